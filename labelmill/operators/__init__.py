"""DataFrame operators: routing, merging, labelling, reports, checks."""
