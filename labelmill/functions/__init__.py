"""Column expressions: text, URIs, anchors, answers, rules, video URLs."""
