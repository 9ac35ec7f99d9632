"""Whole jobs: documents to records, videos to records."""
