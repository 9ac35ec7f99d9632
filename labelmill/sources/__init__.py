"""Readers: object listings, OCR shard files, metadata CSV."""
