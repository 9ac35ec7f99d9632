"""Writers: metadata CSV, text sidecar table."""
