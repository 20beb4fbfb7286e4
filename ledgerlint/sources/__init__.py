"""Table scans, fixtures derived from the driver tables, and sinks."""
