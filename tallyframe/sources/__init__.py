"""Sources, metadata and sinks."""
