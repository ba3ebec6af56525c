"""Table declarations, readers, sinks and the landing adapters."""
