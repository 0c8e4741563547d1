"""Landing as an incremental stream."""
