"""Bronze table, landed files, correction lists and dumps."""
