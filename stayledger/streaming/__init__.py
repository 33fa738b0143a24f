"""Landing as a stream of files."""
