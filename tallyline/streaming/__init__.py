"""Daily files as a stream."""
