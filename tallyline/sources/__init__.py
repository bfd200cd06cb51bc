"""Reading delivered files, loading tables and writing results."""
