"""Independent SQL for the catalog's queries, over the same tables."""
