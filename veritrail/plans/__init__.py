"""End-to-end plans: entity views, batch and incremental runs, query list."""
