"""Planning tables and end-to-end jobs."""
