"""Independent SQL for checking the queries."""
