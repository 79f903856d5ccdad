"""End-to-end jobs and the table-derived fixtures used by checks and the bench."""
