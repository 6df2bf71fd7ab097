"""End-to-end jobs and the mapping of the given tables to a behaviour log."""
