"""End-to-end jobs, and the queries that are checked against SQL."""
