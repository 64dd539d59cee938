"""End-to-end jobs and the query catalogue (queries() / oracle_sql())."""
