"""Column expressions shared by the jobs (built-ins only, no Python UDF)."""
