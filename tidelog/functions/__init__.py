"""Column expressions: positions in the log, PostgreSQL types, counters as text."""
