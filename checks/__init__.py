"""DuckDB oracle SQL and the local comparison tool (not part of the library)."""
