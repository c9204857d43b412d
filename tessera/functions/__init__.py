"""Column-expression functions (log line parsing)."""
