"""Column jobs (native expressions) and fixed domain values."""
