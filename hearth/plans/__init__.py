"""Plans: the programme's tables and reports as lazily composed DataFrame jobs."""
