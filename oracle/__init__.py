"""Independent DuckDB SQL for every registered Spark query (correctness oracle)."""
