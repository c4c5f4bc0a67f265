"""Independent DuckDB SQL for every registered query (the correctness oracle)."""
