"""Independent DuckDB SQL for every registered job (the correctness oracle)."""
