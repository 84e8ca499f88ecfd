"""Independent DuckDB SQL for the correctness gate (not part of the library)."""
