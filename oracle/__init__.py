"""DuckDB SQL for every registered query, written independently of the Spark code."""
