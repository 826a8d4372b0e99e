"""The same questions in plain DuckDB SQL, written apart from the Spark plans, to check them against."""
