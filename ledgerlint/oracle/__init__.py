"""Independent DuckDB SQL for the registered queries, and a compare tool."""
