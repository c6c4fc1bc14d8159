"""Named queries (``catalog``) and their DuckDB SQL (``oracle``)."""
