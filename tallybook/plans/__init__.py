"""Registered queries, their DuckDB oracles and the stand-in inputs they read."""
