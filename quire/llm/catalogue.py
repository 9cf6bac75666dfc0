"""What ``__spark_entry__`` registers: queries by name, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from quire.llm import oracles, queries

QUERIES = {name: f for name, f in vars(queries).items() if name.startswith("op") and name[2].isdigit()}
ORACLES = dict(oracles.SQL)
