"""Registry of runnable queries (one per operator output) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybook.plans.fixtures import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``oracle`` is SQL over fixtures."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    from tallybook.plans import (  # noqa: F401
        q_balances,
        q_posting,
        q_validate,
        q_lookup,
        q_sources,
        q_holds,
        q_idem,
        q_recon,
        q_outbox,
        q_provider,
        q_projections,
        q_admission,
        q_streaming,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return {k: with_fixtures(v, "duckdb") for k, v in ORACLES.items()}
