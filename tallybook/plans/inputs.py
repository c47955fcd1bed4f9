"""Typed ledger inputs for the registered queries: fixtures conformed to the declared schemas."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook import schemas as S
from tallybook.plans.fixtures import fixture
from tallybook.schemas import conform  # noqa: F401  (re-export)


class Inputs:
    """Lazily built fixture DataFrames for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return fixture(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        return conform(self.raw("fx_customers"), S.CUSTOMERS)

    @cached_property
    def accounts(self) -> DataFrame:
        return conform(self.raw("fx_accounts"), S.ACCOUNTS)

    @cached_property
    def transfers(self) -> DataFrame:
        return conform(self.raw("fx_transfers"), S.TRANSFER_REQUESTS)

    @cached_property
    def journal(self) -> DataFrame:
        return conform(self.raw("fx_journal"), S.JOURNAL_TRANSACTIONS)

    @cached_property
    def lines(self) -> DataFrame:
        return conform(self.raw("fx_lines"), S.JOURNAL_LINES)

    @cached_property
    def lines_bad(self) -> DataFrame:
        return conform(self.raw("fx_lines_bad"), S.JOURNAL_LINES)

    @cached_property
    def holds(self) -> DataFrame:
        return conform(self.raw("fx_holds"), S.FUNDS_HOLDS)

    @cached_property
    def projections(self) -> DataFrame:
        return conform(self.raw("fx_projections"), S.BALANCE_PROJECTIONS)

    @cached_property
    def deposits(self) -> DataFrame:
        return self.raw("fx_deposits")

    @cached_property
    def withdrawals(self) -> DataFrame:
        return self.raw("fx_withdrawals")

    @cached_property
    def ops(self) -> DataFrame:
        return self.raw("fx_ops")
