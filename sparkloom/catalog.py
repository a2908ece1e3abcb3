"""Every query of the library by name, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.plans import core, more, policy, privacy, rollups


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core.QUERIES | more.QUERIES | privacy.QUERIES | policy.QUERIES | rollups.QUERIES


def oracle_sql() -> dict[str, str]:
    return core.SQL | more.SQL | privacy.SQL | policy.SQL | rollups.SQL
