"""Registered queries of the reference's operators and the same results in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from . import agreement_plans, manifest_plans, source_plans, stats_plans

_PLANS = (agreement_plans, stats_plans, manifest_plans, source_plans)


def _shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Lets Python workers import this package from where the driver has it."""

    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
        if root not in env.get("PYTHONPATH", "").split(":"):
            env["PYTHONPATH"] = ":".join(filter(None, (root, env.get("PYTHONPATH", ""))))
        return f(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(f) for plans in _PLANS for name, f in plans.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for plans in _PLANS for name, sql in plans.ORACLE.items()}
