"""Count, mean and squared deviations of score columns, kept per run and merged, so that old posts need not be read again."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "column string, n bigint, mean double, m2 double, run string"


def part_moments(df: DataFrame, columns: Sequence[str], run: str | Column) -> DataFrame:
    """``run, column, n, mean, m2`` per run and column: non-null values, their mean, and squared distances from it.

    ``run`` is a name, or an expression that gives each row its own (a date, say). Columns without a value in a run
    have no row there. One aggregation with map-side combining.
    """
    run = F.lit(run) if isinstance(run, str) else F.coalesce(run.cast("string"), F.lit("none"))
    told = [
        F.struct(
            F.lit(c).alias("column"), F.count(F.col(f"`{c}`")).alias("n"), F.avg(F.col(f"`{c}`")).alias("mean"),
            (F.var_pop(F.col(f"`{c}`")) * F.count(F.col(f"`{c}`"))).alias("m2"),
        )
        for c in columns
    ]
    parts = df.groupBy(run.alias("run")).agg(F.array(*told).alias("_told"))
    return parts.select("run", F.inline("_told")).where("n > 0")


def merge_moments(parts: DataFrame) -> DataFrame:
    """``column, n, mean, m2`` over all given parts, in any order; merged rows can be merged again.

    Deviations are taken from the merged mean, never as a difference of two large sums.
    """
    total = parts.groupBy("column").agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    apart = F.col("mean") - F.col("_mean")
    return (
        parts.join(total, "column").groupBy("column", "_n", "_mean")
        .agg(F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"))
        .select("column", F.col("_n").alias("n"), F.col("_mean").alias("mean"), "m2")
    )


def store_moments(df: DataFrame, columns: Sequence[str], folder: str, run: str | Column) -> None:
    """Add the moments of new rows to a stored table; a run that is stored already is replaced, not counted twice."""
    parts = part_moments(df, columns, run).coalesce(1)  # a row per run and column
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(folder)


def stored_moments(spark: SparkSession, folder: str) -> DataFrame:
    """The merged moments of all runs in a stored table."""
    return merge_moments(spark.read.schema(SCHEMA).parquet(folder))


def as_fit(moments: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column (a row per column comes back), as ``zscore`` and frozen fits take them.

    A deviation within the rounding error of the sum is 0.
    """
    spread = F.sqrt(F.col("m2") / F.col("n"))
    noise = F.col("n") * F.lit(sys.float_info.epsilon) * F.abs("mean")
    rows = moments.select("column", "mean", F.when(spread > noise, spread).otherwise(F.lit(0.0)).alias("spread")).collect()
    return {r["column"]: (r["mean"], r["spread"]) for r in rows}
