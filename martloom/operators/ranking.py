"""Global ranks without pulling all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS_PER_DOUBLING = 64
SALTS = 16


def _coarse(value: Column) -> Column:
    """A step function that never decreases: 64 steps per doubling, about 1% wide, whatever the spread.

    A 64-bit range has at most 2 * 64 * 64 steps, which bounds the table of step totals.
    """
    v = value.cast("double")
    return (F.signum(v) * F.floor(F.log2(F.abs(v) + 1) * STEPS_PER_DOUBLING)).cast("int")


def _same_reading(df: DataFrame) -> DataFrame:
    """``df`` under a condition that always holds and reads every column.

    ``rank_by`` reads its rows twice. If one reading asked for fewer columns it would get an aggregation, and all the
    joins and scans below it, of its own; readings of the same columns share one shuffle.
    """
    return df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(1)) == 0)


def rank_by(
    df: DataFrame,
    value: str,
    rank: str = "rank",
    dense: str | None = None,
    spread_by: str | None = None,
) -> DataFrame:
    """Add ``rank`` (1 + rows with a greater value) and, on request, the gapless ``dense`` rank.

    Rows are first counted per distinct value, which is partial aggregation and needs no sort of the rows. The counts
    are summed per coarse step; the running total over the few steps is one small window, and the running total
    inside a step is a window per step. Joining back spreads each value over ``SALTS`` keys (``spread_by`` picks the
    salt), so a value shared by a third of the rows is not one task's work.
    """
    counts = _same_reading(df).filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_step", _coarse(F.col(value)))

    steps = counts.groupBy("_step").agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    above = Window.orderBy(F.desc("_step")).rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select(
        "_step",
        F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_rows_above"),
        F.coalesce(F.sum("_values").over(above), F.lit(0)).alias("_values_above"),
    )

    greater = Window.partitionBy("_step").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.join(F.broadcast(steps), "_step").select(
        value,
        (1 + F.col("_rows_above") + F.coalesce(F.sum("_n").over(greater), F.lit(0))).cast("bigint").alias(rank),
        (1 + F.col("_values_above") + F.coalesce(F.count("_n").over(greater), F.lit(0))).cast("bigint").alias("_dense"),
    )
    placed = placed.withColumnRenamed("_dense", dense) if dense else placed.drop("_dense")

    if spread_by is None:
        return df.join(placed, value, "left")
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    copies = placed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [value, "_salt"], "left").drop("_salt")
