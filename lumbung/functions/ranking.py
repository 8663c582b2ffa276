"""RANK within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Slots that a group's values are cut into; the window over slots has one row for each.
SLOTS = 64


def rank_desc(df: DataFrame, keys: Sequence[str], by: str, name: str, slots: int = SLOTS) -> DataFrame:
    """Add RANK() OVER (PARTITION BY keys ORDER BY by DESC NULLS FIRST) as column `name`.

    Ties collapse in a map-side combine, so one repeated value costs one row. Approximate
    percentiles, which are mergeable, cut the distinct values of each group into slots; a rank is
    the rows of the slots before, plus the rank within the slot. Where the cuts lie only decides
    how even the slots are, never a rank. No job runs while the plan is built.
    """
    keys = list(keys)
    tallies = df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n"))
    shares = F.array(*[F.lit(i / slots) for i in range(1, slots)])
    cuts = tallies.groupBy(*keys).agg(F.sort_array(F.percentile_approx(by, shares)).alias("_cuts"))
    cut = _with_count_up_to(join_null_safe(tallies, cuts, keys), "_cuts", by, slots - 1, "_below")
    placed = cut.select(
        *keys, by, "_n",
        F.when(F.col(by).isNull(), -1).otherwise(slots - 1 - F.col("_below")).alias("_slot"),
    )
    before = Window.partitionBy(*keys, "_slot").orderBy(F.col(by).desc_nulls_first())
    inside = placed.withColumn(
        "_inside", F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    )
    # At most one row per group and slot.
    earlier = Window.partitionBy(*keys).orderBy("_slot")
    offsets = (
        placed.groupBy(*keys, "_slot")
        .agg(F.sum("_n").alias("_rows"))
        .withColumn(
            "_offset",
            F.sum("_rows").over(earlier.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows"),
        )
        .drop("_rows")
    )
    ranks = join_null_safe(inside, offsets, [*keys, "_slot"]).select(
        *keys, by, (F.col("_offset") + F.col("_inside") + 1).cast("int").alias(name)
    )
    # One row per group and value on the right: a hot value is split by the skew join.
    return join_null_safe(df, ranks, [*keys, by])


def _with_count_up_to(df: DataFrame, ascending: str, value: str, size: int, name: str) -> DataFrame:
    """Add how many of the `size` entries of an ascending array are at most `value`.

    A binary search with a column for each step: unlike a lambda over the entries it stays inside
    codegen, and no step is computed twice.
    """
    df, step = df.withColumn(name, F.lit(0)), 1 << size.bit_length() >> 1
    while step:
        # Past the end there is no entry, so nothing is added.
        higher = F.get(ascending, F.col(name) + (step - 1)) <= F.col(value)
        df = df.withColumn(name, F.col(name) + F.when(higher, step).otherwise(0))
        step >>= 1
    return df


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on `keys` of which NULLs are equal, with the keys of the left side."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    return left.join(renamed, condition).drop(*[f"_right_{key}" for key in keys])
