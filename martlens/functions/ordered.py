"""Ordered computations that stay parallel when one group holds most of the rows.

A plain window sorts a whole group inside one task.  Here a group is first cut into
slices along its order, each slice is a window group of its own, and only one summary row
per slice is passed between slices.  The explicit repartition matters: without it
Spark may reuse a partitioning on the group key alone, which puts all slices of a hot
group back into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _sliced(df: DataFrame, keys: Sequence[str], slice_of: Column) -> DataFrame:
    """Rows partitioned by group and slice: one shuffle that all later steps share.

    The slice is made non-null so that the optimizer adds the same filters to every use;
    with different filters the shuffle would be repeated instead of reused.
    """
    never_null = F.coalesce(slice_of.cast("bigint"), F.lit(-1).cast("bigint"))
    return df.withColumn("_slice", never_null).repartition(*keys, "_slice")


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    slice_of: Column,
    towards: str = "previous",
    prefix: str = "previous_",
) -> DataFrame:
    """Add the values of the previous (or next) row of the same group.

    `order` must be unique inside a group and `slice_of` must be a number or time
    that rises with it; neither they nor the keys may be null.
    """
    backwards = towards == "previous"
    step = F.lag if backwards else F.lead
    pick = F.max_by if backwards else F.min_by
    group = [*keys, "_slice"]
    taken = [order, *[v for v in values if v != order]]

    sliced = _sliced(df, keys, slice_of)
    inside = Window.partitionBy(*group).orderBy(order)
    near = sliced.withColumns({f"_near_{v}": step(v).over(inside) for v in taken})

    # the row of each slice that faces the neighbouring slice
    edges = sliced.groupBy(*group).agg(*[pick(v, order).alias(v) for v in taken])
    across = Window.partitionBy(*keys).orderBy("_slice")
    facing = edges.select(*group, *[step(v).over(across).alias(f"_far_{v}") for v in taken])

    joined = near.join(facing, group)
    at_edge = F.col(f"_near_{order}").isNull()
    return joined.select(
        *df.columns,
        *[
            F.when(at_edge, F.col(f"_far_{v}")).otherwise(F.col(f"_near_{v}")).alias(prefix + v)
            for v in values
        ],
    )


def with_total_before(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    out: str = "total_before",
    slice_bits: int = 21,
    value_bits: int = 63,
) -> DataFrame:
    """Add the sum of `weight` over the rows of the group with a smaller `value`.

    `value` is a non-negative integer below 2^value_bits, unique inside its group, so a
    slice of 2^slice_bits neighbouring values has at most that many rows however the
    values are spread.  Slice totals are summed the same way, one level up.
    """
    if value_bits <= slice_bits:
        upto = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.coalesce(F.sum(weight).over(upto), F.lit(0)))

    group = [*keys, "_slice"]
    sliced = _sliced(df, keys, F.shiftright(F.col(value).cast("bigint"), slice_bits))
    upto = Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inside = sliced.withColumn("_inside", F.coalesce(F.sum(weight).over(upto), F.lit(0)))
    totals = sliced.groupBy(*group).agg(F.sum(weight).alias("_weight"))
    level_up = totals.withColumnRenamed("_slice", "_value")
    offsets = (
        with_total_before(
            level_up, keys, "_value", "_weight", "_offset", slice_bits, value_bits - slice_bits
        )
        .withColumnRenamed("_value", "_slice")
        .select(*group, "_offset")
    )
    return inside.join(offsets, group).select(
        *df.columns, (F.col("_inside") + F.col("_offset")).alias(out)
    )


def with_row_number(
    df: DataFrame, keys: Sequence[str], unique_id: str, out: str = "row_number", **slicing: int
) -> DataFrame:
    """1-based position by a unique non-negative integer id, over a group or the whole table."""
    counted = with_total_before(
        df.withColumn("_one", F.lit(1)), keys, unique_id, "_one", "_before", **slicing
    )
    return counted.select(*df.columns, (F.col("_before") + 1).cast("bigint").alias(out))


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "rank"
) -> DataFrame:
    """The first k rows of each group.

    Spark plans row_number() <= k as a group limit before the shuffle too, so each map
    task sends at most k rows of a group however large the group is.
    """
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(out) <= k)


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], value_bits: int = 63
) -> DataFrame:
    """Exact linearly interpolated percentiles of a non-negative integer column.

    The built-in exact percentile holds every distinct value of a group in one buffer.
    Here equal values are counted first and ranks come from sliced running totals.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranked = with_total_before(counts, keys, value, "_n", "_before", value_bits=value_bits)
    sizes = counts.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    placed = ranked.join(sizes, list(keys))

    def at(rank: Column) -> Column:
        hit = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n"))
        return F.max(F.when(hit, F.col(value))).cast("double")

    aggs = [F.max("_size").alias("n_values")]
    for name, share in shares.items():
        spot = (F.col("_size") - 1) * F.lit(share)
        low, high = F.floor(spot), F.ceil(spot)
        aggs += [
            at(low).alias(f"_low_{name}"),
            at(high).alias(f"_high_{name}"),
            F.max(spot - low).alias(f"_part_{name}"),
        ]
    found = placed.groupBy(*keys).agg(*aggs)
    return found.select(
        *keys,
        "n_values",
        *[
            (
                F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * F.col(f"_part_{n}")
            ).alias(n)
            for n in shares
        ],
    )


def as_of_join(
    left: DataFrame, right: DataFrame, key: str, time: str, value_time: str, values: Sequence[str], unit: str = "month"
) -> DataFrame:
    """Every left row with the values of the newest right row of its key at or before its own time, null where there is none.

    Both sides are merged in time slices of one calendar unit, so a hot key is cut up; the last right row of each slice is carried
    over the slices after it.  Left rows without a key or a time get nulls.  The right side has one row per key and time.
    """
    value = F.struct(F.col(value_time).alias("_from"), *values)
    asked = left.select(F.col(key).alias("_key"), F.col(time).alias("_time"), F.struct("*").alias("_row"))
    told = right.where(F.col(key).isNotNull() & F.col(value_time).isNotNull())
    told = told.select(F.col(key).alias("_key"), F.col(value_time).alias("_time"), value.alias("_value"))
    usable = F.col("_key").isNotNull() & F.col("_time").isNotNull()
    both = asked.where(usable).unionByName(told, allowMissingColumns=True)
    sliced = _sliced(both, ["_key"], F.unix_micros(F.date_trunc(unit, "_time")))
    # of equal times the right row comes first
    upto = Window.partitionBy("_key", "_slice").orderBy("_time", F.col("_row").isNotNull())
    near = sliced.withColumn("_near", F.last("_value", ignorenulls=True).over(upto)).where(F.col("_row").isNotNull())

    ends = sliced.groupBy("_key", "_slice").agg(F.max("_value").alias("_value"))
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_key", "_slice", F.last("_value", ignorenulls=True).over(before).alias("_far"))
    found = near.join(carried, ["_key", "_slice"]).select("_row", F.coalesce("_near", "_far").alias("_value"))
    nothing = asked.where(~usable).select("_row").withColumn("_value", F.lit(None).cast(told.schema["_value"].dataType))
    return found.unionByName(nothing).select("_row.*", *[F.col("_value").getField(v).alias(v) for v in values])
