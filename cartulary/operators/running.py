"""Running totals, ranks and medians over a whole table in sorted order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.sources.storage import settle


def with_running_total(
    df: DataFrame, value: str, order: Sequence[Column], name: str, group: Sequence[str] = ()
) -> DataFrame:
    """Adds `name`: the sum of `value` up to and including the row, within `group`, in `order`.

    `group` and `order` together should tell rows apart. The rows are range-partitioned, each
    range sums on its own, and each starts from the totals of the ranges before it, so neither
    the whole table nor one large group passes through a single task. The ranges are settled
    first because both branches below must see the same boundaries.
    """
    ordering = [*[F.col(g).asc() for g in group], *order]
    ranged = settle(df.repartitionByRange(*ordering).withColumn("_range", F.spark_partition_id()))
    # one row per range and group that meet: at most ranges + groups
    totals = ranged.groupBy("_range", *group).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*group or [F.lit(0)]).orderBy("_range")
    before = F.sum("_total").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        F.col("_range").alias("_r"),
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.coalesce(before, F.lit(0)).alias("_before"),
    )
    match = F.col("_range") == F.col("_r")
    for g in group:
        match &= F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    inside = Window.partitionBy("_range", *group).orderBy(*order)
    local = F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    summed = ranged.withColumn("_local", local).join(offsets, match, "left")
    return summed.select(*df.columns, (F.col("_local") + F.col("_before")).alias(name))


def with_rank(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Adds the 1-based position of each row in `order`."""
    counted = with_running_total(df.withColumn("_one", F.lit(1).cast("bigint")), "_one", order, name)
    return counted.drop("_one")


#: Bins of one refinement, and how often a range is refined.
BINS, LEVELS = 4096, 2
#: Rows of a group that may be sorted in one task.
SORTED_ROWS = 1 << 20


def _bin(value: Column, low: Column, high: Column) -> Column:
    """Equal parts of a range from 0 on; it never falls where the value grows."""
    place = F.floor((value - low) / (high - low) * BINS)
    return F.when(high > low, F.least(place, F.lit(BINS - 1))).otherwise(0)


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    match = F.lit(True)
    for a, b in zip(left, right):
        match &= F.col(a).eqNullSafe(F.col(b))
    return match


def lower_medians(df: DataFrame, group: str, column: str, name: str) -> DataFrame:
    """`group, name`: the exact lower middle of the non-null values of each group.

    The counts of distinct values are made once. Twice the range that holds the middle is cut into
    bins and only the bin with the middle kept; values are sorted within that bin alone. Nothing
    runs before the result is used.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(group, column).agg(F.count(F.lit(1)).alias("_n"))
    number, match = F.col(column).cast("double"), F.col(group).eqNullSafe(F.col("_group"))
    state = values.groupBy(F.col(group).alias("_group")).agg(
        F.min(number).alias("_low"), F.max(number).alias("_high"), F.floor((F.sum("_n") + 1) / 2).alias("_place")
    )
    for _ in range(LEVELS):
        inside = values.join(state, match).where(number.between(F.col("_low"), F.col("_high")))
        binned = inside.groupBy("_group", _bin(number, F.col("_low"), F.col("_high")).alias("_bin")).agg(
            F.sum("_n").alias("_in"), F.min(number).alias("_low"), F.max(number).alias("_high"), F.first("_place").alias("_place")
        )
        state = _holding(binned, ["_group"], [F.col("_bin")], "_in").select("_group", "_low", "_high", (F.col("_place") - F.col("_before")).alias("_place"))
    inside = values.join(state, match).where(number.between(F.col("_low"), F.col("_high")))
    return _holding(inside, ["_group"], [F.col(column)], "_n").select(F.col("_group").alias(group), F.col(column).alias(name))


def _holding(df: DataFrame, group: Sequence[str], order: Sequence[Column], counted: str) -> DataFrame:
    """Of each group the row in which the running sum of `counted` reaches `_place`, and the sum `_before` it."""
    upto = F.sum(counted).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    summed = df.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col(counted))
    return summed.where((F.col("_upto") >= F.col("_place")) & (F.col("_before") < F.col("_place")))


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row with the exact `median`; null when the column has no value.

    Works on the distinct values and their counts, so equal values cost nothing.
    """
    histogram = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranked = with_running_total(histogram, "_n", [F.col(column).asc()], "_upto")
    total = histogram.agg(F.sum("_n").alias("t")).scalar()
    low, high = F.floor((total + 1) / 2), F.floor(total / 2) + 1
    holds = lambda place: (F.col("_upto") >= place) & (F.col("_upto") - F.col("_n") < place)
    return ranked.agg(
        (
            (F.max(F.when(holds(low), F.col(column))) + F.max(F.when(holds(high), F.col(column)))) / 2
        ).alias("median")
    )


def left_in_order(
    df: DataFrame,
    amount: str,
    limits: DataFrame,
    group: Sequence[str],
    value: str,
    code: str,
    name: str,
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """Adds `name`: what is left of the group's limit when the row's turn comes.

    Rows take their `amount` (not negative) by falling `value`, then rising `code` (numbers without nulls).
    `limits` has `group` and `limit`; a group without limit leaves nothing. Rows whose turn surely comes before
    the limit is reached have infinity, rows after it 0.

    The place where a limit is reached is narrowed by bins of values, or of codes among equal
    values, until at most `sorted_rows` of a group lie around it; only those are sorted. The other rows
    are not shuffled. Each step is one aggregate over `df`, which should be cheap to read, and
    settles one row for each group.
    """
    names = [f"_g{i}" for i in range(len(group))]
    own = [F.col(g).alias(n) for g, n in zip(group, names)]
    by, at = F.col(value).cast("double"), F.col(code).cast("double")
    ends = [
        F.min(by).alias("_low"),
        F.max(by).alias("_high"),
        F.min(at).alias("_from_code"),
        F.max(at).alias("_to_code"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum(amount).alias("_in"),
    ]
    here = by.between(F.col("_low"), F.col("_high")) & ((F.col("_low") < F.col("_high")) | at.between(F.col("_from_code"), F.col("_to_code")))
    bins = F.when(F.col("_low") < F.col("_high"), _bin(-by, -F.col("_high"), -F.col("_low"))).otherwise(_bin(at, F.col("_from_code"), F.col("_to_code")))

    limited = limits.select(*own, F.col("limit").cast("double").alias("_place")).where("_place > 0")
    border = settle(df.groupBy(*own).agg(*ends).join(limited, names).withColumn("_all", F.col("_in") <= F.col("_place")))
    for _ in range(2 * LEVELS):
        if (border.agg(F.max(F.when(~F.col("_all"), F.col("_rows")))).first()[0] or 0) <= sorted_rows:
            break
        inside = df.join(border.where("NOT _all").drop("_rows", "_in"), _same(group, names)).where(here)
        binned = inside.groupBy(*names, bins.alias("_bin")).agg(*ends, F.first("_place").alias("_place"))
        found = _holding(binned, names, [F.col("_bin")], "_in").withColumn("_place", F.col("_place") - F.col("_before")).withColumn("_all", F.lit(False))
        border = settle(border.where("_all").unionByName(found.select(*border.columns)))

    placed = df.join(border.drop("_rows", "_in"), _same(group, names), "left")
    earlier = (by > F.col("_high")) | ((by == F.col("_high")) & (F.col("_low") == F.col("_high")) & (at < F.col("_from_code")))
    turn = F.when(F.col("_all") | earlier, F.lit(float("inf"))).otherwise(0.0)
    on_border = F.coalesce(~F.col("_all") & here, F.lit(False))
    outside = placed.where(~on_border).select(*df.columns, turn.alias(name))
    order = Window.partitionBy(*names).orderBy(by.desc(), at.asc()).rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum(amount).over(order) - F.col(amount)
    return outside.unionByName(placed.where(on_border).select(*df.columns, (F.col("_place") - before).alias(name)))
