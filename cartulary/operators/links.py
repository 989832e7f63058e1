"""Existence flags, repeated rows and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 1024


def left_lookup(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join on `key` against a table that holds each key once.

    Rows without a key match nothing, so they are spread over many partitions instead of
    meeting in one. A frequent key only widens the left side, whose skewed partitions Spark
    splits. There is no broadcast hint: Spark broadcasts a side it measures as small.
    """
    others = [name for name in table.columns if name != key]
    plain = [name for name, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    spread = F.pmod(F.xxhash64(*plain), F.lit(NULL_SPREAD)).cast("int")
    slot = F.when(F.col(key).isNull(), spread + 1).otherwise(0)
    left = df.withColumn("_key", F.struct(F.col(key).alias("k"), slot.alias("slot")))
    right = table.select(F.struct(F.col(key).alias("k"), F.lit(0).alias("slot")).alias("_key"), *others)
    return left.join(right, "_key", "left").drop("_key")


def flag_exists(df: DataFrame, reference: DataFrame, key: str, flag: str) -> DataFrame:
    """`flag` is true where `key` occurs in `reference`; a null key gives false."""
    known = reference.select(key).distinct().withColumn(flag, F.lit(True))
    return left_lookup(df, known, key).withColumn(flag, F.coalesce(flag, F.lit(False)))


def flag_repeats(
    df: DataFrame,
    keys: Sequence[str],
    identity: Sequence[str],
    latest: str | None = None,
    flag: str = "_duplicate",
) -> DataFrame:
    """True for every row of a key but one: the newest by `latest`, then first by `identity`.

    `identity` must tell any two rows apart (for example digest, file and row position).
    Rows whose first key is null are never repeats.

    Two steps replace a window over whole rows: one aggregate counts each key and finds its kept
    row, and joining those of keys that do repeat marks the rows. The aggregate reads only key, order and
    identity and combines before its shuffle, so a key that holds a large part of the table
    never lands whole in one task. While few keys repeat, the join is a broadcast and the rows
    are not shuffled at all; otherwise a frequent key only widens its left side, which Spark splits.

    Keys are compared as one struct: null-safe, and no not-null filter is derived from it
    that would compute the key expression a second time at the scan. Keys that are digests travel as
    bytes (`narrowed`).
    """
    texts = [name for name, kind in df.dtypes if kind == "string" and name in keys and name not in (*identity, latest)]
    slim = df.withColumns({name: narrowed(F.col(name)) for name in texts})
    rank = [F.lit(0)] if latest is None else [F.col(latest).isNull(), -_as_number(df, latest)]
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*rank, *map(F.col, identity)])])
    first = F.col(keys[0])
    slot = F.when(first.isNull(), F.pmod(F.xxhash64(*identity), F.lit(NULL_SPREAD)).cast("int")).otherwise(0)

    counted = slim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(F.when(first.isNotNull(), order)).alias("_kept"))
    kept = counted.where("_n > 1 AND _kept IS NOT NULL").select(F.struct(*keys, F.lit(0).alias("_slot")).alias("_kept_key"), "_kept")
    repeats = first.isNotNull() & F.col("_kept").isNotNull() & (order != F.col("_kept"))
    joined = slim.join(kept, F.struct(*keys, slot.alias("_slot")) == F.col("_kept_key"), "left")
    flagged = joined.select(*slim.columns, F.coalesce(repeats, F.lit(False)).alias(flag))
    metadata = {name: df.schema[name].metadata for name in texts}
    return flagged.select(*[widened(F.col(c)).alias(c, metadata=metadata[c]) if c in texts else c for c in flagged.columns])


def narrowed(text: Column) -> Column:
    """The text as bytes, hex digests in half their size. Different texts stay different."""
    hexed = text.rlike(r"\A(?:[0-9a-f]{2})+\z")
    return F.when(hexed, F.concat(F.lit(b"\1"), F.unhex(text))).otherwise(F.concat(F.lit(b"\0"), text.cast("binary")))


def widened(data: Column) -> Column:
    """The text that `narrowed` took."""
    rest = F.substring(data, 2, 2**31 - 1)
    return F.when(F.substring(data, 1, 1) == F.lit(b"\1"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def _as_number(df: DataFrame, column: str) -> Column:
    """A number that grows with the column, so that its negative sorts newest first."""
    kind = df.schema[column].dataType.typeName()
    if kind == "date":
        return F.unix_date(column)
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column)


def newest_per_key(df: DataFrame, key: str, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per non-null key: the one with the greatest `order` columns (nulls lowest)."""
    best = F.max(F.struct(*order, *[c for c in keep if c not in order])).alias("_best")
    chosen = df.where(F.col(key).isNotNull()).groupBy(key).agg(best)
    return chosen.select(key, *[F.col(f"_best.{c}").alias(c) for c in keep])
