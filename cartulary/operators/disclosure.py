"""Disclosure control: small-cell suppression and the scan for clear-text identifiers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the shape of a document number, masked or not.
DOCUMENT_SHAPE = r"^\d{3}\.?\d{3}\.?\d{3}-?\d{2}$"


def suppress_small_cells(df: DataFrame, cells: Mapping[str, Sequence[str]], minimum: int) -> DataFrame:
    """Null every count from 1 to `minimum - 1` together with the fields derived from it.

    `cells` maps a count to its derived fields. Zero stays. `suppressed_fields` lists what
    was removed. This is primary suppression: totals can still be differenced.
    """
    present = {
        count: [count, *[d for d in derived if d in df.columns]]
        for count, derived in cells.items()
        if count in df.columns
    }
    small = {count: F.col(count).between(1, minimum - 1) for count in present}
    hidden: dict[str, Column] = {}
    for count, fields in present.items():
        for name in fields:
            hidden[name] = hidden[name] | small[count] if name in hidden else small[count]
    listed = [F.when(small[count], name) for count, fields in present.items() for name in fields]
    return df.select(
        *[
            F.when(~F.coalesce(hidden[c], F.lit(False)), F.col(c)).alias(c) if c in hidden else F.col(c)
            for c in df.columns
        ],
        (F.array_compact(F.array(*listed)) if listed else F.array()).cast("array<string>").alias("suppressed_fields"),
    )


def leak_scan(published: DataFrame, forbidden: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """`column_name, reason, n_rows, n_values` for text that should not be there.

    `forbidden` holds one text column of known identifiers. A value leaks when it is one of
    them or looks like a document number. Values are counted per column before the join, so
    a frequent value costs one row.
    """
    texts = list(columns or [name for name, kind in published.dtypes if kind == "string"])
    long = published.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in texts]))
    )
    counted = long.where("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    known = forbidden.toDF("value").where("value IS NOT NULL").distinct().withColumn("_known", F.lit(True))
    reasons = F.array_compact(
        F.array(
            F.when(F.col("_known"), "known_identifier"),
            F.when(F.col("value").rlike(DOCUMENT_SHAPE), "document_shape"),
        )
    )
    found = counted.join(known, "value", "left").select("column_name", "n", F.explode(reasons).alias("reason"))
    return found.groupBy("column_name", "reason").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_values")
    )
