"""Document profile of a table: how many values are valid, invalid or missing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.functions.documents import with_documents


def validate_documents(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """`document_column, status, n` from one pass; `kinds` maps a column to `cpf` or `nis`."""
    statuses = with_documents(df.select(*kinds), kinds)
    counted = statuses.agg(
        *[
            F.count_if(F.col(f"_status_{column}") == status).alias(f"{column}|{status}")
            for column in kinds
            for status in ("valid", "invalid", "missing")
        ]
    )
    cells = [
        F.struct(
            F.lit(name.split("|")[0]).alias("document_column"),
            F.lit(name.split("|")[1]).alias("status"),
            F.col(f"`{name}`").alias("n"),
        )
        for name in counted.columns
    ]
    return counted.select(F.inline(F.array(*cells)))
