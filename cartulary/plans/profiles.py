"""One nested document per area, with small cells suppressed, and its keyed sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.operators.disclosure import suppress_small_cells
from cartulary.operators.merge import any_difference, upsert
from cartulary.plans.households import COMPONENTS, INADEQUACIES
from cartulary.plans.marts import AREA

# Fixed value: what disappears with each suppressed count.
CELLS = {
    "n_families": ("median_per_capita_income",),
    "n_families_deficit": ("deficit_rate",),
    **{f"n_{kind}": (f"{kind}_rate",) for kind in (*COMPONENTS, *INADEQUACIES)},
}


def plain_values(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates as ISO text, NaN as null."""
    values = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind in ("double", "float"):
            column = F.nanvl(column, F.lit(None).cast(kind))
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        values.append(column.alias(name))
    return df.select(*values)


def _or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("double").alias(name)


def build_profiles(
    precarious: DataFrame,
    gap: DataFrame,
    predictions: DataFrame,
    allocated: DataFrame,
    min_cell_size: int,
    generated_at: Column | None = None,
) -> DataFrame:
    """Nested profiles keyed by `_id`; areas missing from a side table get nulls there."""
    generated_at = F.current_timestamp() if generated_at is None else generated_at
    shown = suppress_small_cells(plain_values(precarious), CELLS, min_cell_size)
    joined = (
        shown.join(plain_values(gap).select(AREA, "n_units_contracted", "fjp_deficit", "coverage_fjp"), AREA, "left")
        .join(
            plain_values(predictions).select(AREA, "relative_deficit_forecast", "deficit_forecast_units"), AREA, "left"
        )
        .join(plain_values(allocated).select(AREA, "allocated_units", "investment"), AREA, "left")
    )
    value = lambda name, alias: _or_null(joined, name).alias(alias)
    return joined.select(
        F.col(AREA).alias("_id"),
        F.struct(
            F.col(AREA).alias("ibge_code"),
            F.col("municipality_name").alias("name"),
            F.col("state"),
            F.col("region"),
        ).alias("municipality"),
        "reference_date",
        F.struct(
            value("n_families", "families"),
            value("n_families_deficit", "families_in_deficit"),
            value("deficit_rate", "deficit_rate"),
            F.struct(*[value(f"n_{c}", c) for c in COMPONENTS]).alias("deficit_components"),
            F.struct(*[value(f"{i}_rate", i) for i in INADEQUACIES]).alias("inadequacies"),
            value("precariousness_index", "precariousness_index"),
            value("median_per_capita_income", "median_per_capita_income"),
        ).alias("cadunico"),
        F.struct(
            F.col("n_units_contracted").alias("units_contracted"),
            F.col("fjp_deficit"),
            F.col("coverage_fjp").alias("fjp_coverage"),
        ).alias("service"),
        F.struct(
            F.col("relative_deficit_forecast").alias("relative_deficit"),
            F.col("deficit_forecast_units").alias("deficit_units"),
        ).alias("forecast"),
        F.struct(F.col("allocated_units").alias("units"), F.col("investment")).alias("allocation"),
        F.struct(F.lit(min_cell_size).alias("min_cell_size"), F.col("suppressed_fields")).alias("disclosure_control"),
        generated_at.alias("updated_at"),
    )


def publish(profiles: DataFrame, table: str) -> dict[str, int]:
    """Replace or insert by `_id`; a document whose content is the same is not rewritten.

    `updated_at` alone does not count as a change.
    """
    test = any_difference("updated_at")(profiles.columns)
    counts = upsert(profiles, table, "_id", test)
    return {"inserted": counts["rows_inserted"], "updated": counts["rows_updated"]}


def profiles_with_suppression(profiles: DataFrame) -> DataFrame:
    return profiles.agg(
        F.count(F.lit(1)).alias("profiles"),
        F.count_if(F.size("disclosure_control.suppressed_fields") > 0).alias("profiles_with_suppression"),
    )
