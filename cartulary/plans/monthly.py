"""The monthly job end to end: files, silver tables, indicators, forecast, allocation, profiles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.functions.pseudonyms import Pseudonyms
from cartulary.plans import marts
from cartulary.plans.allocation import allocate, allocation_totals
from cartulary.plans.audit import Step, logged
from cartulary.plans.forecast import TreeSettings, feature_table, forecast
from cartulary.plans.ingest import ingest
from cartulary.plans.lake import Lake, Parameters
from cartulary.plans.profiles import build_profiles, profiles_with_suppression, publish
from cartulary.plans.refine import LOADS, refine
from cartulary.sources.layouts import FEEDS
from cartulary.sources.storage import drop_path, read_table, stage, write_version


def ingest_all(spark: SparkSession, lake: Lake, inbox: str, run_id: str, reprocess: bool = False) -> int:
    return sum(ingest(spark, lake, name, inbox, run_id, reprocess) for name in FEEDS)


def refine_all(
    spark: SparkSession,
    lake: Lake,
    run_id: str,
    key: str | bytes,
    parameters: Parameters = Parameters(),
    today: date | None = None,
) -> None:
    pseudonyms = Pseudonyms(spark, key)
    for load in LOADS.values():
        refine(spark, lake, run_id, load, pseudonyms, parameters, today)


def _written(spark: SparkSession, lake: Lake, step: Step, df: DataFrame) -> DataFrame:
    """Write a gold table and go on with the stored rows."""
    table = lake.path("gold", step.table)
    write_version(df, table)
    stored = read_table(spark, table)
    step.rows_out = stored.count()
    return stored


def build_marts(spark: SparkSession, lake: Lake, run_id: str, parameters: Parameters = Parameters()) -> None:
    silver = lambda name: read_table(spark, lake.path("silver", name))
    families, areas = silver("cadunico_family"), silver("dim_municipality")
    contracts = silver("mcmv_beneficiaries")

    with logged(spark, lake, Step(run_id, "gold", "municipality_precariousness")) as step:
        precarious = _written(spark, lake, step, marts.precariousness(families, areas))
        step.snapshot = precarious.agg(F.max("reference_date")).first()[0]

    crossed = marts.crosswalk(contracts, silver("cadunico_person"), families, parameters.income_bands)
    # two tables read it, so it is written once instead of joined twice
    crossed, folder = stage(crossed, "crosswalk")
    try:
        with logged(spark, lake, Step(run_id, "gold", "mcmv_targeting")) as step:
            _written(spark, lake, step, marts.targeting(crossed))
        with logged(spark, lake, Step(run_id, "gold", "review_flags")) as step:
            _written(spark, lake, step, marts.review_flags(crossed))
    finally:
        drop_path(spark, folder)

    with logged(spark, lake, Step(run_id, "gold", "service_gap")) as step:
        _written(spark, lake, step, marts.service_gap(precarious, contracts, silver("fjp_deficit"), areas))


def forecast_and_allocate(
    spark: SparkSession,
    lake: Lake,
    run_id: str,
    parameters: Parameters = Parameters(),
    settings: TreeSettings = TreeSettings(),
) -> None:
    precarious = read_table(spark, lake.path("gold", "municipality_precariousness"))
    areas = read_table(spark, lake.path("silver", "dim_municipality"))
    deficit = read_table(spark, lake.path("silver", "fjp_deficit"))

    with logged(spark, lake, Step(run_id, "ml", "deficit_forecast")) as step:
        result = forecast(feature_table(precarious, areas, deficit), settings)
        step.details["metrics"] = result.metrics
        predictions = _written(spark, lake, step, result.predictions.withColumn("run_id", F.lit(run_id)))

    with logged(spark, lake, Step(run_id, "ml", "unit_allocation")) as step:
        wanted = predictions.select(
            marts.AREA, "municipality_name", "state", "region", "deficit_forecast_units"
        ).join(
            precarious.select(marts.AREA, F.col("precariousness_index").cast("double")), marts.AREA, "left"
        )
        allocated = allocate(
            wanted,
            parameters.budget,
            parameters.unit_costs,
            parameters.execution_cap,
            parameters.min_region_share,
        )
        totals = allocation_totals(_written(spark, lake, step, allocated)).first()
        step.rows_out = totals.areas_with_units
        step.details.update(total_units=totals.total_units, total_investment=totals.total_investment)


def publish_profiles(
    spark: SparkSession, lake: Lake, run_id: str, table: str, parameters: Parameters = Parameters()
) -> dict[str, int]:
    gold = lambda name: read_table(spark, lake.path("gold", name))
    with logged(spark, lake, Step(run_id, "publishing", "municipality_profiles")) as step:
        profiles = build_profiles(
            gold("municipality_precariousness"),
            gold("service_gap"),
            gold("deficit_forecast"),
            gold("unit_allocation"),
            parameters.min_cell_size,
        )
        counts = publish(profiles, table)
        seen = profiles_with_suppression(profiles).first()
        step.rows_out = seen.profiles
        step.details.update(
            rows_inserted=counts["inserted"], rows_updated=counts["updated"], profiles_with_suppression=seen.profiles_with_suppression
        )
    return counts
