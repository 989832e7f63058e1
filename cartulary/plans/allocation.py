"""Allocation of housing units under a budget, with a minimum share per region.

Maximise the sum of priority times units, with units at most the capacity of each area,
total cost at most the budget and a floor of spending per region. The cost is one value per
region, so within a region money is best spent by priority, and across regions by priority
per unit of cost. The cut of priority up to which money lasts is found by refining bins, once
within each region and once over all; only areas at the cut are sorted. This is the optimum
of the relaxed problem; the whole-unit answer is within one unit's priority of it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.operators.running import exact_median, left_in_order
from cartulary.sources.storage import drop_path, settle, stage

# Fixed value: keeps areas of zero priority eligible for what is left.
TINY = 1e-6


class MissingCost(ValueError):
    """A region has no unit cost."""


def _known(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.greatest(F.nanvl(F.coalesce(value, F.lit(0.0)), F.lit(0.0)), F.lit(0.0))


def unit_cost(region: Column, costs: Mapping[str, float]) -> Column:
    known = F.lit(None).cast("double")
    for name, cost in costs.items():
        known = F.when(region == name, F.lit(float(cost))).otherwise(known)
    return known


def require_costs(areas: DataFrame, costs: Mapping[str, float]) -> None:
    without = areas.where(unit_cost(F.col("region"), costs).isNull()).select("region").distinct()
    missing = without.agg(F.count(F.lit(1)).alias("n"), F.min(F.coalesce("region", F.lit("None"))).alias("first")).first()
    if missing.n:
        raise MissingCost(f"no unit cost for {missing.first}" + f" and {missing.n - 1} more" * (missing.n > 1))


def region_floors(sized: DataFrame, budget: float, min_share: float) -> DataFrame:
    """`region, floor_units`: whole units each region must get.

    One unit cost is taken off the floor, so that whole units can always meet it.
    """
    totals = sized.groupBy("region").agg(
        F.sum("_need").alias("_region_need"),
        F.sum(F.col("unit_cost") * F.col("capacity")).alias("_absorbable"),
        F.max("unit_cost").alias("_cost"),
    )
    overall = sized.agg(F.sum("_need").alias("n")).scalar()
    share = F.when(overall > 0, F.col("_region_need") / overall)
    money = F.least(F.lit(min_share * budget) * share, F.col("_absorbable")) - F.col("_cost")
    units = F.ceil(F.greatest(F.coalesce(money, F.lit(0.0)), F.lit(0.0)) / F.col("_cost"))
    return totals.select("region", units.cast("bigint").alias("floor_units"))


def allocate(
    areas: DataFrame,
    budget: float,
    costs: Mapping[str, float],
    execution_cap: float = 0.3,
    min_region_share: float = 0.8,
    code: str = "municipality_code",
) -> DataFrame:
    """Adds `unit_cost, capacity, allocated_units, investment` to
    `code, region, deficit_forecast_units, precariousness_index`."""
    require_costs(areas, costs)
    columns = areas.columns
    middle = exact_median(
        areas.where(~F.isnan(F.col("precariousness_index").cast("double"))), "precariousness_index"
    ).scalar()
    index = F.nanvl(F.col("precariousness_index").cast("double"), F.lit(None).cast("double"))
    sized = areas.withColumns(
        {
            "unit_cost": unit_cost(F.col("region"), costs),
            "_need": _known("deficit_forecast_units"),
            "capacity": F.floor(_known("deficit_forecast_units") * execution_cap).cast("bigint"),
            "_priority": F.greatest(F.coalesce(index, middle.cast("double"), F.lit(0.0)), F.lit(0.0)) + TINY,
        }
    )

    sized, at = stage(sized, "sized")
    floors = region_floors(sized, budget, min_region_share)
    turns = left_in_order(sized, "capacity", floors.withColumnRenamed("floor_units", "limit"), ["region"], "_priority", code, "_left")
    first = F.greatest(F.least(F.col("capacity").cast("double"), F.col("_left")), F.lit(0.0)).cast("bigint")
    # settled: the spent total and the second pass must see the same first pass
    floored = settle(
        turns.withColumn("_first", first)
        .withColumn("_room_cost", (F.col("capacity") - F.col("_first")) * F.col("unit_cost"))
        .withColumn("_value", F.col("_priority") / F.col("unit_cost"))
        .drop("_left")
    )
    drop_path(areas.sparkSession, at)

    spent = F.coalesce(F.sum(F.col("_first") * F.col("unit_cost")), F.lit(0.0))
    limit = floored.agg((F.lit(float(budget)) - spent).alias("limit")).withColumn("_all_areas", F.lit(0))
    ranked = left_in_order(floored.withColumn("_all_areas", F.lit(0)), "_room_cost", limit, ["_all_areas"], "_value", code, "_left")
    spare = F.floor(F.col("_left") / F.col("unit_cost"))
    second = F.least(F.col("capacity") - F.col("_first"), F.greatest(spare, F.lit(0)))
    units = (F.col("_first") + second).cast("bigint")
    return ranked.select(
        *columns,
        "unit_cost",
        "capacity",
        units.alias("allocated_units"),
        (units * F.col("unit_cost")).alias("investment"),
    )


def allocation_totals(allocated: DataFrame) -> DataFrame:
    return allocated.agg(
        F.sum("allocated_units").alias("total_units"),
        F.sum("investment").alias("total_investment"),
        F.count_if(F.col("allocated_units") > 0).alias("areas_with_units"),
    )
