"""The official rule sets, the catalog of published columns, and the steps after the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.checking import SHIPMENTS
from bindings.cleaning import KEY, raw_lines, with_cents
from bindings.indicators import AREAS_SQL, areas, indicators, units_and_deficit
from bindings.registry import query, table
from cartulary.functions.pseudonyms import Pseudonyms
from cartulary.operators.policy import apply_policy, catalog
from cartulary.operators.preparation import prepare
from cartulary.operators.quality import check
from cartulary.plans import marts
from cartulary.plans.audit import read_runs, with_details
from cartulary.plans.forecast import TreeSettings
from cartulary.plans.lake import Lake, Parameters
from cartulary.plans.monthly import forecast_and_allocate, publish_profiles
from cartulary.plans.refine import RULES, parse_rules
from cartulary.sources.storage import read_table, scratch_folder, write_version

# What the cleaned columns are read from: the same text serves Spark and the oracle.
CLEANED = {
    "dim_municipality": (
        "customer",
        {
            "_layout_invalid": "c_custkey % 11 = 0",
            "_code_valid": "CASE WHEN c_custkey % 5 > 0 THEN c_acctbal > 0 END",
            "state": "CASE WHEN c_custkey % 7 > 0 THEN substr(c_mktsegment, 1, c_nationkey % 3 + 1) END",
            "population": "CASE WHEN c_custkey % 13 > 0 THEN c_acctbal END",
        },
    ),
    "fjp_deficit": (
        "part",
        {
            "_layout_invalid": "p_partkey % 11 = 0",
            "_municipality_exists": "p_size > 5",
            "deficit_total": "CASE WHEN p_partkey % 7 > 0 THEN p_size - 10 END",
        },
    ),
    "cadunico_family": (
        "orders",
        {
            "_layout_invalid": "o_orderkey % 11 = 0",
            "_odd": "o_orderkey % 13 = 0",
            "family_id": "CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey END",
            "_duplicate": "o_orderkey % 5 = 1",
            "_municipality_exists": "o_custkey % 3 > 0",
            "total_income": "CASE WHEN o_orderkey % 17 > 0 THEN o_totalprice - 100000 END",
            "last_update_date": "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END",
            "_reference_date": "DATE '1999-06-01'",
            "people_in_dwelling": "CASE WHEN o_orderkey % 19 > 0 THEN o_orderkey % 40 END",
            "bedrooms": "o_orderkey % 4",
            "rooms": "CASE WHEN o_custkey % 6 > 0 THEN o_custkey % 5 END",
            "zip_prefix": "CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END",
        },
    ),
    "cadunico_person": (
        "lineitem",
        {
            "_layout_invalid": "l_orderkey % 11 = 0",
            "_odd": "l_partkey % 13 = 0",
            "person_id": "CASE WHEN l_partkey % 7 > 0 THEN l_partkey END",
            "_duplicate": "l_linenumber = 6",
            "_municipality_exists": "l_suppkey % 3 > 0",
            "family_id": "CASE WHEN l_linenumber < 7 THEN l_orderkey END",
            "age": "CASE WHEN l_partkey % 23 > 0 THEN l_quantity * 3 - 5 END",
            "cpf_status": "CASE l_returnflag WHEN 'A' THEN 'valid' WHEN 'N' THEN 'missing' ELSE 'invalid' END",
            "nis_status": "CASE WHEN l_linestatus = 'O' THEN 'invalid' ELSE 'missing' END",
            "sex": "CASE WHEN l_partkey % 29 > 0 THEN l_linenumber END",
            "_family_exists": "CASE WHEN l_suppkey % 4 > 0 THEN l_tax > 0.02 END",
        },
    ),
    "mcmv_beneficiaries": (
        "events",
        {
            "_layout_invalid": "event_id % 11 = 0",
            "_odd": "event_id % 13 = 0",
            "cpf_status": "CASE event_type WHEN 'error' THEN 'invalid' ELSE 'valid' END",
            "_duplicate": "user_id % 5 = 1",
            "program": "CASE event_type WHEN 'click' THEN 'FAR' WHEN 'purchase' THEN 'FGTS' WHEN 'error' THEN 'FDS' ELSE upper(event_type) END",
            "_municipality_exists": "user_id % 3 > 0",
            "declared_income": "CASE WHEN event_id % 7 > 0 THEN value - 20 END",
            "band_ceiling": "CASE WHEN event_id % 4 > 0 THEN 2850 END",
            "contract_date": "CAST(ts AS DATE)",
            "_reference_date": "DATE '2024-01-20'",
            "age": "user_id",
        },
    ),
}
# The rules again, for the oracle.
HOLDS = {
    "dim_municipality": {
        "layout_valid": "NOT _layout_invalid",
        "ibge_code_valid": "_code_valid",
        "state_valid": "length(state) = 2",
        "population_positive": "population > 0",
    },
    "fjp_deficit": {"layout_valid": "NOT _layout_invalid", "municipality_valid": "_municipality_exists", "deficit_non_negative": "deficit_total >= 0"},
    "cadunico_family": {
        "layout_valid": "NOT _layout_invalid",
        "types_valid": "NOT _odd",
        "family_id_present": "family_id IS NOT NULL",
        "unique_record": "NOT _duplicate",
        "municipality_valid": "_municipality_exists",
        "income_non_negative": "total_income >= 0",
        "update_date_valid": "last_update_date <= _reference_date",
        "plausible_people_in_dwelling": "people_in_dwelling >= 1 AND people_in_dwelling <= 30",
        "consistent_bedrooms": "bedrooms <= rooms",
        "zip_valid": "zip_prefix IS NOT NULL",
    },
    "cadunico_person": {
        "layout_valid": "NOT _layout_invalid",
        "types_valid": "NOT _odd",
        "person_id_present": "person_id IS NOT NULL",
        "unique_record": "NOT _duplicate",
        "municipality_valid": "_municipality_exists",
        "family_id_present": "family_id IS NOT NULL",
        "age_valid": "age >= 0 AND age <= 120",
        "cpf_valid_when_present": "cpf_status <> 'invalid'",
        "nis_valid_when_present": "nis_status <> 'invalid'",
        "sex_valid": "sex = 1 OR sex = 2",
        "family_exists": "_family_exists",
    },
    "mcmv_beneficiaries": {
        "layout_valid": "NOT _layout_invalid",
        "types_valid": "NOT _odd",
        "cpf_valid": "cpf_status = 'valid'",
        "unique_record": "NOT _duplicate",
        "program_valid": "program = 'FAR' OR program = 'FDS' OR program = 'PNHR' OR program = 'FGTS'",
        "municipality_valid": "_municipality_exists",
        "income_non_negative": "declared_income >= 0",
        "band_valid": "band_ceiling IS NOT NULL",
        "contract_date_valid": "contract_date <= _reference_date",
        "plausible_age": "age >= 18 AND age <= 110",
    },
}
WARNINGS = (
    "types_valid plausible_people_in_dwelling consistent_bedrooms zip_valid cpf_valid_when_present nis_valid_when_present sex_valid "
    "family_exists plausible_age"
).split()


def _rule_sql(name: str) -> str:
    source, columns = CLEANED[name]
    cleaned = f"SELECT {', '.join(f'{text} AS {column}' for column, text in columns.items())} FROM {source}"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{rule}' AS rule, '{'warning' if rule in WARNINGS else 'blocking'}' AS severity, "
        f"count(*) FILTER (WHERE NOT coalesce({holds}, false)) AS failures, count(*) AS total FROM ({cleaned})"
        for rule, holds in HOLDS[name].items()
    )


@query(" UNION ALL ".join(map(_rule_sql, CLEANED)))
def rule_sets(spark, folder):
    """All five rule sets of the load, counted over whole tables."""
    out = None
    for name, (source, columns) in CLEANED.items():
        rows = table(spark, folder, source).select(*[F.expr(text).alias(column) for column, text in columns.items()])
        if "_odd" in columns:
            rows = rows.withColumn("_invalid_types", F.when(F.col("_odd"), F.array(F.lit("X"))).otherwise(F.array()))
        metrics = check(rows, parse_rules(RULES[name])).metrics.select(F.lit(name).alias("table_name"), "rule", "severity", "failures", "total")
        out = metrics if out is None else out.unionByName(metrics)
    return out


@query("""
SELECT column_name, category, action, n FROM (
  SELECT * FROM (VALUES ('order_key', 'operational', 'keep'), ('line_number', 'operational', 'keep'), ('price', 'operational', 'keep'),
    ('quantity', 'operational', 'keep'), ('ship_date', 'operational', 'keep'), ('flag', 'operational', 'keep'), ('supplier', 'operational', 'keep'),
    ('line_id', 'identifier', 'pseudonymize')) c(column_name, category, action))
JOIN (SELECT unnest(['order_key', 'line_number', 'price', 'supplier', 'line_id', 'quantity', 'ship_date', 'flag']) AS column_name,
  unnest([count(*), count(*), count(*), count(*), count(*), count(*) FILTER (WHERE NOT (l_linenumber = 7 AND l_returnflag = 'R')),
          count(*) FILTER (WHERE NOT (l_linestatus = 'O' AND l_linenumber = 1)), count(*) FILTER (WHERE l_linenumber <> 2)]) AS n FROM lineitem)
  USING (column_name)
""")
def column_catalog(spark, folder):
    """Surviving columns with category and action, read from the schema of the cleaned rows, and how many values each has."""
    raw = raw_lines(with_cents(table(spark, folder, "lineitem")), F.col("l_suppkey").cast("string").alias("SUPPLIER")).select(
        "*", F.concat("LINE_NUMBER", F.lit("-"), F.trim("ORDER_KEY")).alias("LINE_CODE"), F.lit("free text").alias("REMARK")
    )
    rows = apply_policy(prepare(raw, SHIPMENTS), SHIPMENTS, Pseudonyms(spark, KEY))
    listed = catalog(spark, "shipments", rows)
    names = [r.column_name for r in listed.collect()]
    counted = rows.agg(*[F.count(name).alias(name) for name in names])
    long = counted.unpivot([], names, "column_name", "n")
    return listed.join(long, "column_name").select("column_name", "category", "action", "n")


def published_lake(spark, folder) -> Lake:
    """Marts of the given tables in a lake, then forecast, allocation and publishing by the monthly job's own steps."""
    lake = Lake(scratch_folder(spark, "months"))
    known = areas(spark, folder).withColumn("population", F.col("households") * 3)
    units, deficit = units_and_deficit(spark, folder)
    precarious = indicators(spark, folder)
    write_version(known, lake.path("silver", "dim_municipality"))
    write_version(deficit, lake.path("silver", "fjp_deficit"))
    write_version(precarious, lake.path("gold", "municipality_precariousness"))
    precarious = read_table(spark, lake.path("gold", "municipality_precariousness"))
    write_version(marts.service_gap(precarious, units, deficit, known), lake.path("gold", "service_gap"))
    costs = {r.r_name: 175000 for r in table(spark, folder, "region").select("r_name").collect()}
    parameters = Parameters(budget=1e8, unit_costs=costs)
    forecast_and_allocate(spark, lake, "run", parameters, TreeSettings(iterations=3))
    for run in ("run", "again"):
        publish_profiles(spark, lake, run, lake.path("gold", "profiles"), parameters)
    return lake


@query(f"""
SELECT municipality_code, municipality_name, region, true AS has_forecast, municipality_code IN (SELECT s_nationkey FROM supplier) AS has_index, true AS within_capacity,
       true AS within_budget, 175000.0::DOUBLE AS unit_cost
FROM ({AREAS_SQL})
""")
def allocation_step(spark, folder):
    """Every area with its forecast, the index it is ranked by, and an allocation within capacity and budget."""
    lake = published_lake(spark, folder)
    allocated = read_table(spark, lake.path("gold", "unit_allocation"))
    spent = allocated.agg(F.sum("investment")).scalar()
    return allocated.select(
        "municipality_code",
        "municipality_name",
        "region",
        F.col("deficit_forecast_units").isNotNull().alias("has_forecast"),
        F.col("precariousness_index").isNotNull().alias("has_index"),
        F.col("allocated_units").between(0, F.col("capacity")).alias("within_capacity"),
        (spent <= 1e8).alias("within_budget"),
        "unit_cost",
    )


@query("""
SELECT run_id, CASE run_id WHEN 'run' THEN n ELSE 0 END AS rows_inserted, 0 AS rows_updated, n AS rows_out
FROM (SELECT count(DISTINCT s_nationkey) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag <> 'R'),
     (VALUES ('run'), ('again')) r(run_id)
""")
def publish_step(spark, folder):
    """The publish step's log: all profiles are new at first, none has changed the second time."""
    runs = with_details(read_runs(spark, published_lake(spark, folder))).where("stage = 'publishing'")
    return runs.select("run_id", "rows_inserted", "rows_updated", "rows_out")
