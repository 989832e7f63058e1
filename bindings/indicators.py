"""Household classification, area indicators, crosswalk, gap, disclosure and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.cleaning import BANDS, KEY, hmac_sql
from bindings.registry import query, table
from cartulary.functions.measures import per_head
from cartulary.functions.pseudonyms import Pseudonyms
from cartulary.operators.disclosure import leak_scan, suppress_small_cells
from cartulary.plans import marts
from cartulary.plans.households import COMPONENTS, INADEQUACIES, classify
from cartulary.plans.profiles import CELLS, build_profiles, profiles_with_suppression, publish
from cartulary.sources.storage import scratch_folder, stage

# -- households ---------------------------------------------------------------------------

# What each household column is read from: the same text serves Spark and the oracle.
HOUSEHOLD = {
    "registry_status": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 3 END",
    "wall_material": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INT) % 30 END",
    "dwelling_kind": "CASE WHEN l_discount > 0.09 THEN 2 ELSE 1 END",
    "families_in_dwelling": "CASE WHEN l_tax > 0.07 THEN 2 ELSE 1 END",
    "expense_rent": "CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS INT) * 40 END",
    "total_income": "CASE WHEN l_linenumber = 6 THEN NULL ELSE CAST(floor(l_extendedprice) AS INT) END",
    "people_in_dwelling": "CAST(l_quantity AS INT)",
    "bedrooms": "l_linenumber",
    "piped_water": "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_linenumber END",
    "has_bathroom": "CASE WHEN l_discount > 0.07 THEN 2 ELSE 1 END",
    "sewage_disposal": "l_linenumber",
    "garbage_disposal": "CAST(l_quantity AS INT) % 9",
    "lighting": "CAST(l_quantity AS INT) % 17",
    "floor_material": "CASE WHEN l_tax < 0.01 THEN 1 ELSE 2 END",
}


def households(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_shipdate",
        *[F.expr(text).alias(name) for name, text in HOUSEHOLD.items()],
    )


HOUSEHOLDS_SQL = "SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, {} FROM lineitem".format(
    ", ".join(f"{text} AS {name}" for name, text in HOUSEHOLD.items())
)
CLASSIFIED_SQL = f"""
SELECT *,
  CASE WHEN coalesce(wall_material BETWEEN 5 AND 8, false) OR dwelling_kind = 2 THEN 'precarious_housing'
       WHEN families_in_dwelling > 1 THEN 'cohabitation'
       WHEN coalesce(expense_rent, 0) > 0 AND coalesce(expense_rent, 0) > 0.3::DOUBLE * coalesce(total_income, 0)
       THEN 'rent_burden'
       WHEN coalesce(expense_rent, 0) > 0 AND people_in_dwelling / greatest(bedrooms, 1) > 3
       THEN 'rented_overcrowding' END AS deficit_component,
  coalesce(piped_water = 2, false) AS no_piped_water,
  coalesce(has_bathroom = 2, false) AS no_bathroom,
  coalesce(sewage_disposal BETWEEN 3 AND 6, false) AS inadequate_sewage,
  coalesce(garbage_disposal BETWEEN 3 AND 6, false) AS inadequate_garbage,
  coalesce(lighting BETWEEN 4 AND 6, false) AS no_electricity,
  coalesce(floor_material = 1, false) AS dirt_floor
FROM ({HOUSEHOLDS_SQL})
"""


@query(f"SELECT l_orderkey, l_linenumber, deficit_component, {', '.join(INADEQUACIES)} FROM ({CLASSIFIED_SQL})")
def household_components(spark, folder):
    return classify(households(table(spark, folder, "lineitem"))).select(
        "l_orderkey", "l_linenumber", "deficit_component", *INADEQUACIES
    )


# -- indicators ---------------------------------------------------------------------------


def areas(spark, folder) -> DataFrame:
    """Nations as municipalities, and regions as areas that nothing is known of."""
    regions = table(spark, folder, "region")
    nations = table(spark, folder, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    empty = regions.select(
        (F.col("r_regionkey") + 100).alias("municipality_code"),
        F.concat("r_name", F.lit(" (rest)")).alias("municipality_name"),
        F.lit("S0").alias("state"),
        F.col("r_name").alias("region"),
        F.lit(0).alias("households"),
    )
    known = nations.select(
        F.col("n_nationkey").alias("municipality_code"),
        F.col("n_name").alias("municipality_name"),
        F.concat(F.lit("S"), F.col("n_nationkey") % 8).alias("state"),
        F.col("r_name").alias("region"),
        (F.col("n_nationkey") * 40 + 300).alias("households"),
    )
    return known.unionByName(empty)


AREAS_SQL = """
SELECT n_nationkey AS municipality_code, n_name AS municipality_name, 'S' || (n_nationkey % 8) AS state,
       r_name AS region, n_nationkey * 40 + 300 AS households
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey
UNION ALL SELECT r_regionkey + 100, r_name || ' (rest)', 'S0', r_name, 0 FROM region
"""


def families(spark, folder) -> DataFrame:
    """Every line as a family, in the nation of its supplier."""
    nations = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("municipality_code"))
    homes = households(table(spark, folder, "lineitem"))
    located = homes.join(nations, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    income = per_head(F.col("total_income").cast("decimal(14,2)"), F.col("people_in_dwelling"))
    return located.withColumns(
        {"per_capita_income": income, "_reference_date": F.col("l_shipdate").cast("date")}
    )


KINDS = (*COMPONENTS, *INADEQUACIES)
_n = {
    **{c: f"count(*) FILTER (WHERE deficit_component = '{c}')" for c in COMPONENTS},
    **{i: f"count(*) FILTER (WHERE {i})" for i in INADEQUACIES},
}
INDICATORS_SQL = f"""
WITH counted AS (
  SELECT s_nationkey AS municipality_code, count(*) AS n_families, count(deficit_component) AS n_families_deficit,
         {', '.join(f'{text} AS n_{kind}' for kind, text in _n.items())},
         CAST(quantile_disc(round(CAST(total_income AS DOUBLE) / greatest(people_in_dwelling, 1), 2), 0.5) AS DOUBLE)
           AS median_per_capita_income,
         CAST(max(l_shipdate) AS DATE) AS reference_date
  FROM ({CLASSIFIED_SQL}) LEFT JOIN supplier ON s_suppkey = l_suppkey
  WHERE registry_status = 3 GROUP BY s_nationkey),
rated AS (
  SELECT *, CASE WHEN n_families > 0 THEN round(n_families_deficit / n_families, 4) END AS deficit_rate,
         {', '.join(f'CASE WHEN n_families > 0 THEN round(n_{k} / n_families, 4) END AS {k}_rate' for k in KINDS)}
  FROM counted)
SELECT r.*, CAST(round(CAST(CAST(100 * (0.5::DOUBLE * deficit_rate
                  + 0.5::DOUBLE * ((0::DOUBLE + {' + '.join(f'{i}_rate' for i in INADEQUACIES)}) / 6)) AS VARCHAR)
                  AS DECIMAL(30,18)), 2) AS DOUBLE)
              AS precariousness_index,
       municipality_name, state, region
FROM rated r LEFT JOIN ({AREAS_SQL}) a ON a.municipality_code = r.municipality_code
"""


def indicators(spark, folder) -> DataFrame:
    return marts.precariousness(families(spark, folder), areas(spark, folder))


@query(INDICATORS_SQL)
def area_indicators(spark, folder):
    return indicators(spark, folder)


# -- contracts ----------------------------------------------------------------------------


#: For the review list a family is the greatest value of each of these over all lines of an order.
LINE_COLUMNS = ("l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def contract_tables(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events as contracts, orders as persons, every line of an order as a row of its family."""
    pseudonyms = Pseudonyms(spark, KEY)
    person = lambda name: pseudonyms.of(F.col(name).cast("string"), "cpf")
    contracts = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", person("user_id")).alias("cpf_pseudo"),
        F.upper("event_type").alias("program"),
        F.get_json_object("props", "$.k").cast("int").alias("municipality_code"),
        F.col("ts").cast("date").alias("contract_date"),
        (F.floor(F.col("value") * 300).cast("bigint")).alias("declared_income"),
        (F.floor(F.col("value") / 20) + 1).cast("int").alias("income_band"),
    )
    persons = table(spark, folder, "orders").select(
        person("o_custkey").alias("cpf_pseudo"),
        F.col("o_orderkey").alias("family_id"),
        F.col("o_orderkey").alias("person_id"),
        F.col("o_orderdate").cast("date").alias("_reference_date"),
    )
    return contracts, persons, table(spark, folder, "lineitem")


CONTRACTS_SQL = f"""
SELECT event_id, CASE WHEN event_type <> 'error' THEN {hmac_sql('CAST(user_id AS VARCHAR)', 'cpf')} END AS cpf_pseudo,
       upper(event_type) AS program, CAST(json_extract_string(props, '$.k') AS INTEGER) AS municipality_code,
       CAST(ts AS DATE) AS contract_date, CAST(floor(value * 300) AS BIGINT) AS declared_income,
       CAST(floor(value / 20) + 1 AS INTEGER) AS income_band
FROM events
"""
_places = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(COMPONENTS))
_components = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(COMPONENTS))
#: The family of an order from all its lines, each classified.
FAMILIES_SQL = f"""
  SELECT l_orderkey AS family_id, max(total_income) AS cadunico_income,
         CASE min(CASE deficit_component {_places} END) {_components} END AS deficit_component
  FROM ({CLASSIFIED_SQL}) GROUP BY l_orderkey
"""
#: The family of an order as one row of greatest values.
GREATEST_SQL = f"""
  SELECT l_orderkey AS family_id, total_income AS cadunico_income, deficit_component
  FROM (SELECT * FROM ({CLASSIFIED_SQL.replace('FROM lineitem', f"FROM (SELECT l_orderkey, {', '.join(f'max({c}) AS {c}' for c in LINE_COLUMNS)} FROM lineitem GROUP BY l_orderkey) AS lineitem")}))
"""


def crossed_sql(homes: str) -> str:
    return f"""
WITH contracts AS ({CONTRACTS_SQL}),
persons AS (
  SELECT {hmac_sql('CAST(o_custkey AS VARCHAR)', 'cpf')} AS cpf_pseudo, o_orderkey AS family_id
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS n
        FROM orders) WHERE n = 1),
homes AS ({homes}),
held AS (SELECT cpf_pseudo, count(*) AS contracts_per_cpf, count(DISTINCT program) AS programs_per_cpf
         FROM contracts WHERE cpf_pseudo IS NOT NULL GROUP BY cpf_pseudo),
ceilings AS (SELECT * FROM (VALUES (1, 2850), (2, 4700), (3, 8600), (4, 12000)) c(income_band, ceiling))
SELECT c.*, p.family_id, h.cadunico_income, h.deficit_component, k.contracts_per_cpf, k.programs_per_cpf,
       p.family_id IS NOT NULL AS in_cadunico,
       coalesce(c.declared_income > ceiling, false) AS declared_income_above_band,
       coalesce(h.cadunico_income > ceiling, false) AS cadunico_income_above_band,
       k.contracts_per_cpf > 1 AS multiple_contracts,
       h.deficit_component IS NOT NULL AS family_in_deficit
FROM contracts c LEFT JOIN persons p ON p.cpf_pseudo = c.cpf_pseudo
     LEFT JOIN homes h ON h.family_id = p.family_id
     LEFT JOIN held k ON k.cpf_pseudo = c.cpf_pseudo
     LEFT JOIN ceilings b ON b.income_band = c.income_band
"""


CROSSED_SQL = crossed_sql(FAMILIES_SQL)


def crossed(spark, folder) -> DataFrame:
    contracts, persons, lines = contract_tables(spark, folder)
    return marts.crosswalk(contracts, persons, households(lines).withColumnRenamed("l_orderkey", "family_id"), BANDS)


@query(CROSSED_SQL)
def contract_crosswalk(spark, folder):
    return crossed(spark, folder)


@query(f"""
WITH counted AS (
  SELECT program, municipality_code, count(*) AS n_contracts,
         {', '.join(f'count(*) FILTER (WHERE {flag}) AS n_{flag}' for flag in marts.FLAGS)}
  FROM ({CROSSED_SQL}) GROUP BY program, municipality_code)
SELECT *, {', '.join(f'CASE WHEN n_contracts > 0 THEN round(n_{f} / n_contracts, 4) END AS {f}_rate'
                     for f in marts.RATED)}
FROM counted
""")
def targeting(spark, folder):
    return marts.targeting(crossed(spark, folder))


@query(f"""
SELECT * FROM (
  SELECT cpf_pseudo, program, municipality_code, contract_date, income_band, declared_income, cadunico_income,
         contracts_per_cpf,
         concat_ws(',', CASE WHEN declared_income_above_band THEN 'declared_income_above_band' END,
                        CASE WHEN cadunico_income_above_band THEN 'cadunico_income_above_band' END,
                        CASE WHEN multiple_contracts THEN 'multiple_contracts' END) AS reasons
  FROM ({crossed_sql(GREATEST_SQL)})) WHERE reasons <> ''
""")
def review_flags(spark, folder):
    contracts, persons, lines = contract_tables(spark, folder)
    greatest = lines.groupBy("l_orderkey").agg(*[F.max(c).alias(c) for c in LINE_COLUMNS])
    families = households(greatest).withColumnRenamed("l_orderkey", "family_id")
    found = marts.review_flags(marts.crosswalk(contracts, persons, families, BANDS))
    return found.withColumn("reasons", F.array_join("reasons", ","))


# -- service gap --------------------------------------------------------------------------


def units_and_deficit(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Customers as contracted units, orders per nation and year as the official deficit."""
    customers = table(spark, folder, "customer")
    units = customers.select(F.col("c_nationkey").alias("municipality_code"))
    owners = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders").join(owners, F.col("o_custkey") == F.col("c_custkey"))
    deficit = orders.groupBy(
        F.col("c_nationkey").alias("municipality_code"), F.year("o_orderdate").alias("year")
    ).agg(F.count(F.lit(1)).alias("deficit_total"))
    return units, deficit


GAP_SQL = f"""
WITH deficit AS (SELECT c_nationkey AS code, year(o_orderdate) AS yr, count(*) AS total
                 FROM orders JOIN customer ON c_custkey = o_custkey
                 GROUP BY ALL),
units AS (SELECT c_nationkey AS code, count(*) AS n FROM customer GROUP BY ALL),
joined AS (
  SELECT a.*, coalesce(p.n_families, 0) AS n_families, coalesce(p.n_families_deficit, 0) AS n_families_deficit,
         coalesce(u.n, 0) AS n_units_contracted, d.total AS fjp_deficit, d.yr AS fjp_year
  FROM ({AREAS_SQL}) a LEFT JOIN ({INDICATORS_SQL}) p USING (municipality_code)
       LEFT JOIN units u ON u.code = a.municipality_code
       LEFT JOIN deficit d ON d.code = a.municipality_code AND d.yr = (SELECT max(yr) FROM deficit))
SELECT *, greatest(n_families_deficit - n_units_contracted, 0) AS gap_cadunico,
       greatest(fjp_deficit - n_units_contracted, 0) AS gap_fjp,
       CASE WHEN n_families_deficit > 0 THEN round(n_units_contracted / n_families_deficit, 4) END AS coverage_cadunico,
       CASE WHEN fjp_deficit > 0 THEN round(n_units_contracted / fjp_deficit, 4) END AS coverage_fjp
FROM joined
""".replace("SELECT a.*, coalesce", "SELECT a.municipality_code, a.municipality_name, a.state, a.region, a.households, coalesce")


def gap(spark, folder) -> DataFrame:
    return marts.service_gap(
        indicators(spark, folder), *units_and_deficit(spark, folder), areas(spark, folder)
    )


@query(GAP_SQL)
def service_gap(spark, folder):
    return gap(spark, folder)


# -- disclosure ---------------------------------------------------------------------------

SEGMENT_CELLS = {"n_negative": ["negative_rate"], "n_rich": ["rich_rate", "top_balance"]}


@query("""
WITH cells AS (
  SELECT c_nationkey, c_mktsegment, count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0) AS n_negative,
         count(*) FILTER (WHERE c_acctbal > 7500) AS n_rich, max(c_acctbal) AS top_balance
  FROM customer GROUP BY ALL)
SELECT c_nationkey, c_mktsegment, n,
       CASE WHEN n_negative BETWEEN 1 AND 2 THEN NULL ELSE n_negative END AS n_negative,
       CASE WHEN n_rich BETWEEN 1 AND 2 THEN NULL ELSE n_rich END AS n_rich,
       CASE WHEN n_rich BETWEEN 1 AND 2 THEN NULL ELSE top_balance END AS top_balance,
       CASE WHEN n_negative BETWEEN 1 AND 2 THEN NULL ELSE round(n_negative / n, 4) END AS negative_rate,
       CASE WHEN n_rich BETWEEN 1 AND 2 THEN NULL ELSE round(n_rich / n, 4) END AS rich_rate,
       concat_ws(',', CASE WHEN n_negative BETWEEN 1 AND 2 THEN 'n_negative,negative_rate' END,
                      CASE WHEN n_rich BETWEEN 1 AND 2 THEN 'n_rich,rich_rate,top_balance' END) AS suppressed
FROM cells
""")
def suppress_cells(spark, folder):
    cells = table(spark, folder, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("c_acctbal") < 0).alias("n_negative"),
        F.count_if(F.col("c_acctbal") > 7500).alias("n_rich"),
        F.max("c_acctbal").alias("top_balance"),
    )
    rated = cells.withColumns(
        {
            "negative_rate": F.round(F.col("n_negative") / F.col("n"), 4),
            "rich_rate": F.round(F.col("n_rich") / F.col("n"), 4),
        }
    )
    hidden = suppress_small_cells(rated, SEGMENT_CELLS, 3)
    return hidden.withColumn("suppressed", F.array_join("suppressed_fields", ",")).drop("suppressed_fields")


MASK_SQL = "lpad(CAST(c_custkey * 7919 % 100000000000 AS VARCHAR), 11, '3')"


@query(f"""
WITH published AS (
  SELECT {hmac_sql('c_name', 'name')} AS person, c_mktsegment AS segment,
         CASE c_mktsegment WHEN 'BUILDING' THEN c_name
              WHEN 'MACHINERY' THEN substr({MASK_SQL}, 1, 3) || '.' || substr({MASK_SQL}, 4, 3) || '.'
                                    || substr({MASK_SQL}, 7, 3) || '-' || substr({MASK_SQL}, 10, 2)
              ELSE 'see ' || c_name END AS remark
  FROM customer),
long AS (SELECT 'person' AS column_name, person AS value FROM published
         UNION ALL SELECT 'segment', segment FROM published UNION ALL SELECT 'remark', remark FROM published)
SELECT column_name, 'known_identifier' AS reason, count(*) AS n_rows, count(DISTINCT value) AS n_values
FROM long WHERE value IN (SELECT c_name FROM customer) GROUP BY ALL
UNION ALL
SELECT column_name, 'document_shape', count(*), count(DISTINCT value)
FROM long WHERE regexp_full_match(value, '[0-9]{{3}}\\.?[0-9]{{3}}\\.?[0-9]{{3}}-?[0-9]{{2}}') GROUP BY ALL
""")
def leaks(spark, folder):
    customers = table(spark, folder, "customer").withColumn(
        "m", F.expr("lpad(CAST(c_custkey * 7919 % 100000000000 AS STRING), 11, '3')")
    )
    masked = F.expr("concat(substr(m, 1, 3), '.', substr(m, 4, 3), '.', substr(m, 7, 3), '-', substr(m, 10, 2))")
    remark = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name"))
        .when(F.col("c_mktsegment") == "MACHINERY", masked)
        .otherwise(F.concat(F.lit("see "), F.col("c_name")))
    )
    published = customers.select(
        Pseudonyms(spark, KEY).of(F.col("c_name"), "name").alias("person"),
        F.col("c_mktsegment").alias("segment"),
        remark.alias("remark"),
    )
    return leak_scan(published, customers.select("c_name"))


# -- profiles -----------------------------------------------------------------------------


def side_tables(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Stand-ins with the columns of forecast and allocation, from customers per nation."""
    grouped = table(spark, folder, "customer").groupBy(
        F.col("c_nationkey").alias("municipality_code")
    ).agg(F.count(F.lit(1)).alias("n"))
    predictions = grouped.select(
        "municipality_code",
        (F.col("n") / 1000).alias("relative_deficit_forecast"),
        (F.col("n") * 2.0).alias("deficit_forecast_units"),
    )
    allocated = grouped.select(
        "municipality_code", F.col("n").alias("allocated_units"), (F.col("n") * 150000.0).alias("investment")
    )
    return predictions, allocated


def profiles(spark, folder, minimum: int) -> DataFrame:
    precarious, _ = stage(indicators(spark, folder), "indicators")
    service = marts.service_gap(precarious, *units_and_deficit(spark, folder), areas(spark, folder))
    day = F.expr("TIMESTAMP '2026-09-11 00:00:00'")
    return build_profiles(precarious, service, *side_tables(spark, folder), minimum, day)


MINIMUM = 150
_hidden = {
    field: f"(p.n_{kind} BETWEEN 1 AND {MINIMUM - 1})" for kind in KINDS for field in (f"n_{kind}", f"{kind}_rate")
}
_hidden |= {
    f: f"(p.n_families BETWEEN 1 AND {MINIMUM - 1})" for f in ("n_families", "median_per_capita_income")
}
_hidden |= {
    f: f"(p.n_families_deficit BETWEEN 1 AND {MINIMUM - 1})" for f in ("n_families_deficit", "deficit_rate")
}
_suppressed_list = ", ".join(
    f"CASE WHEN {_hidden[count]} THEN '{','.join([count, *derived])}' END" for count, derived in CELLS.items()
)
SHOWN = [
    "n_families",
    "median_per_capita_income",
    "n_families_deficit",
    "deficit_rate",
    *(f"n_{c}" for c in COMPONENTS),
    *(f"{i}_rate" for i in INADEQUACIES),
]


def _shown(name: str) -> str:
    return f"CASE WHEN {_hidden[name]} THEN NULL ELSE p.{name} END"


PROFILES_SQL = f"""
WITH p AS ({INDICATORS_SQL}), g AS ({GAP_SQL}),
c AS (SELECT c_nationkey AS code, count(*) AS n FROM customer GROUP BY ALL)
SELECT p.municipality_code AS id, p.municipality_name AS name, p.state, p.region,
       strftime(p.reference_date, '%Y-%m-%d') AS reference_date,
       {', '.join(f'{_shown(f)} AS {f}' for f in SHOWN)},
       p.precariousness_index, g.n_units_contracted AS units_contracted, g.fjp_deficit, g.coverage_fjp AS fjp_coverage,
       c.n / 1000 AS relative_deficit, c.n * 2.0::DOUBLE AS deficit_units,
       c.n AS units,
       c.n * 150000.0::DOUBLE AS investment,
       concat_ws(',', {_suppressed_list}) AS suppressed
FROM p LEFT JOIN g ON g.municipality_code = p.municipality_code LEFT JOIN c ON c.code = p.municipality_code
"""


@query(PROFILES_SQL)
def profile_rows(spark, folder):
    nested = profiles(spark, folder, MINIMUM)
    return nested.select(
        F.col("_id").alias("id"),
        "municipality.name",
        "municipality.state",
        "municipality.region",
        "reference_date",
        F.col("cadunico.families").alias("n_families"),
        "cadunico.median_per_capita_income",
        F.col("cadunico.families_in_deficit").alias("n_families_deficit"),
        "cadunico.deficit_rate",
        *[F.col(f"cadunico.deficit_components.{c}").alias(f"n_{c}") for c in COMPONENTS],
        *[F.col(f"cadunico.inadequacies.{i}").alias(f"{i}_rate") for i in INADEQUACIES],
        "cadunico.precariousness_index",
        "service.*",
        "forecast.*",
        "allocation.*",
        F.array_join("disclosure_control.suppressed_fields", ",").alias("suppressed"),
    )


@query(f"""
SELECT count(*) AS profiles, count(*) FILTER (WHERE suppressed <> '') AS profiles_with_suppression
FROM ({PROFILES_SQL})
""")
def profile_summary(spark, folder):
    return profiles_with_suppression(profiles(spark, folder, MINIMUM))


@query(f"""
WITH p AS ({PROFILES_SQL})
SELECT 1 AS load, count(*) FILTER (WHERE suppressed = '') AS inserted, 0 AS updated FROM p
UNION ALL SELECT 2, count(*) FILTER (WHERE suppressed <> ''), 0 FROM p
UNION ALL SELECT 3, 0, count(*) FILTER (WHERE units IS NOT NULL) FROM p
""")
def profile_publish(spark, folder):
    """Published three times: some profiles, all of them, and with changed allocations."""
    target = scratch_folder(spark, "profiles")
    built, _ = stage(profiles(spark, folder, MINIMUM), "profiles")
    changed = built.withColumn(
        "allocation", F.col("allocation").withField("units", F.col("allocation.units") + 1)
    ).withColumn("updated_at", F.current_timestamp())
    loads = (built.where("size(disclosure_control.suppressed_fields) = 0"), built, changed)
    counts = [(n, *publish(load, target).values()) for n, load in enumerate(loads, 1)]
    rows = [f"SELECT {n} AS load, {i}L AS inserted, {u}L AS updated" for n, i, u in counts]
    return spark.sql(" UNION ALL ".join(rows))
