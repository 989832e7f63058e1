"""Quality rules, existence and repeat flags, merges and the silver load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.cleaning import KEY, TYPED_LINES_SQL, hmac_sql, raw_lines, with_cents
from bindings.files import write_inbox
from bindings.registry import query, table
from cartulary.functions.pseudonyms import Pseudonyms
from cartulary.operators.links import flag_exists, flag_repeats, newest_per_key
from cartulary.operators.merge import merge_counts, merge_rows, newer_version, upsert
from cartulary.operators.quality import WARNING, Rule, check
from cartulary.plans.audit import read_runs, with_details
from cartulary.plans.ingest import ingest
from cartulary.plans.lake import Lake, Parameters
from cartulary.plans.refine import Load, Lookup, located, refine
from cartulary.sources.layouts import Feed, Layout
from cartulary.sources.storage import read_partitioned, read_table, scratch_folder, stage, write_version

# -- rules --------------------------------------------------------------------------------


def line_rules() -> list[Rule]:
    tax = F.when(F.col("l_tax") > 0, F.col("l_tax"))  # null where untaxed: an unknown outcome fails
    return [
        Rule("quantity_small", F.col("l_quantity") <= 45, description="at most 45"),
        Rule("price_positive", F.col("l_extendedprice") >= 2000),
        Rule("flag_known", F.col("l_returnflag").isin("A", "N", "R")),
        Rule("returned_closed", ~((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))),
        Rule("taxed", tax <= 0.07, WARNING),
        Rule("discount_plausible", F.col("l_discount").between(0.01, 0.09), WARNING),
    ]


LINE_RULES_SQL = """
SELECT *,
       list_filter([CASE WHEN l_quantity <= 45 THEN NULL ELSE 'quantity_small' END,
                    CASE WHEN l_extendedprice >= 2000 THEN NULL ELSE 'price_positive' END,
                    CASE WHEN l_returnflag IN ('A', 'N', 'R') THEN NULL ELSE 'flag_known' END,
                    CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'O') THEN NULL ELSE 'returned_closed' END],
                   lambda x: x IS NOT NULL) AS failures,
       list_filter([CASE WHEN l_tax > 0 AND l_tax <= 0.07 THEN NULL ELSE 'taxed' END,
                    CASE WHEN l_discount >= 0.01 AND l_discount <= 0.09 THEN NULL ELSE 'discount_plausible' END],
                   lambda x: x IS NOT NULL) AS warnings
FROM lineitem
"""


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(failures, ',') AS failures,
       array_to_string(warnings, ',') AS warnings
FROM ({LINE_RULES_SQL})
""")
def rule_failures(spark, folder):
    checked = check(table(spark, folder, "lineitem"), line_rules())
    return checked.rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.array_join("_failures", ",").alias("failures"),
        F.array_join("_warnings", ",").alias("warnings"),
    )


@query(f"""
SELECT rule, severity, n AS failures, total, n / total AS rate
FROM (SELECT r.rule, r.severity, count(*) FILTER (WHERE list_contains(l.failures, r.rule)
                                              OR list_contains(l.warnings, r.rule)) AS n, count(*) AS total
      FROM ({LINE_RULES_SQL}) l,
           (VALUES ('quantity_small', 'blocking'), ('price_positive', 'blocking'), ('flag_known', 'blocking'),
                   ('returned_closed', 'blocking'), ('taxed', 'warning'), ('discount_plausible', 'warning')
           ) r(rule, severity)
      GROUP BY ALL)
""")
def rule_metrics(spark, folder):
    return check(table(spark, folder, "lineitem"), line_rules()).metrics.drop("description")


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN len(failures) = 0 THEN 'valid' ELSE 'quarantine' END AS side
FROM ({LINE_RULES_SQL})
""")
def quarantine_split(spark, folder):
    """The flagged rows are staged once; each half reads its own directory."""
    flagged = check(table(spark, folder, "lineitem"), line_rules()).rows
    staged, _ = stage(flagged.withColumn("_rejected", F.size("_failures") > 0), "split", "_rejected")
    names = ("l_orderkey", "l_linenumber", "l_partkey")
    valid = staged.where("NOT _rejected").select(*names, F.lit("valid").alias("side"))
    return valid.unionByName(staged.where("_rejected").select(*names, F.lit("quarantine").alias("side")))


@query(f"""
WITH flagged AS ({LINE_RULES_SQL}),
counted AS (SELECT count(*) AS total, count(*) FILTER (WHERE len(failures) > 0) AS rejected FROM flagged),
ranked AS (SELECT rule, count(*) AS n FROM (SELECT unnest(failures) AS rule FROM flagged) GROUP BY rule
           ORDER BY n DESC, rule LIMIT 3)
SELECT total, rejected, rejected / total AS rejection_rate, rejected / total > 0.05 AS tripped,
       (SELECT string_agg(rule || '=' || n, ',' ORDER BY n DESC, rule) FROM ranked) AS worst
FROM counted
""")
def circuit_breaker(spark, folder):
    summary = check(table(spark, folder, "lineitem"), line_rules()).summary
    return summary.withColumn("tripped", F.col("rejection_rate") > 0.05).withColumn("worst", F.array_join("worst", ","))


@query(f"""
SELECT rule, count(*) AS failures FROM (SELECT unnest(failures) AS rule FROM ({LINE_RULES_SQL}))
GROUP BY rule ORDER BY failures DESC, rule LIMIT 3
""")
def top_rules(spark, folder):
    metrics = check(table(spark, folder, "lineitem"), line_rules()).metrics
    failing = metrics.where((F.col("severity") == "blocking") & (F.col("failures") > 0))
    return failing.select("rule", "failures").orderBy(F.col("failures").desc(), "rule").limit(3)


# -- links --------------------------------------------------------------------------------


@query("""
SELECT c.c_custkey, c.c_name, o.o_custkey IS NOT NULL AS has_large_order
FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000) o
  ON o.o_custkey = c.c_custkey
""")
def exists_flag(spark, folder):
    large = table(spark, folder, "orders").where("o_totalprice > 400000")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    reference = large.select(F.col("o_custkey").alias("c_custkey"))
    return flag_exists(customers, reference, "c_custkey", "has_large_order")


REPEATS_SQL = """
SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY CAST(l_shipdate AS DATE) DESC NULLS LAST, digest) > 1 AS is_repeat
FROM (SELECT *, sha256(l_partkey || '|' || l_suppkey || '|' || CAST(l_quantity AS INTEGER) || '|'
                       || CAST(round(l_extendedprice * 100) AS BIGINT) || '|' || l_returnflag || '|'
                       || strftime(l_shipdate, '%Y-%m-%d')) AS digest FROM lineitem)
"""


def line_digest():
    return F.sha2(
        F.concat_ws(
            "|",
            F.col("l_partkey"),
            F.col("l_suppkey"),
            F.col("l_quantity").cast("int"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint"),
            F.col("l_returnflag"),
            F.date_format("l_shipdate", "yyyy-MM-dd"),
        ),
        256,
    )


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       CAST(l_shipdate AS DATE) AS ship_date, is_repeat FROM ({REPEATS_SQL})
""")
def duplicate_flag(spark, folder):
    lines = located(table(spark, folder, "lineitem")).withColumns(
        {"ship_date": F.col("l_shipdate").cast("date"), "_record_hash": line_digest()}
    )
    identity = ["_record_hash", "_file_key", "_row_number"]
    flagged = flag_repeats(lines, ["l_orderkey", "l_linenumber"], identity, "ship_date", "is_repeat")
    return flagged.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "ship_date", "is_repeat"
    )


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders)
WHERE n = 1
""")
def one_per_key(spark, folder):
    orders = table(spark, folder, "orders")
    return newest_per_key(
        orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus", "o_totalprice"]
    )


# -- merges -------------------------------------------------------------------------------


def state_of_customers(orders: DataFrame, start: str, end: str) -> DataFrame:
    """The latest order of each customer within a period, as a snapshot keyed by customer."""
    period = orders.where(f"o_orderdate >= DATE '{start}' AND o_orderdate < DATE '{end}'")
    newest = newest_per_key(
        period, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate", "o_orderstatus"]
    )
    # a pending order has no date yet, so its stored version is unknown
    version = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    return newest.select("o_custkey", "o_orderkey", version.alias("version"), "o_orderstatus")


STATE_SQL = """
SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS version, o_orderstatus
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
      FROM orders WHERE o_orderdate >= DATE '{0}' AND o_orderdate < DATE '{1}') WHERE n = 1
"""
STORED, INCOMING = ("0001-01-01", "1999-01-01"), ("1998-07-01", "9999-01-01")
MERGE_SQL = f"""
SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
       CASE WHEN t.o_custkey IS NULL THEN 'inserted'
            WHEN s.o_custkey IS NOT NULL AND (t.version IS NULL OR s.version > t.version) THEN 'updated'
            ELSE 'kept' END AS action,
       t.o_orderkey AS t_key, s.o_orderkey AS s_key, t.version AS t_version, s.version AS s_version,
       t.o_orderstatus AS t_status, s.o_orderstatus AS s_status
FROM ({STATE_SQL.format(*STORED)}) t FULL OUTER JOIN ({STATE_SQL.format(*INCOMING)}) s ON t.o_custkey = s.o_custkey
"""
MERGED_SQL = f"""
SELECT o_custkey, CASE WHEN action = 'kept' THEN t_key ELSE s_key END AS o_orderkey,
       CASE WHEN action = 'kept' THEN t_version ELSE s_version END AS version,
       CASE WHEN action = 'kept' THEN t_status ELSE s_status END AS o_orderstatus, action
FROM ({MERGE_SQL})
"""


def merged_states(spark, folder) -> DataFrame:
    orders = table(spark, folder, "orders")
    return merge_rows(
        state_of_customers(orders, *STORED),
        state_of_customers(orders, *INCOMING),
        "o_custkey",
        newer_version("version"),
    )


@query(MERGED_SQL)
def upsert_result(spark, folder):
    return merged_states(spark, folder).withColumnRenamed("_action", "action")


@query(f"""
SELECT count(*) FILTER (WHERE action = 'inserted') AS rows_inserted,
       count(*) FILTER (WHERE action = 'updated') AS rows_updated FROM ({MERGED_SQL})
""")
def upsert_counts(spark, folder):
    return merge_counts(merged_states(spark, folder))


@query(f"""
SELECT *, (SELECT count(*) FROM ({MERGED_SQL}) WHERE action = 'inserted') AS rows_inserted,
       (SELECT count(*) FROM ({MERGED_SQL}) WHERE action = 'updated') AS rows_updated
FROM (SELECT * EXCLUDE (action) FROM ({MERGED_SQL}))
""")
def upsert_table(spark, folder):
    """The same merge through a stored table: first version, upsert, read back."""
    orders = table(spark, folder, "orders")
    target = scratch_folder(spark, "states")
    upsert(state_of_customers(orders, *STORED), target, "o_custkey", newer_version("version"))
    counts = upsert(state_of_customers(orders, *INCOMING), target, "o_custkey", newer_version("version"))
    return read_table(spark, target).withColumns({name: F.lit(n).cast("bigint") for name, n in counts.items()})


# -- the load, end to end -----------------------------------------------------------------

SHIPMENTS = Layout.parse(
    "shipments",
    """
    ORDER_KEY    int   order_key    operational  keep
    LINE_NUMBER  int   line_number  operational  keep
    QUANTITY     int   quantity     operational  keep
    PRICE        dec   price        operational  keep
    SHIP_DATE    date  ship_date    operational  keep
    FLAG         str   flag         operational  keep
    SUPPLIER     int   supplier     operational  keep
    LINE_CODE    str   line_id      identifier   pseudonymize
    REMARK       str   -            identifier   drop
    """,
)


SHIPMENT_LOAD = Load(
    "shipments",
    "shipments",
    Feed(SHIPMENTS, "LINES_*.TXT"),
    """
    types_valid | warning | size(_invalid_types) = 0
    line_id_present | blocking | line_id IS NOT NULL
    unique_record | blocking | NOT _duplicate
    supplier_solvent | blocking | _supplier_exists
    quantity_read | blocking | quantity >= 0
    ship_date_valid | blocking | ship_date IS NOT NULL AND ship_date <= _reference_date
    flag_given | warning | flag IS NOT NULL
    """,
    lookups=(Lookup("_supplier_exists", "supplier", "solvent_suppliers"),),
    repeats=("line_id",),
    newest_by="ship_date",
    key="line_id",
    version="ship_date",
)


def loaded_shipments(spark, folder) -> Lake:
    """lineitem as text files of one snapshot, through ingest and the load step."""
    root = scratch_folder(spark, "shipments")
    lake = Lake(root)
    texts = raw_lines(with_cents(table(spark, folder, "lineitem")), F.col("l_suppkey").cast("string").alias("SUPPLIER")).select(
        "*", F.concat("LINE_NUMBER", F.lit("-"), F.trim("ORDER_KEY")).alias("LINE_CODE"), F.lit("free text").alias("REMARK")
    )
    write_inbox(texts.select(F.lit("01062001").alias("day"), F.concat_ws(";", *SHIPMENTS.names).alias(";".join(SHIPMENTS.names))), f"{root}/inbox", "LINES")
    ingest(spark, lake, "shipments", f"{root}/inbox", "run", feed=SHIPMENT_LOAD.feed)
    solvent = table(spark, folder, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").cast("int").alias("supplier"))
    write_version(solvent, lake.path("silver", "solvent_suppliers"))
    refine(spark, lake, "run", SHIPMENT_LOAD, Pseudonyms(spark, KEY), Parameters(max_rejection_rate=1.0))
    return lake


SHIPMENTS_SQL = f"""
WITH joined AS (
  SELECT *, l_suppkey AS supplier, {hmac_sql("ltrim(l_linenumber || '' || l_orderkey, '0')", "line_id")} AS line_id
  FROM ({TYPED_LINES_SQL})),
flagged AS (
  SELECT h.*, s.s_suppkey IS NOT NULL AS supplier_exists,
         row_number() OVER (PARTITION BY line_id ORDER BY ship_date DESC NULLS LAST, digest) > 1 AS repeated
  FROM joined h LEFT JOIN supplier s ON s.s_suppkey = h.supplier AND s.s_acctbal >= 0)
SELECT order_key, line_number, quantity, price, ship_date, flag, supplier, line_id,
       concat_ws(',', CASE WHEN repeated THEN 'unique_record' END,
                      CASE WHEN NOT supplier_exists THEN 'supplier_solvent' END,
                      CASE WHEN quantity IS NULL OR quantity < 0 THEN 'quantity_read' END,
                      CASE WHEN ship_date IS NULL OR ship_date > DATE '2001-06-01' THEN 'ship_date_valid' END) AS failures,
       concat_ws(',', CASE WHEN (quantity_text IS NOT NULL AND quantity IS NULL)
                             OR (ship_date_text IS NOT NULL AND ship_date IS NULL) THEN 'types_valid' END,
                      CASE WHEN flag IS NULL THEN 'flag_given' END) AS warnings
FROM flagged
"""


@query(SHIPMENTS_SQL)
def silver_load(spark, folder):
    """The published rows and the quarantined ones."""
    lake = loaded_shipments(spark, folder)
    names = [f.target for f in SHIPMENTS.fields if f.action != "drop"]
    warnings = F.array_join("_warnings", ",").alias("warnings")
    published = read_table(spark, lake.path("silver", "shipments")).select(*names, F.lit("").alias("failures"), warnings)
    rejected = read_partitioned(spark, lake.path("quarantine", "shipments"))
    return published.unionByName(rejected.select(*names, F.array_join("_failures", ",").alias("failures"), warnings))


@query(f"""
SELECT flag, count(*) AS n_rows, count(*) FILTER (WHERE failures = '') AS n_valid,
       sum(price) FILTER (WHERE failures = '') AS valid_price,
       count(DISTINCT line_id) FILTER (WHERE failures = '') AS n_lines
FROM ({SHIPMENTS_SQL}) GROUP BY flag
""")
def silver_publish(spark, folder):
    """What the load published, from the keyed table, beside all rows of the flag, quarantined ones too."""
    lake = loaded_shipments(spark, folder)
    stored = read_table(spark, lake.path("silver", "shipments"))
    # half as wide as the text, and as distinct
    valid = stored.groupBy("flag").agg(
        F.count(F.lit(1)).alias("n_valid"), F.sum("price").alias("valid_price"), F.countDistinct(F.unhex("line_id")).alias("n_lines")
    )
    rejected = read_partitioned(spark, lake.path("quarantine", "shipments")).select("flag")
    totals = stored.select("flag").unionByName(rejected).groupBy("flag").agg(F.count(F.lit(1)).alias("n_rows"))
    joined = totals.alias("t").join(valid.alias("v"), F.expr("t.flag <=> v.flag"), "left")
    return joined.selectExpr(
        "t.flag AS flag", "n_rows", "coalesce(n_valid, 0) AS n_valid", "valid_price", "coalesce(n_lines, 0) AS n_lines"
    )


@query(f"""
SELECT r.rule, r.severity, count(*) FILTER (WHERE list_contains(string_split(failures || ',' || warnings, ','), r.rule)) AS failures,
       count(*) AS total, DATE '2001-06-01' AS reference_date
FROM ({SHIPMENTS_SQL}), (VALUES ('types_valid', 'warning'), ('line_id_present', 'blocking'), ('unique_record', 'blocking'),
  ('supplier_solvent', 'blocking'), ('quantity_read', 'blocking'), ('ship_date_valid', 'blocking'), ('flag_given', 'warning')) r(rule, severity)
GROUP BY ALL
""")
def quality_log(spark, folder):
    """The load's entries in the quality log, one for each rule."""
    log = read_partitioned(spark, loaded_shipments(spark, folder).path("audit", "quality"))
    return log.select("rule", "severity", "failures", "total", "reference_date")


@query(f"""
SELECT 'silver' AS stage, 'success' AS status, count(*) AS rows_in, count(*) FILTER (WHERE failures = '') AS rows_out,
       count(*) FILTER (WHERE failures <> '') AS rows_quarantined, count(*) FILTER (WHERE failures = '') AS rows_inserted
FROM ({SHIPMENTS_SQL})
""")
def load_step(spark, folder):
    """The load's own entry in the run log, details read back."""
    runs = with_details(read_runs(spark, loaded_shipments(spark, folder))).where("stage = 'silver'")
    return runs.select("stage", "status", "rows_in", "rows_out", "rows_quarantined", "rows_inserted")
