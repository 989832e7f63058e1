"""Ingest, partitioned tables, snapshots, audit log and freshness."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.files import write_inbox
from bindings.registry import query, table
from cartulary.plans.audit import freshness, latest_loads, noted_changes, read_runs, run_report, volume_changes
from cartulary.plans.ingest import apply_retention, ingest, load_counts
from cartulary.plans.lake import Lake
from cartulary.plans.refine import Load, pending_snapshots, refine
from cartulary.sources.delimited import arrivals, header_verdict, first_lines
from cartulary.sources.layouts import Feed, Layout
from cartulary.sources.storage import (
    append,
    read_partitioned,
    read_table,
    replace_partition,
    replace_partitions,
    scratch_folder,
)
from cartulary.streaming.arrivals import load_arrivals

ORDERS = Layout.parse(
    "orders",
    """
    O_ORDERKEY     int   order_key    operational  keep
    O_CUSTKEY      int   customer     operational  keep
    O_ORDERSTATUS  str   status       operational  keep
    O_CENTS        int   cents        operational  keep
    O_ORDERDATE    date  order_date   operational  keep
    """,
)
FEED = Feed(ORDERS, "ORDERS_*.TXT", encoding="ISO-8859-1")


def export_orders(spark: SparkSession, folder: str, short_rows: bool = False) -> str:
    """All orders as `;` text, one snapshot per month, in dated files.

    With `short_rows` the pending orders lack their last field. Rows are ranged by month and
    key, so a large month is split over several files of the same date.
    """
    short = F.col("o_orderstatus") == "P" if short_rows else F.lit(False)
    fields = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), cents(), iso_day()]
    line = F.when(short, F.concat_ws(";", *fields[:-1])).otherwise(F.concat_ws(";", *fields))
    root = scratch_folder(spark, "inbox")
    month = F.date_format(F.trunc("o_orderdate", "month"), "ddMMyyyy").alias("day")
    lines = table(spark, folder, "orders").select(month, "o_orderkey", line.alias(";".join(ORDERS.names)))
    write_inbox(lines.repartitionByRange("day", "o_orderkey").drop("o_orderkey"), f"{root}/inbox", "ORDERS")
    return root


def cents():
    return F.round(F.col("o_totalprice") * 100).cast("bigint")


def iso_day():
    return F.date_format("o_orderdate", "yyyy-MM-dd")


def load_orders(spark: SparkSession, root: str, run_id: str = "run") -> int:
    """Load the files of `root` that are not recorded as loaded; returns how many were read."""
    return ingest(spark, Lake(root), "orders", f"{root}/inbox", run_id, feed=FEED)


def bronze_orders(spark: SparkSession, root: str) -> DataFrame:
    return read_partitioned(spark, Lake(root).path("bronze", "orders"))


ORDERS_TEXT_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS o_cents,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot
FROM orders
"""


@query(f"""
SELECT *, sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_cents, o_orderdate)) AS digest
FROM ({ORDERS_TEXT_SQL})
""")
def ingest_idempotent(spark, folder):
    """Load all files, then load again: the second call finds nothing new."""
    root = export_orders(spark, folder)
    load_orders(spark, root)
    if load_orders(spark, root, "again"):
        raise AssertionError("a loaded file was seen as new")
    return bronze_orders(spark, root).select(
        *[F.col(name).alias(name.lower()) for name in ORDERS.names],
        F.col("_reference_date").alias("snapshot"),
        F.col("_record_hash").alias("digest"),
    )


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot, count(*) AS "rows",
       count(*) FILTER (WHERE o_orderstatus = 'P') AS corrupt_rows
FROM orders GROUP BY ALL
""")
def load_counts_by_snapshot(spark, folder):
    root = export_orders(spark, folder, short_rows=True)
    load_orders(spark, root)
    counted = load_counts(spark, Lake(root).path("bronze", "orders"))
    return counted.groupBy(F.col("_reference_date").alias("snapshot")).agg(
        F.sum("rows").alias("rows"), F.sum("corrupt_rows").alias("corrupt_rows")
    )


@query(ORDERS_TEXT_SQL)
def stream_arrivals(spark, folder):
    """The same files through a file stream, started twice on one checkpoint."""
    root = export_orders(spark, folder)
    for _ in range(2):
        load_arrivals(spark, f"{root}/inbox", FEED, f"{root}/bronze", f"{root}/checkpoint")
    return read_partitioned(spark, f"{root}/bronze").select(
        *[F.col(name).alias(name.lower()) for name in ORDERS.names], F.col("_reference_date").alias("snapshot")
    )


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot, 'ok' AS verdict FROM orders GROUP BY ALL
""")
def file_headers(spark, folder):
    root = export_orders(spark, folder)
    listed = arrivals(spark, f"{root}/inbox", FEED.pattern)
    verdicts = header_verdict(first_lines(spark, [r.path for r in listed.collect()]), ORDERS, ";")
    joined = listed.join(verdicts.select("path", "verdict"), "path")
    return joined.groupBy("snapshot").agg(F.array_join(F.array_sort(F.collect_set("verdict")), ",").alias("verdict"))


# -- partitioned tables -------------------------------------------------------------------


@query("""
SELECT o_orderstatus, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey + 1 ELSE o_custkey END AS o_custkey
FROM orders WHERE o_orderstatus <> 'P'
""")
def partition_overwrite(spark, folder):
    """Three partitions; one is replaced, one is replaced by nothing, one is left alone."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    target = scratch_folder(spark, "parted")
    replace_partitions(orders, target, "o_orderstatus", ["F", "O", "P"])
    changed = orders.where("o_orderstatus = 'F'").withColumn("o_custkey", F.col("o_custkey") + 1)
    replace_partition(changed, target, "o_orderstatus", "F")
    replace_partition(orders.where("o_orderkey IS NULL"), target, "o_orderstatus", "P")
    return read_partitioned(spark, target).select("o_orderstatus", "o_orderkey", "o_custkey")


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= DATE '1998-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def append_merge(spark, folder):
    orders = table(spark, folder, "orders")
    target = scratch_folder(spark, "appended")
    append(orders.where("o_orderdate < DATE '1998-01-01'").select("o_orderkey", "o_custkey"), target)
    append(
        orders.where("o_orderdate >= DATE '1998-01-01'").select("o_orderkey", "o_custkey", "o_orderpriority"), target
    )
    return read_partitioned(spark, target, merge_schema=True)


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot, count(*) AS n
FROM orders WHERE o_orderdate >= DATE '2000-02-01' GROUP BY ALL
""")
def retention_keep(spark, folder):
    """Snapshots older than 18 months before August 2001 are deleted, and so is their record."""
    root = export_orders(spark, folder)
    load_orders(spark, root)
    apply_retention(spark, Lake(root), "retention", 18, datetime.date(2001, 8, 1), {"orders": FEED})
    return bronze_orders(spark, root).groupBy(F.col("_reference_date").alias("snapshot")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH months AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot, count(*) AS n,
                       count(*) FILTER (WHERE o_orderstatus = 'P') AS bad FROM orders GROUP BY ALL),
changes AS (SELECT *, median(n) OVER (ORDER BY snapshot ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS base FROM months)
SELECT snapshot, n AS rows_in, bad AS corrupt_rows, round((n - base) / base, 4) AS volume_change, abs((n - base) / base) > 0.2 AS unusual
FROM changes WHERE base IS NOT NULL
""")
def noted_volume(spark, folder):
    """What each monthly load noted in the run log, read back from its JSON."""
    root = export_orders(spark, folder, short_rows=True)
    load_orders(spark, root)
    noted = noted_changes(read_runs(spark, Lake(root)))
    return noted.select(F.col("reference_date").alias("snapshot"), "rows_in", "corrupt_rows", "volume_change", "unusual")


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_date, 'success' AS status, count(*) AS rows_in, count(*) AS rows_out
FROM orders GROUP BY ALL
UNION ALL
SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE), 'skipped', NULL, NULL FROM orders
""")
def step_log(spark, folder):
    """The run log of a load and of the same load again."""
    root = export_orders(spark, folder)
    load_orders(spark, root)
    load_orders(spark, root, "again")
    return read_runs(spark, Lake(root)).select("reference_date", "status", "rows_in", "rows_out")


# -- snapshots and audit ------------------------------------------------------------------


def monthly(orders: DataFrame, *keys: str) -> DataFrame:
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")
    return orders.groupBy(month, *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("closed"),
        F.count_if(F.col("o_orderstatus") == "O").alias("open"),
        F.max("o_orderdate").alias("last_order"),
    )


@query("""
SELECT month AS snapshot FROM (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         count(*) FILTER (WHERE o_orderstatus = 'F') >= count(*) FILTER (WHERE o_orderstatus = 'O') AS done,
         max(o_orderdate) AS last_order FROM orders GROUP BY ALL)
WHERE NOT done OR last_order > month + INTERVAL 29 DAY
""")
def pending_months(spark, folder):
    """Months are done when most orders closed, and due again when an order came after day 30."""
    orders = table(spark, folder, "orders")
    available = orders.select(
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("_reference_date"),
        F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
    )
    runs = monthly(orders).select(
        F.lit("silver").alias("stage"),
        F.lit("orders").alias("table_name"),
        F.when(F.col("closed") >= F.col("open"), "success").otherwise("failed").alias("status"),
        F.col("month").alias("reference_date"),
        F.date_add("month", 29).cast("timestamp").alias("started_at"),
    )
    return pending_snapshots(available, runs, "orders").withColumnRenamed("_reference_date", "snapshot")


@query("""
SELECT o_orderkey, o_custkey FROM orders
WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders)
""")
def latest_snapshot(spark, folder):
    """A table without key takes the newest snapshot; older ones that come later don't replace it."""
    root = export_orders(spark, folder)
    load_orders(spark, root)
    load = Load("current_orders", "orders", FEED, "layout_valid | blocking | NOT _layout_invalid")
    refine(spark, Lake(root), "run", load)
    if refine(spark, Lake(root), "again", load):
        raise AssertionError("an older snapshot was due")
    return read_table(spark, Lake(root).path("silver", "current_orders")).select(
        F.col("order_key").cast("bigint").alias("o_orderkey"), F.col("customer").cast("bigint").alias("o_custkey")
    )


def order_runs(orders: DataFrame) -> DataFrame:
    """One run per month and status of the orders, as an audit log."""
    return monthly(orders, "o_orderpriority").select(
        F.lit("bronze").alias("stage"),
        F.col("o_orderpriority").alias("table_name"),
        F.col("month").alias("reference_date"),
        F.when(F.col("closed") > F.col("open"), "success").otherwise("failed").alias("status"),
        F.col("month").cast("timestamp_ntz").alias("started_at"),
        F.col("closed").cast("double").alias("duration_s"),
        F.col("n").alias("rows_in"),
        F.col("closed").alias("rows_out"),
        F.col("open").alias("rows_quarantined"),
    )


ORDER_RUNS_SQL = """
SELECT 'bronze' AS stage, o_orderpriority AS table_name, month AS reference_date,
       CASE WHEN closed > opened THEN 'success' ELSE 'failed' END AS status,
       CAST(month AS TIMESTAMP) AS started_at, CAST(closed AS DOUBLE) AS duration_s, n AS rows_in,
       closed AS rows_out, opened AS rows_quarantined
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority, count(*) AS n,
             count(*) FILTER (WHERE o_orderstatus = 'F') AS closed,
             count(*) FILTER (WHERE o_orderstatus = 'O') AS opened
      FROM orders GROUP BY ALL)
"""


@query(f"""
SELECT table_name, reference_date, rows_in, baseline, 
       round(CASE WHEN baseline = 0 THEN 0 ELSE (rows_in - baseline) / baseline END, 4) AS volume_change,
       coalesce(abs(CASE WHEN baseline = 0 THEN 0 ELSE (rows_in - baseline) / baseline END) > 0.2, false) AS unusual
FROM (SELECT *, CAST(median(rows_in) OVER (PARTITION BY table_name ORDER BY started_at
                                      ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS DOUBLE) AS baseline
      FROM ({ORDER_RUNS_SQL}) WHERE status = 'success')
""")
def volume_change(spark, folder):
    runs = order_runs(table(spark, folder, "orders"))
    return volume_changes(runs, 0.2).select(
        "table_name", "reference_date", "rows_in", "baseline", "volume_change", "unusual"
    )


@query(f"""
SELECT started_at, stage, table_name, reference_date, status, duration_s, rows_in, rows_out, rows_quarantined
FROM ({ORDER_RUNS_SQL}) ORDER BY started_at DESC, stage, table_name LIMIT 30
""")
def latest_runs(spark, folder):
    return run_report(order_runs(table(spark, folder, "orders")))


@query(f"""
SELECT table_name, reference_date, rows_in FROM ({ORDER_RUNS_SQL}) WHERE status = 'success'
ORDER BY started_at DESC, stage, table_name LIMIT 3
""")
def last_loads(spark, folder):
    return latest_loads(order_runs(table(spark, folder, "orders")), 3).select(
        "table_name", "reference_date", "rows_in"
    )


@query("""
SELECT c_name AS table_name, latest, datediff('day', latest, DATE '2001-08-01') AS days,
       coalesce(datediff('day', latest, DATE '2001-08-01') > 450, true) AS stale
FROM customer LEFT JOIN (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS latest FROM orders
                         WHERE o_orderstatus = 'F' GROUP BY o_custkey) ON o_custkey = c_custkey
""")
def stale_tables(spark, folder):
    """Customers stand for tables, their closed orders for successful loads."""
    names = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("table_name"))
    runs = (
        table(spark, folder, "orders")
        .join(names, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.lit("silver").alias("stage"),
            "table_name",
            F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("status"),
            F.col("o_orderdate").cast("date").alias("reference_date"),
        )
    )
    return freshness(runs, names, F.expr("DATE '2001-08-01'"), 450)
