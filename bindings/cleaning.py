"""Text clean-up, typing, file names, headers, documents, pseudonyms and the privacy policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.registry import query, table
from cartulary.functions.casts import date_in_name
from cartulary.functions.documents import padded_document, trimmed_code, valid_municipality_code, with_documents
from cartulary.functions.measures import age_group, age_on, band_of_income, ceiling_of_band, zip_area
from cartulary.functions.pseudonyms import Pseudonyms
from cartulary.operators.documents import validate_documents
from cartulary.operators.policy import apply_policy
from cartulary.operators.preparation import prepare
from cartulary.sources.delimited import header_verdict, row_digest
from cartulary.sources.layouts import Layout

KEY = "a fixed key used only on the sample tables"
BANDS = {1: 2850, 2: 4700, 3: 8600, 4: 12000}
AS_OF = "DATE '2026-09-11'"


def pads_sql() -> tuple[str, str]:
    block = KEY.encode().ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in block).hex(), bytes(b ^ 0x5C for b in block).hex()


INNER, OUTER = pads_sql()


def hmac_sql(text: str, domain: str) -> str:
    """The same keyed hash in the oracle's SQL."""
    message = f"encode('{domain}:' || {text})"
    return f"sha256(unhex('{OUTER}') || unhex(sha256(unhex('{INNER}') || {message})))"


# -- typed rows ---------------------------------------------------------------------------

LINES = Layout.parse(
    "lines",
    """
    ORDER_KEY    int   order_key    operational  keep
    LINE_NUMBER  int   line_number  operational  keep
    QUANTITY     int   quantity     operational  keep
    PRICE        dec   price        operational  keep
    SHIP_DATE    date  ship_date    operational  keep
    FLAG         str   flag         operational  keep
    """,
)


def raw_lines(lineitem: DataFrame, *others: str) -> DataFrame:
    """lineitem as the text a delimited file would bring, defects included."""
    return lineitem.select(
        *others,
        F.expr("concat(' ', l_orderkey, ' ')").alias("ORDER_KEY"),
        F.col("l_linenumber").cast("string").alias("LINE_NUMBER"),
        F.expr(
            "CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'dois' "
            "ELSE CAST(CAST(l_quantity AS INT) AS STRING) END"
        ).alias("QUANTITY"),
        F.expr(
            "CASE WHEN l_returnflag = 'R' "
            "THEN concat(cents div 100000, '.', lpad(CAST(cents div 100 % 1000 AS STRING), 3, '0'), ',', "
            "lpad(CAST(cents % 100 AS STRING), 2, '0')) "
            "ELSE concat(cents div 100, '.', lpad(CAST(cents % 100 AS STRING), 2, '0')) END"
        ).alias("PRICE"),
        F.expr(
            "CASE WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN '31/02/2026' "
            "WHEN l_returnflag = 'R' THEN date_format(l_shipdate, 'dd/MM/yyyy') "
            "WHEN l_returnflag = 'A' THEN date_format(l_shipdate, 'yyyy-MM-dd') "
            "ELSE date_format(l_shipdate, 'ddMMyyyy') END"
        ).alias("SHIP_DATE"),
        F.expr(
            "CASE WHEN l_linenumber = 2 THEN '   ' ELSE concat(decode(unhex('00'), 'UTF-8'), l_returnflag, '  ') END"
        ).alias("FLAG"),
    )


def with_cents(lineitem: DataFrame) -> DataFrame:
    return lineitem.withColumn("cents", F.round(F.col("l_extendedprice") * 100).cast("bigint"))


RAW_LINES_SQL = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
       ' ' || l_orderkey || ' ' AS order_key,
       CAST(l_linenumber AS VARCHAR) AS line_number,
       CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'dois'
            ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
       CASE WHEN l_returnflag = 'R'
            THEN (cents // 100000) || '.' || lpad(CAST(cents // 100 % 1000 AS VARCHAR), 3, '0') || ','
                 || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
            ELSE (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS price,
       CASE WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN '31/02/2026'
            WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%d/%m/%Y')
            WHEN l_returnflag = 'A' THEN strftime(l_shipdate, '%Y-%m-%d')
            ELSE strftime(l_shipdate, '%d%m%Y') END AS ship_date,
       CASE WHEN l_linenumber = 2 THEN '   ' ELSE chr(0) || l_returnflag || '  ' END AS flag
FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
"""
TYPED_LINES_SQL = f"""
SELECT CASE WHEN regexp_full_match(order_key, '[+-]?[0-9]+') THEN try_cast(order_key AS INTEGER) END AS order_key,
       CASE WHEN regexp_full_match(line_number, '[+-]?[0-9]+') THEN try_cast(line_number AS INTEGER) END AS line_number,
       CASE WHEN regexp_full_match(quantity, '[+-]?[0-9]+') THEN try_cast(quantity AS INTEGER) END AS quantity,
       try_cast(CASE WHEN price LIKE '%,%' THEN replace(replace(price, '.', ''), ',', '.') ELSE price END
                AS DECIMAL(14,2)) AS price,
       CAST(coalesce(CASE WHEN length(ship_date) = 10 THEN try_strptime(ship_date, '%d/%m/%Y') END,
                     CASE WHEN length(ship_date) = 10 THEN try_strptime(ship_date, '%Y-%m-%d') END,
                     CASE WHEN length(ship_date) = 8 THEN try_strptime(ship_date, '%d%m%Y') END) AS DATE) AS ship_date,
       flag,
       quantity AS quantity_text, ship_date AS ship_date_text, price AS price_text,
       l_orderkey, l_linenumber, l_suppkey, l_partkey, digest
FROM (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
             sha256(concat_ws('|', order_key, line_number, quantity, price, ship_date, flag, l_suppkey,
                              line_number || '-' || trim(order_key), 'free text')) AS digest,
             trim(order_key) AS order_key, trim(line_number) AS line_number, trim(quantity) AS quantity,
             trim(price) AS price, trim(ship_date) AS ship_date,
             nullif(trim(replace(flag, chr(0), '')), '') AS flag
      FROM ({RAW_LINES_SQL}))
"""


@query(f"""
SELECT order_key, line_number, quantity, price, ship_date, flag,
       concat_ws(',', CASE WHEN quantity_text IS NOT NULL AND quantity IS NULL THEN 'QUANTITY' END,
                      CASE WHEN ship_date_text IS NOT NULL AND ship_date IS NULL THEN 'SHIP_DATE' END) AS invalid_types
FROM ({TYPED_LINES_SQL})
""")
def clean_and_type(spark, folder):
    typed = prepare(raw_lines(with_cents(table(spark, folder, "lineitem"))), LINES)
    return typed.select(
        *[F.col(f.source).alias(f.target) for f in LINES.fields],
        F.array_join("_invalid_types", ",").alias("invalid_types"),
    )


# -- file names, headers, digests ---------------------------------------------------------


@query("""
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'MUNICIPIOS.csv'
            WHEN '5-LOW' THEN 'ARQ_99999999_' || strftime(o_orderdate, '%d%m%Y') || '_X.TXT'
            ELSE 'ARQ_FAMILIA_' || strftime(o_orderdate, '%d%m%Y') || '_SB8.TXT' END AS file_name,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderdate AS DATE) END AS snapshot
FROM orders
""")
def filename_date(spark, folder):
    day = F.date_format("o_orderdate", "ddMMyyyy")
    name = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "MUNICIPIOS.csv")
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("ARQ_99999999_"), day, F.lit("_X.TXT")))
        .otherwise(F.concat(F.lit("ARQ_FAMILIA_"), day, F.lit("_SB8.TXT")))
    )
    named = table(spark, folder, "orders").select("o_orderkey", name.alias("file_name"))
    return named.withColumn("snapshot", date_in_name(F.col("file_name")))


HEADED = Layout.parse(
    "orders",
    """
    O_ORDERKEY     int  -  operational  keep
    O_CUSTKEY      int  -  operational  keep
    O_ORDERSTATUS  str  -  operational  keep
    O_TOTALPRICE   dec  -  operational  keep
    """,
)


@query("""
WITH lines AS (
  SELECT o_orderkey,
         CASE o_orderstatus
              WHEN 'F' THEN chr(65279) || 'o_orderkey; o_custkey ;o_orderstatus;o_totalprice' || chr(13)
              WHEN 'O' THEN 'O_TOTALPRICE;O_ORDERSTATUS;O_CUSTKEY;O_ORDERKEY'
              ELSE 'O_ORDERKEY;CLIENT_' || o_custkey || ';O_ORDERSTATUS;O_TOTALPRICE' END AS header
  FROM orders),
cells AS (
  SELECT o_orderkey,
         list_transform(string_split(replace(replace(header, chr(65279), ''), chr(13), ''), ';'),
                        lambda x: upper(trim(x))) AS names,
         ['O_ORDERKEY', 'O_CUSTKEY', 'O_ORDERSTATUS', 'O_TOTALPRICE'] AS expected
  FROM lines)
SELECT o_orderkey,
       array_to_string(list_filter(expected, lambda x: NOT list_contains(names, x)), ',') AS missing,
       array_to_string(list_filter(names, lambda x: NOT list_contains(expected, x)), ',') AS unexpected,
       CASE WHEN names = expected THEN 'ok'
            WHEN len(list_filter(expected, lambda x: NOT list_contains(names, x))) = 0
             AND len(list_filter(names, lambda x: NOT list_contains(expected, x))) = 0 THEN 'wrong_order'
            ELSE 'changed' END AS verdict
FROM cells
""")
def header_diff(spark, folder):
    header = (
        F.when(F.col("o_orderstatus") == "F", "﻿o_orderkey; o_custkey ;o_orderstatus;o_totalprice\r")
        .when(F.col("o_orderstatus") == "O", "O_TOTALPRICE;O_ORDERSTATUS;O_CUSTKEY;O_ORDERKEY")
        .otherwise(F.concat(F.lit("O_ORDERKEY;CLIENT_"), "o_custkey", F.lit(";O_ORDERSTATUS;O_TOTALPRICE")))
    )
    lines = table(spark, folder, "orders").select("o_orderkey", header.alias("header"))
    return header_verdict(lines, HEADED, ";").select(
        "o_orderkey",
        F.array_join("missing", ",").alias("missing"),
        F.array_join("unexpected", ",").alias("unexpected"),
        "verdict",
    )


@query("""
SELECT c_custkey,
       sha256(concat_ws('|', CAST(c_custkey AS VARCHAR), coalesce(c_name, ''), CAST(c_nationkey AS VARCHAR),
                        coalesce(CASE WHEN c_acctbal >= 0 THEN CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END, ''),
                        coalesce(c_mktsegment, ''))) AS digest
FROM customer
""")
def record_hash(spark, folder):
    texts = table(spark, folder, "customer").select(
        F.col("c_custkey"),
        F.col("c_custkey").cast("string").alias("k"),
        F.col("c_name").alias("n"),
        F.col("c_nationkey").cast("string").alias("a"),
        F.when(F.col("c_acctbal") >= 0, F.floor("c_acctbal").cast("string")).alias("b"),
        F.col("c_mktsegment").alias("m"),
    )
    return texts.select("c_custkey", row_digest(["k", "n", "a", "b", "m"]).alias("digest"))


# -- documents ----------------------------------------------------------------------------

SCRAMBLE = "(o_orderkey * 7919 + o_custkey * 104729 + 1000003) * 613 % 100000000000"


def document_text():
    """A document text per order: masked, bare, too long, all digits equal, blank or null."""
    return F.expr(
        "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN NULL "
        "WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN ' - ' "
        "WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN concat('9', n) "
        "WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN repeat(substr(n, 11, 1), 11) "
        "WHEN o_orderstatus = 'F' "
        "THEN concat(substr(n, 1, 3), '.', substr(n, 4, 3), '.', substr(n, 7, 3), '-', substr(n, 10, 2)) "
        "ELSE n END"
    )


def numbered(orders: DataFrame) -> DataFrame:
    return orders.withColumn("n", F.expr(f"lpad(CAST({SCRAMBLE} AS STRING), 11, '0')"))


def raw_documents(orders: DataFrame) -> DataFrame:
    return numbered(orders).select("o_orderkey", document_text().alias("doc"))


RAW_DOCUMENTS_SQL = f"""
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN NULL
            WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN ' - '
            WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN '9' || n
            WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN repeat(substr(n, 11, 1), 11)
            WHEN o_orderstatus = 'F'
            THEN substr(n, 1, 3) || '.' || substr(n, 4, 3) || '.' || substr(n, 7, 3) || '-' || substr(n, 10, 2)
            ELSE n END AS doc
FROM (SELECT *, lpad(CAST({SCRAMBLE} AS VARCHAR), 11, '0') AS n FROM orders)
"""


def _weighted(weights) -> str:
    return " + ".join(f"CAST(substr(p, {i + 1}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights))


def _remainder_digit(weights) -> str:
    total = f"(({_weighted(weights)}) % 11)"
    return f"(CASE WHEN {total} < 2 THEN 0 ELSE 11 - {total} END)"


DOCUMENTS_SQL = f"""
SELECT o_orderkey, doc, p,
       CASE WHEN doc IS NULL OR regexp_replace(doc, '[^0-9]', '', 'g') = '' THEN 'missing'
            WHEN p IS NOT NULL AND p <> repeat(substr(p, 1, 1), 11)
             AND {_remainder_digit(range(10, 1, -1))} = CAST(substr(p, 10, 1) AS INTEGER)
             AND {_remainder_digit(range(11, 1, -1))} = CAST(substr(p, 11, 1) AS INTEGER) THEN 'valid'
            ELSE 'invalid' END AS cpf_status,
       CASE WHEN doc IS NULL OR regexp_replace(doc, '[^0-9]', '', 'g') = '' THEN 'missing'
            WHEN p IS NOT NULL AND p <> repeat(substr(p, 1, 1), 11)
             AND {_remainder_digit((3, 2, 9, 8, 7, 6, 5, 4, 3, 2))} = CAST(substr(p, 11, 1) AS INTEGER) THEN 'valid'
            ELSE 'invalid' END AS nis_status,
       nullif(ltrim(regexp_replace(trim(doc), '[^0-9]', '', 'g'), '0'), '') AS code
FROM (SELECT o_orderkey, doc,
             CASE WHEN length(regexp_replace(doc, '[^0-9]', '', 'g')) BETWEEN 1 AND 11
                  THEN lpad(regexp_replace(doc, '[^0-9]', '', 'g'), 11, '0') END AS p
      FROM ({RAW_DOCUMENTS_SQL}))
"""


@query(f"SELECT o_orderkey, p AS padded, cpf_status, nis_status, code FROM ({DOCUMENTS_SQL})")
def document_checks(spark, folder):
    texts = raw_documents(table(spark, folder, "orders")).withColumn("other", F.col("doc"))
    return with_documents(texts, {"doc": "cpf", "other": "nis"}).select(
        "o_orderkey",
        padded_document(F.col("doc")).alias("padded"),
        F.col("_status_doc").alias("cpf_status"),
        F.col("_status_other").alias("nis_status"),
        trimmed_code(F.col("doc")).alias("code"),
    )


@query(f"""
SELECT document_column, s.status, count(*) FILTER (WHERE x.status = s.status) AS n
FROM (SELECT 'as_cpf' AS document_column, cpf_status AS status FROM ({DOCUMENTS_SQL})
      UNION ALL SELECT 'as_nis', nis_status FROM ({DOCUMENTS_SQL})) x,
     (VALUES ('valid'), ('invalid'), ('missing')) s(status)
GROUP BY ALL
""")
def document_profile(spark, folder):
    docs = raw_documents(table(spark, folder, "orders")).select(
        F.col("doc").alias("as_cpf"), F.col("doc").alias("as_nis")
    )
    return validate_documents(docs, {"as_cpf": "cpf", "as_nis": "nis"})


@query("""
WITH codes AS (SELECT o_orderkey, o_orderkey * 37 + 990000 + o_custkey AS code FROM orders),
d AS (SELECT *, lpad(CAST(code AS VARCHAR), 7, '0') AS t FROM codes),
parts AS (
  SELECT o_orderkey, code, t,
         list_sum([CAST(substr(t, i, 1) AS INTEGER) FOR i IN [1, 3, 5]])
         + list_sum([(2 * CAST(substr(t, i, 1) AS INTEGER)) // 10 + (2 * CAST(substr(t, i, 1) AS INTEGER)) % 10
                     FOR i IN [2, 4, 6]]) AS total
  FROM d)
SELECT o_orderkey, code,
       code BETWEEN 1000000 AND 9999999 AND (10 - total % 10) % 10 = CAST(substr(t, 7, 1) AS INTEGER) AS is_valid
FROM parts
""")
def ibge_check(spark, folder):
    coded = table(spark, folder, "orders").select(
        "o_orderkey", (F.col("o_orderkey") * 37 + 990000 + F.col("o_custkey")).alias("code")
    )
    return coded.withColumn("is_valid", valid_municipality_code(F.col("code")))


# -- pseudonyms and policy ----------------------------------------------------------------


@query(f"SELECT c_custkey, {hmac_sql('c_name', 'customer')} AS pseudonym FROM customer")
def hmac_pseudonym(spark, folder):
    pseudonyms = Pseudonyms(spark, KEY)
    return table(spark, folder, "customer").select(
        "c_custkey", pseudonyms.of(F.col("c_name"), "customer").alias("pseudonym")
    )


@query("""
SELECT c_mktsegment, event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_people
FROM events JOIN customer ON c_custkey = user_id
GROUP BY ALL
""")
def pseudonym_join(spark, folder):
    """Two tables that share only a pseudonym; events are counted per pseudonym before the join."""
    pseudonyms = Pseudonyms(spark, KEY)
    code = lambda name: pseudonyms.of(trimmed_code(F.concat(F.lit("1"), F.col(name))), "person")
    people = table(spark, folder, "customer").select(code("c_custkey").alias("person"), "c_mktsegment")
    seen = (
        table(spark, folder, "events")
        .groupBy("user_id", "event_type")
        .count()
        .select(code("user_id").alias("person"), "event_type", "count")
    )
    return (
        seen.join(people, "person")
        .groupBy("c_mktsegment", "event_type")
        .agg(F.sum("count").alias("n_events"), F.count(F.lit(1)).alias("n_people"))
    )


@query(f"""
SELECT o_orderkey, age, CASE WHEN age < 18 THEN '0-17' WHEN age < 60 THEN '18-59' ELSE '60+' END AS age_group,
       CASE WHEN length(z) = 8 THEN substr(z, 1, 5) END AS zip_prefix
FROM (SELECT o_orderkey, CAST(datesub('year', CAST(o_orderdate AS DATE) - CAST(o_custkey * 20 AS INTEGER), {AS_OF}) AS INTEGER) AS age,
             CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderkey AS VARCHAR)
                  ELSE lpad(CAST(o_orderkey AS VARCHAR), 8, '7') END AS z
      FROM orders)
""")
def age_and_zip(spark, folder):
    birth = F.date_sub(F.col("o_orderdate").cast("date"), (F.col("o_custkey") * 20).cast("int"))
    zip_text = F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey").cast("string")).otherwise(
        F.expr("concat(substr(lpad(o_orderkey, 8, '7'), 1, 5), '-', substr(lpad(o_orderkey, 8, '7'), 6, 3))")
    )
    age = age_on(birth, F.expr(AS_OF))
    return table(spark, folder, "orders").select(
        "o_orderkey", age.alias("age"), age_group(age).alias("age_group"), zip_area(zip_text).alias("zip_prefix")
    )


CLIENTS = Layout.parse(
    "clients",
    """
    ORDER_CODE  str   order_code      identifier   pseudonymize
    DOCUMENT    str   person          identifier   pseudonymize  cpf
    ADDRESS     str   -               identifier   drop
    ZIP         str   zip_prefix      personal     generalize    zip5
    BIRTH       date  age             personal     generalize    age
    STATUS      str   order_status    operational  keep
    """,
)


@query(f"""
SELECT o.o_orderkey,
       {hmac_sql("ltrim(CAST(o.o_orderkey + 1 AS VARCHAR), '0')", "order_code")} AS order_code,
       CASE WHEN d.cpf_status = 'valid' THEN {hmac_sql("d.p", "cpf")} END AS person,
       d.cpf_status, substr(lpad(CAST(o.o_orderkey AS VARCHAR), 8, '7'), 1, 5) AS zip_prefix,
       CAST(datesub('year', CAST(o_orderdate AS DATE), {AS_OF}) AS INTEGER) AS age,
       o_orderstatus AS order_status
FROM orders o JOIN ({DOCUMENTS_SQL}) d ON d.o_orderkey = o.o_orderkey
""")
def policy_projection(spark, folder):
    rows = numbered(table(spark, folder, "orders")).select(
        F.col("o_orderkey").alias("_order"),
        F.format_string("00%d", F.col("o_orderkey") + 1).alias("ORDER_CODE"),
        document_text().alias("DOCUMENT"),
        F.lit("street and number").alias("ADDRESS"),
        F.expr("lpad(o_orderkey, 8, '7')").alias("ZIP"),
        F.col("o_orderdate").cast("date").alias("BIRTH"),
        F.col("o_orderstatus").alias("STATUS"),
    )
    shown = apply_policy(rows, CLIENTS, Pseudonyms(spark, KEY), F.expr(AS_OF))
    return shown.withColumnRenamed("_order", "o_orderkey")


# -- income bands -------------------------------------------------------------------------


@query("""
SELECT o_orderkey, income, band, 
       CASE band WHEN 1 THEN 2850.0::DOUBLE WHEN 2 THEN 4700.0::DOUBLE WHEN 3 THEN 8600.0::DOUBLE
                 WHEN 4 THEN 12000.0::DOUBLE END AS ceiling,
       CASE given WHEN 1 THEN 2850.0::DOUBLE WHEN 2 THEN 4700.0::DOUBLE WHEN 3 THEN 8600.0::DOUBLE
                  WHEN 4 THEN 12000.0::DOUBLE END AS given_ceiling,
       income <= CASE given WHEN 1 THEN 2850 WHEN 2 THEN 4700 WHEN 3 THEN 8600 WHEN 4 THEN 12000 END AS within_band
FROM (SELECT o_orderkey, o_totalprice / 25 AS income,
             CASE WHEN o_totalprice / 25 <= 2850 THEN 1 WHEN o_totalprice / 25 <= 4700 THEN 2
                  WHEN o_totalprice / 25 <= 8600 THEN 3 ELSE 4 END AS band,
             CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS given FROM orders)
""")
def band_lookup(spark, folder):
    income = F.col("o_totalprice") / 25
    given = F.substring("o_orderpriority", 1, 1).cast("int")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        income.alias("income"),
        band_of_income(income, BANDS).alias("band"),
        ceiling_of_band(band_of_income(income, BANDS), BANDS).alias("ceiling"),
        ceiling_of_band(given, BANDS).alias("given_ceiling"),
        (income <= ceiling_of_band(given, BANDS)).alias("within_band"),
    )
