"""Secret scan with a ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger, a Parquet
table, has one row for each blob and rule version that has been scanned, with its findings. A run
scans one version of each blob that the ledger lacks under the current rules, appends the result,
and joins findings back to all paths. A change of the rules changes the rule version.

Digests, not contents, are grouped; contents move once, for the representative's join. Everything
is DataFrame functions: matches come from regexp_extract_all, their places from what split leaves
between them, in code points. A blob with a third of the paths is a skewed join on its digest,
which adaptive execution splits.

Null content counts as empty. A null path is a path. Repeated rows each get the findings. Other
columns stay; same-named ones are replaced. An empty table gives no rows and an unchanged ledger.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.sources.storage import append, path_exists


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if `group` of it has `least` characters. `needs`: a string that every match has."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    needs: str = ""


# The base rules.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18, 0, "AKIA"),
    Rule("hex", r"[0-9a-f]{16,}", 16),
)
RULES = (
    *BASE,
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0, "PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 20, 0, "eyJ"),
)
SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def rule_version(rules: tuple[Rule, ...]) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def _places(matches: Column, between: Column, rank: int, rule: Rule) -> Column:
    """Spans of the matches that count, from the text between them."""

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.length(x["match"])
        value = F.regexp_extract(x["match"], rule.pattern, rule.group) if rule.group else x["match"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        held = F.when(F.length(value) >= rule.least, F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), held.alias("spans"))

    nothing = F.array().cast(SPANS)
    gaps = F.transform(matches, lambda m, k: F.struct(F.length(F.get(between, k)).alias("gap"), m.alias("match")))
    begin = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))
    return F.when(F.size(matches) > 0, F.aggregate(gaps, begin, step, lambda state: state["spans"])).otherwise(nothing)


def scanned(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """`blobs` with spans, by start and then by the rules' order, instead of content."""
    out = blobs
    for i, rule in enumerate(rules):
        found = F.regexp_extract_all("content", F.lit(rule.pattern), F.lit(0))
        out = out.withColumn(f"_m{i}", F.when(F.contains("content", F.lit(rule.needs)), found) if rule.needs else found)
    for i, rule in enumerate(rules):
        out = out.withColumn(f"_p{i}", F.when(F.size(f"_m{i}") > 0, F.split("content", rule.pattern, -1)))
    out = out.drop("content")
    parts = [_places(F.col(f"_m{i}"), F.col(f"_p{i}"), i, rule) for i, rule in enumerate(rules)]
    out = out.withColumn("spans", F.array_sort(F.concat(*parts)))
    return out.drop(*[f"_{x}{i}" for x in "mp" for i in range(len(rules))])


def scan_versions(versions: DataFrame, ledger: str, path: str = "path", content: str = "content", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`versions` with blob and spans instead of the content. Scans what `ledger` lacks and adds it there."""
    spark, current = versions.sparkSession, rule_version(rules)
    text = F.coalesce(F.col(content).cast("string"), F.lit(""))
    keyed = versions.select(F.coalesce(F.col(path).cast("string"), F.lit("")).alias("_path"), text.alias("content"), F.sha2(text, 256).alias("blob"))
    wanted = keyed.groupBy("blob").agg(F.min("_path").alias("_path"))
    if path_exists(spark, ledger):
        known = spark.read.parquet(ledger).where(F.col("rules") == current)
        wanted = wanted.join(known, "blob", "left_anti")
    fresh = scanned(keyed.join(wanted, ["blob", "_path"]).select("blob", "content"), rules)
    append(fresh.select("blob", F.lit(current).alias("rules"), "spans"), ledger)
    held = spark.read.parquet(ledger).where((F.col("rules") == current) & (F.size("spans") > 0)).dropDuplicates(["blob"]).select("blob", "spans")
    own = versions.drop("blob", "spans").withColumn("blob", F.sha2(text, 256)).drop(content)
    return own.join(held, "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_rank(rank: int):
    """A test of spans for the rule at this place."""
    return lambda span: span["rank"] == rank
