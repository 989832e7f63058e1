"""URL filter: rules first, else the reputation of the host.

Reputation is empirical Bayes over labelled pages: the rate of bad pages is shrunk from all pages
to the public suffix, the registered domain and the host. At each level the units' rates follow a
beta distribution around their parent's rate; its strength comes from the spread of the units by
the method of moments, within limits: the overlap of units is taken as 1e-4 to 0.5, and a strength of
10 pages is assumed where the moments give none. A page is blocked when the lower bound of its host's posterior is above
`limit`. A host without labelled pages takes its domain's rate, and so on up.

Counts combine before the shuffle, one aggregate per level on the one below; pages are joined to
hosts, so a host with a third of the pages is a skewed join that adaptive execution splits. Only
the sums of a level go to the driver.

Null urls and urls without `://` have an empty host and path, match no rule and are judged as an
unknown host; their labels count for no host. Of equally long rules that fit the first given wins. Null outcomes don't count. Without labelled pages the rate is `PRIOR`. Repeated
rows are judged alike; a url's labels count as often as they are given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import carried, given_back
from cartulary.sources.storage import stage

# The rules of the filter (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Public suffixes of two labels; the last label is one otherwise. A parameter.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.in", "co.nz", "co.za")
LIMIT, SURENESS, PRIOR = 0.3, 1.645, 0.1
LEVELS = ("suffix", "domain", "host")
RESULTS = ("host", "path", "rule", "verdict", "bad_rate", "bad_low")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, with its verdict; of equally long ones the first given."""
    found = F.lit(None).cast("struct<rule string, verdict string>")
    for own, start, verdict in sorted(reversed(rules), key=lambda r: len(r[0] + r[1])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(own + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def units_of(host: Column, long_suffixes: tuple = LONG_SUFFIXES) -> dict[str, Column]:
    """The suffix and the registered domain of a host; the host itself where it has no more labels."""
    two = F.substring_index(host, ".", -2)
    long = two.isin(*long_suffixes)
    return {"suffix": F.when(long, two).otherwise(F.substring_index(host, ".", -1)), "domain": F.when(long, F.substring_index(host, ".", -3)).otherwise(two)}


def strength(units: DataFrame) -> float:
    """Beta strength (in pages) of units with n, bad and their parent's rate, by moments."""
    rate = F.col("bad") / F.col("n")
    spread = F.col("parent") * (1 - F.col("parent"))
    s = units.agg(F.sum(F.col("n") * F.pow(rate - F.col("parent"), 2)).alias("between"), F.sum(spread).alias("within"), F.sum(F.col("n") * spread).alias("most")).first()
    if not s.most or s.most <= s.within:
        return 10.0
    overlap = min(max((s.between - s.within) / (s.most - s.within), 1e-4), 0.5)
    return (1 - overlap) / overlap


def reputation(labelled: DataFrame) -> tuple[DataFrame, dict[str, DataFrame], float]:
    """Posterior by host, and by level for hosts without labels. labelled: host, bad (0 or 1)."""
    known = labelled.where("bad is not null and host <> ''")
    hosts, _ = stage(known.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad")).withColumns(units_of(F.col("host"))), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = (total.bad + PRIOR) / (total.n + 1) if total.n else PRIOR
    levels: dict[str, DataFrame] = {}
    above = None
    for level in LEVELS:
        keep = [c for c in LEVELS if LEVELS.index(c) < LEVELS.index(level)][-1:]
        units = hosts.groupBy(level, *keep).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        units = units.join(above.select(keep[0], F.col("rate").alias("parent")), keep[0]) if keep else units.withColumn("parent", F.lit(overall))
        s = strength(units)
        alpha, weight = F.lit(s) * F.col("parent") + F.col("bad"), F.lit(s) + F.col("n")
        rate = alpha / weight
        above = units.withColumns({"rate": rate, "low": rate - F.lit(SURENESS) * F.sqrt(rate * (1 - rate) / (weight + 1))})
        levels[level] = above.select(level, "rate", "low")
    return levels["host"], levels, overall


def judge(pages: DataFrame, labelled: DataFrame, rules: tuple = RULES, limit: float = LIMIT) -> DataFrame:
    """`pages` with host, path, rule, verdict and posterior; labelled: url, bad (0, 1 or null). Same-named columns are replaced."""
    own = carried(pages, "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    _, levels, overall = reputation(labelled.select(host_of(F.col("url")).alias("host"), F.col("bad").cast("int").alias("bad")))
    units = units_of(F.col("host"))
    own = own.withColumns({"_suffix": units["suffix"], "_domain": units["domain"], "_host": F.col("host"), "_rule": rule_of(F.col("host"), F.col("path"), rules)})
    for level in LEVELS:
        own = own.join(levels[level].select(F.col(level).alias(f"_{level}"), F.col("rate").alias(f"_{level}_rate"), F.col("low").alias(f"_{level}_low")), f"_{level}", "left")
    rate = F.coalesce("_host_rate", "_domain_rate", "_suffix_rate", F.lit(overall))
    low = F.coalesce("_host_low", "_domain_low", "_suffix_low", F.lit(0.0))
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(low > limit, F.lit("block")).otherwise(F.lit("allow")))
    out = own.withColumns({"rule": F.col("_rule.rule"), "verdict": verdict, "bad_rate": rate, "bad_low": low})
    return given_back(out, pages.columns, ("url",), RESULTS)
