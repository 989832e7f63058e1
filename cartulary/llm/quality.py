"""Quality rules on lines that many documents of a host share.

Lines are normalised (lower case, digit runs as 0, white space as one space) and hashed. Per host
the documents of each line are counted; a line is removed where its documents are more than
`LEAST` and more than `SHARE` of the host's. A document that keeps less than `KEEP` of the
characters of its lines is depleted and rejected, as is one that fails the base rules.

Everything is DataFrame functions. Hashes of lines, not texts, are shuffled; counts combine first;
a line or host with a third of the rows is a skewed join that adaptive execution splits. Repeats
inside a text are found in its own row: hashes of word windows are sorted only where an equal pair
exists, in n log n.

Null text has no words and no lines, and fails the base rules. A null host is a host of its own.
A repeated row counts as one more document; equal rows get equal results. Same-named columns are
replaced by the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import carried, given_back, row_key

SPACE = r"[\x20\x09-\x0D]+"
LEAST, SHARE, KEEP = 10, 0.005, 0.5
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "line_chars", "removed_chars", "kept")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), SPACE, " "))


def base_counts(df: DataFrame, text: str) -> DataFrame:
    """Adds the counts of the base rules."""
    w = F.col("_words")
    out = df.withColumns({"_words": words_of(F.col(text)), "_lines": lines_of(F.col(text)), "n_symbols": F.regexp_count(F.col(text), F.lit("[#*$%&|<>]")).cast("long")})
    windows = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    out = out.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.when(F.size(w) >= 3, F.slice(windows, 1, F.size(w) - 2)).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("_words", "_lines")
    equal = F.size(F.array_distinct("_windows")) < F.size("_windows")
    out = out.withColumn("_sorted", F.when(equal, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_windows")
    s = F.col("_sorted")
    again = F.transform(s, lambda x, j: F.when((x.h == F.get(s, j - 1).h) | (x.h == F.get(s, j + 1).h), x.i))
    out = out.withColumn("_again", F.array_sort(F.filter(again, lambda i: i.isNotNull()))).drop("_sorted")
    p = F.col("_again")
    covered = F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_again")
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def frequent_lines(docs: DataFrame, host: str, text: str, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """(host, line, documents): hashes of lines above the limit of their host."""
    own = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("\x00")).alias("host"), F.coalesce(text, F.lit("")).alias("text"))
    hosts = own.groupBy("host").agg(F.count("*").alias("of"))
    hashes = F.array_distinct(F.transform(lines_of(F.col("text")), lambda x: F.xxhash64(normal_line(x))))
    counted = own.select("host", F.explode(hashes).alias("line")).groupBy("host", "line").agg(F.count("*").alias("documents")).where(F.col("documents") > least)
    return counted.join(hosts, "host").where(F.col("documents") > F.lit(share) * F.col("of")).select("host", "line", "documents")


def assess(docs: DataFrame, host: str = "source", text: str = "text", least: int = LEAST, share: float = SHARE, keep: float = KEEP) -> DataFrame:
    """`docs` without the text, with the counts, line_chars, removed_chars, base_failed and kept."""
    keyed = carried(docs, "doc_id", host, text).withColumns({"_text": F.coalesce(F.col(text).cast("string"), F.lit("")), "_row": row_key("doc_id", host, text)})
    often = frequent_lines(docs, host, text, least, share)
    lines = keyed.select("_row", F.coalesce(F.col(host).cast("string"), F.lit("\x00")).alias("host"), F.posexplode(F.transform(lines_of(F.col("_text")), lambda x: F.struct(F.xxhash64(normal_line(x)).alias("line"), F.length(x).alias("chars")))).alias("pos", "x"))
    hit = lines.select("_row", "host", "pos", "x.line", "x.chars").join(often, ["host", "line"], "left_semi")
    removed = hit.dropDuplicates(["_row", "pos"]).groupBy("_row").agg(F.sum("chars").alias("removed_chars"))
    counted = base_counts(keyed.drop(text), "_text").withColumn("line_chars", F.aggregate(lines_of(F.col("_text")), F.lit(0).cast("long"), lambda a, x: a + F.length(x))).drop("_text")
    out = counted.join(removed, "_row", "left").withColumn("removed_chars", F.coalesce("removed_chars", F.lit(0).cast("long"))).drop("_row")
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("line_chars") - F.col("removed_chars") >= F.lit(keep) * F.col("line_chars")))
    return given_back(out, [c for c in docs.columns if c != text], ("doc_id", host), RESULTS)
