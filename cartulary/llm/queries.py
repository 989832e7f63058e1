"""The thirteen operators, applied to their tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm import decontaminate, extract, fim, lines, minhash, packing, quality, ranked, secrets, substrings, toxicity, urls, warc
from cartulary.sources.storage import scratch_folder

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Base and further secrets of every document; the ledger starts empty."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan_versions(docs, scratch_folder(spark, "ledger"), "doc_id", "text")
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE))
    counts = [F.size(F.filter("spans", secrets.of_rank(i))).cast("long").alias(f"n_{r.kind}") for i, r in enumerate(secrets.BASE)]
    return found.select("doc_id", *counts, F.sha2(secrets.span_text(base), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"), "blob")


@query()
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a model of the labels that are not held out."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, folder, "labels").where(~toxicity.held_out()))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
spans AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, list_slice(w, i, i + least(13, len(w)) - 1) AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT DISTINCT k FROM spans) WHERE len(w) >= k)),
hits AS (SELECT doc_id, item_id, i, p.k FROM places p JOIN spans s ON p.k = s.k AND p.win = s.win),
found AS (
  SELECT doc_id, len(list_distinct(flatten(list(range(i, i + k))))) AS n_hit, list_sort(list(DISTINCT item_id::VARCHAR)) AS found_items
  FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(found_items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(found_items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN found USING (doc_id)
"""


@query(OP3_SQL)
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.judged(decontaminate.scan_benchmark(docs, _table(spark, folder, "benchmark")))
    items = F.array_sort(F.transform("hit_items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated")


@query()
def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Class of each document: the smallest doc_id of its near-duplicates."""
    found = minhash.near_duplicates(_table(spark, folder, "documents"), by_family=True)
    return found.select("doc_id", "class_id", "n_in_class", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def _level_sql(name: str, unit: str, above: str | None) -> str:
    """Posterior of one level: units of `unit`, each shrunk to its parent by the strength that moments give."""
    parent = f"(SELECT rate FROM {above} p WHERE p.{above} = max(h.{above}))" if above else "(SELECT rate FROM overall)"
    return f"""
{name}_units AS (SELECT h.{unit} AS {name}, sum(n) AS n, sum(bad) AS bad, {parent} AS parent FROM hosts h GROUP BY h.{unit}),
{name}_moments AS (
  SELECT sum(n * (bad / n - parent) ** 2) AS b, sum(parent * (1 - parent)) AS w, sum(n * parent * (1 - parent)) AS m FROM {name}_units),
{name}_strength AS (
  SELECT CASE WHEN coalesce(m, 0) = 0 OR m <= w THEN 10.0 ELSE 1 / least(greatest((b - w) / (m - w), 1e-4), 0.5) - 1 END AS s FROM {name}_moments),
{name} AS (
  SELECT {name}, rate, rate - 1.645 * sqrt(rate * (1 - rate) / (weight + 1)) AS low
  FROM (SELECT {name}, (s * parent + bad) / (s + n) AS rate, s + n AS weight FROM {name}_units, {name}_strength))"""


OP5_SQL = rf"""
WITH own AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN ['example.org/en/1', 'block']
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN ['example.org/es/', 'block']
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN ['com/fr/', 'allow']
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN ['com/de/', 'block']
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN ['org/', 'allow'] END AS fits
  FROM own),
labelled AS (
  SELECT host, greatest(toxic, 1 - quality) AS bad FROM own JOIN labels ON page_id = doc_id
  WHERE host <> '' AND greatest(toxic, 1 - quality) IS NOT NULL),
split AS (
  SELECT host, string_split(host, '.') AS l, array_to_string(list_slice(string_split(host, '.'), greatest(len(string_split(host, '.')) - 1, 1), 99), '.') AS two
  FROM (SELECT DISTINCT host FROM own)),
units AS (
  SELECT host, CASE WHEN two IN {urls.LONG_SUFFIXES} THEN two ELSE l[len(l)] END AS suffix,
    CASE WHEN two IN {urls.LONG_SUFFIXES} THEN array_to_string(list_slice(l, greatest(len(l) - 2, 1), 99), '.') ELSE two END AS domain FROM split),
hosts AS (SELECT host, suffix, domain, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM labelled JOIN units USING (host) GROUP BY ALL),
overall AS (SELECT CASE WHEN count(*) = 0 THEN 0.1 ELSE (sum(bad) + 0.1) / (sum(n) + 1) END AS rate FROM hosts),
{_level_sql("suffix", "suffix", None)},{_level_sql("domain", "domain", "suffix")},{_level_sql("host", "host", "domain")}
SELECT page_id, r.host, path, fits[1] AS rule,
  coalesce(fits[2], CASE WHEN coalesce(host.low, domain.low, suffix.low, 0) > 0.3 THEN 'block' ELSE 'allow' END) AS verdict,
  round(coalesce(host.rate, domain.rate, suffix.rate, (SELECT rate FROM overall)), 9) AS bad_rate,
  round(coalesce(host.low, domain.low, suffix.low, 0), 9) AS bad_low
FROM ruled r JOIN units USING (host) LEFT JOIN host ON host.host = r.host LEFT JOIN domain ON domain.domain = units.domain
  LEFT JOIN suffix ON suffix.suffix = units.suffix
"""


@query(OP5_SQL)
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled pages are those whose page_id is a doc_id of labels; toxic or of quality 0 is bad."""
    pages = _table(spark, folder, "pages").select("page_id", "url")
    labels = _table(spark, folder, "labels").select("doc_id", F.greatest(F.col("toxic"), 1 - F.col("quality")).alias("bad"))
    labelled = pages.join(labels, F.col("page_id") == F.col("doc_id")).select("url", "bad")
    posterior = [F.round(c, 9).alias(c) for c in ("bad_rate", "bad_low")]
    return urls.judge(pages, labelled).select("page_id", "host", "path", "rule", "verdict", *posterior)


@query()
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


OP7_SQL = """
WITH own AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
sized AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM own),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM sized WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM sized LEFT JOIN firsts USING (payload_digest)
"""


@query(OP7_SQL)
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(spark, _table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's text without repeated passages, what was removed, and from where."""
    found = substrings.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", "n_removed", "removed")


@query()
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's text without repeated lines, and the numbers of the lines removed."""
    found = lines.dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", "n_lines", "removed_lines")


OP10_SQL = r"""
WITH own AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM own),
windows AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM again) GROUP BY r),
each AS (SELECT r, host, unnest(lines) AS line FROM split),
normal AS (SELECT r, host, line, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS x FROM each),
often AS (
  SELECT host, x FROM (SELECT host, x, count(DISTINCT r) AS n FROM normal GROUP BY ALL) JOIN (SELECT host, count(*) AS docs FROM own GROUP BY host) USING (host)
  WHERE n > 10 AND n > 0.005 * docs),
removed AS (SELECT r, sum(length(line)) AS n FROM normal SEMI JOIN often USING (host, x) GROUP BY r),
counted AS (
  SELECT r, doc_id, len(w) AS n_words, length(coalesce(array_to_string(w, ''), '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, length(coalesce(array_to_string(lines, ''), '')) AS line_chars FROM split),
judged AS (
  SELECT c.*, coalesce(v.n, 0) AS n_repeat_words, coalesce(g.n, 0) AS removed_chars, n_words < 50 OR 100 * coalesce(v.n, 0) > 50 * n_words AS base_failed
  FROM counted c LEFT JOIN covered v USING (r) LEFT JOIN removed g USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND line_chars - removed_chars >= 0.5 * line_chars AS kept,
  line_chars::BIGINT AS line_chars, removed_chars::BIGINT AS removed_chars
FROM judged
"""


@query(OP10_SQL)
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.assess(_table(spark, folder, "documents").select("doc_id", "source", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "line_chars", "removed_chars")


OP11_SQL = r"""
WITH own AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT doc_id, text, tokens, len(tokens) AS n, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS h FROM own),
cut AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR text LIKE '%<P>%' OR text LIKE '%<S>%' OR text LIKE '%<M>%' OR h[3] % 100 >= 90 THEN 'plain'
      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(list_slice(tokens, 1, least(h[1] % (n + 1), h[2] % (n + 1))), '') AS p,
    array_to_string(list_slice(tokens, least(h[1] % (n + 1), h[2] % (n + 1)) + 1, greatest(h[1] % (n + 1), h[2] % (n + 1))), '') AS m,
    array_to_string(list_slice(tokens, greatest(h[1] % (n + 1), h[2] % (n + 1)) + 1, n), '') AS s
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(coalesce(p, '')) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(coalesce(m, '')) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || coalesce(p, '') || '<S>' || coalesce(s, '') || '<M>' || coalesce(m, '')
    ELSE '<S>' || coalesce(s, '') || '<P>' || coalesce(p, '') || '<M>' || coalesce(m, '') END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""


@query(OP11_SQL)
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document transformed, and its text rebuilt from the output."""
    found = fim.restore(fim.transform(_table(spark, folder, "documents").select("doc_id", "text")))
    digests = {f"{c}_sha256": F.sha2(c, 256) for c in ("output", "restored")}
    return found.withColumns(digests).select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


OP12_SQL = r"""
WITH words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
tfs AS (SELECT r, doc_id, t, count(*)::BIGINT AS tf FROM words GROUP BY ALL),
lengths AS (SELECT r, sum(tf)::BIGINT AS n FROM tfs GROUP BY r),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
damped AS (SELECT r, 100 - 50 + (50 * n * n_docs) // n_terms AS m FROM lengths, corpus),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
weights AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM tfs WHERE t IN (SELECT t FROM items) GROUP BY t), corpus),
scores AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM items JOIN weights USING (t) JOIN tfs USING (t) JOIN damped USING (r) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
"""


@query(OP12_SQL)
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return ranked.rank(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


#: For pages of the given tables: an article of headings and paragraphs, and everything else outside it.
OP13_SQL = r"""
WITH article AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1) AS a FROM pages),
blocks AS (SELECT page_id, url, string_split_regex(a, '</?(?:p|h1)>') AS b FROM article),
bare AS (SELECT page_id, url, list_transform(b, lambda x: regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g')) AS b FROM blocks),
decoded AS (
  SELECT page_id, url, list_transform(b, lambda x: trim(regexp_replace(
    regexp_replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS b
  FROM bare),
joined AS (SELECT page_id, url, coalesce(array_to_string(list_filter(b, lambda x: x <> ''), chr(10)), '') AS text FROM decoded)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined
"""


@query(OP13_SQL)
def op13_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = extract.main_text(_table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
