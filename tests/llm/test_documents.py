"""Toxicity, decontamination, quality rules and url filter."""

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cartulary.llm import decontaminate, quality, queries, toxicity, urls
from tools.compare import connect, normal

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def same_as_sql(spark, folder, name):
    got = queries.QUERIES[name](spark, folder)
    cursor = connect(folder).execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert normal(got.columns, got.collect()) == normal(columns, cursor.fetchall())


def test_decontamination_equals_sql(spark, folder):
    same_as_sql(spark, folder, "op3_decontamination")


def test_blocks_give_the_same(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60).cache()
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    one = decontaminate.scan_benchmark(docs, items).select("doc_id", "n_words", "hit_words", "hit_items").collect()
    many = decontaminate.scan_benchmark(docs, items, block=40).select("doc_id", "n_words", "hit_words", "hit_items").collect()
    assert sorted(one) == sorted(many) and any(r.hit_items for r in one)


def test_decontamination_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "Twice over HERE"), (2, None), (3, " . "), (4, "word"), (4, "word")], "item_id long, text string")
    rows = decontaminate.judged(decontaminate.scan_benchmark(edge_docs, items)).collect()
    assert sorted((r.doc_id, r.n_hit, r.hit_items) for r in rows if r.n_hit) == [(4, 1, [4]), (6, 3, [1]), (6, 3, [1]), (7, 3, [1])]
    assert decontaminate.scan_benchmark(no_docs, items).count() == 0
    kept = decontaminate.remove_documents(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 4
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(edge_docs, items).collect()}
    assert cut[7] == "same text  to be seen again and again by all who look at it" and cut[1] is None
    assert decontaminate.scan_benchmark(edge_docs, items.limit(0)).where("size(hit_items) > 0").count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    scored = queries.op2_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = scored.where("held_out").select("score", "predicted", "toxic").collect()
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    assert hit / max(1, sum(r.predicted for r in rows)) > 0.9
    assert hit / sum(r.toxic for r in rows) > 0.75


def test_toxicity_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(6, 1), (5, 0), (None, 1), (99, None)], "doc_id long, toxic int")
    for rows in (labels, labels.limit(0)):
        out = toxicity.score(edge_docs, toxicity.fit(edge_docs, rows)).collect()
        assert len(out) == edge_docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert toxicity.score(no_docs, toxicity.Model({}, 0.0)).count() == 0


def test_label_model_finds_accurate_voters():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.2
    good = [(truth & (rng.random(4000) < 0.6)) | (rng.random(4000) < 0.01) for _ in range(4)]
    copied = good[0]
    given = np.where(rng.random(4000) < 0.3, truth ^ (rng.random(4000) < 0.05), np.nan)
    posterior = toxicity.label_model(np.array([*good, copied, copied], float).T, given)
    assert ((posterior > 0.5) == truth).mean() > 0.95


def plain_quality(text):
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    repeated = {j for i in range(len(own) - 2) if windows[tuple(own[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(own) < 50 or 100 * len(repeated) > 50 * len(own)
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def test_quality_counts(spark, folder, edge_docs, no_docs):
    for docs in (spark.read.parquet(f"{folder}/documents.parquet"), edge_docs):
        texts = docs.withColumn("text_", F.col("text"))
        rows = quality.assess(texts).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_quality(r.text_), r.doc_id
    assert quality.assess(no_docs).count() == 0


def test_quality_rejects_depleted(spark):
    shared, long = "All rights reserved by page 7 of this host.", " ".join("ab" * (i + 1) for i in range(60))
    rows = [(i, "a", f"{shared}\n{long} {'cd' * (i + 1)}") for i in range(20)] + [(100 + i, "b", "\n".join([long] * 3)) for i in range(12)]
    out = quality.assess(spark.createDataFrame(rows, "doc_id long, source string, text string"), least=10, share=0.1).collect()
    assert {r.removed_chars for r in out if r.doc_id < 20} == {len(shared)} and all(r.kept for r in out if r.doc_id < 20)
    assert all(r.removed_chars == r.line_chars and not r.kept for r in out if r.doc_id >= 100)


URLS = [
    None,
    "",
    "no scheme/x",
    "http://",
    "https://A.Example.ORG/en/12?x=1#y",
    "http://example.org/es/",
    "http://badexample.org/es/",
    "ftp://x.com/de/1",
    "http://x.com/fr/1",
    "http://org#a",
    "http://q.net?a=http://b/c",
    "a://b://c/d",
]


def plain_url(url):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [r for r in urls.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def test_urls(spark, folder):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit(1))
    labelled = spark.createDataFrame([("http://q.net/1", 1)] * 30 + [("http://ok.net/1", 0)] * 30 + [("http://x.com", None), (None, 0)], "url string, bad int")
    rows = urls.judge(pages, labelled).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path, rule, verdict = plain_url(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict == (verdict or ("block" if r.bad_low > urls.LIMIT else "allow"))
    by = {r.host: r for r in rows}
    assert by["q.net"].verdict == "block" and by["q.net"].bad_rate > 0.5
    assert urls.judge(pages, labelled.limit(0)).where("verdict is null").count() == 0
    assert urls.judge(pages.limit(0), labelled).count() == 0
    for r in queries.op5_url_filter(spark, folder).join(spark.read.parquet(f"{folder}/pages.parquet"), "page_id").collect():
        assert (r.host, r.path, r.rule) == plain_url(r.url)[:3]


def test_more_pages_shrink_less(spark):
    labelled = spark.createDataFrame([(f"http://h{i}.d{i % 3}.com/", int(k % 7 == 0)) for i in range(30) for k in range(20)] + [("http://few.d0.com", 1), *[("http://many.d0.com", 1)] * 50], "url string, bad int")
    hosts = {r.host: r.rate for r in urls.reputation(labelled.select(urls.host_of(F.col("url")).alias("host"), "bad"))[0].collect()}
    assert hosts["h1.d1.com"] < hosts["few.d0.com"] < hosts["many.d0.com"] < 1
