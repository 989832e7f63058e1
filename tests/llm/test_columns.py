"""Callers' columns come back unchanged, whatever their names; rules that tie; labels without a host."""

from pyspark.sql import functions as F

from cartulary.llm import decontaminate, extract, fim, lines, minhash, quality, substrings, urls

NAMES = (
    "_row _found _cut _text _doc _tied _others _whole _words _lines _windows _sorted _again _host _rule _suffix _domain _host_rate _host_low row doc node head "
    "bucket component page blocks found whole region d1 d2 n sim own keeper group pos start size removed_by line documents of"
).split()


def table(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, text), (2, text + " more"), (3, None), (4, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    extra = {name: F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for name in NAMES}
    return df.withColumns({"source": F.lit("s"), "url": F.lit("http://a.example/x"), "html": F.col("text")} | extra)


def test_columns_of_any_name_come_back(spark):
    docs = table(spark)
    items = spark.createDataFrame([(1, "six seven eight"), (2, "ten eleven")], "item_id long, text string")
    labelled = spark.createDataFrame([("http://a.example/y", 1)], "url string, bad int")
    found = {
        "decontamination": decontaminate.scan_benchmark(docs, items, block=2),
        "minhash": minhash.one_of_each(docs),
        "urls": urls.judge(docs, labelled),
        "substrings": substrings.remove_repeats(docs),
        "lines": lines.dedup_lines(docs),
        "quality": quality.assess(docs),
        "fim": fim.restore(fim.transform(docs)),
        "extract": extract.main_text(docs.drop("text")),
    }
    replaced = {"fim": {"n"}}
    for operator, df in found.items():
        kept = [n for n in NAMES if n not in replaced.get(operator, ())]
        rows = df.collect()
        assert rows and all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in kept), operator


def test_first_of_equal_rules_wins_and_no_host_has_no_reputation(spark):
    pages = spark.createDataFrame([(1, "http://a.b/x"), (2, None), (3, "nothing")], "page_id long, url string")
    labelled = spark.createDataFrame([(None, 1)] * 50 + [("http://c.d/", 0)] * 3, "url string, bad int")
    rules = (("a.b", "/", "block"), ("b", "/x", "allow"), ("a.b", "/x", "allow"), ("a.b", "/x", "block"))
    rows = {r.page_id: r for r in urls.judge(pages, labelled, rules).collect()}
    assert rows[1].rule == "a.b/x" and rows[1].verdict == "allow"
    assert rows[2].verdict == rows[3].verdict == "allow" and rows[2].bad_rate < 0.3
