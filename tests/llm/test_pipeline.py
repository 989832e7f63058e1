import corpus_pipeline


def test_pipeline(spark, folder, edge_docs):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        found = spark.createDataFrame(function(spark, kept, folder).collect(), docs.schema)
        assert found.columns == columns, name
        assert 0 < found.count() <= kept.count(), name
        kept = found
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in kept.collect()}
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


def test_stages_take_edges(spark, folder, edge_docs):
    """Nulls, empties, a very long text, ties and repeated rows have the results that the stages' docstrings state."""
    own = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    found = {name: function(spark, own, folder).collect() for name, function in corpus_pipeline.STAGES}
    for name, rows in found.items():
        assert name == "packing" or list(rows[0].asDict()) == own.columns, name
    kept = {name: [(r.doc_id, r.text) for r in rows] for name, rows in found.items() if name != "packing"}
    assert len(kept["decontamination"]) == own.count() and len(kept["near_dedup"]) == 8
    assert {(1, None), (2, ""), (None, None)} <= set(kept["line_dedup"]) and 7 not in {i for i, _ in kept["line_dedup"]}
    assert {i for i, _ in kept["toxicity"]} <= {r.doc_id for r in own.collect()}
    assert {r.doc_id for r in found["packing"]} == {r.doc_id for r in own.collect()}
    assert sum(r.start == 0 for r in found["packing"]) == own.count()
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, own.limit(0), folder).count() == 0, name


def test_near_copies_by_counted_shingles(spark, folder):
    """Two texts that differ in what no other has, and share what a fiftieth of all has, both stay: by equal weights they are near copies."""
    shared = "common words that many of these texts have at their very end right here"
    words = shared.split()
    near = [" ".join(f"a{i}b{j}" for j in range(30)) + " " + shared for i in range(20)]
    other = [" ".join(f"w{i}x{j}" for j in range(8)) for i in range(978)]
    texts = [f"first {shared}", f"second {shared}", *near, *other]
    assert len(words) - 4 >= 0.8 * (len(words) - 4 + 2)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, folder).select("doc_id").collect()} == set(range(1000))
