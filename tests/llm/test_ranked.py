"""Ranked search against brute force; what bounds rule out."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from cartulary.llm import ranked
from tests.llm.test_documents import plain_words, same_as_sql


def brute_force(docs, items, best):
    """Rows by the contract's formula; docs and items: (id, text)."""
    counted = [(i, Counter(plain_words(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    out = []
    for item, text in items:
        weights = {}
        for t in set(plain_words(text)):
            df = sum(t in c for _, c in counted)
            weights[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        scored = []
        for i, c in counted:
            m = 100 - 50 + 50 * c.total() * n_docs // n_terms
            score = sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t, w in weights.items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:best], 1)]
    return out


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=lambda r: (r[0], r[1]))


def test_equals_sql(spark, folder):
    same_as_sql(spark, folder, "op12_ranked_search")


def test_equals_brute_force(spark, monkeypatch):
    """Many ties, small trees, several blocks of items."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary[: rng.randrange(2, 60)], k=rng.randrange(0, 30)))) for i in rng.sample(range(900), 700)]
    docs += [(i, "w1 w2 w3") for i in range(1000, 1080)]
    items = [(i, " ".join(rng.choices(vocabulary, k=8))) for i in range(30)]
    monkeypatch.setattr(ranked, "SEEDS", 100)
    monkeypatch.setattr(ranked, "CELLS", 64)
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(brute_force(docs, items, 20))
    assert found(ranked.rank(*frames, best=20)) == expected
    assert found(ranked.rank(*frames, best=20, block=25)) == expected


def test_edges(spark, edge_docs, no_docs):
    """Null, empty and very long texts, repeated rows, null ids, columns of clashing names, empty tables."""
    rows = [(1, "same TEXT again"), (1, "same TEXT again"), (2, None), (3, ""), (4, "w29999 word Some"), (5, "absent")]
    items = spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' as score", "1 as item")
    docs = edge_docs.selectExpr("*", "'x' as terms", "3 as item", "4 as rank")
    plain = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert found(ranked.rank(docs, items)) == sorted(brute_force(plain, rows, 50), key=lambda r: (r[0], r[1]))
    assert ranked.rank(no_docs, items).count() == 0
    assert ranked.rank(edge_docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked.rank(edge_docs, items.where("item_id = 3")).count() == 0


def test_bounds_rule_out_batches():
    """With floors, most pairs are never scored, and what is left out is below the floor."""
    rng = np.random.default_rng(5)
    topics = [[f"t{k}w{i}" for i in range(30)] for k in range(16)]
    items = ranked.Items([" ".join(rng.choice(topics[k], 8)) for k in range(16) for _ in range(4)])
    texts = [" ".join(rng.choice(topics[k], 20)) for k in rng.integers(0, 16, 1000)]
    counted = [items.counted(t) for t in texts]
    search = ranked.Search(items, Counter(int(t) for _, terms, _ in counted for t in terms), 1000, 20_000, 10)
    batch = pa.RecordBatch.from_pydict({"doc_id": range(1000), "n": [20] * 1000, "terms": [c[1] for c in counted], "times": [c[2] for c in counted]})
    first = ranked.Found(search)
    first.look(batch)
    search.floors = first.floors
    docs = search.coordinates([20] * 1000, np.array([len(c[1]) for c in counted]), *(np.concatenate([c[j] for c in counted]) for j in (1, 2)))
    own = np.array([[float(t in terms) for t in range(len(items.number))] for terms in items.terms]) * search.weight
    exact = own @ docs.T
    scored = np.zeros(exact.shape, bool)
    for item, at, scores in search.pairs(docs, search.floors):
        assert (scores == exact[item, at]).all()
        scored[item, at] = True
    assert scored.mean() < 0.02
    assert not ((exact >= search.floors[:, None]) & (exact > 0) & ~scored).any()
