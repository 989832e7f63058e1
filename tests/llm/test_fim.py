"""Fill-in-the-middle against a plain version, exact round trips."""

import hashlib
import random
import re

import numpy as np

from cartulary.llm import fim
from tests.llm.test_documents import same_as_sql

MARK = re.compile("<[PSM]>")


def plain_version(doc_id, text, seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    if not text or MARK.search(text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:i], tokens[i:j], tokens[j:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_equals_sql(spark, folder):
    same_as_sql(spark, folder, "op11_fill_in_middle")


def results(df):
    return [(r.doc_id, r.text, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.restored) for r in df.collect()]


def test_equals_plain_version(spark, monkeypatch):
    rng = random.Random(4)
    parts = ["<P", ">", "<", "P>", "<S>", "a", "Bc", "é", "日本", "😀", " ", "\n", "\x00", "M>", "<M"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(800)] + [None, "", "<", "<P>", "x" * 9000]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = results(fim.restore(fim.transform(docs)))
    assert [(i, t) for i, t, _, _ in got] == rows
    for doc_id, text, found, restored in got:
        assert found == plain_version(doc_id, text) and restored == (text or "")
    assert {f for _, _, (_, f, *_), _ in got} == set(fim.FORMS)


def test_edges(spark, edge_docs, no_docs):
    """Nulls, empties, a long text, repeated rows; columns of other names come back as they were, result names hold results."""
    clashing = edge_docs.selectExpr("*", "'x' as output", "'y' as form", "7 as where", "doc_id as marks")
    rows = fim.restore(fim.transform(clashing)).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_version(r.doc_id, r.text)
        assert r.restored == (r.text or "") and r["where"] == 7 and r.marks == r.doc_id and r.score == "mine"
    assert fim.restore(fim.transform(no_docs)).count() == 0


def test_pieces_cover_all_rows(spark, monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["a" * 5, None, "b" * 30, "", "c", "d" * 3]})
    monkeypatch.setattr(fim, "PIECE", 8)
    sizes = [p.num_rows for p in fim.pieces(batch, "text")]
    assert sizes == [2, 1, 3]


def test_shifts_are_a_permutation():
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 4, (50, 3))
    form = rng.integers(0, 3, 50)
    bounds = np.concatenate([[0], np.cumsum(sizes.sum(1))])
    where, outs, marks = fim.displaced(bounds[:-1], sizes, form, int(bounds[-1]))
    taken = np.concatenate([where, (marks[:, :, None] + np.arange(3)).ravel()])
    assert sorted(taken.tolist()) == list(range(outs[-1]))
