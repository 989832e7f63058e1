"""Candidate pairs of near-duplicates."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cartulary.llm import minhash


def test_samples_rule_no_pair_out(spark):
    """Two equal texts under one head meet, however far apart their samples' bits are."""
    sketch = [0] * (minhash.SKETCH // 64)
    rows = [(0, node, node, bits, bits, bits, bits, 100.0, 100.0, 100.0, 0.0, 0, sketch) for node, bits in ((1, 0), (2, -1))]
    fields = "head long, node long, component long, b0 long, b1 long, b2 long, b3 long, head_weight double, weight double, both double, largest double, spare int, sketch array<long>"
    df = spark.createDataFrame(rows, fields)
    assert [tuple(r) for r in minhash._across(df, df, minhash.SIMILARITY).collect()] == [(1, 2)]
    assert minhash._sampled(df.selectExpr("unhex(hex(node)) node", "'a b c d e f' text"), minhash.Weights([], 2)).columns == ["node", "bands"]


def test_every_shingle_is_counted(spark):
    """Documents of rare and common shingles alike, copies included; none are weighed as others of another count."""
    texts = [f"one two three four five six s{i}" for i in range(300)] + [f"only in this one text {i} times" for i in (7, 7, 8)] + [None, "", "a b"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    keyed = docs.select(minhash.text_key(F.col("text")).alias("node"), "text")
    want = Counter(h for t in texts for h in minhash.shingles(t)[0].tolist())
    found = keyed.dropDuplicates(["node"]).join(minhash.drawn_samples(keyed, len(texts)), "node").collect()
    got = {r.text: np.frombuffer(r.df, np.uint32).tolist() for r in found}
    assert got == {t: [want[h] for h in minhash.shingles(t)[0].tolist()] for t in set(texts) if t}
    assert sorted(set(want.values())) == [1, 2, 3, 300]
    assert sorted(minhash.frequent_shingles(docs, len(texts))) == sorted((int(np.uint64(h).astype(np.int64)), n) for h, n in want.items())


def test_rare_shingles_weigh_by_their_count(spark):
    """Two texts that share what a fiftieth of all has are less alike than by equal weights."""
    shared = "common words that many of these texts have at their very end here"
    pair = [f"x{i} y z " + " ".join(f"own{j}" for j in range(13)) + " " + shared for i in range(2)]
    near = [f"first{i} second{i} third{i} fourth{i} fifth{i} {shared}" for i in range(20)]
    other = [" ".join(f"w{i}x{j}" for j in range(8)) for i in range(980)]
    docs = spark.createDataFrame(list(enumerate(pair + near + other)), "doc_id long, text string")
    own = [minhash.shingles(t) for t in pair]
    equal, counted = [(h, n.astype(float)) for h, n in own], []
    df = Counter(h for t in pair + near + other for h in minhash.shingles(t)[0].tolist())
    for h, n in own:
        counted.append((h, minhash.weighed(n, np.array([df[x] for x in h.tolist()]), 1002)))
    least = (minhash.similarity(*equal) + minhash.similarity(*counted)) / 2
    assert minhash.similarity(*equal) > least > minhash.similarity(*counted)
    assert minhash.near_duplicates(docs.where("doc_id < 1002"), least).where("doc_id < 2 and class_id <> doc_id").count() == 0


def test_large_groups_keep_their_near_copies(spark):
    """Copies are near for what they share, however many they are; counted by documents, a text in a large group is not."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    base = [word() for _ in range(204)]
    spots = [[20 * k + 3 * j for k in range(6)] for j in range(4)] + [[34 * k + j for k in range(6)] for j in (1, 5, 9)]
    near = [" ".join(word() if i in own else w for i, w in enumerate(base)) for own in spots]
    texts = [" ".join(base)] * 300 + near * 20 + [" ".join(word() for _ in range(30)) for _ in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df = Counter(h for t in texts for h in minhash.shingles(t)[0].tolist())
    counted = [(h, minhash.weighed(n, np.array([df[x] for x in h.tolist()]), len(texts))) for h, n in map(minhash.shingles, (texts[0], near[0]))]
    least = 0.73
    assert minhash.similarity(*counted) < least < minhash.similarity(*((h, n.astype(float)) for h, n in map(minhash.shingles, (texts[0], near[0]))))
    got = minhash.near_duplicates(docs, least, by_family=True)
    assert got.where(f"doc_id < {300 + 20 * len(near)}").select("class_id").distinct().collect() == [(0,)]
    assert got.where("class_id = doc_id").count() == 2001


def test_families_count_once(spark):
    """A shingle counts once for each family, over all blocks; unlike texts that share a line are families of their own."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    line = " ".join(word() for _ in range(9))
    bases = [[word() for _ in range(120)] for _ in range(3)]
    texts = [" ".join([*b[:i], word(), *b[i:], line]) for b in bases for i in range(0, 40, 2)] + [f"{' '.join(word() for _ in range(20))} {line}" for _ in range(15)] + ["", None, "a"]
    docs = spark.createDataFrame([(t,) for t in [*texts, *texts[:30]]], "text string").repartition(5)
    keyed = docs.select(minhash.text_key(F.col("text")).alias("node"), "text").persist()
    members, total, _ = minhash.families(keyed)
    names = {r.node: r.family for r in members.collect()}
    key = {r.text: bytes(r.node) for r in keyed.collect()}
    family = {t: names.get(key[t], t) for t in texts if t}
    assert total == len(set(family.values())) == 3 + 15 + 1
    want = {}
    for t, own in family.items():
        for h in minhash.shingles(t)[0].tolist():
            want.setdefault(h, set()).add(own)
    found = minhash.drawn_samples(keyed, 400, members)
    got = {r.text: np.frombuffer(r.df, np.uint32).tolist() for r in keyed.dropDuplicates(["node"]).join(found, "node").collect()}
    assert got == {t: [len(want[h]) for h in minhash.shingles(t)[0].tolist()] for t in family}
    assert {1, 18} <= {n for df in got.values() for n in df}
