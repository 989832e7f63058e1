"""MinHash, substrings and lines, against all pairs and planted cases."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartulary.llm import lines, minhash, queries, substrings
from cartulary.llm.common import classes, connected, lower_ascii, shared_buckets, word_hashes, words


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n))


def components(pairs):
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {x: top(x) for x in parent}


def test_connected(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(200, 200 + i) for i in range(1, 50)] + [tuple(rng.sample(range(300, 400), 2)) for _ in range(60)] + [(7, 7)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == components([p for p in pairs if p[0] != p[1]])


def test_classes_lose_no_link(spark):
    """Nodes of a bucket are linked when near; the leader is near to few."""
    rows = [(b, n) for b, members in enumerate([range(0, 40), range(30, 70), [5, 200, 203], [500]]) for n in members]
    near = lambda pairs: pairs.where(F.abs(F.col("a") - F.col("b")) <= 3)
    got = {r.node: r.component for r in classes(shared_buckets(spark.createDataFrame(rows, "bucket long, node long"))[0], lambda nodes: near).collect()}
    assert got == components([(a, b) for m in (range(0, 40), range(30, 70), [5, 200, 203]) for a, b in combinations(m, 2) if b - a <= 3])


def test_word_hashes_follow_words():
    text = "Ünï Word wORD 12 x-y_z 日本 日本\nend 😀."
    hashes, starts, _ = word_hashes(text)
    own = words(text)
    assert len(hashes) == len(own) == len(starts)
    assert all((own[i] == own[j]) == (hashes[i] == hashes[j]) for i, j in combinations(range(len(own)), 2))
    assert all(lower_ascii(text[s:]).startswith(w) for s, w in zip(starts.tolist(), own))


def test_sampling_estimates_weighted_similarity():
    rng = np.random.default_rng(5)
    own = rng.integers(0, 1 << 63, 400, np.uint64)
    wa, wb = rng.integers(1, 4, 300).astype(float), rng.integers(1, 4, 300).astype(float)
    a, b = (np.sort(own[:300]), wa), (np.sort(own[60:360]), wb)
    agree = []
    for i in range(30):
        shift = np.uint64(i * 7919)
        agree.append((minhash.samples(a[0] + shift, a[1]) == minhash.samples(b[0] + shift, b[1])).mean())
    assert abs(np.mean(agree) - minhash.similarity(a, b)) < 0.03


def test_near_duplicates_equal_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rng = random.Random(1)
    base = prose(rng, 300)
    near = []
    for i in range(40):
        own = base.split()
        for _ in range(rng.randint(1, 6)):
            own[rng.randrange(len(own))] = "changed"
        near.append((10_000 + i, " ".join(own)))
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([*near, (20_000, None), (20_001, None), (20_002, ""), (20_003, "!")], "doc_id long, text string")).repartition(3)
    rows = docs.collect()
    weights = minhash.Weights(minhash.frequent_shingles(docs.select("text"), len(rows)), len(rows))
    df = {}
    sets = {}
    for r in rows:
        own, counts = minhash.shingles(r.text)
        sets[r.doc_id] = own, counts
        for h in own.tolist():
            df[h] = df.get(h, 0) + 1
    assert {h: n for h, n in df.items() if n * minhash.RARE > len(rows)}.keys() == set(weights.hashes.tolist())
    weighed = {}
    for i, (own, counts) in sets.items():
        idf = np.array([1 + np.log(min(minhash.RARE, len(rows) / df[h])) for h in own.tolist()])
        weighed[i] = own, counts * idf
        assert np.allclose(weights(own, counts), counts * idf)
    text = {r.doc_id: r.text for r in rows}
    links = [(a, b) for a, b in combinations(sorted(weighed), 2) if text[a] == text[b] or len(weighed[a][0]) and minhash.similarity(weighed[a], weighed[b]) >= 0.8]
    want = components(links)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: want.get(i, i) for i in text} and len(links) > 100
    kept = minhash.one_of_each(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(got.values()))


def test_bound_never_rules_out_a_pair(spark):
    """What two texts share is at most what their differences from a head allow."""
    rng = np.random.default_rng(9)
    head = np.sort(rng.choice(1 << 40, 200, False).astype(np.uint64)), rng.integers(1, 3, 200).astype(float)
    sums, rows = head[1].sum(), []
    spare = rng.choice(1 << 40, 60, False).astype(np.uint64)
    own = []
    for n in range(40):
        keep = rng.random(200) > rng.random() * 0.3
        extra = np.setdiff1d(rng.choice(spare, rng.integers(0, 50), False), head[0])
        h = np.concatenate([head[0][keep], extra])
        w = np.concatenate([head[1][keep] + rng.integers(0, 2, keep.sum()) * (rng.random() < 0.2), np.full(len(extra), 2.0)])
        order = np.argsort(h)
        own.append((h[order], w[order]))
        both, largest, items, sketch = minhash.difference(head, own[-1])
        over = items - int(np.bitwise_count(sketch.view(np.uint64)).sum())
        rows.append((n, float(sums), float(own[-1][1].sum()), both, largest, over, sketch.tolist()))
    df = spark.createDataFrame(rows, "n int, head_weight double, weight double, both double, largest double, spare int, sketch array<long>")
    pairs = df.alias("x").join(df.alias("y"), F.col("x.n") < F.col("y.n"))
    for least in (0.5, 0.7, 0.8, 0.9):
        kept = {tuple(r) for r in pairs.where(minhash._may_share(least)).select("x.n", "y.n").collect()}
        linked = {(a, b) for a, b in combinations(range(40), 2) if minhash.similarity(own[a], own[b]) >= least}
        assert linked <= kept
        assert least < 0.9 or len(kept) < 40 * 39 / 4


def test_narrowed_lines_keep_the_decision():
    """Narrowing keeps the edit distance, and `sure` only where it is allowed."""

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng, sure = random.Random(4), 0
    for _ in range(150):
        a = prose(rng, rng.randint(1, 12)).split()
        b = [w for w in a if rng.random() > 0.1]
        for _ in range(rng.randint(0, 3)):
            b.insert(rng.randint(0, len(b)), rng.choice(["x", "aa", "jjjj"]))
        a, b = " ".join(a), " ".join(b)
        allowed = max(len(a), len(b)) // 5
        x, y, within = lines.narrowed(a, b, allowed)
        assert edits(x, y) == edits(a, b) and (not within or edits(a, b) <= allowed)
        sure += within
    assert sure > 30
    assert lines.narrowed("", "", 0) == ("", "", True) and lines.narrowed("a b", "a b", 0)[2]


def test_minhash_edges(edge_docs, no_docs):
    got = sorted((str(r.doc_id), str(r.class_id), r.n_in_class) for r in minhash.near_duplicates(edge_docs).collect())
    assert [x for x in got if x[0] in "67"] == [("6", "6", 3)] * 2 + [("7", "6", 3)]
    assert ("1", "1", 2) in got and ("None", "1", 2) in got and ("2", "2", 1) in got and len(got) == edge_docs.count()
    kept = minhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == 8
    assert minhash.near_duplicates(no_docs).count() == 0 == minhash.one_of_each(no_docs).count()


def test_substrings(spark):
    rng = random.Random(2)
    passage = prose(rng, 60)
    texts = [f"{prose(rng, 80)} {passage} {prose(rng, 80)}" for _ in range(20)] + [prose(rng, 200) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in substrings.remove_repeats(docs).collect()}
    assert got[0].text == texts[0]
    for i in range(1, 20):
        assert passage in texts[i] and passage not in got[i].text and got[i].n_removed > 150
        assert all(texts[i][x.start : x.end] in passage for x in got[i].removed)
    assert all(got[i].text == texts[i] and not got[i].n_removed for i in range(20, 40))


def test_substrings_equal_plain_digests(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    first, spans = {}, {}
    for i in sorted(texts):
        ends = substrings.cuts(np.frombuffer((texts[i] or "").encode("utf-32-le"), np.uint32)) if texts[i] else []
        for start, end in zip([0, *ends[:-1]], ends):
            if first.setdefault(texts[i][start:end], (i, start)) != (i, start):
                own = spans.setdefault(i, [])
                if own and own[-1][1] == start:
                    own[-1][1] = end
                else:
                    own.append([start, end])
    want = {i: [tuple(x) for x in own if x[1] - x[0] >= substrings.RUN] for i, own in spans.items()}
    for r in queries.op8_substring_dedup(spark, folder).collect():
        assert [tuple(x) for x in r.removed] == want.get(r.doc_id, []), r.doc_id


@pytest.mark.parametrize("size", [0, 1, 15, 16, 17, 5000])
def test_cuts_cover_the_text(size):
    ends = substrings.cuts(np.arange(size, dtype=np.uint32) % 7 * 31)
    assert ends == sorted(set(ends)) and (ends[-1] if ends else 0) == size
    assert all(e - b <= substrings.MOST for b, e in zip([0, *ends[:-1]], ends))


def test_substring_and_line_edges(edge_docs, no_docs):
    for operator in (substrings.remove_repeats, lines.dedup_lines):
        out = operator(edge_docs)
        assert out.columns[: len(edge_docs.columns)] == edge_docs.columns
        texts = [(r.doc_id, r.text) for r in out.collect()]
        assert len(texts) == edge_docs.count() and (1, None) in texts and (2, "") in texts
        assert operator(no_docs).count() == 0
    assert {r.text for r in lines.dedup_lines(edge_docs).where("doc_id = 7").collect()} == {""}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j] + 1, row[j + 1] + 1, last + (x != y))
    return row[-1]


def test_block_hashes_follow_lines():
    """Texts of a block keep to themselves; equal lines, and only they, have equal digests; SimHash is the majority of the different words."""
    rng = random.Random(8)
    long = " ".join(rng.choices([f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)], k=2000))
    texts = ["", "a b c d e", "f\nA  b, C d\u00e9 E 17\n", "", "\n\nx", "y z \u65e5\u672c u v\nx y z z z z\na b c d\u00e9 e 99 \n" + long, " a b c d e\n", ""]
    data = [t.encode() for t in texts]
    begins = np.cumsum([0, *map(len, data)])[:-1]
    got = lines.block_hashes(np.frombuffer(b"".join(data), np.uint8), begins)
    plain = [(i, n, re.sub("[0-9]", "0", " ".join(words(line)))) for i, t in enumerate(texts) for n, line in enumerate(t.split("\n")) if len(words(line)) >= lines.LEAST]
    assert list(zip(got[0].tolist(), got[1].tolist())) == [x[:2] for x in plain] and len(plain) == 9
    digests = [tuple(x) for x in got[2].tolist()]
    assert all((digests[i] == digests[j]) == (plain[i][2] == plain[j][2]) for i, j in combinations(range(9), 2))
    own = {w: int(h) for _, _, line in plain for w in line.split(" ") for h in lines.line_hashes(w, 1)[2]}  # one word's SimHash is its hash
    for (_, _, line), sim in zip(plain, got[3].tolist()):
        kinds = [own[w] for w in set(line.split(" "))]
        assert sim == sum(1 << b for b in range(64) if 2 * sum(k >> b & 1 for k in kinds) > len(kinds))
    assert len(lines.block_hashes(np.empty(0, np.uint8), np.zeros(3, np.int64))[0]) == 0


def test_lines_equal_all_pairs(spark):
    rng = random.Random(4)
    base = [prose(rng, 40) for _ in range(12)]
    texts = []
    for i in range(60):
        own = [prose(rng, 20), rng.choice(base), rng.choice(base).replace("a", "b", rng.randint(0, 2)), "short line here"]
        texts.append("\n".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    places = {(i, n): " ".join(words(line)) for i, t in enumerate(texts) for n, line in enumerate(t.split("\n")) if len(words(line)) >= lines.LEAST}
    sims = {x: int(lines.line_hashes(t)[2][0]) for x, t in places.items()}
    links = [
        (x, y)
        for x, y in combinations(sorted(places), 2)
        if places[x] == places[y]
        or bin(sims[x] ^ sims[y]).count("1") <= lines.DISTANCE
        and levenshtein(places[x], places[y]) <= (1 - lines.SIMILARITY) * max(len(places[x]), len(places[y]))
    ]
    assert any(places[x] != places[y] for x, y in links)
    gone = {x for x, top in components(links).items() if x != top}
    for r in lines.dedup_lines(docs).collect():
        assert set(r.removed_lines) == {n for i, n in gone if i == r.doc_id}
        assert r.text == "\n".join(x for n, x in enumerate(texts[r.doc_id].split("\n")) if n not in set(r.removed_lines))
