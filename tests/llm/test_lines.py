"""Line dedup against edit similarity alone."""

import random
from itertools import combinations

import numpy as np
import pytest

from cartulary.llm import lines
from tests.llm.test_copies import components, levenshtein, prose


@pytest.mark.parametrize("n", [10, 20, 40])
def test_replaced_words_are_found(spark, n):
    """Pairs of lines that differ in a tenth of their words, whatever their SimHashes."""
    rng, texts = random.Random(n), []
    for _ in range(60):
        own = prose(rng, n).split()
        changed = list(own)
        for i in rng.sample(range(n), n // 10):
            changed[i] = "".join(rng.choices("klmnop", k=len(own[i])))
        texts += [" ".join(own), " ".join(changed)]
    alike = [i for i in range(0, 120, 2) if levenshtein(texts[i], texts[i + 1]) <= (1 - lines.SIMILARITY) * max(len(texts[i]), len(texts[i + 1]))]
    want = {i + 1 for i in alike}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in lines.dedup_lines(docs).collect() if r.removed_lines}
    assert len(want) > 50 and got <= want and len(got) >= 0.95 * len(want)


def test_short_equal_lines_go(spark):
    """Equal lines have no least length, also where a line is one word; other short lines stay."""
    texts = ["Les.\n日本語の文章です\nx", "les\n日本語の文章です\ny", "Les!\n\n...\nDes.", "one two tree\n", "one two three\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.text, r.removed_lines) for r in lines.dedup_lines(docs).collect()}
    assert got[0] == (texts[0], []) and got[1] == ("y", [0, 1]) and got[2] == ("\n...\nDes.", [0])
    data = np.frombuffer("".join(texts[:1]).encode(), np.uint8)
    assert lines.block_hashes(data, np.zeros(1, np.int64))[5].tolist() == [3, 8, 1]


def test_unlike_lines_are_ruled_out():
    """Most pairs of unlike long lines go by the bound, which takes no pair within the edits: typos, moved and added words, any script."""
    rng, a, b = random.Random(6), [], []
    for i in range(150):
        own = rng.choices("abcdeé日 ", k=rng.randint(0, 500))
        changed = list(own)
        for _ in range(int(rng.random() * 0.3 * len(own))):
            at = rng.randrange(len(changed) + 1)
            changed[at : at + rng.randint(0, 2)] = rng.choices("abcdeé日 ", k=rng.randint(0, 2))
        if i % 3 == 0:
            changed += rng.choices("abcde", k=len(own) // 8)
        a.append("".join(own))
        b.append("".join(changed) if i % 2 else prose(rng, len(own) // 6 + 1))
    allowed = np.array([max(len(x), len(y)) // 5 for x, y in zip(a, b)], np.int32)
    out = lines.ruled_out(a, b, allowed)
    links = np.array([levenshtein(x, y) <= k for x, y, k in zip(a, b, allowed.tolist())])
    assert 25 < links.sum() and not (out & links).any()
    long = np.array([min(len(x), len(y)) >= 2 * lines.PIECE for x, y in zip(a, b)])
    assert out[long & ~links].mean() > 0.7


def test_band_keys_are_shared_by_slices(spark):
    """Lines under the same key of the same band are in one bucket; the same key of two bands, and a key of one line, are not."""
    rows = [(d, d * 10, 20, {"bands": [(d * 7919 + i * 104729) % (1 << 31) - (1 << 30) for i in range(lines.BANDS)]}) for d in range(1, 40)]
    rows += [(100 + d, 5, 20, {"bands": [*r[3]["bands"][:2], *(x + d + 1 for x in r[3]["bands"][2:])]}) for d, r in enumerate(rows[:10])]
    rows += [(200, 5, 3, {"bands": []}), (201, 5, 20, {"bands": [rows[0][3]["bands"][5]] * lines.BANDS})]
    unique = spark.createDataFrame(rows, "d1 long, sim long, chars int, place struct<bands array<int>>").repartition(3)
    by = {}
    for d, *_, place in rows:
        for k in enumerate(place["bands"]):
            by.setdefault(k, set()).add(d)
    got = {}
    for r in lines._shared(unique)[0].collect():
        got.setdefault(r.bucket, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in by.values() if len(x) > 1)


def test_short_lines_meet_their_near_copies(spark):
    """Lines of four to nine characters within one edit of each other, whatever their words and script, against all pairs."""
    rng, texts = random.Random(13), []
    for n in [4, 5, 5, 6, 7, 8, 8, 9] * 6:
        own = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz\u65e5\u672c\u8a9e\u00e9", k=n))
        if n > 6:
            own = own[:3] + " " + own[4:]
        at = rng.randrange(n)
        new = rng.choice("vwxyz\u00fc")
        texts += [own, rng.choice([own[:at] + new + own[at + 1 :], own[:at] + new + own[at:]])]
    places = [" ".join(t.split()) for t in texts]
    near = lambda a, b: a == b or max(map(len, (a, b))) <= 9 and levenshtein(a, b) <= max(map(len, (a, b))) // 5
    pairs = [(i, j) for i, j in combinations(range(len(places)), 2) if near(places[i], places[j])]
    links = components(pairs)
    docs = spark.createDataFrame([(i, f"{t}! -- \n{i * 'z'} {'q' * i}") for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in lines.dedup_lines(docs).collect() if 0 in r.removed_lines}
    assert got >= {x for x, top in links.items() if x != top} and len(pairs) > 30
    assert lines.shortest(0.8) == 4 and len(lines.short_keys("a\u00e9b".encode())) == 4
