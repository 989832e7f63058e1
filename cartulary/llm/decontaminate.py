"""Benchmark decontamination by a broadcast set of word windows.

The windows of all benchmark items (13 words; the whole item where it is shorter) are numbered
words. A task numbers the words of a text, looks at places where enough known words stand in a
row, compares a rolling hash of the window with the set, and then the window itself, so a hit is
exact. One pass over the texts, no shuffle.

The broadcast set is bounded: at most `block` windows each. A larger benchmark is split into
blocks of items, each scanned in a pass of its own; the hits of a row are then merged.

Null texts and texts without words have no words and no hits; null or empty items have no
windows; repeated items and repeated rows each count as they stand. Columns that share a name
with a result column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import WORD, add_columns, carried, given_back, lower_ascii, row_key, shipped, words
from cartulary.sources.storage import stage

SPAN = 13
BLOCK = 500_000
FIELDS = "n_words long, hit_words array<int>, hit_items array<long>"
PRIME = np.uint64(0x9E3779B97F4A7C15)


class Windows:
    """The windows of some items, by length."""

    def __init__(self, items: list[tuple[int, str]], span: int):
        self.number: dict[str, int] = {}
        self.items: dict[int, dict[bytes, set[int]]] = {}
        for item, text in items:
            own = words(text)
            ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in own], np.int32)
            k = min(span, len(own))
            for i in range(len(own) - k + 1 if k else 0):
                self.items.setdefault(k, {}).setdefault(ids[i : i + k].tobytes(), set()).add(item)
        self.hashes = {k: np.unique(_rolled(np.array([np.frombuffer(w, np.int32) for w in found]).T)) for k, found in self.items.items()}

    def hits(self, own: list[str]) -> tuple[np.ndarray, list[int]]:
        """Positions of hit words, in order, and the items found."""
        n = len(own)
        ids = np.fromiter(map(self.number.get, own, repeat(0)), np.int32, n)
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        hit, items = np.zeros(n, bool), set()
        for k, found in self.items.items():
            at = np.flatnonzero(known[k:] - known[:-k] == k) if n >= k else ()
            if not len(at):
                continue
            at = at[np.isin(_rolled([ids[at + j] for j in range(k)]), self.hashes[k])]
            for i in at.tolist():
                if names := found.get(ids[i : i + k].tobytes()):
                    items |= names
                    hit[i : i + k] = True
        return np.flatnonzero(hit), sorted(items)


def _rolled(columns) -> np.ndarray:
    total = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        total = (total + column.astype(np.uint64)) * PRIME
        total ^= total >> np.uint64(29)
    return total


def _blocks(benchmark: DataFrame, span: int, block: int) -> Iterator[list]:
    """Items in blocks of at most `block` words each, one at a time; a longer item is cut into overlapping parts."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null").toLocalIterator()
    filled, room = [], block
    for item, text in rows:
        own = words(text)
        for i in range(0, max(1, len(own) - span + 1), block):
            part = own[i : i + block + span - 1]
            if len(part) > room and filled:
                yield filled
                filled, room = [], block
            filled.append((item, " ".join(part)))
            room -= len(part)
    yield filled


def _scanned(docs: DataFrame, items: list, span: int) -> DataFrame:
    shared = shipped(docs.sparkSession, Windows(items, span))

    def scan(batch: pa.RecordBatch) -> list:
        windows = shared()
        counts, hits, items = [], [], []
        for text in batch.column("text").to_pylist():
            own = words(text)
            at, found = windows.hits(own)
            counts.append(len(own))
            hits.append(at)
            items.append(found)
        return [pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.int64()))]

    return add_columns(docs, scan, FIELDS)


def scan_benchmark(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, block: int = BLOCK) -> DataFrame:
    """`docs` with n_words, hit_words (positions of words inside a found window) and hit_items."""
    blocks = _blocks(benchmark, span, block)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _scanned(docs, first, span)
    keyed = carried(docs, "doc_id", "text").withColumn("_row", row_key("doc_id", "text"))
    texts = keyed.select("_row", "text").dropDuplicates(["_row"])
    found = None
    for items in chain([first, second], blocks):
        part, _ = stage(_scanned(texts, items, span).where("size(hit_items) > 0").select("_row", "hit_words", "hit_items"), "hits")
        found = part if found is None else found.union(part)
    merged = found.groupBy("_row").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("hit_items"),
    )
    counted = add_columns(keyed, lambda b: [pa.array([len(words(t)) for t in b.column("text").to_pylist()], pa.int64())], "n_words long")
    nothing = {"hit_words": "array<int>", "hit_items": "array<long>"}
    out = counted.join(merged, "_row", "left").withColumns({c: F.coalesce(c, F.array().cast(t)) for c, t in nothing.items()})
    return given_back(out, docs.columns, ("doc_id", "text"), ("n_words", "hit_words", "hit_items"))


def judged(scanned: DataFrame) -> DataFrame:
    """Adds n_hit and contaminated: some word is hit and the hit words are at least a twentieth."""
    n_hit = F.size("hit_words").cast("long")
    return scanned.withColumns({"n_hit": n_hit, "contaminated": (n_hit > 0) & (20 * n_hit >= F.col("n_words"))})


def remove_documents(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """`docs` without the contaminated ones, columns unchanged."""
    scanned = judged(scan_benchmark(docs.withColumn("_whole", F.struct(*[docs[c] for c in docs.columns])).select("_whole", "doc_id", "text"), benchmark, span))
    return scanned.where("not contaminated").select("_whole.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """`docs` with hit words cut out of the text, with what stands between two hit words."""

    def cut(batch: pa.RecordBatch) -> list:
        texts = []
        for text, hits in zip(batch.column("text").to_pylist(), batch.column("hit_words").to_pylist()):
            if hits:
                places = [m.span() for m in WORD.finditer(lower_ascii(text))]
                parts, at, i = [], 0, 0
                while i < len(hits):
                    j = i
                    while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1:
                        j += 1
                    parts.append(text[at : places[hits[i]][0]])
                    at, i = places[hits[j]][1], j + 1
                text = "".join([*parts, text[at:]])
            texts.append(text)
        return [pa.array(texts, pa.string())]

    order = docs.columns
    whole = docs.withColumn("_whole", F.struct(*[docs[c] for c in order])).select("_whole", "doc_id", "text")
    cleaned = add_columns(scan_benchmark(whole, benchmark, span), cut, "_cut string")
    return cleaned.select(*[F.col("_cut").alias(c) if c == "text" else F.col("_whole")[c].alias(c) for c in order])
