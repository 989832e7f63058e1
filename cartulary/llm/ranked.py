"""Ranked lexical search by two trees, exact.

A document's coordinate for a term is its damped frequency, an item's coordinate is the term's weight;
a score is the sum of their products. Items form one tree, the documents of a part another; a node
holds the largest coordinate of its members for each term, so the product of two nodes bounds all
scores between their members. From the roots down, a pair of nodes is dropped where its bound is
below the weakest k-th score of the items under it, and with it the whole batch of pairs. All
figures are whole numbers under 2^53, so that products of float matrices are exact, and a bound equal to a
k-th score is followed, since a smaller doc_id wins ties.

Spark reads the documents once for each block of items (at most `BLOCK` different terms; a benchmark of
today is one block) and writes each document's frequencies of those terms; their statistics are
aggregates over all documents. A second pass over the frequencies walks the trees, task by task, from
floors that `SEEDS` documents give: each item's k-th score among them, which only prunes. A task returns at
most k rows an item. Memory is bounded by `CELLS` coordinates of documents and by the block.

Null and empty texts have no terms, are in no statistics and in no result; items without terms have no
result. Repeated document rows each count and take ranks of their own; repeated items are answered
each. Equal scores are ordered by doc_id, a null one last. Documents' other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartulary.llm.common import shipped, words
from cartulary.sources.storage import drop_path, stage

BEST = 50
BLOCK = 20_000
SEEDS = 4096
CELLS = 4 << 20
FAN = 8
SALTS = 32


class Items:
    """Items of one block and the numbers of their terms."""

    def __init__(self, texts: list[str]):
        self.number: dict[str, int] = {}
        self.terms = [sorted({self.number.setdefault(w, len(self.number)) for w in words(text)}) for text in texts]

    def counted(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """A document's words, the numbers of known terms among them, and how often each stands there."""
        own = words(text)
        known = [i for i in map(self.number.get, own) if i is not None]
        terms, times = np.unique(np.array(known, np.int32), return_counts=True)
        return len(own), terms, times


def maxima(rows: np.ndarray) -> list[np.ndarray]:
    """A tree over the rows in their order: levels from the root down to the rows themselves."""
    levels = [rows]
    while len(levels[0]) > 1:
        levels.insert(0, np.maximum.reduceat(levels[0], np.arange(0, len(levels[0]), FAN)))
    return levels


def children(alive: np.ndarray, n: int, axis: int) -> np.ndarray:
    return np.repeat(alive, FAN, axis)[(slice(None),) * axis + (slice(n),)]


class Search:
    """The items' tree, the corpus figures, and the floors to start from."""

    def __init__(self, items: Items, found: dict[int, int], n_docs: int, n_terms: int, best: int):
        self.best, self.n_docs, self.n_terms = best, n_docs, n_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * found.get(t, 0) + 1))) for t in range(len(items.number))], float)
        own = np.zeros((len(items.terms), len(self.weight)))
        for i, terms in enumerate(items.terms):
            own[i, terms] = self.weight[terms]
        self.order = np.argsort(own.argmax(1), kind="stable")
        self.levels = maxima(own[self.order])
        self.floors = np.zeros(len(own))
        self.rows = max(64, CELLS // max(1, len(self.weight)))

    def lengths(self, words_in: list[int]) -> np.ndarray:
        return np.array([100 - 50 + 50 * n * self.n_docs // self.n_terms for n in words_in], np.int64)

    def coordinates(self, words_in: list[int], sizes: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Documents by terms."""
        row = np.repeat(np.arange(len(sizes)), sizes)
        times = times.astype(np.int64)
        out = np.zeros((len(sizes), len(self.weight)))
        out[row, terms] = 1_000_000_000 * times // (1000 * times + 20 * self.lengths(words_in)[row])
        return out

    def pairs(self, docs: np.ndarray, floors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(item, documents, scores) of all pairs that no bound rules out."""
        order = np.argsort((docs * self.weight).argmax(1), kind="stable")
        doc_levels = maxima(docs[order])
        least = [floors[self.order]]
        for level in self.levels[:0:-1]:
            least.insert(0, np.minimum.reduceat(least[0], np.arange(0, len(level), FAN)))
        i = d = 0
        alive, bounds = np.ones((1, 1), bool), None
        while True:
            rows, columns = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
            if not len(rows):
                return
            bounds = self.levels[i][rows] @ doc_levels[d][columns].T
            kept = alive[np.ix_(rows, columns)] & (bounds > 0) & (bounds >= least[i][rows, None])
            more_docs, more_items = d + 1 < len(doc_levels), i + 1 < len(self.levels)
            if not more_docs and not more_items:
                for r, hits in zip(rows.tolist(), map(np.flatnonzero, kept)):
                    if len(hits):
                        yield int(self.order[r]), order[columns[hits]], bounds[np.searchsorted(rows, r), hits]
                return
            alive = np.zeros_like(alive)
            alive[np.ix_(rows, columns)] = kept
            if more_docs and (not more_items or len(doc_levels) - d >= len(self.levels) - i):
                d += 1
                alive = children(alive, len(doc_levels[d]), 1)
            else:
                i += 1
                alive = children(alive, len(self.levels[i]), 0)


def _ordered(score: np.ndarray, doc_id: np.ndarray, absent: np.ndarray) -> np.ndarray:
    return np.lexsort((doc_id, absent, -score))


class Found:
    """The best of a task's documents so far, for each item."""

    def __init__(self, search: Search):
        self.search, self.floors = search, search.floors.copy()
        self.best = [(np.empty(0), np.empty(0, np.int64), np.empty(0, bool)) for _ in self.floors]

    def look(self, batch: pa.RecordBatch) -> None:
        search = self.search
        terms, times = (batch.column(c).flatten().to_numpy() for c in ("terms", "times"))
        sizes = pc.list_value_length(batch.column("terms")).to_numpy()
        docs = search.coordinates(batch.column("n").to_pylist(), sizes, terms, times)
        ids = batch.column("doc_id")
        absent, ids = ids.is_null().to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
        for item, at, scores in search.pairs(docs, self.floors):
            merged = [np.concatenate([old, new]) for old, new in zip(self.best[item], (scores, ids[at], absent[at]))]
            first = _ordered(*merged)[: search.best]
            self.best[item] = tuple(x[first] for x in merged)
            if len(first) == search.best:
                self.floors[item] = max(self.floors[item], self.best[item][0][-1])

    def rows(self) -> pa.RecordBatch:
        item = np.repeat(np.arange(len(self.best), dtype=np.int32), [len(b[0]) for b in self.best])
        score, doc_id, absent = (np.concatenate([b[j] for b in self.best]) for j in range(3))
        return pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc_id, pa.int64(), mask=absent), pa.array(score.astype(np.int64))], names=["item", "doc_id", "score"])


def _blocks(items: DataFrame, block: int) -> Iterator[list[tuple]]:
    """(item_id, text) in blocks of at most `block` different terms; items without terms are left out."""
    filled, known = [], set()
    for item, text in items.select("item_id", "text").where("text is not null").toLocalIterator():
        own = set(words(text))
        if filled and len(known | own) > block:
            yield filled
            filled, known = [], set()
        if own:
            filled.append((item, text))
            known |= own
    yield filled


def frequencies(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n words, terms, times) of documents with a term."""
    shared = shipped(docs.sparkSession, items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared()
        for batch in batches:
            n, terms, times = zip(*map(items.counted, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))],
                names=["doc_id", "n", "terms", "times"],
            )

    own = docs.select(F.col("doc_id").cast("long"), "text").where("text <> ''")
    return own.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>").where("n > 0")


def scores(counted: DataFrame, search: Search) -> DataFrame:
    """(item, doc_id, score): the best of every task."""
    shared = shipped(counted.sparkSession, search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Found(shared())
        for batch in batches:
            for start in range(0, batch.num_rows, found.search.rows):
                found.look(batch.slice(start, found.search.rows))
        yield found.rows()

    return counted.where("size(terms) > 0").mapInArrow(run, "item int, doc_id long, score long")


def _best(scored: DataFrame, best: int) -> DataFrame:
    """Ranks by item; a first round by salt keeps an item's rows out of one task."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*order)
    fewer = scored.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= best)
    return fewer.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= best)


def _block_ranks(docs: DataFrame, block: list[tuple], best: int) -> DataFrame:
    spark = docs.sparkSession
    items = Items([text for _, text in block])
    counted, at = stage(frequencies(docs, items), "frequencies")
    n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
    found = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect() if n_docs else []
    search = Search(items, {r["term"]: r["count"] for r in found}, n_docs, n_terms or 1, best)
    seeds = _best(scores(counted.limit(SEEDS), search), best).where(F.col("rank") == best).select("item", "score")
    for item, score in seeds.collect():
        search.floors[item] = score
    ranks, _ = stage(_best(scores(counted, search), best).select("item", "rank", "doc_id", "score"), "ranks")
    drop_path(spark, at)
    return ranks


def rank(docs: DataFrame, items: DataFrame, best: int = BEST, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the `best` highest-scoring documents (doc_id, text) for each row of items (item_id, text)."""
    spark, out = docs.sparkSession, None
    for rows in _blocks(items, block):
        named = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(rows)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        part = _block_ranks(docs, rows, best) if rows else spark.createDataFrame([], "item int, rank int, doc_id long, score long")
        part = part.join(named, "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out
