"""Near-duplicate documents by consistent weighted sampling.

A document is the weighted set of its five-word shingles: the weight is the count in the text
times 1 + ln(N / df), where df counts the documents, copies included, or with `by_family` the families that hold the
shingle, of N. A family is a text with
its likely copies: of texts that share one of `KINDRED` plain min-hash keys those with `KIN` of their minima alike, connected. By
families a shingle is common where unlike texts hold it; where each copy counts, what a large group has in common weighs
ever less than what tells its members apart, and they are no near copies for being many. Every shingle is counted.
Texts are dealt to blocks, equal ones to the same; a block sends each of its
different shingles once, in as many slices of the hash space as it has texts on average (those of families of several
texts with the family, which may be in other blocks too), a slice adds the blocks' counts and the different families and
sends each block the sums in the order asked. So a shingle that is in
every text comes once from each block and family, and no table of all shingles is held in one place.

Improved consistent weighted sampling draws `SAMPLES` (shingle, step) pairs from each text; bands
of four are bucket keys. Pairs from shared buckets are verified by the exact weighted Jaccard
similarity, at `SIMILARITY`. Equal texts are one node. Pairs are not formed within a bucket. First each
node meets the head of its bucket, which gives the weight of what it has beyond the head, of what it
lacks and a bitmap of both. Then only nodes outside their head's component meet nodes of other
components under the same head: every link between components has such a node, so none is lost.
What two nodes share follows from those weights but for what both have beyond the head or both
lack, which the bitmaps bound from above, so most pairs are ruled out without their texts, and no linked one.

Texts move only where they have a candidate. A text of fewer than five words is one shingle.
Null texts and texts without words have no shingles and are only alike when equal (null equals
null). A class is named by its smallest doc_id (null only if all are null). Other columns are
ignored; repeated rows are members like any other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import carried, connected, given_back, headed, mixed, packed, shipped, unpacked, word_hashes
from cartulary.sources.storage import drop_path, stage

WIDTH, SIMILARITY, SAMPLES, ROWS = 5, 0.8, 64, 4
#: What N / df counts as at most: there is no limit.
RARE = math.inf
#: Keys of a text that its family shares one of, minima of its shingles in each, and the share of `SAMPLES` minima that is alike in kin.
KINDRED, MINIMA, KIN = 8, 4, 0.6
#: Bits of the bitmap of a text's differences from its head.
SKETCH = 512
_SEEDS = mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_GRID = (np.arange(4096) + 0.5) / 4096


def _gamma_table() -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2 at the midpoints of 4,096 equal parts."""
    x = np.linspace(0, 30, 300_001)
    return np.interp(_GRID, 1 - (1 + x) * np.exp(-x), x).astype(np.float32)


_GAMMA = _gamma_table()


def shingles(text: str | None, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order, and their counts."""
    own = word_hashes(text)[0] if text else np.empty(0, np.uint64)
    if not len(own):
        return own, np.empty(0, np.int64)
    k = min(width, len(own))
    total = np.zeros(len(own) - k + 1, np.uint64)
    for j in range(k):
        total = mixed(total + own[j : len(own) - k + 1 + j])
    return np.unique(total, return_counts=True)


def weighed(counts: np.ndarray, df: np.ndarray, total: int) -> np.ndarray:
    """Weights of shingles that occur `counts` times in a text and are in `df` of `total` texts."""
    return counts * (1 + np.log(total / df))


class Weights:
    """Shingle weights from a table in memory; a shingle that isn't there is in one text."""

    def __init__(self, table: list[tuple[int, int]], total: int):
        order = sorted((h % (1 << 64), df) for h, df in table)
        self.hashes = np.array([h for h, _ in order], np.uint64)
        self.df = np.array([df for _, df in order] + [1], np.int64)
        self.total = total

    def __call__(self, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, own)
        known = np.zeros(len(own), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == own[inside]
        return weighed(counts, self.df[np.where(known, at, len(self.hashes))], self.total)


def samples(own: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """SAMPLES consistent samples as hashes; own must not be empty."""
    best, chosen = np.full(SAMPLES, np.inf, np.float32), np.zeros(SAMPLES, np.uint64)
    for at in range(0, len(own), 1024):
        part = own[at : at + 1024]
        log_w = np.log(weights[at : at + 1024]).astype(np.float32)
        h = part[None, :] * _SEEDS[:, None]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        r = _GAMMA[h & np.uint64(4095)]
        beta = ((h >> np.uint64(12)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(2**-16)
        u = ((h >> np.uint64(28)) & np.uint64(0x3FFFF)).astype(np.float32) + np.float32(0.5)
        u *= (h >> np.uint64(46)).astype(np.float32) + np.float32(0.5)
        t = np.floor(log_w / r + beta)
        cost = np.log(-np.log(u * np.float32(2**-36))) - r * (t - beta + 1)
        least = cost.argmin(1)
        row = np.arange(SAMPLES)
        better = cost[row, least] < best
        best = np.where(better, cost[row, least], best)
        step = t[row, least].astype(np.int64).view(np.uint64)
        chosen = np.where(better, mixed(part[least] + step * np.uint64(0xC2B2AE3D27D4EB4F)), chosen)
    return chosen


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of (hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    return float(shared / max(a[1].sum() + b[1].sum() - shared, 1e-300))


def difference(head: tuple[np.ndarray, np.ndarray], own: tuple[np.ndarray, np.ndarray]) -> tuple[float, float, int, np.ndarray]:
    """Shared weight; the largest single difference, the number of differences and a bitmap of them.

    A difference is a shingle that weighs more in `own` than in the head, or less.
    """
    _, i, j = np.intersect1d(head[0], own[0], assume_unique=True, return_indices=True)
    lack, beyond = head[1].copy(), own[1].copy()
    both = np.minimum(head[1][i], own[1][j])
    lack[i] -= both
    beyond[j] -= both
    size = np.uint64(SKETCH)
    places = np.concatenate([head[0][lack > 0] % size, (own[0][beyond > 0] // size) % size])
    bits = np.zeros(SKETCH, bool)
    bits[places.astype(np.int64)] = True
    return float(both.sum()), float(max(lack.max(initial=0), beyond.max(initial=0))), len(places), np.packbits(bits).view(np.int64)


def _summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys in order, the sum of each one's amounts, and where each of `keys` is among them."""
    if not len(keys):
        return keys, amounts, np.empty(0, np.int64)
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.append(True, ordered[1:] != ordered[:-1])
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return ordered[fresh], np.add.reduceat(amounts[order], np.flatnonzero(fresh)), place


def _slice_bits(total: int) -> int:
    """Slices and texts of a block are both about the root of all texts, so that their messages grow as the texts."""
    return max(4, ((max(total, 1) - 1).bit_length() + 1) // 2)


def _block(total: int) -> Column:
    """The block of a node."""
    blocks = max(1, -(-total // (1 << _slice_bits(total))))
    return F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block")


def _first_places(nodes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each different node is first, and how often it is there."""
    return np.unique(nodes.dictionary_encode().indices.to_numpy(), return_index=True, return_counts=True)[1:]


def _dealt(keyed: DataFrame, total: int) -> DataFrame:
    """(block, node, text, n) of texts that aren't null, n: as often as it is in a batch of rows."""

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, n = _first_places(batch.column("node"))
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(first)).columns, pa.array(n)], names=["block", "node", "text", "n"])

    return keyed.where("text is not null").select(_block(total), "node", "text").mapInArrow(combined, "block int, node binary, text string, n long")


def families(keyed: DataFrame) -> tuple[DataFrame, int, list[str]]:
    """(node, family) of different texts in families of several, the number of all families, and the paths that hold both."""

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.take(pa.array(_first_places(batch.column("node"))[0]))
            found = [(key, shingles(text)[0]) for key, text in zip(*(c.to_pylist() for c in own.columns))]
            found = [(key, *_kindred(own)) for key, own in found if len(own)]
            kinds = zip(zip(*found) if found else ((), (), ()), (pa.binary(), pa.list_(pa.int64()), pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in kinds], names=["node", "bands", "least"])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SAMPLES) for c in ("least", "head_least"))
            yield batch.select(["head", "node"]).filter(pa.array((a == b).mean(1) >= KIN))

    known = keyed.where("text is not null").select("node", "text").mapInArrow(drawn, "node binary, bands array<long>, least binary")
    known, at_known = stage(known.dropDuplicates(["node"]), "kindred")
    shared, heads, paths = headed(known.select(F.explode("bands").alias("bucket"), "node"))
    pairs = shared.join(heads, "bucket").where("node <> head").select("head", "node").distinct()
    pairs = pairs.join(known.select("node", "least"), "node").join(known.select(F.col("node").alias("head"), F.col("least").alias("head_least")), "head")
    found = connected(pairs.select("head", "node", "least", "head_least").mapInArrow(alike, "head binary, node binary"), "head", "node")
    size = found.agg(F.count(F.lit(1)).alias("texts"), F.countDistinct("component").alias("families")).first()
    return found.select("node", F.xxhash64("component").alias("family")), known.count() - size.texts + size.families, [at_known, *paths]


def _asked(dealt: DataFrame, total: int, members: DataFrame | None = None) -> DataFrame:
    """(slice, block, shingles, n, joint, families): different shingles of each block in order, cut into slices, and the rows that hold them.

    With `members` (node, family) each different text counts once, and those of `members` not in n: their shingles are in
    `joint`, once with each family.
    """
    bits, once = _slice_bits(total), members is not None
    if members is None:
        members = dealt.sparkSession.createDataFrame([], "node binary, family long")

    def cut(own: np.ndarray) -> np.ndarray:
        return np.append(np.searchsorted(own >> np.uint64(64 - bits), np.arange(1 << bits, dtype=np.uint64)), len(own))

    def run(texts: pa.Table, members: pa.Table) -> pa.Table:
        known = dict(zip(members["node"].to_pylist(), members["family"].to_pylist()))
        if once:
            texts = texts.take(pa.array(_first_places(texts["node"].combine_chunks())[0]))
        alone, amounts, joint, kin = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for node, text, n in zip(*(texts[c].to_pylist() for c in ("node", "text", "n"))):
            own = shingles(text)[0]
            if node in known:
                joint.append(own)
                kin.append(np.full(len(own), known[node], np.int64))
            else:
                alone.append(own)
                amounts.append(np.full(len(own), 1 if once else n, np.int64))
        own, n, _ = _summed(np.concatenate(alone), np.concatenate(amounts))
        joint, kin = _different(np.concatenate(joint), np.concatenate(kin))
        edges, others = cut(own), cut(joint)
        filled = np.flatnonzero(np.diff(edges) + np.diff(others))
        edges, others = (np.append(x[filled], x[-1]) for x in (edges, others))
        block = np.full(len(filled), texts["block"][0].as_py() if len(texts) else 0, np.int32)
        kinds = {"shingles": packed(own, edges), "n": packed(n.astype(np.uint32), edges), "joint": packed(joint, others), "families": packed(kin, others)}
        return pa.table({"slice": filled.astype(np.int32), "block": block, **kinds})

    sent = members.select(_block(total), "node", "family").groupBy("block")
    return dealt.groupBy("block").cogroup(sent).applyInArrow(run, "slice int, block int, shingles binary, n binary, joint binary, families binary")


def _different(keys: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs in order."""
    order = np.lexsort((others, keys))
    keys, others = keys[order], others[order]
    fresh = np.append(True, (keys[1:] != keys[:-1]) | (others[1:] != others[:-1]))[: len(keys)]
    return keys[fresh], others[fresh]


def _answered(asked: DataFrame) -> DataFrame:
    """(block, slice, df): the rows and families of all blocks for each different one of `shingles` and `joint`, in order."""

    def run(table: pa.Table) -> pa.Table:
        (own, edges), (n, _) = unpacked(table["shingles"], np.uint64), unpacked(table["n"], np.uint32)
        (joint, others), (kin, _) = unpacked(table["joint"], np.uint64), unpacked(table["families"], np.int64)
        once, _ = _different(joint, kin)
        known, sums, _ = _summed(np.append(own, once), np.append(n.astype(np.int64), np.ones(len(once), np.int64)))
        cuts = zip(edges, edges[1:], others, others[1:])
        every = [np.union1d(own[a:b], joint[c:d]) if c < d else own[a:b] for a, b, c, d in cuts]
        df = sums[np.searchsorted(known, np.concatenate(every))].astype(np.uint32)
        return pa.table({"block": table["block"], "slice": table["slice"], "df": packed(df, np.cumsum([0, *map(len, every)]))})

    return asked.groupBy("slice").applyInArrow(run, "block int, slice int, df binary")


def frequent_shingles(texts: DataFrame, total: int) -> list[tuple[int, int]]:
    """(shingle, documents) of all that are in more than total / RARE texts, in memory: for small tables."""

    def run(table: pa.Table) -> pa.Table:
        own, sums, _ = _summed(unpacked(table["shingles"], np.uint64)[0], unpacked(table["n"], np.uint32)[0].astype(np.int64))
        return pa.table({"shingle": own.view(np.int64), "n": sums})

    keyed = texts.select(text_key(F.col("text")).alias("node"), "text")
    counted = _asked(_dealt(keyed, total), total).groupBy("slice").applyInArrow(run, "shingle long, n long")
    return [(r.shingle, r.n) for r in counted.where(F.col("n") * RARE > total).collect()]


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("="), text), F.lit(""))))


def _kindred(own: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Bucket keys of a text's shingles, all alike, and 16 bits of each of their minima; own must not be empty."""
    least = np.min([(own[at : at + 4096] * _SEEDS[:, None]).min(1) for at in range(0, len(own), 4096)], 0)
    total = mixed(np.arange(KINDRED, dtype=np.uint64))
    for column in least[: KINDRED * MINIMA].reshape(-1, MINIMA).T:
        total = mixed(total + column)
    return total.view(np.int64), (mixed(least) >> np.uint64(48)).astype(np.uint16).tobytes()


def _bands(own: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Bucket keys of a text's samples."""
    total = mixed(np.arange(SAMPLES // ROWS, dtype=np.uint64))
    for column in samples(own, weights).reshape(-1, ROWS).T:
        total = mixed(total + column)
    return total.view(np.int64)


def _sampled(texts: DataFrame, weights: Weights) -> DataFrame:
    """(node, bands) by a table of weights."""
    shared = shipped(texts.sparkSession, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = shared()
        for batch in batches:
            drawn = [(key, *shingles(text)) for key, text in zip(*(c.to_pylist() for c in batch.columns))]
            drawn = [(key, _bands(own, weigh(own, counts))) for key, own, counts in drawn if len(own)]
            keys, bands = zip(*drawn) if drawn else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["node", "bands"])

    return texts.mapInArrow(run, "node binary, bands array<long>")


def drawn_samples(keyed: DataFrame, total: int, members: DataFrame | None = None) -> DataFrame:
    """(node, bands, df) of each different text with words; df: documents (with `members`: families) of `total` that hold each
    of its shingles, 32-bit numbers in the shingles' order."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        first, _ = _first_places(texts["node"].combine_chunks())
        found = [(key, *shingles(text)) for key, text in zip(*(texts[c].take(pa.array(first)).to_pylist() for c in ("node", "text")))]
        found = [x for x in found if len(x[1])]
        edges = np.cumsum([0, *(len(own) for _, own, _ in found)])
        every = np.concatenate([np.empty(0, np.uint64), *(own for _, own, _ in found)])
        _, _, place = _summed(every, np.ones(len(every), np.int64))
        df = unpacked(answers.sort_by("slice")["df"], np.uint32)[0][place]
        bands = [_bands(own, weighed(counts, df[a:b], total)) for (_, own, counts), a, b in zip(found, edges, edges[1:])]
        kinds = pa.array([key for key, _, _ in found], pa.binary()), pa.array(bands, pa.list_(pa.int64())), packed(df, edges)
        return pa.table(dict(zip(("node", "bands", "df"), kinds)))

    dealt = _dealt(keyed, total)
    answers = _answered(_asked(dealt, total, members))
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, "node binary, bands array<long>, df binary")


def _may_share(least: float) -> Column:
    """Whether x and y, measured against the same head, can be this similar.

    Shared weight is x's and y's with the head, less the head's, plus what both have beyond it or
    both lack. Common differences are in places set in both bitmaps; a place holds one, and the
    fewer of the two texts' differences beyond one for each place.
    """
    common = sum((F.bit_count(F.expr(f"x.sketch[{i}] & y.sketch[{i}]")) for i in range(SKETCH // 64)), F.least("x.spare", "y.spare"))
    most = F.col("x.both") + F.col("y.both") - F.col("x.head_weight") + common * F.least("x.largest", "y.largest")
    return most * (1 + 1e-9) >= least / (1 + least) * (F.col("x.weight") + F.col("y.weight"))


def _across(outside: DataFrame, beside: DataFrame, least: float) -> DataFrame:
    """(head, node): pairs of different components under one head, all but those that the exact bound rules out."""
    meets = (F.col("x.head") == F.col("y.head")) & (F.col("x.component") != F.col("y.component"))
    more = outside.alias("x").join(beside.alias("y"), meets & _may_share(least))
    return more.select(F.least("x.node", "y.node").alias("head"), F.greatest("x.node", "y.node").alias("node")).distinct()


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, by_family: bool = False) -> DataFrame:
    """(doc_id, text_key, class_id, n_in_class) for each row of `docs`; shingles weigh by the documents or by the families that hold them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("node", text_key(F.col("text")))
    members, total, paths = families(keyed.select("node", "text")) if by_family else (None, rows.count(), [])
    drawn, _ = stage(drawn_samples(keyed.select("node", "text"), total, members), "samples")
    buckets = drawn.select(F.explode("bands").alias("bucket"), "node")

    def with_texts(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("head", "node")).alias("node")).distinct()
        # merged at every size: nodes in pairs grow with the corpus, and so do their texts
        texts = keyed.select("node", "text").join(wanted.hint("merge"), "node", "left_semi").dropDuplicates(["node"])
        texts, _ = stage(texts.join(drawn.select("node", "df").hint("merge"), "node"), "texts")
        both = pairs.join(texts.select("node", F.struct("text", "df").alias("_own")).hint("merge"), "node")
        return both.join(texts.select(F.col("node").alias("head"), F.struct("text", "df").alias("_head")).hint("merge"), "head")

    def compared(pairs: DataFrame, measure: bool) -> DataFrame:
        """Pairs with `linked`, and with the measures that `_may_share` takes."""
        names = pairs.columns
        fields = "linked boolean" + ", head_weight double, weight double, both double, largest double, spare int, sketch array<long>" * measure

        def weighted(known: dict) -> tuple[np.ndarray, np.ndarray]:
            own, counts = shingles(known["text"])
            return own, weighed(counts, np.frombuffer(known["df"], np.uint32), total)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, head = None, None
            for batch in batches:
                out = []
                for key, known_head, known in zip(*(batch.column(c).to_pylist() for c in ("head", "_head", "_own"))):
                    if key != last:
                        last, head = key, weighted(known_head)
                    own = weighted(known)
                    sums = float(head[1].sum()), float(own[1].sum())
                    if measure:
                        both, largest, n, sketch = difference(head, own)
                        linked = both >= least * max(sums[0] + sums[1] - both, 1e-300)
                        out.append((linked, *sums, both, largest, n - int(np.bitwise_count(sketch.view(np.uint64)).sum()), sketch))
                    else:
                        out.append((similarity(head, own) >= least,))
                types = [pa.bool_(), *[pa.float64()] * 4, pa.int32(), pa.list_(pa.int64())] if measure else [pa.bool_()]
                columns = list(zip(*out)) or [()] * len(types)
                added = [pa.array(list(c), t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *added], names=[*names, *(f.split()[0] for f in fields.split(", "))])

        schema = ", ".join(f"{c} {t}" for c, t in pairs.dtypes) + ", " + fields
        return with_texts(pairs).select(*names, "_head", "_own").mapInArrow(run, schema)

    together, heads, at_heads = headed(buckets)
    first, at_first = stage(together.join(heads, "bucket").where("node <> head").select("head", "node").dropDuplicates(["head", "node"]), "pairs")
    measured, at_measured = stage(compared(first, True), "measured")
    edges = measured.where("linked").select("head", "node")
    found = connected(edges, "head", "node")
    named = found.select(F.col("node").alias("head"), F.col("component").alias("first"))
    placed = measured.join(found, "node", "left").join(named, "head", "left")
    placed = placed.withColumns({"component": F.coalesce("component", "node"), "first": F.coalesce("first", "head")}).drop("linked")
    placed, at_placed = stage(placed, "placed")
    outside = placed.where("component <> first")
    beside = placed.join(outside.select("head").distinct(), "head", "left_semi")
    more, at_more = stage(_across(outside, beside, least), "pairs")
    others, _ = stage(compared(more, False).where("linked").select("head", "node"), "links")
    if others.limit(1).count():
        found = connected(edges.union(others), "head", "node")
    for path in (*paths, *at_heads, at_first, at_measured, at_placed, at_more):
        drop_path(docs.sparkSession, path)
    members, _ = stage(keyed.select("doc_id", "node").join(found, "node", "left").select("doc_id", F.col("node").alias("text_key"), F.coalesce("component", "node").alias("component")), "classes")
    named = members.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_in_class"))
    return members.join(named, "component").select("doc_id", "text_key", "class_id", "n_in_class")


def one_of_each(docs: DataFrame, least: float = SIMILARITY, by_family: bool = False) -> DataFrame:
    """`docs` with one row of each class: that of its smallest doc_id; of rows that tie, one."""
    found = near_duplicates(docs, least, by_family)
    heads = found.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class_id", "n_in_class").agg(F.min("text_key").alias("text_key"), F.count("*").alias("n"))
    keyed = carried(docs, "doc_id", "text").withColumns({"_doc": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_text": text_key(F.col("text").cast("string"))})
    heads = heads.select(F.coalesce(F.col("class_id").cast("string"), F.lit("")).alias("_doc"), F.col("text_key").alias("_text"), (F.col("n") > 1).alias("_tied"))
    kept = keyed.join(heads, ["_doc", "_text"])
    tied = kept.where("_tied").dropDuplicates(["_doc", "_text"])
    return given_back(kept.where("not _tied").unionByName(tied), docs.columns, ("doc_id", "text"), ())
