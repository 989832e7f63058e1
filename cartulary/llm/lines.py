"""Fuzzy line dedup.

A line is normalised to its words (A-Z lower-cased, digits as 0) and given a 128-bit digest and a
64-bit SimHash of its different words. Lines without words are left alone. Equal lines are one node, however short. `BANDS`
keys of `ROWS` minima over a line's different words name candidates, of all lines but those too short to be alike unless equal. Lines of up to
`SHORT` characters, which one edit may tell apart, are also candidates where they are equal, or one is like the other, after a character of either is left out:
all such pairs are found. Candidates that are
alike in length and whose SimHashes differ in at most `DISTANCE` bits (or that are both short) are verified by edit similarity, first by an alignment of words that may already
be good enough, else exactly on what differs. Longer candidates are found by whole words, so not every pair that meets `SIMILARITY` is: the README has the
measured recall. It is high where words are replaced and low where typos are in most words. Of a connected
group of lines one occurrence stays: the first place in the document with the smallest doc_id.

Digests are shuffled, not lines; texts once, for lines with a candidate. Buckets are worked off as
`common.classes` says, without pairs among lines that are already together. Groups are joined to
occurrences, so a line in a third of the documents is a skewed join, not a hot task.

Null text stays null; a text that loses lines keeps the others in order. Rows that share a doc_id
count as one document; a null doc_id is the largest. Other columns stay; same-named ones are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import Verified, add_columns, carried, classes, given_back, mixed, packed, powers, row_key, unpacked
from cartulary.sources.storage import drop_path, stage

LEAST, DISTANCE, SIMILARITY = 1, 20, 0.8
#: Most characters of a line whose pairs are found by leaving out a character: up to here `SIMILARITY` allows one edit.
SHORT = 9
#: Keys of a line that candidates share one of, and minima of its different words in each.
BANDS, ROWS = 12, 4
_SEEDS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
#: Characters of the pieces that bound an edit distance, one for each bit of a word; pieces that are bounded side by side, as few as are worth it, and cells of a matrix of them.
PIECE, GROUP, FEWEST, CELLS = 64, 2048, 64, 1 << 20
#: Lines for each slice of the key space.
SLICE = 200_000
NOBODY = (1 << 63) - 1
BLOCK_BYTES = 1 << 18
LINES = "row long, doc long, pos int, d1 long, d2 long, sim long, chars int, bands array<int>"


def normal_line(line: Column) -> Column:
    lower = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
    return F.trim(F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _values() -> np.ndarray:
    """Value of each UTF-8 byte in a word (A-Z lower-cased, digits as 0); 0 for bytes between words."""
    byte = np.arange(256)
    upper, digit = (byte >= 65) & (byte <= 90), (byte >= 48) & (byte <= 57)
    inside = upper | digit | ((byte >= 97) & (byte <= 122)) | (byte >= 128)
    return np.where(inside, np.where(digit, 48, byte + 32 * upper), 0).astype(np.uint8)


_VALUE = _values()
#: A byte's bits, each in a byte of its own: sums of up to 255 such words don't run over.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64)[:, 0]


def _sim_hashes(kinds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """SimHash of each line; kinds: the lines' different words one after the other, counts: how many each has."""
    pieces = -(-counts // 255)
    firsts = np.cumsum(pieces) - pieces
    within = np.arange(pieces.sum()) - np.repeat(firsts, pieces)
    begins = np.repeat(np.cumsum(counts) - counts, pieces) + 255 * within
    octets = kinds.view(np.uint8).reshape(-1, 8)
    sums = np.stack([np.add.reduceat(_LANES[octets[:, i]], begins) for i in range(8)], 1).view(np.uint8)
    if len(begins) > len(counts):
        sums = np.add.reduceat(sums, firsts, axis=0, dtype=np.int64)
    return np.packbits(sums.astype(np.int64) > (counts // 2)[:, None], axis=1).view(np.uint64)[:, 0]


def _bands(kinds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """BANDS 32-bit keys of each line: of ROWS minima over its different words each. Arguments as of `_sim_hashes`."""
    at = np.cumsum(counts) - counts
    keys = np.empty((len(counts), BANDS), np.uint32)
    for i in range(BANDS):
        total = np.full(len(counts), i, np.uint64)
        for seed in _SEEDS[i * ROWS : (i + 1) * ROWS]:
            total = mixed(total + np.minimum.reduceat(kinds * seed, at))
        keys[:, i] = total >> np.uint64(32)
    return keys


def shortest(similarity: float) -> int:
    """Characters of the shortest line that can be this similar to another than its equals."""
    return max(1, math.ceil(1 / max(1 - similarity, 1e-9) - 1e-6) - 1)


@lru_cache(1 << 16)
def short_keys(line: bytes) -> tuple[int, ...]:
    """32-bit keys of a line and of what is left of it without one of its characters."""
    own = line.decode("utf-8", "replace")
    every = {own, *(own[:i] + own[i + 1 :] for i in range(len(own)))}
    return tuple({zlib.crc32(x.encode("utf-8", "replace")) for x in every})


def block_hashes(data: np.ndarray, begins: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Text, number, 128-bit digest (two columns), SimHash, band keys, characters and `short_keys` (long lines: none) of each line with enough words.

    data: UTF-8 bytes of texts one after the other; begins: where each of them begins.
    """
    value = _VALUE[data]
    inside = value != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    filled = begins[begins < len(data)]
    first[filled] = inside[filled]
    starts = np.flatnonzero(first)
    breaks = np.flatnonzero(data == 10) + 1
    edges = np.searchsorted(starts, np.unique(np.concatenate([begins, breaks])))
    counts = np.diff(edges, append=len(starts))
    long = counts >= max(least, 1)
    if not long.any():
        none = np.empty(0, np.int64)
        return none, none, np.empty((0, 2), np.uint64), np.empty(0, np.uint64), np.empty((0, BANDS), np.uint32), none, []
    up, down = powers(len(data))
    own = mixed(np.add.reduceat(value * up, starts) * down[starts])[np.repeat(long, counts)]
    letters = np.add.reduceat((inside & (data & 0xC0 != 0x80)).astype(np.int64), starts)[np.repeat(long, counts)]
    places, counts, ends = starts[edges[long]], counts[long], (edges + counts)[long]
    text = np.searchsorted(begins, places, "right") - 1
    number = np.searchsorted(breaks, places, "right") - np.searchsorted(breaks, begins[text], "right")
    at = np.cumsum(counts) - counts
    place = (np.arange(len(own)) - np.repeat(at, counts)).astype(np.uint64)
    digests = np.stack([mixed(np.add.reduceat(mixed(own + place * np.uint64(p)), at)) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)], 1)
    keys = mixed(own + np.repeat(np.arange(len(at), dtype=np.uint64), counts) * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(keys)
    keys = keys[order]
    fresh = np.zeros(len(own), bool)
    fresh[order[np.append(True, keys[1:] != keys[:-1])]] = True
    kinds, different = own[fresh], np.add.reduceat(fresh, at, dtype=np.int64)
    sizes = np.add.reduceat(letters, at) + counts - 1
    short = [()] * len(sizes)
    for i in np.flatnonzero(sizes <= SHORT).tolist():
        to = min(starts[ends[i] - 1] + 4 * SHORT, starts[ends[i]] if ends[i] < len(starts) else len(data))
        short[i] = short_keys(b" ".join([w for w in value[places[i] : to].tobytes().split(b"\0") if w][: counts[i]]))
    return text, number, digests, _sim_hashes(kinds, different), _bands(kinds, different), sizes, short


def line_hashes(text: str, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Number, digest, SimHash, band keys, characters and short keys of each line of one text."""
    return block_hashes(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), np.zeros(1, np.int64), least)[1:]


def hashed_lines(docs: DataFrame, least: int = LEAST, similarity: float = SIMILARITY) -> DataFrame:
    """A row for each line with words; its bands are those of its words, then those it has for being short."""
    compared = shortest(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").fill_null("").cast(pa.large_string())
            rows, docs = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "doc"))
            _, ends, data = texts.buffers()
            ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
            at = 0
            while at < len(texts):  # whole texts, about BLOCK_BYTES at a time
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK_BYTES, "right")) - 1)
                text, number, digests, sims, bands, sizes, short = block_hashes(data[ends[at] : ends[to]], ends[at:to] - ends[at], least)
                halves = digests.view(np.int64)
                columns = [rows[at:to][text], docs[at:to][text], number.astype(np.int32), halves[:, 0].copy(), halves[:, 1].copy(), sims.view(np.int64), sizes.astype(np.int32)]
                near = sizes >= compared
                edges = np.append(0, np.cumsum(near * (BANDS + np.fromiter(map(len, short), np.int64, len(short)))))
                own = np.empty(edges[-1], np.uint32)
                own[edges[:-1][near][:, None] + np.arange(BANDS)] = bands[near]
                for i in np.flatnonzero(near & (sizes <= SHORT)).tolist():
                    own[edges[i] + BANDS : edges[i + 1]] = short[i]
                keys = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(own.view(np.int32)))
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], keys], names=["row", "doc", "pos", "d1", "d2", "sim", "chars", "bands"])
                at = to

    own = docs.select(row_key("doc_id", "text").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NOBODY)).alias("doc"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, LINES)


def _shared(unique: DataFrame) -> tuple[DataFrame, str]:
    """(bucket, node, sim, chars) of lines that share a band key with another one, and the path that holds them.

    The space of keys is cut into slices. Lines are sent to them as arrays of keys and nodes, and a slice gives back
    what it has twice, so most keys are never rows.
    """
    keyed = unique.where(F.size("place.bands") > 0).select("d1", "place.bands")
    slices = max(64, unique.count() // SLICE)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("bands").flatten().to_numpy().view(np.uint32)
            counts = batch.column("bands").value_lengths().to_numpy()
            place = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = (keys.astype(np.uint64) * np.uint64(slices)) >> np.uint64(32)
            order = np.argsort(at, kind="stable")
            filled, edges = np.unique(at[order], return_index=True)
            edges = np.append(edges, len(order))
            nodes = np.repeat(batch.column("d1").to_numpy(), counts)[order]
            band = np.minimum(place, BANDS).astype(np.uint8)[order]
            columns = [pa.array(filled.astype(np.int32)), packed(keys[order], edges), packed(band, edges), packed(nodes, edges)]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "keys", "bands", "nodes"])

    def run(table: pa.Table) -> pa.Table:
        keys, band, nodes = (unpacked(table[c], kind)[0] for c, kind in (("keys", np.uint32), ("bands", np.uint8), ("nodes", np.int64)))
        bucket = (band.astype(np.int64) << 32) | keys
        order = np.argsort(bucket)
        bucket = bucket[order]
        same = bucket[1:] == bucket[:-1]
        twice = np.append(False, same) | np.append(same, False)
        return pa.table({"bucket": bucket[twice], "node": nodes[order[twice]]})

    found = keyed.mapInArrow(sent, "slice int, keys binary, bands binary, nodes binary").groupBy("slice").applyInArrow(run, "bucket long, node long")
    return stage(found.join(unique.select(F.col("d1").alias("node"), "sim", "chars"), "node"), "shared")


def _allowed(similarity: float, a: str | Column, b: str | Column) -> Column:
    """Edits that two lines of these lengths may differ in."""
    return F.floor(F.lit(1 - similarity) * F.greatest(a, b) + 1e-9).cast("int")


def narrowed(a: str, b: str, allowed: int) -> tuple[str, str, bool]:
    """What differs between two lines' common start and end, and whether an alignment of words is within `allowed` edits."""
    x, y = ([w + " " for w in line.split(" ")] for line in (a, b))
    n = min(len(x), len(y))
    start = next((i for i in range(n) if x[i] != y[i]), n)
    end = next((i for i in range(n - start) if x[-1 - i] != y[-1 - i]), n - start)
    x, y = x[start : len(x) - end], y[start : len(y) - end]
    if len(x) == len(y) and sum(max(len(v), len(w)) - 1 for v, w in zip(x, y) if v != w) <= allowed:
        return "".join(x), "".join(y), True
    steps = SequenceMatcher(None, x, y).get_opcodes()
    cost = sum(max(sum(map(len, x[i:j])), sum(map(len, y[k:m]))) for kind, i, j, k, m in steps if kind != "equal")
    return "".join(x), "".join(y), cost <= allowed


def _codes(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all lines one after the other as numbers under 63, equal ones alike; where each line begins, and its length."""
    sizes = np.array([len(line) for line in lines], np.int64)
    return (np.frombuffer("".join(lines).encode("utf-32-le", "replace"), np.uint32) % 63).astype(np.uint8), np.cumsum(sizes) - sizes, sizes


def _least_edits(piece: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Least edit distance of each row of `piece` (PIECE numbers) to any part of its row of `window`; 63 there is like nothing.

    Myers' bit vectors, one for each row: a column of the table of distances is its differences, up and down.
    """
    rows = len(piece)
    base = np.arange(rows) * 64
    where = np.zeros(rows * 64, np.uint64)
    for i in range(PIECE):
        where[base + piece[:, i]] |= np.uint64(1 << i)
    one, top = np.uint64(1), np.uint64(PIECE - 1)
    up, down = np.full(rows, (1 << 64) - 1, np.uint64), np.zeros(rows, np.uint64)
    cost = np.full(rows, PIECE, np.uint64)
    best = cost.copy()
    equal, level, more, less, bit = (np.empty(rows, np.uint64) for _ in range(5))
    for place in np.ascontiguousarray(window.T) + base:
        np.take(where, place, out=equal)
        np.bitwise_and(equal, up, out=level)
        level += up
        level ^= up
        level |= equal
        np.bitwise_or(level, up, out=more)
        np.invert(more, out=more)
        more |= down
        np.bitwise_and(up, level, out=less)
        cost += np.right_shift(more, top, out=bit)
        cost -= np.right_shift(less, top, out=bit)
        np.minimum(best, cost, out=best)
        more <<= one
        less <<= one
        equal |= down
        np.bitwise_or(equal, more, out=up)
        np.invert(up, out=up)
        up |= less
        np.bitwise_and(more, equal, out=down)
    return best.view(np.int64)


def ruled_out(a: list[str], b: list[str], allowed: np.ndarray) -> np.ndarray:
    """Which pairs surely differ in more than `allowed` edits; the others are undecided.

    An alignment within the edits gives each piece of a line a part of the other one that begins and ends at most half of
    them off the difference in length, so the least edits of the pieces add up to a lower bound. Pairs that stay well
    below it by their first pieces are left undecided, and so are the last few. Pairs with too few of a like length to go side by side go with longer ones.
    """
    (text, at, size), (other, begin, length) = _codes(a), _codes(b)
    text, other = np.append(text, np.uint8(63)), np.append(other, np.uint8(63))
    allowed = allowed.astype(np.int64)
    longer = length - size
    out = np.abs(longer) > allowed
    kind = np.where(out | (size < 2 * PIECE), -1, (4 * np.log2(np.maximum(allowed, 1))).astype(np.int64))
    total, seen = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    groups, rows = [], np.empty(0, np.int64)
    for own in np.unique(kind[kind >= 0]):
        rows = np.append(rows, np.flatnonzero(kind == own))
        if (size[rows] // PIECE).sum() >= FEWEST:
            groups, rows = [*groups, rows], rows[:0]
    if len(rows):
        groups[-1:] = [np.concatenate([*groups[-1:], rows])]
    for rows in groups:
        side = max(FEWEST, min(GROUP, CELLS // (PIECE + int(allowed[rows].max()))))
        for live in np.array_split(rows, -(-len(rows) // side)):
            while len(live):
                several = max(1, side // len(live))
                start = seen[live][:, None] + PIECE * np.arange(several)
                pair, k = np.nonzero(start + PIECE <= size[live][:, None])
                if len(pair) < FEWEST:
                    break
                start, pair = start[pair, k], live[pair]
                low = np.maximum(start - (allowed[pair] - longer[pair]) // 2, 0)
                high = np.minimum(start + PIECE + (allowed[pair] + longer[pair]) // 2, length[pair])
                place = low[:, None] + np.arange(max(int((high - low).max()), 1))
                window = np.where(place < high[:, None], other[np.minimum(begin[pair][:, None] + place, len(other) - 1)], np.uint8(63))
                edits = _least_edits(text[(at[pair] + start)[:, None] + np.arange(PIECE)], window)
                total += np.bincount(pair, edits, len(a)).astype(np.int64)
                seen[live] += PIECE * several
                out[live] = total[live] > allowed[live]
                live = live[~out[live] & (seen[live] + PIECE <= size[live]) & (total[live] * size[live] >= 0.7 * allowed[live] * seen[live])]
    return out


def _undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that aren't ruled out: what differs between their lines, and whether it is surely little enough."""
    for batch in batches:
        whole = [batch.column(c).to_pylist() for c in ("whole_a", "whole_b")]
        kept = np.flatnonzero(~ruled_out(*whole, batch.column("allowed").to_numpy()))
        own = batch.select(["a", "b", "allowed"]).take(pa.array(kept))
        found = [narrowed(whole[0][i], whole[1][i], k) for i, k in zip(kept.tolist(), own.column("allowed").to_pylist())]
        a, b, sure = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([*own.columns, pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(sure, pa.bool_())], names=[*own.schema.names, "line_a", "line_b", "sure"])


def near_lines(docs: DataFrame, unique: DataFrame, similarity: float = SIMILARITY, distance: int = DISTANCE) -> DataFrame:
    """(node, component) of different lines that belong together; a node is the first half of a line's digest."""
    texts = docs.select(row_key("doc_id", "text").alias("row"), "text")

    def verifier(nodes: DataFrame) -> Verified:
        """Fetches the lines of all nodes once."""
        places = unique.join(nodes, F.col("d1") == F.col("node")).select("node", "place.row", "place.pos")
        found = texts.join(places, "row").select("node", normal_line(F.get(F.split("text", "\n"), F.col("pos"))).alias("line"))
        found, _ = stage(found.dropDuplicates(["node"]), "line-texts")

        def near(pairs: DataFrame) -> DataFrame:
            both = pairs
            for x in "ab":
                both = both.join(found.select(F.col("node").alias(x), F.col("line").alias(f"whole_{x}")), x)
            allowed = _allowed(similarity, F.length("whole_a"), F.length("whole_b"))
            both = both.select("a", "b", "whole_a", "whole_b", allowed.alias("allowed"))
            both = both.mapInArrow(_undecided, "a long, b long, allowed int, line_a string, line_b string, sure boolean")
            return both.where("sure or levenshtein(line_a, line_b, allowed) >= 0").select("a", "b")

        return near

    # lines whose lengths differ in more than the allowed edits are never links
    alike = F.abs(F.col("x.chars") - F.col("y.chars")) <= _allowed(similarity, "x.chars", "y.chars")
    both_short = F.greatest("x.chars", "y.chars") <= SHORT
    alike &= both_short | (F.bit_count(F.col("x.sim").bitwiseXOR(F.col("y.sim"))) <= distance)
    shared, at_shared = _shared(unique)
    found = classes(shared, verifier, ("sim", "chars"), alike)
    drop_path(docs.sparkSession, at_shared)
    return found


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, least: int = LEAST) -> DataFrame:
    """`docs` with repeated lines cut out of the text, n_lines, and removed_lines (their numbers, from 0)."""
    occurrences, _ = stage(hashed_lines(docs, least, similarity), "lines")
    unique = occurrences.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min("doc").alias("doc"), F.max("sim").alias("sim"), F.max("chars").alias("chars"), F.min(F.struct("row", "pos", "bands")).alias("place"))
    unique, _ = stage(unique, "unique-lines")
    together = near_lines(docs, unique, similarity)
    grouped = unique.join(together.withColumnRenamed("node", "d1"), "d1", "left")
    own = F.struct(F.coalesce("component", "d1").alias("node"), F.when(F.col("component").isNull(), F.col("d2")).otherwise(F.lit(0)).alias("rest"))
    grouped = grouped.select("d1", "d2", own.alias("group"), "n", "doc")
    repeated = grouped.groupBy("group").agg(F.sum("n").alias("n"), F.min("doc").alias("keeper")).where("n > 1").drop("n")
    repeated, _ = stage(grouped.select("d1", "d2", "group").join(repeated, "group"), "repeated-lines")
    found = occurrences.join(repeated, ["d1", "d2"]).groupBy("row").agg(F.collect_set(F.struct("pos", "group", (F.col("doc") == F.col("keeper")).alias("own"))).alias("_found"))
    joined = carried(docs, "doc_id", "text").withColumn("_row", row_key("doc_id", "text")).join(found.withColumnRenamed("row", "_row"), "_row", "left")

    def cut(batch: pa.RecordBatch) -> list:
        texts, counts, removed = [], [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("_found").to_pylist()):
            own = text.split("\n") if text is not None else []
            gone, seen, last = [], set(), -1
            for x in sorted(found or [], key=lambda x: x["pos"]):
                if x["pos"] == last:
                    continue
                last = x["pos"]
                group = (x["group"]["node"], x["group"]["rest"])
                if x["own"] and group not in seen:
                    seen.add(group)
                else:
                    gone.append(last)
            drop = set(gone)
            texts.append("\n".join(line for i, line in enumerate(own) if i not in drop) if drop else text)
            counts.append(len(own))
            removed.append(gone)
        return [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.list_(pa.int32()))]

    out = add_columns(joined, cut, "_cut string, n_lines long, removed_lines array<int>")
    return given_back(out.withColumn("text", F.col("_cut")), docs.columns, ("doc_id", "text"), ("n_lines", "removed_lines"))
