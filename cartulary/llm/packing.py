"""Sequence packing by non-negative least squares over the histogram of lengths.

A document (its ids and the end id) is cut into full windows, one piece of whole grains (a grain
is 1/32 of a window) and a last piece under a grain. Full windows are sequences. For the pieces of
whole grains, all combinations of at most four lengths that fill a window are enumerated; how
often each is used comes from non-negative least squares against the histogram, rounded down and
mended so that no length is overdrawn. What is left is packed greedily: first by whole
combinations, then end to end as one stream that is cut at every window. The stream's last
sequences have lengths that are powers of two, which need no padding.

Tokens are made once and written to the shared folder with each row's rank among the pieces of
its task. Sums per task give the ranks over all tasks, so a piece's place is arithmetic: no sort,
no shuffle of tokens, no group in one task, and a bound of 31 x combinations on the driver.

Null text counts as empty: the end id alone. Repeated rows are packed as often as they occur. An
empty table gives no piece. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartulary.llm.fim import pieces
from cartulary.sources.storage import stage

#: The normalizer and pre-tokenizer under which a word's tokens don't depend on other words.
BY_WORD = [
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
]
WINDOW, GRAINS, DEPTH, END = 2048, 32, 4, 1
CACHE = 1_000_000
STAGED = "doc_id long, part long, n long, n_full long, bin int, rank long, fine long, fine_start long, full_start long, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Tokens:
    """Ids of texts, as little-endian integers of `width`.

    Where the tokenizer splits as `BY_WORD` says, white space always ends a token, so each word is looked up
    once; new words of many texts are encoded in one string with a special token between them. The table
    of known words is emptied when it holds `CACHE` of them; results do not depend on it. Texts
    for any other tokenizer, or with special tokens in them, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        self.width = id_width(self.tokenizer)
        specials = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.end_id, self.end = max(specials.items(), default=(None, ""))
        self.marked = all(t.startswith("<|") for t in specials.values())
        rules = json.loads(self.tokenizer.to_str())
        self.by_word = self.marked and self.end_id is not None and [rules["normalizer"], rules["pre_tokenizer"]] == BY_WORD

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.width).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, missing: set[str]) -> None:
        """A full stop or comma after a letter is a token of its own, if the letter stays one when normalised."""
        bare = {w[:-1] if len(w) > 1 and w[-1] in ".," and ends_in_letter(w[:-1]) else w for w in missing} | {".", ","}
        new = [w for w in bare if w not in self.known]
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            [encoded] = self.tokenizer.encode_batch_fast([self.end.join(part)], add_special_tokens=False)
            ids = np.array(encoded.ids, np.int64)
            ends = np.flatnonzero(ids == self.end_id).tolist()
            data, size = ids.astype(self.width).tobytes(), np.dtype(self.width).itemsize
            for word, begin, end in zip(part, [0, *(e + 1 for e in ends)], [*ends, len(ids)]):
                self.known[word] = data[begin * size : end * size]
        for w in missing - bare:
            self.known[w] = self.known[w[:-1]] + self.known[w[-1]]

    def many(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._plain(texts)
        whole = {i for i, text in enumerate(texts) if "<|" in text}  # special tokens depend on the letters' case
        split = [[] if i in whole else text.encode("utf-8", "replace").lower().decode("utf-8").replace("\n", " ").split(" ") for i, text in enumerate(texts)]
        if len(self.known) > CACHE:
            self.known.clear()
        missing = set().union(*split).difference(self.known)
        if missing:
            self._learn(missing)
        found = [b"".join(map(self.known.__getitem__, own)) for own in split]
        for i, ids in zip(sorted(whole), self._plain([texts[i] for i in sorted(whole)])):
            found[i] = ids
        return found

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


@lru_cache(maxsize=1)
def loaded(path: str) -> Tokens:
    """One for all tasks that a Python worker runs."""
    return Tokens(path)


def ends_in_letter(word: str) -> bool:
    last = word[-1]
    return last.isalpha() and (last.isascii() or unicodedata.normalize("NFC", word).lower()[-1].isalpha())


def id_width(tokenizer) -> str:
    """The least type that holds all ids."""
    return "<u2" if max(tokenizer.get_vocab(with_added_tokens=True).values(), default=0) < 1 << 16 else "<u4"


def _tokenised(docs: DataFrame, path: str, window: int, grain: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = loaded(path)
        end, size = np.array([END], tokens.width).tobytes(), np.dtype(tokens.width).itemsize
        part, ranks, fine_sum, full_sum = TaskContext.get().partitionId(), [0] * (window // grain), 0, 0
        names = [f.split()[0] for f in STAGED.split(", ")]
        for batch in batches:
            for piece in pieces(batch, "text"):
                rows, (doc_ids, texts) = [], (c.to_pylist() for c in piece.columns)
                for doc_id, ids in zip(doc_ids, tokens.many([text or "" for text in texts])):
                    ids += end
                    n = len(ids) // size
                    n_full, rest = divmod(n, window)
                    b, fine = divmod(rest, grain)
                    rows.append((doc_id, part, n, n_full, b, ranks[b], fine, fine_sum, full_sum, ids))
                    ranks[b] += 1
                    fine_sum += fine
                    full_sum += n_full
                kinds = [pa.int64()] * 4 + [pa.int32()] + [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, STAGED)


def combinations(total: int, depth: int, most: int | None = None) -> list[list[int]]:
    """All falling lists of at most `depth` lengths with this sum."""
    if total == 0:
        return [[]]
    if depth == 0:
        return []
    return [[x, *rest] for x in range(min(total, most or total - 1), 0, -1) for rest in combinations(total - x, depth - 1, x)]


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least squares with x >= 0, by active sets."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(3 * a.shape[1]):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        if gain.max() <= 1e-9:
            break
        free[gain.argmax()] = True
        while True:
            s = np.zeros_like(x)
            s[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (s <= 1e-12)
            if not low.any():
                break
            step = np.min(x[low] / np.maximum(x[low] - s[low], 1e-300))
            x += step * (s - x)
            free &= x > 1e-12
            x[~free] = 0
        x = s
    return x


def repeat_counts(histogram: np.ndarray, grains: int, depth: int) -> tuple[list[list[int]], list[int]]:
    """Combinations of piece lengths and how often each is used. histogram[b]: pieces of b grains."""
    shapes = combinations(grains, depth)
    a = np.array([np.bincount(s, minlength=grains) for s in shapes], float).T
    left = np.array(histogram, float)
    left[0] = 0
    counts = np.floor(nnls(a, left / max(1, left.sum())) * left.sum() + 1e-6).astype(np.int64)
    use = a.astype(np.int64)
    left = left.astype(np.int64) - use @ counts
    for b in range(grains):  # mend what rounding or the fit overdrew
        for s in np.flatnonzero(use[b]):
            if left[b] < 0 and counts[s]:
                back = min(counts[s], -(left[b] // use[b, s]))
                counts[s] -= back
                left += back * use[:, s]
    for s in sorted(range(len(shapes)), key=lambda i: len(shapes[i])):
        more = min(int(left[b] // use[b, s]) for b in set(shapes[s]))
        if more > 0:
            counts[s] += more
            left -= more * use[:, s]
    return shapes, counts.tolist()


class Plan:
    """Where pieces go: sequences of full windows, then combinations, then the stream."""

    def __init__(self, histogram: list[int], fine: int, full: int, window: int, grains: int, depth: int):
        self.window, self.grain = window, window // grains
        shapes, counts = repeat_counts(np.array(histogram), grains, depth)
        slots: list[list[tuple[int, int, int]]] = [[] for _ in range(grains)]
        used, first = [0] * grains, full
        for shape, count in zip(shapes, counts):
            offset = 0
            for b in shape if count else ():
                slots[b].append((used[b], first, offset))
                used[b] += count
                offset += b * self.grain
            first += count
        self.slots = [(np.array([s[0] for s in own], np.int64), own) for own in slots]
        self.used, self.first, at, self.residual = used, first, fine, []
        for b in range(grains):
            self.residual.append(at)
            at += (histogram[b] - used[b]) * b * self.grain if b else 0
        whole, tail = divmod(at, window)
        self.whole, self.bounds = whole * window, [whole * window]
        for power in range(tail.bit_length() - 1, -1, -1):
            if tail >> power & 1:
                self.bounds.append(self.bounds[-1] + (1 << power))

    def piece(self, b: int, rank: int) -> tuple[int, int] | None:
        """Sequence and offset of a piece in a combination, or None: it is in the stream."""
        if rank >= self.used[b]:
            return None
        begins, own = self.slots[b]
        start, first, offset = own[int(np.searchsorted(begins, rank, "right")) - 1]
        return first + rank - start, offset

    def stream(self, at: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(sequence, offset, length) of what lies at these places of the stream."""
        while length:
            if at < self.whole:
                number, offset = divmod(at, self.window)
                room = self.window - offset
            else:
                k = int(np.searchsorted(self.bounds, at, "right")) - 1
                number, offset, room = self.whole // self.window + k, at - self.bounds[k], self.bounds[k + 1] - at
            size = min(room, length)
            yield self.first + number, offset, size
            at, length = at + size, length - size


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, grains: int = GRAINS, depth: int = DEPTH) -> DataFrame:
    """One row per piece; `ids` are unsigned little-endian 32-bit ids. `tokenizer`: path of its file on every machine."""
    from tokenizers import Tokenizer

    grain, width = window // grains, id_width(Tokenizer.from_file(tokenizer))
    staged, _ = stage(_tokenised(docs, tokenizer, window, grain), "tokens")
    amounts = staged.groupBy("part", "bin").agg(F.count("*").alias("pieces"), F.sum("fine").alias("fine"), F.sum("n_full").alias("full"))
    kinds = F.array(F.struct(F.col("bin").alias("kind"), F.col("pieces").alias("amount")), F.struct(F.lit(grains).alias("kind"), F.col("fine").alias("amount")), F.struct(F.lit(grains + 1).alias("kind"), F.col("full").alias("amount")))
    summed, _ = stage(amounts.select("part", F.explode(kinds).alias("x")).groupBy("part", "x.kind").agg(F.sum("x.amount").alias("amount")), "amounts")
    before = F.sum("amount").over(Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = summed.withColumn("before", F.coalesce(before, F.lit(0))).groupBy("part").agg(*[F.coalesce(F.max(F.when(F.col("kind") == k, F.col("before"))), F.lit(0)).alias(f"o{k}") for k in range(grains + 2)])
    offsets = offsets.select("part", F.array(*[f"o{k}" for k in range(grains + 2)]).alias("before"))
    totals = {r.kind: r.amount for r in summed.groupBy("kind").agg(F.sum("amount").alias("amount")).collect()}
    plan = Plan([totals.get(b, 0) for b in range(grains)], totals.get(grains, 0), totals.get(grains + 1, 0), window, grains, depth)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PIECES.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.binary()]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for r in batch.slice(at, 256).to_pylist():
                    ids, before, n = np.frombuffer(r["ids"], width).astype("<u4"), r["before"], r["n"]
                    cuts = [(before[grains + 1] + r["full_start"] + i, 0, window) for i in range(r["n_full"])]
                    if b := r["bin"]:
                        rank = before[b] + r["rank"]
                        place = plan.piece(b, rank)
                        cuts += [(*place, b * grain)] if place else plan.stream(plan.residual[b] + (rank - plan.used[b]) * b * grain, b * grain)
                    cuts += plan.stream(before[grains] + r["fine_start"], r["fine"])
                    start = 0
                    for number, offset, size in cuts:
                        rows.append((r["doc_id"], start, size, n, number, offset, ids[start : start + size].tobytes()))
                        start += size
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    return staged.join(offsets, "part").mapInArrow(place, PIECES)
