"""Substring dedup by content-defined chunks.

A gear hash rolls over the last 16 characters of a text; a chunk ends where its top bits are zero,
with a least and a greatest length. Ends depend on nearby characters alone, so chunks find step
again after an insertion. Chunks are compared by a 128-bit digest. Of a chunk that repeats, the
first place in the document with the smallest doc_id stays. Removed are runs of repeated chunks of
at least `run` characters, so that a short common phrase leaves a document as it is.

Digests are grouped (counts combine first, so a passage in a third of the documents is no hot
task) and joined back to the chunks; only a document's own chunks are gathered, by document.

Null text stays null, text shorter than `run` is never changed. Rows that share a doc_id count as
one document; a null doc_id is the largest. Other columns stay; same-named ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import add_columns, carried, given_back, row_key

LEAST, BITS, MOST, RUN = 16, 5, 256, 100
NOBODY = (1 << 63) - 1
GEAR = np.random.default_rng(20240501).integers(0, 1 << 16, 256, np.uint16)


def cuts(points: np.ndarray, least: int = LEAST, bits: int = BITS, most: int = MOST) -> list[int]:
    """Ends of the chunks of a text's code points."""
    rolled = GEAR[(points ^ (points >> 8)) & 255]
    for step in (1, 2, 4, 8):
        longer = rolled.copy()
        longer[step:] += rolled[:-step] << np.uint16(step)
        rolled = longer
    ends, last = [], 0
    for at in (np.flatnonzero((rolled >> np.uint16(16 - bits)) == 0) + 1).tolist() + [len(points)]:
        while at - last > most:
            last += most
            ends.append(last)
        if at - last >= least or at == len(points) and at > last:
            ends.append(at)
            last = at
    return ends


def chunks(docs: DataFrame) -> DataFrame:
    """(row, doc, d1, d2, start, size): the chunks of `text`, with their digests."""
    schema = "row long, doc long, d1 long, d2 long, start int, size int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows, owners, counts, starts, sizes, digests = [], [], [], [], [], []
                for row, doc, text in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns)):
                    if not text:
                        continue
                    ends = cuts(np.frombuffer(text.encode("utf-32-le"), np.uint32))
                    begins = [0, *ends[:-1]]
                    digests += [blake2b(text[b:e].encode(), digest_size=16).digest() for b, e in zip(begins, ends)]
                    rows.append(row)
                    owners.append(doc)
                    counts.append(len(ends))
                    starts += begins
                    sizes += [e - b for b, e in zip(begins, ends)]
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                columns = [np.repeat(np.array(rows, np.int64), counts), np.repeat(np.array(owners, np.int64), counts), halves[:, 0].copy(), halves[:, 1].copy(), np.array(starts, np.int32), np.array(sizes, np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "doc", "d1", "d2", "start", "size"])

    own = docs.select(row_key("doc_id", "text").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NOBODY)).alias("doc"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, run: int = RUN) -> DataFrame:
    """`docs` with repeated runs cut out of the text, n_removed (characters) and removed (start, end)."""
    all_chunks = chunks(docs)
    repeated = all_chunks.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min("doc").alias("keeper")).where("n > 1").drop("n")
    found = all_chunks.join(repeated, ["d1", "d2"])
    own = found.groupBy("row").agg(F.collect_set(F.struct("start", "size", "d1", "d2", (F.col("doc") == F.col("keeper")).alias("own"))).alias("_found"))
    joined = carried(docs, "doc_id", "text").withColumn("_row", row_key("doc_id", "text")).join(own.withColumnRenamed("row", "_row"), "_row", "left")

    def cut(batch: pa.RecordBatch) -> list:
        texts, removed = [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("_found").to_pylist()):
            spans = _spans(found, run) if found else []
            at, parts = 0, []
            for start, end in spans:
                parts.append(text[at:start])
                at = end
            texts.append("".join([*parts, text[at:]]) if spans else text)
            removed.append([{"start": s, "end": e} for s, e in spans])
        return [pa.array(texts, pa.string()), pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]

    out = add_columns(joined, cut, "_cut string, removed array<struct<start:int,end:int>>")
    n_removed = F.aggregate("removed", F.lit(0), lambda a, x: a + x["end"] - x["start"]).cast("long")
    out = out.withColumns({"text": F.col("_cut"), "n_removed": n_removed})
    return given_back(out, docs.columns, ("doc_id", "text"), ("n_removed", "removed"))


def _spans(found: list[dict], run: int) -> list[tuple[int, int]]:
    """Runs of repeated chunks that are not the places to keep."""
    spans: list[list[int]] = []
    seen, last = set(), -1
    for x in sorted(found, key=lambda x: x["start"]):
        if x["start"] == last:
            continue
        last = x["start"]
        key = (x["d1"], x["d2"])
        if x["own"] and key not in seen:
            seen.add(key)
            continue
        if spans and spans[-1][1] == x["start"]:
            spans[-1][1] += x["size"]
        else:
            spans.append([x["start"], x["start"] + x["size"]])
    return [(s, e) for s, e in spans if e - s >= run]
