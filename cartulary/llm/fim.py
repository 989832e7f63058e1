"""Fill-in-the-middle transformation by displacement scatter.

The bytes of many texts lie in one array. One scan marks where tokens (`[A-Za-z]+|[^A-Za-z]`) begin
and thus turns a cut, given in tokens, into a byte. A text is a row of three segments: prefix,
middle, suffix. Each segment has one shift to its place in the output; the steps between
shifts go into a difference array, whose cumulative sum is the shift of every byte, and one scatter
writes all outputs. `restore` finds the marks in the output, derives the same shifts, and gathers.

Where to cut, and in which form, follows from a hash of the seed and `doc_id` alone, so a task that
runs again, or another partitioning, gives the same. There is no shuffle; memory is bounded by
`PIECE` bytes of text at a time, or one text where that is longer.

Null text counts as empty; empty texts and those that hold a mark stay plain. A null id is hashed as
an empty one. Rows with equal id and text get equal results. Same-named columns are replaced by the results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

MARKS = (b"<P>", b"<S>", b"<M>")
WIDE = len(MARKS[0])
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")
#: Of 100 texts, those that stay plain, and of 100 others, those whose suffix comes first.
PLAIN_SHARE, SPM_SHARE = 10, 20
PIECE = 4 << 20
RESULTS = "n long, form string, prefix_chars long, middle_chars long, output string"


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins; the last entry is the end."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def as_texts(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def marks_in(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places of marks that lie inside one text."""
    opens = np.flatnonzero(data[:-2] == MARKS[0][0]) if len(data) >= WIDE else np.empty(0, np.int64)
    named = np.isin(data[opens + 1], [m[1] for m in MARKS]) & (data[opens + 2] == MARKS[0][2])
    at = opens[named]
    return at[np.searchsorted(bounds, at, "right") == np.searchsorted(bounds, at + WIDE - 1, "right")]


def token_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bytes at which a token begins."""
    letter = ((data | 32) - np.uint8(97)) < 26
    follows = np.zeros(len(data), bool)
    follows[1:] = letter[1:] & letter[:-1]
    follows[bounds[:-1][bounds[:-1] < len(data)]] = False
    return np.flatnonzero(((data & 0xC0) != 0x80) & ~follows)


def draws(ids: list, seed: int) -> np.ndarray:
    """Four 32-bit numbers for each id."""
    digests = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(digests), ">u4").reshape(-1, 4).astype(np.int64)


def displaced(begins: np.ndarray, sizes: np.ndarray, form: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every byte's place in the output, the outputs' bounds, and the places of the three marks of each marked text.

    begins: where texts begin; sizes: (text, 3) bytes of prefix, middle, suffix.
    """
    marked = form != PLAIN
    outs = np.concatenate([[0], np.cumsum(sizes.sum(1) + 3 * WIDE * marked)])
    prefix, middle, suffix = sizes.T
    ahead = np.where(form == SPM, suffix + WIDE, 0)
    places = np.stack(
        [
            np.where(marked, WIDE + ahead, 0),
            np.where(marked, 3 * WIDE + prefix + suffix, prefix),
            np.where(marked, np.where(form == SPM, WIDE, 2 * WIDE + prefix), prefix + middle),
        ],
        1,
    )
    sources = begins[:, None] + np.stack([np.zeros_like(prefix), prefix, prefix + middle], 1)
    shifts = (outs[:-1, None] + places - sources).ravel()
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, sources.ravel(), np.diff(shifts, prepend=0))
    where = np.cumsum(steps[:-1])
    where += np.arange(total)
    return where, outs, (outs[:-1, None] + places - WIDE)[marked]


def scattered(data: np.ndarray, bounds: np.ndarray, cuts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs and their bounds; cuts: (text, 2) bytes."""
    edges = np.column_stack([bounds[:-1], cuts, bounds[1:]])
    where, outs, marks = displaced(bounds[:-1], np.diff(edges, axis=1), form, len(data))
    out = np.empty(outs[-1], np.uint8)
    out[where] = data
    for mark, at in zip((MARKS[0], MARKS[2], MARKS[1]), marks.T):
        for j, byte in enumerate(mark):
            out[at + j] = byte
    return out, outs


def gathered(out: np.ndarray, outs: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts and their bounds from outputs and forms."""
    marked = np.flatnonzero(form != PLAIN)
    at = marks_in(out, outs)
    at = at[np.isin(np.searchsorted(outs, at, "right") - 1, marked)].reshape(-1, 3)
    ends = np.column_stack([at[:, 1:], outs[marked + 1]]) - at - WIDE
    sizes = np.zeros((len(form), 3), np.int64)
    sizes[:, 0] = np.diff(outs)
    spm = form[marked] == SPM
    first, second = np.where(spm, ends[:, 1], ends[:, 0]), np.where(spm, ends[:, 0], ends[:, 1])
    sizes[marked] = np.column_stack([first, ends[:, 2], second])
    bounds = np.concatenate([[0], np.cumsum(sizes.sum(1))])
    where, _, _ = displaced(bounds[:-1], sizes, form, int(bounds[-1]))
    return out[where], bounds


def pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most `PIECE` bytes of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PIECE, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _added(df: DataFrame, text: str, function: Callable[[pa.RecordBatch], list], fields: str) -> DataFrame:
    added = StructType.fromDDL(fields)
    kept = df.drop(*added.fieldNames())
    names = kept.columns + added.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                yield pa.RecordBatch.from_arrays([*piece.columns, *function(piece)], names=names)

    return kept.mapInArrow(run, StructType(kept.schema.fields + added.fields))


def transform(docs: DataFrame, seed: int = 1) -> DataFrame:
    """`docs` (doc_id, text) with n (tokens), form, prefix_chars, middle_chars (null where plain) and output."""

    def run(batch: pa.RecordBatch) -> list:
        data, bounds = text_bytes(batch.column("text"))
        starts = token_starts(data, bounds)
        base = np.searchsorted(starts, bounds)
        n = np.diff(base)
        h = draws(batch.column("doc_id").to_pylist(), seed)
        form = np.where(h[:, 3] % 100 < SPM_SHARE, SPM, PSM)
        form[(n == 0) | (h[:, 2] % 100 >= 100 - PLAIN_SHARE)] = PLAIN
        form[np.searchsorted(bounds, marks_in(data, bounds), "right") - 1] = PLAIN
        chosen = np.sort(h[:, :2] % (n + 1)[:, None], 1) + base[:-1, None]
        cuts = np.append(starts, len(data))[chosen]
        out, outs = scattered(data, bounds, cuts, form)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        plain = form == PLAIN
        first, second = points[cuts].T
        return [
            pa.array(n, pa.int64()),
            pa.array([FORMS[f] for f in form.tolist()], pa.string()),
            pa.array(first - points[bounds[:-1]], pa.int64(), mask=plain),
            pa.array(second - first, pa.int64(), mask=plain),
            as_texts(out, outs),
        ]

    return _added(docs, "text", run, RESULTS)


def restore(transformed: DataFrame) -> DataFrame:
    """Adds `restored`, the text rebuilt from `output` and `form` alone."""

    def run(batch: pa.RecordBatch) -> list:
        out, outs = text_bytes(batch.column("output"))
        form = np.array([FORMS.index(f) for f in batch.column("form").to_pylist()], np.int64)
        return [as_texts(*gathered(out, outs, form))]

    return _added(transformed, "output", run, "restored string")
