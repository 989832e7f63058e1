"""What several operators share: staging, added columns, row keys, connected groups."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartulary.sources.storage import drop_path, stage

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text: str) -> str:
    """A-Z to a-z; everything else stays."""
    return text.encode("utf-8", "replace").lower().decode("utf-8")


def words(text: str | None) -> list[str]:
    return WORD.findall(lower_ascii(text)) if text else []


_PRIME = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64)]
_INVERSE = [np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 2 * len(_POWERS[0]), 1 << 16)
        for table, base in ((_POWERS, _PRIME), (_INVERSE, pow(_PRIME, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            table[0] = np.multiply.accumulate(factors)
    return _POWERS[0][:n], _INVERSE[0][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes with all bits mixed."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def word_hashes(text: str, digits_as_zero: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first place of each word as in `words`, and the text's code points."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    upper = (points >= 65) & (points <= 90)
    digit = (points >= 48) & (points <= 57)
    inside = upper | digit | ((points >= 97) & (points <= 122)) | (points >= 128)
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts, points
    value = points + 32 * upper.astype(np.uint32)
    if digits_as_zero:
        value = np.where(digit, np.uint32(48), value)
    up, down = powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((value.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts]), starts, points


def row_key(*columns: str) -> Column:
    """A row's identity for joins back to it. Rows equal in these columns share it and all decisions."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])


def carried(df: DataFrame, *inputs: str) -> DataFrame:
    """The columns an operator reads, and the caller's others as one struct: no name of theirs meets one of the operator's own."""
    others = [df[c] for c in df.columns if c not in inputs] or [F.lit(0).alias("none")]
    return df.select(F.struct(*others).alias("_others"), *inputs)


def given_back(out: DataFrame, columns: list[str], inputs: tuple[str, ...], results: tuple[str, ...]) -> DataFrame:
    """The caller's `columns` in their order, the inputs as `out` has them, then the results; those named like a result are replaced by it."""
    own = [F.col(c) if c in inputs else F.col("_others")[c].alias(c) for c in columns if c not in results]
    return out.select(*own, *results)


def sliced(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most `rows` rows; a batch of no rows stays one."""
    return (batch.slice(at, rows) for at in range(0, max(batch.num_rows, 1), rows))


#: Rows that a function of `add_columns` sees at once: as Python objects a whole batch is many times its size.
PART = 500


def add_columns(df: DataFrame, function: Callable[[pa.RecordBatch], list], fields: str) -> DataFrame:
    """`df` plus the Arrow columns that `function` makes of each part of a batch; same-named ones are replaced."""
    added = StructType.fromDDL(fields)
    kept = df.drop(*added.fieldNames())
    names = kept.columns + added.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, PART):
                yield pa.RecordBatch.from_arrays([*part.columns, *function(part)], names=names)

    return kept.mapInArrow(run, StructType(kept.schema.fields + added.fields))


def shipped(spark: SparkSession, thing: object) -> Callable[[], object]:
    """Broadcasts an object's fields; the function returned makes the object again on an executor."""
    kind, fields = type(thing), spark.sparkContext.broadcast(vars(thing))

    def get() -> object:
        again = object.__new__(kind)
        vars(again).update(fields.value)
        return again

    return get


def packed(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Parts of `values` as bytes; edges: where each part begins, and the end."""
    offsets = pa.py_buffer((edges * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Values and edges that `packed` took."""
    if not len(column):
        return np.empty(0, kind), np.zeros(1, np.int64)
    whole = pa.concat_arrays([c.cast(pa.binary()) for c in column.chunks])
    _, offsets, data = whole.buffers()
    edges = np.frombuffer(offsets, np.int32)[whole.offset : whole.offset + len(whole) + 1].astype(np.int64)
    values = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]].copy().view(kind)
    return values, (edges - edges[0]) // np.dtype(kind).itemsize


def shared_buckets(buckets: DataFrame) -> tuple[DataFrame, str]:
    """Rows of `buckets` with more than one node, and the path that holds them."""
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return stage(buckets.join(sizes, "bucket").drop("n"), "shared")


def heads_of(shared: DataFrame, *carried: str) -> tuple[DataFrame, str]:
    """(bucket, head and its `carried` columns), and the path that holds them.

    The head is the member whose buckets are fullest, which in a group of copies is near their
    common origin. Heads follow one order, so of two nodes only one ever heads the other.
    """
    sizes = shared.groupBy("bucket").agg(F.count("*").alias("n"))
    fullness = shared.join(sizes, "bucket").groupBy("node").agg(F.sum("n").alias("full"))
    ranked = shared.select("bucket", "node", *carried).join(fullness, "node")
    heads = ranked.groupBy("bucket").agg(F.min(F.struct((-F.col("full")).alias("rank"), "node", *carried)).alias("head"))
    return stage(heads.select("bucket", F.col("head.node").alias("head"), *[F.col(f"head.{c}").alias(c) for c in carried]), "heads")


def headed(buckets: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Shared rows of `buckets`, the heads of their buckets, and the paths that hold both."""
    shared, at_shared = shared_buckets(buckets)
    heads, at_heads = heads_of(shared)
    return shared, heads, [at_shared, at_heads]


Verified = Callable[[DataFrame], DataFrame]


def classes(shared: DataFrame, verifier: Callable[[DataFrame], Verified], carried: tuple[str, ...] = (), likely: Column | None = None) -> DataFrame:
    """(node, component) of nodes that are linked over shared buckets.

    shared: bucket, node and the `carried` columns that `likely` compares (as x.* and y.*); verifier: all nodes
    that may come into a pair -> a function from pairs (a, b) to the links among them. Pairs are not formed
    within a bucket. First each node meets the head of its bucket (see `heads_of`). Then a bucket whose
    nodes fall into several components lets the nodes outside its head's component meet the nodes
    of other components: every link between components has such a node, so none is lost, and copies
    that are together meet no more.
    """
    spark = shared.sparkSession
    likely = F.lit(True) if likely is None else likely
    heads, at_heads = heads_of(shared, *carried)
    meets = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.node") != F.col("y.node")) & likely
    pairs = shared.alias("x").join(heads.withColumnRenamed("head", "node").alias("y"), meets)
    pairs, at_pairs = stage(pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "pairs")
    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    beside = shared.join(met, "node", "left_anti").alias("x").join(shared.alias("y"), meets, "left_semi").select("node")
    verified = verifier(met.union(beside).distinct())
    edges, _ = stage(verified(pairs), "links")
    found = connected(edges, "a", "b")
    named = heads.join(found, F.col("head") == F.col("node"), "left").select("bucket", F.coalesce("component", "head").alias("first"))
    members = shared.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).join(named, "bucket")
    members, at_members = stage(members, "members")
    apart = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") != F.col("y.component")) & likely
    more = members.where("component <> first").alias("x").join(members.alias("y"), apart)
    more = more.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    others, _ = stage(verified(more), "links")
    for path in (at_heads, at_pairs, at_members):
        drop_path(spark, path)
    return merged(found, others) if others.limit(1).count() else found


def merged(found: DataFrame, others: DataFrame) -> DataFrame:
    """`found` (node, component) after more links (a, b): only components are connected anew, not their nodes."""
    between = others.select("a", "b")
    for x in "ab":
        own = found.select(F.col("node").alias(x), F.col("component").alias(f"in_{x}"))
        between = between.join(own, x, "left").withColumn(f"in_{x}", F.coalesce(f"in_{x}", x))
    wider = connected(between, "in_a", "in_b")
    names = wider.select(F.col("node").alias("component"), F.col("component").alias("wide"))
    renamed = found.join(names, "component", "left").select("node", F.coalesce("wide", "component").alias("component"))
    return renamed.unionByName(wider.join(found.select("node"), "node", "left_anti"))


def connected(edges: DataFrame, first: str, second: str) -> DataFrame:
    """(node, component) for the nodes of `edges`; a component is named by its smallest node.

    Each round takes the least label among a node's neighbours and then follows labels once
    more, so that chains halve. Every round is written to the shared folder. Minima combine
    before the shuffle and labels are joined to edges, so a node with very many neighbours
    is only a skewed join.
    """
    spark = edges.sparkSession
    pair = edges.select(F.col(first).alias("a"), F.col(second).alias("b")).where("a <> b")
    both, at_edges = stage(pair.union(pair.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels, at = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lowered = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        target = labels.select(F.col("node").alias("t"), F.col("label").alias("further"))
        jumped = lowered.join(target, F.col("low") == F.col("t")).select("node", "old", F.least("low", "further").alias("label"))
        following, at_next = stage(jumped, "labels")
        moved = following.where("label <> old").limit(1).count()
        drop_path(spark, at)
        labels, at = following.select("node", "label"), at_next
        if not moved:
            drop_path(spark, at_edges)
            return labels.withColumnRenamed("label", "component")
