"""Toxicity by weak supervision.

1. From a bounded sample of labelled rows (`LABELLED` at most, by a hash of doc_id; equal texts
   once) the words and word beginnings that tell toxic from other documents are counted by Spark
   in one half and confirmed in the other. They become voters: lexicons of words and patterns of
   beginnings, in groups of like precision. A voter says toxic, or abstains.
2. A generative model (a latent label, a rate of firing of each voter under either label) is
   fitted by expectation maximisation; the given label is one more voter, of odds `TRUST`, which
   anchors the latent one. Correlations of voters beyond the label are estimated from the fitted
   residuals, and a voter's evidence is divided by one plus its positive correlations, so that
   voters that fire together count once.
3. A linear classifier over word and beginning features is trained on the posterior labels, with
   its weight decay. Scoring is one pass over whole texts, with no shuffle.

Inputs of a score are texts alone. Null text counts as empty; a text without words gets the score
of the intercept. Labels that are null, given twice or for unknown rows count as they join;
without labelled rows of both kinds the score is `PRIOR`. Other columns stay; same-named ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import add_columns, shipped, words
from cartulary.sources.storage import drop_path, stage

#: Bounds: labelled rows that the model is fitted to, and features and voters chosen from them.
LABELLED, FEATURES, VOTERS = 20_000, 3_000, 60
BEGINNINGS = range(3, 9)
PRIOR, TRUST = 0.1, 20.0


def features(text: str | None) -> set[str]:
    """Words (as =word) and their beginnings."""
    own = set(words(text))
    return {f"={w}" for w in own} | {w[:k] for w in own for k in BEGINNINGS if len(w) > k}


class Model:
    """Weights of features; a document's score is the logistic of the sum over those it has."""

    def __init__(self, weights: dict[str, float], intercept: float):
        self.weights, self.intercept = weights, intercept
        self.lengths = sorted({len(k) for k in weights if k[0] != "="})

    def score(self, text: str | None) -> float:
        own = set(words(text))
        get, hit = self.weights.get, set()
        for w in own:
            if f"={w}" in self.weights:
                hit.add(f"={w}")
            hit.update(w[:k] for k in self.lengths if len(w) > k and w[:k] in self.weights)
        z = self.intercept + sum(get(x) for x in hit)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def voters(chosen: list[str], precision: np.ndarray) -> list[list[int]]:
    """Lexicons and patterns: features of one kind and neighbouring precision, by index."""
    out = []
    for kind in (True, False):
        own = [i for i in np.argsort(-precision, kind="stable").tolist() if (chosen[i][0] == "=") == kind and precision[i] > 0.5]
        size = max(1, -(-len(own) // (VOTERS // 2)))
        out += [own[i : i + size] for i in range(0, len(own), size)]
    return out


def label_model(votes: np.ndarray, given: np.ndarray) -> np.ndarray:
    """Posterior of the toxic label from the voters' matrix (rows x voters, 0 or 1) and the given labels (nan: none)."""
    n = votes.shape[1]
    anchor = np.nan_to_num((2 * given - 1) * np.log(TRUST))
    posterior = np.where(np.isnan(given), np.where(votes.any(1), 0.9, 0.05), np.where(given == 1, 0.95, 0.05))
    discount = np.ones(n)
    for turn in range(30):
        weight = posterior.sum()
        prior = np.clip(posterior.mean(), 1e-3, 0.999)
        on = np.clip((votes.T @ posterior + 0.5) / (weight + 1), 1e-4, 1 - 1e-4)
        off = np.clip((votes.T @ (1 - posterior) + 0.05) / (len(votes) - weight + 1), 1e-5, 1 - 1e-4)
        if turn in (5, 15):
            spread = votes - (posterior[:, None] * on + (1 - posterior[:, None]) * off)
            scale = np.sqrt((spread**2).sum(0)) + 1e-9
            related = (spread.T @ spread) / np.outer(scale, scale)
            discount = 1 + np.clip(related - np.diag(np.diag(related)), 0, 1).sum(1)
        evidence = votes * (np.log(on / off) / discount) + (1 - votes) * (np.log((1 - on) / (1 - off)) / discount)
        posterior = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + anchor + evidence.sum(1), -30, 30)))
    return posterior


def linear(rows: list[np.ndarray], target: np.ndarray, size: int, rounds: int = 800, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels over sets of features, by adaptive gradients."""
    index = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, b = np.zeros(size), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(owner, w[index], len(rows)) + b
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        grad, gb = np.bincount(index, error[owner], size) / len(rows) + decay * w, error.mean()
        m, v, mb, vb = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b -= 0.1 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return w, b


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """The model, from rows of `labels` (doc_id, toxic) that are given; hold rows out before the call."""
    known = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64(F.col("_id").cast("string")), "_id", "toxic").limit(labelled)
    own = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text")).join(chosen, "_id").select("toxic", "text").dropDuplicates()
    own, at = stage(own.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2))), "labelled")

    def listed(batch: pa.RecordBatch) -> list:
        return [pa.array([sorted(features(t)) for t in batch.column("text").to_pylist()], pa.list_(pa.string()))]

    totals = {r.half: r for r in own.groupBy("half").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).collect()}
    if len(totals) < 2 or not all(0 < t.bad < t.n for t in totals.values()):
        return Model({}, float(np.log(PRIOR / (1 - PRIOR))))
    found = add_columns(own, listed, "found array<string>").select("toxic", "half", F.explode("found").alias("feature"))
    sums = [F.sum(F.when(F.col("half") == h, x)).alias(f"{name}{h}") for h in (0, 1) for name, x in (("bad", F.col("toxic")), ("n", F.lit(1)))]
    counts = found.groupBy("feature").agg(*sums).where("n0 >= 3 and n1 >= 1")
    for h, t in totals.items():
        base = t.bad / t.n
        counts = counts.withColumn(f"lift{h}", (F.col(f"bad{h}") - F.lit(base) * F.col(f"n{h}")) / F.sqrt(F.col(f"n{h}") * F.lit(base * (1 - base))))
    agreed = (F.abs("lift0") >= 3) & (F.col("lift0") * F.col("lift1") > 0) & (F.abs("lift1") >= 2)
    best = counts.where(agreed).orderBy(F.desc(F.abs(F.col("lift0") + F.col("lift1"))), "feature").limit(FEATURES).collect()
    names = [r.feature for r in best]
    place = {x: i for i, x in enumerate(names)}
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def numbered(batch: pa.RecordBatch) -> list:
        return [pa.array([sorted(shared.value[x] for x in features(t) if x in shared.value) for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))]

    sample = sorted((list(r[1]), r[0]) for r in add_columns(own, numbered, "at array<int>").select("toxic", "at").toLocalIterator())
    drop_path(docs.sparkSession, at)
    rows, given = [np.array(x, np.int64) for x, _ in sample], np.array([y for _, y in sample], float)
    precision = np.array([(r.bad0 + r.bad1 + PRIOR) / (r.n0 + r.n1 + 1) for r in best])
    groups = voters(names, precision)
    member = np.zeros((len(groups), len(names)), bool)
    for k, group in enumerate(groups):
        member[k, group] = True
    votes = np.array([member[:, r].any(1) for r in rows], float).reshape(len(rows), len(groups))
    weights, intercept = linear(rows, label_model(votes, given), len(names))
    return Model({x: float(w) for x, w in zip(names, weights) if abs(w) > 1e-3}, intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with score and predicted."""
    shared = shipped(docs.sparkSession, model)

    def run(batch: pa.RecordBatch) -> list:
        score_of = shared().score
        found = np.array([score_of(t) for t in batch.column("text").to_pylist()], float)
        return [pa.array(found), pa.array((found >= 0.5).astype(np.int32))]

    return add_columns(docs, run, "score double, predicted int")


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
