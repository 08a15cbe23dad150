"""Document quality by Bradley-Terry pairwise ranking.

A document's utility is linear in features of its text (shares of characters,
word and line repetition, sizes). It is learned from preference pairs, a
document labelled good against one labelled bad, by logistic loss on the
difference of their features. The threshold is the quantile of the utilities at
the share of bad labels, over all labelled rows that are not held out; utilities
are mapped to (0, 1) so that the threshold falls on ``ACCEPT``.

The weights are fitted on at most ``SAMPLE`` labelled rows (those with the smallest
hash of their id) and ``PAIRS`` pairs; every document is scored over its whole
text. Null and empty texts have zero features and a score like any other. Rows
whose label or id is null teach nothing; of repeated labels of one id the
smallest counts. Without labels of both kinds every score is the share of good
labels, 0.5 if there are none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, bounded_sample, held_out

SAMPLE = 8_000
PAIRS = 40_000
ACCEPT = 0.7
PENALTY = 1e-2
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_PUNCTUATION = [ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]


def features(text: str | None) -> np.ndarray:
    text = text or ""
    data = np.frombuffer(text.encode(), np.uint8)
    count = np.bincount(data, minlength=256)
    n, words, lines = max(1, len(data)), text.split(), text.split("\n")
    upper, letters = count[65:91].sum(), max(1, count[65:91].sum() + count[97:123].sum())
    w = max(1, len(words))
    shares = [upper / letters, count[48:58].sum() / n, count[[9, 10, 11, 12, 13, 32]].sum() / n, count[128:].sum() / n,
              sum(map(eq, words, words[1:])) / w, len(set(words)) / w, sum(map(str.isupper, words)) / w,
              sum(map(str.isalpha, words)) / w, len(set(lines)) / len(lines)]
    sizes = [np.log1p(len(words)), n / w if words else 0.0, np.log1p(len(lines)), np.log1p(n / len(lines))]
    return np.concatenate([np.sqrt(shares), sizes, np.sqrt(count[_PUNCTUATION] / n)])


class BradleyTerry:
    """Utility weights from preference pairs; scores in (0, 1)."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, accept: float = ACCEPT, pairs: int = PAIRS, penalty: float = PENALTY):
        good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
        self.share = len(good) / len(labels) if len(labels) else 0.5
        self.accept, self.weights = accept, None
        if not len(good) or not len(bad):
            return
        self.mean, self.scale = rows.mean(axis=0), rows.std(axis=0) + 1e-6
        z = self._standard(rows)
        rng = np.random.default_rng(0)
        difference = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
        weights = np.zeros(rows.shape[1])
        for _ in range(30):  # Newton steps of the penalised logistic loss
            p = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
            gradient = difference.T @ p / pairs - penalty * weights
            hessian = (difference * (p * (1 - p))[:, None]).T @ difference / pairs + penalty * np.eye(len(weights))
            step = np.linalg.solve(hessian, gradient)
            weights += step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = weights
        utility = self.utility(rows)
        self.place(len(good) / len(labels), np.quantile(utility, 1 - self.share), utility.std())

    def place(self, share: float, threshold: float, deviation: float) -> None:
        """Where the labelled utilities lie; the fit puts in those of its own rows."""
        self.share, self.threshold, self.spread = share, threshold, deviation / 2 + 1e-9

    def _standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8)

    def utility(self, rows: np.ndarray) -> np.ndarray:
        return self._standard(rows) @ self.weights if self.weights is not None else np.zeros(len(rows))

    def score(self, rows: np.ndarray) -> np.ndarray:
        return self.score_of(self.utility(rows))

    def score_of(self, utility: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(utility), self.share)
        x = (utility - self.threshold) / self.spread + np.log(self.accept / (1 - self.accept))
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the rows that may teach."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
    return known.groupBy("doc_id").agg(F.min(label).alias("label"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> BradleyTerry:
    """Fitted on rows that are not held out."""
    known = bounded_sample(known_labels(labels, label), "doc_id", sample)
    chosen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("label", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array([features(t).tolist() for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), rows], ["label", "features"])

    got = chosen.mapInArrow(measure, "label int, features array<double>").toArrow()
    found = sorted(zip(got[0].to_pylist(), got[1].to_pylist()))
    width = len(features(None))
    return BradleyTerry(np.array([row for _, row in found], float).reshape(-1, width), np.array([y for y, _ in found], int))


def scores(docs: DataFrame, labels: DataFrame, model: BradleyTerry, label: str = "quality") -> DataFrame:
    """One row per row of ``docs`` (see ``SCHEMA``). Utilities are written, placed by
    those of all labelled rows and mapped to scores; texts are read once."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features(t) for t in batch.column(2).to_pylist()])
            found = model.utility(rows) if len(rows) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["doc_id", "held_out", "utility"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    measured = Scratch(docs.sparkSession, "quality").write(wanted.mapInArrow(measure, "doc_id long, held_out boolean, utility double"), "utilities")
    told = known_labels(labels, label).join(measured.where("not held_out"), "doc_id")
    placed = told.agg(F.avg("label").alias("share"), F.stddev_pop("utility").alias("deviation")).first()
    if placed.share is not None and model.weights is not None:
        at = F.percentile_approx("utility", F.lit(1 - float(placed.share)), F.lit(100_000))
        model.place(float(placed.share), float(told.agg(at.alias("at")).first().at), float(placed.deviation))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score_of(batch.column(2).to_numpy())
            arrays = [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= model.accept).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "score", "predicted"])

    return measured.mapInArrow(apply, SCHEMA)
