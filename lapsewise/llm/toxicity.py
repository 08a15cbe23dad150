"""Toxicity severity by cumulative-link ordinal regression over sparse words.

Features are words and their first letters (``PREFIXES``), marked ones only: those
in toxic documents more often than chance explains. Severity grades are
ordered: 0 for documents labelled clean, 1 to 3 for toxic ones by the terciles
of the sum of x over marked features. One weight per feature is
shared by all thresholds: P(grade <= k) = logistic(threshold k - weights . x),
where x is 1 + log(occurrences) of a feature that occurs; thresholds are in
order by construction. The result is the expected severity, the sum of
P(grade > k) over all k. A document is toxic when P(grade > 0) reaches the cut
that makes fewest errors on the training rows.

Words are counted, terciles taken and the cut is chosen over all labelled rows
that are not held out, and every marked feature is kept (of more than ``MARKS``
those with most evidence). Only the weights are
fitted on a sample: about ``EACH`` rows of every feature (fewer where they would
pass ``ROWS`` together), all of a rarer one, by a hash of their id and weighted by
the inverse of their chance to be taken. Rows
without a marked word differ by label only and stand as counts.
Every document is graded over its whole text. Null and empty texts have no words.
Labels that are null or without an id teach nothing; of repeated labels of one
id the largest counts. With no toxic label, or no clean one, or no marked word,
nothing is toxic. An empty table gives no rows. Other columns are kept by the
filter and ignored by the scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from .chunk_ids import release_encoders
from .common import Scratch, held_out

EACH = 200  # rows of a feature that the weights are fitted on
ROWS = 60_000  # rows that the weights are fitted on, at most (expected): fewer of each feature beyond
PREFIXES = (5, 6, 7)
FALSE_MARKS = 2.0
MARKS = 1 << 18  # features of a model at most, those with most evidence: bounds what every task gets
FLUSH = 200_000  # features that a task counts before it sends them on
GRADES = 4
PENALTY = 1e-4
SCORES = "severity double, grade int, toxic_probability double, toxic boolean"
_WORD = re.compile(r"[^\W\d_]+")


def features_of(text: str | None) -> Counter:
    """How often each word of a text occurs, and each word beginning: ``abcde*``
    stands for the words that begin so. Training and scoring count alike."""
    counts = Counter(_WORD.findall((text or "").lower()))
    for size in PREFIXES:
        for word, n in list(counts.items()):
            if len(word) >= size and word[-1] != "*":
                counts[word[:size] + "*"] += n
    return counts


class OrdinalWords:
    """Cumulative-link regression on the occurrences of chosen words."""

    def __init__(self, words: list[str], steps: int = 1500, rate: float = 0.05):
        self.words = {w: k for k, w in enumerate(words)}
        self.steps, self.rate = steps, rate
        self.weights = np.zeros(len(words))
        self.thresholds = np.full(GRADES - 1, np.inf)
        self.cut = 0.5

    def occurrences(self, text: str | None) -> dict[int, int]:
        """How often each feature of the model occurs (see ``features_of``); only the
        beginnings that the model knows are counted."""
        counts = Counter(_WORD.findall((text or "").lower()))
        found = {self.words[w]: counts[w] for w in self.words.keys() & counts.keys()}
        for size in PREFIXES:
            features = self.words.keys() & {w[:size] + "*" for w in counts if len(w) >= size}
            for w, n in counts.items() if features else ():
                if len(w) >= size and w[:size] + "*" in features:
                    k = self.words[w[:size] + "*"]
                    found[k] = found.get(k, 0) + n
        return found

    def rows(self, texts: list[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.words)))
        for row, text in zip(x, texts):
            for k, n in self.occurrences(text).items():
                row[k] = 1 + np.log(n)
        return x

    def fit(self, x: np.ndarray, grades: np.ndarray) -> None:
        at, feature = np.nonzero(x)
        sums = self.fit_sparse(at, feature, x[at, feature], grades, np.ones(len(x)))
        cuts = between(sums)
        bins = np.searchsorted(cuts, sums, side="right")
        self.choose_cut(cuts, *(np.bincount(bins[kind], minlength=len(cuts) + 1) for kind in (grades > 0, grades == 0)))

    def fit_sparse(self, row: np.ndarray, feature: np.ndarray, x: np.ndarray, grades: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Gradient steps (Adam) on the penalised likelihood. The first threshold is
        free, the gaps to the next ones are exponentials. Row ``row`` stands for
        ``counts[row]`` rows and has ``x`` at ``feature``. Returns weights . x."""
        n, size, share = len(grades), len(self.words), counts / counts.sum()
        values = np.concatenate([np.zeros(size), [2.0], np.zeros(GRADES - 2)])
        mean, square = np.zeros_like(values), np.zeros_like(values)
        at = np.arange(n)
        for step in range(1, self.steps + 1):
            weights, free = values[:size], values[size:]
            gaps = np.exp(free[1:])
            thresholds = free[0] + np.append(0, np.cumsum(gaps))
            sums = np.bincount(row, x * weights[feature], n)
            below = 1 / (1 + np.exp(-np.clip(thresholds - sums[:, None], -30, 30)))
            edges = np.column_stack([np.zeros(n), below, np.ones(n)])
            slope = edges * (1 - edges)
            p = np.maximum(edges[at, grades + 1] - edges[at, grades], 1e-12)
            up, down = slope[at, grades + 1] / p, slope[at, grades] / p
            by_threshold = np.zeros((n, GRADES + 1))
            by_threshold[at, grades + 1] += up
            by_threshold[at, grades] -= down
            by_threshold = share @ by_threshold[:, 1:-1]
            later = np.cumsum(by_threshold[::-1])[::-1]
            by_weight = np.bincount(feature, x * ((up - down) * share)[row], size)
            gradient = np.concatenate([-by_weight - 2 * PENALTY * weights, [later[0]], later[1:] * gaps])
            mean = 0.9 * mean + 0.1 * gradient
            square = 0.999 * square + 0.001 * gradient**2
            values = values + self.rate * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        self.weights = values[:size]
        free = values[size:]
        self.thresholds = free[0] + np.append(0, np.cumsum(np.exp(free[1:])))
        return np.bincount(row, x * self.weights[feature], n)

    def choose_cut(self, cuts: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> None:
        """The cut that makes fewest errors: ``toxic`` and ``clean`` rows by the number
        of ``cuts`` at or below their weights . x."""
        errors = np.cumsum(toxic)[:-1] + clean.sum() - np.cumsum(clean)[:-1]
        self.cut = float(1 / (1 + np.exp(self.thresholds[0] - cuts[np.argmin(errors)])))

    def above(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > k) for every text and k."""
        sums = [sum(self.weights[k] * (1 + np.log(n)) for k, n in self.occurrences(t).items()) for t in texts]
        return 1 / (1 + np.exp(np.clip(self.thresholds - np.array(sums).reshape(-1, 1), -500, 500)))


def between(sums: np.ndarray) -> np.ndarray:
    """The middles between neighbouring values; above the value if there is one only."""
    distinct = np.unique(sums)
    return (distinct[:-1] + distinct[1:]) / 2 if len(distinct) > 1 else distinct + 1


def labelled(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, toxic, text) of the labelled documents that are not held out.

    The join shuffles the texts once and is written, by the same plan at every size:
    a broadcast of the labels would only serve small tables."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return scratch.write(texts.hint("merge").join(known.hint("merge"), "doc_id").select("doc_id", "toxic", "text"), "labelled")


def feature_counts(chosen: DataFrame) -> DataFrame:
    """(word, n, k): documents with each feature, and toxic ones. The empty word
    stands for the document itself."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        n, k = Counter(), Counter()
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = ["", *features_of(text)]
                n.update(found)
                if toxic:
                    k.update(found)
                if len(n) > FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64()), pa.array([k[w] for w in n], pa.int64())], ["word", "n", "k"])
                    n, k = Counter(), Counter()
        yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64()), pa.array([k[w] for w in n], pa.int64())], ["word", "n", "k"])

    counted = chosen.select("toxic", "text").mapInArrow(count, "word string, n long, k long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))


def train(docs: DataFrame, labels: DataFrame, each: int = EACH, rows_limit: int = ROWS) -> OrdinalWords:
    scratch = Scratch(docs.sparkSession, "toxicity")
    chosen = labelled(docs, labels, scratch)
    counts = feature_counts(chosen)
    counts = scratch.write(counts, "words")
    total = counts.where("word = ''").first()
    if total is None or not 0 < total.k < total.n:
        return OrdinalWords([])
    counts, share = counts.where("word <> ''"), total.k / total.n
    # Chernoff's bound on the chance of a word's share of toxic documents, against
    # the number of words: at most FALSE_MARKS words are expected to pass by chance.
    q = F.col("k") / F.col("n")
    clean = F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - share))).otherwise(0.0)
    evidence = F.when(q > share, F.col("n") * (q * F.log(q / share) + clean)).otherwise(0.0)
    least = math.log(max(1, counts.count()) / FALSE_MARKS)
    strongest = counts.select("word", "n", evidence.alias("evidence")).where(F.col("evidence") >= least).orderBy(F.desc("evidence"), "word")
    marked = {r.word: r.n for r in strongest.limit(MARKS).collect()}
    model = OrdinalWords(sorted(marked))
    if not model.words:
        return model
    each = min(each, rows_limit / len(model.words))
    chance = np.array([min(1.0, each / marked[w]) for w in model.words])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(toxic, uses, stands_for, features, x) of every row; a row that is not
        taken stands for none."""
        for batch in batches:
            found = [model.occurrences(t) for t in batch.column(2).to_pylist()]
            x = [[1 + math.log(n) for n in f.values()] for f in found]
            most = np.array([max((chance[k] for k in f), default=1.0) for f in found])
            stands_for = np.where(batch.column(0).to_numpy() < most, 1 / most, 0.0)
            arrays = [batch.column(1), pa.array([sum(v) for v in x], pa.float64()), pa.array(stands_for),
                      pa.array([list(f) for f in found], pa.list_(pa.int32())), pa.array(x, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["toxic", "uses", "stands_for", "features", "x"])

    span = 1 << 31
    rows = chosen.select((F.pmod(F.xxhash64("doc_id"), F.lit(span)) / F.lit(float(span))).alias("hash"), "toxic", "text")
    rows = scratch.write(rows.mapInArrow(measure, "toxic int, uses double, stands_for double, features array<int>, x array<double>"), "rows")
    terciles = rows.where("toxic = 1").agg(F.percentile_approx("uses", [1 / 3, 2 / 3], 100_000)).first()[0]
    unmarked = rows.where("size(features) = 0").groupBy("toxic").agg(F.count(F.lit(1)).cast("double").alias("n"), F.lit(0.0).alias("uses")).toArrow()
    got = rows.where("size(features) > 0 and stands_for > 0").toArrow()
    is_toxic = np.concatenate([got["toxic"].to_numpy(), unmarked["toxic"].to_numpy()]) == 1
    uses = np.concatenate([got["uses"].to_numpy(), unmarked["uses"].to_numpy()])
    row = np.repeat(np.arange(got.num_rows), got["features"].combine_chunks().value_lengths().to_numpy())
    feature, x = (got[c].combine_chunks().flatten().to_numpy() for c in ("features", "x"))
    stands_for = np.concatenate([got["stands_for"].to_numpy(), unmarked["n"].to_numpy()])
    cuts = between(model.fit_sparse(row, feature, x, np.where(is_toxic, 1 + np.searchsorted(terciles, uses), 0), stands_for))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, values = batch.column(1), np.array(batch.column(2).flatten())
            row = np.repeat(np.arange(batch.num_rows), np.array(features.value_lengths()))
            sums = np.bincount(row, values * model.weights[np.array(features.flatten())], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.searchsorted(cuts, sums, side="right"))], ["toxic", "cuts"])

    placed = rows.select("toxic", "features", "x").mapInArrow(place, "toxic int, cuts long").groupBy("toxic", "cuts").agg(F.count(F.lit(1)).alias("n"))
    errors = np.zeros((2, len(cuts) + 1))
    for r in placed.collect():  # twice the sampled rows at most
        errors[r.toxic, r.cuts] = r.n
    model.choose_cut(cuts, errors[1], errors[0])
    return model


def _graded(model: OrdinalWords, texts: list[str | None]) -> list[pa.Array]:
    above = model.above(texts)
    toxic = above[:, 0] >= model.cut
    grade = np.where(toxic, np.maximum(1, (above >= 0.5).sum(axis=1)), 0).astype(np.int32)
    return [pa.array(above.sum(axis=1)), pa.array(grade), pa.array(above[:, 0]), pa.array(toxic)]


def severities(docs: DataFrame, model: OrdinalWords) -> DataFrame:
    """One row per row of ``docs``: doc_id, expected severity (0 to 3), grade (0 if
    not toxic, else the thresholds more likely passed than not, 1 at least),
    P(grade > 0) and toxic."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["doc_id", "severity", "grade", "toxic_probability", "toxic"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_graded(model, batch.column(1).to_pylist())], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(apply, f"doc_id long, {SCORES}")


def without_toxic(docs: DataFrame, model: OrdinalWords) -> DataFrame:
    """The rows of ``docs``, with their columns, that are not toxic."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").cast("string").alias("text"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.array(_graded(model, batch.column(1).to_pylist())[3])
            yield batch.select([0]).filter(pa.array(~toxic))

    return rows.mapInArrow(keep, StructType([StructField("doc", rows.schema["doc"].dataType)])).select("doc.*")
