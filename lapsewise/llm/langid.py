"""Language identification by a byte convolutional network in numpy.

A window of ``WINDOW`` bytes is embedded byte by byte; filters of several widths
slide over it, each keeps its largest response (max pooling), and a linear
layer with softmax gives the languages. A text is cut into such windows from
end to end (the last one padded with zero bytes); its language has the largest
mean log-probability over all windows.

The network learns every language, from about ``PER_LANGUAGE`` documents of each,
chosen by a hash of their id, of which a few windows leave the tasks; never from
held-out rows, null languages or null texts. Null texts and texts without a
letter are ``und`` with score 0, and so is every text if there is nothing to
learn from. Repeated rows and a null ``doc_id`` give a row each; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .chunk_ids import text_slices
from .common import held_out

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBEDDING = 8
PER_LANGUAGE = 500
UNDETERMINED = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
_MAYBE_LETTER = re.compile(r"[^\W\d_]")  # also finds number signs such as ½ and Ⅷ
_BATCH = 256  # windows


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in map(re.Match.group, _MAYBE_LETTER.finditer(text)))


def windows(data: bytes) -> np.ndarray:
    """All of ``data`` in rows of WINDOW bytes."""
    rows = -(-len(data) // WINDOW)
    return np.frombuffer(data.ljust(rows * WINDOW, b"\0"), np.uint8).reshape(rows, WINDOW)


class ByteCnn:
    def __init__(self, languages: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.languages = languages
        longest, filters = max(WIDTHS), FILTERS * len(WIDTHS)
        # Filters of all widths stand in one matrix; a narrow one is zero beyond its width.
        width = np.repeat(WIDTHS, FILTERS)
        self.mask = (np.repeat(np.arange(longest), EMBEDDING)[:, None] < width).astype(np.float32)
        self.parameters = {
            "embedding": rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
            "filters": self.mask * rng.normal(0, 0.3, (longest * EMBEDDING, filters)).astype(np.float32),
            "bias": np.zeros(filters, np.float32),
            "output": rng.normal(0, 0.3, (filters, len(languages))).astype(np.float32),
            "output_bias": np.zeros(len(languages), np.float32),
        }

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Patches of every position and the filters' responses, not yet pooled."""
        p, longest = self.parameters, max(WIDTHS)
        embedded = p["embedding"][x]
        spots = WINDOW - longest + 1
        patches = np.concatenate([embedded[:, k : k + spots] for k in range(longest)], axis=2)
        return patches, (patches.reshape(-1, patches.shape[2]) @ p["filters"]).reshape(len(x), spots, -1)

    def _logits(self, peak: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.parameters
        active = np.maximum(peak + p["bias"], 0)
        return active, active @ p["output"] + p["output_bias"]

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for k in range(0, len(x), _BATCH):
            logits = self._logits(self._pooled(x[k : k + _BATCH])[1].max(axis=1))[1].astype(np.float64)
            logits -= logits.max(axis=1, keepdims=True)
            out.append(logits - np.log(np.exp(logits).sum(axis=1, keepdims=True)))
        return np.concatenate(out)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, rate: float = 4e-3, batch: int = 64, seed: int = 0) -> None:
        rng, p = np.random.default_rng(seed), self.parameters
        mean = {k: np.zeros_like(v) for k, v in p.items()}
        square = {k: np.zeros_like(v) for k, v in p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for k in range(0, len(x), batch):
                at = order[k : k + batch]
                step += 1
                for name, g in self._gradients(x[at], y[at]).items():
                    mean[name] = 0.9 * mean[name] + 0.1 * g
                    square[name] = 0.999 * square[name] + 0.001 * g * g
                    p[name] -= (rate * mean[name] / (1 - 0.9**step) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.parameters, len(x)
        patches, responses = self._pooled(x)
        spot = responses.argmax(axis=1)
        active, logits = self._logits(np.take_along_axis(responses, spot[:, None], axis=1)[:, 0])
        probability = np.exp(logits - logits.max(axis=1, keepdims=True))
        probability /= probability.sum(axis=1, keepdims=True)
        probability[np.arange(n), y] -= 1
        probability /= n
        back = (probability @ p["output"].T) * (active > 0)
        peaks = patches[np.arange(n)[:, None], spot]  # window, filter, patch
        to_patch = back[:, :, None] * p["filters"].T
        to_embedding = np.zeros_like(p["embedding"])
        for k in range(max(WIDTHS)):
            letters = x[np.arange(n)[:, None], spot + k]
            np.add.at(to_embedding, letters, to_patch[:, :, k * EMBEDDING : (k + 1) * EMBEDDING])
        return {
            "embedding": to_embedding,
            "filters": self.mask * np.einsum("nfp,nf->pf", peaks, back),
            "bias": back.sum(axis=0),
            "output": active.T @ probability,
            "output_bias": probability.sum(axis=0),
        }

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and probability of each text."""
        found: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
        if not self.languages:
            return found
        told = [k for k, t in enumerate(texts) if t and has_letter(t)]
        if told:
            parts = [windows(texts[k].encode()) for k in told]
            begins = np.cumsum([0, *map(len, parts)])
            means = np.add.reduceat(self.log_probabilities(np.concatenate(parts)), begins[:-1], axis=0) / np.diff(begins)[:, None]
            means = np.exp(means - means.max(axis=1, keepdims=True))
            means /= means.sum(axis=1, keepdims=True)
            for k, row in zip(told, means):
                found[k] = self.languages[int(row.argmax())], float(row.max())
        return found


def samples(usable: DataFrame, sizes: dict[str, int], per_language: int, windows_each: int) -> DataFrame:
    """(lang, order, windows): ``windows_each`` windows at most of the documents taken."""
    # One pass: a row is taken if its hash falls below its language's share.
    span = 1 << 31
    shares = usable.sparkSession.createDataFrame([(v, min(span, span * per_language // n)) for v, n in sizes.items()], "lang string, share long")
    taken = usable.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < F.col("share"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = []
            for order, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode() if has_letter(text) else b""
                rows = windows(data)[: max(1, len(data) // WINDOW)]  # a padded window only for a short text
                own = np.random.default_rng(order % (1 << 63)).permutation(len(rows))[:windows_each]
                some.append(rows[own].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(some, pa.binary())], ["lang", "order", "windows"])

    taken = taken.select("lang", F.xxhash64("doc_id", "text").alias("order"), F.col("text").cast("string").alias("text"))
    return taken.mapInArrow(cut, "lang string, order long, windows binary")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, windows_each: int = 4) -> ByteCnn:
    usable = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return ByteCnn([])
    # About per_language rows a language, more only where one id has many rows.
    taken = samples(usable, sizes, per_language, windows_each).orderBy("order", "windows").limit(2 * per_language * len(sizes))
    languages = sorted(sizes)
    number = {v: k for k, v in enumerate(languages)}
    x, y = [], []
    for row in taken.collect():
        some = windows(bytes(row.windows))
        x.append(some)
        y.extend([number[row.lang]] * len(some))
    if not y:
        return ByteCnn([])
    model = ByteCnn(languages)
    model.train(np.concatenate(x), np.array(y))
    return model


def languages(docs: DataFrame, model: ByteCnn) -> DataFrame:
    """One row per row of ``docs`` (see ``SCHEMA``)."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [f for _, texts in text_slices(batch.column(2).to_pylist()) for f in model.predict(texts)]
            names, score = zip(*found) if found else ((), ())
            arrays = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "lang_pred", "score"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(apply, SCHEMA)
