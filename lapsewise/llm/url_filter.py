"""URL filter by the ratio of two character language models.

Rules decide what they fit: a rule is a host and a path, fits that host and its
subdomains where the url's path starts with the rule's, and of several the
longest (as text; then the longer host) wins. The urls that rules decide are
what is learned from: the allowed ones and the blocked ones each give a
variable-order Markov model over characters, the start and end of a url
included. A character's probability mixes the orders that were seen before it,
longest first, by Witten-Bell smoothing

    P_k(c | k characters) = (n(k characters, c) + t P_{k-1}(c)) / (n + t)

with n the times and t the kinds of what followed those k characters; orders
that were never seen are passed over, and below order 0 all code points are
equal. A url's score is the difference of the two log-likelihoods by character.

The score is calibrated to P(allow) by logistic regression over all decided
urls, each scored without the half of the urls (by a hash of the host and path)
that it belongs to. A url that no rule decides is allowed if P(allow) is a half
or more. Lacking allowed or blocked urls nothing is learned and such urls are
allowed.

Counts cover every url and lie in tables; windows of characters are counted in
buckets of rows, so a host that holds most urls sends each window once a
bucket, and a bucket gets back the scores of its own windows only.

A null url, and one without ``://``, has an empty host and path; a null one is
judged as an empty text. Repeated rows count and are judged as often as they
occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch

ORDER = 4  # characters of context at most
BUCKET_CHARS = 1 << 18
START, END = "\x02", "\x03"
BINS = 4096  # of scores between -BOUND and BOUND, for the calibration
BOUND = 8.0
CODE_POINTS = 0x110000
# Which halves of the decided urls a model counts: both, all but the first, all but the second.
VARIANTS = ((0, 1), (1,), (0,))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The rule that decides and its verdict; null where none fits. ``rules`` are
    (verdict, host/path)."""
    rule = verdict = F.lit(None).cast("string")
    # The longest is tested first, so it is the outermost.
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"))):
        of, slash, rest = text.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def windows(url: str, order: int) -> list[str]:
    """Every character of the url and its end, each behind the ``order`` characters before."""
    padded = START * order + url + END
    return [padded[k : k + order + 1] for k in range(len(padded) - order)]


def log_ratios(counts: np.ndarray, followers: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """log P(allowed) - log P(blocked) of the last characters of windows, for every
    variant: [window, variant]. Counts of the gram of every order, of all that
    followed its context, and the kinds of that: [window, order, variant, class]."""
    p = np.full(counts.shape[:1] + counts.shape[2:], 1.0 / CODE_POINTS)
    for k in range(counts.shape[1]):
        seen = followers[:, k] > 0
        mixed = (counts[:, k] + kinds[:, k] * p) / np.where(seen, followers[:, k] + kinds[:, k], 1)
        p = np.where(seen, mixed, p)
    logs = np.log(p)
    return logs[..., 0] - logs[..., 1]


def calibrate(score: np.ndarray, allowed: np.ndarray, blocked: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """(a, b) of P(allow) = logistic(a score + b) for counts of urls by score:
    Newton's method on the likelihood with a small penalty on a."""
    a, b, n = 0.0, 0.0, allowed + blocked
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -500, 500)))
        slope = n * p * (1 - p)
        gradient = np.array([((n * p - allowed) * score).sum() + 1e-3 * a, (n * p - allowed).sum()])
        curve = np.array([[(slope * score**2).sum() + 1e-3, (slope * score).sum()], [(slope * score).sum(), slope.sum() + 1e-9]])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def _window_counts(judged: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    """(bucket, window, allowed and blocked counts in each half). Undecided urls add zeros."""
    schema = "bucket long, window string, a0 long, a1 long, b0 long, b1 long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            found: dict[int, dict[str, list[int]]] = {}
            for bucket, url, kind in zip(*(got.column(k).to_pylist() for k in range(3))):
                of = found.setdefault(bucket, {})
                for window, n in Counter(windows(url, order)).items():
                    counts = of.setdefault(window, [0, 0, 0, 0])
                    if kind is not None:
                        counts[kind] += n
            for bucket, of in found.items():
                columns = [pa.array([bucket] * len(of), pa.int64()), pa.array(of.keys(), pa.string())]
                columns += [pa.array(c, pa.int64()) for c in zip(*of.values())]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "window", "a0", "a1", "b0", "b1"])

    # Place among the four counts: allowed or blocked, first or second half.
    kind = F.when(F.col("verdict") == "allow", F.col("half")).when(F.col("verdict") == "block", F.col("half") + 2)
    counted = judged.select("bucket", F.coalesce("url", F.lit("")).alias("url"), kind.cast("int").alias("kind")).mapInArrow(count, schema)
    sums = [F.sum(c).alias(c) for c in ("a0", "a1", "b0", "b1")]
    return scratch.write(counted.groupBy("bucket", "window").agg(*sums), "windows")


def _scored_windows(in_bucket: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    """(window, ratios by variant) of every window met."""
    sums = [F.sum(c).alias(c) for c in ("a0", "a1", "b0", "b1")]
    met = scratch.write(in_bucket.groupBy("window").agg(*sums), "met")
    known = met.where("a0 + a1 + b0 + b1 > 0")
    tail = lambda k: F.substring("window", order + 1 - k, k + 1)
    grams = known.select(F.explode(F.array(*[tail(k) for k in range(order + 1)])).alias("gram"), "a0", "a1", "b0", "b1")
    grams = scratch.write(grams.groupBy("gram").agg(*sums), "grams")
    # What followed each context: sums and kinds, by variant and class.
    parts = [(v, c, F.col(f"{c}{halves[0]}") if len(halves) == 1 else F.col(f"{c}0") + F.col(f"{c}1")) for v, halves in enumerate(VARIANTS) for c in "ab"]
    context = grams.select(F.expr("substring(gram, 1, length(gram) - 1)").alias("key"), *[n.alias(f"{c}{v}") for v, c, n in parts])
    names = [f"{c}{v}" for v, c, _ in parts]
    context = context.groupBy("key").agg(*[F.sum(n).alias(f"n_{n}") for n in names], *[F.count_if(F.col(n) > 0).alias(f"t_{n}") for n in names])
    context = context.select(
        F.lit(1).alias("is_context"), "key", F.array(*[f"n_{n}" for n in names]).alias("n"), F.array(*[f"t_{n}" for n in names]).alias("t")
    )
    context = scratch.write(context, "contexts")
    counts = grams.select(F.lit(0).alias("is_context"), F.col("gram").alias("key"), F.array(*[n for _, _, n in parts]).alias("n"), F.lit(None).cast("array<bigint>").alias("t"))
    # Order 0 follows every window: one row, looked up once here.
    overall = context.where("key = ''").first()
    asked = [F.struct(F.lit(0).alias("is_context"), F.lit(k).alias("k"), tail(k).alias("key")) for k in range(order + 1)]
    asked += [F.struct(F.lit(1).alias("is_context"), F.lit(k).alias("k"), F.substring("window", order + 1 - k, k).alias("key")) for k in range(1, order + 1)]
    wanted = met.select("window", F.explode(F.array(*asked)).alias("q")).select("window", "q.*")
    answers = wanted.join(counts.unionByName(context.where("key <> ''")), ["is_context", "key"])
    answers = answers.groupBy("window").agg(F.collect_list(F.struct("is_context", "k", "n", "t")).alias("found"))  # 2 order + 1 at most
    answers = met.select("window").join(answers, "window", "left")
    first = [[0] * 6, [0] * 6] if overall is None else [list(overall.n), list(overall.t)]

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            size = got.num_rows
            counts, followers, kinds = (np.zeros((size, order + 1, len(VARIANTS), 2)) for _ in range(3))
            followers[:, 0], kinds[:, 0] = (np.array(v).reshape(-1, 2) for v in first)
            lists = got.column(1)
            row = np.repeat(np.arange(size), np.array(lists.value_lengths().fill_null(0)))
            found = lists.flatten()
            is_context, k = (np.array(found.field(c)) for c in ("is_context", "k"))
            n = np.array(found.field("n").flatten()).reshape(-1, len(VARIANTS), 2)
            t = np.array(found.field("t").filter(pa.array(is_context == 1)).flatten()).reshape(-1, len(VARIANTS), 2)
            gram = is_context == 0
            counts[row[gram], k[gram]] = n[gram]
            followers[row[~gram], k[~gram]], kinds[row[~gram], k[~gram]] = n[~gram], t
            ratios = log_ratios(counts, followers, kinds)
            yield pa.RecordBatch.from_arrays([got.column(0), *[pa.array(r) for r in ratios.T]], ["window", "all", "not0", "not1"])

    return scratch.write(answers.mapInArrow(evaluate, "window string, all double, not0 double, not1 double"), "ratios")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], order: int = ORDER, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict (allow or
    block), score (log-likelihood difference by character) and allow_probability."""
    scratch = Scratch(pages.sparkSession, "url-filter")
    judged_schema = "page_id long, url string, host string, path string, rule string, verdict string, half int"
    names = [field.split()[0] for field in judged_schema.split(", ")]

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A bucket closes with the row that fills it."""
        base = TaskContext.get().partitionId() << 33
        chars = 0
        for got in batches:
            before = np.cumsum([len(u or "") + 1 for u in got.column(1).to_pylist()]) + chars
            yield pa.RecordBatch.from_arrays([*got.columns, pa.array(base + np.append(chars, before[:-1]) // bucket_chars)], [*names, "bucket"])
            chars = int(before[-1])

    url = F.col("url")
    host, path = host_and_path(url)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    half = F.pmod(F.xxhash64("host", "path"), F.lit(2)).cast("int")
    rows = rows.select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("verdict"), half.alias("half"))
    judged = scratch.write(rows.mapInArrow(bucketed, judged_schema + ", bucket long"), "judged")

    in_bucket = _window_counts(judged, order, scratch)
    ratios = in_bucket.select("bucket", "window").join(_scored_windows(in_bucket, order, scratch), "window")

    def score(rows: pa.Table, known: pa.Table) -> pa.Table:
        values = np.column_stack([known[c].to_numpy() for c in ("all", "not0", "not1")])
        place = {w: k for k, w in enumerate(known["window"].to_pylist())}
        scores = []
        for url, verdict, half in zip(*(rows[c].to_pylist() for c in ("url", "verdict", "half"))):
            at = [place[w] for w in windows(url or "", order)]
            scores.append(float(values[at, 0 if verdict is None else 1 + half].mean()))
        return rows.select(["page_id", "host", "path", "rule", "verdict"]).append_column("score", pa.array(scores, pa.float64()))

    schema = "page_id long, host string, path string, rule string, verdict string, score double"
    scored = scratch.write(judged.groupBy("bucket").cogroup(ratios.groupBy("bucket")).applyInArrow(score, schema), "scored")
    place = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") + BOUND) * (BINS / (2 * BOUND))))).cast("int")
    counts = np.zeros((2, BINS))
    for r in scored.where("verdict is not null").groupBy("verdict", place.alias("bin")).count().collect():  # 2 * BINS at most
        counts[0 if r.verdict == "allow" else 1, r.bin] = r["count"]
    if counts[0].sum() and counts[1].sum():
        a, b = calibrate((np.arange(BINS) + 0.5) * (2 * BOUND / BINS) - BOUND, counts[0], counts[1])
        allow = 1 / (1 + F.exp(-(a * F.col("score") + b)))
    else:
        allow = F.lit(1.0)
    scored = scored.withColumn("allow_probability", allow)
    decided = F.coalesce("verdict", F.when(F.col("allow_probability") >= 0.5, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", decided.alias("verdict"), "score", "allow_probability")
