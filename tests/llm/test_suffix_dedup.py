import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lapsewise.llm import chunk_ids, suffix_dedup
from lapsewise.llm.suffix_dedup import merged, removal_report, without, without_repeats

SCHEMA = "doc_id long, text string, spans string, doc string, n_chars long"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", None, len(t or "")) for i, t in texts], SCHEMA)


def brute(texts, span):
    data = [(t or "").encode() for _, t in texts]
    seen = Counter(d[p : p + span] for d in data for p in range(len(d) - span + 1))
    rows = []
    for (i, _), d in zip(texts, data):
        runs = merged([p << 32 | p + span for p in range(len(d) - span + 1) if seen[d[p : p + span]] > 1])
        rows.append((i, len(d), sum(b - a for a, b in runs), len(runs), hashlib.sha256(without(d, runs)).hexdigest()))
    return sorted(rows, key=repr)


def noise(rng, n):
    return "".join(rng.choices("abcdé ", k=n))


@pytest.mark.parametrize("span, class_size", [(8, 8192), (40, 3), (200, 8192), (200, 2)])
def test_equals_brute_force(spark, span, class_size):
    rng = random.Random(span)
    shared = [noise(rng, n) for n in (span - 1, span, span + 1, 2 * span, 5 * span)]
    texts = [(0, None), (1, ""), (2, "a" * 3 * span), (None, shared[4]), (3, "x" * (span - 1)), (4, shared[1]), (5, shared[1])]
    for k in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts.append(noise(rng, rng.randint(0, 2 * span)))
            passage = rng.choice(shared)
            a = rng.randint(0, len(passage))
            parts.append(passage if rng.random() < 0.5 else passage[a:] if rng.random() < 0.5 else passage[:a])
        texts.append((10 + k, "".join(parts)))
    texts += [(11, texts[-2][1]), (90, texts[-3][1]), (91, texts[-3][1] + "z"), (92, texts[-3][1]), (92, texts[-3][1])]
    got = removal_report(frame(spark, texts).repartition(4), span, class_size).collect()
    assert sorted(map(tuple, got), key=repr) == brute(texts, span)


def test_alphabet_of_one_and_two_letters(spark):
    rng = random.Random(2)
    texts = [(k, "".join(rng.choices("ab", k=rng.randint(0, 60)))) for k in range(80)] + [(100, "a" * 500), (101, "ab" * 200)]
    assert sorted(map(tuple, removal_report(frame(spark, texts), 12).collect()), key=repr) == brute(texts, 12)


def test_cut_texts_keep_columns(spark):
    rng = random.Random(4)
    passage = "é" + noise(rng, 300) + "é"
    texts = [(1, "one " + passage + " end"), (2, "two " + passage + " fin"), (3, None), (3, None), (4, "clean")]
    rows = without_repeats(frame(spark, texts)).collect()
    assert "é" + passage[1:40] not in rows_text(rows, 1)
    assert rows_text(rows, 1).startswith("one") and rows_text(rows, 1).endswith("end")
    assert [(r.spans, r.doc, r.n_chars) for r in rows if r.doc_id == 4] == [("x", None, 5)]


def rows_text(rows, doc_id):
    return next(r.text for r in rows if r.doc_id == doc_id)


def test_empty_table(spark):
    assert removal_report(frame(spark, [])).collect() == []
    assert without_repeats(frame(spark, [])).collect() == []


def test_slices_are_bounded_and_whole():
    rng = random.Random(6)
    texts = [None if k % 50 == 7 else noise(rng, rng.randint(0, 6000)) for k in range(1500)]
    texts += ["é" * suffix_dedup.SLICE, "", "end"]
    for kind in (pa.string(), pa.large_string()):
        batch = pa.RecordBatch.from_arrays([pa.array(["cut", *texts], kind)], ["text"]).slice(1)
        found, row = [], 0
        for at, data, starts in suffix_dedup._buffers(batch, 0):
            assert at == row and (len(data) <= suffix_dedup.SLICE or len(starts) == 2)
            found += [data[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
            row = len(found)
        assert found == [(t or "").encode() for t in texts]
    nulls = pa.RecordBatch.from_arrays([pa.array([None, None, ""], pa.string())], ["text"])
    assert [(at, len(data), list(starts)) for at, data, starts in suffix_dedup._buffers(nulls, 0)] == [(0, 0, [0, 0, 0, 0])]


def peak(work) -> int:
    tracemalloc.start()
    work()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_a_worker_holds_little_beside_a_batch():
    """Batches of Spark's size, 10,000 rows: arrays over positions took 164 MB with slices
    of 2 MB, those over windows 112 MB with a batch at once."""
    text = np.random.default_rng(1).integers(97, 123, 2200, np.uint8).tobytes().decode()
    texts = pa.RecordBatch.from_arrays([pa.array([text[k % 100 :] + str(k) for k in range(10_000)])], ["text"])

    def all_anchors():
        for _, data, starts in suffix_dedup._buffers(texts, 0):
            suffix_dedup.anchors(data, starts, 200)

    assert peak(all_anchors) < 80e6
    n, more = 10_000, 74
    columns = [[k // 3 for k in range(n)], list(range(n)), list(range(n)), [k << 18 | more << 2 | 1 for k in range(n)]]
    columns = [pa.array(c, pa.int64()) for c in columns] + [pa.array([text[k % 3 * 500 :][: more + 200].encode() for k in range(n)])]
    sorted_rows = pa.RecordBatch.from_arrays(columns, ["gram", "doc_id", "text_hash", "at", "bytes"])
    assert peak(lambda: [None for _ in suffix_dedup._repeated_inside(iter([sorted_rows]), 200)]) < 80e6


@pytest.mark.parametrize("size", [1, 2, 7, 2000])
def test_buckets_across_parts_are_whole(monkeypatch, size):
    rng = random.Random(8)
    rows = []
    for k in range(80):  # equal windows are in one bucket: each has two letters of its own
        gram = rng.randint(0, 6)
        rows.append((gram, k, k, k << 18 | 4 << 2 | rng.randint(1, 2), bytes(rng.choices((65 + 2 * gram, 66 + 2 * gram), k=12))))
    rows.sort()

    def spans(part, window):
        monkeypatch.setattr(suffix_dedup, "SURROUNDINGS", window)
        columns = [pa.array(c) for c in zip(*rows)]
        batch = pa.RecordBatch.from_arrays(columns, ["gram", "doc_id", "text_hash", "at", "bytes"])
        got = suffix_dedup._repeated_inside((batch.slice(k, part) for k in range(0, len(rows), part)), 8)
        return sorted(tuple(r.values()) for some in got for r in some.to_pylist())

    assert spans(13, size) == spans(len(rows), 10_000) != []


def test_other_operators_give_up_the_encoder(monkeypatch):
    monkeypatch.setattr(chunk_ids, "_ENCODERS", {("kind",): object()})
    monkeypatch.setattr(chunk_ids, "_TOKENIZERS", {"path": object()})
    chunk_ids.release_encoders()
    assert not chunk_ids._ENCODERS and not chunk_ids._TOKENIZERS
