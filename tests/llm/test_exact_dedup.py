import hashlib
import re

import pytest

from lapsewise.llm.exact_dedup import deduplicated, duplicate_groups

SCHEMA = "doc_id long, text string, digest string, row string, first int"
TEXTS = [(1, "a  b"), (2, "a b"), (0, "a\t\nb"), (3, "c"), (None, "c"), (None, "only null ids"), (None, "only null ids"), (4, None), (5, ""), (6, " "),
         (7, "a b"), (8, "rep"), (8, "rep"), (9, "long " * 30000), (10, "long  " * 30000), (8, "other")]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", None, k) for k, (i, t) in enumerate(texts)], SCHEMA)


def expected(texts):
    groups = {}
    for k, (i, t) in enumerate(texts):
        groups.setdefault(re.sub("[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    rows = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        kept_left = 1
        for i in sorted(ids, key=lambda i: (i is None, i)):
            rows.append((i, keep, len(ids), kept_left == 1, hashlib.sha256(text.encode()).hexdigest()))
            kept_left = 0
    return sorted(rows, key=repr)


@pytest.mark.parametrize("options", [{}, {"digest_bits": 8}, {"trigger_bytes": 1}])
def test_groups_equal_brute_force(spark, options):
    """Also with a digest so short that different texts share it, and over many micro-batches."""
    texts = TEXTS + [(100 + k, f"text {k % 90}") for k in range(400)]
    rows = duplicate_groups(frame(spark, texts).repartition(5), **options).collect()
    assert sorted(map(tuple, rows), key=repr) == expected(texts)


def test_deduplicated_keeps_columns_and_one_row_a_text(spark):
    got = deduplicated(frame(spark, TEXTS))
    assert got.columns == ["doc_id", "text", "digest", "row", "first"]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == sorted((i is None, i or 0) for i, _, _, kept, _ in expected(TEXTS) if kept)


def test_empty_table(spark):
    assert duplicate_groups(frame(spark, [])).collect() == []


def test_no_python_on_the_data_path(spark):
    plan = duplicate_groups(frame(spark, TEXTS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
