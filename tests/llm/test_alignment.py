import collections
import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers

from lapsewise.llm.alignment import Aligner, alignments

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SYMBOLS = [*"abcXYZ 019.,'!?\n\t  éüñß日本漢字😀🎉", " ", "　", "​", "́", "\x1c", "\x85", "\x00", "\r\n", " ", " ", " the", " word",
           "<|endoftext|>", "<s>", "<0x0A>", "'s", " ", "▁", "👨‍👩‍👧", "ﷺ"]
SCHEMA = "doc_id long, text string, n_a string, row string, bucket string, links string"


def by_definition(aligner, text):
    """(n_a, n_b, groups as text, links) from all tokens of the whole text."""
    if not text:
        return 0, 0, "", []
    ids = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    tokens = [aligner.bytes_a[k] for k in ids[0]], [aligner.bytes_b[k] for k in ids[1]]
    if any(b"".join(t) != (" " + text).encode() for t in tokens):
        return 0, 0, "", []
    ends = [np.cumsum([len(t) for t in side]).tolist() for side in tokens]
    groups, links, at = [], [], [0, 0]
    for end in sorted(set(ends[0]) & set(ends[1])):
        to = [side.index(end) + 1 for side in ends]
        groups.append("|".join(",".join(map(str, i[a:b])) for i, a, b in zip(ids, at, to)))
        links.append((ids[0][to[0] - 1], ids[1][to[1] - 1]))
        at = to
    return len(ids[0]), len(ids[1]), ";".join(groups), links


def unpacked(aligner, found):
    n_a, n_b, groups, links = found
    return n_a, n_b, groups, [(k >> aligner.shift, k & (1 << aligner.shift) - 1) for k in np.frombuffer(links, aligner.link_type).tolist()]


def test_words_at_a_time_equal_whole_texts():
    rng = random.Random(11)
    texts = ["".join(rng.choices(SYMBOLS, k=rng.randint(0, 40))) for _ in range(2500)]
    texts += [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    texts += ["x" * 5000, "日" * 3000, " lead", "trail ", "\nline", "a\n\nb", "a \nb", "▁", " "]
    for aligner in (Aligner(A, B), Aligner(A, B, cache_bytes=20_000)):
        for k in range(0, len(texts), 100):
            for text, got in zip(texts[k : k + 100], aligner.align_batch(texts[k : k + 100])):
                assert unpacked(aligner, got) == by_definition(aligner, text), repr(text)


def test_table_with_counts_over_all_documents(spark):
    rng = random.Random(12)
    texts = [None, "", "▁ no tokens", "one two", "one two", "one two three " * 400, *("".join(rng.choices(SYMBOLS, k=rng.randint(0, 30))) for _ in range(60))]
    rows = [(k if k % 7 else None, t, "clash", None, "clash", "clash") for k, t in enumerate(texts)] + [(3, "one two", "", "", "", "")]
    aligner = Aligner(A, B)
    found = [by_definition(aligner, r[1]) for r in rows]
    counts = collections.Counter(pair for f in found for pair in f[3])
    best = collections.defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    expected = []
    for (doc_id, *_), (n_a, n_b, groups, links) in zip(rows, found):
        n_best = sum(counts[p] == best[p[1]] for p in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        expected.append((doc_id, n_a, n_b, len(links), len(links), n_best, sum(counts[p] for p in links), digest))
    for bucket_links in (1 << 21, 50):
        got = alignments(spark.createDataFrame(rows, SCHEMA).repartition(3), A, B, bucket_links=bucket_links)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert alignments(spark.createDataFrame([], SCHEMA), A, B).collect() == []
