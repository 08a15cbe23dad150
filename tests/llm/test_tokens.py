import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from lapsewise.llm import packing, token_store
from lapsewise.llm.chunk_ids import ByteBpeEncoder, WordBpeEncoder, load_tokenizer

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
SYMBOLS = [" ", " ", "  ", "\n", "\t", "a", "B", "é", "É", "'s", "'", "́", " ", "\x1c", "\x1f", "\x85", "　", "1", "%",
           "İ", "Σ", "漢", "<|endoftext|>", "<|startoftext|>", "🎉", "J̌", "\r\n", "٣", "​", "½", "\x00", "word", "don't"]
ROWS = [(1, "Some words, some more words."), (None, "no id"), (3, None), (4, ""), (5, "x " * 3000), (5, "x " * 3000), (6, "naïve Straße\n\n two")]
SCHEMA = "doc_id long, text string, start string, sequence_id string"
ROWS4 = [(*r, "clash", None) for r in ROWS]


@pytest.mark.parametrize("kind, path", [(ByteBpeEncoder, BYTE), (WordBpeEncoder, WORD)])
def test_word_by_word_ids_are_the_librarys(kind, path):
    rng = random.Random(3)
    texts = ["".join(rng.choices(SYMBOLS, k=rng.randint(0, 14))) for _ in range(4000)]
    got = kind(path).encode_batch(texts)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == load_tokenizer(path).encode(text, add_special_tokens=False).ids, repr(text)


def test_fullest_is_the_best_subset_with_the_largest_length():
    rng = random.Random(5)
    for _ in range(200):
        items = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        capacity = rng.randint(max(items), 60)
        counts = {n: items.count(n) for n in items}
        used = packing.fullest(sorted(counts), counts, capacity)
        sums = {0}
        rest = sorted(items)
        seed = rest.pop()
        for n in rest:
            sums |= {s + n for s in sums}
        assert used[seed] >= 1 and all(k <= counts[n] for n, k in used.items())
        assert sum(n * k for n, k in used.items()) == max(s + seed for s in sums if s + seed <= capacity)


def check_packed(rows, docs, capacity):
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for got in sequences.values():
        at = 0
        for offset, length in sorted(got):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return sequences, pieces


def test_packing_covers_every_id_once_without_padding(spark):
    docs = spark.createDataFrame(ROWS4, SCHEMA).repartition(3, "doc_id")
    rows = packing.pack_documents(docs, BYTE, capacity=64).collect()
    sequences, _ = check_packed(rows, ROWS, 64)
    totals = [sum(n for _, n in s) for s in sequences.values()]
    assert all(t & (t - 1) == 0 for t in totals)
    for doc_id, text in [(1, ROWS[0][1]), (None, "no id"), (3, ""), (4, ""), (6, ROWS[6][1])]:
        ids = np.array([*load_tokenizer(BYTE).encode(text, add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == doc_id and r.doc_tokens == len(ids))
        at = 0
        for start, length, crc in own:
            assert start == at and crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    assert sum(r.length for r in rows if r.doc_id == 5) == 2 * (len(load_tokenizer(BYTE).encode(ROWS[4][1]).ids) + 1)


def test_packing_of_an_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), BYTE).collect() == []


def test_elias_fano_round_trip_and_select():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 5), (7, 3), (1000, 10), (3000, 2**40), (700, 700)):
        values = np.sort(rng.integers(0, top, n))
        code = token_store.EliasFano.from_bytes(token_store.EliasFano.encode(values).to_bytes())
        assert code.values().tolist() == values.tolist()
        assert [code.select(i) for i in range(0, n, 13)] == values[::13].tolist()
        index = np.random.default_rng(n).permutation(n)
        assert code.select_many(index).tolist() == values[index].tolist()
        for i in range(0, n, 97):
            assert code.select_many([i]).tolist() == [values[i]]


@pytest.mark.parametrize("chunk_ids", [1 << 20, 8])
def test_store_round_trip(spark, tmp_path, chunk_ids):
    docs = spark.createDataFrame(ROWS4, SCHEMA)
    token_store.write_store(docs, str(tmp_path / "store"), WORD, chunk_ids=chunk_ids)
    got = sorted(token_store.read_store(spark, str(tmp_path / "store")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([r[0] for r in ROWS], key=lambda i: -1 if i is None else i)
    texts = dict((r[0], r[1] or "") for r in ROWS)
    at = 0
    for r in got:
        ids = np.array([*load_tokenizer(WORD).encode(texts[r.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    for wanted in ([5, 999], [1], [4, 6]):
        some = token_store.read_documents(spark, str(tmp_path / "store"), wanted).collect()
        expected = [(r[0], [*load_tokenizer(WORD).encode(r[1] or "", add_special_tokens=False).ids, 1]) for r in ROWS if r[0] in wanted]
        assert sorted(map(tuple, some)) == sorted(expected)


def test_a_document_beyond_a_chunk_of_the_real_size(spark, tmp_path):
    text = "one two three four " * 300_000
    docs = spark.createDataFrame([(1, "short"), (2, text), (3, "after")], "doc_id long, text string")
    token_store.write_store(docs, str(tmp_path / "store"), WORD)
    got = sorted(token_store.read_store(spark, str(tmp_path / "store")).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(1, 0, 2), (2, 2, 1_200_001), (3, 1_200_003, 2)]


def test_held_ids_are_bounded_in_bytes():
    from lapsewise.llm import chunk_ids

    rng = random.Random(9)
    ids = chunk_ids._Ids(load_tokenizer(BYTE), "I", room=1 << 16)
    for _ in range(60):
        met = {" " + "".join(rng.choices("abcdefé", k=rng.randint(1, 9))) for _ in range(200)} | {"long" * 3000}
        ids.learn(met)
        assert all(ids[t] == ids.encode(t) for t in met)
        batch = sum(chunk_ids._ENTRY + 5 * len(t) for t in met)
        assert ids.held <= ids.room // 2 + batch
        assert chunk_ids._ENTRY * (len(ids) + len(ids.older)) < ids.room + 2 * batch


def test_ids_are_found_at_the_first_lookup_without_a_pass_over_the_tokens():
    from lapsewise.llm import chunk_ids

    ids = chunk_ids._Ids(load_tokenizer(BYTE), "I", room=1 << 12)
    tokens = [" word", "\n", " \n", " naïve", "%%", "<|endoftext|>", "漢字", "x" * 2000, " word"] * 3
    assert [ids[t] for t in tokens] == [ids.encode(t) for t in tokens]
    assert " word" in ids or " word" in ids.older
    assert ids.held <= ids.room // 2 + chunk_ids._ENTRY + 2000 * 5


def test_store_of_an_empty_table(spark, tmp_path):
    token_store.write_store(spark.createDataFrame([], SCHEMA), str(tmp_path / "s"), WORD)
    assert token_store.read_store(spark, str(tmp_path / "s")).collect() == []
