import hashlib
import random

import duckdb
import public_tokenizers

from lapsewise.llm.bpe import NumpyBpe, encode_and_decode
from lapsewise.llm.chunk_ids import load_tokenizer

from .test_tokens import ROWS4, SCHEMA, SYMBOLS

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_ids_and_decoded_text_are_the_librarys():
    rng = random.Random(7)
    texts = ["".join(rng.choices(SYMBOLS, k=rng.randint(0, 14))) for _ in range(3000)]
    texts += ["a" * n for n in range(1, 40)] + ["ababab" * 9, "hahahaha", "x" * 3000, "'ll've's it's", "don't", "aaa aaaa"]
    texts += [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    library, bpe = load_tokenizer(PATH), NumpyBpe(PATH)
    bpe.learn({w for t in texts for w in bpe.words(t)})
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == ids, repr(text)
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)
        assert bpe.digests([text])[0][1] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_table(spark):
    rows = encode_and_decode(spark.createDataFrame(ROWS4, SCHEMA).repartition(3), PATH).collect()
    library = load_tokenizer(PATH)
    expected = []
    for doc_id, text, *_ in ROWS4:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    assert encode_and_decode(spark.createDataFrame([], SCHEMA), PATH).collect() == []
