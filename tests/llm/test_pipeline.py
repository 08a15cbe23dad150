import zlib

import numpy as np
import public_tokenizers

import corpus_pipeline
from lapsewise.llm import toxicity
from lapsewise.llm.chunk_ids import load_tokenizer
from lapsewise.llm.suffix_dedup import merged, without

from .test_exact_dedup import expected as exact_groups
from .test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.01"


def brute_force(spark, rows):
    """The pipeline's texts before packing, by other means (the toxicity model is the operator's own)."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels)
    clean = [(i, t) for i, t in rows if not model.above([t])[0, 0] >= model.cut]
    kept = {i for i, _, _, stays, _ in exact_groups(clean) if stays}
    distinct = [(i, t) for i, t in clean if i in kept]
    group = plain_components([plain_fingerprint(t) for _, t in distinct])
    least = {}
    for (i, _), g in zip(distinct, group):
        least[g] = min(i, least.get(g, i))
    single = [(i, t) for i, t in distinct if i in least.values()]
    data = [(t or "").encode() for _, t in single]
    seen = {}
    for d in data:
        for p in range(len(d) - 199):
            seen[d[p : p + 200]] = seen.get(d[p : p + 200], 0) + 1
    out = {}
    for (i, _), d in zip(single, data):
        runs = merged([p << 32 | p + 200 for p in range(len(d) - 199) if seen[d[p : p + 200]] > 1])
        out[i] = without(d, runs).decode(errors="ignore")
    return out


def test_pipeline_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    texts = brute_force(spark, rows)
    assert 0 < len(texts) < len(rows)
    pieces = corpus_pipeline.run(spark, SF).collect()
    library = load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in texts.items()}
    assert {r.doc_id for r in pieces} == set(ids)
    covered = dict.fromkeys(ids, 0)
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.start == covered[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        covered[r.doc_id] += r.length
    assert all(covered[i] == len(own) for i, own in ids.items())


def test_stages_keep_columns_and_pass_odd_rows(spark, tmp_path):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, "s", None), (3, "a b c", "en", None, 5),
           (3, "a b c", "en", None, 5), (4, "word " * 5000, "en", "s", 25000)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        got = {r.doc_id for r in docs.collect()}
        # Null and empty texts are equal; the smallest id of them stays.
        assert got == ({1, 3, 4} if rows else set())
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
