import zlib

import numpy as np
import pytest

from lapsewise.llm import langid, quality, toxicity
from lapsewise.llm.queries import op4_quality, op6_toxicity, op8_language_id

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, score string, label int"


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_quality_of_held_out_documents(spark):
    known = labels(spark)
    rows = op4_quality(spark, SF).collect()
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    told = [(known[r.doc_id].quality, r.score, r.predicted) for r in rows if r.held_out and r.doc_id in known]
    right = np.mean([p == q for q, _, p in told])
    good, bad = ([s for q, s, _ in told if q == k] for k in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    print(f"quality: held-out accuracy {right:.3f}, AUC {auc:.3f} of {len(told)}")
    assert right > 0.95 and auc > 0.97


def test_toxicity_of_held_out_documents(spark):
    known = labels(spark)
    rows = op6_toxicity(spark, SF).collect()
    told = [(known[r.doc_id].toxic, r.toxic) for r in rows if is_held_out(r.doc_id) and r.doc_id in known]
    missed, wrong = sum(t and not p for t, p in told), sum(p and not t for t, p in told)
    print(f"toxicity: {missed} of {sum(t for t, _ in told)} toxic missed, {wrong} of {sum(not t for t, _ in told)} clean called toxic")
    # Some toxic rows hold no word that the labels of this size can mark.
    assert missed <= 0.15 * sum(t for t, _ in told) and wrong <= 0.01 * len(told)
    assert all(0 <= r.severity <= 3 and 0 <= r.grade <= 3 and r.toxic == (r.grade > 0) for r in rows)
    assert np.mean([r.severity for r in rows if r.toxic]) > 1 > np.mean([r.severity for r in rows if not r.toxic])
    assert all(r.toxic_probability >= 0 for r in rows)


def test_language_of_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op8_language_id(spark, SF).collect()
    told = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out and r.lang_pred != "und"]
    print(f"language: held-out accuracy {np.mean(told):.3f} of {len(told)}")
    assert np.mean(told) > 0.97 and len(rows) == len(lang)


def test_bradley_terry_prefers_what_the_pairs_prefer():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3))
    y = (x[:, 0] - 2 * x[:, 1] + 0.1 * rng.normal(size=500) > 0).astype(int)
    model = quality.BradleyTerry(x, y)
    assert model.weights[0] > 0 > model.weights[1] and np.mean((model.score(x) >= 0.7) == y) > 0.95
    assert quality.BradleyTerry(x, np.ones(500, int)).score(x[:2]).tolist() == [1.0, 1.0]
    assert quality.BradleyTerry(x[:0], y[:0]).score(x[:1]).tolist() == [0.5]


def test_ordinal_thresholds_are_ordered_and_weights_shared():
    words = ["bad", "worse"]
    model = toxicity.OrdinalWords(words)
    texts = ["fine"] * 60 + ["bad"] * 20 + ["bad worse"] * 20 + ["bad worse worse worse"] * 20
    grades = np.repeat([0, 1, 2, 3], [60, 20, 20, 20])
    model.fit(model.rows(texts), grades)
    assert (np.diff(model.thresholds) > 0).all() and (model.weights > 0).all()
    severity = model.above(["fine", "bad", "bad worse", "bad worse worse worse"]).sum(axis=1)
    assert (np.diff(severity) > 0).all()


def test_gradients_of_the_network():
    model = langid.ByteCnn(["a", "b", "c"], seed=1)
    rng = np.random.default_rng(2)
    x, y = rng.integers(97, 105, (5, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    model.parameters = {k: v.astype(np.float64) for k, v in model.parameters.items()}

    def loss():
        return -model.log_probabilities(x)[np.arange(5), y].mean()

    got = model._gradients(x, y)
    for name, values in model.parameters.items():
        for at in [tuple(rng.integers(0, s) for s in values.shape) for _ in range(6)]:
            if name == "filters" and not model.mask[at]:
                continue
            old, h = values[at], 1e-6
            values[at] = old + h
            up = loss()
            values[at] = old - h
            down = loss()
            values[at] = old
            assert got[name][at] == pytest.approx((up - down) / (2 * h), abs=1e-5)


ROWS = [(1, None, "en", "x", 1), (None, "The cat and the dog", "en", None, 1), (2, "", None, "x", 1), (2, "", None, "x", 1),
        (3, "1234 !!", "fr", "x", 1), (4, "le chat et le chien " * 4000, "fr", "x", 1), (5, "une phrase", "fr", "x", 0)]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    known = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (5, None, None), (None, 1, 1), (5, 0, 1)], "doc_id long, quality int, toxic int")
    scored = quality.scores(docs, known, quality.train(docs, known)).collect()
    assert len(scored) == len(ROWS) and all(0 <= r.score <= 1 for r in scored)
    graded = toxicity.severities(docs, toxicity.train(docs, known)).collect()
    assert len(graded) == len(ROWS)
    told = {(r.doc_id, r.lang_pred) for r in langid.languages(docs, langid.train(docs)).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= told and len([d for d, _ in told]) == 6


def test_quality_scores_recomputed_row_by_row(spark):
    """Features, utility, quantile and score of every row by plain loops."""
    docs, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.limit(3000)
    model = quality.train(docs, known)
    got = {r.doc_id: r for r in quality.scores(docs, known, model).collect()}
    label = {r.doc_id: r.quality for r in known.collect()}

    def features(text):
        raw, words, lines = text.encode(), text.split(), text.split("\n")
        n, w = max(1, len(raw)), max(1, len(words))
        share = lambda found, of: sum(found) / max(1, of)
        capitals, small = sum(65 <= b <= 90 for b in raw), sum(97 <= b <= 122 for b in raw)
        shares = [share([capitals], capitals + small), share((48 <= b <= 57 for b in raw), n), share((b in b"\t\n\x0b\x0c\r " for b in raw), n),
                  share((b >= 128 for b in raw), n), share((a == b for a, b in zip(words, words[1:])), w), len(set(words)) / w,
                  share((x.isupper() for x in words), w), share((x.isalpha() for x in words), w), len(set(lines)) / len(lines)]
        sizes = [np.log(1 + len(words)), n / w if words else 0.0, np.log(1 + len(lines)), np.log(1 + n / len(lines))]
        return [s**0.5 for s in shares] + sizes + [(raw.count(c) / n) ** 0.5 for c in map(ord, "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")]

    utility = {}
    for r in docs.collect():
        z = [min(8.0, max(-8.0, (x - m) / s)) for x, m, s in zip(features(r.text or ""), model.mean, model.scale)]
        utility[r.doc_id] = sum(a * b for a, b in zip(z, model.weights))
    told = [(utility[d], q) for d, q in label.items() if d in utility and not is_held_out(d)]
    share = sum(q for _, q in told) / len(told)
    below = sum(u < model.threshold for u, _ in told)
    assert abs(below - (1 - share) * len(told)) <= 2
    for doc_id, u in utility.items():
        x = (u - model.threshold) / model.spread + np.log(0.7 / 0.3)
        assert got[doc_id].score == pytest.approx(1 / (1 + np.exp(-x)), abs=1e-6)
    assert model.spread == pytest.approx(np.std([u for u, _ in told]) / 2, rel=1e-6)


def test_severities_recomputed_row_by_row(spark):
    docs, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.limit(3000)
    model = toxicity.train(docs, known)
    got = {r.doc_id: r for r in toxicity.severities(docs, model).collect()}
    for r in docs.collect():
        text, total = (r.text or "").lower(), 0.0
        words, word = [], ""
        for c in text + " ":
            if c.isalnum() and not c.isdecimal():
                word += c
            else:
                words += [word] if word else []
                word = ""
        for feature, k in model.words.items():
            n = sum(w[: len(feature) - 1] == feature[:-1] if feature.endswith("*") else w == feature for w in words)
            total += model.weights[k] * (1 + np.log(n)) if n else 0.0
        above = 1 / (1 + np.exp(np.clip(model.thresholds - total, -500, 500)))
        assert got[r.doc_id].severity == pytest.approx(above.sum(), abs=1e-9)
        assert got[r.doc_id].toxic == (above[0] >= model.cut)


def test_training_counts_the_words_that_scoring_sees(spark):
    """Number signs, İ and words that end in marks are cut alike on both sides."""
    texts = ["x½y İstanbul ẞ ǅ", "ab1cdefgh_ijklmnop toxicword", "", None, "TOXICWORD toxicwords"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    counted = toxicity.feature_counts(docs.selectExpr("cast(doc_id = 1 as int) toxic", "coalesce(text, '') text"))
    got = {r.word: (r.n, r.k) for r in counted.collect()}
    model = toxicity.OrdinalWords(sorted(set(got) - {""}))
    names = list(model.words)
    seen = [{names[k] for k in model.occurrences(t)} for t in texts]
    assert got == {"": (5, 1)} | {w: (sum(w in s for s in seen), int(w in seen[1])) for w in model.words}


def test_language_probabilities_recomputed_window_by_window():
    """The network by its definition: embedding, filters of each width, maximum over places, softmax."""
    model = langid.ByteCnn(["a", "b", "c"], seed=4)
    p = {k: v.astype(float) for k, v in model.parameters.items()}
    for text in ("short", "Ein längerer Text, der über mehr als ein Fenster geht. " * 5):
        data, logs = text.encode(), []
        for start in range(0, len(data), langid.WINDOW):
            window = data[start : start + langid.WINDOW].ljust(langid.WINDOW, b"\0")
            pooled = []
            for f in range(langid.FILTERS * len(langid.WIDTHS)):
                places = []
                for at in range(langid.WINDOW - max(langid.WIDTHS) + 1):
                    patch = np.concatenate([p["embedding"][b] for b in window[at : at + max(langid.WIDTHS)]])
                    places.append(float(patch @ p["filters"][:, f]))
                pooled.append(max(0.0, max(places) + p["bias"][f]))
            logits = np.array(pooled) @ p["output"] + p["output_bias"]
            logs.append(logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max())
        mean = np.exp(np.mean(logs, axis=0))
        [(name, score)] = model.predict([text])
        assert name == "abc"[int(mean.argmax())] and score == pytest.approx(mean.max() / mean.sum(), abs=1e-4)


def test_texts_without_letters_are_undetermined_and_names_may_clash(spark):
    texts = ["½", "²", "Ⅷ ①", "12 _", "٣", "é", "日"]
    docs = spark.createDataFrame([(k, t, "en", 1, 2.0) for k, t in enumerate(texts * 8)], "doc_id long, text string, lang string, share int, order double")
    got = {texts[r.doc_id % len(texts)]: r.lang_pred for r in langid.languages(docs, langid.train(docs)).collect()}
    assert got == {t: "en" if t in ("é", "日") else "und" for t in texts}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.scores(docs, known, quality.train(docs, known)).collect() == []
    model = toxicity.train(docs, known)
    assert toxicity.severities(docs, model).collect() == [] and toxicity.without_toxic(docs, model).collect() == []
    assert langid.languages(docs, langid.train(docs)).collect() == []
    rows = spark.createDataFrame(ROWS, DOCS)
    assert not any(r.toxic for r in toxicity.severities(rows, model).collect())
    assert sorted(toxicity.without_toxic(rows, model).collect(), key=repr) == sorted(rows.collect(), key=repr)


def test_every_marked_word_of_all_labels_is_kept(spark):
    """250 toxic words, 1000 features, in 30,000 labels that are not held out."""
    word = "translate(substring(md5(cast(id div 10 % 250 as string)), 1, 10), '0123456789', 'ghijklmnop')"
    docs = spark.range(40_000).selectExpr("id doc_id", f"if(id % 10 = 0, concat('some plain words ', {word}), 'some plain words') text")
    known = docs.selectExpr("doc_id", "cast(doc_id % 10 = 0 as int) toxic")
    model = toxicity.train(docs, known)
    assert len({w for w in model.words if not w.endswith("*")}) == 250
    assert toxicity.severities(docs, model).where("toxic <> (doc_id % 10 = 0)").count() == 0


def test_every_language_is_learned_from_a_few_windows(spark):
    docs = spark.range(1800).selectExpr("id doc_id", "concat('l', id % 300) lang", "if(id < 2, repeat('long text ', 20000), concat('text ', id % 300)) text")
    usable = docs.where(~langid.held_out())
    sizes = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    longest = langid.samples(usable, sizes, 500, 4).selectExpr("max(length(windows)) n").first().n
    assert longest == 4 * langid.WINDOW
    assert langid.train(docs).languages == sorted(f"l{k}" for k in range(300))
