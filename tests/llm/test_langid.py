"""Language identification: held-out accuracy and odd inputs."""

import zlib

import pytest
from pyspark.sql import functions as F

from ratemill.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.identify(docs, "doc_id", "text", "lang")


def test_held_out_accuracy(spark, docs, model):
    rows = langid.predict(docs, "text", model).where(langid.fold(F.col("doc_id")) == langid.HELD_OUT).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_only_unseen_words(model):
    # Words that no training text holds, made of its syllables.
    assert "erschungenkeitlichbe" not in model.words
    assert model.predict("erschungenkeitlichbe verkeitenheitung")[0] == "de"
    assert model.predict("thationingthered ofthationerly")[0] == "en"


def test_odd_texts(spark, model):
    texts = [None, "", "123 !? \n", "the", "²", "́", "the of and " * 200_000, "Ω"]
    table = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    rows = langid.predict(table.select("doc_id", "text"), "text", model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows[:4]] == ["und", "und", "und", "en"]
    assert [r.lang_pred for r in rows[4:7]] == ["und", "und", "en"]
    assert rows[7].lang_pred in model.languages
    assert [r.score for r in rows[:3]] == [0.0] * 3


def test_null_ids_labels_and_empty_tables(spark):
    rows = [(None, "the and of", "en"), (None, "der die das", "de"), (0, "no label", None), (3, None, "fr"), (4, "und und der", "de")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    own = langid.identify(table, "doc_id", "text", "lang")
    assert own.languages == ["de", "en"]
    assert own.predict("the")[0] == "en" and own.predict("der")[0] == "de"
    nothing = langid.identify(table.limit(0), "doc_id", "text", "lang")
    assert nothing.predict("words") == ("und", 0.0)
    assert langid.predict(table.limit(0), "text", own).count() == 0


def test_backing_off_is_in_order():
    import numpy as np

    grams = [{"<abc": np.array([1.0, 0.0])}, {"abc": np.array([2.0, 0.0])}, {}, {"z": np.array([3.0, 0.0])}]
    own = langid.Model(["a", "b"], langid.Scores.of({"abc": [9.0, 0.0]}, 2), [langid.Scores.of(g, 2) for g in grams], -50.0)
    want = [9.0, 1.0 + langid.DISCOUNT, 2.0 + 2 * langid.DISCOUNT, 3.0 + 4 * langid.DISCOUNT, -50.0]
    words = ["abc", "abcd", "xabc", "z", "q"]
    assert own.score(words)[:, 0].tolist() == pytest.approx(want)


def test_training_equals_a_plain_loop(spark, docs):
    """Log frequencies of words and n-grams of all labelled documents outside the fold, and sums
    and shares of some texts."""
    import math
    import re
    from collections import Counter

    own = langid.train(docs.where(langid.fold(F.col("doc_id")) != 2), "text", "lang", F.col("doc_id").cast("string"), sample_docs=10**6, sample_chars=10**9)
    rows = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None and r.text is not None]
    names = sorted({r.lang for r in rows})
    words = {n: Counter(w for r in rows if r.lang == n for w in re.findall(r"[^\W\d_]+", r.text.lower())) for n in names}
    every = set().union(*words.values())
    assert own.languages == names and set(own.words.at) == every

    def log_share(counts, vocabulary, key):
        return [math.log(counts[n][key] + 1) - math.log(sum(counts[n].values()) + len(vocabulary)) for n in names]

    for w in sorted(every)[::50]:
        assert own.words.rows[own.words.at[w]].tolist() == pytest.approx(log_share(words, every, w))
    for size, table in zip(langid.ORDERS, own.grams):
        grams = {n: Counter() for n in names}
        for n in names:
            for w, k in words[n].items():
                for i in range(len(w) + 3 - size):
                    grams[n][f"<{w}>"[i : i + size]] += k
        known = set().union(*grams.values())
        assert set(table.at) == known
        for g in sorted(known)[::50]:
            assert table.rows[table.at[g]].tolist() == pytest.approx(log_share(grams, known, g))
    for r in rows[:40]:
        found = Counter(re.findall(r"[^\W\d_]+", r.text.lower()))
        if found:
            logs = {w: log_share(words, every, w) for w in found}
            best = max(range(len(names)), key=lambda k: (sum(n * logs[w][k] for w, n in found.items()), -k))
            share = sum(n for w, n in found.items() if logs[w][best] == max(logs[w])) / sum(found.values())
            assert own.predict(r.text) == (names[best], pytest.approx(share))


def test_score_of_mixed_and_garbled_texts(docs, model):
    """The bar of the pipeline lets clean texts through and stops long mixed and garbled ones."""
    import random

    from corpus_pipeline import MIN_LANGUAGE_SCORE

    rng = random.Random(4)
    rows = [r for r in docs.collect() if r.lang is not None and r.text and len(r.text.split()) >= 100]
    by = {n: [r.text.split() for r in rows if r.lang == n] for n in model.languages}
    kept = [model.predict(r.text)[1] >= MIN_LANGUAGE_SCORE for r in rows]
    assert sum(kept) >= 0.98 * len(kept)
    garbled = [model.predict("".join(rng.sample(r.text, len(r.text))))[1] for r in rows[:200]]
    assert sum(x < MIN_LANGUAGE_SCORE for x in garbled) >= 0.8 * len(garbled)
    a, b = model.languages[:2]
    mixed = [model.predict(" ".join(x[:400] + y[: len(x[:400])]))[1] for x, y in zip(by[a], by[b]) if len(y) >= len(x[:400])]
    assert mixed and sum(x < MIN_LANGUAGE_SCORE for x in mixed) >= 0.9 * len(mixed)


def test_words_met_later_are_forgotten_in_time(monkeypatch):
    import numpy as np

    monkeypatch.setattr(langid, "MET_WORDS", 3)
    grams = [{}, {}, {}, {c: [float(i)] for i, c in enumerate("abcdef")}]
    own = langid.Model(["a"], langid.Scores.of({"k": [7.0]}, 1), [langid.Scores.of(g, 1) for g in grams], -50.0)
    for words in (["a", "k", "b", "c", "d"], ["a", "e"], ["f", "k", "b"]):
        assert own.score(words)[:, 0].tolist() == pytest.approx([7.0 if w == "k" else "abcdef".index(w) + 4 * langid.DISCOUNT for w in words])
