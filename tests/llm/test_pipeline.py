"""The pipeline's stages against plain loops over the same rows."""

import pytest
from .test_simhash import fingerprint, smallest_reachable

import corpus_pipeline
from ratemill.llm import langid, quality
from ratemill.session import new_scratch, written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], SF), new_scratch(spark, "test-stage")))
    return docs


def test_columns(outputs):
    for df in outputs[1:-1]:
        assert df.columns == outputs[0].columns and df.dtypes == outputs[0].dtypes


def test_languages(outputs):
    before, after = outputs[0], outputs[1]
    model = langid.identify(before, "doc_id", "text", "lang")
    want = []
    for r in before.collect():
        name, score = model.predict(r.text)
        if name != "und" and score >= corpus_pipeline.MIN_LANGUAGE_SCORE:
            want.append(tuple(r))
    assert sorted(map(tuple, after.collect())) == sorted(want)


def test_quality(outputs):
    verdict = {r.doc_id: r for r in quality.quality_rules(outputs[1], "doc_id", "text", "source").collect()}
    got = {r.doc_id: r for r in outputs[2].collect()}
    assert set(got) == {i for i, r in verdict.items() if r.kept}
    texts = {r.doc_id: r.text for r in outputs[1].collect()}
    for i, r in got.items():
        assert r.n_chars == len(r.text)
        if verdict[i].words_left == verdict[i].n_words:
            assert r.text == texts[i]


def test_one_of_each_group(outputs):
    prints = {r.doc_id: fingerprint(r.text) for r in outputs[2].collect()}
    root = smallest_reachable(set(prints.values()), lambda a, b: bin(a ^ b).count("1") <= 3)
    first = {}
    for i in sorted(prints):
        first.setdefault(root[prints[i]], i)
    assert sorted(r.doc_id for r in outputs[3].collect()) == sorted(first.values())
    assert len(first) < len(prints)


def test_all_that_is_left_is_packed(outputs):
    assert {r.doc_id for r in outputs[4].select("doc_id").distinct().collect()} == {r.doc_id for r in outputs[3].collect()}
    sums = outputs[4].groupBy("sequence_id").agg({"length": "sum"}).toDF("id", "n").collect()
    assert all(0 < r.n <= 1024 for r in sums)


def test_run(spark, outputs):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length").collect())) == sorted(
        map(tuple, outputs[4].select("doc_id", "piece", "length").collect())
    )


def test_nulls_and_repeated_rows(spark):
    text = " ".join(f"the house number{i} of street{i}" for i in range(30))
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (2, text, None, None, None), (None, text, "en", "s", 5), (None, text + " more", "en", "s", 1),
            (3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, "123", None, "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    more = docs.selectExpr("*", "'x' AS _key", "1 AS _row", "2 AS _score", "3 AS key", "4 AS fp")
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, more, SF).columns == more.columns
    one = corpus_pipeline.keep_known_languages(spark, docs, SF)
    assert one.count() == 5
    two = corpus_pipeline.keep_good_texts(spark, one, SF)
    assert two.count() == 5
    three = corpus_pipeline.keep_one_of_each_group(spark, two, SF)
    kept = three.collect()
    assert len([r for r in kept if r.text == text]) == 1
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
