import itertools

import numpy as np
import pytest

from railweave.llm import language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")


def test_held_out_accuracy(spark, docs):
    got = language.predict_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 150 and (got.lang == got.lang_pred).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_words_of_mixed_text_and_odd_rows(spark, docs):
    model = language.train(docs)
    some = {r.lang: " ".join(r.text.split()[:40]) for r in docs.where("length(text) > 400").orderBy("doc_id").collect()}
    mixed = some["en"] + " " + some["fr"]
    rows = [(1, mixed, "a"), (2, None, None), (3, "", ""), (4, "12 | .. !", ""), (5, "x" * 50_000, ""), (1, mixed, "a"), (6, some["de"] * 400, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string, words_ string")
    got = {r.doc_id: r for r in language.label_words(table, model).collect()}
    assert (np.array(got[1].langs[:40]) == "en").mean() > 0.8 and (np.array(got[1].langs[40:]) == "fr").mean() > 0.8
    out = language.identify(table, model).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == 7 and by[2].lang_pred == by[3].lang_pred == by[4].lang_pred == "und" and by[4].score == 0
    assert by[6].lang_pred == "de" and by[5].lang_pred in model.langs
    assert language.identify(table.limit(0), model).count() == 0


def test_copies_count_once_in_the_training_sample(spark, monkeypatch):
    texts = [f"passage number {'abcdefghij'[i]} of ten" for i in range(10)]
    rows = [(i, t, lang) for lang in ("aa", "bb") for t in texts for i in range(50)]
    monkeypatch.setattr(language, "_fit", lambda passages: passages)
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    assert language.train(table, 10) == sorted((lang, t) for lang in ("aa", "bb") for t in texts)
    least = [r.text for r in table.select("text").distinct().orderBy(language.F.xxhash64("text")).limit(4).collect()]
    assert language.train(table, 4) == sorted((lang, t) for lang in ("aa", "bb") for t in least)


def test_marginals_match_enumeration():
    r = np.random.default_rng(1)
    moves, sizes = r.normal(size=(3, 3)), np.array([4, 0, 1, 5])
    scores = r.normal(size=(10, 3))
    post, pairs = language.marginals(scores, moves, sizes)
    at, expect, expect_pairs = 0, np.zeros((10, 3)), np.zeros((3, 3))
    for n in sizes:
        total, own, between = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            w = np.exp(sum(scores[at + i, k] for i, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += w
            for i, k in enumerate(path):
                own[i, k] += w
            for a, b in zip(path, path[1:]):
                between[a, b] += w
        expect[at:at + n] = own / total
        expect_pairs += between / total
        at += n
    assert np.allclose(post, expect) and np.allclose(pairs, expect_pairs)


def test_blocks_join_up():
    r = np.random.default_rng(2)
    moves, scores = r.normal(size=(4, 4)), r.normal(size=(900, 4))
    long, _ = language.marginals(scores, moves, np.array([900]))
    saved, language.BLOCK = language.BLOCK, 1000
    try:
        whole, _ = language.marginals(scores, moves, np.array([900]))
    finally:
        language.BLOCK = saved
    assert np.allclose(long, whole)
