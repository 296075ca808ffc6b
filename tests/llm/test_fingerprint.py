import hashlib
import random

from railweave.llm import fingerprint as f

DOCS = "doc_id long, text string"


def prose(r, n):
    return " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(n))


def test_edited_texts_and_next_documents(spark):
    r = random.Random(4)
    texts = [prose(r, r.choice((1, 5, 80, 700))) for _ in range(90)] + ["", None, "aaaa" * 3000, "é" * 7, "same text", "same text"]
    docs = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    got = {x.doc_id: x for x in f.compare_with_next(spark.createDataFrame(docs, DOCS).repartition(5)).collect()}
    assert len(got) == len(docs)
    ordered = sorted(docs)
    prints = {}
    for (i, t), (_, u) in zip(ordered, ordered[1:] + ordered[:1]):
        t, u, x = t or "", u or "", got[i]
        edited = t[:len(t) - len(t) // 2] + u[:len(t) // 2]
        assert x.n_chars == len(t) and x.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(t, x.fingerprint) == x.fingerprint
        assert 0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1
        if len(t) > 2000 and len(set(t)) > 5:
            assert x.near_edited > x.near_next + 0.1
    assert all(f.fingerprints(spark.createDataFrame(docs, DOCS)).select("doc_id", "fingerprint").toPandas().set_index("doc_id").fingerprint[i] == got[i].fingerprint for i in (1000, 997))


def test_interior_phrases_do_not_depend_on_the_offset():
    r = random.Random(5)
    body = prose(r, 400)
    a, b, other = f.sketches([body, "zz" + prose(r, 3) + body, prose(r, 400)])
    assert f.likeness(a, b) > 0.8 > 0.2 > f.likeness(a, other)


def test_few_rows(spark):
    assert f.compare_with_next(spark.createDataFrame([], DOCS)).count() == 0
    one = f.compare_with_next(spark.createDataFrame([(7, "abcdef")], DOCS)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    rows = f.compare_with_next(spark.createDataFrame([(None, "b"), (1, None), (1, "x"), (1, "x")], DOCS)).collect()
    assert len(rows) == 4
