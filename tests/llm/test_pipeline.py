import corpus_pipeline as p
from test_minhash import bag, similarity
from test_substrings import brute

from railweave.llm import packing

SF = "/root/testdata/sf0.001"


def ids(docs):
    return sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_each_stage_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = p.store(p.identify_language(spark, docs, SF), "test-known")
    assert known.columns == docs.columns and known.dtypes == docs.dtypes
    spoken = [r for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    assert len(spoken) * 0.97 <= known.count() <= len(spoken)

    single = p.store(p.drop_near_duplicates(spark, known, SF), "test-single")
    rows = sorted(known.collect(), key=lambda r: r.doc_id)
    sets, root = [bag(r.text) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    assert ids(single) == sorted(rows[i].doc_id for i in set(root)) and single.dtypes == docs.dtypes

    cut = p.store(p.remove_repeated_passages(spark, single, SF), "test-cut")
    expect = {b[0]: b for b in brute([(r.doc_id, r.text) for r in single.collect()])}
    before = {r.doc_id: r.text for r in single.collect()}
    assert cut.dtypes == docs.dtypes and cut.count() == len(expect)
    for r in cut.collect():
        lost = len(before[r.doc_id].encode()) - len(r.text.encode())
        assert expect[r.doc_id][2] <= lost <= expect[r.doc_id][2] + 6 * expect[r.doc_id][3] and r.n_chars == len(r.text)

    placed = p.pack(spark, cut, SF).collect()
    tokenizer, _ = packing._load(packing.VOCABULARY)
    for r in cut.collect():
        n = len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
        assert sum(x.length for x in placed if x.doc_id == r.doc_id) == n
    assert sorted(map(tuple, p.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted((x.doc_id, x.start, x.length, x.ids_crc32) for x in placed)


def test_language_stage_drops_named_junk_alone(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    some = {r.lang: r.text.split()[:40] for r in docs.where("length(text) > 400").orderBy("doc_id").collect()}
    assert len(some) > 2
    mixed = " ".join(w for lang in sorted(some) for w in some[lang])
    junk = {-11: None, -12: "", -13: " \n", -14: "12 | .. !", -15: "0 1 2 " * 500}
    odd = [*((i, t, None) for i, t in junk.items()), (-1, mixed, None), (-2, f"{mixed} " * 20, None)]
    rows = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    spoken = sorted(r.doc_id for r in rows.collect() if any(c.isalpha() for c in r.text or ""))
    assert ids(p.identify_language(spark, rows, SF)) == spoken and not set(junk) & set(spoken)

    # a model to which all languages are equally likely knows no word
    model = p.language.train(docs)
    for a in (model.weights, model.listed, model.moves):
        a[:] = 0
    monkeypatch.setattr(p.language, "train", lambda docs: model)
    assert ids(p.identify_language(spark, rows, SF)) == []


def test_odd_rows_and_extra_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, node string, kept string, n_bytes int, sequence_id int, `row` string"
    more = (0.5, "zz", "n", "k", 1, 2, "r")
    text = "the of and that with for are this have from they which one were all " * 30
    rows = [(1, text, "en", "s", 5, *more), (2, None, None, None, None, *[None] * 7), (3, "", "en", "s", 0, *more), (4, text, "en", None, 5, *more), (4, text, "en", None, 5, *more),
            (None, "der die und das ist nicht mit auf ein eine für von dem " * 20, "de", "s", 1, *more), (5, "é" * 150 + "x", "fr", "s", 1, *more), (6, "é" * 150 + "y", "fr", "s", 1, *more)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in p.STAGES[:-1]:
        docs = p.store(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == [c.split()[0].strip("`") for c in schema.split(", ")]
    got = {r.doc_id: r for r in docs.collect()}
    assert 2 not in got and 3 not in got and 4 not in got and got[1].score == 0.5 and got[1].lang_pred == "zz"
    assert {got[5].text, got[6].text} == {"x", "y"}
    assert {r.doc_id for r in p.pack(spark, docs, SF).collect()} == set(got)
    for _, stage in p.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
