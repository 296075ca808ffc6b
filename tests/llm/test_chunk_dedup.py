import hashlib
import random
import re

from railweave.llm import chunk_dedup

DOCS = "doc_id long, text string"


def brute(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out = []
    for k, (i, t) in enumerate(norm):
        same = [(j is None, j, m) for m, (j, u) in enumerate(norm) if u == t]
        first = min(same, key=lambda s: (s[0], -1 if s[1] is None else s[1], s[2]))
        out.append((i, first[1], len(same), first[2] == k, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus():
    r = random.Random(5)
    words = ["alpha", "beta", "gamma", "délta", "ε", "\t", "\n\n", "  ", "x" * 300]
    long_text = " ".join(r.choice(words) for _ in range(40_000))
    rows = [(1, "a  b"), (2, "a b"), (3, "a\tb"), (4, " a b"), (5, None), (6, ""), (7, long_text), (8, long_text.replace(" ", "\n")),
            (9, long_text + "!"), (10, "z"), (10, "z"), (None, "z"), (None, "q"), (11, "\r\n")]
    rows += [(100 + k, " ".join(r.choice(words) for _ in range(r.randint(0, 400)))) for k in range(60)]
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, DOCS).coalesce(1)  # one partition: the input order decides ties
    return sorted(map(tuple, chunk_dedup.exact_groups(df, **kw).collect()), key=str)


def test_equals_brute_force(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_clashing_names_are_settled_by_bytes(spark):
    rows = corpus()
    assert run(spark, rows, name_bytes=1, salts=3) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "x y", "kept", 3), (2, "x  y", "no", 4)], "doc_id long, text string, kept string, recipe int")
    got = sorted(map(tuple, chunk_dedup.exact_groups(df).select("doc_id", "keep_id", "kept").collect()))
    assert got == [(1, 1, True), (2, 1, False)]


def test_cuts_are_content_defined():
    r = random.Random(1)
    body = bytes(r.randrange(256) for _ in range(50_000))
    a, b = chunk_dedup.cuts(body), chunk_dedup.cuts(b"prefix" + body)
    assert a[-1] == len(body) and all(0 < y - x <= chunk_dedup.MAX_CHUNK for x, y in zip([0] + a, a))
    shifted = {e - 6 for e in b}
    assert len(set(a[3:-1]) & shifted) >= len(a[3:-1]) - 1
    assert chunk_dedup.cuts(b"") == [] and chunk_dedup.cuts(b"\0" * 20_000)[-1] == 20_000


def test_recipes_come_from_names_alone_and_the_digest_from_the_same_pass(spark):
    rows = [(1, "word " * 900), (2, ""), (3, "Straße")]
    df = spark.createDataFrame(rows, "doc_id long, norm string").selectExpr("doc_id", "norm", "doc_id AS _row")
    both, names = chunk_dedup.chunked(df), chunk_dedup.chunked(df, with_bytes=False)
    assert names.columns == ["_row", "doc_id", "text_sha256", "names"] and both.columns == [*names.columns, "chunks"]
    got = {r.doc_id: r for r in both.collect()}
    for r in names.collect():
        text = dict(rows)[r.doc_id].encode()
        assert b"".join(map(bytes, got[r.doc_id].chunks)) == text and r.names == got[r.doc_id].names
        assert r.text_sha256 == hashlib.sha256(text).hexdigest()
