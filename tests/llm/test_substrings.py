import hashlib
import random
from collections import Counter

import pytest

from railweave.llm import substrings

DOCS = "doc_id long, text string"


def brute(rows, length=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s:s + length] for _, b in raw for s in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = b"\x01" * length
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def corpus():
    r = random.Random(8)
    noise = lambda n: "".join(r.choice("abcdefghij klmé\x00") for _ in range(n))
    shared = [noise(n) for n in (150, 199, 200, 201, 260, 700)]
    out = []
    for i in range(120):
        text = noise(r.choice((10, 150, 400)))
        for _ in range(r.randint(0, 3)):
            p = r.choice(shared)
            a = r.randint(0, 30)
            text += r.choice((p, p[a:], p[:len(p) - a])) + noise(r.choice((0, 1, 90)))
        out.append((i, text))
    near = noise(900)
    out += [(200 + i, near[:300 + i] + "#" + near[301 + i:]) for i in range(12)]
    out += [(300, None), (301, ""), (302, "x" * 199), (303, "y" * 200), (304, "z" * 201), (305, "ab" * 2000), (306, "word " * 900), (307, near), (308, near), (308, near)]
    out += [(400 + i, "\x00" * 150 + noise(5) + "\x00" * (199 + i)) for i in range(3)]
    return out


@pytest.mark.parametrize("bounds", [{}, {"hot_segments": 2}, {"shard_segments": 20}])
def test_same_as_brute_force(spark, bounds):
    rows = corpus()
    got = substrings.dedup_documents(spark.createDataFrame(rows, DOCS).repartition(4), **bounds).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_chunks_and_other_columns(spark, monkeypatch):
    rows = [(i, t, "k") for i, t in corpus()[:60]]
    table = spark.createDataFrame(rows, "doc_id long, text string, kept string").withColumnRenamed("kept", "digest")
    got = substrings.remove_repeats(table).select("doc_id", "n_removed", "digest").collect()
    assert {r.digest for r in got} == {"k"} and sorted((r[0], r[1]) for r in got) == [(b[0], b[2]) for b in sorted(brute([r[:2] for r in rows]))]
    whole = substrings.anchors(substrings._bytes(rows[0][1].encode() * 40))
    monkeypatch.setattr(substrings, "CHUNK", 500)
    part = substrings.anchors(substrings._bytes(rows[0][1].encode() * 40))
    assert set(whole[0].tolist()) == set(part[0].tolist())


def test_no_rows(spark):
    assert substrings.dedup_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_family_marks_all_equals():
    r, family = random.Random(1), substrings.Family(5)
    segments = [bytes(r.choice(b"ab\x00") for _ in range(r.randint(5, 12))) for _ in range(200)]
    for i in range(0, 200, 7):
        family.add(segments[i:i + 7], substrings.np.zeros(len(segments[i:i + 7]), bool))
    windows = [s[k:k + 5] for s in segments for k in range(len(s) - 4)]
    count = Counter(windows)
    assert family.marked[0].tolist() == [count[w] > 1 for w in windows]
    assert len(family.levels) < 8
