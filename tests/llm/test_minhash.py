import random
from collections import Counter

import numpy as np

from railweave.llm import minhash

DOCS = "doc_id long, text string"


def bag(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def similarity(a, b):
    common, total = sum((a & b).values()), sum((a | b).values())
    return common / total if total else 1.0


def corpus():
    r = random.Random(9)
    vocabulary = ["".join(r.choice("abcdefg") for _ in range(4)) for _ in range(400)]
    prose = lambda n: [r.choice(vocabulary) for _ in range(n)]
    out = [prose(r.choice((3, 20, 120, 400))) for _ in range(60)]
    for base in out[:25]:
        for _ in range(r.randint(1, 6)):  # chains of edits: not all members resemble each other
            base = list(base)
            for _ in range(max(0, len(base) // r.choice((40, 60, 200)))):
                base[r.randrange(len(base))] = r.choice(vocabulary)
            out.append(base)
    out += [["same", "few", "words"]] * 5 + [prose(6) * 300] * 2 + [prose(1) * 900, prose(1) * 950]
    texts = [" ".join(t) for t in out] + [None, "", " \n"]
    texts[5] = texts[5].upper()
    return [(3 * i + 1, t) for i, t in enumerate(texts)] + [(1, texts[0]), (None, texts[0])]


def test_classes_match_brute_force(spark):
    rows = corpus()
    sets = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= 0.8:
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    expect = sorted(((d, min(x for x in g if x is not None), len(g)) for g in groups.values() for d in g), key=str)
    table = spark.createDataFrame(rows, DOCS).repartition(3)
    assert sorted((tuple(r) for r in minhash.dedup_documents(table).collect()), key=str) == expect
    kept = minhash.keep_one(table.withColumnRenamed("text", "text").selectExpr("*", "'x' AS node", "1 AS band")).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, c, _ in expect}) and kept[0].node == "x"


def test_signature_estimates_the_weighted_similarity():
    r = np.random.default_rng(3)
    keys = np.unique(r.integers(0, 1 << 48, 300, dtype=np.uint64))
    a, b = r.integers(1, 30, len(keys)), r.integers(1, 30, len(keys))
    both = minhash.signatures(np.tile(keys, 2), np.concatenate([a, b]), np.array([len(keys), 2 * len(keys)]), 4096)
    assert abs((both[0] == both[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_pairs_at_the_bound_share_a_band():
    """Nobody looks at a pair without a common band again: at 0.8 that may happen once in 300,000 times."""
    assert (1 - 0.8**minhash.ROWS) ** minhash.BANDS < 3.3e-6
    r = np.random.default_rng(11)
    missed = 0
    for _ in range(4):
        keys = r.integers(0, 1 << 48, (1000, 10), dtype=np.uint64)
        both = np.stack([keys[:, :9], keys[:, 1:]], 1).reshape(-1)  # 8 of 10 shingles in common
        best = minhash.signatures(both, np.ones(len(both), np.int64), np.arange(9, len(both) + 1, 9))
        band = minhash.band_keys(best)
        missed += int((~(band[::2] == band[1::2]).any(1)).sum())
    assert missed == 0


def test_bands_go_on_until_all_pairs_are_settled(spark, monkeypatch):
    """Every node in one band: classes must still come out whole."""
    monkeypatch.setattr(minhash, "SALT_PAIRS", 3)
    rows = [r for r in corpus() if r[1] and len(r[1].split()) > 15][:40]
    table = spark.createDataFrame(rows, DOCS)
    expect = sorted(map(tuple, minhash.dedup_documents(table).collect()))
    whole = minhash.signed

    def crowded(docs):
        return whole(docs).withColumn("bands", minhash.F.array(minhash.F.lit(1).cast("long")))

    monkeypatch.setattr(minhash, "signed", crowded)
    assert sorted(map(tuple, minhash.dedup_documents(table).collect())) == expect


def test_no_rows_and_no_pairs(spark):
    assert minhash.dedup_documents(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, "a b c d e f"), (2, "g h i j k l")]
    assert sorted(map(tuple, minhash.dedup_documents(spark.createDataFrame(rows, DOCS)).collect())) == [(1, 1, 1), (2, 2, 1)]


def test_odd_bits_never_say_more_than_the_shingles_differ():
    """Edits of one text, all in one band: what resembles the text but not each other is settled without a comparison."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for edits in [0, 1, 2, 3] * 20 + [5, 6, 7, 8] * 20:
        words = list(base)
        for _ in range(edits):
            words[r.randrange(len(words))] = f"x{r.random()}"
        texts.append(" ".join(words))
    texts += ["a b " * 300, "a b " * 320, "a b " * 500, None, "a"]
    keys, counts, ends = minhash.bags(texts)
    odd, sets = minhash.odd_bits(keys, counts, ends).view(np.uint64), [bag(t) for t in texts]
    ruled_out = unlike = 0
    for i in range(len(texts)):
        for j in range(i):
            bits = int(np.bitwise_count(odd[i] ^ odd[j]).sum())
            apart = sum(((sets[i] - sets[j]) + (sets[j] - sets[i])).values())
            assert bits <= apart and (bits - apart) % 2 == 0
            if similarity(sets[i], sets[j]) < 0.8:
                unlike += 1
                ruled_out += bits * 9 > sum(sets[i].values()) + sum(sets[j].values())
    assert ruled_out > 0.9 * unlike


def test_crowded_band_compares_few_unlike_pairs(spark, monkeypatch):
    """A band of edits of one text compared nearly all of its pairs, though few are similar."""
    r = random.Random(6)
    rows = []
    for i in range(60):
        words = [f"w{k}" for k in range(150)]
        for k in r.sample(range(5, 145), 6):
            words[k] = f"x{i}-{k}"
        rows.append((i, " ".join(words)))
    whole, verify, compared = minhash.signed, minhash._verify, []
    monkeypatch.setattr(minhash, "signed", lambda docs: whole(docs).withColumn("bands", minhash.F.array(minhash.F.lit(1).cast("long"))))
    monkeypatch.setattr(minhash, "_verify", lambda pairs, bags: compared.append(pairs.count()) or verify(pairs, bags))
    found = minhash.dedup_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, found)) == [(i, i, 1) for i in range(60)]
    assert sum(compared) < 100  # of 1,770 pairs
