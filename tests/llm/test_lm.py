import math
import random
import re
import zlib
from collections import Counter

from railweave.llm import lm

DOCS = "doc_id long, text string"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def corpus():
    r = random.Random(6)
    words = [f"w{i}" for i in range(40)] + ["The", "É", "x y", "a\x00b"]
    out = []
    for i in range(300):
        text, w = [], r.randrange(len(words))
        for _ in range(r.choice((0, 1, 30, 200))):
            w = (w * 3 + r.choice((0, 1, 2))) % len(words)
            text.append(words[w])
        out.append((i, r.choice((" ", "\t", "\n")).join(text)))
    return out + [(300, None), (301, ""), (302, "hot " * 4000), (None, "w1 w2"), (5, "again w3"), (5, "again w3")]


def brute(rows):
    fold = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i, _ in rows]
    uni, bi, uni_left, bi_left = Counter(), Counter(), Counter(), Counter()
    for (_, text), f in zip(rows, fold):
        t = tokens(text)
        pairs = list(zip([None, *t], t))
        if f != 2:
            uni.update(t)
            bi.update(pairs)
            if f != 3:
                uni_left.update(t)
                bi_left.update(pairs)
    n, n_left, events = sum(uni.values()), sum(uni_left.values()), Counter()
    level = lambda p: round(math.log10(p) * lm.LOG_STEPS) if p else 1
    for (_, text), f in zip(rows, fold):
        if f == 3:
            t = tokens(text)
            for h, w in zip([None, *t], t):
                c = uni_left[h]
                events[(c.bit_length(), level(bi_left[h, w] / c if c else 0), level(uni_left[w] / n_left))] += 1
    table = lm._weights(lm.mixture([(*k, c) for k, c in events.items()], len(uni_left)))
    out = []
    for (i, text), f in zip(rows, fold):
        t, base, own = tokens(text), 0.0, 0.0
        for h, w in zip([None, *t], t):
            a, b, c = table[uni[h].bit_length()]
            base += math.log10((uni[w] + 1) / (n + len(uni) + 1))
            own += math.log10((a * bi[h, w] / uni[h] if uni[h] else 0) + b * uni[w] / n + c / (len(uni) + 1))
        out.append((i, f == 2, len(t), sum(uni[w] > 0 for w in t), n, round(base, 6), round(own, 6)))
    return sorted(out, key=str)


def test_same_as_brute_force(spark):
    rows = corpus()
    table = spark.createDataFrame(rows, DOCS).repartition(5)
    fold = lm.doc_fold(lm.F.col("doc_id"), 7)
    parts = table.select("doc_id", "text", (fold != 2).alias("train"), (fold == 3).alias("tuned"))
    for got in (lm.score(parts, cell_tokens=500, range_keys=300), lm.score(parts)):
        got = got.withColumn("held_out", fold == 2).collect()
        assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got), key=str) == brute(rows)


def test_better_than_the_base_on_held_out_text(spark):
    got = lm.score_documents(spark.createDataFrame(corpus(), DOCS)).where("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum()


def test_no_rows(spark):
    assert lm.score_documents(spark.createDataFrame([], DOCS)).count() == 0
