import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from railweave.llm import alignment

DOCS = "doc_id long, text string"


def brute(rows):
    """Plain spans from decoded bytes alone, links by comparing every pair of tokens."""
    a = Tokenizer.from_file(public_tokenizers.path(alignment.A_FILE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.B_FILE))
    chars = alignment._byte_chars()
    a_vocab = {i: t for t, i in a.get_vocab().items()}

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    per = []
    for doc_id, text in rows:
        if not text:
            per.append((doc_id, None))
            continue
        target = (" " + text).encode()
        ai = a.encode(" " + text, add_special_tokens=False).ids
        bi = b.encode(text)
        ab = [bytes(chars[c] for c in a_vocab[i]) for i in ai]
        bb = [b_bytes(i) for i in bi]
        if b"".join(ab) != target or b"".join(bb) != target:
            per.append((doc_id, None))
            continue
        ae, be = list(itertools.accumulate(map(len, ab))), list(itertools.accumulate(map(len, bb)))
        links = [(ai[x], bi[y]) for x in range(len(ai)) for y in range(len(bi))
                 if (ae[x - 1] if x else 0) < be[y] and (be[y - 1] if y else 0) < ae[x]]
        cuts = sorted(set(ae) & set(be))
        groups, lo = [], 0
        for c in cuts:
            ga = [i for i, e, s in zip(ai, ae, [0] + ae) if lo <= s and e <= c]
            gb = [i for i, e, s in zip(bi, be, [0] + be) if lo <= s and e <= c]
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            lo = c
        per.append((doc_id, (len(ai), len(bi), groups, links)))
    count = Counter(p for _, found in per if found for p in set(found[3]))
    top = Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, found in per:
        if found is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


def corpus():
    r = random.Random(3)
    words = ["the", "Straße", "日本語", "😀", "ᚠᛇᚻ", "<|endoftext|>", "<s>", "  ", "\t", "\n", "naïve", "x" * 40, "é́", "\x00"]
    rows = [(k, " ".join(r.choice(words) for _ in range(r.randint(1, 30)))) for k in range(40)]
    return rows + [(100, None), (101, ""), (102, " "), (103, "the the"), (103, "the the"), (None, "Straße")]


def test_equals_brute_force(spark):
    rows = corpus()
    got = alignment.align_documents(spark.createDataFrame(rows, DOCS), salts=3)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_long_text_clashing_columns_and_empty_table(spark):
    long_text = "word ü 日本 " * 20_000
    df = spark.createDataFrame([(1, long_text, 5, "x"), (2, "", 6, "y")], "doc_id long, text string, n_a int, pairs string")
    got = {r.doc_id: r for r in alignment.align_documents(df).collect()}
    assert got[1].n_a > 40_000 and got[1].n_groups > 0 and got[2].n_a == 0 and got[2].groups_sha256 == ""
    assert alignment.align_documents(spark.createDataFrame([], DOCS)).count() == 0


def tools():
    return alignment.Tools(public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE))


def test_stretches_align_as_the_whole_text(monkeypatch):
    r = random.Random(8)
    parts = ["the", "Straße", "日本語", "😀", "<|endoftext|>", "<s>", "\t", "\n", "\u00a0", "\u3000", "\x1c", "\x85", "\u2581", "\u200b", "é\u0301",
             "\x00", "'s", "don't", "12a", "...", "<0x41>"]
    texts = ["".join(r.choice(parts) + r.choice(["", " ", " ", "  "]) for _ in range(r.randint(1, 12))) for _ in range(3_000)]
    texts += [None, "", " ", "  ", "a ", "a  ", " a", "a b"]
    own, plain = alignment.Known(tools()), tools()
    monkeypatch.setattr(alignment, "CACHED", 2_000)  # so that what is known is forgotten several times
    for i in range(0, len(texts), 100):
        batch = texts[i:i + 100]
        for text, (n, spelled, pair, m) in zip(batch, alignment.align_texts(batch, own), strict=True):
            found = alignment.align_text(text, plain)
            if found is None:
                assert n == (0, 0, 0, 0) and spelled == "" and len(pair) == len(m) == 0
                continue
            wanted, groups, link_a, link_b = alignment.groups_and_links(*found)
            pairs, times = np.unique((link_a << 32) | link_b, return_counts=True)
            assert (n, spelled) == ((len(found[0]), len(found[2]), groups, len(link_a)), wanted), text
            assert pair.tolist() == pairs.tolist() and m.tolist() == times.tolist()


def test_a_stretch_is_aligned_once(monkeypatch):
    seen = []
    monkeypatch.setattr(alignment, "align_run", lambda run, t, real=alignment.align_run: seen.extend(run) or real(run, t))
    own = alignment.Known(tools())
    got = list(alignment.align_texts(["one two one", "two one two"], own)) + list(alignment.align_texts(["one"], own))
    assert sorted(seen) == [" one", " two"] and [n[3] > 0 for n, *_ in got] == [True] * 3
