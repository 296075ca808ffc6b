import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from railweave.llm import packing

DOCS = "doc_id long, text string"


def expected(text):
    tokenizer = Tokenizer.from_file(packing.VOCABULARY)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


def test_pieces_hold_each_id_once_and_sequences_have_no_gaps(spark):
    r = random.Random(2)
    words = ["alpha", "Straße", "don't", "x9", "日本", "…", "é", " ", "a\tb", "<|endoftext|>"]
    texts = [None, "", " \n ", "one"] + [" ".join(r.choice(words) for _ in range(r.choice((3, 50, 900, 5000)))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)) + [(3, "one")], DOCS)
    got = packing.pack_documents(rows).collect()
    docs, seqs = {}, {}
    for p in got:
        docs.setdefault(p.doc_id, []).append(p)
        seqs.setdefault(p.sequence_id, []).append(p)
    for i, text in enumerate(texts):
        ids, own = expected(text), sorted(docs[i], key=lambda p: p.start)
        if i == 3:
            assert len(own) == 2
            continue
        assert sum(p.length for p in own) == len(ids) and all(p.doc_tokens == len(ids) for p in own)
        for p in own:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
    for own in seqs.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096


def test_little_padding(spark):
    r = np.random.default_rng(3)
    lengths = np.minimum(4096, np.exp(r.normal(6, 1.2, 20_000)).astype(int) + 1)
    lengths[:6_000] = 77  # a third of all rows alike
    rows = spark.createDataFrame([(int(n), "x") for n in lengths], "length long, offset_note string")
    used = packing.pack(rows).select("sequence_id").distinct().count()
    assert used * 4096 < lengths.sum() * 1.04


@pytest.mark.parametrize("lengths", [[], [1] * 5000, [4096, 4096, 1], [2049] * 50])
def test_plain_cases(spark, lengths):
    rows = spark.createDataFrame([(n,) for n in lengths], "length long")
    got = packing.pack(rows).collect()
    assert sorted(r.length for r in got) == sorted(lengths)
    best = {0: 0, 5000: 2, 3: 3, 50: 50}[len(lengths)]
    assert len({r.sequence_id for r in got}) == best


def test_words_are_looked_up_once_for_all_their_places_in_a_run(monkeypatch):
    texts = [None, "", "one two one", "two\none  Straße", "x" * 100, None, "a\tb " * 50, " "]
    known, asked = packing._Words(packing.VOCABULARY), []
    monkeypatch.setattr(known, "places", lambda words, real=known.places: asked.append(len(words)) or real(words))
    ids, n = packing._encoded(pa.array(texts), known, packing.END)
    assert ids.tolist() == sum(map(expected, texts), []) and n.tolist() == [len(expected(t)) for t in texts]
    assert asked == [len({w for t in texts if t is not None for w in t.replace("\n", " ").split(" ")})]


def test_runs_of_texts_and_forgotten_words_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "SLICE_BYTES", 40)
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    texts = pa.array(["alpha beta gamma", None, "delta " * 30, "", "beta é epsilon zeta eta", "alpha"])
    runs = list(packing._slices(texts))
    assert [i for a, b in runs for i in range(a, b)] == list(range(len(texts))) and len(runs) > 2
    known = packing._Words(packing.VOCABULARY)
    got = sum((packing._encoded(texts.slice(a, b - a), known, packing.END)[0].tolist() for a, b in runs), [])
    assert got == sum(map(expected, texts.to_pylist()), []) and list(packing._slices(texts.slice(0, 0))) == []
