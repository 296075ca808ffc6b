import base64
import hashlib
import random

import public_tokenizers as P
import tiktoken

from railweave.llm import byte_bpe

DOCS = "doc_id long, text string"


def library():
    with open(byte_bpe.VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    r = random.Random(1)
    some = ["", None, " ", "a", "\n\n  x", "it's we'll 12345 …", "naïve café ", "日本語のテキスト", "🙂👩‍👩‍👧", "ab" * 400, "x" * 3000, "\x00\x01", "  \t\r\n end "]
    return some + ["".join(r.choice("abcdetlönñ '.,1 \n") for _ in range(r.randint(1, 200))) for _ in range(100)]


def test_same_as_the_library(spark):
    own, all_texts = library(), texts()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(all_texts)], DOCS)
    got = {r.doc_id: r for r in byte_bpe.round_trip(rows).collect()}
    assert len(got) == len(all_texts)
    for i, t in enumerate(all_texts):
        ids = own.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids), t
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_other_columns_stay_and_empty_tables_work(spark):
    rows = spark.createDataFrame([(1, "a b", "x", None), (1, "a b", "x", None)], "doc_id long, text string, ids2 string, `rank` string")
    out = byte_bpe.encode(rows).collect()
    assert len(out) == 2 and out[0].ids2 == "x" and out[0]["rank"] is None and list(out[0].ids) == library().encode_ordinary("a b")
    assert byte_bpe.round_trip(spark.createDataFrame([], DOCS)).count() == 0
