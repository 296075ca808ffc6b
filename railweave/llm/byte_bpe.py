"""Byte-level BPE with a segment tree over byte positions.

Each leaf holds ``rank << bits | position`` of the pair that starts there, so the root is the
leftmost pair of least rank.  A merge changes at most three leaves (the pair, its right half
and the pair before it) and their paths to the root.  Many pieces are merged side by side as
rows of numpy arrays; long pieces get a wider tree, never a cut.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
NONE = np.int64(1 << 62)
CACHED_PIECES = 300_000  # a memory bound of the lookup of pieces met before, nothing else
CELLS = 1 << 20  # leaves merged side by side


class Ranks:
    """A rank file: ids are ranks; ``pairs`` lists every two ids whose bytes join to a third."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        size = max(self.ranks.values()) + 1
        vocabulary = [b""] * size
        for token, rank in self.ranks.items():
            vocabulary[rank] = token
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in vocabulary])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(vocabulary), np.uint8)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        keys, values = [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int64)[order]

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def merge(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of pieces of at most ``width`` bytes, a power of two."""
        rows, bits = len(pieces), width.bit_length()
        lengths = np.array([len(p) for p in pieces])
        text = np.zeros((rows, width), np.uint8)
        text[np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        token = self.single[text]
        after = np.minimum(np.arange(1, width + 1), lengths[:, None])  # the length itself: no successor
        before = np.tile(np.arange(-1, width - 1), (rows, 1))
        alive = np.arange(width) < lengths[:, None]
        tree = np.full((rows, 2 * width), NONE)
        pair = self.pair(token[:, :-1], token[:, 1:])
        pair[~alive[:, 1:]] = NONE
        tree[:, width:-1] = np.where(pair < NONE, pair << bits | np.arange(width - 1), NONE)
        level = width // 2
        while level:
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
            level //= 2
        todo = np.flatnonzero(tree[:, 1] < NONE)
        while len(todo):
            best = tree[todo, 1]
            at, rank = best & ((1 << bits) - 1), best >> bits
            gone = after[todo, at]
            right = after[todo, gone]
            token[todo, at] = rank
            after[todo, at] = right
            alive[todo, gone] = False
            inside = right < lengths[todo]
            before[todo[inside], right[inside]] = at[inside]
            left = before[todo, at]
            tree[todo, width + gone] = NONE
            new = np.where(inside, self.pair(rank, token[todo, np.where(inside, right, 0)]), NONE)
            tree[todo, width + at] = np.where(new < NONE, new << bits | at, NONE)
            has = left >= 0
            new = np.where(has, self.pair(token[todo, left], rank), NONE)
            left = np.where(has, left, at)
            tree[todo, width + left] = np.where(has, np.where(new < NONE, new << bits | left, NONE), tree[todo, width + at])
            node = (width + np.stack([gone, at, left])) >> 1
            while node[0, 0]:
                tree[todo, node] = np.minimum(tree[todo, 2 * node], tree[todo, 2 * node + 1])
                node >>= 1
            todo = todo[tree[todo, 1] < NONE]
        ids, ends = token[alive].astype("<i4"), np.cumsum(alive.sum(1))
        return np.split(ids, ends[:-1])

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Little-endian 32-bit ids of each piece."""
        out, widths = {}, {}
        for piece in pieces:
            raw = piece.encode("utf-8", "replace")
            whole = self.ranks.get(raw)
            if whole is not None:
                out[piece] = whole.to_bytes(4, "little")
            else:
                widths.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for width, own in widths.items():
            step = max(1, CELLS // width)
            for i in range(0, len(own), step):
                part = own[i:i + step]
                for (piece, _), ids in zip(part, self.merge([raw for _, raw in part], width)):
                    out[piece] = ids.tobytes()
        return out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, and where each id's bytes end."""
        sizes = self.starts[ids + 1] - self.starts[ids]
        ends = np.cumsum(sizes)
        return self.bytes[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - ends + sizes, sizes)], ends


@lru_cache(maxsize=2)
def _load(path: str) -> tuple[Ranks, dict[str, bytes]]:
    return Ranks(path), {}


def _offsets(lengths) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Replace ``text`` by its ids; all other columns stay, but one named ``ids`` is replaced.

    Null and empty texts give an empty array.
    """
    rest = [c for c in df.columns if c not in (text, ids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (ranks, cache), find = _load(path), regex.compile(pattern).findall
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                found = [find(t) if t else [] for t in batch.column(text).to_pylist()]
                new = set().union(*found).difference(cache)
                if len(cache) + len(new) > CACHED_PIECES:
                    cache.clear()
                    new = set().union(*found)
                cache.update(ranks.encode_pieces(list(new)))
                joined = [b"".join(map(cache.__getitem__, pieces)) for pieces in found]
                values = pa.array(np.frombuffer(b"".join(joined), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.ListArray.from_arrays(_offsets([len(j) // 4 for j in joined]), values)],
                                                 [*rest, ids])

    return df.select(*rest, text).mapInArrow(run, StructType([*df.select(*rest).schema.fields, StructField(ids, ArrayType(IntegerType(), False))]))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str = VOCABULARY) -> DataFrame:
    """Add the bytes that the ids stand for (a column of that name is replaced); null ids give no bytes."""
    df = df.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, _ = _load(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                lists = batch.column(ids)
                counts = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0))
                data, ends = ranks.decode(np.asarray(lists.flatten()).astype(np.int64))
                upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
                column = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(upto.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, out])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(out, BinaryType())]))


def round_trip(docs: DataFrame) -> DataFrame:
    """Per row of ``doc_id, text``: how many ids, and digests of the ids and of what they decode to."""
    both = decode(encode(docs.select("doc_id", "text")))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
