"""Scoring by a bigram model with deleted interpolation.

p(w | h) = a p2(w | h) + b p1(w) + c / (V + 1): maximum-likelihood bigram, unigram and
uniform estimates, with three weights for each bucket (power of two) of the frequency of h.
Expectation-maximisation learns the weights on a held-out fold of the training documents,
against counts from which that fold is deleted; the final model counts all of them.

Counting without a row per token: documents are gathered in cells of about two million
tokens, each a row of packed arrays.  A cell asks for each of its distinct words and bigrams
once, hashed and sorted, in packed runs per hash range; a hash range adds up what all cells
hold and answers only where a cell's own count is not the total.  A frequent word is one
entry per cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling
from .common import doc_fold, store

CELL_TOKENS = 2_000_000
RANGE_KEYS = 2_000_000
END = np.uint64(0x656E64206F662074)
LOG_STEPS = 20  # held-out events are gathered by log10 probability in steps of 1/20

CELLS = "cell long, tuned boolean, n_tokens long, doc_id array<long>, train array<boolean>, sizes array<int>, ids binary, words binary"


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs; the first byte says how many."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.uint64(0))) if len(values) else b"\x01"


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data), dtype=np.uint64)


def _cells(docs: DataFrame, cell_tokens: int) -> DataFrame:
    """Rows of CELLS from ``doc_id, text, train, tuned``; tuned and other documents never share a cell."""

    def close(number: int, tuned: bool, docs: list[tuple[int, bool, int]], hashes: list[np.ndarray]):
        words, ids = np.unique(np.concatenate(hashes), return_inverse=True)
        doc_id, train, sizes = zip(*docs)
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in (
            (number, pa.int64()), (tuned, pa.bool_()), (len(ids), pa.int64()), (list(doc_id), pa.list_(pa.int64())), (list(train), pa.list_(pa.bool_())),
            (list(sizes), pa.list_(pa.int32())), (ids.astype("<i4").tobytes(), pa.binary()), (words.tobytes(), pa.binary()))], [f.split()[0] for f in CELLS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        open_: dict[bool, tuple[list, list]] = {False: ([], []), True: ([], [])}
        held = {False: 0, True: 0}
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in batch.column("text").to_pylist()]
                data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
                starts, ends = rolling.words(data)
                hashes = rolling.Prefix(data).hash(starts, ends)
                edges = np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raw]))
                first = 0
                for doc, train, tuned, edge in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "train", "tuned")), edges):
                    docs, parts = open_[tuned]
                    docs.append((doc, train, int(edge) - first + 1))
                    parts += [hashes[first:edge], np.array([END])]
                    first = int(edge)
                    held[tuned] += docs[-1][2]
                    if held[tuned] >= cell_tokens:
                        yield close(number, tuned, docs, parts)
                        number += 1
                        open_[tuned], held[tuned] = ([], []), 0
        for tuned, (docs, parts) in open_.items():
            if docs:
                yield close(number, tuned, docs, parts)
                number += 1

    return store(docs.select("doc_id", "text", "train", "tuned").mapInArrow(run, CELLS), "lm-cells")


class Cell:
    """A cell's tokens, and its distinct keys of each kind (0: words, 1: bigrams) with local counts."""

    def __init__(self, tuned: bool, train, sizes, ids: bytes, words: bytes):
        self.ids, self.words, self.tuned = np.frombuffer(ids, "<i4"), np.frombuffer(words, np.uint64), tuned
        self.sizes = np.asarray(sizes, np.int64)
        self.learned = np.repeat(np.asarray(train, bool), self.sizes)
        self.before = np.empty_like(self.ids)
        self.before[1:] = self.ids[:-1]
        end = int(np.searchsorted(self.words, END))
        self.before[np.cumsum(self.sizes) - self.sizes] = end  # a text follows the end of another
        pair = rolling.mix(self.words[self.before] * np.uint64(3) + rolling.mix(self.words[self.ids]))
        self.pairs, self.pair_of = np.unique(pair, return_inverse=True)
        self.keys = (self.words, self.pairs)
        self.of = (self.ids, self.pair_of)
        self.counts = tuple(np.bincount(of[self.learned], minlength=len(k)) for of, k in zip(self.of, self.keys))


def _split(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each hash range begins in sorted keys."""
    return np.searchsorted(keys, np.array([(r << 64) // ranges for r in range(ranges)] + [(1 << 64) - 1], dtype=object).astype(np.uint64))


def _requests(cells: DataFrame, ranges: tuple[int, int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                cell, rows = Cell(row["tuned"], row["train"], row["sizes"], row["ids"], row["words"]), []
                for kind in (0, 1):
                    keys, counts = cell.keys[kind], cell.counts[kind].astype(np.uint64)
                    at = _split(keys, ranges[kind])
                    at[-1] = len(keys)
                    rows += [(kind, r, row["cell"], row["tuned"], int(at[r]), _pack_sorted(keys[at[r]:at[r + 1]]), _pack(counts[at[r]:at[r + 1]]))
                             for r in range(ranges[kind]) if at[r] < at[r + 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()))],
                                                 ["kind", "range", "cell", "tuned", "first", "keys", "counts"])

    return cells.select("cell", "tuned", "train", "sizes", "ids", "words").mapInArrow(
        run, "kind int, range int, cell long, tuned boolean, first long, keys binary, counts binary")


ANSWERS = "kind int, cell long, at binary, total binary, deleted binary, tokens long, tuned_tokens long, types long, tuned_types long"


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """Add up one hash range; answer each cell, and one row (cell null) with the range's totals."""
    keys = [_unpack_sorted(k) for k in group["keys"]]
    counts = [_unpack(c).astype(np.int64) for c in group["counts"]]
    distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
    tuned = np.repeat(group["tuned"].to_numpy(bool), [len(k) for k in keys])
    flat = np.concatenate(counts)
    total = np.bincount(of, flat, len(distinct)).astype(np.int64)
    held = np.bincount(of[tuned], flat[tuned], len(distinct)).astype(np.int64)
    rest, at, out = total - held, 0, []
    kind = int(group["kind"].iloc[0])
    for cell, first, own, count, is_tuned in zip(group["cell"], group["first"], keys, counts, group["tuned"]):
        mine = of[at:at + len(own)]
        at += len(own)
        # what a cell presumes: the total is its own count, and its fold holds all of it
        wrong = np.flatnonzero((total[mine] != count) | ((rest[mine] != 0) if is_tuned else False))
        if len(wrong):
            picked = mine[wrong]
            out.append((kind, cell, _pack_sorted(wrong.astype(np.uint64) + np.uint64(first)), _pack(total[picked].astype(np.uint64)),
                        _pack(rest[picked].astype(np.uint64)) if is_tuned else None, 0, 0, 0, 0))
    out.append((kind, None, None, None, None, *((int(total.sum()), int(held.sum()), int((total > 0).sum()), int((rest > 0).sum())) if kind == 0 else (0, 0, 0, 0))))
    frame = pd.DataFrame(out, columns=[f.split()[0] for f in ANSWERS.split(", ")])
    return frame.astype({"cell": "Int64"})


def _with_answers(cells: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    own = answers.where("cell is not null").select("cell", "kind", "at", "total", "deleted")
    return cells.groupBy("cell").cogroup(own.groupBy("cell")).applyInPandas(run, schema)


def _counts(cell: Cell, answers: pd.DataFrame, deleted: bool) -> list[np.ndarray]:
    """Corpus counts of the cell's words and bigrams, with its fold deleted or not."""
    out = [np.zeros(len(k), np.int64) if deleted else c.astype(np.int64) for k, c in zip(cell.keys, cell.counts)]
    for kind, at, total, rest in zip(answers["kind"], answers["at"], answers["total"], answers["deleted"]):
        out[kind][_unpack_sorted(at).astype(np.int64)] = _unpack(rest if deleted else total).astype(np.int64)
    return out


def _bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2)."""
    return np.frexp(count.astype(np.float64))[1]


def _estimates(cell: Cell, counts: list[np.ndarray], tokens: int):
    context = counts[0][cell.before]
    return counts[1][cell.pair_of] / np.maximum(context, 1), counts[0][cell.ids] / max(1, tokens), _bucket(context)


def _events(tokens: int):
    def run(cells: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if cells.empty:
            return pd.DataFrame({"bucket": [], "q2": [], "q1": [], "n": []}, dtype="int64")
        row = cells.iloc[0]
        cell = Cell(row["tuned"], row["train"], row["sizes"], row["ids"], row["words"])
        p2, p1, bucket = _estimates(cell, _counts(cell, answers, True), tokens)
        level = [np.where(p > 0, np.rint(np.log10(np.maximum(p, 1e-30)) * LOG_STEPS), 1).astype(np.int64) for p in (p2, p1)]
        key, n = np.unique((bucket.astype(np.int64) << 40) + (level[0] + 1000 << 20) + level[1] + 1000, return_counts=True)
        return pd.DataFrame({"bucket": key >> 40, "q2": (key >> 20 & 0xFFFFF) - 1000, "q1": (key & 0xFFFFF) - 1000, "n": n})

    return run


def mixture(events: list[tuple[int, int, int, int]], types: int, rounds: int = 100) -> dict[int, tuple[float, float, float]]:
    """Weights per context bucket by expectation-maximisation; ``events``: bucket, levels, count.

    A bucket without events takes those of the nearest bucket that has some.  Uniform keeps at
    least a millionth, so every text has a finite score.
    """
    by: dict[int, list] = {}
    for bucket, q2, q1, n in events:
        by.setdefault(bucket, []).append(([0.0 if q == 1 else 10 ** (q / LOG_STEPS) for q in (q2, q1)] + [1 / (types + 1)], n))
    out = {}
    for bucket, rows in by.items():
        p, n = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
        weight = np.array([0.0 if bucket == 0 else 0.4, 0.4, 0.2])
        for _ in range(rounds):
            share = p * weight
            share /= share.sum(1, keepdims=True)
            weight = np.maximum((share * n[:, None]).sum(0), [0, 0, 1e-6 * n.sum()])
            weight /= weight.sum()
        out[bucket] = tuple(weight)
    return out or {1: (0.4, 0.4, 0.2)}


def _weights(mixed: dict[int, tuple[float, float, float]]) -> np.ndarray:
    table = np.array([mixed[min(mixed, key=lambda b: (abs(b - i), b))] for i in range(80)])
    table[0] = table[0] * [0, 1, 1] / table[0][1:].sum()  # nothing is known after an unseen context
    return table


SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(tokens: int, types: int, table: np.ndarray):
    def run(cells: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = [f.split()[0] for f in SCORES.split(", ")]
        if cells.empty:
            return pd.DataFrame(columns=names)
        row = cells.iloc[0]
        cell = Cell(row["tuned"], row["train"], row["sizes"], row["ids"], row["words"])
        counts = _counts(cell, answers, False)
        p2, p1, bucket = _estimates(cell, counts, tokens)
        p = table[bucket, 0] * p2 + table[bucket, 1] * p1 + table[bucket, 2] / (types + 1)
        count = counts[0][cell.ids]
        starts = np.cumsum(cell.sizes) - cell.sizes
        base = np.log10((count + 1) / (tokens + types + 1))
        return pd.DataFrame(dict(zip(names, (
            pd.array(list(row["doc_id"]), "Int64"), cell.sizes, np.add.reduceat((count > 0).astype(np.int64), starts), tokens, np.add.reduceat(base, starts),
            np.add.reduceat(np.log10(p), starts)))))

    return run


def score(docs: DataFrame, cell_tokens: int = CELL_TOKENS, range_keys: int = RANGE_KEYS) -> DataFrame:
    """SCORES for each row of ``doc_id, text, train, tuned``.

    ``train`` rows are counted; ``tuned`` ones, a part of them, are the fold that is deleted to
    learn the weights.  A null or empty text is its end alone.  Without training rows every
    token is unknown.  The driver sees totals and a histogram of held-out events over 1/20
    steps of two log probabilities: its size does not grow with the corpus.
    """
    cells = _cells(docs, cell_tokens)
    tokens = cells.agg(F.sum("n_tokens")).first()[0] or 0
    ranges = (max(1, math.ceil(tokens / 6 / range_keys)), max(1, math.ceil(tokens / range_keys)))
    answers = store(_requests(cells, ranges).groupBy("kind", "range").applyInPandas(_answer, ANSWERS), "lm-answers")
    sums = answers.where("cell is null").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "tuned_tokens", "types", "tuned_types"))).first()
    n, n_tuned, types, types_left = (int(x) for x in sums)
    events = _with_answers(cells.where("tuned"), answers.where("deleted is not null"), _events(n - n_tuned), "bucket long, q2 long, q1 long, n long")
    held = [tuple(r) for r in events.groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n")).collect()]
    table = _weights(mixture(held, types_left))
    return _with_answers(cells, answers, _score(n, types, table), SCORES)


def score_documents(docs: DataFrame, folds: int = 7, held: int = 2, tuned: int = 3) -> DataFrame:
    """Learn outside one fold of ``documents`` and score all of them; another fold tunes the mixture."""
    fold = doc_fold(F.col("doc_id"), folds)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold != held).alias("train"), (fold == tuned).alias("tuned"))
    out = score(rows)
    return out.select("doc_id", (doc_fold(F.col("doc_id"), folds) == held).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
