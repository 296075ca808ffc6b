"""Cross-tokenizer alignment: where the tokens of a byte-level BPE (A) and of a sentencepiece
BPE with byte fallback (B) cover the same bytes of a text.

A encodes space+text, B encodes the text and adds the space itself.  Token spans come from the
tokenizers' own offsets: A's character offsets and B's proto spans (source bytes) are coarse
cuts; where several tokens share one coarse span (a character split over byte tokens, B's
``<0xHH>`` fallback) the decoded bytes refine the cut.  The refined spans must tile space+text
exactly and the joined bytes must equal it, else the text counts as unaligned (no tokens).
Texts are aligned in stretches that end before plain spaces, where both tokenizers end a token;
a stretch is encoded and aligned once per worker and looked up after that.

Offsets where both sequences end a token cut them into groups; every pair of an A and a B token
whose byte ranges overlap is a link.  Corpus-wide counts of (A id, B id) pairs count documents;
they are summed in two levels over a salt of the row, so a pair found in every document (a
space, say) spreads over ``SALTS`` tasks when counts travel back to the links.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SALTS = 64
CACHED = 600_000  # a memory bound of the lookup of stretches met before, nothing else

ALIGNED = ("_row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<struct<a:int,b:int,m:long>>")


def _byte_chars() -> dict[str, int]:
    """Byte-level BPE spelling of bytes: printable Latin-1 stands for itself, the other bytes
    take the code points from 256 upwards in byte order (fixed values of the byte-level scheme)."""
    keep = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, extra = {}, 0
    for b in range(256):
        if b in keep:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


class Tools:
    """Both tokenizers, and every id's bytes as one flat array with offsets and lengths."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings inside texts are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        chars = _byte_chars()
        a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        known = np.zeros(len(a_bytes), bool)
        for tok, i in self.a.get_vocab(with_added_tokens=True).items():
            if all(c in chars for c in tok):
                a_bytes[i], known[i] = bytes(chars[c] for c in tok), True
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode("utf-8"))
        self.a_known = known
        self.a_flat, self.a_start, self.a_len = _flat(a_bytes)
        self.b_flat, self.b_start, self.b_len = _flat(b_bytes)


def _flat(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64), lengths


def _refined(starts: np.ndarray, coarse: np.ndarray, sizes: np.ndarray) -> np.ndarray | None:
    """Token ends in bytes.  A token whose coarse span is empty, or that ends where the next one
    ends, shares its cut with what follows (a character split into byte tokens); within such a
    run the decoded bytes place the cuts, and the run's last token must end at its coarse cut.
    None if they disagree."""
    ends = np.cumsum(sizes)
    shared = (starts == coarse) | np.r_[coarse[1:] == coarse[:-1], False]
    return ends if np.array_equal(ends[~shared], coarse[~shared]) else None


def _spells(flat: np.ndarray, start: np.ndarray, length: np.ndarray, ids: np.ndarray, target: np.ndarray) -> bool:
    """Do the tokens' bytes, joined, equal ``target``?"""
    sizes = length[ids]
    if sizes.sum() != len(target):
        return False
    before = np.cumsum(sizes) - sizes
    at = np.repeat(start[ids] - before, sizes) + np.arange(len(target))
    return bool(np.array_equal(flat[at], target))


#: Before a space that follows a character other than white space and is not the text's last
#: character, both tokenizers end a token whatever stands around it: A's pattern lets only a token's
#: first characters be white space, and no piece of B has white space after another character.
_CUT = re.compile(r"(?<=\S)(?= .)", re.S)


def segments(text: str) -> list[str]:
    """space+text in stretches that both tokenizers encode alike alone and in the text."""
    return _CUT.split(" " + text)


def align_run(run: list[str], tools: Tools) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """A ids, A byte ends, B ids, B byte ends in the joined ``run`` of stretches, each encoded by
    itself; None when the joined bytes of some stretch's tokens are not the stretch."""
    data = "".join(run).encode("utf-8")
    target = np.frombuffer(data, np.uint8)
    char_at = np.append(np.flatnonzero((target & 0xC0) != 0x80), len(target))  # byte offset of each character
    sizes = np.fromiter(map(len, run), np.int64, len(run))
    first = np.cumsum(sizes) - sizes  # first character of each stretch
    found = tools.a.encode_batch(run, add_special_tokens=False)
    many = np.fromiter(map(len, found), np.int64, len(run))
    a_ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.int64, int(many.sum()))
    if not many.all() or not tools.a_known[a_ids].all() or not _spells(tools.a_flat, tools.a_start, tools.a_len, a_ids, target):
        return None
    spans = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in found)), np.int64, 2 * len(a_ids)).reshape(-1, 2)
    spans = char_at[spans + np.repeat(first, many)[:, None]]
    a_ends = _refined(spans[:, 0], spans[:, 1], tools.a_len[a_ids])
    pieces = [p.pieces for p in tools.b.encode([s[1:] for s in run], return_type="proto", num_threads=1)]
    many = np.fromiter(map(len, pieces), np.int64, len(run))
    b_rows = np.fromiter(chain.from_iterable(map(_SPAN, chain.from_iterable(pieces))), np.int64, 3 * int(many.sum())).reshape(-1, 3)
    b_ids = b_rows[:, 0]
    if not many.all() or not _spells(tools.b_flat, tools.b_start, tools.b_len, b_ids, target):
        return None
    base = np.repeat(char_at[first], many) + 1  # +1: the space B adds
    b_ends = _refined(b_rows[:, 1] + base, b_rows[:, 2] + base, tools.b_len[b_ids])
    if a_ends is None or b_ends is None:
        return None
    return a_ids, a_ends, b_ids, b_ends


def align_text(text: str | None, tools: Tools) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """A ids, A byte ends, B ids, B byte ends in space+text, encoded whole; None when the text has no
    tokens (null, empty, or joined bytes that are not space+text)."""
    return align_run([" " + text], tools) if text else None


class Known:
    """What is known of every stretch met so far: its spelled groups, counts and links.

    Both sequences end a token where a stretch ends, so no group or link reaches over it and a
    text's groups and links are those of its stretches in order.
    """

    def __init__(self, tools: Tools):
        self.tools = tools
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.spelled: list[str | None] = []
        self.counts = np.zeros((0, 3), np.int64)  # A tokens, B tokens, groups
        self.link_ends, self.links = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def places(self, run: list[str]) -> np.ndarray:
        """Number of each stretch of ``run``, learning the new ones."""
        at = np.fromiter(map(self.place.get, run, repeat(-1)), np.int64, len(run))
        new = list({run[i] for i in np.flatnonzero(at < 0).tolist()})
        if not new:
            return at
        if len(self.place) + len(new) > CACHED:
            self.clear()
            new = list(set(run))
        for i in range(0, len(new), 10_000):
            self._learn(new[i:i + 10_000])
        return np.fromiter(map(self.place.__getitem__, run), np.int64, len(run))

    def _learn(self, run: list[str]) -> None:
        found = align_run(run, self.tools)
        if found is None and len(run) > 1:  # some stretch has no tokens: halve until it is alone
            self._learn(run[:len(run) // 2])
            self._learn(run[len(run) // 2:])
            return
        self.place.update(zip(run, range(len(self.place), len(self.place) + len(run))))
        if found is None:
            self.spelled.append(None)
            self.counts = np.concatenate([self.counts, np.zeros((1, 3), np.int64)])
            self.link_ends = np.append(self.link_ends, self.link_ends[-1])
            return
        words, common, cuts, link_a, link_b = _grouped(*found)
        ends = np.cumsum(np.fromiter((len(s.encode("utf-8")) for s in run), np.int64, len(run)))
        upto = np.stack([np.searchsorted(x, ends, "right") for x in (found[1], found[3], common, cuts)], 1)
        counts = np.diff(upto, axis=0, prepend=0)
        stops = (upto[:, 0] + upto[:, 1]).tolist()
        self.spelled += ["".join(words[x:y])[:-1] for x, y in zip([0, *stops], stops)]
        self.counts = np.concatenate([self.counts, counts[:, :3]])
        self.link_ends = np.concatenate([self.link_ends, self.link_ends[-1] + upto[:, 3]])
        self.links = np.concatenate([self.links, (link_a << 32) | link_b])


def align_texts(texts: list[str | None], known: Known) -> Iterator[tuple[tuple[int, int, int, int], str, np.ndarray, np.ndarray]]:
    """Per text: numbers of A tokens, B tokens, groups and links; the spelled groups; the distinct
    linked pairs (A id above B id) with how often each is linked.  Zeros and ``''`` when the text
    has no tokens (null, empty, or joined bytes that are not space+text)."""
    runs = [segments(t) if t else [] for t in texts]
    at = known.places(list(chain.from_iterable(runs)))
    counts, begin, many = known.counts[at], known.link_ends[at], np.diff(known.link_ends)[at]
    before = np.concatenate([[0], np.cumsum(many)])
    links = known.links[np.repeat(begin - before[:-1], many) + np.arange(before[-1])]
    stop = 0
    for run in runs:
        start, stop = stop, stop + len(run)
        spelled = list(map(known.spelled.__getitem__, at[start:stop].tolist()))
        if not spelled or None in spelled:
            yield (0, 0, 0, 0), "", links[:0], links[:0]
            continue
        pair, m = np.unique(links[before[start]:before[stop]], return_counts=True)
        yield (*counts[start:stop].sum(0).tolist(), int(before[stop] - before[start])), ";".join(spelled), pair, m


def _grouped(a_ids, a_ends, b_ids, b_ends) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids spelled in the order of the groups, each with the sign after it; the ends of the groups;
    the end, A id and B id of every link.

    Both sequences tile the same bytes, so every end of either closes exactly one link: the
    pair of tokens that hold the byte before it.  Ends of both close a group.
    """
    both = np.sort(np.r_[a_ends, b_ends], kind="stable")  # two sorted runs
    twice = both[1:] == both[:-1]
    cuts, common = both[np.r_[True, ~twice]], both[1:][twice]
    link_a, link_b = a_ids[np.searchsorted(a_ends, cuts)], b_ids[np.searchsorted(b_ends, cuts)]
    ga, gb = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
    sep_a = np.where(np.r_[ga[1:] == ga[:-1], False], ",", "|")
    sep_b = np.where(np.r_[gb[1:] == gb[:-1], False], ",", ";")
    order = np.lexsort((np.r_[np.arange(len(ga)), np.arange(len(gb))], np.r_[np.zeros(len(ga)), np.ones(len(gb))], np.r_[ga, gb]))
    ids = np.r_[a_ids, b_ids][order].tolist()
    seps = np.r_[sep_a, sep_b][order].tolist()
    return list(map("".join, zip(map(str, ids), seps))), common, cuts, link_a, link_b


def groups_and_links(a_ids, a_ends, b_ids, b_ends) -> tuple[str, int, np.ndarray, np.ndarray]:
    """The spelled groups (``a1,a2|b1;a3|b2,b3``), their number, and the A and B id of every link."""
    spelled, common, _, link_a, link_b = _grouped(a_ids, a_ends, b_ids, b_ends)
    return "".join(spelled)[:-1], len(common), link_a, link_b


_SPAN = operator.attrgetter("id", "begin", "end")
PAIR = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("m", pa.int64())])


@lru_cache(maxsize=2)
def _known(a_path: str, b_path: str) -> Known:
    return Known(Tools(a_path, b_path))


def aligned(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """ALIGNED for ``_row, doc_id, text``: counts, group digest and distinct linked pairs of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(a_path, b_path)
        for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
            counts, digests, offsets, keys, many = [], [], [0], [], []
            for n, spelled, pair, m in align_texts(batch.column("text").to_pylist(), known):
                counts.append(n)
                digests.append(hashlib.sha256(spelled.encode()).hexdigest() if spelled else "")
                keys.append(pair)
                many.append(m)
                offsets.append(offsets[-1] + len(pair))
            key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            m = np.concatenate(many) if many else np.zeros(0, np.int64)
            pairs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array((key >> 32).astype(np.int32)), pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(m.astype(np.int64))], fields=list(PAIR)))
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)] if counts else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("doc_id"), *columns, pa.array(digests, pa.string()), pairs],
                                             ["_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])

    return rows.select("_row", "doc_id", "text").mapInArrow(run, ALIGNED)


def align_documents(docs: DataFrame, salts: int = SALTS, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``; nothing else is read): ``doc_id, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256``.

    Null, empty and unalignable texts give zeros and ``''``.  A pair's count is the number of
    rows holding it linked, so repeated rows count each time.  ``n_best`` counts links whose
    pair count is the highest of any pair of that A id (ties all count).  An empty table gives
    no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("_row", F.monotonically_increasing_id())
    made = store(aligned(rows, public_tokenizers.path(a_file), public_tokenizers.path(b_file)), "alignment")
    links = made.select("_row", F.pmod(F.xxhash64("_row"), F.lit(salts)).alias("_salt"), F.explode("pairs").alias("p")) \
        .select("_row", "_salt", "p.a", "p.b", "p.m")
    # read three times below, and each time it would list all links again
    part = store(links.groupBy("a", "b", "_salt").agg(F.count(F.lit(1)).alias("_n")), "pair-counts")
    total = part.groupBy("a", "b").agg(F.sum("_n").alias("count"))
    top = total.groupBy("a").agg(F.max("count").alias("_top"))
    stats = part.join(total.join(top, "a"), ["a", "b"]).select("a", "b", "_salt", "count", (F.col("count") == F.col("_top")).alias("_best"))
    scored = links.join(stats, ["a", "b", "_salt"]).groupBy("_row").agg(
        F.sum(F.when(F.col("_best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("count")).alias("count_sum"))
    out = made.join(scored, "_row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
                      F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
