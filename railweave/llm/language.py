"""Language of words and documents by a linear-chain conditional random field.

A word's emission score sums weights of its affixes, character n-grams and lexicon lists;
transitions between the languages of neighbouring words are learned with them.  Training
walks code-switched sequences made of passages of different documents.  Forward-backward
runs over blocks of all texts of a batch side by side: transfer matrices per block first,
then messages between the blocks of a text, then inside the blocks, so a long text costs no
more per word than a short one and none is cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_fold

BITS = 18
BLOCK = 64
LEXICON = 300  # words per language
PASSAGES, PASSAGE_CHARS = 500, 1500  # bound of the training sample: passages per language, characters of each
STEPS = 40

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _letters(word: str) -> str:
    low = word.lower()
    return low if low.isalpha() else "".join(filter(str.isalpha, low))


class Words:
    """Hashed features of distinct words; words without a letter have none."""

    def __init__(self, words: list[str]):
        plain = [_letters(w) for w in words]
        self.spoken = np.array([bool(p) for p in plain], bool)
        marked = [f"\x02{p}\x03" for p in plain if p]
        sizes = np.array([len(m) for m in marked], np.int64)
        chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        starts = np.cumsum(sizes) - sizes
        self.groups: list[tuple[np.ndarray, np.ndarray]] = []  # feature numbers, where each word's begin
        self.hash = np.zeros(0, np.uint64)
        if not len(marked):
            return
        ends = np.repeat(starts + sizes, sizes)
        gram = np.zeros(len(chars), np.uint64)
        for n in (1, 2, 3):
            gram = gram * _A
            gram[:len(chars) - n + 1] += chars[n - 1:] + np.uint64(1)
            whole = np.arange(len(chars)) + n <= ends
            at = np.cumsum(whole) - whole
            self._add(gram[whole], n, at[starts])
            one = np.arange(len(marked))
            if n > 1:  # with the mark: prefixes and suffixes of one letter and two
                self._add(gram[starts], 10 + n, one)
                self._add(gram[starts + sizes - n], 20 + n, one)
        place = np.arange(len(chars), dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64)
        self.hash = np.add.reduceat(_mix(chars + place * _B), starts)

    def _add(self, value: np.ndarray, kind: int, starts: np.ndarray) -> None:
        self.groups.append(((_mix(value + np.uint64(kind * int(_B) % (1 << 64))) >> np.uint64(64 - BITS)).astype(np.int64), starts))

    def scores(self, weights: np.ndarray, lexicon: np.ndarray, lists: np.ndarray, listed: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.spoken), weights.shape[1]), np.float32)
        if self.groups:
            own = sum(np.add.reduceat(weights[idx], starts) for idx, starts in self.groups)
            if len(lexicon):
                at = np.minimum(np.searchsorted(lexicon, self.hash), len(lexicon) - 1)
                hit = lexicon[at] == self.hash
                own[hit] += listed[lists[at[hit]]]
            out[self.spoken] = own
        return out


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # feature x language
    lexicon: np.ndarray  # sorted word hashes
    lists: np.ndarray  # the language list of each
    listed: np.ndarray  # list x language
    moves: np.ndarray  # language x language, log

    def emissions(self, words: Words) -> np.ndarray:
        return words.scores(self.weights, self.lexicon, self.lists, self.listed)


def marginals(scores: np.ndarray, moves: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each word's language, and the expected moves; texts are ``sizes`` words after one another."""
    n_lang = scores.shape[1]
    sizes = np.asarray(sizes, np.int64)
    blocks = -(-sizes // BLOCK)
    n = int(blocks.sum())
    if not n:
        return np.zeros((0, n_lang)), np.zeros((n_lang, n_lang))
    first = np.cumsum(blocks) - blocks
    slot = np.arange(int(sizes.sum())) + np.repeat(first * BLOCK - (np.cumsum(sizes) - sizes), sizes)
    step = np.zeros((n * BLOCK, n_lang))
    step[slot] = np.exp(scores - scores.max(1, keepdims=True))
    real = np.zeros(n * BLOCK, bool)
    real[slot] = True
    step, real = step.reshape(n, BLOCK, n_lang).swapaxes(0, 1).copy(), real.reshape(n, BLOCK).T.copy()
    trans = np.exp(moves - moves.max())
    whole = np.tile(np.eye(n_lang), (n, 1, 1))
    begin = first[sizes > 0]
    for t in range(BLOCK):
        new = (whole.reshape(-1, n_lang) @ trans).reshape(n, n_lang, n_lang)
        if t == 0:
            new[begin] = 1  # no move leads to the first word
        new *= step[t][:, None, :]
        new /= new.max((1, 2), keepdims=True) + 1e-300
        whole = np.where(real[t][:, None, None], new, whole)
    into, out = np.ones((n, n_lang)), np.ones((n, n_lang))  # messages at both ends of a block
    order = np.argsort(-blocks, kind="stable")
    for k in range(1, int(blocks.max())):
        on = first[order[:np.searchsorted(-blocks[order], -k)]] + k
        new = np.einsum("bi,bij->bj", into[on - 1], whole[on - 1])
        into[on] = new / new.sum(1, keepdims=True)
    for k in range(int(blocks.max()) - 2, -1, -1):
        on = first[order[:np.searchsorted(-blocks[order], -(k + 1))]] + k
        new = np.einsum("bij,bj->bi", whole[on + 1], out[on + 1])
        out[on] = new / new.sum(1, keepdims=True)
    ahead, behind = np.empty((BLOCK, n, n_lang)), np.empty((BLOCK, n, n_lang))
    now = into
    for t in range(BLOCK):
        new = now @ trans
        if t == 0:
            new[begin] = 1
        new *= step[t]
        new /= new.sum(1, keepdims=True) + 1e-300
        now = ahead[t] = np.where(real[t][:, None], new, now)
    now = out
    for t in range(BLOCK - 1, -1, -1):
        behind[t] = now
        new = (now * step[t]) @ trans.T
        new /= new.sum(1, keepdims=True) + 1e-300
        now = np.where(real[t][:, None], new, now)
    both = ahead * behind
    both /= both.sum(2, keepdims=True) + 1e-300
    # expected moves between neighbours inside a text
    left = np.concatenate([into[None], ahead[:-1]])
    right = step * behind
    norm = np.einsum("tbi,ij,tbj->tb", left, trans, right, optimize=True)
    norm[0, begin] = np.inf
    share = np.where(real, 1 / np.maximum(norm, 1e-300), 0)
    pairs = trans * (left.reshape(-1, n_lang).T @ (right * share[:, :, None]).reshape(-1, n_lang))
    return both.swapaxes(0, 1).reshape(-1, n_lang)[slot], pairs


def _fit(passages: list[tuple[str, str]], steps: int = STEPS, seed: int = 7) -> Model:
    langs = sorted({lang for lang, _ in passages})
    if not langs:
        raise ValueError("no labelled document to learn from")
    n_lang, rng = len(langs), np.random.default_rng(seed)
    tokens, labels, sizes, run = [], [], [], 0
    for i, at in enumerate(rng.permutation(len(passages))):  # three passages make one code-switched sequence
        lang, text = passages[at]
        words = text.split()
        tokens += words
        labels += [langs.index(lang)] * len(words)
        run += len(words)
        if i % 3 == 2 or i == len(passages) - 1:
            sizes.append(run)
            run = 0
    codes, distinct = pd.factorize(np.array(tokens, object))
    labels = np.array(labels, np.int64)
    words = Words(list(distinct))
    n_words = len(distinct)
    count = np.zeros((n_words, n_lang))
    np.add.at(count, (codes, labels), 1)
    spoken = count[words.spoken]
    share = (spoken + 0.1) / (spoken.sum(0) + 1)
    gain = spoken * (np.log(share) - np.log((share.sum(1, keepdims=True) - share + 1e-9) / max(1, n_lang - 1)))
    chosen: dict[int, int] = {}
    for k in range(n_lang):
        for w in np.argsort(-gain[:, k], kind="stable")[:LEXICON]:
            if spoken[w, k] >= 2 and gain[w, k] > 0:
                chosen.setdefault(int(words.hash[w]), k)
    lexicon = np.array(sorted(chosen), np.uint64)
    lists = np.array([chosen[int(h)] for h in lexicon], np.int64)
    model = Model(langs, np.zeros((1 << BITS, n_lang), np.float32), lexicon, lists, np.zeros((n_lang, n_lang), np.float32), np.zeros((n_lang, n_lang)))
    boundary = np.cumsum(sizes)[:-1]
    same = np.ones(max(0, len(labels) - 1), bool)
    same[boundary[(boundary > 0) & (boundary < len(labels))] - 1] = False
    moves = np.zeros((n_lang, n_lang))
    np.add.at(moves, (labels[:-1][same], labels[1:][same]), 1)
    at = np.minimum(np.searchsorted(lexicon, words.hash), max(0, len(lexicon) - 1)) if len(lexicon) else None
    hit = lexicon[at] == words.hash if len(lexicon) else None
    squares = [np.full(a.shape, 1e-2) for a in (model.weights, model.listed, model.moves)]
    total = max(1, len(labels))
    for _ in range(steps):  # full gradient, steps scaled by past gradients
        post, pairs = marginals(model.emissions(words)[codes], model.moves, np.array(sizes))
        miss = count.copy()
        for k in range(n_lang):
            miss[:, k] -= np.bincount(codes, post[:, k], n_words)
        miss = miss[words.spoken] / total * 1000
        up = np.zeros(model.weights.shape)
        for idx, starts in words.groups:
            each = np.repeat(np.arange(len(miss)), np.diff(starts, append=len(idx)))
            for k in range(n_lang):
                up[:, k] += np.bincount(idx, miss[each, k], len(up))
        ups = [up - 1e-3 * model.weights, np.zeros((n_lang, n_lang)), (moves - pairs) / total * 1000]
        if len(lexicon):
            np.add.at(ups[1], lists[at[hit]], miss[hit])
        for k, (value, gradient) in enumerate(zip((model.weights, model.listed, model.moves), ups)):
            squares[k] += gradient**2
            value += (0.3 * gradient / np.sqrt(squares[k])).astype(value.dtype)
    return model


def train(docs: DataFrame, passages: int = PASSAGES, chars: int = PASSAGE_CHARS) -> Model:
    """Fit on at most ``passages`` passages of ``chars`` characters per language of ``doc_id, text, lang``.

    Documents are drawn by a hash of their text, each passage from the middle of its text;
    copies count once per language.  Rows without text or language are left out.  That sample
    is all the driver sees.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    start = F.greatest(F.lit(1), F.floor((F.char_length("text") - chars) / 2).cast("int"))
    rows = rows.select("lang", F.xxhash64("text").alias("_at"), F.substring("text", start, F.lit(chars)).alias("_text"))
    # hashes are drawn first, so that no passage moves that is not drawn; what is drawn has the bound of the sample
    drawn = rows.select("lang", "_at").distinct().withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("_at"))).where(F.col("_n") <= passages)
    first = rows.join(F.broadcast(drawn.select("lang", "_at")), ["lang", "_at"], "left_semi").groupBy("lang", "_at").agg(F.min("_text").alias("_text"))
    return _fit(sorted((r["lang"], r["_text"]) for r in first.collect()))


def _posteriors(model: Model, texts: list[str | None]):
    """Words of each text, whether each has a letter, and their posteriors."""
    split = [t.split() if t else [] for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    codes, distinct = pd.factorize(np.array([w for own in split for w in own], object))
    words = Words(list(distinct))
    post, _ = marginals(model.emissions(words)[codes], model.moves, sizes)
    return split, sizes, words.spoken[codes] if len(codes) else np.zeros(0, bool), post


def _run(df: DataFrame, model: Model, made, fields: str, keep_text: bool = False) -> DataFrame:
    new = {f.split()[0] for f in fields.split(", ")}
    rest = [c for c in df.columns if c not in new and (keep_text or c != "text")]
    shared = df.sparkSession.sparkContext.broadcast(model)  # size fixed by BITS and the number of languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = 0
            texts = whole.column("text").to_pylist()
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end] or "") <= 2_000_000):
                    chars += len(texts[end] or "")
                    end += 1
                columns, names = made(shared.value, texts[at:end])
                batch = whole.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *columns], [*rest, *names])
                at = end

    base = df.select(*rest) if keep_text else df.select(*rest, "text")
    kept = ", ".join(f"`{n}` {t}" for n, t in df.select(*rest).dtypes)
    return base.mapInArrow(run, ", ".join(x for x in (kept, fields) if x))


def _documents(model: Model, texts: list[str | None]):
    _, sizes, spoken, post = _posteriors(model, texts)
    doc = np.repeat(np.arange(len(texts)), sizes)[spoken]
    votes = np.stack([np.bincount(doc, post[spoken, k], len(texts)) for k in range(len(model.langs))], 1)
    n = np.bincount(doc, minlength=len(texts))
    best = votes.argmax(1)
    score = np.where(n > 0, votes[np.arange(len(texts)), best] / np.maximum(n, 1), 0.0)
    lang = [model.langs[b] if m else "und" for b, m in zip(best, n)]
    return [pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1), pa.float64())], ["lang_pred", "score"]


def identify(df: DataFrame, model: Model, keep_text: bool = False) -> DataFrame:
    """Replace ``text`` by ``lang_pred`` and ``score``, the mean posterior of that language over
    the words with a letter; ``und`` and 0 without such a word.  The other
    columns stay, ``text`` too if asked; columns of the new names are replaced."""
    return _run(df, model, _documents, "lang_pred string, score double", keep_text)


def _certainty(model: Model, texts: list[str | None]):
    _, sizes, spoken, post = _posteriors(model, texts)
    doc = np.repeat(np.arange(len(texts)), sizes)[spoken]
    n = np.bincount(doc, minlength=len(texts))
    sure = np.bincount(doc, post[spoken].max(1), len(texts)) / np.maximum(n, 1)
    return [pa.array(np.clip(sure, 0, 1), pa.float64())], ["certainty"]


def certainty(df: DataFrame, model: Model) -> DataFrame:
    """Replace ``text`` by ``certainty``: the mean, over the words with a letter, of each word's
    largest posterior, whatever its language; 0 without such a word."""
    return _run(df, model, _certainty, "certainty double")


def _words(model: Model, texts: list[str | None]):
    split, sizes, spoken, post = _posteriors(model, texts)
    label = np.where(spoken, np.array(model.langs, object)[post.argmax(1)] if len(post) else "", "und")
    ends = np.cumsum(sizes)
    return [pa.array(split, pa.list_(pa.string())), pa.array([list(label[e - s:e]) for s, e in zip(sizes, ends)], pa.list_(pa.string()))], ["words", "langs"]


def label_words(df: DataFrame, model: Model) -> DataFrame:
    """Replace ``text`` by its words and the language of each (``und``: no letter)."""
    return _run(df, model, _words, "words array<string>, langs array<string>")


def predict_documents(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Learn outside the held-out fold of ``doc_id, text, lang`` and predict every document."""
    fold = doc_fold(F.col("doc_id"), folds)
    model = train(docs.where(fold != held))
    return identify(docs.select("doc_id", (fold == held).alias("held_out"), "text"), model)
