"""Language ID: a linear-chain conditional random field labels the words of a text.

A word's emission scores are the sum of learned weights of its affixes, character n-grams
and lexicon entry (hashed); learned transitions tie neighbouring words. Forward-backward
over each whole sentence gives every word a distribution over languages, so a text that switches
language keeps its parts apart. A text's language is the one with the most word mass. Words are
what blanks part: a text without blanks is one word, and a sentence ends at ``. ! ?`` only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.tokens import PUNCTUATION, TEXTS, each, lean

#: Hashed feature weights as a power of two; the model's size doesn't depend on the input.
BITS = 16
#: Labelled rows the model is fitted on at most, of each language.
FIT_ROWS = 250
#: Words of these rows that it is fitted on at most.
FIT_WORDS = 150_000
#: Frequent words of a language in its lexicon.
LEXICON = 150
END = frozenset(".!?")
#: Languages that are learned, the most frequent ones; ties by name.
LANGUAGES = 256
#: Code points of a row that it is fitted on at most. Texts are predicted whole.
FIT_CHARS = 20_000
#: Words of a fitted sentence; a longer one teaches as several.
CHAIN = 128
#: Words that a worker remembers the scores of, and words scored at once; both bound its memory, the results don't depend on them.
TAGGED, AT_ONCE = 1 << 17, 100_000
#: Words of a stretch. A longer sentence is scored in stretches side by side, with exact messages passed between them.
STRETCH = 128


def letters(token: str) -> str:
    """The token lower-cased and without outer punctuation, if it holds a letter."""
    word = token.lower().strip(PUNCTUATION)
    return word if any(c.isalpha() for c in word) else ""


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of orders 1 to 4 of all words, and where each word's begin.

    A word is written ^word$, so that the n-grams which hold a mark are its affixes of up to
    three characters. A word of any length is read to its end.
    """
    chars = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.cumsum(chars == 2) - 1
    h, codes, owners = np.zeros(len(chars), np.uint64), [], []
    for k in range(1, 5):
        n = len(chars) - k + 1
        if n <= 0:
            break
        h = (h[:n] ^ (chars[k - 1 :] + np.uint64(k << 32))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        own = owner[:n] == owner[k - 1 :]
        codes.append((h[own] >> np.uint64(64 - BITS)).astype(np.int32))
        owners.append(owner[:n][own])
    code, own = np.concatenate(codes), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return code[order], np.searchsorted(own[order], np.arange(len(words)))


@dataclass
class Model:
    labels: list[str]
    lexicon: dict[str, int]  # frequent words of any language, numbered
    weights: np.ndarray  # 2 ** BITS n-gram rows, then a row for each word of the lexicon; a column for each label
    transitions: np.ndarray  # from x to, as weights
    start: np.ndarray

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``weights`` that each word sums, and where each word's begin."""
        code, at = ngrams(words)
        known = np.array([self.lexicon.get(w, -1) for w in words], np.int64)
        held = np.flatnonzero(known >= 0)
        code = np.insert(code, at[held], (1 << BITS) + known[held])
        return code, at + np.searchsorted(held, np.arange(len(words)), side="left")

    def emissions(self, words: list[str]) -> np.ndarray:
        """words x labels"""
        code, at = self.rows(words)
        return np.add.reduceat(self.weights[code], at, axis=0) if len(words) else np.zeros((0, len(self.labels)))


def chains(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sentences, given by their lengths, in step: (step, sentences that have it, their words)."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    ordered = lengths[order]
    for t in range(int(ordered[0]) if len(ordered) else 0):
        live = int(np.searchsorted(-ordered, -t, side="left"))
        yield t, order[:live], starts[:live] + t


def messages(e: np.ndarray, a: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sentences cut into stretches: (lengths of the stretches, what reaches the first word of each from before, the last from behind).

    A stretch acts on a message as the product of its words' transfer matrices, so all stretches
    are multiplied at once and messages go from stretch to stretch. Up to its scale, a message is
    what passing word by word gives.
    """
    k = len(a)
    parts = -(-lengths // STRETCH)
    cut = np.full(int(parts.sum()), STRETCH)
    ends = np.cumsum(parts)
    cut[ends[lengths > 0] - 1] = (lengths - 1)[lengths > 0] % STRETCH + 1
    before, behind = np.repeat(first, len(cut), axis=1), np.ones((k, len(cut)))
    long = np.flatnonzero(parts > 1)
    if not len(long):
        return cut, before, behind
    held = np.concatenate([np.arange(ends[i] - parts[i], ends[i]) for i in long])
    where = np.full(len(cut), -1)
    where[held] = np.arange(len(held))
    starts = (np.cumsum(cut) - cut)[held]
    # emissions and transitions from a stretch's first word to its last, both emissions in
    through = e[:, starts].T[:, :, None] * np.eye(k)
    for t in range(1, STRETCH):
        live = np.flatnonzero(cut[held] > t)
        step = (through[live] @ a) * e[:, starts[live] + t].T[:, None, :]
        through[live] = step / step.sum(axis=(1, 2), keepdims=True)
    for i in long:
        for c in range(ends[i] - parts[i] + 1, ends[i]):
            x = before[:, c - 1] @ through[where[c - 1]] @ a
            before[:, c] = x / x.sum()
        for c in range(ends[i] - 1, ends[i] - parts[i], -1):
            x = a @ (through[where[c]] @ behind[:, c])
            behind[:, c - 1] = x / x.sum()
    return cut, before, behind


def forward_backward(score: np.ndarray, trans: np.ndarray, start: np.ndarray, lengths: np.ndarray, pairs: bool = False):
    """Marginals (labels x words) of every word, of all sentences at once; with ``pairs`` also the
    expected transition counts and the log-likelihood's partition sum."""
    k, n = score.shape
    top = score.max(axis=0)
    e, a, first = score - top, np.exp(trans), np.exp(start)[:, None]
    del score  # arrays of all words are few: they are most of a worker's memory
    np.exp(e, out=e)
    before = behind = None
    if not pairs:
        lengths, before, behind = messages(e, a, first, np.asarray(lengths))
    alpha, beta, scale = np.empty((k, n)), np.empty((k, n)), np.empty(n)
    steps = list(chains(lengths))
    for t, own, at in steps:
        x = e[:, at] * ((first if before is None else before[:, own]) if t == 0 else a.T @ alpha[:, at - 1])
        s = x.sum(axis=0)
        alpha[:, at], scale[at] = x / s, s
    later = 0
    for t, own, at in reversed(steps):
        if later < len(at):
            beta[:, at[later:]] = 1.0 if behind is None else behind[:, own[later:]]
        if later:
            nxt = at[:later] + 1
            beta[:, at[:later]] = a @ (e[:, nxt] * beta[:, nxt] / scale[nxt])
        later = len(at)
    if not pairs:
        alpha *= beta
        alpha /= alpha.sum(axis=0)
        return alpha
    marginal = alpha * beta
    inner = np.ones(n, bool)
    inner[np.cumsum(lengths)[lengths > 0] - 1] = False
    i = np.flatnonzero(inner)
    moved = a * (alpha[:, i] @ (e[:, i + 1] * beta[:, i + 1] / scale[i + 1]).T)
    return marginal, moved, float(np.log(scale).sum() + top.sum())


def split_words(text: str) -> tuple[list[str], list[int]]:
    """Words of a text and the lengths of its sentences, cut at ``CHAIN`` words."""
    words, lengths, run = [], [], 0
    for token in text.split():
        if word := letters(token):
            words.append(word)
            run += 1
        if run == CHAIN or (run and not END.isdisjoint(token)):
            lengths.append(run)
            run = 0
    return words, lengths + [run] if run else lengths


def fit(rows: list[tuple[str, str]], rounds: int = 40, rate: float = 0.25, decay: float = 1e-5) -> Model | None:
    """Fitted on (text, language) rows by conditional likelihood, all words of a row bearing its language."""
    labels = sorted({lang for _, lang in rows})
    if not labels:
        return None
    words, lengths, truth, seen = [], [], [], {x: Counter() for x in labels}
    share = Counter()
    for text, lang in sorted(rows, key=lambda r: xxhash.xxh64_intdigest(r[0])):
        if share[lang] > FIT_WORDS // len(labels):
            continue
        w, n = split_words(text)
        words += w
        lengths += n
        truth += [labels.index(lang)] * len(w)
        seen[lang].update(w)
        share[lang] += len(w)
    lexicon = {w: i for i, w in enumerate(sorted({w for lang in labels for w, _ in seen[lang].most_common(LEXICON)}))}
    k, size = len(labels), (1 << BITS) + len(lexicon)
    model = Model(labels, lexicon, np.zeros((size, k)), np.zeros((k, k)), np.zeros(k))
    if not words or k == 1:
        return model
    vocabulary = sorted(set(words))
    index = {w: i for i, w in enumerate(vocabulary)}
    ids = np.array([index[w] for w in words])
    flat, bounds = model.rows(vocabulary)
    owner = np.repeat(np.arange(len(vocabulary)), np.diff(np.append(bounds, len(flat))))
    y, n = np.array(truth), np.array(lengths)
    firsts = np.cumsum(n) - n
    inner = np.ones(len(y), bool)
    inner[firsts] = False
    real = np.zeros((k, len(y)))
    real[y, np.arange(len(y))] = 1
    moves = np.zeros((k, k))
    np.add.at(moves, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
    parts = [model.weights, model.transitions, model.start]
    past = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    for step in range(1, rounds + 1):
        types = np.add.reduceat(model.weights[flat], bounds, axis=0)
        marginal, moved, _ = forward_backward(types[ids].T, model.transitions, model.start, n, pairs=True)
        off = real - marginal
        by_type = np.stack([np.bincount(ids, off[i], len(vocabulary)) for i in range(k)])
        by_row = np.stack([np.bincount(flat, by_type[i][owner], size) for i in range(k)], axis=1)
        slopes = [by_row / len(y) - decay * model.weights, (moves - moved) / len(y) - decay * model.transitions, off[:, firsts].sum(axis=1) / len(y) - decay * model.start]
        for p, g, (m, v) in zip(parts, slopes, past, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        rate *= 0.96
    return model


class Tagger:
    """Scores texts with a model, remembering the words it has met (a bounded number)."""

    def __init__(self, model: Model):
        self.model, k = model, len(model.labels)
        self.scores = np.zeros((TAGGED, k), np.float32)
        self.tokens: dict[str, int] = {}
        self.words: dict[str, int] = {}
        # codes: 2 * word + 1 at the end of a sentence; no word: -1 or, at an end, -2

    def _learn(self, tokens: list[str]) -> None:
        if len(self.words) + len(tokens) >= TAGGED or len(self.tokens) + len(tokens) >= 2 * TAGGED:
            self.tokens.clear()
            self.words.clear()
        first, fresh = len(self.words), []
        for token in dict.fromkeys(tokens):
            if token in self.tokens:
                continue
            word, end = letters(token), not END.isdisjoint(token)
            if word:
                at = self.words.setdefault(word, len(self.words))
                if at == first + len(fresh):
                    fresh.append(word)
                self.tokens[token] = 2 * at + end
            else:
                self.tokens[token] = -1 - end
        if fresh:
            self.scores[first : first + len(fresh)] = self.model.emissions(fresh)

    def codes(self, tokens: list[str]) -> np.ndarray:
        """In blocks that the memory holds."""
        try:
            return np.fromiter(map(self.tokens.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            self._learn(tokens)
            return np.fromiter(map(self.tokens.__getitem__, tokens), np.int64, len(tokens))

    def marginals(self, texts: Iterable[str | None], block: int = TAGGED // 4) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per group of texts: (marginals, labels x words; the number of words of each text)."""
        k = len(self.model.labels)
        scores, lengths, counts, size = [], [], [], 0
        for text in texts:
            tokens, own, run = (text or "").split(), 0, 0
            for lo in range(0, len(tokens), block):
                codes = self.codes(tokens[lo : lo + block])
                word, end = codes >= 0, np.where(codes >= 0, codes & 1, codes == -2).astype(bool)
                scores.append(self.scores[codes[word] >> 1].T)
                upto = np.cumsum(word)
                cuts = np.diff(np.concatenate([[0], upto[end]]))
                if len(cuts):
                    cuts[0] += run
                    run = 0
                lengths.append(cuts)
                run += int(upto[-1] - (upto[end][-1] if end.any() else 0))
                own += int(upto[-1])
            if run:
                lengths.append(np.array([run]))
            counts.append(own)
            size += own
            if size >= AT_ONCE:
                yield self._run(scores, lengths, k), np.array(counts)
                scores, lengths, counts, size = [], [], [], 0
        if counts:
            yield self._run(scores, lengths, k), np.array(counts)

    def _run(self, scores, lengths, k):
        n = np.concatenate(lengths).astype(np.int64) if lengths else np.zeros(0, np.int64)
        return forward_backward(
            np.concatenate(scores, axis=1, dtype=np.float64) if scores else np.zeros((k, 0)), self.model.transitions, self.model.start, n[n > 0])

    def predict(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float, list[float]]]:
        """(language, share of the word mass, shares of all) of each text."""
        labels = self.model.labels
        for marginal, counts in self.marginals(texts):
            if len(counts[counts > 0]):
                ends = np.cumsum(counts[counts > 0])
                mass = np.add.reduceat(marginal, ends - counts[counts > 0], axis=1) / counts[counts > 0]
            del marginal
            at = 0
            for c in counts:
                if not c:
                    yield "und", 0.0, [0.0] * len(labels)
                    continue
                m = mass[:, at]
                at += 1
                best = int(m.argmax())
                yield labels[best], float(min(1.0, m[best])), [float(x) for x in m]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = FIT_ROWS,
          languages: int = LANGUAGES) -> Model | None:
    """A model fitted on at most about ``per_language`` labelled rows of each language, taken by a hash of the id, and
    ``FIT_CHARS`` code points of a row.

    The rows of each language are counted over all of them; the hash then passes the right share, so
    that nothing is ranked or sorted. The ``languages`` most frequent are learned, so that a dirty column
    neither floods the driver nor the model. Null or empty languages and null texts teach nothing. Repeated rows
    teach as often as they are taken; their order does not matter.
    """
    labelled = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where("l IS NOT NULL AND l <> '' AND t IS NOT NULL")
    counts = labelled.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(languages)
    bounds = counts.select("l", F.least(F.lit(1 << 20), F.ceil(F.lit(per_language << 20) / F.col("n"))).alias("bound"))
    pick = F.pmod(F.xxhash64(F.lit(5), "i"), F.lit(1 << 20))
    # at most ``languages`` rows are broadcast, and per_language * languages bounded texts come back
    rows = labelled.join(F.broadcast(bounds), "l").where(pick < F.col("bound")).select(F.substring("t", 1, FIT_CHARS).alias("t"), "l").toArrow()
    told = sorted(zip(rows.column("t").to_pylist(), rows.column("l").to_pylist(), strict=True))
    return fit(told) if told else None


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score, shares)`` for every row; only the text is read for it.

    ``score`` is the share of the text's word mass in the predicted language, ``shares`` that
    of every learned one. A null text, or one without letters, is ``und`` with score 0, and so
    is everything if nothing could be learned. Repeated rows agree; a null id stays null.
    No rows give no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 2 ** BITS weights a language and its lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tagger = Tagger(model) if model else None
        for b in batches:
            texts = b.column(1).to_pylist()
            found = list(tagger.predict(texts)) if tagger else [("und", 0.0, [])] * len(texts)
            langs, scores, shares = zip(*found, strict=True) if found else ((), (), ())
            shares = [list(zip(model.labels, s, strict=True)) if model else [] for s in shares]
            yield pa.record_batch(
                [b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.map_(pa.string(), pa.float64()))],
                ["id", "lang_pred", "score", "shares"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(lean(run), "id long, lang_pred string, score double, shares map<string,double>")


def tag_words(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, langs)``: the most likely language of every word that holds a letter, in order. Null or wordless texts: empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        names = np.array(tagger.model.labels)
        for b in batches:
            out = []
            for marginal, counts in tagger.marginals(b.column(1).to_pylist()):
                best = names[marginal.argmax(axis=0)] if marginal.shape[1] else np.array([], names.dtype)
                out += [list(x) for x in np.split(best, np.cumsum(counts)[:-1])]
            yield pa.record_batch([b.column(0), pa.array(out, pa.list_(pa.string()))], ["id", "langs"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, "id long, langs array<string>")


def reject_unidentified(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` whose language is known: not ``und``, and holding at least ``least`` of the word mass.

    All columns pass through unchanged. With no model nothing can be known and no row stays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value) if shared.value else None
        for b in batches:
            found = tagger.predict(each(b.column(at))) if tagger else [("und", 0.0, [])] * len(b)
            stay = [lang != "und" and score >= least for lang, score, _ in found]
            for lo in range(0, b.num_rows, TEXTS):
                yield b.slice(lo, TEXTS).filter(pa.array(stay[lo : lo + TEXTS], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)
