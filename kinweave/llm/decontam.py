"""Benchmark decontamination by spaced seeds.

A mask slides over the tokens of test items and documents and hashes only the positions it
keeps, so two windows collide although the tokens it ignores differ. Document windows are
first looked up in a bit map of the test hashes (fixed size), then joined to them by hash;
around every hit the item and the document are laid on each other and the overlap is
counted token by token, substitutions included.

An item too short for a stretch must agree as a whole. It is cut into one piece more than the
tokens it may differ in, so that one piece at least is found as it stands; masks are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.tokens import Remember, each, lean, plain_hash
from kinweave.operators.skew import bounded, spread_join
from kinweave.runtime import materialize

#: 1: the token counts, 0: it is ignored.
MASKS = ("111111", "1110111", "11011011", "110010111", "1010110011")
#: Document tokens whose hits go together; bounds a row, whatever the text's length.
STRETCH = 4096
#: Largest bit map, in bits as a power of two (16 MB).
MAP_BITS = 27
_U = np.uint64


def window_hashes(tokens: np.ndarray, mask: int) -> np.ndarray:
    """Hash of the window at every position, over the positions that ``MASKS[mask]`` keeps; of -mask tokens if it is negative."""
    kept = [i for i, c in enumerate(MASKS[mask]) if c == "1"] if mask >= 0 else range(-mask)
    n = len(tokens) - (len(MASKS[mask]) if mask >= 0 else -mask) + 1
    if n <= 0:
        return np.zeros(0, _U)
    h = np.full(n, mask + 1 if mask >= 0 else len(MASKS) - mask, _U)
    for i in kept:
        h = (h ^ tokens[i : i + n]) * _U(0x9E3779B97F4A7C15)
        h ^= h >> _U(29)
    return h


def pieces(n: int, similarity: float) -> list[int]:
    """Bounds of the pieces of an item of ``n`` tokens: one more than the tokens that may differ, as far as there are tokens."""
    parts = min(n, int((1 - similarity) * n + 1e-9) + 1)
    return [n * k // parts for k in range(parts + 1)] if n else [0]


def _slots(h, bits: int):
    """Two positions in the bit map."""
    return h >> _U(64 - bits), (h * _U(0xD6E8FEB86659FD93)) >> _U(64 - bits)


def _item_hashes(min_tokens: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                tokens = np.array([h for w in (text or b"").split() if (h := plain_hash(w))], _U)
                if len(tokens) <= min_tokens:
                    cut = pieces(len(tokens), similarity)
                    h = [window_hashes(tokens[x:y], x - y) for x, y in zip(cut, cut[1:])]
                    at = np.array(cut[:-1], np.int32)
                else:
                    h = [window_hashes(tokens, m) for m in range(len(MASKS))]
                    at = np.concatenate([np.arange(len(x), dtype=np.int32) for x in h])
                h = np.concatenate([*h, np.zeros(0, _U)])
                yield pa.record_batch(
                    [pa.array([item], pa.int64()), pa.array([tokens.view(np.int64)], pa.list_(pa.int64())), pa.array([h.view(np.int64)], pa.list_(pa.int64())), pa.array([at], pa.list_(pa.int32()))],
                    ["item", "tokens", "hashes", "at"])

    return run


def bit_map(test: DataFrame) -> tuple[int, np.ndarray]:
    """Bit map of all test hashes: size as a power of two (by their number, at most MAP_BITS) and its bytes."""
    n = test.count()
    bits = int(min(MAP_BITS, max(16, np.ceil(np.log2(max(n, 1) * 4096)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(np.concatenate(_slots(np.ascontiguousarray(b.column(0).to_numpy()).view(_U), bits)))
            yield pa.record_batch([pa.array((at >> _U(6)).astype(np.int64)), pa.array((_U(1) << (at & _U(63))).view(np.int64))], ["word", "set"])

    rows = test.select("hash").mapInArrow(run, "word long, set long").groupBy("word").agg(F.bit_or("set").alias("set")).toArrow()
    words = np.zeros(1 << (bits - 6), _U)
    words[rows.column("word").to_numpy()] = rows.column("set").to_numpy().view(_U)
    return bits, words


def _segments(shared, bits: int, lengths: list[int], around: int):
    """Stretches of a document with windows that may be a test item's: their tokens, and the windows. ``lengths`` are those of pieces.

    With each window come ``around`` tokens on both sides, as many as the longest item has: all that an item laid on
    the window can cover, so that what is counted is the whole document's overlap.
    """
    kinds_of = [*range(len(MASKS)), *(-n for n in lengths)]
    longest = max([*map(len, MASKS), *lengths])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = shared.value, Remember(plain_hash)

        def seen(at: np.ndarray) -> np.ndarray:
            return (words[at >> _U(6)] >> (at & _U(63))) & _U(1) == 1

        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(b.column(0).to_pylist(), each(b.column(1).cast(pa.binary())), strict=True):
                raw = (text or b"").split()
                tokens = np.fromiter(map(known.__getitem__, raw), _U, len(raw))
                tokens = tokens[tokens != 0]
                found_at, found = [], []
                for m in kinds_of:
                    h = window_hashes(tokens, m)
                    one, two = _slots(h, bits)
                    at = np.flatnonzero(seen(one))
                    at = at[seen(two[at])]
                    found_at.append(at)
                    found.append(h[at])
                at = np.concatenate(found_at)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, h = at[order], np.concatenate(found)[order]
                cuts = np.flatnonzero((np.diff(at) > 2 * around) | (np.diff(at // STRETCH) > 0)) + 1
                for k, (a, hh) in enumerate(zip(np.split(at, cuts), np.split(h, cuts), strict=True)):
                    start = max(0, int(a[0]) - around)
                    part = tokens[start : int(a[-1]) + around + longest]
                    for column, value in zip(out, (doc, k, part.view(np.int64), hh.view(np.int64), (a - start).astype(np.int32)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["doc", "seg", "tokens", "hashes", "at"])

    return run


def overlap(item: np.ndarray, doc: np.ndarray, shift: int, similarity: float) -> tuple[int, int, int]:
    """The longest stretch, item token i on document token i + shift, with ``similarity`` of its tokens equal:
    (tokens, equal tokens, first item token)."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    if hi <= lo:
        return 0, 0, 0
    same = item[lo:hi] == doc[lo + shift : hi + shift]
    equal = np.concatenate([[0], np.cumsum(same)])
    gain = equal - similarity * np.arange(len(equal)) + 1e-9 * (np.arange(len(equal)) > 0)
    low = np.minimum.accumulate(gain)
    best = (0, 0, 0)
    for end in np.flatnonzero(same) + 1:
        start = int(np.searchsorted(-low, -(gain[end] + 1e-9), side="left"))
        while start < end and not same[start]:
            start += 1
        if end - start > best[0] and equal[end] - equal[start] >= similarity * (end - start) - 1e-9:
            best = (int(end - start), int(equal[end] - equal[start]), int(start + lo))
    return best


def whole(item: np.ndarray, doc: np.ndarray, shift: int, similarity: float) -> tuple[int, int]:
    """(tokens, equal tokens) of the whole item laid on the document, if it fits and ``similarity`` of its tokens are equal."""
    if shift < 0 or shift + len(item) > len(doc):
        return 0, 0
    equal = int((item == doc[shift : shift + len(item)]).sum())
    return (len(item), equal) if equal >= similarity * len(item) - 1e-9 else (0, 0)


def _verify(min_tokens: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc, item, shift, theirs, own in zip(*(b.column(i) for i in range(5)), strict=True):
                test = theirs.values.to_numpy()
                laid = whole if len(test) <= min_tokens else overlap
                n, equal = laid(test, own.values.to_numpy(), shift.as_py(), similarity)[:2]
                if n >= min(min_tokens, len(test)):
                    out.append((doc.as_py(), item.as_py(), n, equal))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["doc", "item", "n", "equal"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", min_tokens: int = 12, similarity: float = 0.8) -> DataFrame:
    """``(doc_id, item_id, n_tokens, n_equal)`` for every document and test item that overlap.

    Tokens are what ASCII whitespace parts, lower-cased and without outer punctuation. A
    pair overlaps if, laid on each other without gaps, a stretch of at least ``min_tokens``
    tokens agrees in ``similarity`` of them; n_tokens and n_equal describe the longest such
    stretch of the whole texts, which begins and ends on equal tokens. An item of ``min_tokens`` or fewer must lie
    in the document as a whole and agree in ``similarity`` of all its tokens, wherever it
    differs; one of a few words may be in many documents. Items without tokens match nothing. Rows with a null id are left out.
    Repeated rows, equal items and ties give one row per pair of ids. Other columns are not
    read. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    tests = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("t")).where("item IS NOT NULL").distinct()
    tests = materialize(tests.mapInArrow(_item_hashes(min_tokens, similarity), "item long, tokens array<long>, hashes array<long>, at array<int>"), "test-items")
    test = tests.select("item", F.explode(F.arrays_zip("hashes", "at")).alias("x")).select("item", F.col("x.hashes").alias("hash"), F.col("x.at").alias("item_at"))
    size = F.size("tokens")
    longest = tests.agg(F.coalesce(F.max(size), F.lit(0))).first()[0]
    short = [r.n for r in tests.select(size.alias("n")).where(F.col("n") <= min_tokens).distinct().collect()]  # min_tokens + 1 numbers at most
    lengths = sorted({y - x for n in short for cut in [pieces(n, similarity)] for x, y in zip(cut, cut[1:])})
    bits, words = bit_map(test)
    shared = spark.sparkContext.broadcast(words)  # 2 ** MAP_BITS bits at most, whatever the benchmark
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("t"))
    segments = materialize(rows.mapInArrow(lean(_segments(shared, bits, lengths, longest)), "doc long, seg int, tokens array<long>, hashes array<long>, at array<int>"), "segments")
    hits = segments.select("doc", "seg", F.explode(F.arrays_zip("hashes", "at")).alias("x")).select("doc", "seg", F.col("x.hashes").alias("hash"), F.col("x.at").alias("doc_at"))
    laid = spread_join(hits, test, ["hash"], ["doc", "seg", "doc_at"])
    laid = materialize(laid.select("doc", "seg", "item", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct(), "laid-items")
    pairs = (
        spread_join(laid, tests.select("item", F.col("tokens").alias("theirs")), ["item"], ["doc", "seg", "shift"])
        .join(segments.select("doc", "seg", F.col("tokens").alias("own")), ["doc", "seg"])
        .select("doc", "item", "shift", "theirs", "own")
        .mapInArrow(lean(_verify(min_tokens, similarity)), "doc long, item long, n long, equal long"))
    best = F.max(F.struct("n", "equal"))
    return pairs.groupBy("doc", "item").agg(best.alias("b")).select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("b.n").alias("n_tokens"), F.col("b.equal").alias("n_equal"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that overlap a test item. Rows with a null id stay."""
    gone = materialize(contaminated(docs, benchmark, id_col, **options).select(F.col("doc_id").alias(id_col)).distinct(), "contaminated")
    return docs.join(bounded(gone), id_col, "left_anti")
