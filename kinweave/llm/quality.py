"""Document quality: text statistics, base rules and gradient-boosted trees.

The trees are fitted on a bounded sample of labelled rows with histogram splits and Newton
leaves; features named in ``MONOTONE`` may only push the score one way. They are flattened
into numpy node arrays, and all rows of a batch walk a tree together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "line_words", "upper_share", "digit_share", "distinct_share", "stop_share")
#: +1: a larger value may only raise the score, -1: only lower it.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "digit_share": -1}
#: Labelled rows the trees are fitted on at most, about.
FIT_ROWS = 4000


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that are found twice or more, the first included."""
    n, codes = len(words), {}
    if n < 4:
        return 0
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    u = len(codes)
    if u == n:
        return 0
    pair = ids[:-1] * u + ids[1:]
    if u > 2_000_000:  # else the code of a window fits 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, at, times = np.unique(pair[:-1] * u + ids[2:], return_inverse=True, return_counts=True)
    again, held = times[at] > 1, np.zeros(n, bool)
    for k in range(3):
        held[k : n - 2 + k] |= again
    return int(held.sum())


def describe(text: bytes | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The counts and the features of a UTF-8 text; a null text has no words."""
    text = text or b""
    words = text.split()
    n = len(words)
    blank = sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    points = len(text.decode("utf-8", "replace"))
    symbols = sum(text.count(bytes([c])) for c in SYMBOLS)
    lines, dup = text.split(b"\n"), 0
    if len(set(lines)) < len(lines):
        seen: set[bytes] = set()
        for line in lines:
            dup += line in seen and bool(line.strip())
            seen.add(line)
    repeats = repeated_words(words)
    some = max(n, 1)
    upper = sum(map(text.count, _UPPER))
    digits = sum(map(text.count, _DIGITS))
    counts = (n, points - blank, symbols, dup, repeats)
    return counts, (
        float(np.log1p(n)), (points - blank) / some, symbols / some, dup / len(lines), repeats / some, n / len(lines),
        upper / some, digits / some, len(set(words)) / some, (text.count(b".") + text.count(b"?") + text.count(b"!")) / some)


_UPPER = [bytes([c]) for c in range(65, 91)]
_DIGITS = [bytes([c]) for c in range(48, 58)]


@dataclass
class Trees:
    """All nodes of all trees. A leaf is its own child, so that every row takes ``depth`` steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of good quality of each row of features."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out += self.value[at]
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48, ridge: float = 1.0, least: int = 8) -> Trees:
    """Boosted trees for the logistic loss, under the monotonic constraints of ``MONOTONE``."""
    sign = np.array([MONOTONE.get(f, 0) for f in FEATURES])
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1) if len(x) else np.zeros(x.shape, int)
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    score, roots = np.full(len(y), base), []

    def add() -> int:
        for k, v in (("feature", 0), ("threshold", np.inf), ("left", len(nodes["left"])), ("right", len(nodes["right"])), ("value", 0.0)):
            nodes[k].append(v)
        return len(nodes["value"]) - 1

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, lo: float, hi: float, level: int) -> int:
        me, gs, hs = add(), g[rows].sum(), h[rows].sum()
        own = float(np.clip(gs / (hs + ridge), lo, hi))
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * least:
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                c = code[rows, f]
                gl, hl, nl = (np.cumsum(np.bincount(c, w, len(e) + 1))[:-1] for w in (g[rows], h[rows], None))
                vl, vr = np.clip(gl / (hl + ridge), lo, hi), np.clip((gs - gl) / (hs - hl + ridge), lo, hi)
                gain = gl * vl - 0.5 * (hl + ridge) * vl**2 + (gs - gl) * vr - 0.5 * (hs - hl + ridge) * vr**2 - gs * own + 0.5 * (hs + ridge) * own**2
                gain[(nl < least) | (len(rows) - nl < least) | ((vr - vl) * sign[f] < 0)] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, float(vl[k]), float(vr[k])))
        if best[1] is None:
            nodes["value"][me] = rate * own
            return me
        f, k, vl, vr = best[1]
        mid = (vl + vr) / 2  # children keep to their side of it, whatever they split on
        bounds = {0: ((lo, hi), (lo, hi)), 1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid))}[int(sign[f])]
        under = code[rows, f] <= k
        nodes["feature"][me], nodes["threshold"][me] = f, float(edges[f][k])
        nodes["left"][me] = grow(rows[under], g, h, *bounds[0], level + 1)
        nodes["right"][me] = grow(rows[~under], g, h, *bounds[1], level + 1)
        return me

    for _ in range(rounds if len(set(y.tolist())) > 1 else 0):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(len(y)), y - p, p * (1 - p), -np.inf, np.inf, 0))
        one = Trees(*(np.array(nodes[k]) for k in nodes), np.array(roots[-1:]), 0.0, depth)
        s = one.score(x)
        score += np.log(s) - np.log1p(-s)
    return Trees(*(np.array(nodes[k]) for k in nodes), np.array(roots, int), base, depth)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
          label_col: str = "quality", fit_rows: int = FIT_ROWS) -> Trees:
    """Trees fitted on about ``fit_rows`` labelled rows at most, taken by a hash of the id. Null labels and ids teach nothing.

    Of labels that disagree about an id the lowest counts. Repeated documents each teach; the order of rows does not matter.
    """
    rows = labels.select(F.col(label_id_col).cast("long").alias("__i"), F.col(label_col).cast("int").alias("__y")).where("__i IS NOT NULL AND __y IS NOT NULL")
    n = max(1, rows.count())
    part = min(1 << 20, -(-(fit_rows << 20) // n))
    rows = rows.where(F.pmod(F.xxhash64(F.lit(11), "__i"), F.lit(1 << 20)) < part).groupBy("__i").agg(F.min("__y").alias("__y"))
    texts = docs.select(F.col(id_col).cast("long").alias("__i"), F.col(text_col).cast("string").alias("t"))
    # about fit_rows rows of two numbers, whatever the input
    found = texts.join(F.broadcast(rows), "__i").mapInArrow(_fit_rows, "id long, y int, x array<double>").toArrow()
    told = sorted(zip(*(found.column(c).to_pylist() for c in ("id", "x", "y")), strict=True))
    return fit(np.array([x for _, x, _ in told], float).reshape(-1, len(FEATURES)), np.array([float(y > 0) for *_, y in told]))


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [describe(t)[1] for t in b.column("t").cast(pa.binary()).to_pylist()]
        yield pa.record_batch([b.column("__i"), b.column("__y"), pa.array(x, pa.list_(pa.float64()))], ["id", "y", "x"])


def judge(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept)`` for every row.

    Base rules fail a text of fewer than 50 words, or with over half its words in repeated
    three-word windows. ``kept``: the base rules pass and the trees give at least ``least``.
    Null, empty and blank texts have no words and fail. Repeated rows agree; a null id stays null.
    Other columns are not read. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [describe(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            score = shared.value.score(np.array([f for _, f in found], float).reshape(-1, len(FEATURES)))
            failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
            yield pa.record_batch(
                [b.column(0), *(pa.array(counts[:, i].copy()) for i in range(len(COUNTS))), pa.array(failed), pa.array(score), pa.array(~failed & (score >= least))],
                ["id", *COUNTS, "base_failed", "score", "kept"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, "id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean")
