"""Near-duplicate groups by SimHash and generalised pigeonhole probing.

Fingerprints are 64-bit SimHashes of word shingles. Two link when they differ in at most
``max_distance`` bits. Links are found over the *distinct* fingerprints:

1. one pass counts how often every two bits are set together;
2. the driver groups correlated bits into partitions and spreads unequal thresholds over
   them by dynamic programming on the candidate counts these statistics predict. Any two
   fingerprints within the distance then agree, up to its threshold, on some partition;
3. every fingerprint is indexed under its value in each used partition and probes the
   values within the threshold; what meets is verified on all 64 bits;
4. a bucket of many fingerprints is cut into blocks and its pairs of blocks are spread
   over tasks; a task returns a spanning forest of the links it verified, not the pairs.

A wide distance finds edited copies but lets chance pairs through on 64 bits. Fingerprints of
further seeds (``checks``) then travel along, and a link must also hold over all their bits.

With ``similarity`` the bits only find candidates: inside each group they link, the sets of
shingles themselves are compared, and only links of that Jaccard similarity make components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.tokens import each, lean
from kinweave.operators.components import connected_components
from kinweave.operators.skew import bounded, spread_join
from kinweave.runtime import materialize

BITS = 64
#: Shingles hashed at a time; bounds the memory a very long text takes.
CHUNK = 1 << 15
#: Fingerprints of a bucket's block; a larger bucket is compared block by block.
BLOCK = 1024
#: Cost of shuffling one index or probe row, and of verifying one pair, in the planner: 1.4 ns a pair and 5 to 8 us a row, sort and hand-over to Python
#: in them, were measured.
ROW_COST, PAIR_COST = 1.0, 0.0002
#: Rows compared at once with a block; their distances fit a processor's cache.
SLICE = 32
#: Shingles of a block of a candidate group; a larger group is compared block by block.
SET_BLOCK = 1 << 19
#: Texts whose sets of five-word shingles are 0.8 similar. Candidates: bits of the fingerprint, further fingerprints, bits
#: of all of them (at 0.8 similarity 29 of 192 are expected, with a deviation of 5).
#: ``searches``: fingerprints whose near values propose candidates. One finds about 0.95 of the pairs of just 0.8 (9.7 of 64 bits
#: are expected to differ, with a deviation of 2.9), two nearly all.
SIMILAR = {"shingle": 5, "max_distance": 14, "checks": 2, "max_total": 48, "block": 1 << 16, "similarity": 0.8, "searches": 2}


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a UTF-8 text; 0 for a null text or one without words."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and exactly \x20\x09-\x0D
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    n, ones = len(words) - shingle + 1, np.zeros(BITS, np.int64)
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(shingle)), strict=False))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(seed))
    for at in range(0, n, CHUNK):
        h = np.fromiter(islice(hashes, CHUNK), "<u8", min(CHUNK, n - at))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def shingle_set(text: bytes | None, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """Distinct shingle hashes of a UTF-8 text, sorted. Fewer words than a shingle has are one; no words are none."""
    words = (text or b"").lower().split()
    if 0 < len(words) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(shingle)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, max(0, len(words) - shingle + 1)))


def set_fingerprint(hashes: np.ndarray, k: int = 0) -> int:
    """SimHash of a set of hashes, each counted once; ``k`` mixes them anew, as another seed would."""
    if k:
        hashes = hashes + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        hashes = (hashes ^ hashes >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        hashes = (hashes ^ hashes >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        hashes = hashes ^ hashes >> np.uint64(31)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        ones += np.unpackbits(hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def _names(checks: int) -> list[str]:
    """The fingerprint's column and those of further seeds."""
    return ["fp", *(f"c{k}" for k in range(1, checks + 1))]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, checks: int = 0) -> DataFrame:
    """``(id, fp, c1, ...)``: the fingerprint of every row as a signed 64-bit integer, and those of the next ``checks`` seeds."""
    names = _names(checks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([[fingerprint(t, shingle, seed + k) for k in range(len(names))] for t in texts], np.uint64).reshape(-1, len(names))
            yield pa.record_batch([b.column(0), *(pa.array(fps[:, k].copy().view(np.int64)) for k in range(len(names)))], ["id", *names])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, "id long, " + ", ".join(f"{c} long" for c in names))


def set_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, checks: int = 0) -> DataFrame:
    """``(id, fp, c1, ..., digest)`` like ``fingerprints``, of the set of shingles; ``digest`` is equal where the sets are."""
    names = _names(checks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in each(b.column(1).cast(pa.binary())):
                h = shingle_set(t, shingle, seed)
                rows.append([*(set_fingerprint(h, k) for k in range(len(names))), xxhash.xxh64_intdigest(h.tobytes(), seed)])
            fps = np.array(rows, np.uint64).reshape(-1, len(names) + 1)
            yield pa.record_batch([b.column(0), *(pa.array(fps[:, k].copy().view(np.int64)) for k in range(fps.shape[1]))], ["id", *names, "digest"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(lean(run), "id long, " + ", ".join(f"{c} long" for c in [*names, "digest"]))


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Rows of ``fps`` and the 64 x 64 counts of bits set together (4096 numbers, whatever the input)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        n = 0
        for b in batches:
            raw = np.ascontiguousarray(b.column(0).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            for at in range(0, len(raw), CHUNK):
                bits = np.unpackbits(raw[at : at + CHUNK], axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
            n += len(raw)
        if n:
            cells = np.append(total.astype(np.int64).ravel(), n)
            yield pa.record_batch([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], ["cell", "n"])

    rows = fps.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1, np.int64)
    for r in rows:
        cells[r.cell] = r.n
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def group_bits(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """The 64 bits in ``m`` groups of near-equal width, each grown from its most correlated pair."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, groups = list(range(BITS)), []
    for k in range(m):
        width = BITS // m + (k < BITS % m)
        sub = corr[np.ix_(free, free)]
        i, j = np.unravel_index(int(sub.argmax()), sub.shape)
        group = [free[i], free[j]] if i != j else free[:2]
        free = [x for x in free if x not in group]
        while len(group) < width:
            best = max(free, key=lambda x: (corr[x, group].sum(), -x))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def differing(together: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of two random rows: the chance that a bit differs, and the covariance of two bits' differing (both from the pair counts)."""
    p11 = together / max(n, 1)
    one = np.diag(p11)
    p10 = np.clip(one[:, None] - p11, 0, 1)
    p01 = np.clip(one[None, :] - p11, 0, 1)
    p00 = np.clip(1 - p11 - p10 - p01, 0, 1)
    chance = np.clip(2 * one * (1 - one), 0, 1)
    return chance, 2 * (p11 * p00 + p10 * p01) - np.outer(chance, chance)


def within(chance: np.ndarray, covariance: np.ndarray, t: int) -> float:
    """Chance that at most ``t`` bits of a group differ: a beta-binomial of the number's mean and variance.

    Bits that go together make near values likelier than independent bits would; bits that avoid each other count as independent.
    """
    w, mean = len(chance), float(chance.sum())
    q = mean / w
    if t >= w or q <= 0:
        return 1.0
    independent = w * q * (1 - q)
    rho = min(0.999, max(0.0, (float(covariance.sum()) / independent - 1) / (w - 1))) if w > 1 and independent > 0 else 0.0
    if rho < 1e-6:
        return float(sum(math.comb(w, k) * q**k * (1 - q) ** (w - k) for k in range(t + 1)))
    a, b = q * (1 - rho) / rho, (1 - q) * (1 - rho) / rho
    beta = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    return float(sum(math.comb(w, k) * math.exp(beta(k + a, w - k + b) - beta(a, b)) for k in range(t + 1)))


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]] | None:
    """Thresholds of least total cost. ``costs[i][t + 1]`` is the cost of threshold t (-1: unused); the t + 1 sum to ``budget``. None if none do."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for k, c in enumerate(row[: budget - used + 1]):
                if used + k not in nxt or cost + c < nxt[used + k][0]:
                    nxt[used + k] = (cost + c, [*chosen, k - 1])
        best = nxt
    return best.get(budget)


def plan(n: int, together: np.ndarray, max_distance: int, block: int = BLOCK) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of the partitions in use. Rows of a bucket beyond ``block`` are copied, which counts.

    The thresholds t of m partitions satisfy sum(t + 1) = max_distance + 1, which is the
    generalised pigeonhole bound: were every partition off by more than its t, the whole
    would be off by more than ``max_distance``.
    """
    chance, covariance = differing(together, n)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(2, min(BITS, max_distance + 1) + 1) if max_distance else [2]:
        groups = group_bits(together, n, m)
        costs = []
        for g in groups:
            row = [0.0]
            alike = within(chance[g], covariance[np.ix_(g, g)], 0)
            for t in range(min(max_distance + 1, len(g))):
                probes = 1 + sum(math.comb(len(g), k) for k in range(1, t + 1)) / 2
                copies = max(1.0, n * probes * alike / block)
                row.append(n * probes * copies * ROW_COST + n * n / 2 * within(chance[g], covariance[np.ix_(g, g)], t) * PAIR_COST)
            costs.append(row)
        found = allocate(costs, max_distance + 1)
        if found is None:
            continue
        cost, thresholds = found
        if best is None or cost < best[0]:
            best = cost, [(g, t) for g, t in zip(groups, thresholds, strict=True) if t >= 0]
    return best[1]


def _entries(parts: list[tuple[list[int], int]], names: list[str]):
    """Index and probe rows of rows ``(*names, rep)``, whose first column is the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [np.ascontiguousarray(c.to_numpy(zero_copy_only=False)) for c in b.columns]
            u = kept[0].view(np.uint64)
            for i, (bits, t) in enumerate(parts):
                value = np.zeros(len(u), np.uint64)
                for k, bit in enumerate(bits):
                    value |= ((u >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
                key = value | np.uint64(i << 58)
                yield pa.record_batch([pa.array(key.view(np.int64)), *map(pa.array, kept), pa.array(np.zeros(len(u), bool))], ["key", *names, "rep", "probe"])
                for k in range(1, t + 1):
                    for flip in combinations(range(len(bits)), k):
                        # of two values that differ in these bits exactly one has 0 in the lowest
                        own = (value >> np.uint64(flip[0])) & np.uint64(1) == 0
                        to = (key ^ np.uint64(sum(1 << x for x in flip)))[own]
                        yield pa.record_batch([pa.array(to.view(np.int64)), *(pa.array(c[own]) for c in kept), pa.array(np.ones(len(to), bool))], ["key", *names, "rep", "probe"])

    return run


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as a forest: (node, smallest node of its component), roots left out."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = code[: len(a)], code[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        rx, ry = root[x], root[y]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while not np.array_equal(root[root], root):
            root = root[root]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def span(near: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the components of the matrix ``near`` of links between ``rows`` and ``columns``, no more than these."""
    met = np.flatnonzero(near.any(axis=0))
    near = near[:, met].astype(np.float32)
    child, root = local_forest(*np.nonzero(np.triu(near @ near.T, 1)))  # rows that share a column
    return np.concatenate([rows[near.argmax(axis=0)], rows[child]]), np.concatenate([columns[met], rows[root]])


def _verify(max_distance: int, names: list[str], max_total: int | None):
    def links(fps: np.ndarray, rep: np.ndarray, probe: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        fp = fps[0]

        def surely(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Of rows near on their fingerprints: those near on all bits."""
            if max_total is None:
                return np.ones(len(a), bool)
            return sum(np.bitwise_count(f[a] ^ f[b]).astype(np.int16) for f in fps) <= max_total

        for s in np.unique(sizes[sizes > 1]):
            at = starts[sizes == s]
            if s <= 32:
                for lo in range(0, len(at), step := max(1, (1 << 20) // int(s * s))):
                    rows = at[lo : lo + step, None] + np.arange(s)
                    g = fp[rows]
                    near = np.bitwise_count(g[:, :, None] ^ g[:, None, :]) <= max_distance
                    k, i, j = np.nonzero(near & (np.arange(s)[:, None] < np.arange(s)))
                    a, b = rows[k, i], rows[k, j]
                    sure = surely(a, b)
                    yield rep[a[sure]], rep[b[sure]]
            else:
                for start in at:
                    rows = np.arange(start, start + s)
                    held, asking = rows[~probe[rows]], rows[probe[rows]]
                    for lo in range(0, len(held), SLICE):
                        part, there = held[lo : lo + SLICE], np.concatenate([held[lo:], asking])  # each two rows of the index meet once
                        near = np.bitwise_count(fp[part][:, None] ^ fp[there][None, :]) <= max_distance
                        found = np.flatnonzero(near)
                        i, j = found // len(there), found % len(there)
                        sure = surely(part[i], there[j])
                        if len(found) <= 4 * len(there):  # few links: as they are
                            yield rep[part[i[sure]]], rep[there[j[sure]]]
                        else:
                            near[i[~sure], j[~sure]] = False
                            yield span(near, rep[part], rep[there])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            k = [np.ascontiguousarray(t.column(c).to_numpy()) for c in ("key", "b1", "b2")]
            edge = np.flatnonzero((k[0][1:] != k[0][:-1]) | (k[1][1:] != k[1][:-1]) | (k[2][1:] != k[2][:-1])) + 1
            cut = int(edge[-1]) if len(edge) else 0
            rest = t.slice(cut).combine_chunks()
            if cut:
                yield from emit(t.slice(0, cut), np.append(0, edge[:-1]), cut)
        if rest is not None and len(rest):
            yield from emit(rest, np.array([0]), len(rest))

    def emit(t: pa.Table, starts: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
        fps = np.stack([t.column(c).to_numpy() for c in names]).view(np.uint64)
        rep, probe = t.column("rep").to_numpy(), t.column("probe").to_numpy()
        found = list(links(fps, rep, probe, starts, np.diff(np.append(starts, n))))
        if found:
            a, b = local_forest(*(np.concatenate(x) for x in zip(*found, strict=True)))
            if len(a):
                yield pa.record_batch([pa.array(a), pa.array(b)], ["src", "dst"])

    return run


def near_links(distinct: DataFrame, max_distance: int = 3, block: int = BLOCK, max_total: int | None = None) -> DataFrame:
    """``(src, dst)`` links that span the components of distinct fingerprints ``(fp, rep)`` at ``max_distance``.

    With ``max_total``, rows are ``(fp, c1, ..., rep)`` and links must also differ in at most so many bits of all fingerprints.
    """
    n, together = bit_statistics(distinct)
    parts = plan(n, together, max_distance, block)
    names = [c for c in distinct.columns if c != "rep"]
    entries = distinct.select(*names, "rep").mapInArrow(_entries(parts, names), "key long, " + ", ".join(f"{c} long" for c in names) + ", rep long, probe boolean")
    large = entries.groupBy("key").count().where(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    dealt = (
        entries.join(large, "key", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64(*names), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), *names, "rep", "probe"))
    return (dealt.repartition("key", "b1", "b2").sortWithinPartitions("key", "b1", "b2")
            .mapInArrow(lean(_verify(max_distance, names, max_total)), "src long, dst long"))


def similar_sets(ids: np.ndarray, sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(id, root)`` that span the components of non-empty ``sets`` whose Jaccard similarity is at least ``similarity``.

    Found sets are compared with what no component holds yet, so tight groups cost little more than their size.
    """
    sizes = np.array([len(x) for x in sets])
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    has = np.zeros(len(values), np.int32)
    left, flat, out = np.arange(len(sets)), codes, []
    while len(left):
        root = left[0]
        queue, left, flat = [root], left[1:], flat[sizes[root] :]
        while queue and len(left):
            i = queue.pop()
            own = codes[ends[i] - sizes[i] : ends[i]]
            has[own] = 1
            n = sizes[left]
            both = np.add.reduceat(has[flat], np.cumsum(n) - n)
            has[own] = 0
            near = both >= similarity * (n + sizes[i] - both) - 1e-9
            if near.any():
                queue.extend(left[near])
                out.append((ids[left[near]], np.full(int(near.sum()), ids[root])))
                left, flat = left[~near], flat[np.repeat(~near, n)]
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (none, none)


def similar_links(docs: DataFrame, groups: DataFrame, similarity: float, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 3, seed: int = 42, block: int = SET_BLOCK) -> DataFrame:
    """``(src, dst)`` links that span the components, within each candidate group ``(node, component)`` of ids, of exact similarity.

    A group of more than ``block`` shingles is cut into blocks of about that size, and each pair of blocks is a task's.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = [shingle_set(t, shingle, seed).view(np.int64) for t in part.column(2).cast(pa.binary()).to_pylist()]
                yield pa.record_batch([part.column(0), part.column(1), pa.array([len(h) for h in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["component", "id", "n", "set"])

    def links(t: pa.Table) -> pa.Table:
        column = t.column("set").combine_chunks()
        src, dst = similar_sets(t.column("id").to_numpy(), [x.values.to_numpy().view(np.uint64) for x in column], similarity)
        return pa.table({"src": src, "dst": dst})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    held = rows.join(bounded(materialize(groups, "groups")), F.col("id") == F.col("node")).select("component", "id", "t")
    held = materialize(held.mapInArrow(lean(sets), "component long, id long, n long, set array<long>").where("n > 0"), "sets")
    large = held.groupBy("component").agg(F.sum("n").alias("n")).where(F.col("n") > block).select("component", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    dealt = (
        held.join(bounded(materialize(large, "large-groups")), "component", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("own <> other OR blocks = 1")
        .select("component", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "id", "set"))
    # dealt by all three, or a group's blocks would come to one task
    return dealt.repartition("component", "b1", "b2").groupBy("component", "b1", "b2").applyInArrow(links, "src long, dst long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_distance: int = 3,
                    shingle: int = 3, seed: int = 42, block: int = BLOCK, checks: int = 0, max_total: int | None = None, similarity: float | None = None,
                    searches: int = 1) -> DataFrame:
    """``(id, fp, component)`` for every row: the smallest id reachable over near fingerprints.

    With ``max_total``, the fingerprints of the next ``checks`` seeds count too: a link then
    differs in at most ``max_distance`` bits of the first and ``max_total`` of all. With ``searches``
    above one, of any of the first so many, which finds what a single one misses by chance.

    With ``similarity``, such links only propose groups. Inside one, two texts link when the sets
    of their shingles have that Jaccard similarity, and ``fp`` is the fingerprint of the set.

    Equal fingerprints link at distance 0, so texts without words (null, empty, blank) form
    one group under fingerprint 0. Rows with a null id keep their fingerprint and get a null
    component. Repeated rows are all returned, in the same component. Other columns are not
    read. No rows give no rows.
    """
    names = _names(checks)
    exact = similarity is not None
    key = [*names, "digest"] if exact else names
    fps = materialize((set_fingerprints if exact else fingerprints)(docs, id_col, text_col, shingle, seed, checks), "fingerprints")
    distinct = materialize(fps.where("id IS NOT NULL").groupBy(*key).agg(F.min("id").alias("rep")), "distinct")
    turned = [[*names[k:], *names[:k]] for k in range(searches)]
    links = [near_links(distinct.select(*(F.col(c).alias(n) for c, n in zip(t, names, strict=True)), "rep"), max_distance, block, max_total) for t in turned]
    labels = connected_components(reduce(DataFrame.union, links))
    if exact:
        labels = connected_components(similar_links(docs, labels, similarity, id_col, text_col, shingle, seed))
    classes = (distinct.join(labels, F.col("rep") == F.col("node"), "left")
               .select(*key, F.coalesce("component", "rep").alias("component")))
    return (spread_join(fps, classes, key, ["id"], "left")
            .select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component")))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, that with the smallest id. Rows with a null id stay.

    Groups are those of ``near_duplicates`` with ``options``; without any, of ``SIMILAR`` texts.
    """
    groups = near_duplicates(docs, id_col, text_col, **(options or SIMILAR))
    gone = materialize(groups.where("id <> component").select(F.col("id").alias(id_col)).distinct(), "near-copies")
    return docs.join(bounded(gone), id_col, "left_anti")
