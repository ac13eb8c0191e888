"""Removal of lines that many documents share.

Distinct line hashes are counted by a partial aggregation. Those that repeat go into
sharded minimal perfect hashes over compact fingerprint, count and largest-document
arrays, which documents probe: while all shards take at most ``INDEX_BYTES`` each task
has them at hand and rewrites its texts in one pass. A larger index is visited instead: the
hashes (24 bytes a line, never the lines) go to their shard and probe its arrays there; a shard
whose lines are found in very many documents is copied to several tasks, so that one
common line is not one task's work. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.llm.mphf import LineIndex
from kinweave.llm.tokens import TEXTS, each, lean
from kinweave.runtime import materialize

SPACE = b" \t\n\x0b\x0c\r"
#: Probing rows a shard, or a copy of a hot shard, is meant to get.
SHARD_ROWS = 1 << 15
#: Bytes of all shards up to which they are broadcast.
INDEX_BYTES = 64 << 20


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line stripped and with A-Z lower-cased; None if shorter than ``min_chars`` code points."""
    key = line.strip(SPACE)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key.lower()


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(id, h1, h2)``: the 128-bit hash of every different key of a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owners, sizes, digests = b.column(0).to_numpy(zero_copy_only=False), [], []
            for text in each(b.column(1).cast(pa.binary())):
                own = {xxhash.xxh3_128_digest(k) for line in (text or b"").split(b"\n") if (k := line_key(line, min_chars)) is not None}
                sizes.append(len(own))
                digests += own
            h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.record_batch([pa.array(np.repeat(owners, sizes).astype(np.int64)), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], ["id", "h1", "h2"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(lean(run), "id long, h1 long, h2 long")


def _build(group: pa.Table) -> pa.Table:
    index = LineIndex.build(*(np.ascontiguousarray(group.column(c).to_numpy()) for c in ("h1", "h2", "n", "largest")))
    return pa.table({"shard": group.column("shard").slice(0, 1), "copies": group.column("copies").slice(0, 1), "blob": pa.array([index.dumps()], pa.binary())})


def _probe(probes: pa.Table, shard: pa.Table) -> pa.Table:
    doc, h1, h2 = (np.ascontiguousarray(probes.column(c).to_numpy()) for c in ("id", "h1", "h2"))
    if not len(doc) or not shard.num_rows:
        doc, h1, h2 = (np.zeros(0, np.int64),) * 3
    else:
        counts, largest = LineIndex.loads(shard.column("blob")[0].as_py()).lookup(h1, h2)
        gone = (counts > 0) & (largest != doc)
        doc, h1, h2 = doc[gone], h1[gone], h2[gone]
    return pa.table({"id": doc, "h1": h1, "h2": h2})


def line_shards(probes: DataFrame, min_docs: int) -> tuple[DataFrame, int]:
    """``(shard, copies, blob)`` of the hashes that at least ``min_docs`` rows have, and the number of shards."""
    shards = max(1, -(-probes.count() // SHARD_ROWS))
    index = probes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("largest")).where(F.col("n") >= min_docs)
    index = materialize(index.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int")), "line-index")
    copies = index.groupBy("shard").agg(F.ceil(F.sum("n") / SHARD_ROWS).cast("int").alias("copies"))
    return materialize(index.join(copies, "shard").groupBy("shard").applyInArrow(_build, "shard int, copies int, blob binary"), "line-shards"), shards


def visit(probes: DataFrame, blobs: DataFrame, shards: int) -> DataFrame:
    """``(id, h1s, h2s)``: per document the hashes of the lines it loses, found at the shards."""
    spread = blobs.select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "blob")
    dealt = (probes.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int")).join(blobs.select("shard", "copies"), "shard")
             .withColumn("copy", F.pmod(F.xxhash64("id"), F.col("copies")).cast("int")).select("shard", "copy", "id", "h1", "h2"))
    lost = (dealt.groupBy("shard", "copy").cogroup(spread.groupBy("shard", "copy"))
            .applyInArrow(_probe, "id long, h1 long, h2 long"))
    return lost.groupBy("id").agg(F.collect_list("h1").alias("h1s"), F.collect_list("h2").alias("h2s"))


def at_hand(shared, shards: int):
    """Of a batch of texts, given their ids and the digests of their lines: the digests each loses, from broadcast shards."""
    indexes: dict[int, LineIndex] = {}

    def find(ids: pa.Array, digests: list[list[bytes | None]]) -> list[set[bytes]]:
        if not indexes:
            indexes.update((s, LineIndex.loads(blob)) for s, blob in shared.value)
        flat = [(i, d) for i, own in enumerate(digests) if ids[i].is_valid for d in set(own) if d is not None]
        out: list[set[bytes]] = [set() for _ in digests]
        if not flat:
            return out
        row = np.array([i for i, _ in flat])
        h = np.frombuffer(b"".join(d for _, d in flat), "<i8").reshape(-1, 2)
        doc, shard = ids.fill_null(0).to_numpy(zero_copy_only=False)[row], h[:, 0] % shards
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            if (index := indexes.get(int(shard[part[0]]))) is not None:
                counts, largest = index.lookup(h[part, 0].copy(), h[part, 1].copy())
                for k in part[(counts > 0) & (largest != doc[part])]:
                    out[flat[k][0]].add(flat[k][1])
        return out

    return find


def _listed(h1s: pa.Array, h2s: pa.Array) -> list[set[bytes]]:
    out = []
    for a, b in zip(h1s, h2s, strict=True):
        pairs = np.stack([a.values.to_numpy(), b.values.to_numpy()], axis=1).astype("<i8").tobytes() if a.is_valid else b""
        out.append({pairs[k : k + 16] for k in range(0, len(pairs), 16)})
    return out


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3,
                        index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``docs`` with shared lines removed, plus ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line stripped of ASCII whitespace with A-Z lower-cased. A key of at
    least ``min_chars`` code points that at least ``min_docs`` rows hold loses all its lines
    but those of the largest id holding it; the others stay, joined by a line feed.

    A null text stays null and an empty one empty; both count one line. Every row is a
    document, so repeated rows count each, and repeats of the largest id all keep the line.
    Rows with a null id are neither counted nor changed. Own columns named ``n_lines`` or
    ``n_dropped`` are replaced; all others pass through. No rows give no rows.
    """
    docs = docs.drop("n_lines", "n_dropped")
    names = docs.columns
    at = names.index(text_col)
    probes = materialize(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    blobs, shards = line_shards(probes, min_docs)
    held = blobs.agg(F.coalesce(F.sum(F.octet_length("blob")), F.lit(0))).first()[0]
    if held <= index_bytes:
        found = blobs.select("shard", "blob").toArrow()
        lookup = at_hand(docs.sparkSession.sparkContext.broadcast(list(zip(*(found.column(c).to_pylist() for c in ("shard", "blob")), strict=True))), shards)
        given = docs.select("*", F.col(id_col).cast("long").alias("__id"))
    else:
        lost = visit(probes, blobs, shards).select(F.col("id").alias("__id"), F.col("h1s").alias("__h1s"), F.col("h2s").alias("__h2s"))
        lookup = None
        given = docs.join(lost, F.col(id_col).cast("long") == F.col("__id"), "left").drop("__id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # all digests are looked up together, but texts are held and rewritten few at a time
            digests = [[None if (k := line_key(x, min_chars)) is None else xxhash.xxh3_128_digest(k) for x in (t or b"").split(b"\n")]
                       for t in each(b.column(at).cast(pa.binary()))]
            gone = lookup(b.column(len(names)), digests) if lookup else _listed(b.column(len(names)), b.column(len(names) + 1))
            for lo in range(0, max(1, b.num_rows), TEXTS):
                part = b.slice(lo, TEXTS)
                texts, own, lost = part.column(at).cast(pa.binary()).to_pylist(), digests[lo : lo + TEXTS], gone[lo : lo + TEXTS]
                n_dropped = [0] * len(texts)
                for i, lose in enumerate(lost):
                    if lose:
                        kept = [x for x, d in zip((texts[i] or b"").split(b"\n"), own[i], strict=True) if d is None or d not in lose]
                        n_dropped[i] = len(own[i]) - len(kept)
                        texts[i] = b"\n".join(kept)
                columns = [part.column(i) for i in range(len(names))]
                columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.record_batch([*columns, pa.array(map(len, own), pa.int64()), pa.array(n_dropped, pa.int64())], [*names, "n_lines", "n_dropped"])

    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return given.mapInArrow(lean(run), schema)
