"""Candidate pairs by bounded blocking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.skew import FEW, spread_join
from kinweave.runtime import materialize

# The largest block that makes pairs, and the nine keys.
MAX_BLOCK = 50


def keys() -> dict[str, F.Column]:
    both = lambda *c: F.when(sum((F.col(x).isNull().cast("int") for x in c), F.lit(0)) == 0, F.lit(True))
    return {
        "PERSONAL_EMAIL": F.col("email_n"), "PERSONAL_PHONE": F.col("phone_n"), "WORK_EMAIL": F.col("work_email_n"), "WORK_PHONE": F.col("work_phone_n"),
        "HOME_ADDRESS": F.col("home_address_n"), "WORK_ADDRESS": F.col("work_address_n"),
        "FAMILY_DOB": F.when(both("family_name_n", "dob_usable"), F.concat_ws("|", "family_name_n", F.col("dob_usable").cast("string"))),
        "FAMILY_INITIAL_POSTCODE": F.when(both("family_name_n", "given_name_n", "postcode_n"), F.concat_ws("|", "family_name_n", F.substring("given_name_n", 1, 1), "postcode_n")),
        "PHONE_SUFFIX": F.right("phone_n", F.lit(6)),
    }
# End of fixed values.


def _sized(rows: DataFrame, name: str) -> DataFrame:
    """With the size of each row's block, by one aggregation over a stage table of the rows (no window holds a block, and
    a large block's rows are dealt over tasks)."""
    rows = materialize(rows, "blocks")
    sizes = rows.groupBy("reason", "block").agg(F.count(F.lit(1)).alias(name))
    return spread_join(rows, sizes, ["reason", "block"], ["record_key"])


def blocking_keys(base: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    """``(record_key, source_system, reason, block, original_block_size, block_size)``.

    One scan makes all keys. A block above ``max_block`` is parted by family name, and what is still
    above by initial; rows without that part drop out of the block.
    """
    entries = base.select(
        "record_key", "source_system", "family_name_n", F.substring("given_name_n", 1, 1).alias("initial"),
        F.explode(F.array(*[F.struct(F.lit(r).alias("reason"), c.alias("block")) for r, c in keys().items()])).alias("k"),
    ).select("record_key", "source_system", "family_name_n", "initial", "k.reason", "k.block").where("block IS NOT NULL")
    part = lambda size, by: F.when(F.col(size) <= max_block, F.col("block")).when(F.col(by).isNotNull(), F.concat("block", F.lit("#"), F.col(by)))
    first = materialize(_sized(entries, "original_block_size"), "sized-blocks")
    # what is within the bound stays as it is; a name with the mark in it might be met by a parted block, and goes along
    plain = (F.col("original_block_size") <= max_block) & ~F.contains("block", F.lit("#"))
    parted = first.where(~plain).withColumn("block", part("original_block_size", "family_name_n")).where("block IS NOT NULL")
    second = _sized(parted, "refined").withColumn("block", part("refined", "initial")).where("block IS NOT NULL")
    columns = ["record_key", "source_system", "reason", "block", "original_block_size", "block_size"]
    return first.where(plain).withColumn("block_size", F.col("original_block_size")).select(*columns).union(_sized(second.drop("refined", "family_name_n", "initial"), "block_size").select(*columns))


def candidate_hits(blocks: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    """Distinct ``(left_record_key, right_record_key, reason, route, scope)``; blocks are at most ``max_block`` rows."""
    live = materialize(blocks.where(F.col("block_size").between(2, max_block)).select("reason", "block", "record_key", "source_system"), "live-blocks")
    a, b = live.alias("a"), live.alias("b")
    hits = a.join(b, (F.col("a.reason") == F.col("b.reason")) & (F.col("a.block") == F.col("b.block")) & (F.col("a.record_key") < F.col("b.record_key")))
    scope = F.when(F.col("a.source_system") == F.col("b.source_system"), "WITHIN_SOURCE").otherwise("CROSS_SOURCE")
    return hits.select(F.col("a.record_key").alias("left_record_key"), F.col("b.record_key").alias("right_record_key"), F.col("a.reason").alias("reason"), F.lit("DETERMINISTIC").alias("route"), scope.alias("scope")).distinct()


def candidate_pairs(hits: DataFrame, ann: DataFrame | None = None) -> DataFrame:
    """One row per canonical pair with the sorted sets of reasons, routes and scopes."""
    both = hits if ann is None else hits.unionByName(ann.select(
        "left_record_key", "right_record_key", F.concat(F.lit("ANN_"), F.upper("representation")).alias("reason"), F.lit("ANN").alias("route"), "scope"))
    sets = [F.array_sort(F.collect_set(c)).alias(f"candidate_{c}s") for c in ("reason", "route", "scope")]
    return both.groupBy("left_record_key", "right_record_key").agg(*sets)


def live_keys(base: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    """``base``, a stage table, with a column ``key_<i>`` for each of the ``keys()``: the record's final block under it, null if
    that is beyond ``max_block``. The same blocks as ``blocking_keys``, of which only the few that are too large are listed.
    """
    reasons, out = list(keys()), base.withColumns({f"key_{i}": k for i, k in enumerate(keys().values())})
    for part in ("family_name_n", "substring(given_name_n, 1, 1)", None):
        entries = out.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"key_{i}").alias("block")) for i in range(len(reasons))]))).where("block IS NOT NULL")
        if part != "family_name_n":  # only what was parted, or has the mark in it, can have another size now
            entries = entries.where(F.contains("block", F.lit("#")))
        large = materialize(entries.groupBy("i", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_block).select("i", "block"), "large-blocks")
        for i, n in large.groupBy("i").count().sort("i").collect():
            name = f"key_{i}"
            side = large.where(F.col("i") == i).select(F.col("block").alias(name), F.lit(True).alias("__large"))
            out = out.join(F.broadcast(side), name, "left") if n <= FEW else spread_join(materialize(out, "parted"), side, [name], ["record_key"], "left")
            parted = F.concat(name, F.lit("#"), F.expr(part)) if part else F.lit(None).cast("string")
            out = out.withColumn(name, F.when(F.col("__large"), parted).otherwise(F.col(name))).drop("__large")
    return out


def are_unique(records: DataFrame) -> bool:
    """Whether no two rows have the same ``record_key``; hashes are compared first, which are shorter."""
    twice = records.groupBy(F.xxhash64("record_key").alias("h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    if materialize(twice, "twice").isEmpty():
        return True
    return records.select("record_key", F.xxhash64("record_key").alias("h")).join(twice, "h").groupBy("record_key").count().where("count > 1").isEmpty()


def met_pairs(base: DataFrame, carried: list[str] | None = None, max_block: int = MAX_BLOCK) -> DataFrame:
    """``candidate_pairs`` of the blocks of ``base``, a stage table, with the columns ``carried`` of both records as ``<column>_l`` and ``<column>_r``.

    A record goes once to each of its blocks, with all its blocks and what is carried, so that a pair knows where it meets
    what else it has in common: it is kept in the first block that it shares, and neither pairs nor what they carry are shuffled.
    Records must differ in ``record_key``, or pairs are gathered by ``candidate_pairs`` and joined with the records.
    """
    return met_parts(base, carried, max_block, 1)[0]


def met_parts(base: DataFrame, carried: list[str] | None = None, max_block: int = MAX_BLOCK, parts: int | None = None) -> list[DataFrame]:
    """``met_pairs`` in parts that have no pair in common: by the key of the first block that a pair shares, or by ``parts`` groups of such keys.

    Only the entries of its keys are shuffled for a part, so that parts written one after another need a part's share of the disk.
    """
    carried = list(carried or [])
    if not are_unique(base):
        out = candidate_pairs(candidate_hits(blocking_keys(base, max_block), max_block))
        for side, key in (("l", "left_record_key"), ("r", "right_record_key")) if carried else ():  # else a row a pair, however many records have its keys
            out = out.join(base.select(F.col("record_key").alias(key), *[F.col(c).alias(f"{c}_{side}") for c in carried]), key)
        return [out]
    reasons = list(keys())
    live = live_keys(base, max_block)
    held = F.struct(*dict.fromkeys(["record_key", "source_system", *carried]), *[f"key_{i}" for i in range(len(reasons))]).alias("b")
    step = -(-len(reasons) // (parts or len(reasons)))
    return [_met(live, held, range(at, min(at + step, len(reasons))), reasons, carried) for at in range(0, len(reasons), step)]


def _met(live: DataFrame, held: F.Column, of: range, reasons: list[str], carried: list[str]) -> DataFrame:
    """The pairs whose first common block is one of the keys ``of``."""
    entries = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"key_{i}").alias("block")) for i in of]))
    rows = live.select(held, entries).where("block IS NOT NULL")
    # a block is at most max_block rows, so these lists are short
    before = Window.partitionBy("i", "block").orderBy("b.record_key").rowsBetween(Window.unboundedPreceding, -1)
    met = rows.select("i", "b", F.collect_list("b").over(before).alias("as")).select("i", "b", F.explode("as").alias("a"))
    common = [F.coalesce(F.col(f"a.key_{i}") == F.col(f"b.key_{i}"), F.lit(False)) for i in range(len(reasons))]
    first = F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(common)])
    scope = F.when(F.col("a.source_system") == F.col("b.source_system"), "WITHIN_SOURCE").otherwise("CROSS_SOURCE")
    shared = F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in zip(common, reasons, strict=True)])))
    return met.where(F.col("i") == first).select(
        F.col("a.record_key").alias("left_record_key"), F.col("b.record_key").alias("right_record_key"), shared.alias("candidate_reasons"),
        F.array(F.lit("DETERMINISTIC")).alias("candidate_routes"), F.array(scope).alias("candidate_scopes"),
        *[F.col(f"{x}.{c}").alias(f"{c}_{s}") for x, s in (("a", "l"), ("b", "r")) for c in carried])
