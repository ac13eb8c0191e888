"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame operations only.

The mix is a sequence of equal-token slots. Slot k's golden-ratio point, read through the
cumulative weights, names its source; slots are ranked per source. Each source's documents
are put in hashed order and cut into blocks of equal tokens, repeated at most
``max_repeat`` times; the block of rank r fills the source's slot of rank r. The schedule
comes within a few slots of a target: slots a source lacks follow at its end, those it has
too many stay empty, and the last is cut to the words still owed.

Sources are a table, however many there are. Ranks, token positions, cumulative weights and
the search of a point among them are running sums and maxima of several levels, so that
neither a source nor the list of sources is one task's work.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.skew import spread_join
from kinweave.runtime import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a slot and of a block.
BLOCK = 4096
#: Points are golden-ratio multiples as 60-bit fractions: two limbs of 30 bits, exact for up to 2**32 slots.
POINT_BITS, LIMB = 60, 1 << 30
GOLDEN_HIGH, GOLDEN_LOW = 663608942, 401909697
#: Bits of the hash that orders documents.
HASH_BITS = 60
#: Rows that a running sum takes at once, as a power of two.
RUN_BITS = 9


def running(df: DataFrame, group: list[str], run: str, order: list[str | Column], value: str, out: str, bits: int, total=F.sum) -> DataFrame:
    """``out``: ``total`` (F.sum or F.max) of ``value`` over earlier rows of ``group``, by ``run`` (below 2 ** ``bits``) and then ``order``; null before any.

    A run's rows are one window's; what the runs before it add is a running total of the runs,
    taken the same way over runs of 2 ** ``RUN_BITS`` runs, and so on.
    """
    own = Window.partitionBy(*group, run).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("__p", total(value).over(own))
    if bits <= 0:
        return local.withColumn(out, F.col("__p")).drop("__p")
    up = f"__{run}"
    totals = df.groupBy(*group, run).agg(total(value).alias("__t")).withColumn(up, F.shiftright(run, RUN_BITS))
    above = running(totals, group, up, [run], "__t", "__o", bits - RUN_BITS, total)
    above = above.select(*(F.col(c).alias(f"{c}__") for c in [*group, run]), "__o")
    both = F.coalesce(F.col("__p") + F.col("__o"), "__p", "__o") if total is F.sum else F.greatest("__p", "__o")
    return local.join(above, [F.col(c).eqNullSafe(F.col(f"{c}__")) for c in [*group, run]]).select(*df.columns, both.alias(out))


def run_bits(rows: int) -> int:
    """Bits of a run number that parts ``rows`` rows into runs of about 2 ** ``RUN_BITS``."""
    return max(0, ceil(log2(max(1, rows))) - RUN_BITS)


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), share: float = 1.0, max_repeat: int = 3) -> DataFrame:
    """``(source, src, words, weight, target)`` of sources ``(source, words)``, one row each.

    Sources by code point, null last, are numbered and take ``weights`` in turn; they split ``share`` of all
    words. What a source could give only by repeating more than ``max_repeat`` times is shared again among the others
    by weight until none is above: with the sources by what they can give a weight, those are cut whose bound lies
    below the level that is left for them and all after them.
    """
    dealt = materialize(sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    n, words = dealt.agg(F.count(F.lit(1)), F.coalesce(F.sum("words"), F.lit(0))).first()
    parts = dealt.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0] + 1
    one = dealt.withColumn("one", F.lit(1).cast("long"))
    numbered = running(one, [], "part", [F.col("source").asc_nulls_last()], "one", "src", ceil(log2(parts)) if parts > 1 else 0)
    numbered = numbered.withColumn("src", F.coalesce("src", F.lit(0)).cast("long"))
    turn = F.array(*(F.lit(float(w)) for w in weights))
    weighed = numbered.withColumn("weight", F.element_at(turn, (F.col("src") % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("bound", F.col("words") * float(max_repeat)).withColumn("level", F.col("bound") / F.col("weight"))
    ranged = materialize(weighed.drop("part", "one").repartitionByRange("level", "src").withColumn("part", F.spark_partition_id()), "levels")
    whole = ranged.agg(F.coalesce(F.sum("weight"), F.lit(0.0))).first()[0]
    parts = ranged.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0] + 1
    bits = ceil(log2(parts)) if parts > 1 else 0
    before = running(ranged, [], "part", ["level", "src"], "bound", "bounds", bits)
    before = running(before, [], "part", ["level", "src"], "weight", "weights", bits)
    left = F.lit(share * words) - F.coalesce("bounds", F.lit(0.0))
    cut = F.col("level") < left / (F.lit(whole) - F.coalesce("weights", F.lit(0.0)))
    told = materialize(before.withColumn("cut", cut).select("source", "src", "words", "weight", "bound", "cut"), "cut-sources")
    gone = told.where("cut").agg(F.coalesce(F.sum("bound"), F.lit(0.0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    level = max(0.0, share * words - gone[0]) / (whole - gone[1]) if whole > gone[1] else 0.0
    # the level that is left never exceeds a bound that is not cut, but for rounding
    return told.select("source", "src", "words", "weight", F.when(F.col("cut"), F.col("bound")).otherwise(F.least("bound", F.lit(level) * F.col("weight"))).alias("target"))


def point(slot: str) -> Column:
    """The golden-ratio point of a slot, as a fraction of 2 ** ``POINT_BITS``."""
    k = F.col(slot) + 1
    return F.pmod(F.pmod(k * F.lit(GOLDEN_HIGH), F.lit(LIMB)) * LIMB + k * F.lit(GOLDEN_LOW), F.lit(1 << POINT_BITS))


def schedule(sources: DataFrame, slots: int) -> DataFrame:
    """``(slot, src, rank)``: the source of every slot and the slot's rank in it. ``sources`` is ``(src, target)``, ``src`` from 0 up."""
    n, whole = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    sources = sources.withColumn("run", F.shiftright("src", RUN_BITS))
    edges = running(sources, [], "run", ["src"], "target", "from", run_bits(n))
    edges = edges.select(F.least(F.floor(F.coalesce("from", F.lit(0.0)) / F.lit(whole or 1.0) * float(1 << POINT_BITS)), F.lit(1 << POINT_BITS)).alias("at"), F.lit(None).cast("long").alias("slot"), "src")
    points = sources.sparkSession.range(slots).select(point("id").alias("at"), F.col("id").alias("slot"), F.lit(None).cast("long").alias("src"))
    # the last source that begins at or before a point has it; sources without a share begin where the next one does
    bits = run_bits(slots)
    lined = edges.union(points).withColumn("run", F.shiftright("at", POINT_BITS - bits)).where(F.col("at") < 1 << POINT_BITS)
    found = running(lined, [], "run", ["at", F.col("slot").asc_nulls_first(), "src"], "src", "owner", bits, F.max).where("slot IS NOT NULL")
    named = materialize(found.select("slot", F.col("owner").alias("src"), F.shiftright("slot", RUN_BITS).alias("run"), F.lit(1).cast("long").alias("one")), "points")
    ranked = running(named, ["src"], "run", ["slot"], "one", "rank", bits)
    return ranked.select("slot", "src", F.coalesce("rank", F.lit(0)).cast("long").alias("rank"))


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, share: float, max_repeat: int, seed: int) -> tuple[DataFrame, int]:
    """Rows of ``docs`` with their source's numbers and the position of their first word among the source's, and the slots of the schedule."""
    sized = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("words"))
    sources = materialize(targets(totals, weights, share, max_repeat), "targets")
    rows = sized.count()
    whole = sources.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    few = sources.select(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("void"), "src", F.col("words").alias("source_size"), "target")
    named = sized.withColumn("s", F.coalesce("source", F.lit(""))).withColumn("void", F.col("source").isNull())
    # 60 bits of a SHA-256, which SQL can repeat
    h = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string")), 256), 1, HASH_BITS // 4), 16, 10).cast("long")
    bits = min(HASH_BITS, run_bits(rows))
    keyed = spread_join(named.withColumn("h", h), few, ["s", "void"], ["h"]).drop("s", "void")
    keyed = keyed.withColumn("run", F.shiftright("h", HASH_BITS - bits) if bits else F.lit(0).cast("long"))
    tie = ["h", "doc_id", "size"]
    placed = running(keyed, ["src"], "run", tie, "size", "start", bits).withColumn("start", F.coalesce("start", F.lit(0)))
    placed = placed.withColumn("rn", F.row_number().over(Window.partitionBy("src", "run").orderBy(*tie, "start")))
    return materialize(placed, "placed"), ceil(whole / BLOCK)


def _blocks(placed: DataFrame, slots: int, max_repeat: int) -> DataFrame:
    """``placed`` rows with a slot they fill in part, and that part in words."""
    sources = placed.groupBy("src").agg(F.first("target").alias("target"))
    sources = materialize(sources.withColumn("owed", F.rint("target").cast("long")), "shares")
    timed = schedule(sources.select("src", "target"), slots)
    timed = materialize(timed, "slots")
    wide = timed.groupBy("src").agg(F.count(F.lit(1)).alias("wide"))
    needs = sources.join(wide, "src", "left").select("src", F.coalesce("wide", F.lit(0)).alias("lo"), F.ceil(F.col("owed") / BLOCK).alias("hi"))
    lacking = needs.where("lo < hi").select("src", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("rank"))
    every = timed.select("src", "rank", "slot").union(lacking.select("src", "rank", (F.col("rank") + slots).alias("slot")))
    copies = placed.withColumn("owed", F.rint("target").cast("long")).where("size > 0")
    copies = copies.withColumn("start", F.explode(F.array(*[F.col("start") + e * F.col("source_size") for e in range(max_repeat)]))).where("start < owed")
    end = F.least(F.col("start") + F.col("size"), F.col("owed"))
    pieces = copies.withColumn("end", end).withColumn("rank", F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("end") - 1) / BLOCK))))
    low, high = F.greatest("start", F.col("rank") * BLOCK), F.least("end", (F.col("rank") + 1) * BLOCK)
    pieces = pieces.withColumn("first_word", low - F.col("start")).withColumn("part", high - low)
    return pieces.join(every, ["src", "rank"])


def mixture_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   weights: tuple[float, ...] = (1, 2, 3), share: float = 1.0, max_repeat: int = 3, seed: int = 7) -> DataFrame:
    """The mix itself: ``(slot, source, doc_id, first_word, words)``, to be read by slot, source and rank of the words.

    A row is a stretch of a document's words, from ``first_word``, that its source gives to the slot. Slots are ``BLOCK``
    words, a source's last one less. Slots beyond the schedule's are those that a source lacked. Rows without words give none.
    Edge cases are those of ``mix``.
    """
    placed, slots = _placed(docs, id_col, text_col, source_col, weights, share, max_repeat, seed)
    return _blocks(placed, slots, max_repeat).select("slot", "source", "doc_id", "first_word", F.col("part").alias("words"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (1, 2, 3), share: float = 1.0, max_repeat: int = 3, seed: int = 7) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` for every row.

    ``size`` counts words (0 for a null or blank text), ``target`` is the source's share in
    words, ``taken`` the words of the row in ``mixture_blocks``, repeats counted; at most
    ``max_repeat * size``. The words taken of a source are its target, rounded, whatever the
    input's size. Rows of no words take 0. A null source is a source. Repeated rows
    are documents of their own. Reruns agree: the order is a hash of the id. Other columns
    are not read. No rows give no rows.
    """
    placed, slots = _placed(docs, id_col, text_col, source_col, weights, share, max_repeat, seed)
    key = ["src", "run", "rn", "doc_id", "source", "size", "source_size", "target"]
    filled = _blocks(placed, slots, max_repeat).select(*key, "part")
    every = filled.unionByName(placed.select(*key, F.lit(0).cast("long").alias("part")))
    return every.groupBy(*key).agg(F.sum("part").alias("taken")).select("doc_id", "source", "size", "source_size", "target", "taken")
