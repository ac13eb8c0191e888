"""Deterministic synthetic populations: weighted picks, draws, drift and gates. All randomness is a hash of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.tables import range_bucket_join

WHEEL, STEP = 10_000_000, 100_000


def spin(seed: str, *keys: Column | str) -> Column:
    """A point of [0, WHEEL): the first 13 hex digits of a SHA-256, which any engine can repeat."""
    text = F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys])
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long"), F.lit(WHEEL))


def apportion(df: DataFrame, weight: str, order: str, total: int = WHEEL, group: list[str] | None = None) -> DataFrame:
    """``lo`` and ``hi`` that tile [0, total) in each group by largest remainder; ties go by ``order``."""
    g = [F.col(c) for c in group or []] or [F.lit(1)]
    share = F.col(weight) * total / F.sum(weight).over(Window.partitionBy(*g))
    parts = df.withColumn("__f", F.floor(share)).withColumn("__r", share - F.col("__f"))
    left = F.lit(total) - F.sum("__f").over(Window.partitionBy(*g))
    extra = F.row_number().over(Window.partitionBy(*g).orderBy(F.desc(F.round("__r", 9)), order)) <= left
    parts = parts.withColumn("__n", F.col("__f") + extra.cast("int"))
    hi = F.sum("__n").over(Window.partitionBy(*g).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return parts.withColumn("hi", hi.cast("long")).withColumn("lo", (F.col("hi") - F.col("__n")).cast("long")).drop("__f", "__r", "__n")


def weighted_pick(df: DataFrame, wheel: DataFrame, seed: str, keys: list[str], on: list[str] | None = None) -> DataFrame:
    """Each row with the wheel's row whose [lo, hi) its spin falls in: an equi-join on buckets."""
    return range_bucket_join(df, wheel, spin(seed, *keys), "lo", "hi", STEP, on)


def sample_without_replacement(options: Column, seed: str, key: Column, k: int) -> Column:
    """``k`` names out of array<struct<name,weight>>, likelier by weight: the smallest exponential draws."""
    draw = lambda o: -F.ln((spin(seed, key, o["name"]) + 0.5) / float(WHEEL)) / o["weight"]
    return F.transform(F.slice(F.array_sort(F.transform(options, lambda o: F.struct(draw(o).alias("d"), o["name"].alias("name")))), 1, k), lambda x: x["name"])


def heavy_tail(u: Column, low: int, high: int, exponent: float) -> Column:
    """A whole number of [low, high] from u in [0, 1), small ones likelier."""
    return (F.lit(low) + F.floor(F.pow(u, F.lit(exponent)) * (high - low + 1))).cast("long")


def permuted(i: Column, factor: int = 386093, shift: int = 104729, modulus: int = 1_000_000) -> Column:
    """An affine permutation of [0, modulus)."""
    return F.pmod(i * factor + shift, F.lit(modulus))


def unique_emails(people: DataFrame, key: str, local: str, domain: str, second: str | None = None, fallback: str | None = None, seed: str = "") -> DataFrame:
    """``email`` and ``bumped`` (whether the first choice was taken).

    Four choices in turn: ``local``; ``second``; ``fallback`` with a number of three digits by hash; ``fallback`` without
    dots and with the key; where even that is taken, a plus goes before the key (local parts have none). Of those who choose the same, whoever had it before keeps it, else the smallest key; the others go on.
    ``second`` defaults to the local part with two digits by hash, ``fallback`` to the local part.
    """
    spun = lambda name, n: spin(seed, F.lit(name), key) % n
    base = F.col(fallback) if fallback else F.col(local)
    choices = [
        F.col(second) if second else F.concat(F.col(local), (10 + spun("second", 90)).cast("string")),
        F.concat(base, (100 + spun("tail", 900)).cast("string")), F.concat(F.replace(base, F.lit("."), F.lit("")), F.col(key).cast("string")),
        F.concat(F.replace(base, F.lit("."), F.lit("")), F.lit("+"), F.col(key).cast("string"))]
    at = lambda c: F.concat(c, F.lit("@"), F.col(domain))
    out = people.withColumn("email", at(F.col(local))).withColumn("__held", F.lit(0))
    for i, choice in enumerate(choices):
        first = F.row_number().over(Window.partitionBy("email").orderBy(F.desc("__held"), key)) == 1
        out = out.withColumn("__first", first).withColumn("email", F.when(F.col("__first"), F.col("email")).otherwise(at(choice))).withColumn("__held", F.col("__first").cast("int"))
        if i == 0:
            out = out.withColumn("bumped", ~F.col("__first"))
    return out.drop("__first", "__held")


def as_of(at: Column, changed_at: Column, before: Column, after: Column) -> Column:
    """The value that held at a time, given when it changed (null: never)."""
    return F.when(changed_at.isNotNull() & (at < changed_at), before).otherwise(after)


def slots(df: DataFrame, count: str, name: str = "slot") -> DataFrame:
    """A row for each of ``count`` slots."""
    return df.where(F.col(count) > 0).withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count).cast("long"))))


def slip(c: Column, kind: Column, at: Column) -> Column:
    """A slip of the keyboard: 0 none, 1 a letter dropped, 2 doubled, 3 two swapped, 4 case turned."""
    head, x, y, tail = F.substr(c, F.lit(1), at - 1), F.substr(c, at, F.lit(1)), F.substr(c, at + 1, F.lit(1)), F.substr(c, at + 2, F.length(c))
    return (F.when(kind == 1, F.concat(head, y, tail)).when(kind == 2, F.concat(head, x, x, y, tail))
            .when(kind == 3, F.concat(head, y, x, tail)).when(kind == 4, F.upper(c)).otherwise(c))


def owner_key(n: Column, owners: int) -> Column:
    """Position of the owning row of an activity fact."""
    return spin("owner", n) % owners


def split_of(key: Column) -> Column:
    """development (70 %), standard_holdout (20 %) or challenge_holdout (10 %) by person."""
    p = F.pmod(F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("long"), F.lit(100))
    return F.when(p < 70, "development").when(p < 90, "standard_holdout").otherwise("challenge_holdout")


def gate(df: DataFrame, bands: dict[str, tuple[Column, float, float]]) -> DataFrame:
    """``(gate, value, lo, hi, passed)``: one aggregation for all bands."""
    row = df.agg(*[v.cast("double").alias(k) for k, (v, _, _) in bands.items()])
    parts = F.array(*[F.struct(F.lit(k).alias("gate"), F.round(F.col(k), 6).alias("value"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"), F.col(k).between(lo, hi).alias("passed")) for k, (_, lo, hi) in bands.items()])
    return row.select(F.inline(parts))


def require(gates: DataFrame) -> DataFrame:
    """Fails, when it runs, at a gate that didn't pass."""
    return gates.withColumn("ok", F.assert_true(F.col("passed"), F.concat(F.lit("gate failed: "), F.col("gate"))))
