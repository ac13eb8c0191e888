"""Equi-joins whose keys may be hot: one key may hold a third of all rows."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key that are never worth splitting.
LEAST = 64
#: Rows of two numbers that every executor can hold: some 16 MB.
FEW = 1 << 19


def spread_join(many: DataFrame, few: DataFrame, on: list[str], salt: list[str], how: str = "inner", counted: DataFrame | None = None) -> DataFrame:
    """``many`` joined with ``few`` on the columns ``on`` (``how``: inner or left), no key being one task's work.

    A key is hot if it holds over 1/K of the rows of ``many``, K being four times the number
    of shuffle partitions; so at most K keys are hot, and their list, which is broadcast, is
    bounded whatever the input. A hot key's rows are dealt by a hash of the columns ``salt``
    to as many pieces as it has K-ths, and its rows of ``few`` are copied to each piece.
    Rows of ``many`` with a null key meet nothing; in a left join they are dealt over K pieces.

    Keys are counted in ``counted``, a stage table that has the keys of ``many`` as often as it has
    itself; without one in ``many``, which should then be a stage table. The salt is a function of the row, so a
    task that runs again deals its rows alike. No rows on either side are fine.
    """
    spark = many.sparkSession
    pieces = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = many if counted is None else counted
    limit = max(LEAST, ceil(held.count() / pieces))
    hot = held.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    hot = hot.select(*on, F.ceil(F.col("__n") / limit).cast("int").alias("__k"))
    void = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in on))
    own = F.pmod(F.xxhash64(*salt), F.coalesce("__k", F.when(void, pieces).otherwise(1)).cast("long")).cast("int")
    dealt = many.join(F.broadcast(hot), on, "left").withColumn("__s", own).drop("__k")
    copies = few.join(F.broadcast(hot), on, "left").withColumn("__s", F.explode(F.sequence(F.lit(0), F.coalesce("__k", F.lit(1)) - 1))).drop("__k")
    return dealt.join(copies, [*on, "__s"], how).drop("__s")


def bounded(few: DataFrame, rows: int = FEW) -> DataFrame:
    """``few``, a stage table of few columns of fixed width, to be broadcast if it has at most ``rows`` rows; a larger one is joined by a shuffle."""
    return F.broadcast(few) if few.count() <= rows else few
