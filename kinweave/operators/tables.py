"""Table maintenance without a table format: merges as joins, history, versions, fingerprints."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` and the rows of ``source`` whose key it lacks, one for each key: of several the smallest by its other columns. Null keys equal each other."""
    rest = [c for c in target.columns if c not in keys]
    fresh = source.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__x")).select(*keys, *[F.col(f"__x.{c}").alias(c) for c in rest]) if rest else source.select(*keys).distinct()
    known = target.select(*[F.col(k).alias(f"__{k}") for k in keys])
    fresh = fresh.join(known, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def fill_missing(target: DataFrame, source: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Upsert that replaces a row only where its ``value`` is null."""
    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = source.withColumn("__s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    keep = F.col("t.__t").isNotNull() & (F.col(f"t.{value}").isNotNull() | F.col("s.__s").isNull())
    return t.join(s, on, "full").select(*[F.when(keep, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in target.columns])


def sync(target: DataFrame, source: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """Full synchronisation: ``source``'s rows with ``change`` INSERT, UPDATE or SAME, and the target's others as DELETE.

    Keys and columns compare null-safely; an unchanged row keeps the target's other values.
    """
    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = source.withColumn("__s", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "full")
    equal = F.lit(True)
    for c in compare:
        equal = equal & F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    change = F.when(F.col("t.__t").isNull(), "INSERT").when(F.col("s.__s").isNull(), "DELETE").when(equal, "SAME").otherwise("UPDATE")
    old = change.isin("SAME", "DELETE")
    return joined.select(*[F.when(old, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in target.columns], change.alias("change"))


def close_and_open(history: DataFrame, current: DataFrame, key: str, value: str, now: Column) -> DataFrame:
    """Slowly changing history ``(key, value, valid_from, valid_to)``: open rows that changed or vanished are closed, new values opened."""
    cur = current.select(F.col(key), F.col(value).alias("__v"))
    old = history.join(cur, key, "left")
    ends = F.col("valid_to").isNull() & ~F.col(value).eqNullSafe(F.col("__v"))
    closed = old.withColumn("valid_to", F.when(ends, now).otherwise(F.col("valid_to"))).drop("__v")
    live = closed.where("valid_to IS NULL").select(key)
    opened = current.join(live, key, "left_anti").select(key, value, now.alias("valid_from"), F.lit(None).cast(history.schema["valid_to"].dataType).alias("valid_to"))
    return closed.unionByName(opened)


def fingerprint(df: DataFrame, columns: list[str] | None = None, buckets: int = 256) -> str:
    """Hash of a table's content, whatever its order. Rows hash to ``buckets`` sums, so no task or driver holds the rows."""
    columns = columns or df.columns
    row = F.sha2(F.to_json(F.struct(*columns)), 256)
    part = lambda i: F.conv(F.substring("h", 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")
    sums = df.select(row.alias("h")).select(F.substring("h", 61, 2).alias("b"), *[part(i).alias(f"p{i}") for i in range(5)])
    rows = sums.groupBy("b").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"p{i}").alias(f"s{i}") for i in range(5)]).orderBy("b").collect()
    return hashlib.sha256(json.dumps([[r.b, r.n, *(str(r[f"s{i}"]) for i in range(5))] for r in rows]).encode()).hexdigest()


def path_exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """UPDATE: ``values`` in the rows that meet the condition; a null condition changes nothing."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()}).select(*df.columns)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE: the rows that do not meet the condition; a null condition keeps its row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


class Versions:
    """Immutable versions of tables as directories, with a manifest row each. One writer at a time.

    A version is written under a name of its own and then listed, so that a write which breaks off leaves nothing that a
    later one meets; only what the manifest lists exists.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _manifest(self):
        schema, path = "name string, version long, rows long, fingerprint string, path string", f"{self.root}/_manifest"
        return self.spark.read.schema(schema).json(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def history(self, name: str) -> DataFrame:
        return self._manifest().where(F.col("name") == name).orderBy("version")

    def exists(self, name: str) -> bool:
        return not self.history(name).isEmpty()

    def latest(self, name: str) -> int:
        """Newest version; -1 if there is none."""
        v = self.history(name).agg(F.max("version")).first()[0]
        return -1 if v is None else int(v)

    def write(self, name: str, df: DataFrame) -> int:
        version = self.latest(name) + 1
        path = f"{name}/v{version}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{path}")
        back = self.spark.read.schema(df.schema).parquet(f"{self.root}/{path}")
        self.spark.range(1).select(F.lit(name).alias("name"), F.lit(version).cast("long").alias("version"), F.lit(back.count()).cast("long").alias("rows"), F.lit(fingerprint(back)).alias("fingerprint"), F.lit(path).alias("path")).write.mode("append").json(f"{self.root}/_manifest")
        return version

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """Time travel; the newest by default. A version that was never written is an error."""
        found = self.history(name).where(F.col("version") == (self.latest(name) if version is None else version)).first()
        if found is None:
            raise ValueError(f"{name} has no version {version}")
        return self.spark.read.parquet(f"{self.root}/{found.path}")

    def publish(self, name: str, df: DataFrame, rows: int) -> int:
        """A version of exactly ``rows`` rows; another count is refused before anything is listed."""
        if (n := df.count()) != rows:
            raise ValueError(f"{name} has {n} rows, not the {rows} that are pinned")
        return self.write(name, df)

    def rewrite(self, name: str, change) -> int:
        """UPDATE and DELETE: the newest version as ``change`` (a function of a table) gives it, as the next one."""
        return self.write(name, change(self.read(name)))

    def freeze(self, name: str, df: DataFrame) -> int:
        """Write once: again with equal content is fine, with other content refused."""
        if not self.exists(name):
            return self.write(name, df)
        if self.history(name).first().fingerprint != fingerprint(df):
            raise ValueError(f"{name} is frozen with other content")
        return 0


def range_bucket_join(df: DataFrame, ranges: DataFrame, value: Column, lo: str, hi: str, width: int, on: list[str] | None = None, how: str = "inner") -> DataFrame:
    """Rows whose ``value`` lies in [lo, hi): an equi-join on buckets of ``width`` instead of a nested loop."""
    first, last = F.floor(F.col(lo) / width), F.floor((F.col(hi) - F.lit(1e-9)) / width)
    dealt = ranges.withColumn("__b", F.explode(F.sequence(first.cast("long"), F.greatest(first, last).cast("long"))))
    rows = df.withColumn("__v", value).withColumn("__b", F.floor(F.col("__v") / width).cast("long"))
    cond = (rows["__b"] == dealt["__b"]) & (rows["__v"] >= dealt[lo]) & (rows["__v"] < dealt[hi])
    for c in on or []:
        cond = cond & (rows[c] == dealt[c])
    out = rows.join(dealt, cond, how).drop(rows["__b"]).drop(dealt["__b"]).drop("__v")
    for c in on or []:
        out = out.drop(dealt[c])
    return out


def after(df: DataFrame, keys: list[str], cursor: tuple | None, page: int) -> DataFrame:
    """The next ``page`` rows in key order after a key tuple."""
    later = df if cursor is None else df.where(F.struct(*keys) > F.struct(*[F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in zip(keys, cursor, strict=True)]))
    return later.orderBy(*keys).limit(page)


def pages(df: DataFrame, keys: list[str], page: int, rows: int):
    """All rows, page by page, by cursor. Keys that do not strictly increase, and another number of rows than ``rows``, are errors."""
    cursor, seen = None, 0
    while held := after(df, keys, cursor, page).collect():
        for r in held:
            key = tuple(r[k] for k in keys)
            if None in key or (cursor is not None and key <= cursor):
                raise ValueError(f"key {key} does not follow {cursor}")
            cursor = key
        seen += len(held)
        yield held
    if seen != rows:
        raise ValueError(f"{seen} rows, {rows} declared")


def export_ordered(df: DataFrame, keys: list[str], path: str, rows: int, chunk: int = 100_000) -> DataFrame:
    """Export in key order as JSON chunks of at most ``chunk`` rows; ``(chunk, first_row, rows)`` of each.

    Rows are ranged by key over tasks, so that the files read in name order are the table in key order. Offsets and the number of
    rows are checked on what was written: repeated or null keys and another count than ``rows`` are errors.
    """
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    if not df.where(null).isEmpty():
        raise ValueError(f"a null among {keys}")
    assert_unique(df, keys)
    lines = df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    lines.write.option("maxRecordsPerFile", chunk).text(path)
    named = df.sparkSession.read.text(path).groupBy(F.input_file_name().alias("chunk")).agg(F.count(F.lit(1)).alias("rows"))
    files = sorted((r.chunk.rpartition("/")[2], r.rows) for r in named.collect())
    if (n := sum(x for _, x in files)) != rows:
        raise ValueError(f"{n} rows, {rows} declared")
    firsts = [sum(x for _, x in files[:i]) for i in range(len(files))]
    return df.sparkSession.createDataFrame([(c, f, x) for (c, x), f in zip(files, firsts, strict=True)], "chunk string, first_row long, rows long")


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    if not df.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"{keys} repeat")


def top_k(df: DataFrame, keys: list[str], order: list, k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key; the filter sits on the window, so that partial limits apply."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)
