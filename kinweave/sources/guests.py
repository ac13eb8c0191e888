"""The 22-column guest contract, and a deterministic guest table drawn from the TPC-H-like tables.

A customer is a person, each order a record of one of six systems, with nicknames, dropped letters,
shared phones, role mailboxes and placeholder birth dates by arithmetic on the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The source contract and its systems.
COLUMNS = (
    "source_system", "source_record_id", "given_name", "family_name", "full_name", "personal_email", "work_email", "personal_phone", "work_phone",
    "date_of_birth", "home_address_line1", "home_suburb", "home_state", "home_postcode", "home_country", "work_address_line1", "work_suburb",
    "work_state", "work_postcode", "work_country", "company_name", "source_updated_at")
SYSTEMS = ("sevenrooms", "me_and_u", "moshtix", "momentus", "pos", "payments")
TRUTH_WORDS = ("truth", "person_index", "expected", "scenario", "cohort", "household_index", "evaluation_split")
# End of fixed values.
SCHEMA = T.StructType([
    T.StructField(c, T.DateType() if c == "date_of_birth" else T.TimestampType() if c == "source_updated_at" else T.StringType(), c not in COLUMNS[:2]) for c in COLUMNS])

GIVEN = ("William", "Margaret", "Robert", "Elizabeth", "Thomas", "Katherine", "James", "Priya", "Mei", "Omar", "Samuel", "Alexandra", "Ines", "Yuki", "Charles", "Lena")
SHORT = ("Bill", "Maggie", "Bob", "Liz", "Tom", "Kate", "Jim", "Priya", "Mei", "Omar", "Sam", "Alex", "Ines", "Yuki", "Charlie", "Lena")
FAMILY = ("Walker", "Nguyen", "Okafor", "Singh", "Rossi", "Martin", "Kowalski", "Haddad", "Silva", "Tanaka", "Brown", "Fischer", "Dubois", "Costa", "Novak", "Larsen", "Murphy", "Chen", "Ivanov", "Reyes", "Moore")
STREETS = ("Harbour Street", "Mill Road", "Station Avenue", "Park Lane", "Ocean Drive", "King Court", "High Street")


def _pick(values: tuple[str, ...], index: str) -> str:
    return "CASE " + index + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def guest_sql(string: str = "STRING") -> str:
    """The guest table in SQL that Spark and DuckDB read alike; ``string`` is the engine's name of the type."""
    s = lambda x: f"CAST({x} AS {string})"
    return f"""
    SELECT {_pick(SYSTEMS, 'ok % 6')} AS source_system, concat('R', {s('ok')}) AS source_record_id,
      given AS given_name, family AS family_name, concat(given, ' ', family) AS full_name,
      CASE WHEN ok % 7 = 0 THEN NULL WHEN ok % 50 = 3 THEN 'bookings@venue.example'
           WHEN ok % 61 = 5 THEN 'noreply@mail.example'
           WHEN ck % 5 = 0 AND ok % 3 = 0 THEN concat(lower(g0), '.', lower(f0), {s('ck')}, '+dine@gmail.com')
           WHEN ck % 5 = 0 THEN concat(lower(g0), lower(f0), {s('ck')}, '@googlemail.com')
           ELSE concat(upper(g0), '.', lower(f0), {s('ck')}, '@mail', {s('ck % 4')}, '.example') END AS personal_email,
      CASE WHEN ck % 3 = 0 THEN concat('desk', {s('ck % 40')}, '@office', {s('ck % 20')}, '.example') END AS work_email,
      CASE WHEN ok % 5 = 0 THEN NULL
           WHEN ok % 9 = 4 THEN concat('04', lpad({s('(CAST(floor(ck / 2) AS BIGINT) * 386093 + 104729) % 100000000')}, 8, '0'))
           WHEN ok % 3 = 1 THEN concat('+61 4', lpad({s('(ck * 386093 + 7) % 100000000')}, 8, '0'))
           ELSE concat('(04) ', lpad({s('(ck * 386093 + 7) % 100000000')}, 8, '0')) END AS personal_phone,
      CASE WHEN ck % 3 = 0 THEN concat('02 9', lpad({s('ck % 40')}, 7, '0')) END AS work_phone,
      CASE WHEN ok % 4 = 3 THEN NULL WHEN ok % 6 = 2 AND ok % 5 = 2 THEN DATE '1957-05-01' WHEN ok % 41 = 7 THEN DATE '1950-01-01' + CAST((ok * 31) % 15000 AS INT)
           ELSE DATE '1950-01-01' + CAST((ck * 397) % 15000 AS INT) END AS date_of_birth,
      CASE WHEN ok % 8 = 6 THEN NULL ELSE concat({s('1 + ck % 200')}, ' ', {_pick(STREETS, 'ck % 7')}) END AS home_address_line1,
      country AS home_suburb, 'NSW' AS home_state, CASE WHEN ok % 10 = 9 THEN NULL ELSE lpad({s('2000 + ck % 500')}, 4, '0') END AS home_postcode, 'Australia' AS home_country,
      CASE WHEN ck % 3 = 0 THEN concat({s('1 + ck % 20')}, ' Market Street') END AS work_address_line1,
      CASE WHEN ck % 3 = 0 THEN 'Sydney' END AS work_suburb, CASE WHEN ck % 3 = 0 THEN 'NSW' END AS work_state, CASE WHEN ck % 3 = 0 THEN '2000' END AS work_postcode,
      CASE WHEN ck % 3 = 0 THEN 'Australia' END AS work_country, CASE WHEN ck % 3 = 0 THEN concat('Office ', {s('ck % 20')}) END AS company_name,
      CAST(upd AS TIMESTAMP) AS source_updated_at, ck AS person
    FROM (SELECT ok, ck, upd, country, g0, f0,
            CASE WHEN ok % 11 = 1 THEN concat(substring(g0, 1, 1), substring(g0, 3)) WHEN ok % 11 = 2 THEN gs WHEN ok % 11 = 3 THEN substring(g0, 1, 1) ELSE g0 END AS given,
            CASE WHEN ok % 13 = 1 THEN upper(f0) WHEN ok % 13 = 2 THEN concat(substring(f0, 1, 2), substring(f0, 4)) WHEN ok % 13 = 3 THEN concat(f0, ' Jones') ELSE f0 END AS family
          FROM (SELECT o.o_orderkey AS ok, o.o_custkey AS ck, o.o_orderdate AS upd, n.n_name AS country, {_pick(GIVEN, 'o.o_custkey % 16')} AS g0, {_pick(SHORT, 'o.o_custkey % 16')} AS gs,
                  {_pick(FAMILY, 'CAST(floor(o.o_custkey / 16) AS BIGINT) % 21')} AS f0
                FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey) base) guest"""


def guest_records(spark: SparkSession, sf_dir: str, truth: bool = False) -> DataFrame:
    """The 22 columns of the contract; with ``truth`` also ``person``, which no operator reads.

    Orders in fewer files than there are cores are dealt out, or some would stay idle: their three columns, before a guest is made of them.
    """
    cores = spark.sparkContext.defaultParallelism
    for name in ("orders", "customer", "nation"):
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name == "orders" and len(table.inputFiles()) < cores:
            table = table.select("o_orderkey", "o_custkey", "o_orderdate").repartition(cores, "o_orderkey")
        table.createOrReplaceTempView(name)
    df = spark.sql(guest_sql())
    return df if truth else df.select(*COLUMNS)


def truth_like(columns: list[str]) -> list[str]:
    """Columns that look like answers and must not reach the resolver."""
    return [c for c in columns if any(w in c.lower() for w in TRUTH_WORDS)]


def snapshot(df: DataFrame) -> DataFrame:
    """The contract's columns only, cast and trimmed, with ``record_key`` and ``source_hash``. Refuses a table that lacks one, or that has columns which look like answers."""
    if told := truth_like(df.columns):
        raise ValueError(f"columns that look like answers: {told}")
    missing = [c for c in COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    frame = df.select(*[F.col(c).cast(SCHEMA[c].dataType).alias(c) for c in COLUMNS])
    frame = frame.withColumns({"source_system": F.lower(F.trim("source_system")), "source_record_id": F.trim("source_record_id")})
    key = F.sha2(F.concat_ws("|", "source_system", "source_record_id"), 256)
    content = F.sha2(F.to_json(F.struct(*COLUMNS), {"ignoreNullFields": "false"}), 256)
    return frame.withColumns({"record_key": key, "source_hash": content})
