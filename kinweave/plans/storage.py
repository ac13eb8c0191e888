"""Tables in files, streams, checks and small functions: what they leave behind, as rows that SQL can repeat."""

from __future__ import annotations

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from kinweave.functions import text as norm
from kinweave.functions import variants
from kinweave.operators import generate, profile, review, steward, tables
from kinweave.plans.publication import customers
from kinweave.plans.resolution import BASE, guests
from kinweave.runtime import materialize, shared_path
from kinweave.sources import reference
from kinweave.sources.guests import COLUMNS, truth_like
from kinweave.streaming import outbox

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def refused(action) -> bool:
    """Whether an action ends in the error that it should."""
    try:
        action()
    except ValueError:
        return True
    return False


# --- files -------------------------------------------------------------------------------------------
@query("SELECT n_nationkey AS key, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE n_name END AS name, CASE WHEN n_nationkey % 4 <> 0 THEN n_nationkey / 2.0E0 END AS half FROM nation")
def reference_scan(spark, d):
    """Declared types from a CSV: an empty cell is null, but empty in a text column."""
    k = F.col("n_nationkey")
    path = shared_path(spark, "reference")
    made = t(spark, d, "nation").select(F.when(k % 4 != 0, k / 2).alias("half"), k.alias("key"), F.when(k % 3 != 0, F.col("n_name")).alias("name"))
    made.write.option("header", True).csv(path)
    return reference.read_reference(spark, path, {"key": "BIGINT", "name": "STRING", "half": "DOUBLE"})


@query("SELECT 'nation' AS name, (SELECT count(*) FROM nation) AS rows UNION ALL SELECT 'region', (SELECT count(*) FROM region)")
def loaded_reference(spark, d):
    """Reference files as tables, twice: the second load replaces the first."""
    folder, out = shared_path(spark, "files"), shared_path(spark, "tables")
    for name in ("nation", "region"):
        t(spark, d, name).write.option("header", True).csv(f"{folder}/{name}.csv")
    columns = {"nation": {"n_nationkey": "BIGINT", "n_name": "STRING"}, "region": {"r_name": "STRING"}}
    reference.load_reference(spark, folder, columns, out)
    return spark.createDataFrame(list(reference.load_reference(spark, folder, columns, out).items()), "name string, rows long")


@query(f"WITH {BASE} SELECT concat('source_', source_system) AS name, count(*) AS rows FROM contacts GROUP BY 1")
def source_views(spark, d):
    out = None
    for name in reference.source_views(guests(spark, d)):
        one = spark.table(name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"))
        out = one if out is None else out.union(one)
    return out


@query("""SELECT * FROM (VALUES ('exists before', 0), ('exists after', 1), ('latest', 1), ('versions', 2), ('frozen again', 0), ('other content refused', 1),
      ('wrong count refused', 1), ('missing version refused', 1)) a(what, n)
  UNION ALL SELECT 'rows of 0', count(*) FROM customer UNION ALL SELECT 'rows of 1', count(*) FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT 'published', count(*) FROM customer""")
def versioned_tables(spark, d):
    """Existence, history, time travel, freezing and pinned publication."""
    v, c = tables.Versions(spark, shared_path(spark, "versions")), t(spark, d, "customer")
    n = c.count()
    rows = [("exists before", int(v.exists("c")))]
    v.write("c", c)
    v.write("c", c.where("c_custkey % 2 = 0"))
    rows += [("exists after", int(v.exists("c"))), ("latest", v.latest("c")), ("versions", v.history("c").count()), ("rows of 0", v.read("c", 0).count()), ("rows of 1", v.read("c").count())]
    v.freeze("f", c)
    rows += [("frozen again", v.freeze("f", c.orderBy("c_name"))), ("other content refused", int(refused(lambda: v.freeze("f", c.limit(1))))), ("wrong count refused", int(refused(lambda: v.publish("g", c, n + 1))))]
    v.publish("g", c, n)
    rows += [("published", v.read("g").count()), ("missing version refused", int(refused(lambda: v.read("c", 9))))]
    return spark.createDataFrame(rows, "what string, n long")


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'in debt' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE NOT coalesce(c_nationkey = 7, false)")
def updated_and_deleted(spark, d):
    v = tables.Versions(spark, shared_path(spark, "versions"))
    v.write("c", t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey"))
    v.rewrite("c", lambda c: tables.update_where(c, F.col("c_acctbal") < 0, {"c_mktsegment": F.lit("in debt")}))
    v.rewrite("c", lambda c: tables.delete_where(c, F.col("c_nationkey") == 7))
    return v.read("c").select("c_custkey", "c_mktsegment")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders")
def ordered_export(spark, d):
    """Chunks in key order, read again: a row's place is its chunk's first and its place in it."""
    o, path = t(spark, d, "orders").select("o_orderkey", "o_custkey"), shared_path(spark, "export")
    chunks = materialize(tables.export_ordered(o, ["o_orderkey"], path, o.count(), 1000), "chunks")
    lines = spark.read.text(path).select(F.substring_index(F.input_file_name(), "/", -1).alias("chunk"), F.get_json_object("value", "$.o_orderkey").cast("long").alias("o_orderkey"))
    inside = F.row_number().over(Window.partitionBy("chunk").orderBy("o_orderkey")) - 1
    return lines.withColumn("i", inside).join(chunks, "chunk").select("o_orderkey", (F.col("first_row") + F.col("i")).alias("place"))


@query("SELECT count(*) AS rows, CAST(ceil(count(*) / 7.0E0) AS BIGINT) AS pages, true AS wrong_count_refused, true AS repeated_keys_refused FROM nation")
def keyset_scan(spark, d):
    """All pages of a table by cursor, whose keys increase and whose rows are as many as declared."""
    n = t(spark, d, "nation")
    rows = n.count()
    held = [len(p) for p in tables.pages(n, ["n_regionkey", "n_nationkey"], 7, rows)]
    wrong, twice = refused(lambda: list(tables.pages(n, ["n_nationkey"], 7, rows + 1))), refused(lambda: list(tables.pages(n, ["n_regionkey"], 30, rows)))
    return spark.createDataFrame([(sum(held), len(held), wrong, twice)], "rows long, pages long, wrong_count_refused boolean, repeated_keys_refused boolean")


def _json(c: str) -> str:
    if c == "source_updated_at":
        return f"concat('\"', strftime({c}, '%Y-%m-%dT%H:%M:%S.000Z'), '\"')"
    return f"CASE WHEN {c} IS NULL THEN 'null' ELSE concat('\"', CAST({c} AS VARCHAR), '\"') END"


@query(f"""WITH {BASE} SELECT record_key, sha256(concat('{{', {", ',', ".join(f"concat('{json.dumps(c)}:', {_json(c)})" for c in COLUMNS)}, '}}')) AS source_hash FROM contacts""")
def source_hashes(spark, d):
    """The change identity of a source row: its JSON with nulls."""
    return guests(spark, d).select("record_key", "source_hash")


@query("SELECT c_custkey AS k, c_mktsegment AS v FROM customer UNION ALL SELECT c_custkey, 'late' FROM customer WHERE c_custkey % 9 = 0")
def replaced_and_appended(spark, d):
    """A table overwritten with other columns, then appended to."""
    path, c = shared_path(spark, "replaced"), t(spark, d, "customer")
    c.write.parquet(path)
    c.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v")).write.mode("overwrite").parquet(path)
    c.where("c_custkey % 9 = 0").select(F.col("c_custkey").alias("k"), F.lit("late").alias("v")).write.mode("append").parquet(path)
    return spark.read.parquet(path)


# --- streams -------------------------------------------------------------------------------------------
@query("""SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def streamed_windows(spark, d):
    """Windowed counts of a stream under a watermark, as its last batch leaves them."""
    out, source = shared_path(spark, "stream-out"), shared_path(spark, "stream-in")
    e = t(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    e.write.parquet(source)
    counted = outbox.windowed_counts(spark.readStream.schema(e.schema).parquet(source))
    stream = counted.writeStream.outputMode("complete").foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out)).option("checkpointLocation", shared_path(spark, "stream-state")).trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.read.parquet(out).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("SELECT concat('e', CAST(event_id AS VARCHAR)) AS event_id, concat('c', CAST(user_id AS VARCHAR)) AS case_id, event_id AS applied_case_version FROM events")
def outbox_log(spark, d):
    """Events that arrive twice, in one file and in another batch, land once."""
    source, log, state = shared_path(spark, "outbox"), shared_path(spark, "outbox-log"), shared_path(spark, "outbox-state")
    e = t(spark, d, "events").select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"), F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("case_id"), F.col("event_id").alias("applied_case_version"), F.lit("MERGE").alias("action"), F.lit("x").alias("content_digest"))
    e.union(e.where("applied_case_version % 3 = 0")).write.json(source)
    for _ in range(2):
        outbox.land_once(outbox.read_outbox(spark, source), log, state).awaitTermination()
        e.where("applied_case_version % 5 = 0").write.mode("append").json(source)
    outbox.land_once(outbox.read_outbox(spark, source), log, state).awaitTermination()
    return spark.read.parquet(log).select("event_id", "case_id", "applied_case_version")


# --- checks --------------------------------------------------------------------------------------------
@query("""SELECT * FROM (VALUES ('gate holds', true), ('gate fails', false), ('no rows are none', true), ('keys are unique', true), ('keys repeat',
      false)) a(what, passed)
  UNION ALL SELECT 'truth-like columns', list_contains(['truth_id', 'Expected_x'], 'truth_id')""")
def assertions(spark, d):
    """Checks that stop a query, checks that stop a run, emptiness."""
    o = t(spark, d, "orders")
    gates = lambda hi: generate.require(generate.gate(o, {"mean": (F.avg("o_totalprice"), 0, hi)}))

    def holds(action) -> bool:
        try:
            action()
        except Exception as error:  # the engine's own error class for a failed assertion
            if "gate failed" not in str(error) and not isinstance(error, ValueError):
                raise
            return False
        return True

    rows = [("gate holds", holds(lambda: gates(1e12).collect())), ("gate fails", holds(lambda: gates(1).collect())), ("no rows are none", o.where("o_orderkey < 0").isEmpty()),
            ("keys are unique", holds(lambda: tables.assert_unique(o, ["o_orderkey"]))), ("keys repeat", holds(lambda: tables.assert_unique(o, ["o_orderstatus"]))), ("truth-like columns", truth_like(["name", "truth_id", "Expected_x"]) == ["truth_id", "Expected_x"])]
    return spark.createDataFrame(rows, "what string, passed boolean")


@query("""SELECT * FROM (VALUES ('sound', NULL), ('negative', 'links: version -1'), ('other schema', 'several schemas: [''a.b'', ''a.c'']'), ('unknown',
      'more: unexpected, missing or malformed')) t(name, problem)""")
def manifest_problems(spark, d):
    entry = lambda **k: {"table": "a.b.links", "version": 1, "row_count": 2} | k
    allowed = {"links": r"a\.[bc]\.[a-z]+", "maps": r"a\.[bc]\.[a-z]+"}
    cases = {"sound": {"links": entry(), "maps": entry()}, "negative": {"links": entry(version=-1), "maps": entry()}, "other schema": {"links": entry(), "maps": entry(table="a.c.maps")}, "unknown": {"links": entry(), "maps": entry(), "more": entry()}}
    rows = []
    for name, value in cases.items():
        try:
            review.parse_manifest(value, allowed)
            rows.append((name, None))
        except ValueError as error:
            rows.append((name, str(error)))
    return spark.createDataFrame(rows, "name string, problem string")


@query("""SELECT * FROM (VALUES ('first', 'import'), ('again', 'replay'), ('next', 'replace'), ('changed', 'this release was imported with other content'),
      ('archived', 'this release is archived'), ('foreign', 'the queue holds cases of a release that is not active'), ('two',
      'several active releases')) t(name, outcome)""")
def import_outcomes(spark, d):
    schema = "source_run_id string, content_digest string, active boolean"
    ledger = lambda *rows: spark.createDataFrame(list(rows), schema)
    one, old = ("r1", "x", True), ("r0", "x", False)
    cases = {"first": (ledger(), [], "r1", "x"), "again": (ledger(one), ["r1"], "r1", "x"), "next": (ledger(one), ["r1"], "r2", "y"), "changed": (ledger(one), ["r1"], "r1", "y"), "archived": (ledger(one, old), ["r1"], "r0", "x"), "foreign": (ledger(one), ["r9"], "r1", "x"),
             "two": (ledger(one, ("r2", "y", True)), [], "r1", "x")}
    rows = []
    for name, given in cases.items():
        try:
            rows.append((name, steward.import_outcome(*given)))
        except ValueError as error:
            rows.append((name, str(error)))
    return spark.createDataFrame(rows, "name string, outcome string")


@query("""SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'empty group' WHEN 1 THEN 'not every record exactly once' WHEN 2 THEN 'a merge has one group'
      WHEN 3 THEN 'a separation has single records' WHEN 4 THEN 'a partition has between one and all' WHEN 5 THEN 'no such action' END AS problem
      FROM customer""")
def partition_problems(spark, d):
    n = F.col("c_custkey") % 7
    one, two = F.array(F.array(F.lit("a"), F.lit("b"), F.lit("c"))), F.array(F.array(F.lit("a")), F.array(F.lit("b"), F.lit("c")))
    groups = F.when(n == 0, F.array(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.array().cast("array<string>"))).when(n == 1, F.array(F.array(F.lit("a"), F.lit("b")))).when(n == 4, one).otherwise(two)
    action = F.when(n == 2, "MERGE").when(n == 3, "SEPARATE").when(n == 5, "SHUFFLE").otherwise("PARTITION")
    return t(spark, d, "customer").select("c_custkey", review.partition_problem(F.array(F.lit("c"), F.lit("a"), F.lit("b")), groups, action).alias("problem"))


# --- functions -------------------------------------------------------------------------------------------
@query("""SELECT o_orderkey, CAST(CAST(day + to_months(CAST(o_orderkey % 30 AS INT)) AS DATE) AS VARCHAR) AS later, date_diff('day', DATE '1995-01-31',
      day) AS days, CAST(make_date(year(day), month(day), 1) AS VARCHAR) AS first,
  date_diff('year', day, DATE '2025-12-31') AS years, CAST(last_day(day) AS VARCHAR) AS last, strftime(day, '%Y-%m') AS month
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders) o""")
def date_functions(spark, d):
    day = F.col("o_orderdate").cast("date")
    years = F.floor(F.months_between(F.lit("2025-12-31").cast("date"), day) / 12).cast("long")
    o = t(spark, d, "orders")
    return o.select("o_orderkey", F.add_months(day, (F.col("o_orderkey") % 30).cast("int")).cast("string").alias("later"), F.datediff(day, F.lit("1995-01-31").cast("date")).cast("long").alias("days"),
                    F.make_date(F.year(day), F.month(day), F.lit(1)).cast("string").alias("first"), years.alias("years"), F.last_day(day).cast("string").alias("last"), F.date_format(day, "yyyy-MM").alias("month"))


@query("""SELECT c_nationkey, count(*) AS customers FROM customer
      GROUP BY 1 HAVING count(*) FILTER (WHERE c_acctbal < 0) * 10 > count(*) AND min(c_acctbal) < 0""")
def having_conditional(spark, d):
    return t(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("c_acctbal") < 0).alias("low"), F.min("c_acctbal").alias("least")).where("low * 10 > customers AND least < 0").select("c_nationkey", "customers")


@query("""SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names, count(*) AS n FROM nation GROUP BY 1""")
def listed_options(spark, d):
    return t(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("names"), F.count(F.lit(1)).alias("n"))


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
      FROM orders) x WHERE rn = 1""")
def latest_rows(spark, d):
    return profile.latest(t(spark, d, "orders"), ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"]).select("o_custkey", "o_orderkey")


FORMS = (("  José-Luis O'Neil ", "jose luis o neil", True), ("ﬁne  Ｔext", "fine text", True), ("Straße 5", "strasse 5", True), ("ΓΙΏΡΓΟΣ", "γιωργοσ", True), ("plain_Text 1", "plain_text 1", False), ("~!", None, False), ("東京", "東京", True))


def _rows(rows) -> str:
    lit = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)


@query(f"SELECT * FROM (VALUES {_rows(FORMS)}) t(given, form, non_ascii)")
def unicode_forms(spark, d):
    """Comparable forms of names beyond ASCII, and the test for these."""
    frame = spark.createDataFrame([(r[0],) for r in FORMS], "given string")
    return frame.select("given", norm.text(F.col("given")).alias("form"), F.col("given").rlike(norm.NON_ASCII).alias("non_ascii"))


NAMES = (("will", "bill", "NICKNAME"), ("jo", "jo ann", "EXACT"), ("j", "john", "INITIAL"), ("chris", "christine", "PREFIX"), ("marta", "matra", "TYPO"), ("anna", "zoe", "CONFLICT"), (None, "a", None), ("katherine", "kate", "NICKNAME"), ("robert", "bob", "NICKNAME"), ("robert", "rupert", "CONFLICT"))
SURNAMES = (("o neil", "oneil", "EXACT"), ("smith jones", "jones", "TOKEN"), ("kowalski", "kowlaksi", "TYPO"), ("brown", "green", "CONFLICT"), ("a", None, None), ("li", "lo", "CONFLICT"))
DATES = (("1990-02-03", "1990-02-03", "EXACT", True), ("1990-02-03", "1990-03-02", "DAY_MONTH_SWAP", True), ("1990-02-03", "1980-02-03", "YEAR_DIGIT", False), ("1990-02-03", "1990-02-13", "DAY_DIGIT", False), ("1990-02-03", "1991-03-02", "CONFLICT", False), (None, "1990-01-01", None, None))


@query(f"SELECT 'given' AS kind, * FROM (VALUES {_rows(NAMES)}) a(l, r, variant) UNION ALL SELECT 'family', * FROM (VALUES {_rows(SURNAMES)}) b(l, r, variant)")
def name_variant_cases(spark, d):
    """Nicknames, prefixes, initials, slips and tokens of given and family names."""
    of = lambda rows, kind, f: spark.createDataFrame([r[:2] for r in rows], "l string, r string").select(F.lit(kind).alias("kind"), "l", "r", f(F.col("l"), F.col("r")).alias("variant"))
    return of(NAMES, "given", variants.given_variant).union(of(SURNAMES, "family", variants.family_variant))


@query(f"SELECT l, r, variant, compatible FROM (VALUES {_rows(DATES)}) a(l, r, variant, compatible)")
def date_variant_cases(spark, d):
    frame = spark.createDataFrame([r[:2] for r in DATES], "l string, r string")
    a, b = F.to_date("l"), F.to_date("r")
    return frame.select("l", "r", variants.dob_variant(a, b).alias("variant"), F.when(a.isNotNull() & b.isNotNull(), variants.dob_compatible(a, b)).alias("compatible"))


@query("""SELECT a.n_name AS l, b.n_name AS r, abs(length(a.n_name) - length(b.n_name)) <= 8
      AND damerau_levenshtein(lower(a.n_name), lower(b.n_name)) <= 1 AS near FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey""")
def typo_pairs(spark, d):
    """Pairs of names that one slip parts at most; for so few the two edit distances with swaps agree."""
    n = t(spark, d, "nation")
    a, b = n.select("n_regionkey", F.col("n_name").alias("l")), n.select("n_regionkey", F.col("n_name").alias("r"))
    return a.join(b, "n_regionkey").select("l", "r", (variants._osa(F.lower("l"), F.lower("r")) <= 1).alias("near"))


@query("""SELECT concat('const RELEASE_EVIDENCE = {', chr(10), '  "customers": ', count(*), chr(10), '};', chr(10)) AS script FROM customer""")
def evidence_script(spark, d):
    return spark.createDataFrame([(reference.evidence_js({"customers": customers(spark, d).count()}),)], "script string")


@query("SELECT 'SELECT 1 AS x' AS statement UNION ALL SELECT 'SELECT \"a\" FROM t'")
def rendered_script(spark, d):
    script = reference.render("SELECT {{n}} AS x;\n-- COMMAND ----------\nSELECT \"{{c}}\" FROM t", {"n": "1", "c": "a"})
    assert refused(lambda: reference.render("{{left}}", {}))
    return spark.createDataFrame([(s,) for s in reference.statements(script)], "statement string")
