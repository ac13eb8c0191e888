"""Relational queries over the plain tables: joins, aggregates, windows, sorts, sets, table maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.operators import tables as T
from kinweave.operators import vectors as V
from kinweave.operators.generate import WHEEL, apportion, as_of, gate, permuted, spin, unique_emails, weighted_pick
from kinweave.operators.tables import top_k

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, *names: str):
    found = [spark.read.parquet(f"{d}/{n}.parquet") for n in names]
    return found[0] if len(found) == 1 else found


BANDS = (("low", 0, 20000), ("mid", 20000, 60000), ("high", 60000, 150000), ("top", 150000, 1000000))
BANDS_SQL = "(VALUES " + ", ".join(f"('{n}', {a}, {b})" for n, a, b in BANDS) + ")"


def bands(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {', '.join(str(b) for b in BANDS)} AS b(band, lo, hi)")


@query(f"""SELECT band, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN {BANDS_SQL} b(band, lo, hi)
  ON o_totalprice >= lo AND o_totalprice < hi GROUP BY band""")
def range_bucket_join(spark, d):
    found = T.range_bucket_join(t(spark, d, "orders"), bands(spark), F.col("o_totalprice"), "lo", "hi", 10000)
    return found.groupBy("band").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT n_name, count(o_orderkey) AS big_orders, count(*) AS rows_out FROM nation JOIN customer ON c_nationkey = n_nationkey
  LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 100000 GROUP BY n_name""")
def left_join_with_filter(spark, d):
    n, c, o = t(spark, d, "nation", "customer", "orders")
    j = n.join(c, n.n_nationkey == c.c_nationkey).join(o, (o.o_custkey == c.c_custkey) & (o.o_totalprice > 100000), "left")
    return j.groupBy("n_name").agg(F.count("o_orderkey").alias("big_orders"), F.count(F.lit(1)).alias("rows_out"))


@query("""SELECT c_custkey, band FROM customer JOIN (VALUES ('pinned', 7, 0, 0), ('negative', -1, -100000, 0), ('small', -1, 0, 3000), ('large', -1, 3000,
      100000)) b(band, pin, lo, hi)
  ON (c_custkey = pin) OR (c_custkey <> 7 AND pin = -1 AND c_acctbal >= lo AND c_acctbal < hi)""")
def or_branch_join(spark, d):
    c = t(spark, d, "customer")
    b = spark.sql("SELECT * FROM VALUES ('pinned', 7, 0, 0), ('negative', -1, -100000, 0), ('small', -1, 0, 3000), ('large', -1, 3000, 100000) AS b(band, pin, lo, hi)")
    pinned = c.join(b.where("pin >= 0"), F.col("c_custkey") == F.col("pin")).select("c_custkey", "band")
    picked = T.range_bucket_join(c.where("c_custkey <> 7"), b.where("pin = -1"), F.col("c_acctbal"), "lo", "hi", 5000).select("c_custkey", "band")
    return pinned.unionByName(picked)


@query("""SELECT count(*) AS pairs FROM (SELECT nullif(c_mktsegment, 'BUILDING') AS s, c_nationkey FROM customer) a
      JOIN (SELECT DISTINCT nullif(c_mktsegment, 'BUILDING') AS s, c_nationkey FROM customer) b
  ON a.s IS NOT DISTINCT FROM b.s AND a.c_nationkey = b.c_nationkey""")
def null_safe_join(spark, d):
    a = t(spark, d, "customer").select(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("s"), "c_nationkey")
    b = a.distinct()
    return a.join(b, a.s.eqNullSafe(b.s) & (a.c_nationkey == b.c_nationkey)).agg(F.count(F.lit(1)).alias("pairs"))


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 350000)")
def anti_join(spark, d):
    c, o = t(spark, d, "customer", "orders")
    return c.join(o.where("o_totalprice > 350000"), c.c_custkey == o.o_custkey, "left_anti").select("c_custkey", "c_name")


@query("""SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) OR p_partkey IN (SELECT l_partkey
      FROM lineitem WHERE l_discount > 0.09)""")
def semi_join_either(spark, d):
    p, li = t(spark, d, "part", "lineitem")
    keys = li.where("l_quantity > 49").select("l_partkey").union(li.where("l_discount > 0.09").select("l_partkey")).distinct()
    return p.join(keys, p.p_partkey == keys.l_partkey, "left_semi").select("p_partkey")


@query("""SELECT o_orderpriority, count(*) AS n, round(count(*) * 1.0E0 / (SELECT count(*)
      FROM orders), 6) AS share, round(avg(o_totalprice) / (SELECT avg(o_totalprice) FROM orders), 6) AS relative
  FROM orders GROUP BY o_orderpriority""")
def scalar_subquery_share(spark, d):
    o = t(spark, d, "orders")
    whole = o.agg(F.count(F.lit(1)).alias("all"), F.avg("o_totalprice").alias("mean"))  # one row
    each = o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("m"))
    return each.join(F.broadcast(whole)).select("o_orderpriority", "n", F.round(F.col("n") / F.col("all"), 6).alias("share"), F.round(F.col("m") / F.col("mean"), 6).alias("relative"))


@query("""SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT CASE
      WHEN l_quantity > 40 THEN l_orderkey END) AS large_orders,
  count(*) FILTER (WHERE l_discount > 0.05) AS discounted FROM lineitem GROUP BY l_returnflag""")
def distinct_multi(spark, d):
    return t(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"),
        F.countDistinct(F.when(F.col("l_quantity") > 40, F.col("l_orderkey"))).alias("large_orders"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"))


@query("""SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS f, max(CASE
      WHEN o_orderstatus = 'O' THEN o_totalprice END) AS o, max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS p
  FROM orders GROUP BY o_custkey""")
def conditional_pivot(spark, d):
    return t(spark, d, "orders").groupBy("o_custkey").agg(*[F.max(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))).alias(s.lower()) for s in "FOP"])


@query("""SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(*) AS events FROM events GROUP BY user_id""")
def collect_sorted_set(spark, d):
    return t(spark, d, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"), F.count(F.lit(1)).alias("events"))


@query("""SELECT n_regionkey, max(n) AS most, min(n) AS least, round(avg(n), 6) AS mean FROM (SELECT n_regionkey, n_nationkey, count(c_custkey) AS n
      FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_regionkey, n_nationkey) x
  GROUP BY n_regionkey HAVING max(n) > 1""")
def two_level_aggregate(spark, d):
    n, c = t(spark, d, "nation", "customer")
    each = n.join(c, n.n_nationkey == c.c_nationkey, "left").groupBy("n_regionkey", "n_nationkey").agg(F.count("c_custkey").alias("n"))
    return each.groupBy("n_regionkey").agg(F.max("n").alias("most"), F.min("n").alias("least"), F.round(F.avg("n"), 6).alias("mean")).where("most > 1")


@query("""SELECT k, max(v) AS strongest, count(*) AS ends FROM (SELECT l_partkey AS k, l_extendedprice AS v FROM lineitem
      UNION ALL SELECT l_suppkey, l_extendedprice FROM lineitem) x GROUP BY k""")
def stacked_directions(spark, d):
    li = t(spark, d, "lineitem")
    both = li.select(F.col("l_partkey").alias("k"), F.col("l_extendedprice").alias("v")).union(li.select("l_suppkey", "l_extendedprice"))
    return both.groupBy("k").agg(F.max("v").alias("strongest"), F.count(F.lit(1)).alias("ends"))


@query("""SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC,
      o_orderkey) AS rank FROM orders) x WHERE rank <= 3""")
def topk_orders_per_customer(spark, d):
    return top_k(t(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "rank")


@query("""SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn
      FROM events) x WHERE rn = 1""")
def latest_event_per_user(spark, d):
    return top_k(t(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), "event_id"], 1).select("event_id", "user_id", "event_type")


@query("""SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS own, first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate,
      o_orderkey) AS first_order,
  lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_order, lead(o_orderkey,
    2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS after_next,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders""")
def window_functions(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t(spark, d, "orders").select(
        "o_orderkey", F.count(F.lit(1)).over(Window.partitionBy("o_custkey")).alias("own"), F.first("o_orderkey").over(w).alias("first_order"),
        F.lead("o_orderkey").over(w).alias("next_order"), F.lead("o_orderkey", 2).over(w).alias("after_next"), (F.row_number().over(w) - 1).cast("long").alias("position"))


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25 OFFSET 10""")
def queue_page_sorted(spark, d):
    return t(spark, d, "orders").where("o_orderstatus = 'O'").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").offset(10).limit(25).select("o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber) > (100, 2) ORDER BY l_orderkey, l_linenumber LIMIT 50")
def keyset_page(spark, d):
    return T.after(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], (100, 2), 50).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT n_nationkey AS k FROM nation UNION SELECT r_regionkey FROM region UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, d):
    n, r, s = t(spark, d, "nation", "region", "supplier")
    return n.select(F.col("n_nationkey").alias("k")).union(r.select("r_regionkey")).union(s.select("s_nationkey")).distinct()


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN value > 50 THEN 'high' WHEN value IS NULL THEN 'none' ELSE 'low' END AS level, value BETWEEN 10 AND 50 AS middling FROM events WHERE event_type LIKE '%i%'")
def json_and_case(spark, d):
    level = F.when(F.col("value") > 50, "high").when(F.col("value").isNull(), "none").otherwise("low")
    e = t(spark, d, "events").where(F.col("event_type").like("%i%"))
    return e.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), level.alias("level"), F.col("value").between(10, 50).alias("middling"))


@query("SELECT c_custkey, c_mktsegment, CAST(NULL AS DOUBLE) AS absent FROM customer")
def projections(spark, d):
    c = t(spark, d, "customer")
    c.createOrReplaceTempView("projections_customer")
    kept = spark.sql("SELECT * EXCEPT (c_name, c_acctbal, c_nationkey) FROM projections_customer")
    return kept.withColumn("absent", F.lit(None).cast("double"))


@query("SELECT n_nationkey, concat('member-', CAST(n_nationkey AS VARCHAR)) AS record_key, n_name AS customer_id FROM nation WHERE n_nationkey < 20")
def json_rows(spark, d):
    payload = t(spark, d, "nation").where("n_nationkey < 20").groupBy("n_nationkey").agg(F.to_json(F.collect_list(F.struct(F.concat(F.lit("member-"), F.col("n_nationkey").cast("string")).alias("record_key"), F.col("n_name").alias("customer_id"))), {"ignoreNullFields": "false"}).alias("p"))
    return payload.select("n_nationkey", F.inline(F.from_json("p", "array<struct<record_key:string,customer_id:string>>")))


@query("""WITH old AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'old' ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 5 <> 0),
  new AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 7 <> 0)
  SELECT coalesce(old.k, new.k) AS k, CASE WHEN new.k IS NULL THEN old.v ELSE new.v END AS v,
    CASE WHEN old.k IS NULL THEN 'INSERT' WHEN new.k IS NULL THEN 'DELETE' WHEN old.v IS NOT DISTINCT
      FROM new.v THEN 'SAME' ELSE 'UPDATE' END AS change
  FROM old FULL JOIN new ON old.k = new.k""")
def sync_table(spark, d):
    c = t(spark, d, "customer")
    old = c.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 3 == 0, "old").otherwise(F.col("c_mktsegment")).alias("v"))
    return T.sync(old, c.where("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v")), ["k"], ["v"])


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'first' ELSE 'second' END AS v FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0""")
def insert_only_merge(spark, d):
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    first = c.where("k % 2 = 0").withColumn("v", F.lit("first"))
    return T.insert_only(first, c.where("k % 3 = 0").withColumn("v", F.lit("second")), ["k"])


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE 'old' END AS v FROM customer WHERE c_custkey % 2 = 0""")
def fill_missing_merge(spark, d):
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("k")).where("k % 2 = 0")
    return T.fill_missing(c.withColumn("v", F.when(F.col("k") % 4 != 0, "old")), c.withColumn("v", F.lit("new")), ["k"], "v")


@query("""SELECT c_custkey AS k, 'a' AS v, 1 AS valid_from, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 2 END AS valid_to FROM customer
  UNION ALL SELECT c_custkey, 'b', 2, NULL FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 5 <> 0""")
def scd2_history(spark, d):
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    was = c.select("k", F.lit("a").alias("v"), F.lit(1).alias("valid_from"), F.lit(None).cast("int").alias("valid_to"))
    now = c.where("k % 5 <> 0").withColumn("v", F.when(F.col("k") % 3 == 0, "b").otherwise("a"))
    return T.close_and_open(was, now, "k", "v", F.lit(2))


@query("SELECT true AS order_independent, true AS tells_contents_apart")
def table_fingerprint(spark, d):
    o = t(spark, d, "orders")
    same = T.fingerprint(o) == T.fingerprint(o.orderBy(F.desc("o_totalprice")))
    other = T.fingerprint(o) != T.fingerprint(o.withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return spark.range(1).select(F.lit(same).alias("order_independent"), F.lit(other).alias("tells_contents_apart"))


@query("""SELECT vec_id, len(embedding) AS dims, list_aggregate(list_transform(embedding, lambda x: CAST(abs(x) <= 1 AS INT)), 'min') = 1 AS bounded,
  abs(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) - 1) <= 0.001 AS unit FROM embeddings""")
def vector_norm_gate(spark, d):
    e = t(spark, d, "embeddings")
    return e.select("vec_id", F.size("embedding").cast("long").alias("dims"), F.forall("embedding", lambda x: F.abs(x) <= 1).alias("bounded"), (F.abs(V.norm(F.col("embedding")) - 1) <= 0.001).alias("unit"))


@query("""SELECT query_id, neighbour_id, score, rank FROM (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, s AS score,
      row_number() OVER (PARTITION BY a.vec_id ORDER BY s DESC, b.vec_id) AS rank
  FROM (SELECT a.vec_id, b.vec_id AS bid, round(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS s
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) a JOIN embeddings b ON b.vec_id = a.bid) x WHERE rank <= 20""")
def knn_top20(spark, d):
    e = t(spark, d, "embeddings")
    return V.knn(e, e, 20)


WEIGHTS_SQL = "(VALUES ('a', 5.0E0), ('b', 2.0E0), ('c', 1.0E0), ('d', 0.5E0), ('e', 0.25E0)) w(name, weight)"


def wheel(spark):
    return apportion(spark.sql("SELECT * FROM VALUES ('a', 5.0E0), ('b', 2.0E0), ('c', 1.0E0), ('d', 0.5E0), ('e', 0.25E0) AS w(name, weight)"), "weight", "name")


WHEEL_CTE = f"""parts AS (SELECT name, floor(weight * {WHEEL} / sum(weight) OVER ()) AS f,
      weight * {WHEEL} / sum(weight) OVER () - floor(weight * {WHEEL} / sum(weight) OVER ()) AS r FROM {WEIGHTS_SQL}),
  given AS (SELECT name, f + CASE WHEN row_number() OVER (ORDER BY round(r, 9) DESC, name) <= {WHEEL} - sum(f) OVER () THEN 1 ELSE 0 END AS n
    FROM parts),
  wheel AS (SELECT name, CAST(sum(n) OVER (ORDER BY name ROWS UNBOUNDED PRECEDING) - n AS BIGINT) AS lo,
    CAST(sum(n) OVER (ORDER BY name ROWS UNBOUNDED PRECEDING) AS BIGINT) AS hi FROM given)"""


@query(f"WITH {WHEEL_CTE} SELECT name, lo, hi FROM wheel")
def apportioned_wheel(spark, d):
    return wheel(spark).select("name", "lo", "hi")


@query(f"""WITH {WHEEL_CTE}, spun AS (SELECT c_custkey, CAST(concat('0x', substring(sha256(concat('pick|', CAST(c_custkey AS VARCHAR))), 1,
      13)) AS BIGINT) % {WHEEL} AS s FROM customer)
  SELECT c_custkey, name FROM spun JOIN wheel ON s >= lo AND s < hi""")
def weighted_range_pick(spark, d):
    return weighted_pick(t(spark, d, "customer"), wheel(spark), "pick", ["c_custkey"]).select("c_custkey", "name")


@query("""SELECT event_id, CASE WHEN user_id % 2 = 0 AND ts < TIMESTAMP '2024-01-15' THEN 'before'
      ELSE 'after' END AS attribute, CAST((event_id * 386093 + 104729) % 1000000 AS BIGINT) AS permuted FROM events""")
def asof_attribute(spark, d):
    changed = F.when(F.col("user_id") % 2 == 0, F.lit("2024-01-15").cast("timestamp_ntz"))
    return t(spark, d, "events").select("event_id", as_of(F.col("ts"), changed, F.lit("before"), F.lit("after")).alias("attribute"), permuted(F.col("event_id")).alias("permuted"))


@query("""WITH people AS (SELECT c_custkey AS k, lower(c_mktsegment) AS first_choice, concat(lower(c_mktsegment), '.',
      CAST(c_nationkey % 5 AS VARCHAR)) AS second_choice,
    concat(lower(c_mktsegment), '.x') AS third, concat('n', CAST(c_nationkey AS VARCHAR)) AS dm, CAST(concat('0x',
      substring(sha256(concat('mail|tail|', CAST(c_custkey AS VARCHAR))), 1, 13)) AS BIGINT) % 10000000 % 900 + 100 AS tail FROM customer),
  one AS (SELECT *, concat(first_choice, '@', dm) AS e1, row_number() OVER (PARTITION BY first_choice, dm ORDER BY k) = 1 AS ok1 FROM people),
  two AS (SELECT *, CASE WHEN ok1 THEN e1 ELSE concat(second_choice, '@', dm) END AS e2 FROM one),
  kept2 AS (SELECT *, row_number() OVER (PARTITION BY e2 ORDER BY CASE WHEN ok1 THEN 0 ELSE 1 END, k) = 1 AS ok2 FROM two),
  three AS (SELECT *, CASE WHEN ok2 THEN e2 ELSE concat(third, CAST(tail AS VARCHAR), '@', dm) END AS e3 FROM kept2),
  kept3 AS (SELECT *, row_number() OVER (PARTITION BY e3 ORDER BY CASE WHEN ok2 THEN 0 ELSE 1 END, k) = 1 AS ok3 FROM three),
  four AS (SELECT *, CASE WHEN ok3 THEN e3 ELSE concat(replace(third, '.', ''), CAST(k AS VARCHAR), '@', dm) END AS e4 FROM kept3),
  kept4 AS (SELECT *, row_number() OVER (PARTITION BY e4 ORDER BY CASE WHEN ok3 THEN 0 ELSE 1 END, k) = 1 AS ok4 FROM four)
  SELECT k AS c_custkey, CASE WHEN ok4 THEN e4 ELSE concat(replace(third, '.', ''), '+', CAST(k AS VARCHAR), '@', dm) END AS email, NOT ok1 AS bumped FROM kept4""")
def unique_email(spark, d):
    segment, nation = F.lower("c_mktsegment"), F.col("c_nationkey")
    c = t(spark, d, "customer").select(
        "c_custkey", segment.alias("l"), F.concat(segment, F.lit("."), (nation % 5).cast("string")).alias("second"), F.concat(segment, F.lit(".x")).alias("third"), F.concat(F.lit("n"), nation.cast("string")).alias("dm"))
    return unique_emails(c, "c_custkey", "l", "dm", "second", "third", "mail").select("c_custkey", "email", "bumped")


@query("""SELECT 'open_share' AS gate, round(avg(CASE WHEN o_orderstatus = 'O' THEN 1.0E0
      ELSE 0.0E0 END), 6) AS value, 0.1E0 AS lo, 0.9E0 AS hi, avg(CASE WHEN o_orderstatus = 'O' THEN 1.0E0
      ELSE 0.0E0 END) BETWEEN 0.1 AND 0.9 AS passed FROM orders
  UNION ALL SELECT 'customers', CAST(count(DISTINCT o_custkey) AS DOUBLE), 1.0E0, 1000000000.0E0, count(DISTINCT o_custkey) BETWEEN 1 AND 1000000000
    FROM orders""")
def realism_gate(spark, d):
    return gate(t(spark, d, "orders"), {"open_share": (F.avg(F.when(F.col("o_orderstatus") == "O", 1.0).otherwise(0.0)), 0.1, 0.9), "customers": (F.countDistinct("o_custkey"), 1, 1e9)})


@query("""SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def event_windows(spark, d):
    e = t(spark, d, "events")
    return e.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")


@query("""SELECT o_custkey, sum(slot) AS slots FROM (SELECT o_custkey, o_orderkey, unnest(range(1, CAST(1 + o_orderkey % 3 AS BIGINT) + 1)) AS slot
      FROM orders) x GROUP BY o_custkey""")
def slot_explosion(spark, d):
    from kinweave.operators.generate import slots

    o = t(spark, d, "orders").withColumn("n", 1 + F.col("o_orderkey") % 3)
    return slots(o, "n").groupBy("o_custkey").agg(F.sum("slot").alias("slots"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_partkey AS a, -l_suppkey AS b FROM lineitem),
  s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  cc(node, component) USING KEY (node) AS (
    SELECT DISTINCT a, a FROM s
    UNION (SELECT DISTINCT ON (own.node) own.node, other.component FROM recurring.cc AS own JOIN s ON s.a = own.node
      JOIN cc AS other ON other.node = s.b
      WHERE other.component < own.component ORDER BY own.node, other.component))
  SELECT node, component FROM cc""")
def connected_components(spark, d):
    """Parts and suppliers that lineitem connects, over all its rows."""
    from kinweave.operators.components import connected_components as cc

    return cc(t(spark, d, "lineitem").select(F.col("l_partkey").alias("src"), (-F.col("l_suppkey")).alias("dst")))
