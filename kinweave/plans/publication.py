"""Releases and their publication, over a made-up resolution of the customers that SQL can repeat.

A customer is a record, three neighbours are a component. Pairs of neighbours carry a decision by arithmetic on the key;
bounds are small, so that some cases are deferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators import golden, publication, release, review

QUERIES, ORACLE_SQL = {}, {}
RUN, RESOLVER, RECORDS, PAIRS = "run1", "v1", 5, 8


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def record(k) -> F.Column:
    return F.concat(F.lit("r"), k.cast("string"))


def customers(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/customer.parquet").withColumn("k", F.col("c_custkey"))


def made_mapping(spark, d) -> DataFrame:
    third = F.floor(F.col("k") / 3).cast("string")
    return customers(spark, d).select(record(F.col("k")).alias("record_key"), F.concat(F.lit("m"), third).alias("component"), F.concat(F.lit("c"), third).alias("customer_id"))


def made_decisions(spark, d) -> DataFrame:
    c = customers(spark, d).select("k")
    pairs = c.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).join(c.select((F.col("k")).alias("other")), F.col("k") + F.col("n") == F.col("other"))
    k, n = F.col("k"), F.col("n")
    decision = F.when(k % 7 == 0, "REVIEW").when((k % 7).isin(1, 2), "AUTO_MATCH").otherwise("REJECT")
    a, b = record(k), record(F.col("other"))
    return pairs.select(
        F.least(a, b).alias("left_record_key"), F.greatest(a, b).alias("right_record_key"), (((k * 31 + n * 17) % 100) / 100).alias("match_probability"), decision.alias("decision"),
        F.concat(F.lit("RULE_"), (k % 3).cast("string")).alias("reason"), F.lit(RESOLVER).alias("resolver_version"), (k % 2 == 0).alias("name_exact"), (k % 5 == 0).alias("personal_email_exact"),
        (k % 10 == 0).alias("shared_email_exact"), F.when(k % 4 == 0, "CONFLICT").alias("dob_variant"), ((k * 31 + n * 17) % 100).cast("int").alias("gamma_name"), (n == 2).alias("far"), (k % 14 == 1).alias("odd"))


def made_refused(decisions: DataFrame) -> DataFrame:
    return decisions.where("decision = 'AUTO_MATCH' AND odd AND far").select("left_record_key", "right_record_key", F.lit("COMPONENT_SIZE_LIMIT").alias("reason"), "match_probability")


MADE = """
  m AS (SELECT c_custkey AS k, concat('r', CAST(c_custkey AS VARCHAR)) AS record_key, concat('m', CAST(c_custkey // 3 AS VARCHAR)) AS component,
    concat('c', CAST(c_custkey // 3 AS VARCHAR)) AS customer_id FROM customer),
  raw AS (SELECT a.k, n, a.record_key AS x, b.record_key AS y, a.component AS xc, b.component AS yc
    FROM m a, (VALUES (1), (2)) steps(n), m b WHERE b.k = a.k + n),
  dec AS (SELECT least(x, y) AS l, greatest(x, y) AS r, least(xc, yc) AS lc, greatest(xc, yc) AS rc, k, n, ((k * 31 + n * 17) % 100) / 100.0E0 AS p,
    CASE WHEN k % 7 = 0 THEN 'REVIEW' WHEN k % 7 IN (1, 2) THEN 'AUTO_MATCH' ELSE 'REJECT' END AS decision FROM raw),
  refused AS (SELECT * FROM dec WHERE decision = 'AUTO_MATCH' AND k % 14 = 1 AND n = 2),
  keys AS (SELECT l AS record_key FROM dec WHERE decision = 'REVIEW' UNION SELECT r FROM dec WHERE decision = 'REVIEW' UNION SELECT l
    FROM refused UNION SELECT r FROM refused),
  touched AS (SELECT DISTINCT component FROM m JOIN keys USING (record_key)),
  links AS (SELECT DISTINCT lc AS a, rc AS b FROM dec WHERE decision = 'REVIEW' AND lc <> rc AND (lc IN (SELECT component
    FROM touched) OR rc IN (SELECT component FROM touched))),
  ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
  nodes AS (SELECT component FROM touched UNION SELECT a FROM ends),
  cc(node, top) USING KEY (node) AS (
    SELECT component, component FROM nodes
    UNION (SELECT DISTINCT ON (own.node) own.node, other.top FROM recurring.cc AS own JOIN ends ON ends.a = own.node
      JOIN cc AS other ON other.node = ends.b WHERE other.top < own.top ORDER BY own.node, other.top)),
  sizes AS (SELECT top, count(*) AS records FROM m JOIN cc ON node = component GROUP BY top),
  held AS (SELECT x.top, count(*) AS pairs FROM dec JOIN cc x ON x.node = lc JOIN cc y ON y.node = rc WHERE x.top = y.top GROUP BY 1),
  cases AS (SELECT node AS component, cc.top AS case_component, records, coalesce(pairs, 0) AS pairs, records > {r} OR coalesce(pairs,
    0) > {p} AS deferred FROM cc JOIN sizes ON sizes.top = cc.top LEFT JOIN held ON held.top = cc.top),
  deferred AS (SELECT * FROM cases WHERE deferred),
  oper AS (SELECT m.*, concat('cmp_', substring(sha256(component), 1, 28)) AS provisional_customer_id,
    component IN (SELECT component FROM touched) AND component NOT IN (SELECT component FROM deferred) AS cluster_requires_review FROM m)""".format(r=RECORDS, p=PAIRS)
WITH = f"WITH RECURSIVE {MADE}"


class Made:
    """The made-up release's tables."""

    def __init__(self, spark: SparkSession, d: str):
        self.mapping, self.decisions = made_mapping(spark, d), made_decisions(spark, d)
        self.refused = made_refused(self.decisions)
        self.touched = golden.touched_components(self.decisions, self.refused, self.mapping)
        self.cases = golden.steward_cases(self.mapping, self.touched, self.decisions, RECORDS, PAIRS)
        self.deferred = release.deferred_cases(self.cases, RUN)
        self.operational = release.operational_mapping(self.mapping, self.touched, self.deferred, RUN, release.resolver_of(self.decisions))
        key = F.col("k").cast("string")
        self.sources = customers(spark, d).select(
            record(F.col("k")).alias("record_key"), F.concat(F.lit("s"), (F.col("k") % 3).cast("string")).alias("source_system"), key.alias("source_record_id"),
            F.col("c_name").alias("name"), F.when(F.col("k") % 4 != 0, F.col("c_mktsegment")).alias("company_name"))


@query(f"{WITH} SELECT component, case_component, records, pairs, deferred FROM cases")
def release_steward_cases(spark, d):
    return Made(spark, d).cases


@query(f"{WITH} SELECT '{RUN}' AS release_id, component, case_component AS case_key, records AS case_records, pairs AS case_pairs FROM deferred")
def release_deferred_cases(spark, d):
    return Made(spark, d).deferred


@query(f"{WITH} SELECT '{RUN}' AS resolution_run_id, '{RESOLVER}' AS resolver_version, record_key, customer_id, provisional_customer_id, cluster_requires_review FROM oper")
def release_operational_mapping(spark, d):
    return Made(spark, d).operational


@query(f"""{WITH} SELECT '{RUN}' AS resolution_run_id, l AS left_record_key, r AS right_record_key, decision, p AS evidence_score, concat(decision, ': RULE_',
      CAST(k % 3 AS VARCHAR), ' (p=', printf('%.4f', p), ')') AS decision_explanation,
  CAST(k % 2 = 0 AS INT) AS name_exact, CAST(k % 10 = 0 AS INT) AS shared_email_exact, CAST(k % 5 = 0
    AND k % 10 <> 0 AS INT) AS rare_email_exact, CAST(k % 4 = 0 AS INT) AS valid_dob_contradiction, CAST((k * 31 + n * 17) % 100 AS INT) AS gamma_name
  FROM dec WHERE l IN (SELECT record_key FROM oper WHERE cluster_requires_review) OR r IN (SELECT record_key FROM oper WHERE cluster_requires_review)""")
def release_review_evidence(spark, d):
    made = Made(spark, d)
    return release.review_evidence(made.decisions, made.operational, RUN).drop("evidence_reasons")


@query(f"""{WITH}, strongest AS (SELECT x, max(p) AS s FROM (SELECT l AS x, p FROM dec WHERE decision = 'AUTO_MATCH'
      UNION ALL SELECT r, p FROM dec WHERE decision = 'AUTO_MATCH') e GROUP BY x)
  SELECT customer_id, concat('s', CAST(k % 3 AS VARCHAR)) AS source_system, CAST(k AS VARCHAR) AS source_record_id, '{RUN}' AS resolution_run_id,
    '{RESOLVER}' AS resolver_version,
    CASE WHEN cluster_requires_review THEN 'REQUIRES_REVIEW'
      ELSE 'AUTO_RESOLVED' END AS mapping_status, cluster_requires_review, s AS strongest_edge_score FROM oper LEFT JOIN strongest ON x = record_key""")
def release_gold_links(spark, d):
    made = Made(spark, d)
    return release.gold_links(made.mapping, made.sources, made.operational, made.decisions, RUN, RESOLVER)


@query(f"""{WITH}, one AS (SELECT DISTINCT case_component, records, deferred FROM cases)
  SELECT count(*) FILTER (WHERE NOT deferred) AS steward_cases, count(*) FILTER (WHERE deferred) AS deferred_oversized_cases,
    CAST(coalesce(sum(records) FILTER (WHERE deferred), 0) AS BIGINT) AS deferred_oversized_records FROM one""")
def release_manifest(spark, d):
    """The manifest's numbers; ``manifest`` itself proves that sources and mappings agree."""
    made = Made(spark, d)
    told = release.manifest({"sources": ("x.sources", 0, made.sources), "mappings": ("x.mappings", 0, made.operational), "decisions": ("x.decisions", 0, made.decisions)}, made.cases, RUN, RESOLVER)["metadata"]
    return spark.createDataFrame([tuple(told[c] for c in ("steward_cases", "deferred_oversized_cases", "deferred_oversized_records"))], "steward_cases long, deferred_oversized_cases long, deferred_oversized_records long")


def second_mapping(spark, d) -> DataFrame:
    """The mapping of a later run: every fifth record is gone, every seventh has another customer."""
    m = customers(spark, d).where("k % 5 <> 0")
    return m.select(record(F.col("k")).alias("record_key"), F.when(F.col("k") % 7 == 0, F.concat(F.lit("n"), F.col("k").cast("string"))).otherwise(F.concat(F.lit("c"), F.floor(F.col("k") / 3).cast("string"))).alias("customer_id"))


@query("""SELECT concat('r', CAST(c_custkey AS VARCHAR)) AS record_key, concat('c', CAST(c_custkey // 3 AS VARCHAR)) AS customer_id, 1 AS valid_from, CASE
      WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN 2 END AS valid_to, 'run1' AS release_id FROM customer
  UNION ALL SELECT concat('r', CAST(c_custkey AS VARCHAR)), concat('n', CAST(c_custkey AS VARCHAR)), 2, NULL, 'run2'
    FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 = 0""")
def release_identity_history(spark, d):
    none = spark.createDataFrame([], "record_key string, customer_id string, valid_from int, valid_to int, release_id string")
    first = release.identity_history(none, made_mapping(spark, d), F.lit(1), "run1")
    second = release.identity_history(first, second_mapping(spark, d), F.lit(2), "run2")
    return release.identity_history(second, second_mapping(spark, d), F.lit(3), "run3")  # nothing changes


@query("""SELECT customer_id, min(seen) AS created_at FROM (SELECT concat('c', CAST(c_custkey // 3 AS VARCHAR)) AS customer_id, 1 AS seen FROM customer
  UNION ALL SELECT concat('n', CAST(c_custkey AS VARCHAR)), 2 FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 = 0) x GROUP BY 1""")
def release_id_registry(spark, d):
    none = spark.createDataFrame([], "customer_id string, created_at int")
    return release.registered(release.registered(none, made_mapping(spark, d), F.lit(1)), second_mapping(spark, d), F.lit(2))


@query("""SELECT concat('c', CAST(c_custkey AS VARCHAR)) AS retired_customer_id, concat('c', CAST(c_custkey // 2 AS VARCHAR)) AS surviving_customer_id,
      release_id
  FROM customer, (VALUES ('run1'), ('run2')) runs(release_id) WHERE c_custkey % 3 = 0""")
def release_aliases(spark, d):
    some = customers(spark, d).where("k % 3 = 0").select(F.concat(F.lit("c"), F.col("k").cast("string")).alias("old_id"), F.concat(F.lit("c"), F.floor(F.col("k") / 2).cast("string")).alias("customer_id"))
    log = spark.createDataFrame([], "retired_customer_id string, surviving_customer_id string, release_id string")
    for run in ("run1", "run2", "run1"):
        log = release.alias_log(log, some, run)
    return log


# decisions of stewards on the made-up cases: a component's records, merged, separated, parted or deferred by arithmetic
def steward_events(spark, d) -> DataFrame:
    k = F.col("k")
    c = customers(spark, d).where("k % 3 = 0").select("k")
    keys = F.array(record(k), record(k + 1), record(k + 2))
    groups = F.when(k % 4 == 0, F.array(keys)).when(k % 4 == 1, F.transform(keys, lambda x: F.array(x))).otherwise(F.array(F.slice(keys, 1, 1), F.reverse(F.slice(keys, 2, 2))))
    action = F.when(k % 12 == 3, "DEFER").when(k % 4 == 0, "MERGE").when(k % 4 == 1, "SEPARATE").otherwise("PARTITION")
    case, version = F.concat(F.lit("case"), k.cast("string")), F.explode(F.array(F.lit(1), F.lit(2)))
    two = c.select("k", version.alias("v")).where("v = 1 OR k % 2 = 0")
    return two.select(
        F.concat(F.lit("e"), k.cast("string"), F.lit("-"), F.col("v").cast("string")).alias("event_id"), case.alias("case_id"), F.lit(RUN).alias("source_run_id"), (F.col("v") - 1).alias("base_case_version"), F.col("v").alias("applied_case_version"),
        F.lit("someone").alias("actor"), F.lit("manual").alias("mode"),
        F.struct(F.lit("p1").alias("proposal_id"), case.alias("case_id"), (F.col("v") - 1).alias("case_version"), action.alias("action"), groups.alias("groups")).alias("proposal"))


STEWARD = """
  said AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 12 = 3 THEN 'DEFER' WHEN c_custkey % 4 = 0 THEN 'MERGE' WHEN c_custkey % 4 = 1 THEN 'SEPARATE'
    ELSE 'PARTITION' END AS action FROM customer WHERE c_custkey % 3 = 0),
  versions AS (SELECT said.*, v, concat('e', CAST(k AS VARCHAR), '-', CAST(v AS VARCHAR)) AS event_id, concat('case', CAST(k AS VARCHAR)) AS case_id
    FROM said, (VALUES (1), (2)) vs(v) WHERE v = 1 OR k % 2 = 0),
  members AS (SELECT versions.*, concat('r', CAST(k + i AS VARCHAR)) AS record_key,
    CASE action WHEN 'MERGE' THEN list_sort([concat('r', CAST(k AS VARCHAR)), concat('r', CAST(k + 1 AS VARCHAR)), concat('r',
      CAST(k + 2 AS VARCHAR))]) WHEN 'SEPARATE' THEN [concat('r', CAST(k + i AS VARCHAR))]
      ELSE CASE WHEN i = 0 THEN [concat('r', CAST(k AS VARCHAR))]
        ELSE list_sort([concat('r', CAST(k + 1 AS VARCHAR)), concat('r', CAST(k + 2 AS VARCHAR))]) END END AS grp
    FROM versions, (VALUES (0), (1), (2)) three(i) WHERE action <> 'DEFER'),
  named AS (SELECT *, concat('steward-', sha256(concat('["run1",["', array_to_string(grp, '","'), '"]]'))) AS identity FROM members),
  over AS (SELECT * FROM named WHERE v = CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END)"""


@query(f"""WITH {STEWARD} SELECT versions.event_id, versions.case_id, versions.action, string_agg(concat(record_key, '=', identity), ',' ORDER BY record_key,
      identity) FILTER (WHERE record_key IS NOT NULL) AS memberships
  FROM versions LEFT JOIN named ON named.event_id = versions.event_id GROUP BY 1, 2, 3""")
def exported_events(spark, d):
    told = F.transform("memberships", lambda m: F.concat_ws("=", m["record_key"], m["customer_id"]))
    return publication.export_events(steward_events(spark, d)).select("event_id", "case_id", "action", F.when(F.size("memberships") > 0, F.array_join(told, ",")).alias("memberships"))


def overrides_of(spark, d) -> DataFrame:
    return review.checked_overrides(publication.export_events(steward_events(spark, d)))


def links_of(spark, d) -> DataFrame:
    made = Made(spark, d)
    real = overrides_of(spark, d).join(made.operational.where("cluster_requires_review").select("record_key"), "record_key", "left_semi")
    return publication.reviewed_links(made.operational, made.sources, real, made.deferred)


REVIEWED = f"""{WITH}, {STEWARD},
  late AS (SELECT DISTINCT concat('cmp_', substring(sha256(component), 1, 28)) AS pid, case_component FROM deferred),
  reviewed AS (SELECT oper.record_key, concat('s', CAST(oper.k % 3 AS VARCHAR)) AS source_system, CAST(oper.k AS VARCHAR) AS source_record_id,
    coalesce(identity, customer_id) AS customer_id, customer_id AS pipeline_customer_id, '{RUN}' AS resolution_run_id,
    CASE WHEN identity IS NOT NULL THEN 'STEWARD_RESOLVED' WHEN cluster_requires_review OR case_component IS NOT NULL THEN 'REQUIRES_REVIEW'
      ELSE 'PIPELINE_RESOLVED' END AS mapping_status,
    CASE WHEN case_component IS NOT NULL THEN 'DEFERRED_OVERSIZED'
      WHEN cluster_requires_review THEN 'STEWARD_QUEUE' END AS review_scope, case_component AS deferred_case_key, event_id AS steward_decision_id,
      case_id AS steward_case_id
    FROM oper LEFT JOIN over ON over.record_key = oper.record_key AND cluster_requires_review LEFT JOIN late ON pid = provisional_customer_id)"""


@query(f"{REVIEWED} SELECT * FROM reviewed")
def reviewed_links(spark, d):
    return links_of(spark, d)


@query(f"""{REVIEWED} SELECT count(*) AS rows, count(DISTINCT record_key) AS records, count(steward_decision_id) AS overridden,
      count(deferred_case_key) AS deferred_records, count(DISTINCT deferred_case_key) AS deferred_cases, CAST(0 AS BIGINT) AS contradictions
      FROM reviewed""")
def reviewed_cardinality(spark, d):
    return publication.cardinality(links_of(spark, d))


@query(f"""{REVIEWED} SELECT 'projected' AS state, resolution_run_id, mapping_status, count(*) AS records FROM reviewed GROUP BY 2, 3
  UNION ALL SELECT 'current', 'run0', CASE WHEN k % 6 = 0 THEN 'REQUIRES_REVIEW' ELSE 'PIPELINE_RESOLVED' END, count(*) FROM oper GROUP BY 3""")
def publication_plan(spark, d):
    now = customers(spark, d).select(F.lit("run0").alias("resolution_run_id"), F.when(F.col("k") % 6 == 0, "REQUIRES_REVIEW").otherwise("PIPELINE_RESOLVED").alias("mapping_status"))
    return publication.publication_plan(links_of(spark, d), now)


@query(f"""WITH {STEWARD}, chosen AS (SELECT over.*, field FROM over, (VALUES ('name'), ('company_name')) f(field))
  SELECT 'run1' AS source_run_id, identity AS guest_identity, case_id, field AS field_name, CASE WHEN field = 'name' THEN c_name
    ELSE c_mktsegment END AS field_value, record_key AS chosen_record_key,
    concat('s', CAST(c_custkey % 3 AS VARCHAR)) AS source_system, CAST(c_custkey AS VARCHAR) AS source_record_id, event_id AS decision_id
  FROM chosen JOIN customer ON record_key = concat('r', CAST(c_custkey AS VARCHAR)) WHERE field = 'name' OR c_custkey % 4 <> 0""")
def reviewed_golden_fields(spark, d):
    """Every overridden record's name and company as a choice, and choices of decisions that no longer stand."""
    made, over = Made(spark, d), overrides_of(spark, d)
    fields = made.sources.select(F.col("record_key").alias("chosen_record_key"), F.inline(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("field_value")) for f in ("name", "company_name")]))).where("field_value IS NOT NULL")
    chosen = over.select("source_run_id", F.col("customer_id").alias("guest_identity"), "case_id", F.col("record_key").alias("chosen_record_key"), F.col("event_id").alias("decision_id")).join(fields, "chosen_record_key")
    stale = chosen.withColumn("decision_id", F.concat("decision_id", F.lit("-old")))
    return publication.reviewed_fields(chosen.unionByName(stale), over, made.sources)


@query("""SELECT concat('case', CAST(c_custkey // 3 AS VARCHAR)) AS case_id, CAST(c_custkey % 2 AS INT) AS "group", field AS field_name,
    CASE WHEN field = 'shoe_size' THEN 'no such field' WHEN c_custkey % 5 = 0 THEN 'not a record of the guest'
      ELSE 'the record has no value' END AS problem
  FROM customer, (VALUES ('name'), ('company_name'), ('shoe_size')) f(field)
    WHERE field = 'shoe_size' OR c_custkey % 5 = 0 OR (field = 'company_name' AND c_custkey % 4 = 0)""")
def golden_choice_problems(spark, d):
    k = F.col("k")
    c = customers(spark, d)
    who = c.select(F.concat(F.lit("case"), F.floor(k / 3).cast("string")).alias("case_id"), (k % 2).cast("int").alias("group"), record(k).alias("record_key"), "k")
    choices = who.select("case_id", "group", "record_key", F.explode(F.array(*map(F.lit, ("name", "company_name", "shoe_size")))).alias("field_name"))
    return publication.choice_problems(choices, who.where("k % 5 <> 0"), Made(spark, d).sources)
