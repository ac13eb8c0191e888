"""The steward's operators over made-up evidence on the customers, by arithmetic on the key, that SQL can repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators import review, steward
from kinweave.plans.publication import MADE, RUN, Made, customers, made_decisions, made_refused, record
from kinweave.plans.resolution import BASE, guests
from kinweave.runtime import materialize

QUERIES, ORACLE_SQL = {}, {}
WITH = f"WITH RECURSIVE {MADE}"
#: The largest case and the most pairs that are imported here.
RECORDS, PAIRS = 7, 12


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- evidence --------------------------------------------------------------------------------------------
_FLAGS = {  # (modulus, remainders)
    "name_exact": (5, (0,)), "given_name_exact": (4, (0,)), "family_name_exact": (7, (0,)), "valid_dob_exact": (6, (0,)), "valid_dob_contradiction": (6, (1,)), "left_dob_is_default": (6, (2,)), "right_dob_is_default": (12, (2,)),
    "home_address_exact": (8, (0,)), "home_postcode_exact": (2, (0,)), "shared_email_exact": (10, (2,)), "shared_phone_exact": (10, (3,)), "personal_email_disagrees": (11, (0,)), "personal_phone_disagrees": (11, (1,)),
    "company_exact": (17, (0,)), "work_address_exact": (17, (0, 1)), "multilingual_name_pair": (19, (0,))}
_OWN = {"rare_email_exact": (10, (0,)), "rare_phone_exact": (10, (1,))}


def made_evidence(spark, d) -> DataFrame:
    k = F.col("k")
    flags = {n: F.when((k % m).isin(*r), 1).otherwise(0) for n, (m, r) in _FLAGS.items()} | {n: F.when(k % 13 != 0, F.when((k % m).isin(*r), 1).otherwise(0)) for n, (m, r) in _OWN.items()}
    return customers(spark, d).select(
        "k", F.concat(F.lit("case"), F.floor(k / 6).cast("string")).alias("case_id"), record(k).alias("left_record_key"), record(k + 1).alias("right_record_key"),
        F.when(k % 3 == 0, "REVIEW").when(k % 3 == 1, "REJECT").otherwise("AUTO_MATCH").alias("decision"),
        F.when(k % 9 == 0, "AMBIGUOUS_COMMON_NAME_ADDRESS").when(k % 9 == 3, "MADE_UP_RULE").otherwise("INSUFFICIENT_EVIDENCE_REVIEW").alias("rule"),
        ((k * 37 % 100) / 100).alias("match_probability"), ((k * 37 % 100) / 100).alias("evidence_score"), *[v.alias(n) for n, v in flags.items()],
        F.when(k % 3 == 0, 0.95).when(k % 3 == 1, 0.8).alias("name_similarity"), F.when((k % 8).isin(1, 2), 0.92).when(k % 8 == 3, 0.5).alias("address_similarity"),
        F.when(k % 9 == 0, "Missing").when(k % 9 < 5, "Level 1").alias("dob_level"))


_SQL_FLAGS = ", ".join([f"CASE WHEN c_custkey % {m} IN ({', '.join(map(str, r))}) THEN 1 ELSE 0 END AS {n}" for n, (m, r) in _FLAGS.items()]
                       + [f"CASE WHEN c_custkey % 13 <> 0 THEN CASE WHEN c_custkey % {m} IN ({', '.join(map(str, r))}) THEN 1 ELSE 0 END END AS {n}" for n, (m, r) in _OWN.items()])
EVIDENCE = f"""
  ev AS (SELECT c_custkey AS k, concat('case', CAST(c_custkey // 6 AS VARCHAR)) AS case_id, concat('r', CAST(c_custkey AS VARCHAR)) AS l, concat('r',
    CAST(c_custkey + 1 AS VARCHAR)) AS r,
    CASE c_custkey % 3 WHEN 0 THEN 'REVIEW' WHEN 1 THEN 'REJECT' ELSE 'AUTO_MATCH' END AS decision,
    CASE c_custkey % 9 WHEN 0 THEN 'AMBIGUOUS_COMMON_NAME_ADDRESS' WHEN 3 THEN 'MADE_UP_RULE'
      ELSE 'INSUFFICIENT_EVIDENCE_REVIEW' END AS rule, (c_custkey * 37 % 100) / 100.0E0 AS p,
    CASE c_custkey % 3 WHEN 0 THEN 0.95 WHEN 1 THEN 0.8 END AS name_similarity, CASE WHEN c_custkey % 8 IN (1, 2) THEN 0.92
      WHEN c_custkey % 8 = 3 THEN 0.5 END AS address_similarity,
    CASE WHEN c_custkey % 9 = 0 THEN 'Missing' WHEN c_custkey % 9 < 5 THEN 'Level 1' END AS dob_level, {_SQL_FLAGS} FROM customer)"""
_NAME = "CASE WHEN name_exact = 1 THEN {0} WHEN coalesce(name_similarity >= 0.9, false) THEN {1} WHEN given_name_exact = 1 THEN {2} WHEN family_name_exact = 1 THEN {3} END"
_OWN_CONTACT, _OTHERS = "(coalesce(rare_email_exact, 0) = 1 OR coalesce(rare_phone_exact, 0) = 1)", "(shared_email_exact = 1 OR shared_phone_exact = 1)"
FACTS = f"""
  facts AS (SELECT *, list_filter([{_NAME.format("'exact name'", "'close name spelling'", "'given name'", "'family name'")}, CASE
    WHEN valid_dob_exact = 1 THEN 'birth date' END,
      CASE WHEN home_address_exact = 1 THEN 'home address' WHEN coalesce(address_similarity >= 0.9, false) THEN 'similar home address'
        WHEN home_postcode_exact = 1 THEN 'postcode' END,
      CASE WHEN coalesce(rare_email_exact, 0) = 1 THEN 'personal email'
        WHEN coalesce(rare_phone_exact, 0) = 1 THEN 'personal phone' END], lambda x: x IS NOT NULL) AS agrees,
    list_filter([{_NAME.format("NULL", "'NAME_NOT_EXACT'", "'NAME_DIFFERS'", "'NAME_DIFFERS'")},
      CASE WHEN valid_dob_exact = 1 THEN NULL WHEN valid_dob_contradiction = 1 THEN 'DOB_CONFLICT'
        WHEN left_dob_is_default = 1 OR right_dob_is_default = 1 THEN 'DOB_DEFAULT' WHEN dob_level = 'Missing' THEN 'DOB_MISSING'
        WHEN dob_level IS NOT NULL THEN 'DOB_DIFFERS' ELSE 'DOB_UNCONFIRMED' END,
      CASE WHEN {_OWN_CONTACT} THEN NULL WHEN {_OTHERS} THEN 'CONTACT_NOT_PERSONAL' ELSE 'NO_PERSONAL_CONTACT' END,
      CASE WHEN personal_email_disagrees = 1 THEN 'EMAIL_DIFFERS' END, CASE
        WHEN personal_phone_disagrees = 1 THEN 'PHONE_DIFFERS' END], lambda x: x IS NOT NULL) AS gaps FROM ev)"""


@query(f"WITH {EVIDENCE}, {FACTS} SELECT l AS left_record_key, array_to_string(agrees, '|') AS agrees, array_to_string(gaps, '|') AS gaps FROM facts")
def pair_facts(spark, d):
    agrees, gaps = steward.pair_facts()
    return made_evidence(spark, d).select("left_record_key", F.array_join(agrees, "|").alias("agrees"), F.array_join(gaps, "|").alias("gaps"))


_CONTACT = "CASE WHEN coalesce(rare_{0}_exact, 0) = 1 THEN 'Personal {0}=Same, used only by these records=for' WHEN shared_{0}_exact = 1 THEN 'Personal {0}=Same, but also used by other people=info' WHEN personal_{0}_disagrees = 1 THEN 'Personal {0}=Different=against' END"


@query(f"""WITH {EVIDENCE}, contact AS (SELECT *, {_CONTACT.format('email')} AS mail, {_CONTACT.format('phone')} AS tel FROM ev)
  SELECT l AS left_record_key, array_to_string(list_filter([mail, tel, CASE
    WHEN mail IS NULL AND tel IS NULL AND rare_email_exact IS NOT NULL THEN 'Personal contact=No personal email or phone in common=against' END,
    CASE WHEN name_exact = 1 THEN 'Name=Exact=for' WHEN name_similarity IS NOT NULL THEN concat('Name=', concat_ws(', ',
      concat(CAST(CAST(round(name_similarity * 100) AS INT) AS VARCHAR), '% similar'), CASE WHEN given_name_exact = 1 THEN 'given name exact' END,
      CASE WHEN family_name_exact = 1 THEN 'family name exact' END), '=', CASE WHEN name_similarity >= 0.9 THEN 'for'
        ELSE 'info' END) WHEN given_name_exact = 1 THEN 'Name=Given name exact=info'
        WHEN family_name_exact = 1 THEN 'Name=Family name exact=info' END,
    CASE WHEN multilingual_name_pair = 1 THEN 'Name script=Written in different scripts=info' END,
    CASE WHEN valid_dob_exact = 1 THEN 'Birth date=Same=for' WHEN valid_dob_contradiction = 1 THEN 'Birth date=Conflict=against'
      WHEN left_dob_is_default = 1 OR right_dob_is_default = 1 THEN
      concat('Birth date=Source default on ', concat_ws(' and ', CASE WHEN left_dob_is_default = 1 THEN l END, CASE
        WHEN right_dob_is_default = 1 THEN r END), ', ignored=info')
      WHEN dob_level = 'Missing' THEN 'Birth date=Missing on at least one record=info'
        WHEN dob_level IS NOT NULL THEN 'Birth date=Different=against' END,
    CASE WHEN home_address_exact = 1 THEN 'Home address=Same=for'
      WHEN address_similarity > 0 THEN concat('Home address=', CAST(CAST(round(address_similarity * 100) AS INT) AS VARCHAR), '% similar', CASE
      WHEN home_postcode_exact = 1 THEN ', postcode same' ELSE '' END, '=',
      CASE WHEN address_similarity >= 0.9 THEN 'for' ELSE 'info' END) WHEN home_postcode_exact = 1 THEN 'Home address=Postcode same=info' END,
    CASE WHEN company_exact = 1 THEN 'Workplace=Same company, same work address (not personal evidence)=info'
      WHEN work_address_exact = 1 THEN 'Workplace=same work address (not personal evidence)=info' END], lambda x: x IS NOT NULL), '; ') AS checks
      FROM contact""")
def rule_checks(spark, d):
    told = F.transform(steward.rule_checks(), lambda c: F.concat_ws("=", c["check"], c["result"], c["tone"]))
    return made_evidence(spark, d).select("left_record_key", F.array_join(told, "; ").alias("checks"))


def made_links(spark, d) -> DataFrame:
    """Graph links of some cases."""
    k = F.col("k")
    reason = F.when(k % 4 == 0, "COMPONENT_SIZE_LIMIT").when(k % 4 == 1, "COMPONENT_DOB_CONFLICT").otherwise("COMPONENT_CANNOT_LINK")
    return customers(spark, d).where("k % 10 < 4").select(F.concat(F.lit("case"), F.floor(k / 6).cast("string")).alias("case_id"), reason.alias("reason"))


def made_cases(spark, d) -> DataFrame:
    k = F.col("k")
    return customers(spark, d).where("k % 6 = 0").select(
        F.concat(F.lit("case"), F.floor(k / 6).cast("string")).alias("case_id"), F.when(k % 30 == 0, "RESOLVED").when(k % 42 == 0, "DEFERRED").otherwise("REVIEW").alias("status"), (k % 97).alias("imported_at"),
        F.col("c_name").alias("search_text"), F.when(k % 4 == 0, "same").when(k % 9 == 0, "different").otherwise("unclear").alias("lean"), (k % 8).cast("int").alias("difference"))


REASONS = f"""{EVIDENCE}, {FACTS},
  cases AS (SELECT c_custkey AS k, concat('case', CAST(c_custkey // 6 AS VARCHAR)) AS case_id, CASE WHEN c_custkey % 30 = 0 THEN 'RESOLVED'
    WHEN c_custkey % 42 = 0 THEN 'DEFERRED' ELSE 'REVIEW' END AS status, c_custkey % 97 AS imported_at,
    c_name AS search_text, CASE WHEN c_custkey % 4 = 0 THEN 'same' WHEN c_custkey % 9 = 0 THEN 'different'
      ELSE 'unclear' END AS lean, CAST(c_custkey % 8 AS INT) AS difference FROM customer WHERE c_custkey % 6 = 0),
  links AS (SELECT DISTINCT concat('case', CAST(c_custkey // 6 AS VARCHAR)) AS case_id, CASE c_custkey % 4 WHEN 0 THEN 'COMPONENT_SIZE_LIMIT'
    WHEN 1 THEN 'COMPONENT_DOB_CONFLICT' ELSE 'COMPONENT_CANNOT_LINK' END AS code FROM customer WHERE c_custkey % 10 < 4),
  rules AS (SELECT case_id, rule, count(*) AS n, arg_max(gaps, struct_pack(p, l, r)) AS gaps FROM facts WHERE decision = 'REVIEW' GROUP BY 1, 2),
  said AS (SELECT case_id, CASE code WHEN 'COMPONENT_DOB_CONFLICT' THEN 1 WHEN 'COMPONENT_CANNOT_LINK' THEN 2
    ELSE 3 END AS o, 0 AS n, code, CAST([] AS VARCHAR[]) AS gaps FROM links
    UNION ALL SELECT case_id, 9, -n, rule, gaps FROM rules),
  codes AS (SELECT cases.case_id, CASE WHEN count(code) = 0 THEN ['UNSPECIFIED']
    ELSE list_concat(list(code ORDER BY o, n, code), flatten(list(gaps ORDER BY o, n, code))) END AS codes FROM cases
    LEFT JOIN said ON said.case_id = cases.case_id GROUP BY 1)"""


def codes_of(spark, d) -> DataFrame:
    pairs = made_evidence(spark, d).withColumn("gaps", steward.pair_facts()[1])
    return steward.reason_codes(made_cases(spark, d), made_links(spark, d), pairs)


@query(f"WITH {REASONS} SELECT case_id, array_to_string(codes, ',') AS codes FROM codes")
def review_reason_codes(spark, d):
    return codes_of(spark, d).select("case_id", F.array_join("codes", ",").alias("codes"))


_TAGS = " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in (steward.GAP_TAGS | steward.RULE_TAGS | steward.GRAPH_TAGS).items())
QUEUE = f"""{REASONS},
  asked AS (SELECT case_id, min(p) AS pipeline_confidence FROM ev WHERE decision = 'REVIEW' GROUP BY 1),
  named AS (SELECT case_id, codes, list_transform(codes, lambda c: CASE c {_TAGS} ELSE 'Resolver review' END) AS t FROM codes),
  queue AS (SELECT cases.*, pipeline_confidence, CASE WHEN pipeline_confidence IS NULL THEN 'evidence_score'
    ELSE 'match_probability' END AS confidence_kind, codes,
      list_filter(t, lambda x, i: list_position(t, x) = i)[1:2] AS tags
    FROM cases LEFT JOIN asked ON asked.case_id = cases.case_id LEFT JOIN named ON named.case_id = cases.case_id)"""


def queue_of(spark, d) -> DataFrame:
    return steward.queue_rows(made_cases(spark, d), made_evidence(spark, d), codes_of(spark, d))


@query(f"WITH {QUEUE} SELECT case_id, status, pipeline_confidence, confidence_kind, array_to_string(codes, ',') AS review_codes, array_to_string(tags, ',') AS tags FROM queue")
def queue_rows(spark, d):
    return queue_of(spark, d).select("case_id", "status", "pipeline_confidence", "confidence_kind", F.array_join("review_codes", ",").alias("review_codes"), F.array_join("tags", ",").alias("tags"))


@query(f"WITH {QUEUE} SELECT case_id, pipeline_confidence FROM queue WHERE status = 'REVIEW' AND contains(lower(search_text), '0') AND lean = 'unclear' ORDER BY pipeline_confidence DESC NULLS LAST, case_id OFFSET 10 LIMIT 25")
def queue_page(spark, d):
    """The second page, by confidence, of a search: a page is the feature."""
    return steward.queue_page(queue_of(spark, d), "REVIEW", "confidence", " 0 ", "unclear", 10, 25).select("case_id", "pipeline_confidence")


@query(f"WITH {QUEUE} SELECT lean, count(*) AS cases FROM queue WHERE status = 'REVIEW' GROUP BY 1 UNION ALL SELECT 'all', count(*) FROM queue WHERE status = 'REVIEW'")
def queue_lean_counts(spark, d):
    return steward.lean_counts(queue_of(spark, d), "REVIEW")


@query(f"""WITH {QUEUE} SELECT concat('run', CAST(max(n_nationkey) FILTER (WHERE n_nationkey = 7) AS VARCHAR)) AS source_run_id,
      count(*) FILTER (WHERE n_nationkey <> 7) AS archived_releases,
  any_value((SELECT count(*) FROM queue WHERE status = 'REVIEW')) AS review_cases, any_value((SELECT count(*)
    FROM queue WHERE status = 'RESOLVED')) AS resolved_cases, any_value((SELECT count(*) FROM queue WHERE status = 'DEFERRED')) AS deferred_cases
    FROM nation""")
def review_summary(spark, d):
    releases = spark.read.parquet(f"{d}/nation.parquet").select(F.concat(F.lit("run"), F.col("n_nationkey").cast("string")).alias("source_run_id"), (F.col("n_nationkey") == 7).alias("active"), F.col("n_nationkey").alias("created_at"))
    return steward.summary(made_cases(spark, d), releases)


@query(f"""WITH {EVIDENCE}, ranked AS (SELECT case_id, l, row_number() OVER (PARTITION BY case_id ORDER BY CASE WHEN decision = 'REVIEW' THEN 0
      ELSE 1 END, p, l, r) AS rank FROM ev)
  SELECT case_id, l AS left_record_key, rank FROM ranked WHERE rank <= 4""")
def pairs_in_full(spark, d):
    return steward.full_detail(made_evidence(spark, d), 4).select("case_id", "left_record_key", F.col("rank").cast("long").alias("rank"))


# --- checks and adapters ---------------------------------------------------------------------------------
@query("""SELECT unnest([concat('sources: columns that look like answers: Scenario_x, truth_id'), concat('sources: ', count(*),
      ' rows, the manifest declares ', count(*) + 1), 'sources: required columns missing: source_system',
  'decisions: the version is not in the table''s history']) AS problem FROM customer""")
def preflight_report(spark, d):
    c = customers(spark, d)
    sources = c.select(record(F.col("k")).alias("record_key"), F.lit(1).alias("truth_id"), F.lit(1).alias("Scenario_x"))
    mapping = sources.select("record_key", F.lit(RUN).alias("resolution_run_id")).union(c.limit(9).select("c_name", F.lit("other")))
    n = c.count()
    found = steward.preflight({"sources": (sources, n + 1), "mappings": (mapping, n), "decisions": (None, 1)}, {"sources": ("record_key", "source_system"), "mappings": ("record_key",), "decisions": ()}, RUN)
    return spark.createDataFrame([(p,) for p in found], "problem string")


@query("""SELECT * FROM (VALUES ('model', 'read', 'match_probability'), ('model', 'read', 'decision_reason'), ('model', 'read', 'bf_name_n'), ('model',
      'read', 'bf_tf_adj_name_n'), ('model', 'read', 'gamma_name_n'), ('model', 'null', 'name_similarity'),
  ('rule_features', 'none', NULL)) t(profile, kind, name)""")
def evidence_profiles(spark, d):
    profile, read, null = steward.evidence_profile(["left_record_key", "match_probability", "decision_reason", "bf_name_n", "bf_tf_adj_name_n", "gamma_name_n", "name_exact"], ("name_exact", "name_similarity", "valid_dob_exact"))
    plain = steward.evidence_profile(["left_record_key", "name_exact"], ("name_exact", "name_similarity"))
    rows = [(profile, "read", c) for c in read] + [(profile, "null", c) for c in null] + [(plain[0], "none", None)]
    return spark.createDataFrame(rows, "profile string, kind string, name string")


_LINE = "nullif(concat_ws(', ', {})".format(", ".join(f"nullif(trim({{0}}_{c}), '')" for c in ("address_line1", "suburb", "state", "postcode", "country"))) + ", '')"


@query(f"""WITH {BASE} SELECT record_key, source_system, source_record_id, full_name AS name, personal_email AS email,
      CAST(date_of_birth AS VARCHAR) AS date_of_birth, company_name, {_LINE.format('home')} AS address, {_LINE.format('work')} AS work_address
      FROM contacts""")
def adapted_records(spark, d):
    return steward.adapt_records(guests(spark, d)).select("record_key", "source_system", "source_record_id", "name", "email", "date_of_birth", "company_name", "address", "work_address")


_FAULTS = ("left_dob_is_default", "right_dob_is_default", "valid_dob_exact", "valid_dob_contradiction", "name_exact")


@query(f"""WITH {EVIDENCE}, faulty AS (SELECT *, CASE WHEN k % 31 = 0 THEN 'other' ELSE '{RUN}' END AS run, CASE WHEN k % 29 = 0 THEN 2
      ELSE name_exact END AS flag, CASE WHEN k % 23 = 0 THEN NULL ELSE valid_dob_exact END AS same, CASE WHEN k % 6 = 1 AND k % 4 = 1 THEN 1
      ELSE left_dob_is_default END AS ld FROM ev)
  SELECT l AS left_record_key, CASE WHEN run = 'other' THEN 'another run''s evidence' WHEN NOT l < r THEN 'keys are not canonical'
    WHEN flag = 2 THEN 'a flag that is neither 0 nor 1' WHEN k % 37 = 0 THEN 'a similarity that is no number'
    WHEN same IS NULL THEN 'flags on birth dates are missing'
    WHEN valid_dob_contradiction = 1 AND (ld = 1 OR right_dob_is_default = 1 OR same = 1) THEN 'flags on birth dates contradict'
      WHEN k % 41 = 0 THEN 'no score' END AS problem FROM faulty""")
def pair_problems(spark, d):
    k = F.col("k")
    e = made_evidence(spark, d).withColumns({
        "resolution_run_id": F.when(k % 31 == 0, "other").otherwise(RUN), "name_exact": F.when(k % 29 == 0, 2).otherwise(F.col("name_exact")), "valid_dob_exact": F.when(k % 23 != 0, F.col("valid_dob_exact")),
        "left_dob_is_default": F.when((k % 6 == 1) & (k % 4 == 1), 1).otherwise(F.col("left_dob_is_default")), "name_similarity": F.when(k % 37 == 0, float("nan")).otherwise(F.col("name_similarity")), "evidence_score": F.when(k % 41 != 0, F.col("evidence_score"))})
    return e.select("left_record_key", steward.pair_problem(_FAULTS, ("name_similarity", "address_similarity"), RUN).alias("problem"))


@query("""WITH g AS (SELECT c_custkey AS k, CAST(c_custkey % 6 - 1 AS INT) AS gamma, CASE WHEN c_custkey % 2 = 0 THEN 'name_n'
      ELSE 'dob_usable' END AS comparison FROM customer)
  SELECT k, CASE WHEN gamma = -1 THEN 'Missing' WHEN gamma = 0 THEN 'Different' WHEN comparison = 'dob_usable' THEN CASE
    WHEN gamma = 1 THEN 'Exact' END
    WHEN gamma = 1 THEN 'Similar spelling (75%+ similar)' WHEN gamma = 2 THEN 'Close spelling (90%+ similar)' WHEN gamma = 3 THEN 'Exact' END AS label
      FROM g""")
def level_labels(spark, d):
    comparison = F.when(F.col("k") % 2 == 0, "name_n").otherwise("dob_usable")
    return customers(spark, d).select("k", steward.level_label(comparison, (F.col("k") % 6 - 1).cast("int"))["label"].alias("label"))


def made_weights(spark, d) -> DataFrame:
    k = F.col("k")
    weight = lambda i: F.struct(F.lit(f"c{i}").alias("comparison"), ((k * (i + 3)) % 19 - 9).cast("double").alias("weight"))
    return customers(spark, d).select("k", F.concat(F.lit("case"), F.floor(k / 6).cast("string")).alias("case_id"), F.array(*map(weight, range(3))).alias("weights"), ((k % 11) - 4).cast("double").alias("match_weight"))


_W = ["(c_custkey * 3) % 19 - 9", "(c_custkey * 4) % 19 - 9", "(c_custkey * 5) % 19 - 9"]


@query(f"""WITH w AS (SELECT c_custkey AS k, CAST(c_custkey % 11 - 4 AS DOUBLE) AS m, CAST({_W[0]} AS DOUBLE) AS a, CAST({_W[1]} AS DOUBLE) AS b,
      CAST({_W[2]} AS DOUBLE) AS c FROM customer),
  scales AS (SELECT k // 6 AS cs, greatest(1.0, max(greatest(abs(a), abs(b), abs(c)))) AS scale FROM w GROUP BY 1)
  SELECT k, m - a - b - c AS prior, m - b - c AS first, m - c AS second, m AS third, scale FROM w JOIN scales ON cs = k // 6""")
def weight_traces(spark, d):
    w = made_weights(spark, d)
    traced = w.withColumn("t", steward.weight_trace(F.col("weights"), F.col("match_weight"))).join(steward.weight_scale(w), "case_id")
    return traced.select("k", "t.prior", *[F.col("t.running")[i].alias(n) for i, n in enumerate(("first", "second", "third"))], "scale")


# --- cases and graph links -------------------------------------------------------------------------------
FORMED = f"""{WITH},
  own AS (SELECT component, min(record_key) AS own, max(CAST(cluster_requires_review AS INT)) = 1 AS seed, count(*) AS n FROM oper GROUP BY 1),
  between2 AS (SELECT x.own AS a, y.own AS b, bool_or(x.seed) AS sa, bool_or(y.seed) AS sb, count(*) AS pairs,
    count(*) FILTER (WHERE decision = 'REVIEW') AS asked FROM raw
    JOIN dec ON dec.k = raw.k AND dec.n = raw.n JOIN own x ON x.component = raw.xc JOIN own y ON y.component = raw.yc GROUP BY 1, 2),
  tie AS (SELECT a, b FROM between2 WHERE asked > 0 AND a <> b AND (sa OR sb)),
  both2 AS (SELECT a, b FROM tie UNION SELECT b, a FROM tie),
  start_nodes AS (SELECT own AS node FROM own WHERE seed UNION SELECT a FROM both2),
  roots(node, root) USING KEY (node) AS (
    SELECT node, node FROM start_nodes
    UNION (SELECT DISTINCT ON (one.node) one.node, other.root FROM recurring.roots AS one JOIN both2 ON both2.a = one.node
      JOIN roots AS other ON other.node = both2.b WHERE other.root < one.root ORDER BY one.node, other.root)),
  people AS (SELECT root, record_key, customer_id FROM oper JOIN own ON own.component = oper.component JOIN roots ON node = own.own),
  counts AS (SELECT root, count(*) AS records, list(record_key ORDER BY record_key) AS keys FROM people GROUP BY 1),
  held2 AS (SELECT x.root, sum(pairs) AS pairs, sum(asked) AS review_pairs FROM between2 JOIN roots x ON x.node = a
    JOIN roots y ON y.node = b WHERE x.root = y.root GROUP BY 1),
  formed AS (SELECT counts.root, records, CAST(coalesce(pairs, 0) AS BIGINT) AS pairs, CAST(coalesce(review_pairs, 0) AS BIGINT) AS review_pairs,
    records > {RECORDS} OR coalesce(pairs, 0) > {PAIRS} AS oversized, keys FROM counts LEFT JOIN held2 ON held2.root = counts.root),
  ready AS (SELECT *, CASE WHEN NOT oversized THEN concat('review-',
    substring(sha256(concat('{{"records":["', array_to_string(keys, '","'), '"],"run":"{RUN}"}}')), 1, 32)) END AS case_id FROM formed)"""


def formed(spark, d) -> tuple[Made, DataFrame, DataFrame]:
    made = Made(spark, d)
    cases, members = steward.form_cases(RUN, made.operational, made.decisions, RECORDS, PAIRS)
    return made, cases, members


@query(f"{FORMED} SELECT case_id, root, records, pairs, review_pairs, oversized FROM ready")
def case_formation(spark, d):
    return formed(spark, d)[1]


def links_at_cases(spark, d) -> DataFrame:
    made, cases, members = formed(spark, d)
    cases = materialize(cases, "cases")
    placed = members.join(cases.where("NOT oversized").select("root", "case_id"), "root").select("case_id", "record_key")
    late = members.join(cases.where("oversized").select("root"), "root", "left_semi").select("record_key").union(made.mapping.join(made.deferred.select("component"), "component", "left_semi").select("record_key"))
    # a record of a deferred component may have come into a case
    return steward.graph_links(steward.withheld_links(made.refused, made.decisions), placed, late)


LINKED = f"""{FORMED},
  place AS (SELECT people.record_key, case_id FROM people JOIN ready ON ready.root = people.root WHERE NOT oversized),
  late AS (SELECT people.record_key FROM people JOIN ready ON ready.root = people.root WHERE oversized UNION SELECT record_key FROM m
    JOIN deferred ON deferred.component = m.component),
  sides AS (SELECT l AS x, r AS y, p FROM refused UNION ALL SELECT r, l, p FROM refused),
  linked AS (SELECT h.case_id, x AS record_key, y AS other_record_key, 'COMPONENT_SIZE_LIMIT' AS reason, p AS match_probability,
    t.case_id AS other_case_id, y IN (SELECT record_key FROM late) AS other_deferred
    FROM sides JOIN place h ON h.record_key = x LEFT JOIN place t ON t.record_key = y)"""


@query(f"{LINKED} SELECT * FROM linked")
def graph_links(spark, d):
    return links_at_cases(spark, d)


@query(f"{LINKED} SELECT reason, count(*) AS ends, count(DISTINCT case_id) AS cases, count(*) FILTER (WHERE case_id = other_case_id) AS within_one_case, count(*) FILTER (WHERE other_deferred) AS to_deferred FROM linked GROUP BY 1")
def graph_link_summary(spark, d):
    return steward.link_summary(links_at_cases(spark, d))


@query(f"{WITH} SELECT l AS left_record_key, r AS right_record_key, 'COMPONENT_SIZE_LIMIT' AS reason, p AS match_probability FROM refused")
def withheld_links(spark, d):
    decisions = made_decisions(spark, d)
    return steward.withheld_links(made_refused(decisions), decisions)


# --- decisions -------------------------------------------------------------------------------------------
LOG = "request_id string, case_id string, applied_case_version int, action string, groups array<array<string>>, actor string, mode string"


def made_requests(spark, d) -> tuple[DataFrame, DataFrame]:
    """(imported cases of three records, requests on them, with every kind of fault by arithmetic)."""
    k = F.col("k")
    c = customers(spark, d).where("k % 3 = 0")
    case, keys = F.concat(F.lit("case"), k.cast("string")), F.array(record(k), record(k + 1), record(k + 2))
    single = F.transform(keys, lambda x: F.array(x))
    cases = c.select(case.alias("case_id"), single.alias("groups"), F.lit("f").alias("fingerprint"))
    n = k / 3 % 11
    groups = F.when(n == 0, F.array(keys)).when(n == 1, F.array(F.slice(keys, 1, 2))).when(n == 2, F.array(keys, F.array().cast("array<string>"))).otherwise(F.array(F.slice(keys, 1, 1), F.slice(keys, 2, 2)))
    groups = F.when(n == 9, single).otherwise(groups)
    asked = c.withColumn("t", F.explode(F.array(F.lit("a"), F.lit("b")))).where("t = 'a' OR k % 2 = 0").select(
        F.concat(F.lit("q"), F.col("t"), k.cast("string")).alias("request_id"), case.alias("case_id"), F.when(n == 3, 5).otherwise(1).alias("case_version"), F.when(n == 4, "g").otherwise("f").alias("evidence_fingerprint"),
        F.when(n == 0, "MERGE").when(n == 5, "MERGE").when(n == 6, "SEPARATE").when(n == 9, "DEFER").when(n == 10, "OTHER").otherwise("PARTITION").alias("action"), groups.alias("groups"),
        F.when(n == 7, " ").otherwise("because").alias("rationale"), F.lit("someone").alias("actor"), F.when(n == 8, "auto").otherwise("manual").alias("mode"), F.lit("human").alias("origin"), F.lit(None).cast("string").alias("trace_id"),
        F.lit("x").alias("confirmed_digest"), F.when(k % 39 == 0, "y").otherwise("x").alias("confirmation_digest"))
    return cases, asked


OUTCOMES = """
  req AS (SELECT c_custkey AS k, c_custkey // 3 % 11 AS n, concat('q', t, CAST(c_custkey AS VARCHAR)) AS request_id, concat('case',
    CAST(c_custkey AS VARCHAR)) AS case_id, t FROM customer, (VALUES ('a'), ('b')) v(t) WHERE c_custkey % 3 = 0 AND (t = 'a' OR c_custkey % 2 = 0)),
  judged AS (SELECT *, CASE WHEN k % 39 = 0 AND n <> 8 THEN 'not what was confirmed' WHEN n = 3 THEN 'the case has changed'
    WHEN n = 4 THEN 'the evidence has changed' WHEN n = 7 THEN 'a rationale and an actor are needed'
    WHEN n = 8 THEN 'only a traced agent''s proposal is applied by itself'
    WHEN n = 10 THEN 'no such action' WHEN n = 9 THEN NULL WHEN n IN (1, 2) THEN 'not every record exactly once'
      WHEN n = 5 THEN 'a merge has one group' WHEN n = 6 THEN 'a separation has single records' END AS refused FROM req),
  outcomes AS (SELECT *, coalesce(refused, CASE WHEN t = 'a' THEN 'applied' ELSE 'the case has changed' END) AS outcome FROM judged)"""


def decided(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    cases, asked = made_requests(spark, d)
    empty = spark.createDataFrame([], LOG)
    return cases, asked, materialize(steward.apply_requests(asked, steward.case_states(cases, empty), empty), "log")


@query(f"WITH {OUTCOMES} SELECT request_id, outcome FROM outcomes")
def decision_outcomes(spark, d):
    cases, asked = made_requests(spark, d)
    empty = spark.createDataFrame([], LOG)
    return steward.judge_requests(asked, steward.case_states(cases, empty), empty).select("request_id", "outcome")


@query(f"WITH {OUTCOMES} SELECT CASE WHEN outcome = 'applied' THEN 'replayed' ELSE outcome END AS outcome, count(*) AS requests FROM (SELECT CASE WHEN refused IS NULL AND t = 'b' THEN 'the case has changed' ELSE outcome END AS outcome FROM outcomes) x GROUP BY 1")
def decision_replay(spark, d):
    """The same requests again: what was applied is replayed, and the log stays as it is."""
    cases, asked, log = decided(spark, d)
    again = steward.judge_requests(asked, steward.case_states(cases, log), log)
    # what was refused before is refused again, perhaps since the case has moved on
    first = steward.judge_requests(asked, steward.case_states(cases, log.where("false")), log.where("false")).select("request_id", F.col("outcome").alias("before"))
    told = F.when(F.col("before") == "applied", F.col("outcome")).otherwise(F.col("before"))
    assert steward.apply_requests(asked, steward.case_states(cases, log), log).count() == log.count()
    return again.join(first, "request_id").groupBy(told.alias("outcome")).agg(F.count(F.lit(1)).alias("requests"))


@query(f"""WITH {OUTCOMES} SELECT concat('case', CAST(c_custkey AS VARCHAR)) AS case_id, CASE WHEN outcome IS NULL THEN 'REVIEW' WHEN n = 9 THEN 'DEFERRED'
      ELSE 'RESOLVED' END AS status, CASE WHEN outcome IS NULL THEN 1 ELSE 2 END AS version,
    CASE WHEN outcome IS NULL OR n = 9 THEN 'SEPARATE' WHEN n = 0 THEN 'MERGE' ELSE 'PARTITION' END AS shape
  FROM customer LEFT JOIN outcomes ON k = c_custkey AND outcome = 'applied' WHERE c_custkey % 3 = 0""")
def case_states(spark, d):
    cases, _, log = decided(spark, d)
    return steward.case_states(cases, log).select("case_id", "status", "version", steward.action_of(F.col("groups")).alias("shape"))


@query("SELECT true AS copies_agree, true AS other_rows_differ, count(*) AS rows FROM customer")
def archive_digest(spark, d):
    c = customers(spark, d)
    one, two, other = (steward.content_digest(x, ["c_custkey"]).first() for x in (c, c.repartition(5), c.where("k > 1")))
    return spark.createDataFrame([(one == two, one.digest != other.digest, one.rows)], "copies_agree boolean, other_rows_differ boolean, rows long")


# --- smaller things --------------------------------------------------------------------------------------
@query("""WITH s AS (SELECT c_custkey // 4 AS cs, count(*) AS records, count(DISTINCT c_nationkey) > 1 AS emails,
      count(DISTINCT c_mktsegment) > 1 AS birth_dates, count(DISTINCT c_custkey % 2) > 1 AS first_names FROM customer GROUP BY 1),
  g AS (SELECT c_custkey // 4 AS cs, max(CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END) = 1 AS cannot_link, max(CASE WHEN c_custkey % 5 = 1 THEN 1
    ELSE 0 END) = 1 AS graph_dob FROM customer WHERE c_custkey % 5 < 2 GROUP BY 1),
  r AS (SELECT c_custkey // 4 AS cs, min((c_custkey % 100) / 100.0E0) AS lowest_probability, count(*) AS review_pairs
    FROM customer WHERE c_custkey % 3 = 0 GROUP BY 1)
  SELECT s.cs AS case_id, records, emails, birth_dates, first_names, cannot_link, graph_dob, lowest_probability, review_pairs FROM s
    LEFT JOIN g ON g.cs = s.cs LEFT JOIN r ON r.cs = s.cs""")
def case_signals(spark, d):
    k = F.col("k")
    c = customers(spark, d)
    members = c.select(F.floor(k / 4).alias("case_id"), record(k).alias("record_key"), F.col("c_nationkey").alias("email_n"), F.col("c_mktsegment").alias("dob_usable"), (k % 2).alias("given_key"))
    refused = c.where("k % 5 < 2").select(record(k).alias("left_record_key"), F.when(k % 5 == 0, "COMPONENT_CANNOT_LINK").otherwise("COMPONENT_DOB_CONFLICT").alias("reason"))
    return review.case_signals(members, refused, c.where("k % 3 = 0").select(record(k).alias("left_record_key"), ((k % 100) / 100).alias("match_probability")))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN '[masked]' END AS full_name, c_mktsegment, CASE WHEN p > 0.999 THEN '>99.9%'
      ELSE concat(printf('%.1f', p * 100), '%') END AS said,
  CASE WHEN c_custkey % 3 > 0 THEN 'compared' WHEN c_custkey % 2 = 0 OR c_custkey % 5 = 0 THEN 'excluded' ELSE 'no value' END AS fact
    FROM (SELECT *, CASE WHEN c_custkey % 10 = 0 THEN 0.9995E0 ELSE (c_custkey % 100) / 100.0E0 END AS p FROM customer) x""")
def shown_to_stewards(spark, d):
    """Masked fields, probabilities as text, and why a comparison is missing."""
    k = F.col("c_custkey")
    c = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.when(k % 4 != 0, F.col("c_name")).alias("full_name"), "c_mktsegment")
    p = F.when(k % 10 == 0, 0.9995).otherwise((k % 100) / 100)
    return review.masked(c).withColumns({"said": review.probability_text(p), "fact": review.record_facts(k % 2 == 0, F.when(k % 5 == 0, True), (k % 3 - 1).cast("int"))})


@query("""SELECT c_custkey // 3 AS g, CASE WHEN bool_or(c_custkey % 3 = 1 AND c_custkey % 4 <> 0) THEN max(c_name) FILTER (WHERE c_custkey % 3 = 1)
      ELSE arg_min(c_name, c_custkey) FILTER (WHERE c_custkey % 4 <> 0) END AS picked FROM customer GROUP BY 1""")
def golden_default(spark, d):
    k = F.col("k")
    held = customers(spark, d).groupBy(F.floor(k / 3).alias("g")).agg(F.array_sort(F.collect_list(F.struct("k", F.struct(record(k).alias("record_key"), F.when(k % 4 != 0, F.col("c_name")).otherwise(" ").alias("value")).alias("m")))).alias("x"))
    return held.select("g", review.golden_default(record(F.col("g") * 3 + 1), F.transform("x", lambda e: e["m"])).alias("picked"))
