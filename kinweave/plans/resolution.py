"""Entity resolution queries over the guest table drawn from the plain tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions import policy
from kinweave.functions.text import similarity
from kinweave.operators import blocking, golden, graph, matching, profile, review, vectors
from kinweave.runtime import discard, materialize, staged
from kinweave.sources.guests import guest_records, guest_sql, snapshot

QUERIES, ORACLE_SQL = {}, {}
TODAY = "2026-01-01"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- DuckDB statements of the stages, written on their own -------------------------------------
def _text(x: str) -> str:
    return rf"nullif(trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9_\s]', ' ', 'g'), '\s+', ' ', 'g')), '')"


def _address(x: str) -> str:
    out = _text(x)
    for long, short in (("street", "st"), ("road", "rd"), ("avenue", "ave"), ("lane", "ln"), ("drive", "dr"), ("court", "ct"), ("apartment", "unit")):
        out = rf"regexp_replace({out}, '\b{long}\b', '{short}', 'g')"
    return out


def _email(x: str) -> str:
    v = f"lower(trim({x}))"
    return rf"""CASE WHEN regexp_matches({v}, '^[^@\s]+@[^@\s]+\.[^@\s]+$')
      AND NOT regexp_matches(split_part({v}, '@', 1), '^(noreply|noemail|unknown|guest|test)([+._-]|$)')
      THEN CASE WHEN split_part({v}, '@', 2) IN ('gmail.com', 'googlemail.com') THEN concat(replace(split_part(split_part({v}, '@', 1), '+', 1), '.',
        ''), '@gmail.com') ELSE {v} END END"""


def _phone(x: str) -> str:
    m = f"regexp_replace(trim({x}), '[^0-9+]', '', 'g')"
    full = f"CASE WHEN {m} LIKE '+%' THEN substring({m}, 2) WHEN {m} LIKE '00%' THEN substring({m}, 3) WHEN {m} LIKE '0%' THEN concat('61', substring({m}, 2)) ELSE concat('61', {m}) END"
    return f"CASE WHEN {m} <> '' AND length({full}) BETWEEN 8 AND 15 THEN concat('+', {full}) END"


def _swap(a: str, b: str) -> str:
    return f"(year({a}) = year({b}) AND month({a}) = day({b}) AND day({a}) = month({b}))"


BASE = f"""guests AS ({guest_sql('VARCHAR')}),
contacts AS (SELECT *, sha256(concat(source_system, '|', source_record_id)) AS record_key, {_text('full_name')} AS name_n,
  {_text('given_name')} AS given_name_n, {_text('family_name')} AS family_name_n,
  split_part({_text('given_name')}, ' ', 1) AS given_key, {_email('personal_email')} AS email_n, {_email('work_email')} AS work_email_n,
    {_phone('personal_phone')} AS phone_n, {_phone('work_phone')} AS work_phone_n,
  {_address('home_address_line1')} AS home_address_n, {_address('work_address_line1')} AS work_address_n, nullif(trim(home_postcode),
    '') AS postcode_n FROM guests),
defaults AS (SELECT source_system AS ds, date_of_birth AS dd, count(*) AS records, count(*) * 1.0E0 / any_value(n) AS share
  FROM contacts JOIN (SELECT source_system AS s, count(*) AS n
    FROM contacts GROUP BY 1) t ON s = source_system WHERE date_of_birth IS NOT NULL
    GROUP BY 1, 2 HAVING count(*) >= 25 AND count(*) * 1.0E0 / any_value(n) >= 0.005),
base AS (SELECT contacts.*, ds IS NOT NULL AS dob_is_source_default, CASE
  WHEN ds IS NULL AND date_of_birth BETWEEN DATE '1900-01-01' AND DATE '{TODAY}' THEN date_of_birth END AS dob_usable,
  CASE source_system WHEN 'sevenrooms' THEN 10 WHEN 'momentus' THEN 20 WHEN 'me_and_u' THEN 30 ELSE 40 END AS source_priority
  FROM contacts LEFT JOIN defaults ON ds = source_system AND dd = date_of_birth)"""
PREVALENCE = f"""{BASE},
long AS (SELECT 'email' AS kind, email_n AS value, name_n, given_key, family_name_n, dob_usable FROM base WHERE email_n IS NOT NULL UNION ALL
  SELECT 'phone', phone_n, name_n, given_key, family_name_n, dob_usable FROM base WHERE phone_n IS NOT NULL),
days AS (SELECT DISTINCT kind, value, dob_usable AS d FROM long WHERE dob_usable IS NOT NULL),
clash AS (SELECT a.kind AS ck, a.value AS cv, sum(CASE WHEN {_swap('a.d', 'b.d')} THEN 0 ELSE 1 END) AS n FROM days a
  JOIN days b ON a.kind = b.kind AND a.value = b.value AND a.d < b.d GROUP BY 1, 2),
prevalence AS (SELECT kind, value, record_count, name_count, given_name_count, family_name_count, dob_count, CAST(coalesce(n,
  0) AS BIGINT) AS incompatible_dob_pairs
  FROM (SELECT kind, value, count(*) AS record_count, count(DISTINCT name_n) AS name_count, count(DISTINCT given_key) AS given_name_count,
    count(DISTINCT family_name_n) AS family_name_count, count(DISTINCT dob_usable) AS dob_count FROM long GROUP BY 1, 2) p
  LEFT JOIN clash ON ck = kind AND cv = value),
shared AS (SELECT *, incompatible_dob_pairs > 0 OR (kind = 'email'
  AND regexp_matches(value, '^(events|info|bookings|reservations|admin|office|reception)@')) AS is_shared FROM prevalence),
records AS (SELECT base.*, coalesce(e.is_shared, false) AS email_is_shared, coalesce(p.is_shared, false) AS phone_is_shared, CASE
  WHEN NOT e.is_shared THEN email_n END AS personal_email_n, CASE WHEN NOT p.is_shared THEN phone_n END AS personal_phone_n,
  e.record_count AS email_record_count, p.record_count AS phone_record_count, e.given_name_count AS email_given_names,
    p.given_name_count AS phone_given_names
  FROM base LEFT JOIN shared e ON e.kind = 'email' AND e.value = email_n LEFT JOIN shared p ON p.kind = 'phone' AND p.value = phone_n)"""
_KEYS = (("email_n", "PERSONAL_EMAIL"), ("phone_n", "PERSONAL_PHONE"), ("work_email_n", "WORK_EMAIL"), ("work_phone_n", "WORK_PHONE"), ("home_address_n", "HOME_ADDRESS"), ("work_address_n", "WORK_ADDRESS"),
         ("family_name_n || '|' || CAST(dob_usable AS VARCHAR)", "FAMILY_DOB"), ("family_name_n || '|' || substring(given_name_n, 1, 1) || '|' || postcode_n", "FAMILY_INITIAL_POSTCODE"), ("right(phone_n, 6)", "PHONE_SUFFIX"))
BLOCKS = f"""{PREVALENCE},
k0 AS ({' UNION ALL '.join(f"SELECT record_key, source_system, family_name_n, substring(given_name_n, 1, 1) AS initial, '{r}' AS reason, {e} AS block FROM base" for e, r in _KEYS)}),
k1 AS (SELECT *, count(*) OVER (PARTITION BY reason, block) AS original_block_size FROM k0 WHERE block IS NOT NULL),
k2 AS (SELECT record_key, source_system, family_name_n, initial, reason, CASE WHEN original_block_size <= 50 THEN block
  ELSE block || '#' || family_name_n END AS block, original_block_size FROM k1),
k3 AS (SELECT *, count(*) OVER (PARTITION BY reason, block) AS refined FROM k2 WHERE block IS NOT NULL),
k4 AS (SELECT record_key, source_system, reason, CASE WHEN refined <= 50 THEN block ELSE block || '#' || initial END AS block, original_block_size
  FROM k3),
blocks AS (SELECT *, count(*) OVER (PARTITION BY reason, block) AS block_size FROM k4 WHERE block IS NOT NULL)"""
PAIRS = f"""{BLOCKS},
hits AS (SELECT DISTINCT a.record_key AS l, b.record_key AS r, a.reason, CASE WHEN a.source_system = b.source_system THEN 'WITHIN_SOURCE'
  ELSE 'CROSS_SOURCE' END AS scope
  FROM blocks a JOIN blocks b ON a.reason = b.reason AND a.block = b.block AND a.record_key < b.record_key WHERE a.block_size BETWEEN 2 AND 50),
pairs AS (SELECT l, r, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reasons, string_agg(DISTINCT scope, ',' ORDER BY scope) AS scopes
  FROM hits GROUP BY l, r)"""


def _gamma(c: str, cuts: tuple[float, ...]) -> str:
    sim = f"1 - levenshtein(a.{c}, b.{c}) * 1.0E0 / greatest(length(a.{c}), length(b.{c}), 1)"
    steps = " ".join(f"WHEN {sim} >= {cut} THEN {len(cuts) - i}" for i, cut in enumerate(cuts))
    return f"CASE WHEN a.{c} IS NULL OR b.{c} IS NULL THEN -1 WHEN a.{c} = b.{c} THEN {len(cuts) + 1} {steps} ELSE 0 END AS gamma_{c}"


GAMMAS = f"""{PAIRS},
compared AS (SELECT l, r, {', '.join(_gamma(c, cuts) for c, cuts in matching.COMPARISONS.items())}, a.name_n AS nl, a.home_address_n AS hl,
  a.personal_email_n AS el, a.personal_phone_n AS pl
  FROM pairs JOIN records a ON a.record_key = l JOIN records b ON b.record_key = r)"""


# --- stages --------------------------------------------------------------------------------------
def guests(spark: SparkSession, d: str) -> DataFrame:
    return snapshot(guest_records(spark, d))


#: Columns that blocking reads, and those that the comparisons and the features read beside them.
BLOCKED = ("record_key", "source_system", "given_name_n", "family_name_n", "email_n", "phone_n", "work_email_n", "work_phone_n", "home_address_n", "work_address_n", "postcode_n", "dob_usable")
RESOLVED = (*BLOCKED, "name_n", "given_key", "dob_is_source_default")
#: What profiles take their values from, and the counts of shared contacts.
GOLDEN = ("record_key", "source_system", "source_updated_at", "source_priority", "full_name", "given_name", "family_name", "company_name", "name_n", "given_key", "family_name_n", "dob_usable",
          "email_n", "phone_n", "work_email_n", "work_phone_n", "home_address_n", "work_address_n", *[f"{kind}_{c}" for kind in ("home", "work") for c in golden.ADDRESS.values()])


def base_of(spark, d, columns: tuple[str, ...] = (), packed: bool = False) -> DataFrame:
    """``contact_base`` as a stage table, as what follows reads it several times: all of it, or some columns.

    ``packed``: keys as bytes, which take half the room and have the same order as their digits.
    """
    base = profile.resolved_base(guests(spark, d), TODAY)
    base = base.select(*columns) if columns else base
    return materialize(base.withColumn("record_key", F.unhex("record_key")) if packed else base, "base")


def records_of(spark, d, columns: tuple[str, ...] = (), packed: bool = False) -> DataFrame:
    base = base_of(spark, d, columns, packed)
    records = materialize(profile.contact_records(base, profile.prevalence(base)), "records")
    discard(base)
    return records


def numbered(records: DataFrame) -> DataFrame:
    """``records`` with the key as ``key`` and its first 8 bytes as ``record_key``, a number with the order of the keys; the
    whole key if two records have the same number."""
    digits = F.hex(F.substring("record_key", 1, 8))  # the sign is the first digit's highest bit, turned so that the order stays
    number = F.conv(F.concat(F.translate(F.left(digits, F.lit(1)), "0123456789ABCDEF", "89ABCDEF01234567"), F.substring(digits, 2, 15)), 16, -10).cast("long")
    out = records.withColumns({"key": F.col("record_key"), "record_key": number})
    out = out if blocking.are_unique(out) else records.withColumn("key", F.col("record_key"))
    return staged(out, getattr(records, "_stage", None))


def named(rows: DataFrame, records: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with the whole keys, as bytes, in place of the numbers that ``numbered`` gave."""
    for c in columns:
        if records.schema["record_key"].dataType.typeName() != "binary":
            rows = rows.withColumnRenamed(c, "__n").join(records.select(F.col("record_key").alias("__n"), F.col("key").alias(c)), "__n").drop("__n")
    return rows


def pairs_of(records: DataFrame, carried: list[str] | None = None) -> DataFrame:
    return blocking.met_pairs(records, carried)


def unpacked(pairs: DataFrame) -> DataFrame:
    """Keys as digits again."""
    return pairs.withColumns({c: F.lower(F.hex(c)) for c in ("left_record_key", "right_record_key")})


@query(f"WITH {BASE} SELECT record_key, source_system, source_record_id, full_name, personal_email, personal_phone, CAST(date_of_birth AS VARCHAR) AS date_of_birth, home_address_line1, home_postcode, company_name FROM contacts")
def guest_snapshot(spark, d):
    return guests(spark, d).select("record_key", "source_system", "source_record_id", "full_name", "personal_email", "personal_phone", F.col("date_of_birth").cast("string").alias("date_of_birth"), "home_address_line1", "home_postcode", "company_name")


@query(f"WITH {BASE} SELECT record_key, name_n, given_key, family_name_n, email_n, work_email_n, phone_n, work_phone_n, home_address_n, work_address_n, postcode_n FROM contacts")
def normalize_contacts(spark, d):
    return profile.normalize(guests(spark, d)).select("record_key", "name_n", "given_key", "family_name_n", "email_n", "work_email_n", "phone_n", "work_phone_n", "home_address_n", "work_address_n", "postcode_n")


@query(f"WITH {BASE} SELECT ds AS source_system, CAST(dd AS VARCHAR) AS date_of_birth, records, round(share, 6) AS share FROM defaults")
def default_dates(spark, d):
    return profile.default_dates(profile.normalize(guests(spark, d))).select("source_system", F.col("date_of_birth").cast("string").alias("date_of_birth"), "records", F.round("share", 6).alias("share"))


@query(f"WITH {BASE} SELECT record_key, CAST(dob_usable AS VARCHAR) AS dob_usable, dob_is_source_default, source_priority FROM base")
def usable_dates(spark, d):
    return base_of(spark, d).select("record_key", F.col("dob_usable").cast("string").alias("dob_usable"), "dob_is_source_default", "source_priority")


@query(f"WITH {PREVALENCE} SELECT * FROM prevalence")
def contact_prevalence(spark, d):
    return profile.prevalence(base_of(spark, d))


@query(f"WITH {PREVALENCE} SELECT record_key, email_is_shared, phone_is_shared, personal_email_n, personal_phone_n, email_record_count, phone_record_count, email_given_names, phone_given_names FROM records")
def shared_contact_flags(spark, d):
    return records_of(spark, d).select("record_key", "email_is_shared", "phone_is_shared", "personal_email_n", "personal_phone_n", "email_record_count", "phone_record_count", "email_given_names", "phone_given_names")


@query(f"WITH {BLOCKS} SELECT record_key, reason, block, original_block_size, block_size FROM blocks")
def blocking_keys_refined(spark, d):
    return blocking.blocking_keys(base_of(spark, d, BLOCKED, packed=True)).drop("source_system").withColumn("record_key", F.lower(F.hex("record_key")))


@query(f"WITH {PAIRS} SELECT l AS left_record_key, r AS right_record_key, reason, scope FROM hits")
def candidate_hits(spark, d):
    pairs = pairs_of(base_of(spark, d, BLOCKED, packed=True))
    return unpacked(pairs.select("left_record_key", "right_record_key", F.explode("candidate_reasons").alias("reason"), F.col("candidate_scopes")[0].alias("scope")))


@query(f"WITH {PAIRS} SELECT l AS left_record_key, r AS right_record_key, reasons, 'DETERMINISTIC' AS routes, scopes FROM pairs")
def candidate_pairs_union(spark, d):
    j = lambda c: F.array_join(f"candidate_{c}", ",").alias(c)
    return unpacked(pairs_of(base_of(spark, d, BLOCKED, packed=True))).select("left_record_key", "right_record_key", j("reasons"), j("routes"), j("scopes"))


@query(f"WITH {GAMMAS} SELECT {', '.join('gamma_' + c for c in matching.COMPARISONS)}, count(*) AS pairs FROM compared GROUP BY ALL")
def gamma_patterns(spark, d):
    r = records_of(spark, d, RESOLVED, packed=True)
    return matching.patterns(matching.compare(pairs_of(r, list(matching.COMPARISONS)), r))


FIXED = matching.Model(
    2.0 ** -10, {c: [0.05] * (matching.levels(c) - 1) + [1 - 0.05 * (matching.levels(c) - 1)] for c in matching.COMPARISONS}, {c: [1 - 0.01 * (matching.levels(c) - 1)] + [0.01] * (matching.levels(c) - 1) for c in matching.COMPARISONS})


def _bf(c: str) -> str:
    return f"CASE gamma_{c} WHEN -1 THEN 1.0E0 " + " ".join(f"WHEN {k} THEN {FIXED.m[c][k]!r} / {FIXED.u[c][k]!r}" for k in range(matching.levels(c))) + " END"


def _tf(c: str, value: str) -> str:
    return f"CASE WHEN gamma_{c} = {matching.levels(c) - 1} THEN {FIXED.u[c][-1]!r} * (SELECT count({c}) FROM records) / tf_{c}.n ELSE 1.0E0 END"


_TF = {"name_n": "nl", "home_address_n": "hl", "personal_email_n": "el", "personal_phone_n": "pl"}
WEIGHTS = f"""{GAMMAS}, weighed AS (SELECT l, r, log2({FIXED.prior!r} / (1 - {FIXED.prior!r})) + {' + '.join(f'log2({_bf(c)})' for c in matching.COMPARISONS)} + {' + '.join(f'log2({_tf(c, v)})' for c, v in _TF.items())} AS w
  FROM compared {' '.join(f'LEFT JOIN (SELECT {c} AS v, count(*) AS n FROM records GROUP BY 1) tf_{c} ON tf_{c}.v = {v}' for c, v in _TF.items())})"""


@query(f"WITH {WEIGHTS} SELECT l AS left_record_key, r AS right_record_key, round(w, 4) AS match_weight, round(1 / (1 + pow(2, -w)), 4) AS match_probability FROM weighed")
def match_weight_fixed_params(spark, d):
    r = counted_of(records_of(spark, d, RESOLVED, packed=True))
    scored = matching.score(compared_of(r), r, FIXED)
    return unpacked(scored).select("left_record_key", "right_record_key", F.round("match_weight", 4).alias("match_weight"), F.round("match_probability", 4).alias("match_probability"))


def counted_of(records: DataFrame) -> DataFrame:
    """``records`` with the counts that scores need, in place of their stage table."""
    counted = materialize(matching.with_counts(records), "counted")
    discard(records)
    return counted


def compared_of(counted: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Candidate pairs of ``counted_of`` records with their levels, the counts that scores need and the columns ``carried``."""
    return matching.compare(pairs_of(counted, scoring_columns(carried)), counted)


def scoring_columns(carried: tuple[str, ...] = ()) -> list[str]:
    """What pairs carry to be scored, and the columns ``carried``."""
    return list(dict.fromkeys([*matching.COMPARISONS, *[f"n_{c}" for c in matching.TERM_FREQUENCY], *carried]))


def scored_pairs(spark, d, learned: bool = False):
    """(records, decided pairs) with the whole evidence. Keys are bytes; the pairs are no stage table, and should be read once."""
    r = records_of(spark, d, RESOLVED, packed=True)
    model = matching.fit(r) if learned else FIXED
    r = counted_of(r)
    return r, decided_of(compared_of(r, matching.FEATURE_FIELDS), r, model)


def decided_of(compared: DataFrame, r: DataFrame, model: matching.Model) -> DataFrame:
    """Compared pairs that carry all features, with scores, evidence and decision."""
    scored = matching.score(compared, r, model)
    keep = ["left_record_key", "right_record_key", "candidate_reasons", "match_probability", "match_weight"] + [f"{p}_{c}" for p in ("gamma", "bf", "tf") for c in matching.COMPARISONS]
    features = matching.pair_features(scored.select(*keep, *[f"{c}_{s}" for s in "lr" for c in matching.FEATURE_FIELDS]), r)
    return features.withColumn("__d", policy.decide(policy.rules())).withColumns({"decision": F.col("__d.decision"), "reason": F.col("__d.reason")}).drop("__d")


@query()
def learned_model(spark, d):
    r = records_of(spark, d, RESOLVED)
    model = matching.fit(r)
    rows = [(c, k, float(model.m[c][k]), float(model.u[c][k])) for c in matching.COMPARISONS for k in range(matching.levels(c))]
    return spark.createDataFrame(rows, "comparison string, level int, m double, u double")


@query(f"""WITH {WEIGHTS} SELECT l AS left_record_key, r AS right_record_key, coalesce(a.dob_usable <> b.dob_usable, false) AS valid_dob_conflict,
  CASE WHEN a.dob_usable IS NULL OR b.dob_usable IS NULL THEN NULL WHEN a.dob_usable = b.dob_usable THEN 'EXACT'
    WHEN {_swap('a.dob_usable', 'b.dob_usable')} THEN 'DAY_MONTH_SWAP'
    WHEN month(a.dob_usable) = month(b.dob_usable) AND day(a.dob_usable) = day(b.dob_usable)
      AND hamming(CAST(year(a.dob_usable) AS VARCHAR), CAST(year(b.dob_usable) AS VARCHAR)) = 1 THEN 'YEAR_DIGIT'
    WHEN year(a.dob_usable) = year(b.dob_usable) AND month(a.dob_usable) = month(b.dob_usable)
      AND hamming(lpad(CAST(day(a.dob_usable) AS VARCHAR), 2, '0'), lpad(CAST(day(b.dob_usable) AS VARCHAR), 2, '0')) = 1 THEN 'DAY_DIGIT'
      ELSE 'CONFLICT' END AS dob_variant,
  a.dob_is_source_default OR b.dob_is_source_default AS source_default_dob, coalesce(a.personal_email_n = b.personal_email_n,
    false) AS personal_email_exact, coalesce(a.personal_phone_n = b.personal_phone_n, false) AS personal_phone_exact,
  coalesce(a.email_n = b.email_n, false) AND a.email_is_shared AS shared_email_exact, CASE
    WHEN a.email_n = b.email_n THEN a.email_given_names END AS email_given_names, CASE
    WHEN a.phone_n = b.phone_n THEN a.phone_given_names END AS phone_given_names, coalesce(a.personal_email_n <> b.personal_email_n,
    false) AS personal_email_conflict, a.name_n = b.name_n AS name_exact,
  coalesce(a.home_address_n = b.home_address_n, false) AS address_agreement, coalesce(a.postcode_n = b.postcode_n, false) AS postcode_agreement,
    round(1 - levenshtein(a.name_n, b.name_n) * 1.0E0 / greatest(length(a.name_n), length(b.name_n), 1), 6) AS name_edit_similarity,
  (coalesce(a.email_n = b.email_n, false) AND a.email_is_shared) OR (coalesce(a.phone_n = b.phone_n, false)
    AND a.phone_is_shared) OR coalesce(a.work_email_n = b.work_email_n, false) OR coalesce(a.work_phone_n = b.work_phone_n, false) AS shared_context
  FROM weighed JOIN records a ON a.record_key = l JOIN records b ON b.record_key = r""")
def pair_features(spark, d):
    r = records_of(spark, d, RESOLVED, packed=True)
    pairs = pairs_of(r, list(matching.FEATURE_FIELDS)).withColumn("match_probability", F.lit(0.5))
    return unpacked(matching.pair_features(pairs, r)).select(
        "left_record_key", "right_record_key", "valid_dob_conflict", "dob_variant", "source_default_dob", "personal_email_exact", "personal_phone_exact", "shared_email_exact", "email_given_names", "phone_given_names", "personal_email_conflict",
        "name_exact", "address_agreement", "postcode_agreement", F.round("name_edit_similarity", 6).alias("name_edit_similarity"), "shared_context")


@query()
def name_variants(spark, d):
    _, decided = scored_pairs(spark, d)
    return decided.groupBy("given_variant", "family_variant").agg(F.count(F.lit(1)).alias("pairs"))


# the policy on a grid of evidence, since a table seldom holds every combination
_GRID = {
    "dob_variant": ("EXACT", "DAY_MONTH_SWAP", "YEAR_DIGIT", "CONFLICT", None), "given_variant": ("EXACT", "NICKNAME", "TYPO", "CONFLICT", None), "family_variant": ("EXACT", "TOKEN", "CONFLICT", None),
    "personal_email_exact": (True, False), "personal_phone_exact": (True, False), "name_exact": (True, False), "address_agreement": (True, False), "postcode_agreement": (True, False),
    "personal_email_conflict": (True, False), "personal_phone_conflict": (True, False), "cross_script": (True, False), "shared_context": (True, False), "source_default_dob": (True, False),
    "ann_address_rank": (3, 9, None), "match_probability": (0.95, 0.6, 0.2)}


def _grid_sql(string: str) -> str:
    lit = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)
    columns, step = [], 1
    for name, values in _GRID.items():
        step = step * 7 + 3
        columns.append(f"CASE CAST(floor(id * 7919 / {step % 9973 + 1}) + id AS BIGINT) % {len(values)} " + " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values)) + f" END AS {name}")
    return "SELECT id, " + ", ".join(columns) + ", CASE WHEN id % 2 = 0 THEN true ELSE false END AS valid_dob_conflict FROM ids"


_ACCEPT = "(given_variant IS NULL OR given_variant <> 'CONFLICT') AND (family_variant IS NULL OR family_variant <> 'CONFLICT')"
_CONTACT = "(personal_email_exact OR personal_phone_exact)"
_DOB = "coalesce(dob_variant IN ('EXACT', 'DAY_MONTH_SWAP'), false)"
_TWIN = "coalesce(dob_variant = 'EXACT' AND family_variant = 'EXACT' AND given_variant <> 'EXACT', false)"
POLICY_SQL = f"""CASE WHEN dob_variant = 'CONFLICT' THEN 'REJECT VALID_DOB_CONFLICT'
      WHEN {_CONTACT} AND given_variant = 'CONFLICT' AND family_variant = 'CONFLICT' THEN 'REJECT SHARED_CONTACT_DIFFERENT_PEOPLE'
  WHEN {_CONTACT} AND {_DOB} THEN 'AUTO_MATCH PERSONAL_CONTACT_AND_DOB'
    WHEN personal_email_exact AND personal_phone_exact AND {_ACCEPT} THEN 'AUTO_MATCH BOTH_PERSONAL_CONTACTS'
  WHEN {_CONTACT} AND {_ACCEPT} THEN 'AUTO_MATCH PERSONAL_CONTACT_AND_NAME'
    WHEN {_CONTACT} AND family_variant = 'CONFLICT' THEN 'REJECT SHARED_CONTACT_DIFFERENT_FAMILY'
    WHEN {_CONTACT} THEN 'REJECT SHARED_CONTACT_DIFFERENT_GIVEN'
  WHEN cross_script AND {_DOB} AND coalesce(ann_address_rank <= 5, false) THEN 'AUTO_MATCH MULTILINGUAL_ADDRESS_AND_DOB'
    WHEN {_TWIN} AND given_variant = 'CONFLICT' THEN 'REJECT SAME_BIRTH_FAMILY_GIVEN_CONFLICT'
    WHEN {_TWIN} THEN 'REJECT SAME_BIRTH_FAMILY_GIVEN_VARIANT'
  WHEN name_exact AND {_DOB} AND address_agreement THEN 'AUTO_MATCH NAME_DOB_ADDRESS_CORROBORATION'
    WHEN name_exact AND {_DOB} THEN 'AUTO_MATCH NAME_AND_DOB'
  WHEN name_exact AND address_agreement AND postcode_agreement THEN CASE
    WHEN personal_email_conflict AND personal_phone_conflict THEN 'REJECT NAME_ADDRESS_BOTH_CONTACTS_DIFFER'
    WHEN personal_email_conflict OR personal_phone_conflict THEN 'REJECT NAME_ADDRESS_CONTACT_CONFLICT' ELSE 'AUTO_MATCH NAME_AND_FULL_ADDRESS' END
  WHEN given_variant = 'CONFLICT' AND address_agreement THEN 'REJECT HOUSEHOLD_DIFFERENT_GIVEN'
    WHEN source_default_dob AND name_exact AND address_agreement AND match_probability >= 0.9 THEN 'AUTO_MATCH SOURCE_DEFAULT_DOB_IGNORED'
  WHEN shared_context AND NOT name_exact THEN 'REJECT SHARED_CONTEXT_NOT_IDENTITY' WHEN given_variant = 'CONFLICT' THEN 'REJECT DIFFERENT_GIVEN_NAME'
    WHEN match_probability >= 0.5 THEN 'REVIEW INSUFFICIENT_EVIDENCE_REVIEW' ELSE 'REJECT LOW_MATCH_PROBABILITY' END"""


@query(f"WITH ids AS (SELECT range AS id FROM range(30000)) SELECT id, {POLICY_SQL} AS verdict FROM ({_grid_sql('VARCHAR')}) g")
def policy_grid(spark, d):
    spark.range(30000).createOrReplaceTempView("ids")
    g = spark.sql(_grid_sql("STRING")).withColumn("__d", policy.decide(policy.rules()))
    return g.select("id", F.concat_ws(" ", "__d.decision", "__d.reason").alias("verdict"))


@query(f"""WITH ids AS (SELECT range AS id FROM range(5000)) SELECT id, concat_ws(',', CASE
      WHEN valid_dob_conflict AND dob_variant = 'CONFLICT' THEN 'VALID_DOB_CONFLICT' END, CASE
      WHEN dob_variant IN ('DAY_MONTH_SWAP', 'YEAR_DIGIT', 'DAY_DIGIT') THEN 'DOB_ENTRY_VARIANT' END,
  CASE WHEN source_default_dob THEN 'IGNORE_SOURCE_DEFAULT_DOB' END, CASE WHEN shared_context THEN 'SHARED_CONTEXT_NOT_IDENTITY' END, CASE
    WHEN cross_script AND ann_address_rank <= 5 THEN 'MULTILINGUAL_ANN_ADDRESS' END,
  CASE WHEN {POLICY_SQL} LIKE 'REVIEW%' THEN 'INSUFFICIENT_EVIDENCE_REVIEW' END) AS safeguards FROM ({_grid_sql('VARCHAR')}) g""")
def safeguards_grid(spark, d):
    spark.range(5000).createOrReplaceTempView("ids")
    g = spark.sql(_grid_sql("STRING")).withColumn("decision", policy.decide(policy.rules())["decision"])
    return g.select("id", F.array_join(policy.safeguards(), ",").alias("safeguards"))


def _policy_sql(version: int) -> str:
    """The policy of a version in SQL, clause by clause."""
    part = "(given_variant IS NOT NULL OR family_variant IS NOT NULL)"
    full = "name_exact AND address_agreement AND postcode_agreement"
    steps = [
        (1, "dob_variant = 'CONFLICT'", "REJECT VALID_DOB_CONFLICT"), (1, f"{_CONTACT} AND given_variant = 'CONFLICT' AND family_variant = 'CONFLICT'", "REJECT SHARED_CONTACT_DIFFERENT_PEOPLE"),
        (1, f"{_CONTACT} AND {_DOB}", "AUTO_MATCH PERSONAL_CONTACT_AND_DOB"), (1, f"personal_email_exact AND personal_phone_exact AND {_ACCEPT}", "AUTO_MATCH BOTH_PERSONAL_CONTACTS"),
        (1, f"{_CONTACT} AND {_ACCEPT}" + (f" AND {part}" if version == 1 else ""), "AUTO_MATCH PERSONAL_CONTACT_AND_NAME"), (2, f"{_CONTACT} AND family_variant = 'CONFLICT'", "REJECT SHARED_CONTACT_DIFFERENT_FAMILY"),
        (4, f"{_CONTACT} AND given_variant = 'CONFLICT'", "REJECT SHARED_CONTACT_DIFFERENT_GIVEN"), (1, _CONTACT, "REVIEW PERSONAL_CONTACT_NAME_CONFLICT"), (1, f"cross_script AND {_DOB} AND coalesce(ann_address_rank <= 5, false)", "AUTO_MATCH MULTILINGUAL_ADDRESS_AND_DOB"),
        (2, f"{_TWIN} AND given_variant = 'CONFLICT'", "REJECT SAME_BIRTH_FAMILY_GIVEN_CONFLICT"), (2, _TWIN, "REJECT SAME_BIRTH_FAMILY_GIVEN_VARIANT"), (1, f"name_exact AND {_DOB} AND address_agreement", "AUTO_MATCH NAME_DOB_ADDRESS_CORROBORATION"),
        (2, f"name_exact AND {_DOB}", "AUTO_MATCH NAME_AND_DOB"), (2, full + ("" if version < 3 else " AND NOT personal_email_conflict AND NOT personal_phone_conflict"), "AUTO_MATCH NAME_AND_FULL_ADDRESS"),
        (3, f"{full} AND personal_email_conflict AND personal_phone_conflict", "REJECT NAME_ADDRESS_BOTH_CONTACTS_DIFFER"), (3, full, f"{'REJECT' if version > 3 else 'REVIEW'} NAME_ADDRESS_CONTACT_CONFLICT"),
        (2, "given_variant = 'CONFLICT' AND address_agreement", "REJECT HOUSEHOLD_DIFFERENT_GIVEN"), (1, "source_default_dob AND name_exact AND address_agreement AND match_probability >= 0.9", "AUTO_MATCH SOURCE_DEFAULT_DOB_IGNORED"),
        (1, "shared_context AND NOT name_exact", "REJECT SHARED_CONTEXT_NOT_IDENTITY"), (4, "given_variant = 'CONFLICT'", "REJECT DIFFERENT_GIVEN_NAME"), (1, "match_probability >= 0.5", "REVIEW INSUFFICIENT_EVIDENCE_REVIEW")]
    return "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for since, c, v in steps if since <= version) + " ELSE 'REJECT LOW_MATCH_PROBABILITY' END"


@query(f"WITH ids AS (SELECT range AS id FROM range(20000)) SELECT id, {', '.join(f'{_policy_sql(v)} AS v{v}' for v in (1, 2, 3, 4))} FROM ({_grid_sql('VARCHAR')}) g")
def policy_versions_grid(spark, d):
    spark.range(20000).createOrReplaceTempView("ids")
    g = spark.sql(_grid_sql("STRING"))
    for v in (1, 2, 3, 4):
        g = g.withColumn(f"__{v}", policy.decide(policy.rules(version=v)))
    return g.select("id", *[F.concat_ws(" ", f"__{v}.decision", f"__{v}.reason").alias(f"v{v}") for v in (1, 2, 3, 4)])


_ALONE = f"name_exact AND address_agreement AND NOT {_CONTACT} AND NOT coalesce(dob_variant = 'EXACT', false)"
_SAME = "coalesce(dob_variant = 'EXACT', false)"
EARLIER_SQL = f"""CASE WHEN valid_dob_conflict THEN 'REJECT VALID_DOB_CONFLICT'
      WHEN {_ALONE} AND (personal_email_conflict OR personal_phone_conflict) THEN 'REVIEW CONFLICTING_PERSONAL_CONTACTS_REVIEW'
  WHEN {_ALONE} AND match_probability < 0.5 THEN 'REVIEW AMBIGUOUS_COMMON_NAME_ADDRESS'
    WHEN {_CONTACT} AND {_SAME} THEN 'AUTO_MATCH PERSONAL_CONTACT_AND_DOB'
  WHEN {_CONTACT} AND address_agreement AND match_probability >= 0.995 THEN 'AUTO_MATCH PERSONAL_CONTACT_AND_ADDRESS'
    WHEN name_exact AND {_SAME} AND address_agreement THEN 'AUTO_MATCH NAME_DOB_ADDRESS_CORROBORATION'
  WHEN source_default_dob AND name_exact AND address_agreement AND match_probability >= 0.995 THEN 'AUTO_MATCH SOURCE_DEFAULT_DOB_IGNORED'
    WHEN cross_script AND {_SAME} AND coalesce(ann_address_rank <= 5, false) THEN 'AUTO_MATCH MULTILINGUAL_ADDRESS_AND_DOB'
  WHEN match_probability >= 0.995 AND {_CONTACT} AND (name_exact OR {_SAME} OR address_agreement) THEN 'AUTO_MATCH INDEPENDENT_PERSONAL_EVIDENCE'
    WHEN match_probability >= 0.995 AND name_exact AND address_agreement THEN 'AUTO_MATCH NAME_ADDRESS_CORROBORATION'
  WHEN shared_context AND NOT {_CONTACT} AND NOT ({_SAME} AND name_exact) THEN 'REJECT SHARED_CONTEXT_NOT_IDENTITY'
    WHEN match_probability >= 0.5 THEN 'REVIEW INSUFFICIENT_EVIDENCE_REVIEW'
  WHEN coalesce(ann_address_rank <= 5, false) AND match_probability >= 0.7 THEN 'REVIEW SEMANTIC_CANDIDATE_REVIEW'
    ELSE 'REJECT LOW_MATCH_PROBABILITY' END"""


@query(f"WITH ids AS (SELECT range AS id FROM range(5000)) SELECT id, {EARLIER_SQL} AS verdict FROM ({_grid_sql('VARCHAR')}) g")
def earlier_policy_grid(spark, d):
    """The first policy; the grid's probability stands for its similarities too."""
    spark.range(5000).createOrReplaceTempView("ids")
    same = F.coalesce(F.col("dob_variant") == "EXACT", F.lit(False))
    g = spark.sql(_grid_sql("STRING")).withColumns({"personal_contact": F.col("personal_email_exact") | F.col("personal_phone_exact"), "dob_agreement": same, "name_agreement": F.col("name_exact"), "name_edit_similarity": F.col("match_probability"), "address_edit_similarity": F.col("match_probability")})
    return g.withColumn("__d", policy.decide(policy.earlier_rules())).select("id", F.concat_ws(" ", "__d.decision", "__d.reason").alias("verdict"))


_SIMPLE = f"""{PREVALENCE}, hits AS (SELECT a.record_key AS l, b.record_key AS r, a.name_n AS an, b.name_n AS bn, a.dob_usable AS ad, b.dob_usable AS bd
      FROM records a JOIN records b ON a.record_key < b.record_key AND a.email_n = b.email_n WHERE NOT a.email_is_shared
  UNION SELECT a.record_key, b.record_key, a.name_n, b.name_n, a.dob_usable, b.dob_usable FROM records a
    JOIN records b ON a.record_key < b.record_key AND a.phone_n = b.phone_n WHERE NOT a.phone_is_shared),
judged AS (SELECT l, r, CASE WHEN ad <> bd AND NOT {_swap('ad', 'bd')} THEN 'REJECT'
  WHEN 1 - levenshtein(an, bn) * 1.0E0 / greatest(length(an), length(bn), 1) >= 0.75 THEN 'AUTO_MATCH' WHEN ad = bd THEN 'AUTO_MATCH'
  WHEN 1 - levenshtein(an, bn) * 1.0E0 / greatest(length(an), length(bn), 1) >= 0.5 THEN 'REVIEW' ELSE 'REJECT' END AS decision,
  round(1 - levenshtein(an, bn) * 1.0E0 / greatest(length(an), length(bn), 1), 6) AS similarity FROM hits)"""


@query(f"WITH {_SIMPLE} SELECT decision, count(*) AS pairs, min(l) AS first_left, max(r) AS last_right, round(avg(similarity), 4) AS similarity FROM judged GROUP BY decision")
def er_flagship_decisions(spark, d):
    """Normalise, profile, block on personal contacts, compare names, decide, count.

    Records of equal contacts, name and date are one class with a count, so that copies are compared once.
    """
    r = records_of(spark, d, RESOLVED, packed=True)
    alike = r.where("personal_email_n IS NOT NULL OR personal_phone_n IS NOT NULL").groupBy(F.col("personal_email_n").alias("e"), F.col("personal_phone_n").alias("p"), "name_n", F.col("dob_usable").alias("dob")).agg(
        F.count(F.lit(1)).alias("n"), F.min("record_key").alias("lo"), F.max("record_key").alias("hi"))
    alike = materialize(alike, "classes")
    a, b = alike.alias("a"), alike.alias("b")
    side = lambda x: [F.col(f"{x}.{c}").alias(f"{x}_{c}") for c in ("name_n", "dob", "n", "lo", "hi")]
    met = lambda c: a.join(b, (F.col(f"a.{c}") == F.col(f"b.{c}")) & (F.col("a.lo") < F.col("b.lo"))).select(*side("a"), *side("b"))
    # a pair of classes that shares both contacts meets twice; lo names a class
    pairs = met("e").union(met("p")).dropDuplicates(["a_lo", "b_lo"]).select(
        F.col("a_name_n").alias("an"), F.col("b_name_n").alias("bn"), F.col("a_dob").alias("ad"), F.col("b_dob").alias("bd"), (F.col("a_n") * F.col("b_n")).alias("n"),
        F.least("a_lo", "b_lo").alias("l"), F.greatest("a_hi", "b_hi").alias("r"))
    within = alike.where("n > 1").select(F.col("name_n").alias("an"), F.col("name_n").alias("bn"), F.col("dob").alias("ad"), F.col("dob").alias("bd"), F.expr("n * (n - 1) div 2").alias("n"), F.col("lo").alias("l"), F.col("hi").alias("r"))
    sim = similarity(F.col("an"), F.col("bn"))
    swap = (F.year("ad") == F.year("bd")) & (F.month("ad") == F.dayofmonth("bd")) & (F.dayofmonth("ad") == F.month("bd"))
    decision = F.when((F.col("ad") != F.col("bd")) & ~swap, "REJECT").when((sim >= 0.75) | (F.col("ad") == F.col("bd")), "AUTO_MATCH").when(sim >= 0.5, "REVIEW").otherwise("REJECT")
    return pairs.union(within).withColumns({"decision": decision, "s": F.round(sim, 6)}).groupBy("decision").agg(
        F.sum("n").alias("pairs"), F.lower(F.hex(F.min("l"))).alias("first_left"), F.lower(F.hex(F.max("r"))).alias("last_right"), F.round(F.sum(F.col("s") * F.col("n")) / F.sum(F.when(F.col("s").isNotNull(), F.col("n"))), 4).alias("similarity"))


def resolved(spark, d, whole: bool = False):
    """(records, decisions, mapping with customer_id, refused edges) of a whole run; keys are ``numbered``, in the mapping ``record_key`` is bytes.

    Pairs that neither join records nor keep them apart are among the decisions only if ``whole``.
    """
    r = counted_of(numbered(records_of(spark, d, RESOLVED, packed=True)))
    told = ("left_record_key", "right_record_key", "decision", "reason", "valid_dob_conflict", "dob_variant")
    joins = F.col("decision") == "AUTO_MATCH"
    parts = []
    for pairs in blocking.met_parts(r, scoring_columns(matching.FEATURE_FIELDS), parts=3):
        part = decided_of(matching.compare(pairs, r), r, FIXED).select(*told, F.when(joins, F.round("match_probability", 9)).alias("score"))
        parts.append(materialize(part if whole else part.where(joins | graph.never_joined()), "decisions"))
    decided = reduce(DataFrame.unionAll, parts)
    mapping, refused = graph.constrained_components(r.select("record_key", "dob_usable"), decided.where(joins).select("left_record_key", "right_record_key", "score"), graph.cannot_links(decided))
    kind = r.schema["key"].dataType.simpleString()
    none = spark.createDataFrame([], f"record_key {kind}, customer_id string")
    born = spark.createDataFrame([], "customer_id string, created_at string")
    ids, _ = graph.persistent_ids(named(mapping, r, "record_key"), none, born, "run1")
    ids = materialize(ids, "mapping")
    if not whole:
        discard(*parts)
    return r, decided, ids, refused


@query()
def constrained_components(spark, d):
    r, _, mapping, _ = resolved(spark, d)
    groups = mapping.groupBy("component", "customer_id").agg(F.count(F.lit(1)).alias("records"))
    return named(groups, r, "component").select(F.lower(F.hex("component")).alias("component"), "customer_id", "records")


@query()
def persistent_ids(spark, d):
    """A second run in which a tenth of the records are gone: ids that live on, and aliases."""
    _, _, mapping, _ = resolved(spark, d)
    key = F.lower(F.hex("record_key"))
    old = mapping.select("record_key", F.concat(F.lit("old_"), F.substring(key, 1, 2)).alias("customer_id"))
    born = old.select("customer_id").distinct().withColumn("created_at", F.col("customer_id"))
    ids, aliases = graph.persistent_ids(mapping.select("record_key", "component").where(key > "1"), old, born, "run2")
    return ids.groupBy("customer_id").agg(F.count(F.lit(1)).alias("records")).withColumn("kind", F.lit("id")).unionByName(aliases.select("customer_id", F.lit(1).cast("long").alias("records"), F.lit("alias").alias("kind")))


def by_person(spark, d) -> DataFrame:
    """A mapping by the guest table's own person, so that SQL can repeat what follows."""
    g = guest_records(spark, d, truth=True)
    return g.select(F.sha2(F.concat_ws("|", "source_system", "source_record_id"), 256).alias("record_key"), F.concat(F.lit("c"), F.col("person").cast("string")).alias("customer_id"))


def _line(kind: str) -> str:
    part = lambda name, column: f"CASE WHEN {kind}_{column} IS NULL THEN '' ELSE concat('\"{name}\":\"', {kind}_{column}, '\",') END"
    return f"CASE WHEN {kind}_address_n IS NOT NULL THEN concat('{{', rtrim(concat({', '.join(part(n, c) for n, c in golden.ADDRESS.items())}), ','), '}}') END"


# what each field may take, the rule that picks it, and the profile's name of it
_FIELDS = (
    ("full_name", "coalesce(nullif(full_name, ''), concat_ws(' ', given_name, family_name))", 1, "full_name"), ("given_name", "nullif(trim(given_name), '')", 1, "given_name"),
    ("family_name", "nullif(trim(family_name), '')", 1, "family_name"), ("personal_email", "personal_email_n", 0, "personal_email"), ("personal_phone", "personal_phone_n", 0, "personal_phone"),
    ("work_email", "work_email_n", 0, "work_email"), ("work_phone", "work_phone_n", 0, "work_phone"), ("dob_usable", "CAST(dob_usable AS VARCHAR)", 1, "date_of_birth"),
    ("home_address", _line("home"), 0, "home_address_json"), ("work_address", _line("work"), 0, "work_address_json"), ("company_name", "nullif(trim(company_name), '')", 0, "company_name"))
_EACH = " UNION ALL ".join(
    f"SELECT concat('c', CAST(person AS VARCHAR)) AS customer_id, record_key, source_system, source_updated_at, source_priority, {p} AS by_priority, '{f}' AS field, {e} AS value FROM records" for f, e, p, _ in _FIELDS)
SURVIVORS = f"""{PREVALENCE},
fields AS ({_EACH}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id, field
    ORDER BY by_priority * source_priority, source_updated_at DESC NULLS LAST, source_priority, record_key) AS rn
  FROM fields WHERE value IS NOT NULL AND value <> ''),
picked AS (SELECT customer_id, field, value, record_key, source_system FROM ranked WHERE rn = 1)"""


def summaries_of(spark, d) -> DataFrame:
    """What survives of each of the guest table's persons. Keys are bytes."""
    records, mapping = records_of(spark, d, GOLDEN, packed=True), by_person(spark, d).withColumn("record_key", F.unhex("record_key"))
    rows = materialize(golden.customer_rows(mapping, records), "customer-rows")
    discard(records)
    return golden.customer_summaries(rows, golden.survivorship_rules(None, spark))


@query(f"WITH {SURVIVORS} SELECT * FROM picked")
def survivorship_pick(spark, d):
    return golden.summary_survivors(summaries_of(spark, d)).select("customer_id", "field", "value", F.lower(F.hex("record_key")).alias("record_key"), "source_system")


@query(f"""WITH {SURVIVORS},
  who AS (SELECT concat('c', CAST(person AS VARCHAR)) AS customer_id, count(*) AS source_record_count, string_agg(DISTINCT source_system,
    ',' ORDER BY source_system) AS source_systems FROM records GROUP BY 1)
  SELECT who.customer_id, source_record_count, source_systems,
    {', '.join(f"max(CASE WHEN field = '{f}' THEN value END) AS {name}" for f, _, _, name in _FIELDS)}
  FROM who LEFT JOIN picked ON picked.customer_id = who.customer_id GROUP BY 1, 2, 3""")
def golden_profile(spark, d):
    wide = golden.summary_profiles(summaries_of(spark, d))
    return wide.withColumns({"source_systems": F.array_join("source_systems", ","), "date_of_birth": F.col("date_of_birth").cast("string")})


def simple_decisions(spark, d) -> DataFrame:
    """Pairs of orders of neighbouring customers with a made-up decision, for the release's projections."""
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").cast("string").alias("k"), "o_custkey", "o_orderkey")
    a, b = o.alias("a"), o.alias("b")
    j = a.join(b, (F.col("a.o_custkey") == F.col("b.o_custkey")) & (F.col("a.k") < F.col("b.k")))
    p = F.round(((F.col("a.o_orderkey") * 31 + F.col("b.o_orderkey")) % 100) / 100, 2)
    decision = F.when(p >= 0.9, "AUTO_MATCH").when(p >= 0.85, "REVIEW").otherwise("REJECT")
    return j.select(F.col("a.k").alias("left_record_key"), F.col("b.k").alias("right_record_key"), p.alias("match_probability"), decision.alias("decision"))


def simple_mapping(spark, d) -> DataFrame:
    key = F.concat(F.lit("m"), F.floor(F.col("o_custkey") / 2).cast("string"))
    return spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").cast("string").alias("record_key"), key.alias("component"), key.alias("customer_id"))


_DECIDED = """m AS (SELECT CAST(o_orderkey AS VARCHAR) AS record_key, concat('m', CAST(CAST(floor(o_custkey / 2) AS BIGINT) AS VARCHAR)) AS component
      FROM orders),
dec AS (SELECT l, r, p, CASE WHEN p >= 0.9 THEN 'AUTO_MATCH' WHEN p >= 0.85 THEN 'REVIEW' ELSE 'REJECT' END AS decision
  FROM (SELECT CAST(a.o_orderkey AS VARCHAR) AS l, CAST(b.o_orderkey AS VARCHAR) AS r, round(((a.o_orderkey * 31 + b.o_orderkey) % 100) / 100.0E0,
  2) AS p
  FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND CAST(a.o_orderkey AS VARCHAR) < CAST(b.o_orderkey AS VARCHAR)) x),
touched AS (SELECT DISTINCT component FROM m JOIN (SELECT l AS k FROM dec WHERE decision = 'REVIEW' UNION SELECT r
  FROM dec WHERE decision = 'REVIEW') t ON k = record_key)"""


@query(f"""WITH {_DECIDED} SELECT m.record_key, m.component AS customer_id, CASE WHEN t.component IS NULL THEN 'AUTO_RESOLVED'
      ELSE 'REQUIRES_REVIEW' END AS mapping_status, best AS strongest_edge_score
  FROM m LEFT JOIN touched t ON t.component = m.component
    LEFT JOIN (SELECT k, max(p) AS best FROM (SELECT l AS k, p FROM dec WHERE decision = 'AUTO_MATCH'
    UNION ALL SELECT r, p FROM dec WHERE decision = 'AUTO_MATCH') e GROUP BY k) b ON b.k = m.record_key""")
def identity_links_strongest(spark, d):
    dec, m = simple_decisions(spark, d), simple_mapping(spark, d)
    none = spark.createDataFrame([], "left_record_key string, right_record_key string, reason string")
    return golden.identity_links(m, dec, golden.touched_components(dec, none, m))


@query(f"WITH {_DECIDED} SELECT least(a.component, b.component) AS left_component, greatest(a.component, b.component) AS right_component, count(*) AS pairs FROM dec JOIN m a ON a.record_key = l JOIN m b ON b.record_key = r GROUP BY 1, 2")
def component_pair_counts(spark, d):
    return golden.component_pairs(simple_decisions(spark, d), simple_mapping(spark, d))


@query()
def steward_cases(spark, d):
    r, decided, mapping, refused = resolved(spark, d, whole=True)
    numbers = r.select("key", "record_key")
    mapping = mapping.withColumnRenamed("record_key", "key").join(numbers, "key").select("record_key", "component") if r.schema["record_key"].dataType.typeName() != "binary" else mapping
    cases = golden.steward_cases(mapping, golden.touched_components(decided, refused, mapping), decided)
    return named(cases, r, "case_component", "component").withColumns({c: F.lower(F.hex(c)) for c in ("case_component", "component")}).select(*cases.columns)


@query("""SELECT least(x, y) AS left_record_key, greatest(x, y) AS right_record_key, decision, 'R' AS reason, printf('%.4f', p) AS probability, CASE k % 3
      WHEN 0 THEN 'address,name' WHEN 1 THEN 'a_representation_of_a_very_long_name_that_goes_on_and_on'
      ELSE '' END AS representations, CAST(k % 4 AS INT) AS gamma_name, k / 8.0E0 AS bf_name
  FROM (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS x, CAST(c_custkey + 1 AS VARCHAR) AS y, (c_custkey % 1000) / 1000.0E0 AS p, CASE
    WHEN c_custkey % 2 = 0 THEN 'REVIEW' ELSE 'REJECT' END AS decision FROM customer) c""")
def match_evidence(spark, d):
    k = F.col("c_custkey")
    x, y = k.cast("string"), (k + 1).cast("string")
    reasons = F.when(k % 3 == 0, F.array(F.lit("ANN_NAME"), F.lit("PERSONAL_EMAIL"), F.lit("ANN_ADDRESS"))).when(k % 3 == 1, F.array(F.lit("ANN_A_REPRESENTATION_OF_A_VERY_LONG_NAME_THAT_GOES_ON_AND_ON"))).otherwise(F.array(F.lit("WORK_EMAIL")))
    made = spark.read.parquet(f"{d}/customer.parquet").select(
        F.least(x, y).alias("left_record_key"), F.greatest(x, y).alias("right_record_key"), F.when(k % 2 == 0, "REVIEW").otherwise("REJECT").alias("decision"), F.lit("R").alias("reason"), ((k % 1000) / 1000).alias("match_probability"), reasons.alias("candidate_reasons"),
        (k % 4).cast("int").alias("gamma_name"), (k / 8).alias("bf_name"), F.lit("no").alias("gamma_name_l"))
    return golden.match_evidence(made)


@query(f"WITH {GAMMAS} SELECT round(log2({FIXED.prior!r} / (1 - {FIXED.prior!r})), 4) AS prior_weight, count(*) AS pairs FROM compared")
def comparison_weights(spark, d):
    """Prior and weights of each pair; the prior must be the model's."""
    _, decided = scored_pairs(spark, d)
    w = review.comparison_weights(decided, list(matching.COMPARISONS))
    return w.groupBy("prior_weight").agg(F.count(F.lit(1)).alias("pairs"))


@query(f"WITH {PREVALENCE}, n AS (SELECT count(*) AS n FROM records) SELECT comparison, agreeing FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS comparison, round(sum(k * (k - 1)) * 1.0E0 / (sum(k) * (sum(k) - 1)), 9) AS agreeing FROM (SELECT count(*) AS k FROM records WHERE {c} IS NOT NULL GROUP BY {c}) x" for c in matching.COMPARISONS)
    + """ UNION ALL SELECT 'sure pairs', (SELECT sum(k * (k - 1) // 2) FROM (SELECT count(*) AS k
   FROM records WHERE personal_email_n IS NOT NULL AND name_n IS NOT NULL AND dob_usable IS NOT NULL GROUP BY personal_email_n, name_n, dob_usable) a)
    + (SELECT sum(k * (k - 1) // 2) FROM (SELECT count(*) AS k
      FROM records WHERE personal_phone_n IS NOT NULL AND name_n IS NOT NULL AND dob_usable IS NOT NULL
      GROUP BY personal_phone_n, name_n, dob_usable) b)
    - (SELECT coalesce(sum(k * (k - 1) // 2), 0) FROM (SELECT count(*) AS k
      FROM records WHERE personal_email_n IS NOT NULL AND personal_phone_n IS NOT NULL AND name_n IS NOT NULL AND dob_usable IS NOT NULL
      GROUP BY personal_email_n, personal_phone_n, name_n, dob_usable) c)) y""")
def random_agreement(spark, d):
    """How often two random records agree on a column, and how many pairs the sure rules find, from group sizes."""
    r = records_of(spark, d, RESOLVED, packed=True)
    rows = [(c, round(x, 9)) for c, x in matching.exact_u(r).items()] + [("sure pairs", float(matching.prior_pairs(r)))]
    return spark.createDataFrame(rows, "comparison string, agreeing double")


_BLOCK_SQL = [" AND ".join(f"a.{c} = b.{c}" for c in block) for block in matching.SESSIONS]


@query(f"WITH {PREVALENCE} " + " UNION ALL ".join(f"SELECT {i} AS session, gamma_name_n, gamma_personal_email_n, gamma_personal_phone_n, gamma_dob_usable, gamma_home_address_n, count(*) AS pairs FROM (SELECT {', '.join(_gamma(c, cuts) for c, cuts in matching.COMPARISONS.items())} FROM records a JOIN records b ON {on} AND a.record_key < b.record_key) s{i} GROUP BY ALL"
                                                 for i, on in enumerate(_BLOCK_SQL)))
def session_patterns(spark, d):
    """Level patterns of all pairs that a session's rule blocks together."""
    r = records_of(spark, d, RESOLVED, packed=True)
    out = None
    for i, block in enumerate(matching.SESSIONS):
        found = matching.session_patterns(r, block).withColumn("session", F.lit(i))
        out = found if out is None else out.unionByName(found)
    return out


@query("""SELECT c_custkey, difference, CASE WHEN difference >= 2 THEN 'different' WHEN difference = 0 AND p >= 0.95 THEN 'same' ELSE 'unclear' END AS lean
      FROM (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 4 ELSE 0 END + CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 0 END
  + CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 0 END + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 7 = 0 THEN 1
    ELSE 0 END AS difference, (c_custkey % 100) / 100.0E0 AS p FROM customer) x""")
def case_lean(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    k = F.col("c_custkey")
    cases = c.select("c_custkey", *[(k % m == 0).alias(n) for n, m in (("cannot_link", 11), ("emails", 3), ("birth_dates", 5), ("first_names", 2), ("graph_dob", 7))], ((k % 100) / 100).alias("lowest_probability"))
    return review.lean(cases).select("c_custkey", "difference", "lean")


def steward_events(spark, d) -> DataFrame:
    """Decisions on made-up cases: a user is a case in each of two releases, and holds one record there."""
    e = spark.read.parquet(f"{d}/events.parquet")
    user, k = F.col("user_id").cast("string"), F.col("event_id")
    return e.select(
        F.concat(F.lit("e"), k.cast("string")).alias("event_id"), F.concat(F.lit("run"), (k % 2).cast("string")).alias("source_run_id"), F.concat(F.lit("case"), user).alias("case_id"),
        k.alias("applied_case_version"), F.when(k % 5 == 0, "DEFER").otherwise("MERGE").alias("action"), F.lit("d").alias("content_digest"),
        F.array(F.struct(F.concat(F.lit("r"), user).alias("record_key"), F.concat(F.lit("s"), k.cast("string")).alias("customer_id"))).alias("memberships"))


OVERRIDES = """o AS (SELECT concat('run', CAST(event_id % 2 AS VARCHAR)) AS source_run_id, concat('r', CAST(user_id AS VARCHAR)) AS record_key, concat('s',
      CAST(max(event_id) AS VARCHAR)) AS customer_id,
  concat('case', CAST(user_id AS VARCHAR)) AS case_id, concat('e', CAST(max(event_id) AS VARCHAR)) AS event_id, max(event_id) AS applied_case_version
  FROM events WHERE event_id % 5 <> 0 GROUP BY user_id, event_id % 2)"""


@query(f"WITH {OVERRIDES} SELECT * FROM o")
def override_compaction(spark, d):
    e = steward_events(spark, d)
    return review.checked_overrides(e.union(e))


@query("""SELECT least(CAST(q AS VARCHAR), CAST(n AS VARCHAR)) AS left_record_key, greatest(CAST(q AS VARCHAR), CAST(n AS VARCHAR)) AS right_record_key,
      max(s) AS ann_name_score, min(rank) AS ann_name_rank FROM (SELECT q, n, s, row_number() OVER (PARTITION BY q ORDER BY s DESC, n) AS rank
  FROM (SELECT a.vec_id AS q, b.vec_id AS n, round(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS s
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) x) y WHERE rank <= 20 GROUP BY 1, 2""")
def knn_candidate_pairs(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    who = e.select(F.col("vec_id").cast("string").alias("record_key"), "vec_id", F.col("label").cast("string").alias("source_system"))
    hits = vectors.ann_hits(vectors.knn(e, e, 20), who, "name")
    return vectors.ann_features(hits).select("left_record_key", "right_record_key", "ann_name_score", "ann_name_rank")


@query(f"WITH {BASE} SELECT DISTINCT sha256(concat_ws(' | ', 'name: ' || trim(full_name), 'company: ' || trim(company_name))) AS text_hash, true AS valid FROM contacts WHERE full_name IS NOT NULL OR company_name IS NOT NULL")
def search_embeddings(spark, d):
    """Search texts, one vector for each distinct text, and the gate all vectors must pass."""
    g = guests(spark, d).withColumn("text", vectors.search_text({"name": "full_name", "company": "company_name"}))
    none = spark.createDataFrame([], "text_hash string, embedding array<float>")
    made = vectors.cached_texts(g, none, "text").withColumn("embedding", vectors.hashed_embedding(F.col("text")))
    return made.select("text_hash", vectors.is_valid(F.col("embedding"), 64).alias("valid"))


# --- vectors, caches, gates -----------------------------------------------------------------------
@query("""WITH c AS (SELECT vec_id, len(embedding) AS n, concat('t', CAST(vec_id % 40 AS VARCHAR)) AS text, vec_id % 7 AS f, list_transform(embedding,
      lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)
  SELECT sha256(text) AS text_hash, text AS search_text, max(vec_id) AS generated_at
    FROM c WHERE f NOT IN (0, 1, 2, 3) AND abs(sqrt(list_sum(list_transform(e, lambda x: x * x))) - 1) <= 0.001 GROUP BY 1, 2""")
def reusable_vectors(spark, d):
    """Of a made-up cache with wrong models, errors, hashes and sizes the newest sound vector of each text."""
    e, f = spark.read.parquet(f"{d}/embeddings.parquet"), F.col("vec_id") % 7
    text = F.concat(F.lit("t"), (F.col("vec_id") % 40).cast("string"))
    cache = e.select(F.when(f == 2, F.lit("x")).otherwise(F.sha2(text, 256)).alias("text_hash"), text.alias("search_text"), F.when(f == 3, F.slice("embedding", 1, 9)).otherwise(F.col("embedding")).alias("embedding"), F.when(f == 1, "failed").alias("embedding_error"),
                     F.when(f == 0, "other").otherwise("m").alias("model_name"), F.lit("v").alias("embedding_version"), F.col("vec_id").alias("generated_at"))
    return vectors.reusable_vectors(cache, "m", "v", 64).select("text_hash", "search_text", "generated_at")


@query("""WITH hits AS (SELECT q, i + 1 AS rank, (q * 7 + i * 13) % 97 AS neighbour, 1 - i / 100.0E0 AS score FROM range(60) a(q), range(21) b(i)),
  recs AS (SELECT vec_id AS k, vec_id % 60 AS q FROM embeddings),
  met AS (SELECT k AS query_key, neighbour AS neighbour_key, score, row_number() OVER (PARTITION BY k ORDER BY rank, neighbour) AS rank FROM recs
    JOIN hits ON hits.q = recs.q WHERE k <> neighbour)
  SELECT query_key, neighbour_key, score, rank FROM met WHERE rank <= 20""")
def expanded_neighbours(spark, d):
    """Hits of one query for each text, given to all its records."""
    i = F.col("i")
    hits = spark.range(60).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(20)))).select(F.col("id").cast("string").alias("text_hash"), ((F.col("id") * 7 + i * 13) % 97).alias("neighbour_key"), (1 - i / 100).alias("score"), (i + 1).alias("rank"))
    records = spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").alias("record_key"), (F.col("vec_id") % 60).cast("string").alias("text_hash"), "embedding")
    asked = vectors.distinct_queries(records).select("text_hash")
    return vectors.expanded(hits.join(asked, "text_hash"), records.select("record_key", "text_hash")).withColumn("rank", F.col("rank").cast("long"))


@query("SELECT count(*) FILTER (WHERE vec_id % 50 = 0) AS queries, true AS index_is_fresh, true AS nine_tenths_found, true AS all_cells_are_exact FROM embeddings")
def cell_index_recall(spark, d):
    """Recall of the partitioned index against brute force, three quarters of its cells probed: these vectors hardly cluster."""
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    q = e.where("vec_id % 50 = 0")
    exact, index = materialize(vectors.knn(e, q, 20), "exact-neighbours"), vectors.CellIndex(e)
    n = len(index.centres)
    near, whole = (vectors.recall(materialize(index.search(q, 20, p), "neighbours"), exact) for p in (-(-3 * n // 4), n))
    stale = index.agrees(e.where("vec_id > 1"))
    return spark.createDataFrame([(q.count(), index.agrees(e) and not stale, near >= 0.9, whole == 1.0)], "queries long, index_is_fresh boolean, nine_tenths_found boolean, all_cells_are_exact boolean")


@query("SELECT * FROM (VALUES (1, true, 1), (2, false, 1), (3, true, 2)) t(run, fitted, fits)")
def model_cache(spark, d):
    """The same data twice, then other data: what is fitted and what is taken from the cache."""
    from kinweave.operators.tables import Versions
    from kinweave.runtime import shared_path

    store, fits, rows = Versions(spark, shared_path(spark, "models")), [], []

    def train(records):
        fits.append(1)
        return FIXED

    r = records_of(spark, d, RESOLVED)
    for run, data in enumerate((r, r.repartition(3), r.where("record_key > '1'")), 1):
        _, fitted = matching.cached_model(store, data, train)
        rows.append((run, fitted, len(fits)))
    return spark.createDataFrame(rows, "run int, fitted boolean, fits int")


@query("SELECT 'whole' AS scores, true AS passed UNION ALL SELECT 'a row less', false UNION ALL SELECT 'beyond one', false UNION ALL SELECT 'no number', false")
def score_gates(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", ((F.col("o_orderkey") % 100) / 100).alias("match_probability"))
    p, first = F.col("match_probability"), F.col("o_orderkey") == o.agg(F.min("o_orderkey")).first()[0]
    cases = {"whole": o, "a row less": o.where(~first), "beyond one": o.withColumn("match_probability", F.when(first, 1.5).otherwise(p)), "no number": o.withColumn("match_probability", F.when(first, float("nan")).otherwise(p))}
    rows = []
    for name, scored in cases.items():
        try:
            matching.gate_scores(scored, o)
            rows.append((name, True))
        except ValueError:
            rows.append((name, False))
    return spark.createDataFrame(rows, "scores string, passed boolean")


# --- groups and identities, where SQL can say what becomes of them ------------------------------------
@query("""WITH j AS (SELECT c_custkey // 4 AS g, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) = 4)
  SELECT concat('r', CAST(g * 4 + i AS VARCHAR)) AS record_key, concat('r', CAST(CASE g % 4 WHEN 0 THEN CASE WHEN i < 2 THEN g * 4
    ELSE g * 4 + 2 END WHEN 1 THEN CASE WHEN i < 3 THEN g * 4 ELSE g * 4 + 3 END WHEN 2 THEN CASE WHEN i < 2 THEN g * 4 ELSE g * 4 + 2 END
    ELSE CASE WHEN i < 3 THEN g * 4 ELSE g * 4 + 3 END END AS VARCHAR)) AS component,
    CASE g % 4 WHEN 0 THEN 'COMPONENT_DOB_CONFLICT' WHEN 2 THEN 'COMPONENT_CANNOT_LINK' ELSE 'COMPONENT_SIZE_LIMIT' END AS refused
      FROM j, range(4) r(i)""")
def constrained_groups(spark, d):
    """Four records in a row, linked one after another, the strongest link first; in each group one constraint refuses one link."""
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.floor(F.col("c_custkey") / 4).alias("g")).groupBy("g").count().where("count = 4")
    rec = lambda i: F.concat(F.lit("r"), (F.col("g") * 4 + i).cast("string"))
    pair = lambda i, j: (F.least(rec(i), rec(j)).alias("left_record_key"), F.greatest(rec(i), rec(j)).alias("right_record_key"))
    g = F.col("g") % 4
    edges = None
    for i, p in ((0, 0.9), (2, 0.8), (1, 0.7)):  # 0-1, 2-3, then 1-2; in odd groups 0-1, 1-2, then 2-3
        score = F.when(g % 2 == 0, p).otherwise({0: 0.9, 1: 0.8, 2: 0.7}[i])
        e = c.select(*pair(i, i + 1), score.alias("score"))
        edges = e if edges is None else edges.union(e)
    day = lambda i: F.when((g == 0) & F.lit(i in (1, 2)), F.to_date(F.lit("1990-01-02" if i == 1 else "1985-07-09")))
    records = c.select(F.explode(F.array(*[F.struct(rec(i).alias("record_key"), day(i).alias("dob_usable")) for i in range(4)])).alias("x")).select("x.*")
    banned = c.where("g % 4 = 2").select(*pair(0, 3))
    mapping, refused = graph.constrained_components(records, edges, banned, max_size=4)
    small, over = graph.constrained_components(records, edges, banned, max_size=3)
    of = lambda df: df.withColumn("g", F.floor(F.substr("record_key", F.lit(2)).cast("long") / 4))
    why = lambda df: df.select(F.floor(F.substr("left_record_key", F.lit(2)).cast("long") / 4).alias("g"), F.col("reason").alias("refused")).distinct()
    even = of(mapping).where("g % 2 = 0").join(why(refused), "g")
    odd = of(small).where("g % 2 = 1").join(why(over), "g")
    return even.union(odd).select("record_key", "component", "refused")


@query("""WITH m AS (SELECT c_custkey AS k, concat('r', CAST(c_custkey AS VARCHAR)) AS record_key, concat('m', CAST(c_custkey // 6 AS VARCHAR)) AS component
      FROM customer),
  held AS (SELECT concat('o', CAST(k // 4 AS VARCHAR)) AS old_id, component, count(*) AS n FROM m WHERE k % 7 <> 0 GROUP BY 1, 2),
  claim AS (SELECT old_id, component FROM (SELECT *, row_number() OVER (PARTITION BY old_id ORDER BY n DESC, component) AS rn
    FROM held) x WHERE rn = 1),
  aged AS (SELECT claim.*, row_number() OVER (PARTITION BY component ORDER BY CAST(10000 - CAST(substring(old_id, 2) AS BIGINT) AS VARCHAR),
    old_id) AS rn FROM claim),
  keys AS (SELECT component, string_agg(record_key, '|' ORDER BY record_key) AS members FROM m GROUP BY 1)
  SELECT m.record_key, coalesce(old_id, concat('cus_', substring(sha256(concat('run2|', members)), 1, 28))) AS customer_id FROM m
    JOIN keys ON keys.component = m.component LEFT JOIN aged ON aged.component = m.component AND rn = 1""")
def identities_that_live_on(spark, d):
    k = F.col("c_custkey")
    c = spark.read.parquet(f"{d}/customer.parquet")
    text = lambda p, n: F.concat(F.lit(p), F.floor(k / n).cast("string"))
    mapping = c.select(F.concat(F.lit("r"), k.cast("string")).alias("record_key"), text("m", 6).alias("component"))
    old = c.where(k % 7 != 0).select(F.concat(F.lit("r"), k.cast("string")).alias("record_key"), text("o", 4).alias("customer_id"))
    born = old.select("customer_id").distinct().withColumn("created_at", (10000 - F.substr("customer_id", F.lit(2)).cast("long")).cast("string"))
    return graph.persistent_ids(mapping, old, born, "run2")[0].select("record_key", "customer_id")
