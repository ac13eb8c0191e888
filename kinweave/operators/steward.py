"""What stewards see and do: release checks, adapters, case formation, reasons, the queue, decisions and their log.

State is tables: cases as they were imported, and a log of decisions; a case's state is the fold of its log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.operators.components import connected_components
from kinweave.operators.publication import json_text
from kinweave.operators.tables import top_k
from kinweave.runtime import materialize

# Names and parts of names that suggest hidden answers, columns a source may not have, evidence flags and similarities, case
# bounds, level labels, graph reasons and review rules with their tags, gaps in their order, pairs shown in full.
ANSWER_NAMES = (
    "truth_id", "person_id", "true_person_id", "scenario_id", "scenario", "expected_outcome", "expected_decision", "corruption_label", "corruption_type", "is_true_match", "true_match",
    "ground_truth", "gold_label", "match_label", "label", "is_duplicate", "true_customer_id", "entity_id", "clerical_match_score")
ANSWER_PARTS = ("truth", "expected_", "corruption", "scenario", "ground_", "clerical", "hidden_eval")
FORBIDDEN = ("truth_id", "person_id", "scenario_id", "expected_outcome", "expected_decision", "corruption_label")
DOB_FLAGS = ("valid_dob_exact", "valid_dob_contradiction", "left_dob_is_default", "right_dob_is_default")
MAX_RECORDS, MAX_PAIRS = 50, 1225
CASE_PREFIX, CASE_LENGTH = "review-", 32
EXACT_LEVELS = {1: ("Exact", "Exact"), 0: ("Different", "Disagree"), -1: ("Missing", "Missing")}
EDIT_LEVELS = {
    3: ("Exact", "Exact"), 2: ("Close spelling (90%+ similar)", "Normalised edit similarity >= 0.9"), 1: ("Similar spelling (75%+ similar)", "Normalised edit similarity >= 0.75"),
    0: ("Different", "Disagree"), -1: ("Missing", "Missing")}
LEVELS = {"name_n": EDIT_LEVELS, "home_address_n": EDIT_LEVELS, "personal_email_n": EXACT_LEVELS, "personal_phone_n": EXACT_LEVELS, "dob_usable": EXACT_LEVELS}
GRAPH_TAGS = {"COMPONENT_DOB_CONFLICT": "Birth dates conflict", "COMPONENT_CANNOT_LINK": "Cannot-link conflict", "COMPONENT_SIZE_LIMIT": "Group size limit"}
RULE_TAGS = {
    "INSUFFICIENT_EVIDENCE_REVIEW": "No personal contact", "PERSONAL_CONTACT_NAME_CONFLICT": "Contact shared, name differs", "CONFLICTING_PERSONAL_CONTACTS_REVIEW": "Contacts conflict",
    "AMBIGUOUS_COMMON_NAME_ADDRESS": "Common name", "SEMANTIC_CANDIDATE_REVIEW": "Semantic match only"}
GAP_TAGS = {
    "NAME_NOT_EXACT": "Name not exact", "NAME_DIFFERS": "Name differs", "DOB_CONFLICT": "Birth dates conflict", "DOB_DEFAULT": "Default birth date", "DOB_MISSING": "Birth date missing",
    "DOB_DIFFERS": "Birth dates differ", "DOB_UNCONFIRMED": "Birth date unconfirmed", "CONTACT_NOT_PERSONAL": "Contact used by others", "NO_PERSONAL_CONTACT": "No personal contact",
    "EMAIL_DIFFERS": "Emails differ", "PHONE_DIFFERS": "Phones differ"}
OTHER_TAG = "Resolver review"
FULL_DETAIL_PAIRS = 40
# End of fixed values.


# --- checks before anything is read --------------------------------------------------------------
def answer_like(columns: list[str]) -> list[str]:
    return sorted(c for c in columns if c.lower() in ANSWER_NAMES or any(p in c.lower() for p in ANSWER_PARTS))


def preflight(tables: dict[str, tuple[DataFrame | None, int]], required: dict[str, tuple[str, ...]], run_id: str) -> list[str]:
    """All that is wrong with a release's tables, by role: ``(table, declared rows)``, None for a version that does not exist.

    Looked for are missing versions, columns that look like answers, other counts than declared (of the run's rows, where rows name
    their run) and missing columns. An empty list lets the release in.
    """
    problems = []
    for role, (df, rows) in tables.items():
        if df is None:
            problems.append(f"{role}: the version is not in the table's history")
            continue
        if told := answer_like(df.columns):
            problems.append(f"{role}: columns that look like answers: {', '.join(told)}")
        own = df.where(F.col("resolution_run_id") == run_id) if "resolution_run_id" in df.columns else df
        if (n := own.count()) != rows:
            problems.append(f"{role}: {n} rows, the manifest declares {rows}")
        if missing := [c for c in required[role] if c not in df.columns]:
            problems.append(f"{role}: required columns missing: {', '.join(missing)}")
    return problems


def evidence_profile(columns: list[str], known: tuple[str, ...]) -> tuple[str, list[str], list[str]]:
    """(profile, model columns to read, evidence columns to read as null). Evidence with a match probability is a model's; it may lack what
    only rules need, but never the flags on birth dates."""
    if "match_probability" not in columns:
        return "rule_features", [], []
    model = [c for c in ("match_probability", "match_weight", "comparison_match_weights", "decision_rule", "decision_reason") if c in columns]
    if "comparison_match_weights" not in columns:
        for c in columns:
            if c.startswith("bf_") and not c.startswith("bf_tf_adj_"):
                model += [x for x in (c, f"bf_tf_adj_{c[3:]}", f"gamma_{c[3:]}") if x in columns]
    return "model", model, [c for c in known if c not in DOB_FLAGS and c not in columns]


# --- adapters ----------------------------------------------------------------------------------------
def adapt_records(sources: DataFrame) -> DataFrame:
    """Source rows as stewards see them: blanks are null, an address is one line. Refuses columns that are no business of a steward;
    a row without an id stops the query that reads it."""
    if told := sorted(set(FORBIDDEN) & set(sources.columns)):
        raise ValueError(f"columns that may not come in: {told}")
    text = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c).cast("string"))
    line = lambda kind: F.concat_ws(", ", *[text(f"{kind}_{c}") for c in ("address_line1", "suburb", "state", "postcode", "country")])
    ids = [text(c).alias(c) for c in ("record_key", "source_system", "source_record_id")]
    named = {"full_name": "name", "given_name": "given_name", "family_name": "family_name", "personal_email": "email", "personal_phone": "phone", "date_of_birth": "date_of_birth", "work_email": "work_email",
             "work_phone": "work_phone", "company_name": "company_name"}
    out = sources.select(*ids, *[text(c).alias(n) for c, n in named.items()], *[F.when(line(k) != "", line(k)).alias(n) for k, n in (("home", "address"), ("work", "work_address"))])
    whole = F.assert_true(F.col("record_key").isNotNull() & F.col("source_system").isNotNull() & F.col("source_record_id").isNotNull(), F.lit("a source row without its ids"))
    return out.where(whole.isNull())


def pair_problem(flags: tuple[str, ...], similarities: tuple[str, ...], run_id: str) -> Column:
    """Why a pair of evidence is refused; null if it is sound. Columns: both keys, resolution_run_id, decision, evidence_score, the given flags
    and similarities, among them ``DOB_FLAGS``."""
    any_of = lambda conditions: F.coalesce(sum((F.coalesce(c, F.lit(False)).cast("int") for c in conditions), F.lit(0)) > 0, F.lit(False))
    number = lambda c: F.col(c).isNotNull() & (F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        F.when(~F.col("resolution_run_id").eqNullSafe(F.lit(run_id)), "another run's evidence")
        .when(~F.coalesce((F.col("left_record_key") != "") & (F.col("left_record_key") < F.col("right_record_key")), F.lit(False)), "keys are not canonical")
        .when(~F.coalesce(F.col("decision").isin("AUTO_MATCH", "REVIEW", "REJECT"), F.lit(False)), "no such decision")
        .when(any_of([F.col(c).isNotNull() & ~F.col(c).cast("int").isin(0, 1) for c in flags]), "a flag that is neither 0 nor 1")
        .when(any_of([number(c) for c in similarities]), "a similarity that is no number")
        .when(any_of([F.col(c).isNull() for c in DOB_FLAGS]), "flags on birth dates are missing")
        .when((F.col("valid_dob_contradiction").cast("int") == 1) & any_of([F.col(c).cast("int") == 1 for c in DOB_FLAGS if c != "valid_dob_contradiction"]), "flags on birth dates contradict")
        .when(F.col("evidence_score").isNull() | number("evidence_score"), "no score"))


def level_label(comparison: Column, gamma: Column) -> Column:
    """struct(label, detail) of a comparison's level; null for what is not known."""
    out = None
    for c, levels in LEVELS.items():
        for k, (label, detail) in levels.items():
            answer = F.struct(F.lit(label).alias("label"), F.lit(detail).alias("detail"))
            hit = (comparison == c) & (gamma == k)
            out = F.when(hit, answer) if out is None else out.when(hit, answer)
    return out


def weight_trace(weights: Column, match_weight: Column) -> Column:
    """struct(prior, running): the prior as what the comparisons leave of the match weight, and the weight after each comparison."""
    values = F.transform(weights, lambda w: w["weight"])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    prior = match_weight - total(values)
    running = F.transform(values, lambda v, i: F.round(prior + total(F.slice(values, 1, i + 1)), 6))
    return F.struct(F.round(prior, 6).alias("prior"), running.alias("running"))


def weight_scale(pairs: DataFrame) -> DataFrame:
    """``(case_id, scale)``: the largest weight of a case's comparisons, whatever its sign, and one at least."""
    largest = F.array_max(F.transform("weights", lambda w: F.abs(w["weight"])))
    return pairs.groupBy("case_id").agg(F.greatest(F.lit(1.0), F.coalesce(F.max(largest), F.lit(1.0))).alias("scale"))


# --- cases ---------------------------------------------------------------------------------------------
def json_digest(fields: dict[str, Column]) -> Column:
    """Hash of a canonical JSON object; the values are JSON already."""
    parts = [x for k in sorted(fields) for x in (F.lit(f'{"," if k != min(fields) else ""}"{k}":'), fields[k])]
    return F.sha2(F.concat(F.lit("{"), *parts, F.lit("}")), 256)


def form_cases(run_id: str, mapping: DataFrame, pairs: DataFrame, max_records: int = MAX_RECORDS, max_pairs: int = MAX_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(cases ``(case_id, root, records, pairs, review_pairs, oversized)``, members ``(root, record_key, customer_id)``).

    Records of one customer or one provisional component belong together. A group with a record that requires review is a seed; a REVIEW pair
    between two groups joins them if either is one. Cases are the groups that hold a seed. One beyond the bounds is ``oversized``: told,
    not imported, and not cut. ``mapping`` is the operational mapping; ``pairs`` (left_record_key, right_record_key, decision).

    A run's id in the mapping that is another, a record twice, an empty customer and a seed without a component are refused.
    """
    wrong = mapping.where(~F.col("resolution_run_id").eqNullSafe(F.lit(run_id)) | (F.coalesce("customer_id", F.lit("")) == "") | F.col("cluster_requires_review").isNull()
                          | (F.col("cluster_requires_review") & (F.coalesce("provisional_customer_id", F.lit("")) == "")))
    if not wrong.isEmpty() or not mapping.groupBy("record_key").count().where("count > 1").isEmpty():
        raise ValueError("the mapping is not the run's, or not one sound row for each record")
    # customers and components are nodes of their own, marked so that none is taken for a record
    ties = mapping.select("record_key", F.explode(F.array(F.concat(F.lit("\uffff1"), "customer_id"), F.concat(F.lit("\uffff2"), "provisional_customer_id"))).alias("node")).where("node IS NOT NULL")
    group = connected_components(ties, "record_key", "node").select(F.col("node").alias("record_key"), F.col("component").alias("own"))
    placed = materialize(mapping.join(group, "record_key"), "grouped-mapping")
    seeds = placed.where("cluster_requires_review").select("own").distinct()
    at = lambda s: placed.select(F.col("record_key").alias(f"{s}_record_key"), F.col("own").alias(f"{s}_own"))
    held = pairs.join(at("left"), "left_record_key").join(at("right"), "right_record_key").select("left_own", "right_own", (F.col("decision") == "REVIEW").alias("ask"))
    counted = materialize(held.groupBy("left_own", "right_own").agg(F.count(F.lit(1)).alias("pairs"), F.count_if("ask").alias("review_pairs")), "group-pairs")
    seed = lambda s: seeds.select(F.col("own").alias(f"{s}_own"), F.lit(True).alias(f"{s}_seed"))
    crossing = counted.where("review_pairs > 0 AND left_own <> right_own").join(seed("left"), "left_own", "left").join(seed("right"), "right_own", "left").where("left_seed OR right_seed")
    joined = connected_components(crossing.select("left_own", "right_own").union(seeds.select("own", F.col("own").alias("same"))), "left_own", "right_own")
    roots = materialize(joined.select(F.col("node").alias("own"), F.col("component").alias("root")), "case-roots")
    members = materialize(placed.join(roots, "own").select("root", "record_key", "customer_id"), "case-members")
    of = lambda s: roots.select(F.col("own").alias(f"{s}_own"), F.col("root").alias(f"{s}_root"))
    within = counted.join(of("left"), "left_own").join(of("right"), "right_own").where("left_root = right_root").groupBy(F.col("left_root").alias("root")).agg(
        F.sum("pairs").alias("pairs"), F.sum("review_pairs").alias("review_pairs"))
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("records")).join(within, "root", "left").na.fill(0, ["pairs", "review_pairs"])
    sizes = sizes.withColumn("oversized", (F.col("records") > max_records) | (F.col("pairs") > max_pairs))
    # the keys of a case within bounds fit a row
    keys = members.join(sizes.where("NOT oversized").select("root"), "root", "left_semi").groupBy("root").agg(F.array_sort(F.collect_list("record_key")).alias("keys"))
    ident = F.concat(F.lit(CASE_PREFIX), F.substring(json_digest({"records": F.to_json("keys"), "run": json_text(F.lit(run_id))}), 1, CASE_LENGTH))
    return sizes.join(keys, "root", "left").select(F.when(~F.col("oversized"), ident).alias("case_id"), "root", "records", "pairs", "review_pairs", "oversized"), members


def withheld_links(refused: DataFrame, decisions: DataFrame) -> DataFrame:
    """Refused edges with the probability of their pair, if it was scored."""
    return refused.select("left_record_key", "right_record_key", "reason").join(
        decisions.select("left_record_key", "right_record_key", "match_probability"), ["left_record_key", "right_record_key"], "left")


def graph_links(withheld: DataFrame, members: DataFrame, deferred: DataFrame) -> DataFrame:
    """``(case_id, record_key, other_record_key, reason, match_probability, other_case_id, other_deferred)``: a withheld link at each of its
    ends that lies in a case. ``members`` is (case_id, record_key), ``deferred`` (record_key). A link that touches neither a case
    nor a deferred record is an error."""
    here = members.select("record_key", "case_id")
    there = members.select(F.col("record_key").alias("other_record_key"), F.col("case_id").alias("other_case_id"))
    late = deferred.select(F.col("record_key").alias("other_record_key"), F.lit(True).alias("other_deferred")).distinct()
    own_late = deferred.select("record_key", F.lit(True).alias("own_deferred")).distinct()
    ends = withheld.select(F.inline(F.array(*[F.struct(F.col(a).alias("record_key"), F.col(b).alias("other_record_key"), "reason", "match_probability") for a, b in (("left_record_key", "right_record_key"), ("right_record_key", "left_record_key"))])))
    met = ends.join(here, "record_key", "left").join(there, "other_record_key", "left").join(late, "other_record_key", "left").join(own_late, "record_key", "left")
    met = materialize(met.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("other_deferred", "own_deferred")}), "graph-links")
    lost = met.where("case_id IS NULL AND other_case_id IS NULL AND NOT other_deferred AND NOT own_deferred")
    if not lost.isEmpty():
        raise ValueError(f"{lost.count() // 2} withheld links touch neither a case nor a deferred record")
    return met.where("case_id IS NOT NULL").select("case_id", "record_key", "other_record_key", "reason", "match_probability", "other_case_id", "other_deferred")


def link_summary(links: DataFrame) -> DataFrame:
    """``(reason, ends, cases, within_one_case, to_deferred)`` of graph links."""
    return links.groupBy("reason").agg(
        F.count(F.lit(1)).alias("ends"), F.countDistinct("case_id").alias("cases"), F.count_if(F.col("case_id") == F.col("other_case_id")).alias("within_one_case"), F.count_if("other_deferred").alias("to_deferred"))


# --- why a case is in review -----------------------------------------------------------------------
def _on(c: str) -> Column:
    return F.coalesce(F.col(c).cast("int") == 1, F.lit(False))


def _near(c: str) -> Column:
    return F.coalesce(F.col(c) >= 0.9, F.lit(False))


def _listed(*items: Column) -> Column:
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def pair_facts() -> tuple[Column, Column]:
    """(what a pair agrees on, codes of what is not established), from its evidence columns and the birth date's level ``dob_level``."""
    some = _on("given_name_exact") | _on("family_name_exact")
    name = F.when(_on("name_exact"), "exact name").when(_near("name_similarity"), "close name spelling").when(some, F.when(_on("given_name_exact"), "given name").otherwise("family name"))
    name_gap = F.when(_on("name_exact"), None).when(_near("name_similarity"), "NAME_NOT_EXACT").when(some, "NAME_DIFFERS")
    dob_gap = (F.when(_on("valid_dob_exact"), None).when(_on("valid_dob_contradiction"), "DOB_CONFLICT").when(_on("left_dob_is_default") | _on("right_dob_is_default"), "DOB_DEFAULT")
               .when(F.col("dob_level") == "Missing", "DOB_MISSING").when(F.col("dob_level").isNotNull(), "DOB_DIFFERS").otherwise("DOB_UNCONFIRMED"))
    home = F.when(_on("home_address_exact"), "home address").when(_near("address_similarity"), "similar home address").when(_on("home_postcode_exact"), "postcode")
    own, others = _on("rare_email_exact") | _on("rare_phone_exact"), _on("shared_email_exact") | _on("shared_phone_exact")
    contact = F.when(own, F.when(_on("rare_email_exact"), "personal email").otherwise("personal phone"))
    contact_gap = F.when(own, None).when(others, "CONTACT_NOT_PERSONAL").otherwise("NO_PERSONAL_CONTACT")
    agrees = _listed(name, F.when(_on("valid_dob_exact"), "birth date"), home, contact)
    gaps = _listed(name_gap, dob_gap, contact_gap, F.when(_on("personal_email_disagrees"), "EMAIL_DIFFERS"), F.when(_on("personal_phone_disagrees"), "PHONE_DIFFERS"))
    return agrees, gaps


def reason_codes(cases: DataFrame, links: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(case_id, codes)`` of every case: graph reasons in their precedence, then the rules of its REVIEW pairs by number (most first) and
    name, else UNSPECIFIED; after these, rule by rule, the gaps of the strongest pair (``gaps``; ties by keys)."""
    rank = F.array_position(F.array(*map(F.lit, GRAPH_TAGS)), F.col("reason"))
    graph = links.select("case_id", "reason").distinct().select("case_id", rank.cast("long").alias("o"), F.lit(0).cast("long").alias("n"), F.col("reason").alias("code"), F.array().cast("array<string>").alias("gaps"))
    strongest = F.max_by("gaps", F.struct("match_probability", F.col("left_record_key"), F.col("right_record_key"))).alias("gaps")
    rules = pairs.where("decision = 'REVIEW'").groupBy("case_id", "rule").agg(F.count(F.lit(1)).alias("n"), strongest).select(
        "case_id", F.lit(len(GRAPH_TAGS) + 1).cast("long").alias("o"), (-F.col("n")).alias("n"), F.col("rule").alias("code"), "gaps")
    listed = graph.unionByName(rules).groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("o", "n", "code", "gaps"))).alias("x"))
    codes = F.concat(F.transform("x", lambda e: e["code"]), F.flatten(F.transform("x", lambda e: e["gaps"])))
    return cases.select("case_id").distinct().join(listed, "case_id", "left").select("case_id", F.when(F.col("x").isNull(), F.array(F.lit("UNSPECIFIED"))).otherwise(codes).alias("codes"))


def tags(codes: Column) -> Column:
    """At most two different tags for a case's codes."""
    named = F.create_map(*[F.lit(x) for kv in (GAP_TAGS | RULE_TAGS | GRAPH_TAGS).items() for x in kv])
    return F.slice(F.array_distinct(F.transform(codes, lambda c: F.coalesce(F.try_element_at(named, c), F.lit(OTHER_TAG)))), 1, 2)


def rule_checks() -> Column:
    """array<struct<check, result, tone>>: one row for each area that says something, ``for``, ``against`` or ``info``."""
    row = lambda check, result, tone: F.struct(F.lit(check).alias("check"), result.alias("result"), F.lit(tone).alias("tone") if isinstance(tone, str) else tone.alias("tone"))
    say = lambda check, *options: _first([(c, row(check, F.lit(r) if isinstance(r, str) else r, t)) for c, r, t in options])
    percent = lambda c: F.concat(F.round(F.col(c) * 100).cast("int").cast("string"), F.lit("% similar"))
    contact = [say(f"Personal {kind}", (_on(f"rare_{kind}_exact"), "Same, used only by these records", "for"), (_on(f"shared_{kind}_exact"), "Same, but also used by other people", "info"),
                   (_on(f"personal_{kind}_disagrees"), "Different", "against")) for kind in ("email", "phone")]
    silent = contact[0].isNull() & contact[1].isNull() & (F.col("rare_email_exact").isNotNull() | F.col("rare_phone_exact").isNotNull())
    parts = F.concat_ws(", ", percent("name_similarity"), F.when(_on("given_name_exact"), "given name exact"), F.when(_on("family_name_exact"), "family name exact"))
    tone = lambda c: F.when(F.col(c) >= 0.9, "for").otherwise("info")
    left, right = _on("left_dob_is_default"), _on("right_dob_is_default")
    which = F.concat(F.lit("Source default on "), F.concat_ws(" and ", F.when(left, F.col("left_record_key")), F.when(right, F.col("right_record_key"))), F.lit(", ignored"))
    near_home = F.concat(percent("address_similarity"), F.when(_on("home_postcode_exact"), ", postcode same").otherwise(""))
    work = F.concat(F.concat_ws(", ", F.when(_on("company_exact"), "Same company"), F.when(_on("work_address_exact"), "same work address")), F.lit(" (not personal evidence)"))
    return _listed(
        *contact, F.when(silent, row("Personal contact", F.lit("No personal email or phone in common"), "against")),
        say("Name", (_on("name_exact"), "Exact", "for"), (F.col("name_similarity").isNotNull(), parts, tone("name_similarity")), (_on("given_name_exact"), "Given name exact", "info"), (_on("family_name_exact"), "Family name exact", "info")),
        say("Name script", (_on("multilingual_name_pair"), "Written in different scripts", "info")),
        say("Birth date", (_on("valid_dob_exact"), "Same", "for"), (_on("valid_dob_contradiction"), "Conflict", "against"), (left | right, which, "info"),
            (F.col("dob_level") == "Missing", "Missing on at least one record", "info"), (F.col("dob_level").isNotNull(), "Different", "against")),
        say("Home address", (_on("home_address_exact"), "Same", "for"), (F.coalesce(F.col("address_similarity") > 0, F.lit(False)), near_home, tone("address_similarity")), (_on("home_postcode_exact"), "Postcode same", "info")),
        say("Workplace", (_on("company_exact") | _on("work_address_exact"), work, "info")))


def _first(options: list[tuple[Column, Column]]) -> Column:
    out = None
    for condition, answer in options:
        out = F.when(condition, answer) if out is None else out.when(condition, answer)
    return out


def full_detail(pairs: DataFrame, shown: int = FULL_DETAIL_PAIRS) -> DataFrame:
    """The pairs of a case that are shown in full: REVIEW pairs first, then the weakest; ties by keys. ``rank`` from 1."""
    return top_k(pairs, ["case_id"], [(F.col("decision") != "REVIEW").cast("int"), F.coalesce("match_probability", F.lit(1.0)), "left_record_key", "right_record_key"], shown)


# --- the queue -----------------------------------------------------------------------------------------
def queue_rows(cases: DataFrame, pairs: DataFrame, codes: DataFrame) -> DataFrame:
    """Cases with ``pipeline_confidence`` (the lowest score of a REVIEW pair), ``confidence_kind`` (whether such a pair has a model's probability),
    ``review_codes`` and ``tags``."""
    asked = pairs.where("decision = 'REVIEW'").groupBy("case_id").agg(F.min("evidence_score").alias("pipeline_confidence"), F.max(F.col("match_probability").isNotNull()).alias("__m"))
    kind = F.when(F.coalesce("__m", F.lit(False)), "match_probability").otherwise("evidence_score")
    out = cases.join(asked, "case_id", "left").join(codes.select("case_id", F.col("codes").alias("review_codes")), "case_id", "left")
    return out.withColumns({"confidence_kind": kind, "review_codes": F.coalesce("review_codes", F.array().cast("array<string>")), "tags": tags(F.col("review_codes"))}).drop("__m")


def queue_page(rows: DataFrame, status: str, sort: str = "oldest", search: str = "", lean: str = "all", offset: int = 0, limit: int = 50) -> DataFrame:
    """A page of the queue: by import time, or by confidence with cases without one last; ``search`` in the text, whatever its case."""
    if status not in ("REVIEW", "RESOLVED", "DEFERRED") or sort not in ("oldest", "confidence") or lean not in ("all", "same", "different", "unclear") or not 1 <= limit <= 100 or offset < 0 or len(search) > 100:
        raise ValueError("no such filter, order or page")
    found = rows.where(F.col("status") == status)
    if search.strip():
        found = found.where(F.contains(F.lower("search_text"), F.lit(search.strip().lower())))
    order = ["imported_at", "case_id"] if sort == "oldest" else [F.desc_nulls_last("pipeline_confidence"), "case_id"]
    if lean != "all":
        found = found.where(F.col("lean") == lean)
    if lean == "different":  # strongest conflicts first
        order = [F.desc("difference"), *order]
    return found.orderBy(*order).offset(offset).limit(limit)


def lean_counts(rows: DataFrame, status: str) -> DataFrame:
    """``(lean, cases)`` of a status, ``all`` among them."""
    own = rows.where(F.col("status") == status)
    return own.groupBy("lean").agg(F.count(F.lit(1)).alias("cases")).union(own.agg(F.lit("all").alias("lean"), F.count(F.lit(1)).alias("cases")))


def summary(cases: DataFrame, releases: DataFrame) -> DataFrame:
    """One row: the active release, archived releases, and cases by status."""
    counts = cases.agg(*[F.count_if(F.col("status") == s).alias(f"{s.lower()}_cases") for s in ("REVIEW", "RESOLVED", "DEFERRED")])
    told = releases.agg(F.max_by(F.when(F.col("active"), F.col("source_run_id")), F.when(F.col("active"), F.col("created_at"))).alias("source_run_id"), F.count_if(~F.col("active")).alias("archived_releases"))
    return told.join(counts)  # a row each


# --- decisions --------------------------------------------------------------------------------------
def proposal_digest(proposal: str) -> Column:
    """What a steward confirms: a hash of the proposal as it is shown (a struct column, fields by name)."""
    return F.sha2(F.to_json(F.col(proposal), {"ignoreNullFields": "false"}), 256)


def case_states(imported: DataFrame, log: DataFrame) -> DataFrame:
    """``imported`` (case_id, groups, fingerprint) as decisions left it, with ``version`` and ``status``.

    ``log`` is (case_id, applied_case_version, action, groups); the newest version holds.
    """
    last = log.groupBy("case_id").agg(F.max_by(F.struct("applied_case_version", "action", F.col("groups").alias("g")), "applied_case_version").alias("x"))
    out = imported.join(last, "case_id", "left")
    status = F.when(F.col("x").isNull(), "REVIEW").when(F.col("x.action") == "DEFER", "DEFERRED").otherwise("RESOLVED")
    return out.select("case_id", F.coalesce("x.g", "groups").alias("groups"), "fingerprint", F.coalesce("x.applied_case_version", F.lit(1)).alias("version"), status.alias("status"))


def judge_requests(requests: DataFrame, states: DataFrame, log: DataFrame) -> DataFrame:
    """Every request to apply a proposal with its ``outcome``: ``applied``, ``replayed`` or why it is refused.

    ``requests`` is (request_id, case_id, case_version, evidence_fingerprint, action, groups, rationale, actor, mode, origin, trace_id, confirmed_digest,
    confirmation_digest). A request that the log has is replayed, if it is the same; of several for one case version the first by request id is
    applied and the others are stale.
    """
    prior = log.select("request_id", F.struct("case_id", "action", "actor", "mode").alias("__prior"))
    held = requests.join(prior, "request_id", "left").join(states.select("case_id", F.col("groups").alias("__now"), F.col("fingerprint").alias("__f"), "version"), "case_id", "left")
    flat = lambda g: F.array_sort(F.flatten(g))
    n, k = F.size(F.flatten("__now")), F.size("groups")
    same = F.struct("case_id", "action", "actor", "mode").eqNullSafe(F.col("__prior"))
    refused = (
        F.when((F.col("mode") != "auto") & ~F.col("confirmed_digest").eqNullSafe(F.col("confirmation_digest")), "not what was confirmed")
        .when(F.col("__prior").isNotNull(), F.when(same, "replayed").otherwise("request id used for something else"))
        .when(F.col("version").isNull(), "no such case")
        .when(F.col("case_version") != F.col("version"), "the case has changed")
        .when(~F.col("evidence_fingerprint").eqNullSafe(F.col("__f")), "the evidence has changed")
        .when((F.trim("rationale") == "") | (F.trim("actor") == ""), "a rationale and an actor are needed")
        .when(~F.col("mode").isin("manual", "confirm", "auto"), "no such mode")
        .when((F.col("mode") == "auto") & ((F.col("origin") != "agent") | F.col("trace_id").isNull()), "only a traced agent's proposal is applied by itself")
        .when(~F.col("action").isin("MERGE", "SEPARATE", "PARTITION", "DEFER"), "no such action")
        .when(F.col("action") == "DEFER", F.when(~F.col("groups").eqNullSafe(F.col("__now")), "a deferral changes nothing"))
        .when(F.exists("groups", lambda g: F.size(g) == 0) | (flat(F.col("groups")) != flat(F.col("__now"))), "not every record exactly once")
        .when((F.col("action") == "MERGE") & (k != 1), "a merge has one group")
        .when((F.col("action") == "SEPARATE") & (k != n), "a separation has single records")
        .when((F.col("action") == "PARTITION") & ~((k > 1) & (k < n)), "a partition has between one and all"))
    judged = held.withColumn("outcome", refused)
    first = judged.where("outcome IS NULL").groupBy("case_id", "case_version").agg(F.min("request_id").alias("__first"))
    return judged.join(first, ["case_id", "case_version"], "left").withColumn(
        "outcome", F.coalesce("outcome", F.when(F.col("request_id") == F.col("__first"), "applied").otherwise("the case has changed"))).drop("__prior", "__now", "__f", "__first", "version")


def apply_requests(requests: DataFrame, states: DataFrame, log: DataFrame) -> DataFrame:
    """The log with the decisions that are applied; again with the same requests it stays as it is."""
    done = judge_requests(requests, states, log).where("outcome = 'applied'").withColumn("applied_case_version", F.col("case_version") + 1)
    return log.unionByName(done.select(*log.columns))


def action_of(groups: Column) -> Column:
    """What a shape of groups amounts to."""
    return F.when(F.size(groups) == 1, "MERGE").when(F.forall(groups, lambda g: F.size(g) == 1), "SEPARATE").otherwise("PARTITION")


# --- imports and resets --------------------------------------------------------------------------------
def import_outcome(ledger: DataFrame, queue_runs: list[str], run_id: str, digest: str) -> str:
    """What importing a release amounts to: ``import``, ``replay`` or ``replace``. ``ledger`` is (source_run_id, content_digest, active).

    Other content under a known run, an archived run, several active releases, and a queue with cases of another release than the active
    one are refused.
    """
    known = ledger.where(F.col("source_run_id") == run_id).first()
    active = [r.source_run_id for r in ledger.where("active").limit(2).collect()]
    if len(active) > 1:
        raise ValueError("several active releases")
    if set(queue_runs) - set(active):
        raise ValueError("the queue holds cases of a release that is not active")
    if known is None:
        return "replace" if active else "import"
    if known.content_digest != digest:
        raise ValueError("this release was imported with other content")
    if not known.active:
        raise ValueError("this release is archived")
    return "replay"


def content_digest(df: DataFrame, keys: list[str], buckets: int = 256) -> DataFrame:
    """One row ``(rows, digest)``: a hash over the rows in key order, taken in ``buckets`` by a hash of the key, so that no list holds a table."""
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    cut = df.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("b"), F.struct(*keys).alias("k"), F.sha2(row, 256).alias("h"))
    ranged = cut.groupBy("b").agg(F.count(F.lit(1)).alias("n"), *[F.bit_xor(F.conv(F.substring("h", 1 + 12 * i, 12), 16, 10).cast("long")).alias(f"x{i}") for i in range(5)],
                                  *[F.sum(F.conv(F.substring("h", 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")).alias(f"s{i}") for i in range(5)])
    told = F.to_json(F.array_sort(F.collect_list(F.struct("b", "n", *[f"x{i}" for i in range(5)], *[F.col(f"s{i}").cast("string").alias(f"s{i}") for i in range(5)]))))
    return ranged.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.sha2(told, 256).alias("digest"))


def prove_copy(live: DataFrame, archived: DataFrame, keys: list[str]) -> None:
    """Refuses an archive that does not hold exactly the live rows."""
    a, b = content_digest(live, keys).first(), content_digest(archived.select(*live.columns), keys).first()
    if a != b:
        raise ValueError(f"{b.rows} archived rows are not the {a.rows} live ones")


def reset_states(imported: DataFrame, log: DataFrame, fingerprint: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(cases as imported, an empty log). Refuses if the imported cases no longer have the import's ``fingerprint``."""
    if (now := content_digest(imported, keys).first().digest) != fingerprint:
        raise ValueError(f"the imported cases changed: {now}")
    return imported, log.where("false")
