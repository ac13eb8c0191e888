"""Review analytics: cases, reasons, lean, decisions and the reviewed links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lean weights and bounds, reason precedence, truth-like flags, masked fields.
LEAN_WEIGHTS = {"cannot_link": 4, "emails": 2, "birth_dates": 2, "first_names": 1, "graph_dob": 1}
LEAN_DIFFERENT, LEAN_SAME = 2, 0.95
GRAPH_REASONS = ("COMPONENT_CANNOT_LINK", "COMPONENT_DOB_CONFLICT", "COMPONENT_SIZE_LIMIT")
MASKED = ("full_name", "given_name", "family_name", "personal_email", "personal_phone", "date_of_birth", "home_address_line1")
MASK = "[masked]"
# End of fixed values.


def lean(cases: DataFrame) -> DataFrame:
    """``cases`` (cannot_link, emails, birth_dates, first_names, graph_dob as booleans, lowest_probability) with ``difference`` and ``lean``."""
    points = sum((F.when(F.coalesce(F.col(c), F.lit(False)), w).otherwise(0) for c, w in LEAN_WEIGHTS.items()), F.lit(0))
    verdict = F.when(F.col("difference") >= LEAN_DIFFERENT, "different").when((F.col("difference") == 0) & (F.col("lowest_probability") >= LEAN_SAME), "same").otherwise("unclear")
    return cases.withColumn("difference", points).withColumn("lean", verdict)


def case_signals(members: DataFrame, refused: DataFrame, review: DataFrame) -> DataFrame:
    """The lean's signals by case. ``members`` is (case_id, record_key, email_n, dob_usable, given_key)."""
    several = lambda c: F.countDistinct(c) > 1
    own = members.groupBy("case_id").agg(F.count(F.lit(1)).alias("records"), several("email_n").alias("emails"), several("dob_usable").alias("birth_dates"), several("given_key").alias("first_names"))
    who = members.select("case_id", F.col("record_key").alias("left_record_key"))
    held = refused.join(who, "left_record_key").groupBy("case_id").agg(
        F.max(F.col("reason") == GRAPH_REASONS[0]).alias("cannot_link"), F.max(F.col("reason") == GRAPH_REASONS[1]).alias("graph_dob"))
    low = review.join(who, "left_record_key").groupBy("case_id").agg(F.min("match_probability").alias("lowest_probability"), F.count(F.lit(1)).alias("review_pairs"))
    return own.join(held, "case_id", "left").join(low, "case_id", "left")


def probability_text(p: Column) -> Column:
    return F.when(p > 0.999, ">99.9%").otherwise(F.concat(F.format_number(p * 100, 1), F.lit("%")))


def comparison_weights(scored: DataFrame, comparisons: list[str]) -> DataFrame:
    """Per pair the rounded weight of every comparison, and the prior as what is left of the match weight."""
    own = {c: F.round(F.log2(F.col(f"bf_{c}") * F.col(f"tf_{c}")), 6) for c in comparisons}
    total = sum(own.values(), F.lit(0.0))
    rows = F.array(*[F.struct(F.lit(c).alias("comparison"), F.col(f"gamma_{c}").alias("level"), w.alias("weight")) for c, w in own.items()])
    return scored.select("left_record_key", "right_record_key", rows.alias("weights"), F.round(F.col("match_weight") - total, 4).alias("prior_weight"))


def partition_problem(members: Column, groups: Column, action: Column) -> Column:
    """Why groups of records are no partition that fits the action; null if they are."""
    flat = F.flatten(groups)
    n, k = F.size(members), F.size(groups)
    return (
        F.when(F.exists(groups, lambda g: F.size(g) == 0), "empty group")
        .when((F.size(flat) != n) | (F.array_sort(flat) != F.array_sort(members)), "not every record exactly once")
        .when((action == "MERGE") & (k != 1), "a merge has one group")
        .when((action == "SEPARATE") & (k != n), "a separation has single records")
        .when((action == "PARTITION") & ~((k > 1) & (k < n)), "a partition has between one and all")
        .when(~action.isin("MERGE", "SEPARATE", "PARTITION", "DEFER"), "no such action"))


def latest_overrides(events: DataFrame) -> DataFrame:
    """``(source_run_id, record_key, customer_id, case_id, event_id, applied_case_version)`` of each case's newest decision in a release.

    Deferrals change nothing, repeated events count once. What ``event_problems`` and ``overlapping`` tell is not judged here.
    """
    last = events.where("action <> 'DEFER'").groupBy("source_run_id", "case_id").agg(F.max_by(F.struct("event_id", "applied_case_version", "memberships"), F.struct("applied_case_version", "event_id")).alias("e"))
    return last.select("source_run_id", "case_id", "e.event_id", "e.applied_case_version", F.explode("e.memberships").alias("m")).select(
        "source_run_id", "m.record_key", "m.customer_id", "case_id", "event_id", "applied_case_version")


def event_problems(events: DataFrame) -> DataFrame:
    """``(problem, what)``: event ids that came with several contents, and case versions that several events claim."""
    seen = events.groupBy("event_id").agg(F.countDistinct(F.coalesce("content_digest", F.lit(""))).alias("n")).where("n > 1")
    claimed = events.groupBy("source_run_id", "case_id", "applied_case_version").agg(F.countDistinct("event_id").alias("n")).where("n > 1")
    return seen.select(F.lit("event id with other content").alias("problem"), F.col("event_id").alias("what")).union(
        claimed.select(F.lit("several events for a case version"), F.concat_ws("/", "source_run_id", "case_id", F.col("applied_case_version").cast("string"))))


def overlapping(overrides: DataFrame) -> DataFrame:
    """Records of a release that two cases decide, which is an error."""
    return overrides.groupBy("source_run_id", "record_key").agg(F.countDistinct("case_id").alias("cases")).where("cases > 1")


def checked_overrides(events: DataFrame) -> DataFrame:
    """``latest_overrides`` of events that have no problem; the first few problems are named in the error."""
    out = latest_overrides(events)
    wrong = [f"{r.problem}: {r.what}" for r in event_problems(events).limit(5).collect()]
    wrong += [f"record in several cases: {r.record_key}" for r in overlapping(out).limit(5).collect()]
    if wrong:
        raise ValueError("; ".join(wrong))
    return out


def masked(df: DataFrame, on: bool = True) -> DataFrame:
    """Personal fields hidden where they have a value."""
    if not on:
        return df
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.lit(MASK)) for c in MASKED if c in df.columns})


def record_facts(shared: Column, default_date: Column, gamma: Column) -> Column:
    """Why a comparison is missing: excluded (shared contact, default date), no value, or compared."""
    return F.when(gamma >= 0, "compared").when(F.coalesce(shared, F.lit(False)) | F.coalesce(default_date, F.lit(False)), "excluded").otherwise("no value")


def golden_default(chosen: Column, members: Column) -> Column:
    """The chosen record's value if it is in the group and has one, else the first member's that has. ``members`` is array<struct<record_key,value>>."""
    full = F.filter(members, lambda m: m["value"].isNotNull() & (F.trim(m["value"]) != ""))
    own = F.filter(full, lambda m: m["record_key"] == chosen)
    return F.coalesce(F.get(own, F.lit(0))["value"], F.get(full, F.lit(0))["value"])


def parse_manifest(value: dict, allowed: dict[str, str]) -> dict:
    """A release manifest: exactly the expected tables, all in one schema, with version and row count. All problems in one error."""
    import re

    problems, schemas = [], set()
    for name in sorted(set(allowed) | set(value)):
        entry = value.get(name)
        if name not in allowed or not isinstance(entry, dict) or set(entry) != {"table", "version", "row_count"}:
            problems.append(f"{name}: unexpected, missing or malformed")
            continue
        if not re.fullmatch(allowed[name], str(entry["table"])):
            problems.append(f"{name}: table {entry['table']!r}")
        schemas.add(str(entry["table"]).rpartition(".")[0])
        problems += [f"{name}: {k} {entry[k]!r}" for k in ("version", "row_count") if type(entry[k]) is not int or entry[k] < 0]
    if len(schemas) > 1:
        problems.append(f"several schemas: {sorted(schemas)}")
    if problems:
        raise ValueError("; ".join(problems))
    return value
