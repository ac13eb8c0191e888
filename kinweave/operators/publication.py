"""From committed steward decisions to reviewed links and profiles: what is exported, what it may say, and the proof that nothing is lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.operators.release import provisional_id

# Actions, prefix of a steward's identity, fields that a steward may choose.
ACTIONS = ("MERGE", "SEPARATE", "PARTITION", "DEFER")
IDENTITY = "steward-"
GOLDEN_FIELDS = ("name", "given_name", "family_name", "email", "phone", "date_of_birth", "address", "work_email", "work_phone", "work_address", "company_name", "contact_context")
# End of fixed values.


def json_text(c: Column) -> Column:
    """A string as JSON."""
    listed = F.to_json(F.array(c))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def steward_identity(run_id: Column, group: Column) -> Column:
    """The identity of a group of records, whatever their order: a hash of the release and the sorted keys as JSON."""
    return F.concat(F.lit(IDENTITY), F.sha2(F.concat(F.lit("["), json_text(run_id), F.lit(","), F.to_json(F.array_sort(group)), F.lit("]")), 256))


def event_problem(events: DataFrame) -> Column:
    """Why a committed event (case_id, base_case_version, applied_case_version, and its proposal's case_id, case_version, action and groups) is
    refused; null if it is sound."""
    groups, flat, action = F.col("proposal.groups"), F.flatten("proposal.groups"), F.col("proposal.action")
    single = F.forall(groups, lambda g: F.size(g) == 1)
    return (
        F.when(action.isNull() | ~action.isin(*ACTIONS), "no such action")
        .when(~F.coalesce(F.col("proposal.case_id") == F.col("case_id"), F.lit(False)), "another case's proposal")
        .when(~F.coalesce((F.col("applied_case_version") == F.col("base_case_version") + 1) & (F.col("proposal.case_version") == F.col("base_case_version")), F.lit(False)), "versions do not follow")
        .when(groups.isNull() | (F.size(groups) < 1) | F.exists(groups, lambda g: F.size(g) < 1), "an empty group")
        .when(F.exists(flat, lambda k: k.isNull() | (k == "")) | (F.size(F.array_distinct(flat)) != F.size(flat)), "a record twice or without a key")
        .when((action == "MERGE") & (F.size(groups) != 1), "a merge has one group")
        .when((action == "SEPARATE") & ~single, "a separation has single records")
        .when((action == "PARTITION") & ((F.size(groups) < 2) | single), "a partition has several groups, one of them with several records"))


def export_events(events: DataFrame) -> DataFrame:
    """Events as they are published: allowlisted columns, memberships by record, and a digest of all that. A deferral has no memberships.

    An event with a problem stops the query that reads it.
    """
    sound = F.assert_true(F.col("__p").isNull(), F.concat(F.lit("event "), F.coalesce("event_id", F.lit("?")), F.lit(": "), F.col("__p")))
    member = lambda g: F.transform(g, lambda k: F.struct(k.alias("record_key"), steward_identity(F.col("source_run_id"), g).alias("customer_id")))
    memberships = F.when(F.col("proposal.action") == "DEFER", F.array().cast("array<struct<record_key:string,customer_id:string>>")).otherwise(
        F.array_sort(F.flatten(F.transform("proposal.groups", member))))
    out = events.withColumn("__p", event_problem(events)).where(sound.isNull()).select(
        "event_id", "case_id", "source_run_id", "base_case_version", "applied_case_version", "actor", "mode", F.col("proposal.action").alias("action"),
        F.col("proposal.proposal_id").alias("proposal_id"), memberships.alias("memberships"))
    return out.withColumn("content_digest", F.sha2(F.to_json(F.struct(*sorted(out.columns)), {"ignoreNullFields": "false"}), 256))


def reviewed_links(mapping: DataFrame, sources: DataFrame, overrides: DataFrame, deferred: DataFrame) -> DataFrame:
    """Every record's link: a steward's word over the pipeline's, and what still waits for a steward, in the queue or deferred.

    ``mapping`` is the operational mapping, ``deferred`` the deferred cases of its release, ``overrides`` those of ``checked_overrides``.
    """
    held = deferred.select(provisional_id("component").alias("provisional_customer_id"), F.col("case_key").alias("deferred_case_key")).distinct()
    said = overrides.select(F.col("source_run_id").alias("resolution_run_id"), "record_key", F.col("customer_id").alias("__c"), F.col("event_id").alias("steward_decision_id"), F.col("case_id").alias("steward_case_id"))
    status = (F.when(F.col("steward_decision_id").isNotNull(), "STEWARD_RESOLVED")
              .when(F.col("cluster_requires_review") | F.col("deferred_case_key").isNotNull(), "REQUIRES_REVIEW").otherwise("PIPELINE_RESOLVED"))
    scope = F.when(F.col("deferred_case_key").isNotNull(), "DEFERRED_OVERSIZED").when(F.col("cluster_requires_review"), "STEWARD_QUEUE")
    return (mapping.join(sources.select("record_key", "source_system", "source_record_id"), "record_key")
            .join(said, ["resolution_run_id", "record_key"], "left").join(held, "provisional_customer_id", "left")
            .select("record_key", "source_system", "source_record_id", F.coalesce("__c", "customer_id").alias("customer_id"), F.col("customer_id").alias("pipeline_customer_id"), "resolution_run_id",
                    status.alias("mapping_status"), scope.alias("review_scope"), "deferred_case_key", "steward_decision_id", "steward_case_id"))


def cardinality(links: DataFrame) -> DataFrame:
    """One row: rows, records, overridden records, deferred records and cases, and deferred rows that a steward resolved or that lack their scope."""
    late = F.col("deferred_case_key").isNotNull() & (F.col("steward_decision_id").isNotNull() | ~F.col("review_scope").eqNullSafe(F.lit("DEFERRED_OVERSIZED")))
    return links.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("record_key").alias("records"), F.count("steward_decision_id").alias("overridden"), F.count("deferred_case_key").alias("deferred_records"),
        F.countDistinct("deferred_case_key").alias("deferred_cases"), F.count_if(late).alias("contradictions"))


def prove(links: DataFrame, rows: int, overridden: int, deferred_records: int, deferred_cases: int) -> None:
    """Refuses links whose cardinality is not what the release and the decisions say."""
    want = {"rows": rows, "records": rows, "overridden": overridden, "deferred_records": deferred_records, "deferred_cases": deferred_cases, "contradictions": 0}
    got = cardinality(links).first().asDict()
    if got != want:
        raise ValueError(f"reviewed links: {got}, not {want}")


def reviewed_fields(choices: DataFrame, overrides: DataFrame, sources: DataFrame) -> DataFrame:
    """Golden-field choices of the decisions that stand, with the source record they come from.

    ``choices`` is (source_run_id, guest_identity, case_id, field_name, field_value, chosen_record_key, decision_id). Choices of superseded
    decisions are left out. One whose record is not a member of its guest by that decision, or whose value its source record
    does not hold, stops the query that reads it.
    """
    live = overrides.select("source_run_id", F.col("event_id").alias("decision_id")).distinct()
    who = overrides.select("source_run_id", F.col("record_key").alias("chosen_record_key"), F.col("customer_id").alias("__c"), F.col("event_id").alias("__e"))
    values = sources.select(F.col("record_key").alias("chosen_record_key"), "source_system", "source_record_id",
                            F.inline(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("__v")) for f in GOLDEN_FIELDS if f in sources.columns])))
    met = choices.join(live, ["source_run_id", "decision_id"]).join(who, ["source_run_id", "chosen_record_key"], "left").join(values, ["chosen_record_key", "field_name"], "left")
    owned = F.coalesce((F.col("__c") == F.col("guest_identity")) & (F.col("__e") == F.col("decision_id")), F.lit(False))
    held = F.col("__v").isNotNull() & F.coalesce(F.col("__v") == F.col("field_value"), F.lit(False))
    checks = F.coalesce(F.assert_true(owned, F.lit("a golden field's record is not its guest's")), F.assert_true(held, F.lit("a golden field's value is not its source's")))
    return met.where(checks.isNull()).select("source_run_id", "guest_identity", "case_id", "field_name", "field_value", "chosen_record_key", "source_system", "source_record_id", "decision_id")


def choice_problems(choices: DataFrame, groups: DataFrame, records: DataFrame) -> DataFrame:
    """``(case_id, group, field_name, problem)`` of golden-field choices that are not allowed.

    ``choices`` is (case_id, group, field_name, record_key), ``groups`` (case_id, group, record_key), ``records`` (record_key and the fields).
    """
    member = groups.select("case_id", "group", "record_key", F.lit(True).alias("__m")).distinct()
    values = records.select("record_key", F.inline(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("__v")) for f in GOLDEN_FIELDS if f in records.columns])))
    met = choices.join(member, ["case_id", "group", "record_key"], "left").join(values, ["record_key", "field_name"], "left")
    problem = (F.when(~F.col("field_name").isin(*GOLDEN_FIELDS), "no such field").when(F.col("__m").isNull(), "not a record of the guest")
               .when(F.coalesce(F.col("__v"), F.lit("")) == "", "the record has no value"))
    return met.withColumn("problem", problem).where("problem IS NOT NULL").select("case_id", "group", "field_name", "problem")


def publication_plan(links: DataFrame, current: DataFrame) -> DataFrame:
    """``(state, resolution_run_id, mapping_status, records)``: what is published now, and what would be."""
    told = lambda df, state: df.groupBy("resolution_run_id", "mapping_status").agg(F.count(F.lit(1)).alias("records")).select(F.lit(state).alias("state"), "resolution_run_id", "mapping_status", "records")
    return told(current, "current").union(told(links, "projected"))
