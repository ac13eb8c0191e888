"""A release: frozen tables, identities that live on, what stewards get, the gold projections, and the manifest that ties them together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.operators import golden
from kinweave.operators.tables import Versions, insert_only
from kinweave.sources.guests import COLUMNS

# The tables that a release freezes.
FROZEN = ("source_snapshot", "candidate_pairs", "pair_features", "match_decisions", "customer_mapping", "gold_customer_profile", "gold_field_provenance", "component_quarantine")
# End of fixed values.
HISTORY = ("record_key", "customer_id", "valid_from", "valid_to", "release_id")


def freeze_release(store: Versions, tables: dict[str, DataFrame], run_id: str) -> dict[str, str]:
    """Every table of ``FROZEN`` under the release's name, by table. Again with equal content is fine; other content, or a table that is
    missing or not one of them, is refused before anything is written."""
    if set(tables) != set(FROZEN):
        raise ValueError(f"a release has other tables: {sorted(set(tables) ^ set(FROZEN))}")
    names = {t: f"frozen_{t}_{run_id.replace('-', '_')}" for t in FROZEN}
    for t, name in names.items():
        store.freeze(name, tables[t])
    return names


def registered(registry: DataFrame, mapping: DataFrame, now: Column) -> DataFrame:
    """``(customer_id, created_at)`` with the ids that are new."""
    return insert_only(registry, mapping.select("customer_id").distinct().withColumn("created_at", now), ["customer_id"])


def identity_history(history: DataFrame, mapping: DataFrame, now: Column, run_id: str) -> DataFrame:
    """``HISTORY`` with the open rows closed whose record has another customer or is gone, and a row opened for every record
    that then has none with its customer."""
    current = mapping.select("record_key", F.col("customer_id").alias("__c"))
    ended = F.col("valid_to").isNull() & ~F.coalesce(F.col("customer_id") == F.col("__c"), F.lit(False))
    closed = history.join(current, "record_key", "left").withColumn("valid_to", F.when(ended, now).otherwise(F.col("valid_to"))).select(*HISTORY)
    live = closed.where("valid_to IS NULL").select("record_key", "customer_id")
    opened = mapping.select("record_key", "customer_id").join(live, ["record_key", "customer_id"], "left_anti")
    kind = history.schema["valid_to"].dataType
    return closed.unionByName(opened.select("record_key", "customer_id", now.cast(kind).alias("valid_from"), F.lit(None).cast(kind).alias("valid_to"), F.lit(run_id).alias("release_id")))


def alias_log(log: DataFrame, aliases: DataFrame, run_id: str) -> DataFrame:
    """``(retired_customer_id, surviving_customer_id, release_id)`` with the release's aliases, each once."""
    new = aliases.select(F.col("old_id").alias("retired_customer_id"), F.col("customer_id").alias("surviving_customer_id"), F.lit(run_id).alias("release_id"))
    return insert_only(log, new, ["retired_customer_id", "release_id"])


def deferred_cases(cases: DataFrame, run_id: str) -> DataFrame:
    """``(release_id, component, case_key, case_records, case_pairs)`` of the components whose case is beyond the bounds."""
    return cases.where("deferred").select(F.lit(run_id).alias("release_id"), "component", F.col("case_component").alias("case_key"), F.col("records").alias("case_records"), F.col("pairs").alias("case_pairs"))


def provisional_id(component: str | Column) -> Column:
    return F.concat(F.lit(golden.PROVISIONAL), F.substring(F.sha2(component, 256), 1, golden.PROVISIONAL_LENGTH))


def operational_sources(snapshot: DataFrame) -> DataFrame:
    return snapshot.select("record_key", *COLUMNS)


def operational_mapping(mapping: DataFrame, touched: DataFrame, deferred: DataFrame, run_id: str, resolver: str) -> DataFrame:
    """Records with customer and provisional id; ``cluster_requires_review`` where the component is touched and not deferred."""
    asked = touched.select("component").distinct().join(deferred.select("component"), "component", "left_anti").withColumn("__q", F.lit(True))
    return mapping.join(asked, "component", "left").select(
        F.lit(run_id).alias("resolution_run_id"), F.lit(resolver).alias("resolver_version"), "record_key", "customer_id",
        provisional_id("component").alias("provisional_customer_id"), F.coalesce("__q", F.lit(False)).alias("cluster_requires_review"))


def review_evidence(decisions: DataFrame, operational: DataFrame, run_id: str) -> DataFrame:
    """Decisions with a record under review on either side, said as evidence; ``bf_`` and ``gamma_`` columns pass.

    Flags are 0 and 1 as stewards read them, of those that ``decisions`` has.
    """
    asked = operational.where("cluster_requires_review").select("record_key")
    left, right = asked.select(F.col("record_key").alias("left_record_key"), F.lit(True).alias("__l")), asked.select(F.col("record_key").alias("right_record_key"), F.lit(True).alias("__r"))
    held = decisions.join(left, "left_record_key", "left").join(right, "right_record_key", "left").where("__l OR __r")
    flags = {"address_agreement": "home_address_exact", "name_exact": "name_exact", "dob_agreement": "valid_dob_exact", "cross_script": "multilingual_name_pair", "postcode_agreement": "home_postcode_exact",
             "given_name_exact": "given_name_exact", "family_name_exact": "family_name_exact", "personal_email_conflict": "personal_email_disagrees", "personal_phone_conflict": "personal_phone_disagrees",
             "shared_email_exact": "shared_email_exact", "shared_phone_exact": "shared_phone_exact"}
    shown = [F.col(c).cast("int").alias(name) for c, name in flags.items() if c in decisions.columns]
    for kind in ("email", "phone"):
        if {f"personal_{kind}_exact", f"shared_{kind}_exact"} <= set(decisions.columns):
            shown.append((F.col(f"personal_{kind}_exact") & ~F.col(f"shared_{kind}_exact")).cast("int").alias(f"rare_{kind}_exact"))
    if "dob_variant" in decisions.columns:
        shown.append(F.coalesce(F.col("dob_variant") == "CONFLICT", F.lit(False)).cast("int").alias("valid_dob_contradiction"))
    said = F.concat("decision", F.lit(": "), "reason", F.lit(" (p="), F.format_number("match_probability", 4), F.lit(")"))
    more = sorted(c for c in decisions.columns if c.startswith(("bf_", "gamma_")) and not c.endswith(("_l", "_r")))
    return held.select(F.lit(run_id).alias("resolution_run_id"), "left_record_key", "right_record_key", "decision", F.col("match_probability").cast("double").alias("evidence_score"),
                       F.array("reason").alias("evidence_reasons"), said.alias("decision_explanation"), *shown, *more)


def gold_links(mapping: DataFrame, snapshot: DataFrame, operational: DataFrame, decisions: DataFrame, run_id: str, resolver: str) -> DataFrame:
    """A row for each record: customer, source ids, status, and the probability of its strongest accepted pair."""
    auto = decisions.where("decision = 'AUTO_MATCH'")
    ends = auto.select(F.col("left_record_key").alias("record_key"), "match_probability").union(auto.select("right_record_key", "match_probability"))
    best = ends.groupBy("record_key").agg(F.max("match_probability").cast("double").alias("strongest_edge_score"))
    status = F.when(F.col("cluster_requires_review"), "REQUIRES_REVIEW").otherwise("AUTO_RESOLVED")
    return (mapping.select("record_key", "customer_id").join(snapshot.select("record_key", "source_system", "source_record_id"), "record_key")
            .join(operational.select("record_key", "cluster_requires_review"), "record_key").join(best, "record_key", "left")
            .select("customer_id", "source_system", "source_record_id", F.lit(run_id).alias("resolution_run_id"), F.lit(resolver).alias("resolver_version"),
                    status.alias("mapping_status"), "cluster_requires_review", "strongest_edge_score"))


def gold_master(profiles: DataFrame, run_id: str, resolver: str) -> DataFrame:
    """Golden profiles under their release."""
    named = {"home_address_json": "home_address", "work_address_json": "work_address"}
    return profiles.withColumnsRenamed(named).select(F.lit(run_id).alias("resolution_run_id"), F.lit(resolver).alias("resolver_version"), *[named.get(c, c) for c in profiles.columns])


def resolver_of(decisions: DataFrame) -> str:
    """The one resolver version of a release's decisions; none or several are an error."""
    found = [r[0] for r in decisions.select("resolver_version").distinct().limit(3).collect()]
    if len(found) != 1:
        raise ValueError(f"one resolver version per release, not {found}")
    return found[0]


def manifest(tables: dict[str, tuple[str, int, DataFrame]], cases: DataFrame, run_id: str, resolver: str) -> dict:
    """The release as a document: by role (``sources``, ``mappings``, ``decisions``) table name, version and rows, and the cases in numbers.

    Refuses a release whose sources and mappings differ in rows.
    """
    snapshots = {role: {"table": name, "version": version, "row_count": df.count()} for role, (name, version, df) in tables.items()}
    if snapshots["sources"]["row_count"] != snapshots["mappings"]["row_count"]:
        raise ValueError(f"{snapshots['sources']['row_count']} sources, {snapshots['mappings']['row_count']} mappings")
    return {"source_run_id": run_id, "snapshots": snapshots, "metadata": {"resolver_version": resolver, **case_numbers(cases).first().asDict()}}


def case_numbers(cases: DataFrame) -> DataFrame:
    """One row: cases to review, and cases and records that are deferred."""
    one = cases.groupBy("case_component").agg(F.max("deferred").alias("deferred"), F.max("records").alias("records"))
    held = F.sum(F.when(F.col("deferred"), F.col("records")))
    return one.agg(F.count_if(~F.col("deferred")).alias("steward_cases"), F.count_if("deferred").alias("deferred_oversized_cases"), F.coalesce(held, F.lit(0)).cast("long").alias("deferred_oversized_records"))
