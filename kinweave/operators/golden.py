"""Survivorship, golden profiles and the release's projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators.components import connected_components

# Fields of a profile with the rule that picks them, case bounds, prefix and length of a component's provisional id.
RULES = {
    "full_name": "priority", "given_name": "priority", "family_name": "priority", "personal_email": "recent", "personal_phone": "recent", "work_email": "recent",
    "work_phone": "recent", "dob_usable": "priority", "home_address": "recent", "work_address": "recent", "company_name": "recent"}
ADDRESS = {"line1": "address_line1", "suburb": "suburb", "state": "state", "postcode": "postcode", "country": "country"}
MAX_RECORDS, MAX_PAIRS = 50, 1225
PROVISIONAL, PROVISIONAL_LENGTH = "cmp_", 28
# End of fixed values.
FIELDS = tuple(RULES)
#: Fields that a profile names otherwise.
NAMED = {"dob_usable": "date_of_birth", "home_address": "home_address_json", "work_address": "work_address_json"}


def _values() -> dict[str, F.Column]:
    """What a contact record offers for each field. Emails and phones are the normalised ones, so that a shared or role contact
    offers none; an address is one value, and only where its first line is usable."""
    words = lambda c: F.when(F.trim(c) != "", F.trim(c))
    parts = F.concat_ws(" ", "given_name", "family_name")
    out = {c: words(c) for c in ("given_name", "family_name", "company_name")}
    out["full_name"] = F.when(F.col("full_name") != "", F.col("full_name")).otherwise(parts)
    out |= {c: F.col(f"{c}_n") for c in ("personal_email", "personal_phone", "work_email", "work_phone")}
    out["dob_usable"] = F.col("dob_usable").cast("string")
    for kind in ("home", "work"):
        whole = F.to_json(F.struct(*[F.col(f"{kind}_{column}").alias(name) for name, column in ADDRESS.items()]))
        out[f"{kind}_address"] = F.when(F.col(f"{kind}_address_n").isNotNull(), whole)
    return {f: out[f] for f in FIELDS}


def field_candidates(mapping: DataFrame, contacts: DataFrame) -> DataFrame:
    """``(customer_id, record_key, source_system, source_updated_at, source_priority, field, value)`` of contact records; blank values are left out."""
    rows = F.inline(F.array(*[F.struct(F.lit(f).alias("field"), v.alias("value")) for f, v in _values().items()]))
    long = contacts.join(mapping.select("record_key", "customer_id"), "record_key").select(
        "customer_id", "record_key", "source_system", "source_updated_at", "source_priority", rows)
    return long.where("value <> ''")


def survivorship_rules(current: DataFrame | None, spark: SparkSession) -> DataFrame:
    """``(field, ordering)``: the given rules, and the default for every field that they lack.

    Refuses a field with two rules, and an ordering that is neither ``priority`` nor ``recent``.
    """
    default = spark.createDataFrame(list(RULES.items()), "field string, ordering string")
    if current is None:
        return default
    if not current.groupBy("field").count().where("count > 1").isEmpty():
        raise ValueError("a field has several survivorship rules")
    if not current.where("ordering IS NULL OR ordering NOT IN ('priority', 'recent')").isEmpty():
        raise ValueError("a survivorship rule is neither priority nor recent")
    return current.select("field", "ordering").unionByName(default.join(current.select("field"), "field", "left_anti"))


def _rank(first: F.Column) -> F.Column:
    """The smallest is picked: later times are smaller, none at all last."""
    return F.struct(first.alias("a"), F.coalesce(-F.unix_micros(F.col("source_updated_at")), F.lit((1 << 63) - 1)).alias("b"), F.col("source_priority").alias("c"), F.col("record_key").alias("d"))


def customer_rows(mapping: DataFrame, contacts: DataFrame) -> DataFrame:
    """Contact records with their customer and what they offer for each field."""
    return contacts.join(mapping.select("record_key", "customer_id"), "record_key").select(
        "customer_id", "record_key", "source_system", "source_updated_at", "source_priority", *[v.alias(f) for f, v in _values().items()])


def customer_summaries(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """A row for each customer of ``customer_rows``: its records, its systems and for each field the struct of the value that survives, null if none does.

    A record is shuffled once, with all its fields, and not once for each field.
    """
    ordering = {r.field: r.ordering for r in rules.where(F.col("field").isin(*FIELDS)).collect()}
    first = {"priority": F.col("source_priority"), "recent": F.lit(0)}
    held = lambda f: F.struct("record_key", "source_system", "source_updated_at", "source_priority", F.col(f).alias("value"))
    best = lambda f: F.min_by(held(f), F.when(F.col(f) != "", _rank(first[ordering[f]]))) if f in ordering else F.first(F.when(F.lit(False), held(f)))
    return rows.repartition("customer_id").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("source_record_count"), F.array_sort(F.collect_set("source_system")).alias("source_systems"), *[best(f).alias(f) for f in FIELDS])


def summary_survivors(summaries: DataFrame) -> DataFrame:
    """``survivors`` out of summaries."""
    rows = F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("x")) for f in FIELDS]))
    return summaries.select("customer_id", rows).where("x IS NOT NULL").select("customer_id", "x.record_key", "x.source_system", "x.source_updated_at", "x.source_priority", "field", "x.value")


def summary_profiles(summaries: DataFrame) -> DataFrame:
    """``golden_profiles`` out of summaries."""
    wide = summaries.select("customer_id", "source_record_count", "source_systems", *[F.col(f)["value"].alias(f) for f in FIELDS])
    return wide.withColumn("dob_usable", F.col("dob_usable").cast("date")).withColumnsRenamed(NAMED)


def survivors(candidates: DataFrame, rules: DataFrame) -> DataFrame:
    """One value for each field of a customer: by source priority where the field's rule asks for it, then newest, source priority, key.

    A field without a rule is left out. A maximum over structs is taken, not a window, so that a customer of very many
    records is summed up before it is shuffled.
    """
    ruled = candidates.join(rules, "field")
    rank = _rank(F.when(F.col("ordering") == "priority", F.col("source_priority")).otherwise(0))
    best = ruled.groupBy("customer_id", "field").agg(F.min_by(F.struct("record_key", "source_system", "source_updated_at", "source_priority", "value"), rank).alias("x"))
    return best.select("customer_id", "x.record_key", "x.source_system", "x.source_updated_at", "x.source_priority", "field", "x.value")


def golden_profiles(picked: DataFrame, mapping: DataFrame, contacts: DataFrame) -> DataFrame:
    """A row for each customer: the surviving values, its records and systems."""
    wide = picked.groupBy("customer_id").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS])
    who = mapping.join(contacts.select("record_key", "source_system"), "record_key").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("source_record_count"), F.array_sort(F.collect_set("source_system")).alias("source_systems"))
    return who.join(wide, "customer_id", "left").withColumn("dob_usable", F.col("dob_usable").cast("date")).withColumnsRenamed(NAMED)


def touched_components(decisions: DataFrame, refused: DataFrame, mapping: DataFrame) -> DataFrame:
    """Components with a record on a REVIEW pair or a refused edge."""
    both = decisions.where("decision = 'REVIEW'").select("left_record_key", "right_record_key").union(refused.select("left_record_key", "right_record_key"))
    keys = both.select(F.col("left_record_key").alias("record_key")).union(both.select(F.col("right_record_key").alias("record_key"))).distinct()
    return mapping.join(keys, "record_key").select("component").distinct()


def component_pairs(decisions: DataFrame, mapping: DataFrame) -> DataFrame:
    """``(left_component, right_component, pairs)`` over canonical component pairs."""
    side = lambda s: mapping.select(F.col("record_key").alias(f"{s}_record_key"), F.col("component").alias(f"{s}_c"))
    both = decisions.select("left_record_key", "right_record_key").join(side("left"), "left_record_key").join(side("right"), "right_record_key")
    return both.groupBy(F.least("left_c", "right_c").alias("left_component"), F.greatest("left_c", "right_c").alias("right_component")).agg(F.count(F.lit(1)).alias("pairs"))


def steward_cases(mapping: DataFrame, touched: DataFrame, decisions: DataFrame, max_records: int = MAX_RECORDS, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """``(case_component, component, records, pairs, deferred)``: components that a steward sees together.

    Seeds are the ``touched`` components. A REVIEW pair between two components joins them if either is a seed; no other
    pair does. ``pairs`` counts the decisions within the case. One beyond the bounds is deferred whole, not cut.
    """
    seeds = touched.select(F.col("component").alias("c")).distinct()
    review = component_pairs(decisions.where("decision = 'REVIEW'"), mapping).where("left_component <> right_component")
    left, right = seeds.select(F.col("c").alias("left_component"), F.lit(True).alias("ls")), seeds.select(F.col("c").alias("right_component"), F.lit(True).alias("rs"))
    crossing = review.join(left, "left_component", "left").join(right, "right_component", "left").where("ls OR rs").select("left_component", "right_component")
    cases = connected_components(crossing.union(seeds.select("c", F.col("c").alias("d"))), "left_component", "right_component").select(
        F.col("node").alias("component"), F.col("component").alias("case_component"))
    sizes = mapping.groupBy("component").agg(F.count(F.lit(1)).alias("n")).join(cases, "component").groupBy("case_component").agg(F.sum("n").alias("records"))
    at = lambda side: cases.select(F.col("component").alias(f"{side}_component"), F.col("case_component").alias(f"{side}_case"))
    within = component_pairs(decisions, mapping).join(at("left"), "left_component").join(at("right"), "right_component").where("left_case = right_case")
    pairs = within.groupBy(F.col("left_case").alias("case_component")).agg(F.sum("pairs").alias("pairs"))
    out = cases.join(sizes, "case_component").join(pairs, "case_component", "left").withColumn("pairs", F.coalesce("pairs", F.lit(0)))
    return out.withColumn("deferred", (F.col("records") > max_records) | (F.col("pairs") > max_pairs))


def identity_links(mapping: DataFrame, decisions: DataFrame, touched: DataFrame) -> DataFrame:
    """``(record_key, customer_id, mapping_status, strongest_edge_score)``."""
    auto = decisions.where("decision = 'AUTO_MATCH'")
    ends = auto.select(F.col("left_record_key").alias("record_key"), "match_probability").union(auto.select(F.col("right_record_key").alias("record_key"), "match_probability"))
    best = ends.groupBy("record_key").agg(F.max("match_probability").alias("strongest_edge_score"))
    flag = touched.select("component", F.lit(True).alias("t"))
    status = F.when(F.col("t"), "REQUIRES_REVIEW").otherwise("AUTO_RESOLVED")
    return mapping.join(flag, "component", "left").join(best, "record_key", "left").select("record_key", "customer_id", status.alias("mapping_status"), "strongest_edge_score")


def match_evidence(decisions: DataFrame) -> DataFrame:
    """Pairs with decision, reason and the vector representations that proposed them; dynamic ``bf_`` and ``gamma_`` columns pass."""
    shown = [c for c in decisions.columns if c.startswith(("bf_", "gamma_")) and not c.endswith(("_l", "_r"))]
    shapes = F.array_join(F.array_sort(F.transform(F.filter("candidate_reasons", lambda r: r.startswith("ANN_")), lambda r: F.lower(F.substr(r, F.lit(5))))), ",")
    return decisions.select("left_record_key", "right_record_key", "decision", "reason", F.format_number("match_probability", 4).alias("probability"), shapes.alias("representations"), *shown)
