"""Constrained identity graph and identities that persist between runs."""

from __future__ import annotations

from collections import defaultdict
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.components import connected_components
from kinweave.runtime import discard, materialize

# Size bound, cannot-link reasons, veto names, identity format.
MAX_COMPONENT = 100
CANNOT_LINK = ("SHARED_CONTACT_DIFFERENT_PEOPLE", "SAME_BIRTH_FAMILY_GIVEN_CONFLICT")
DOB_VETO, SIZE_VETO, LINK_VETO = "COMPONENT_DOB_CONFLICT", "COMPONENT_SIZE_LIMIT", "COMPONENT_CANNOT_LINK"
ID_PREFIX, ID_LENGTH = "cus_", 28
# End of fixed values.


def never_joined() -> Column:
    """Whether a decision keeps its pair's records from sharing a component."""
    clash = (F.col("valid_dob_conflict") & (F.col("dob_variant") == "CONFLICT")) | F.col("reason").isin(*CANNOT_LINK)
    return F.coalesce(clash, F.lit(False))


def cannot_links(decisions: DataFrame) -> DataFrame:
    """Pairs that may never share a component."""
    return decisions.where(never_joined()).select("left_record_key", "right_record_key")


def _may_be_one(a, b) -> bool:
    return a == b or (a.year == b.year and a.month == b.day and a.day == b.month)


def merge(edges: list[tuple[str, str, float]], dobs: dict[str, object], denied: dict[str, set[str]], max_size: int) -> tuple[dict[str, str], list[tuple[str, str, str]]]:
    """Strongest edge first; a merge that would break a whole group's constraints is refused, with its reason."""
    group = {k: k for e in edges for k in e[:2]}
    members = {k: [k] for k in group}
    dates = {k: {dobs[k]} if dobs.get(k) is not None else set() for k in group}
    refused = []
    by_key = sorted(edges, key=itemgetter(0, 1))
    for a, b, _ in sorted(by_key, key=itemgetter(2), reverse=True):  # stable: keys decide among equals
        keep, gone = sorted((group[a], group[b]))
        if keep == gone:
            continue
        small, large = sorted((members[keep], members[gone]), key=len)
        if not all(_may_be_one(x, y) for x in dates[keep] for y in dates[gone]):
            refused.append((a, b, DOB_VETO))
        elif len(small) + len(large) > max_size:
            refused.append((a, b, SIZE_VETO))
        elif any(group[x] in (keep, gone) and group[x] != group[k] for k in small for x in denied.get(k, ()) if x in group):
            refused.append((a, b, LINK_VETO))
        else:
            for k in members[gone]:
                group[k] = keep
            members[keep] += members.pop(gone)
            dates[keep] |= dates.pop(gone)
    return group, refused


def constrained_components(records: DataFrame, edges: DataFrame, forbidden: DataFrame, max_size: int = MAX_COMPONENT,
                          max_records: int = 250_000, max_edges: int = 2_000_000) -> tuple[DataFrame, DataFrame]:
    """(``record_key, component``, ``left_record_key, right_record_key, reason`` of refused edges).

    The greedy order is global, but no step looks beyond the groups it merges and these never leave a
    connected component of the edges. So components are found first and merged each in a task.
    A component of more than ``max_records`` records or ``max_edges`` edges is refused, as one task would hold it; nothing is
    cut. Records without an edge are components of their own. Keys may be of any type that has an order.
    """
    where = connected_components(edges, "left_record_key", "right_record_key")
    of = lambda c: where.select(F.col("node").alias(c), F.col("component").alias(f"{c}_cc"))
    own = edges.join(of("left_record_key"), "left_record_key").select(
        F.col("left_record_key_cc").alias("cc"), F.lit("edge").alias("kind"), F.col("left_record_key").alias("a"), F.col("right_record_key").alias("b"), F.col("score").cast("double").alias("score"), F.lit(None).cast("date").alias("dob"))
    large = where.groupBy(F.col("component").alias("cc")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_records).select("cc").union(
        own.groupBy("cc").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_edges).select("cc"))
    if found := materialize(large, "large").limit(5).collect():
        raise ValueError(f"components beyond {max_records} records or {max_edges} edges: {[r.cc for r in found]}")
    bans = forbidden.join(of("left_record_key"), "left_record_key").join(of("right_record_key"), "right_record_key").where("left_record_key_cc = right_record_key_cc").select(
        F.col("left_record_key_cc").alias("cc"), F.lit("ban").alias("kind"), F.col("left_record_key").alias("a"), F.col("right_record_key").alias("b"), F.lit(0.0).alias("score"), F.lit(None).cast("date").alias("dob"))
    dates = records.join(where.select(F.col("node").alias("record_key"), F.col("component").alias("cc")), "record_key").where("dob_usable IS NOT NULL").select(
        "cc", F.lit("dob").alias("kind"), F.col("record_key").alias("a"), F.col("record_key").alias("b"), F.lit(0.0).alias("score"), F.col("dob_usable").alias("dob"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        links, bans, dobs = [], defaultdict(set), {}
        for kind, a, b, s, dob in pdf[["kind", "a", "b", "score", "dob"]].itertuples(index=False):
            if kind == "edge":
                links.append((a, b, s))
            elif kind == "ban":
                bans[a].add(b)
                bans[b].add(a)
            else:
                dobs[a] = dob
        group, refused = merge(links, dobs, bans, max_size)
        # a number must not meet a null in a column, or pandas would round it: a row without a reason is a key and its group
        return pd.DataFrame([(k, g, None) for k, g in group.items()] + refused, columns=["a", "b", "reason"])

    kind = own.schema["a"].dataType.simpleString()
    done = materialize(own.unionByName(bans).unionByName(dates).groupBy("cc").applyInPandas(run, f"a {kind}, b {kind}, reason string"), "groups")
    discard(where)
    mapped = done.where("reason IS NULL").select(F.col("a").alias("record_key"), F.col("b").alias("component"))
    mapping = records.select("record_key").join(mapped, "record_key", "left").select("record_key", F.coalesce("component", "record_key").alias("component"))
    return mapping, done.where("reason IS NOT NULL").select(F.col("a").alias("left_record_key"), F.col("b").alias("right_record_key"), "reason")


def persistent_ids(mapping: DataFrame, previous: DataFrame, created: DataFrame, run_id: str) -> tuple[DataFrame, DataFrame]:
    """(``record_key, component, customer_id``, ``old_id, customer_id`` aliases).

    An old id claims the component that holds most of its records; of a component's claimants the oldest
    lives on and the others become aliases. Other components get an id made from the run and their members.
    ``previous`` is (record_key, customer_id), ``created`` (customer_id, created_at). Keys are digits or bytes, with the same ids.
    """
    top = lambda keys, *order: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    held = mapping.join(previous.withColumnRenamed("customer_id", "old_id"), "record_key").groupBy("old_id", "component").agg(F.count(F.lit(1)).alias("n"))
    claims = held.withColumn("rn", top(["old_id"], F.desc("n"), "component")).where("rn = 1").select("old_id", "component")
    aged = claims.join(created.select(F.col("customer_id").alias("old_id"), F.col("created_at").cast("string").alias("born")), "old_id", "left")
    ranked = aged.withColumn("rn", top(["component"], F.coalesce("born", F.lit("")), "old_id"))
    living = ranked.where("rn = 1").select("component", F.col("old_id").alias("kept_id"))
    # members are bounded by the component size
    digits = (lambda k: F.lower(F.hex(k))) if mapping.schema["record_key"].dataType.typeName() == "binary" else (lambda k: k)
    members = mapping.groupBy("component").agg(F.array_join(F.transform(F.array_sort(F.collect_list("record_key")), digits), "|").alias("m"))
    fresh = F.concat(F.lit(ID_PREFIX), F.substring(F.sha2(F.concat(F.lit(run_id + "|"), F.col("m")), 256), 1, ID_LENGTH))
    ids = members.join(living, "component", "left").select("component", F.coalesce("kept_id", fresh).alias("customer_id"))
    aliases = ranked.where("rn > 1").join(living, "component").select("old_id", F.col("kept_id").alias("customer_id"))
    return mapping.join(ids, "component"), aliases
