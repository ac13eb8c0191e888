"""Normalised contacts and what the records themselves say about dates and shared contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions import text as norm

# Role mailboxes, sentinel bounds, source priorities.
ROLE_MAILBOX = "^(events|info|bookings|reservations|admin|office|reception)@"
SENTINEL_RECORDS, SENTINEL_SHARE = 25, 0.005
PRIORITIES = {"sevenrooms": 10, "momentus": 20, "me_and_u": 30}
OTHER_PRIORITY, UNKNOWN_PRIORITY = 40, 100
# End of fixed values.


def normalize(snapshot: DataFrame, unicode: bool = True) -> DataFrame:
    """The snapshot with comparable forms beside the original fields."""
    t = lambda c: norm.text(F.col(c), unicode)
    return snapshot.withColumns({
        "name_n": t("full_name"), "given_name_n": t("given_name"), "family_name_n": t("family_name"),
        "email_n": norm.email(F.col("personal_email")), "work_email_n": norm.email(F.col("work_email")),
        "phone_n": norm.phone(F.col("personal_phone")), "work_phone_n": norm.phone(F.col("work_phone")),
        "home_address_n": norm.address(F.col("home_address_line1"), unicode), "work_address_n": norm.address(F.col("work_address_line1"), unicode),
        "postcode_n": norm.blank_to_null(F.trim("home_postcode")),
    }).withColumn("given_key", norm.first_token(F.col("given_name_n")))


def default_dates(contacts: DataFrame, least: int = SENTINEL_RECORDS, share: float = SENTINEL_SHARE) -> DataFrame:
    """``(source_system, date_of_birth, records, share)`` of dates a system fills in by default."""
    counts = contacts.groupBy("source_system", "date_of_birth").agg(F.count(F.lit(1)).alias("records"))
    # of a system there are no more rows now than there are days
    total = F.sum("records").over(Window.partitionBy("source_system"))
    rated = counts.withColumn("share", F.col("records") / F.greatest(total, F.lit(1))).where("date_of_birth IS NOT NULL AND source_system IS NOT NULL")
    return rated.where((F.col("records") >= least) & (F.col("share") >= share))


def usable_dates(contacts: DataFrame, defaults: DataFrame, today: str) -> DataFrame:
    """``dob_is_source_default``, ``dob_usable`` (within 1900 and ``today``, no default) and ``source_priority``."""
    marked = defaults.select("source_system", "date_of_birth", F.lit(True).alias("__d"))
    priority = F.lit(UNKNOWN_PRIORITY)
    known = F.create_map(*[F.lit(x) for kv in PRIORITIES.items() for x in kv])
    priority = F.when(F.col("source_system").isNotNull(), F.coalesce(F.try_element_at(known, F.col("source_system")), F.lit(OTHER_PRIORITY))).otherwise(priority)
    out = contacts.join(marked, ["source_system", "date_of_birth"], "left").withColumn("dob_is_source_default", F.coalesce("__d", F.lit(False))).drop("__d")
    fine = ~F.col("dob_is_source_default") & F.col("date_of_birth").between(F.lit("1900-01-01").cast("date"), F.lit(today).cast("date"))
    return out.withColumns({"dob_usable": F.when(fine, F.col("date_of_birth")), "source_priority": priority})


def prevalence(base: DataFrame) -> DataFrame:
    """Per email and phone: records, different names, and pairs of dates that can't be one person's.

    Date pairs are counted, not listed: of d distinct dates all d (d - 1) / 2 pairs clash but those that swap day
    and month, and these are the two dates that a year and an unordered (day, month) can have. So a
    placeholder shared by very many records is sums only. ``base`` is read twice and should be a stage table.
    """
    long = base.select(
        "record_key", "name_n", "given_key", "family_name_n", "dob_usable",
        F.explode(F.array(F.struct(F.lit("email").alias("kind"), F.col("email_n").alias("value")), F.struct(F.lit("phone").alias("kind"), F.col("phone_n").alias("value")))).alias("c"),
    ).select("*", "c.kind", "c.value").drop("c").where("value IS NOT NULL")
    counts = long.groupBy("kind", "value").agg(
        F.count(F.lit(1)).alias("record_count"), F.countDistinct("name_n").alias("name_count"), F.countDistinct("given_key").alias("given_name_count"),
        F.countDistinct("family_name_n").alias("family_name_count"), F.countDistinct("dob_usable").alias("dob_count"))
    day, month = F.dayofmonth("dob_usable"), F.month("dob_usable")
    either = long.where("dob_usable IS NOT NULL").groupBy("kind", "value", F.year("dob_usable").alias("y"), F.least(day, month).alias("a"), F.greatest(day, month).alias("b")).agg(
        (F.count_if(day < month) > 0).cast("long").alias("one"), (F.count_if(day >= month) > 0).cast("long").alias("other"))
    clashes = either.groupBy("kind", "value").agg(F.sum(F.col("one") + F.col("other")).alias("d"), F.sum(F.col("one") * F.col("other")).alias("swaps"))
    clashes = clashes.select("kind", "value", F.expr("d * (d - 1) div 2 - swaps").alias("incompatible_dob_pairs"))
    return counts.join(clashes, ["kind", "value"], "left").withColumn("incompatible_dob_pairs", F.coalesce("incompatible_dob_pairs", F.lit(0)))


def is_shared() -> F.Column:
    """Whether a prevalence row's contact is shared by several people."""
    return (F.col("incompatible_dob_pairs") > 0) | ((F.col("kind") == "email") & F.col("value").rlike(ROLE_MAILBOX))


def contact_records(base: DataFrame, prevalent: DataFrame) -> DataFrame:
    """Base rows with the contacts that are personal, and how many use them."""
    out = base
    for kind in ("email", "phone"):
        side = prevalent.where(F.col("kind") == kind).select(
            F.col("value").alias(f"{kind}_n"), is_shared().alias(f"{kind}_is_shared"), F.col("record_count").alias(f"{kind}_record_count"), F.col("given_name_count").alias(f"{kind}_given_names"))
        out = out.join(side, f"{kind}_n", "left").withColumn(f"{kind}_is_shared", F.coalesce(f"{kind}_is_shared", F.lit(False)))
        out = out.withColumn(f"personal_{kind}_n", F.when(~F.col(f"{kind}_is_shared"), F.col(f"{kind}_n")))
    return out


def resolved_base(snapshot: DataFrame, today: str = "2026-01-01", unicode: bool = True) -> DataFrame:
    """Snapshot to ``contact_base``. The snapshot is scanned twice, once for two of its columns."""
    return usable_dates(normalize(snapshot, unicode), default_dates(snapshot), today)


def latest(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")
