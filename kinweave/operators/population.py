"""A made-up population, table by table: households, people, jobs, relationships, records. All chance is a hash of a seed, a purpose and a key.

Reference lists (cultures, localities, names, streets, employers) are tables with a weight; ``apportion`` turns it into the
range of a wheel that ``weighted_pick`` finds by an equi-join on buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators.generate import STEP, WHEEL, spin
from kinweave.operators.tables import range_bucket_join

# How a hundred people live together (archetype, households, people in each, roles by place), cohorts of persons by index with a
# household of their own kind (first, last, people in each, first household, archetype, role), the day ages count to, shares of
# surname patterns, the window of relationships and how often contacts drift.
BLUEPRINT = (
    ("solo", 15, 1, ("resident",)), ("couple", 14, 2, ("partner", "partner")), ("family", 12, 3, ("parent", "parent", "adult_child")), ("shared", 4, 3, ("roommate",) * 3),
    ("multigenerational", 1, 5, ("older_relative", "adult", "adult", "younger_relative", "younger_relative")), ("multigenerational", 1, 4, ("older_relative", "adult", "adult", "younger_relative")))
COHORTS = ((1400, 1799, 2, 910_000_000, "shared", "roommate"), (1800, 1999, 2, 920_000_000, "twins", "sibling"))
AS_OF = "2025-12-31"
SURNAMES = {"couple": (35, 35), "family": (65, 95), "multigenerational": (35, 85)}  # under the first: same, under the second: mixed
WINDOW = ("2019-01-01", 2555)
DRIFT = {"phone": (30, 70), "email": (20, 60), "address": (40, 90)}  # of a thousand, with few records and with four or more
# End of fixed values.


class Chance:
    """Numbers below ``n`` by purpose and key."""

    def __init__(self, seed: str):
        self.seed = seed

    def __call__(self, purpose: str, key: str | Column, n: int) -> Column:
        return spin(self.seed, F.lit(purpose), key) % n


def people(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").alias("person_index"))


def memberships(persons: DataFrame) -> DataFrame:
    """``(person_index, household_index, household_archetype, member_ordinal, household_role)``: the blueprint, hundred by hundred, and the cohorts."""
    person, at = F.col("person_index"), F.col("person_index") % 100
    block, out, first, homes = F.floor(person / 100), None, 0, 0
    total = sum(n for _, n, _, _ in BLUEPRINT)
    row = lambda home, kind, place, role: F.struct(home.cast("long").alias("household_index"), F.lit(kind).alias("household_archetype"), place.cast("int").alias("member_ordinal"), role.alias("household_role"))
    for lo, hi, size, base, kind, role in COHORTS:
        hit = person.between(lo, hi)
        answer = row(base + F.floor((person - lo) / size), kind, (person - lo) % size, F.lit(role))
        out = F.when(hit, answer) if out is None else out.when(hit, answer)
    for kind, n, size, roles in BLUEPRINT:
        place = (at - first) % size
        role = F.element_at(F.array(*map(F.lit, roles)), (place + 1).cast("int"))
        out = out.when(at < first + n * size, row(block * total + homes + F.floor((at - first) / size), kind, place, role))
        first, homes = first + n * size, homes + n
    return persons.select("person_index", out.alias("m")).select("person_index", "m.*")


def pick(df: DataFrame, wheel: DataFrame, chance: Chance, purpose: str, key: str, on: list[str] | None = None) -> DataFrame:
    """``df`` with the row of ``wheel`` (lo, hi and others) that the key's spin falls on; rows that no wheel fits stay, with nulls."""
    return range_bucket_join(df, wheel, spin(chance.seed, F.lit(purpose), key), "lo", "hi", STEP, on, "left").drop("lo", "hi")


def households(members: DataFrame, chance: Chance, cultures: DataFrame, localities: DataFrame, families: DataFrame, streets: DataFrame) -> DataFrame:
    """A row for each household: archetype, size, culture, family name, surname pattern, anchor age, address.

    ``cultures`` is a wheel of ``culture``, ``localities`` of (culture, suburb, state, postcode, country, apartment_pct), ``families`` of (culture, family_name), ``streets`` of
    ``street``; the second and third have a wheel for each culture.
    """
    h = members.groupBy("household_index").agg(F.max("household_archetype").alias("household_archetype"), F.count(F.lit(1)).alias("household_size"))
    r = lambda purpose, n: chance(purpose, "household_index", n)
    h = pick(pick(pick(pick(h, cultures, chance, "culture", "household_index"), localities, chance, "locality", "household_index", ["culture"]), families, chance, "surname", "household_index", ["culture"]), streets, chance, "street", "household_index")
    number, band = r("street_no", 1_000_000), r("street_no_band", 100)
    street_no = F.when(band < 62, 1 + number % 48).when(band < 90, 49 + number % 152).otherwise(201 + number % 420)
    unit, flat = 1 + r("unit_no", 14), r("apartment", 100) < F.coalesce("apartment_pct", F.lit(40))
    text = lambda c: c.cast("string")
    plain = F.concat(text(street_no), F.lit(" "), F.col("street"))
    address = (
        F.when(F.col("country") == "AU", F.concat(F.when(flat, F.concat(text(unit), F.lit("/"))).otherwise(""), plain))
        .when(F.col("country") == "US", F.concat(plain, F.when(flat, F.concat(F.lit(" Apt "), text(unit))).otherwise("")))
        .when(F.col("country").isin("GB", "IE"), F.concat(F.when(flat, F.concat(F.lit("Flat "), text(unit), F.lit(", "))).otherwise(""), plain))
        .when(F.col("country").isin("DE", "NL", "IT", "ES", "GR"), F.concat(F.col("street"), F.lit(" "), text(street_no))).otherwise(plain))
    age_band, offset, kind = r("age_band", 100), r("age_offset", 1000), F.col("household_archetype")
    age = (F.when(kind == "solo", F.when(age_band < 55, 22 + offset % 19).when(age_band < 85, 41 + offset % 25).otherwise(66 + offset % 20))
           .when(kind == "couple", F.when(age_band < 50, 25 + offset % 16).when(age_band < 80, 41 + offset % 20).otherwise(61 + offset % 22))
           .when(kind == "family", 42 + offset % 23).when(kind == "multigenerational", 70 + offset % 16).otherwise(20 + offset % 15))
    roll = r("surname_pattern", 100)
    pattern = F.when(F.col("household_size") == 1, "individual").when(kind == "twins", "same")
    for name, (same, mixed) in SURNAMES.items():
        pattern = pattern.when((kind == name) & (roll < same), "same").when((kind == name) & (roll < mixed), "mixed")
    return h.select("household_index", "household_archetype", "household_size", "culture", "family_name", pattern.otherwise("independent").alias("surname_pattern"), age.alias("anchor_age"), flat.alias("is_apartment"),
                    address.alias("address_line1"), "suburb", "state", "postcode", "country")


PLACE = ("address_line1", "suburb", "state", "postcode", "country")


def adopt_addresses(homes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Households that take over the address of another, whole: ``pairs`` is (household_index, anchor_household_index). An anchor that is not there changes nothing."""
    theirs = homes.select(F.col("household_index").alias("anchor_household_index"), *[F.col(c).alias(f"__{c}") for c in PLACE], F.lit(True).alias("__a"))
    met = homes.join(pairs, "household_index", "left").join(theirs, "anchor_household_index", "left")
    return met.withColumns({c: F.when(F.col("__a"), F.col(f"__{c}")).otherwise(F.col(c)) for c in PLACE}).select(*homes.columns)


def canonical_people(members: DataFrame, homes: DataFrame, chance: Chance, given: DataFrame, families: DataFrame) -> DataFrame:
    """A row for each person: sex, date of birth, names. ``given`` has a wheel for each (culture, sex), ``families`` for each culture."""
    p = members.drop("household_archetype").join(homes.select("household_index", "household_archetype", "culture", "family_name", "surname_pattern", "anchor_age", *PLACE), "household_index")
    r = lambda purpose, n: chance(purpose, "person_index", n)
    role, kind, place, age = F.col("household_role"), F.col("household_archetype"), F.col("member_ordinal"), F.col("anchor_age")
    bit = chance("household_sex", "household_index", 2) == 0
    couple = kind.isin("couple", "family") & (place < 2)
    like = chance("same_sex_partner", "household_index", 100) < 7
    sex = F.when(F.when(couple, bit == ((place == 0) | like)).otherwise(r("sex", 2) == 0), "F").otherwise("M")
    years = (
        F.when(kind.isin("solo", "twins") | (role == "resident"), age)
        .when(kind == "couple", F.when(place == 0, age).otherwise(age - 4 + r("partner_age", 11)))
        .when(role == "parent", F.when(place == 0, age).otherwise(age - 4 + r("parent_age", 9)))
        .when(role == "adult_child", F.least(age - 22, F.greatest(F.lit(18), age - 22 - r("child_age", 17))))
        .when(role == "older_relative", age).when(role == "adult", age - 22 - r("adult_age", 12))
        .when(role == "younger_relative", F.greatest(F.lit(18), F.least(age - 52, 18 + r("younger_age", 9)))).otherwise(20 + r("roommate_age", 15)))
    whole = F.greatest(F.lit(18), F.least(F.lit(85), years)).cast("int")
    born = F.date_sub(F.add_months(F.lit(AS_OF).cast("date"), -12 * whole), r("birthday", 365).cast("int"))
    # twins share a birthday
    twin = F.date_add(F.lit("1985-01-01").cast("date"), ((F.col("household_index") * 397) % 5000).cast("int"))
    p = p.withColumns({"sex": sex, "date_of_birth": F.when(kind == "twins", twin).otherwise(born)})
    p = pick(p, given, chance, "given_name", "person_index", ["culture", "sex"])
    own = families.withColumnRenamed("family_name", "own_family_name")
    p = pick(p, own, chance, "own_surname", "person_index", ["culture"])
    shares = F.col("surname_pattern").isin("same", "individual") | ((F.col("surname_pattern") == "mixed") & (place < 2))
    return p.withColumn("family_name", F.when(shares, F.col("family_name")).otherwise(F.col("own_family_name"))).select(
        "person_index", "household_index", "household_role", "culture", "sex", "date_of_birth", "given_name", "family_name", "anchor_age", *PLACE)


def age_on(day: str, born: str | Column) -> Column:
    return F.floor(F.months_between(F.lit(day).cast("date"), born) / 12).cast("int")


def employed(persons: DataFrame, chance: Chance, employers: DataFrame, groups: tuple[tuple[int, int, int], ...] = ()) -> DataFrame:
    """``persons`` with ``employer_key`` or null: by age and chance, from a wheel of employers. Persons of ``groups`` (first, last, size) share one by so many."""
    age, roll = age_on(AS_OF, "date_of_birth"), chance("employed", "person_index", 100)
    likely = F.when(age < 23, 35).when(age < 65, 74).when(age < 71, 25).otherwise(4)
    key, certain = F.col("person_index"), F.lit(False)
    for lo, hi, size in groups:
        hit = F.col("person_index").between(lo, hi)
        key, certain = F.when(hit, F.lit(900_000_000) + F.floor((F.col("person_index") - lo) / size)).otherwise(key), certain | hit
    asked = persons.withColumn("__k", F.when(certain | ((F.col("country") == "AU") & (roll < likely)), key))
    return pick(asked, employers.select("employer_key", "lo", "hi"), chance, "employer", "__k").withColumn("employer_key", F.when(F.col("__k").isNotNull(), F.col("employer_key"))).drop("__k")


def employment_history(persons: DataFrame, employers: DataFrame, chance: Chance) -> DataFrame:
    """``(person_index, sequence, employer_key, valid_from, valid_to)``: the present job, and for some another before it; nobody works before turning 18."""
    n = employers.count()
    r = lambda purpose, m: chance(purpose, "person_index", m)
    now = persons.where("employer_key IS NOT NULL")
    moved_on = F.least(F.lit(AS_OF).cast("date"), F.greatest(F.add_months("date_of_birth", 228), F.date_add(F.lit("2019-07-01").cast("date"), r("job_change_date", 2190).cast("int"))))
    start = F.greatest(F.lit("2018-01-01").cast("date"), F.add_months("date_of_birth", 216))
    before = r("previous_employer", n)
    told = now.withColumns({"__move": moved_on, "__start": start, "__before": before, "__moved": (r("job_change", 100) < 18) & (before != F.col("employer_key"))})
    present = told.select("person_index", F.when(F.col("__moved"), 2).otherwise(1).alias("sequence"), "employer_key", F.when(F.col("__moved"), F.col("__move")).otherwise(F.col("__start")).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    past = told.where("__moved").select("person_index", F.lit(1), F.col("__before").cast("long"), F.least("__start", F.date_sub("__move", 180)), F.date_sub("__move", 1))
    return present.union(past)


def record_counts(persons: DataFrame, chance: Chance, cuts: dict[str, tuple[int, int, int, int]], segment: str = "segment") -> DataFrame:
    """``record_count`` by segment: most have one record, few have up to sixty. ``cuts`` are of ten thousand: one, up to 3, up to 8, up to 20; the rest has more."""
    tier, u = chance("visit_tier", "person_index", 10_000), chance("visit_depth", "person_index", 10_000) / 10_000.0
    at = None
    for name, values in cuts.items():
        listed = F.array(*map(F.lit, values))
        at = F.when(F.col(segment) == name, listed) if at is None else at.when(F.col(segment) == name, listed)
    tail = lambda low, width, power: (low + F.floor(width * F.pow(u, F.lit(power)))).cast("int")
    pair = F.when(chance("visit_pair", "person_index", 100) < 66, 2).otherwise(3)
    return persons.withColumn("__c", at).withColumn("record_count", F.when(tier < F.col("__c")[0], 1).when(tier < F.col("__c")[1], pair).when(tier < F.col("__c")[2], tail(4, 5, 1.6))
                                                   .when(tier < F.col("__c")[3], tail(9, 12, 1.8)).otherwise(tail(21, 40, 2.2))).drop("__c")


def relationship_window(persons: DataFrame, chance: Chance) -> DataFrame:
    """``start_secs`` and ``span_secs`` of a guest's records within the window, from the 18th birthday on; longer for guests of more records."""
    first, days = WINDOW
    r = lambda purpose, n: chance(purpose, "person_index", n)
    adult = F.greatest(F.lit(0), F.datediff(F.add_months("date_of_birth", 216), F.lit(first).cast("date")))
    n = F.col("record_count")
    drawn = F.when(n == 1, 0).when(n <= 3, 30 + r("span", 1066)).when(n <= 8, 365 + r("span", 1462)).otherwise(1095 + r("span", 1461))
    span = F.least(drawn, F.greatest(F.lit(0), days - F.col("__a")))
    out = persons.withColumn("__a", F.least(adult, F.lit(days))).withColumn("__s", span)
    start = F.col("__a") + spin(chance.seed, F.lit("start"), "person_index") % (days + 1 - F.col("__a") - F.col("__s"))
    origin = F.unix_timestamp(F.lit(f"{first} 00:00:00").cast("timestamp"))
    return out.withColumns({"start_secs": origin + start * 86400, "span_secs": F.col("__s") * 86400 + 86399}).drop("__a", "__s")


def drift(persons: DataFrame, chance: Chance, kind: str) -> DataFrame:
    """``<kind>_changed_at``, in seconds, for the few guests of several records whose contact changes within their window; null for the others."""
    few, many = DRIFT[kind]
    hit = (F.col("record_count") >= 2) & (chance(f"drift_{kind}", "person_index", 1000) < F.when(F.col("record_count") >= 4, many).otherwise(few))
    at = F.col("start_secs") + F.floor(F.col("span_secs") * (0.3 + chance(f"drift_{kind}_at", "person_index", 500) / 1000.0)).cast("long")
    return persons.withColumn(f"{kind}_changed_at", F.when(hit, at))


def previous_mailboxes(persons: DataFrame, email: str, domains: tuple[str, ...], chance: Chance) -> DataFrame:
    """``previous_email``: the same local part elsewhere; with a number where that is anyone's present mailbox, or several persons' former one."""
    at = (chance("previous_domain", "person_index", len(domains)) + 1).cast("int")
    listed = F.array(*map(F.lit, domains))
    local, domain = F.substring_index(email, "@", 1), F.substring_index(email, "@", -1)
    other = F.when(F.element_at(listed, at) == domain, F.element_at(listed, at % len(domains) + 1)).otherwise(F.element_at(listed, at))
    wanted = persons.withColumn("__w", F.concat(local, F.lit("@"), other))
    taken = persons.select(F.col(email).alias("__w")).distinct().withColumn("__t", F.lit(True))
    several = wanted.groupBy("__w").agg((F.count(F.lit(1)) > 1).alias("__m"))
    numbered = F.concat(local, (10 + chance("previous_tail", "person_index", 89)).cast("string"), F.lit("@"), F.substring_index("__w", "@", -1))
    met = wanted.join(taken, "__w", "left").join(several, "__w")
    return met.withColumn("previous_email", F.when(F.coalesce("__t", F.lit(False)) | F.col("__m"), numbered).otherwise(F.col("__w"))).drop("__w", "__t", "__m")


def assemble(records: DataFrame, kept: tuple[str, ...], corrupted: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Final records: ``kept`` columns, with the value of each corruption where it strikes, and ``corruption_tags``, those that struck, in order.

    ``corrupted`` is column -> (whether it strikes, what the value becomes); a corruption that changes nothing is no tag.
    """
    struck = {c: F.coalesce(hit, F.lit(False)) & ~value.eqNullSafe(F.col(c)) for c, (hit, value) in corrupted.items()}
    tags = F.filter(F.array(*[F.when(hit, F.lit(f"{c}_changed")) for c, hit in struck.items()]), lambda t: t.isNotNull())
    values = [F.when(struck[c], corrupted[c][1]).otherwise(F.col(c)).alias(c) if c in corrupted else F.col(c) for c in kept]
    return records.select(*values, tags.alias("corruption_tags"))


# --- reference lists -------------------------------------------------------------------------------------
def zipf_weights(df: DataFrame, rank: str, exponent: float = 1.0, shift: float = 0.0) -> DataFrame:
    """``weight``: the share of a rank (from 1) among all under a Zipf law."""
    raw = F.pow(F.col(rank) + shift, F.lit(-exponent))
    total = df.agg(F.sum(raw).alias("__total"))
    return df.join(total).withColumn("weight", raw / F.col("__total")).drop("__total")  # one row


def blended(left: DataFrame, right: DataFrame, key: str, share: float) -> DataFrame:
    """Weights of two lists mixed: ``share`` of the first; a name that one lacks has its part of the other only."""
    a, b = left.select(key, F.col("weight").alias("__a")), right.select(key, F.col("weight").alias("__b"))
    mixed = share * F.coalesce("__a", F.lit(0.0)) + (1 - share) * F.coalesce("__b", F.lit(0.0))
    return a.join(b, key, "full").select(key, mixed.alias("weight"))


# Letters of the Korean and Greek alphabets in Latin writing.
INITIALS = ("g", "kk", "n", "d", "tt", "r", "m", "b", "pp", "s", "ss", "", "j", "jj", "ch", "k", "t", "p", "h")
VOWELS = ("a", "ae", "ya", "yae", "eo", "e", "yeo", "ye", "o", "wa", "wae", "oe", "yo", "u", "wo", "we", "wi", "yu", "eu", "ui", "i")
FINALS = ("", "k", "k", "k", "n", "n", "n", "t", "l", "k", "m", "l", "l", "l", "p", "l", "m", "p", "p", "t", "t", "ng", "t", "t", "k", "t", "p", "t")
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", ("a", "v", "g", "d", "e", "z", "i", "th", "i", "k", "l", "m", "n", "x", "o", "p", "r", "s", "s", "t", "y", "f", "ch", "ps", "o"), strict=True))
# End of fixed values.


def romanised(c: Column) -> Column:
    """Korean syllables and Greek letters in Latin writing, syllable by syllable; what is neither stays. Lower case for what is written anew."""
    plain = F.translate(F.lower(c), "άέήίόύώϊϋ", "αεηιουωιυ")
    chars = F.split(plain, "")
    greek = F.create_map(*[F.lit(x) for kv in GREEK.items() for x in kv])

    def one(x: Column) -> Column:
        at = _code_point(x) - 0xAC00
        part = lambda names, i: F.element_at(F.array(*map(F.lit, names)), (i + 1).cast("int"))
        hangul = F.concat(part(INITIALS, F.floor(at / 588)), part(VOWELS, F.floor((at % 588) / 28)), part(FINALS, at % 28))
        return F.when(at.between(0, 11171), hangul).otherwise(F.coalesce(F.try_element_at(greek, x), x))

    return F.array_join(F.transform(chars, one), "")


def _code_point(x: Column) -> Column:
    """Of a character of up to three bytes in UTF-8."""
    h = F.conv(F.hex(F.encode(x, "UTF-8")), 16, 10).cast("long")
    three = F.shiftright(h, 16).bitwiseAND(F.lit(15)) * 4096 + F.shiftright(h, 8).bitwiseAND(F.lit(63)) * 64 + h.bitwiseAND(F.lit(63))
    return F.when(F.octet_length(x) == 3, three).otherwise(F.lit(0))


def cased(c: Column) -> Column:
    """A name as it is written: a capital after each blank, hyphen and apostrophe, and after Mc."""
    words = F.initcap(F.lower(c))
    parts = lambda v, sign: F.array_join(F.transform(F.split(v, sign), lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2)))), sign)
    mc = lambda w: F.when(w.rlike("^Mc[a-z]"), F.concat(F.lit("Mc"), F.upper(F.substring(w, 3, 1)), F.substr(w, F.lit(4)))).otherwise(w)
    return F.array_join(F.transform(F.split(parts(parts(words, "-"), "'"), " "), mc), " ")


# --- records as systems hold them, truth, facts, gates ---------------------------------------------------
# Kinds of noise with their share of ten thousand, activity tables with their key, place of the time and value range, bands of a population.
NOISE = {"given_slip": 250, "family_slip": 250, "street_slip": 150, "upper": 200, "swapped": 60, "domain_slip": 120, "postcode_off": 80}
FACTS = {
    "sevenrooms_reservations": ("reservation_id", 120_000), "me_and_u_orders": ("order_id", 200_000), "moshtix_tickets": ("ticket_id", 80_000), "momentus_bookings": ("booking_id", 30_000),
    "pos_transactions": ("transaction_id", 500_000), "tokenized_payment_events": ("payment_event_id", 400_000)}
# End of fixed values.


def capture_noise(records: DataFrame, key: str, chance: Chance, nicknames: DataFrame) -> DataFrame:
    """Records as a hurried clerk would key them, and ``noise``, the kinds that struck, in the order of ``NOISE``.

    Slips of given, family and street names, names in capitals, given and family name swapped, an email domain one letter short, a
    postcode one off. ``nicknames`` is (given_name, nickname): a tenth of the persons that have one use it first.
    """
    from kinweave.operators.generate import slip

    strike = {k: chance(k, key, 10_000) < share for k, share in NOISE.items()}
    at = lambda c, purpose: (1 + chance(f"{purpose}_at", key, WHEEL) % F.greatest(F.length(c) - 1, F.lit(1))).cast("int")
    known = records.join(nicknames, "given_name", "left").withColumn("given_name", F.when(F.col("nickname").isNotNull() & (chance("nickname", key, 100) < 10), F.col("nickname")).otherwise(F.col("given_name"))).drop("nickname")
    noisy = known.withColumn("noise", F.filter(F.array(*[F.when(hit, F.lit(k)) for k, hit in strike.items()]), lambda k: k.isNotNull()))
    for column, purpose in (("given_name", "given_slip"), ("family_name", "family_slip"), ("street", "street_slip")):
        kind = 1 + chance(f"{purpose}_kind", key, 3)
        noisy = noisy.withColumn(column, F.when(strike[purpose], slip(F.col(column), kind, at(F.col(column), purpose))).otherwise(F.col(column)))
    for column in ("given_name", "family_name"):
        noisy = noisy.withColumn(column, F.when(strike["upper"], F.upper(column)).otherwise(F.col(column)))
    given, family = F.when(strike["swapped"], F.col("family_name")).otherwise(F.col("given_name")), F.when(strike["swapped"], F.col("given_name")).otherwise(F.col("family_name"))
    short = F.concat(F.substring_index("email", "@", 1), F.lit("@"), F.substr(F.substring_index("email", "@", -1), F.lit(2)))
    off = F.lpad(((F.col("postcode").cast("int") + 1) % 10000).cast("string"), 4, "0")
    return noisy.withColumns({"given_name": given, "family_name": family, "email": F.when(strike["domain_slip"], short).otherwise(F.col("email")), "postcode": F.when(strike["postcode_off"], off).otherwise(F.col("postcode"))})


def truth_tables(records: DataFrame, person: str) -> tuple[DataFrame, DataFrame]:
    """(``identity_record_id, truth_person_id, source_system, evaluation_split, include_in_benchmark``, ``identity_record_id, cohort_name, cohort_value``).

    ``records`` is (record_key, source_system, corruption_tags and the person's column). A person's records share one split; a record without a
    person is in no benchmark. Cohorts are the system and every corruption, or ``none``.
    """
    from kinweave.operators.generate import split_of

    truth = records.select(F.col("record_key").alias("identity_record_id"), F.col(person).cast("string").alias("truth_person_id"), "source_system", split_of(F.col(person)).alias("evaluation_split"), F.col(person).isNotNull().alias("include_in_benchmark"))
    struck = F.when(F.size("corruption_tags") > 0, F.col("corruption_tags")).otherwise(F.array(F.lit("none")))
    cohort = lambda name, values: F.transform(values, lambda v: F.struct(F.lit(name).alias("cohort_name"), v.alias("cohort_value")))
    cohorts = records.select(F.col("record_key").alias("identity_record_id"), F.inline(F.concat(cohort("source_system", F.array("source_system")), cohort("corruption", struck))))
    return truth, cohorts


def activity(spark: SparkSession, table: str, owners: DataFrame, chance: Chance, share: float = 1.0) -> DataFrame:
    """``(<key>, source_record_id, at, value_aud)`` of an activity table: each fact belongs to the owner at a hashed place. ``owners`` is
    (place, source_record_id) with places from 0 up."""
    key, rows = FACTS[table]
    n = owners.count()
    facts = spark.range(int(rows * share)).select(F.col("id").alias(key), chance(f"{table}_owner", "id", max(1, n)).alias("place"), (F.lit(1546300800) + chance(f"{table}_at", "id", WHEEL) * 20).alias("secs"),
                                                  ((500 + chance(f"{table}_value", "id", 45_000)) / 100).cast("decimal(12,2)").alias("value_aud"))
    return facts.join(owners, "place").select(key, "source_record_id", F.timestamp_seconds("secs").alias("at"), "value_aud")


def contract_gates(records: DataFrame, systems: tuple[str, ...]) -> DataFrame:
    """``(gate, value, lo, hi, passed)`` of a table under the source contract: ids whole and unique, systems known, contacts and dates in form, shares in their bands."""
    from kinweave.operators.generate import gate

    bad = lambda condition: F.count_if(F.coalesce(condition, F.lit(False)))
    rate = lambda condition: F.avg(F.when(condition, 1.0).otherwise(0.0))
    key = F.struct("source_system", "source_record_id")
    return gate(records, {
        "rows": (F.count(F.lit(1)), 1, 1e15), "repeated_ids": (F.count(F.lit(1)) - F.countDistinct(key), 0, 0), "missing_ids": (bad(F.col("source_system").isNull() | F.col("source_record_id").isNull()), 0, 0),
        "unknown_systems": (bad(~F.col("source_system").isin(*systems)), 0, 0), "systems": (F.countDistinct("source_system"), len(systems), len(systems)),
        "emails_without_at": (bad(~F.col("personal_email").contains("@")), 0, 0), "phones_with_letters": (bad(F.col("personal_phone").rlike("[A-Za-z]")), 0, 0),
        "born_too_early": (bad(F.col("date_of_birth") < F.lit("1900-01-01").cast("date")), 0, 0), "born_too_late": (bad(F.col("date_of_birth") > F.lit(AS_OF).cast("date")), 0, 0),
        "address_without_postcode": (rate(F.col("home_address_line1").isNotNull() & F.col("home_postcode").isNull()), 0, 0.2), "with_email": (rate(F.col("personal_email").isNotNull()), 0.5, 1), "with_phone": (rate(F.col("personal_phone").isNotNull()), 0.5, 1),
        "with_birth_date": (rate(F.col("date_of_birth").isNotNull()), 0.5, 1), "full_name_whole": (rate(F.col("full_name") == F.concat_ws(" ", "given_name", "family_name")), 0.99, 1)})
