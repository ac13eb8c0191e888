"""The population generator over short reference lists, as many persons as there are customers; SQL repeats every draw."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators import generate, population
from kinweave.operators.generate import WHEEL, apportion
from kinweave.plans.resolution import BASE, guests
from kinweave.runtime import materialize
from kinweave.sources.guests import SYSTEMS

QUERIES, ORACLE_SQL = {}, {}
SEED = "s1"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# short lists of our own: (weights are whole parts of the wheel, so that SQL's and our ranges agree)
CULTURES = (("north", 5), ("south", 3), ("east", 2))
LOCALITIES = tuple((c, f"{c} {s}", st, p, n, a, w) for c in ("north", "south", "east") for s, st, p, n, a, w in (("hill", "AA", "2000", "AU", 60, 4), ("bay", "BB", "3000", "AU", 20, 3), ("gate", "CC", "1000", "GB", 40, 2), ("plain", "DD", "90001", "US", 30, 1)))
FAMILIES = tuple((c, f"{c}{n}", w) for c in ("north", "south", "east") for n, w in (("son", 5), ("ley", 3), ("ov", 2)))
GIVEN = tuple((c, x, f"{c[:2]}{n}{x.lower()}", w) for c in ("north", "south", "east") for x in ("F", "M") for n, w in (("a", 5), ("b", 3), ("c", 2)))
STREETS = (("Mill Road", 5), ("High Street", 3), ("Park Lane", 2))
EMPLOYERS = tuple((i, 1) for i in range(10))


def wheel(spark, rows, columns: str, group: list[str] | None = None) -> DataFrame:
    """Rows, whose last value is a weight, with their range; each tenth of a group's weight is a tenth of the wheel."""
    df = spark.createDataFrame([(i, *r[:-1], float(r[-1])) for i, r in enumerate(rows)], f"i int, {columns}, weight double")
    return materialize(apportion(df, "weight", "i", group=group).drop("i", "weight"), "wheel")


def _values(rows, names: str, group: int = 0) -> str:
    """The same in SQL: ranges by running sums of weights within the first ``group`` columns."""
    lit = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    out, at = [], {}
    total = {}
    for r in rows:
        total[r[:group]] = total.get(r[:group], 0) + r[-1]
    for r in rows:
        g = r[:group]
        lo = at.get(g, 0)
        hi = lo + r[-1] * WHEEL // total[g]
        at[g] = hi
        out.append("(" + ", ".join(map(lit, [*r[:-1], lo, hi])) + ")")
    return f"(VALUES {', '.join(out)}) t({names}, lo, hi)"


def _r(purpose: str, key: str, n: int | str = WHEEL) -> str:
    spun = f"CAST(concat('0x', substring(sha256(concat('{SEED}|{purpose}|', CAST({key} AS VARCHAR))), 1, 13)) AS BIGINT) % {WHEEL}"
    return f"({spun})" if n == WHEEL else f"({spun} % {n})"


def chance() -> population.Chance:
    return population.Chance(SEED)


def members_of(spark, d) -> DataFrame:
    return population.memberships(population.people(spark, spark.read.parquet(f"{d}/customer.parquet").count()))


def homes_of(spark, members: DataFrame) -> DataFrame:
    return materialize(population.households(
        members, chance(), wheel(spark, CULTURES, "culture string"), wheel(spark, LOCALITIES, "culture string, suburb string, state string, postcode string, country string, apartment_pct int", ["culture"]),
        wheel(spark, FAMILIES, "culture string, family_name string", ["culture"]), wheel(spark, STREETS, "street string")), "households")


def persons_of(spark, d) -> DataFrame:
    members = members_of(spark, d)
    given = wheel(spark, GIVEN, "culture string, sex string, given_name string", ["culture", "sex"])
    return materialize(population.canonical_people(members, homes_of(spark, members), chance(), given, wheel(spark, FAMILIES, "culture string, family_name string", ["culture"])), "people")


MEMBERS = """
  ids AS (SELECT CAST(i AS BIGINT) AS i, CAST(i % 100 AS BIGINT) AS p FROM range((SELECT count(*) FROM customer)) r(i)),
  members AS (SELECT i AS person_index,
    CASE WHEN i BETWEEN 1400 AND 1799 THEN 910000000 + (i - 1400) // 2 WHEN i BETWEEN 1800 AND 1999 THEN 920000000 + (i - 1800) // 2
      ELSE i // 100 * 47 + CASE WHEN p < 15 THEN p WHEN p < 43 THEN 15 + (p - 15) // 2 WHEN p < 79 THEN 29 + (p - 43) // 3
        WHEN p < 91 THEN 41 + (p - 79) // 3 WHEN p < 96 THEN 45 ELSE 46 END END AS household_index,
    CASE WHEN i BETWEEN 1400 AND 1799 THEN 'shared' WHEN i BETWEEN 1800 AND 1999 THEN 'twins' WHEN p < 15 THEN 'solo' WHEN p < 43 THEN 'couple'
      WHEN p < 79 THEN 'family' WHEN p < 91 THEN 'shared' ELSE 'multigenerational' END AS household_archetype,
    CAST(CASE WHEN i BETWEEN 1400 AND 1999 THEN i % 2 WHEN p < 15 THEN 0 WHEN p < 43 THEN (p - 15) % 2 WHEN p < 79 THEN (p - 43) % 3
      WHEN p < 91 THEN (p - 79) % 3 WHEN p < 96 THEN p - 91 ELSE p - 96 END AS INT) AS member_ordinal,
    CASE WHEN i BETWEEN 1400 AND 1799 THEN 'roommate' WHEN i BETWEEN 1800 AND 1999 THEN 'sibling' WHEN p < 15 THEN 'resident'
      WHEN p < 43 THEN 'partner' WHEN p < 79 THEN CASE WHEN (p - 43) % 3 < 2 THEN 'parent' ELSE 'adult_child' END WHEN p < 91 THEN 'roommate'
      WHEN p IN (91, 96) THEN 'older_relative' WHEN p IN (92, 93, 97, 98) THEN 'adult' ELSE 'younger_relative' END AS household_role FROM ids)"""
_H = "household_index"
HOMES = f"""{MEMBERS},
  h0 AS (SELECT household_index, max(household_archetype) AS k, count(*) AS size FROM members GROUP BY 1),
  h1 AS (SELECT h0.*, c.culture FROM h0 JOIN {_values(CULTURES, 'culture')} AS c(culture, lo, hi) ON {_r('culture', _H)} >= c.lo
    AND {_r('culture', _H)} < c.hi),
  h2 AS (SELECT h1.*, l.suburb, l.state, l.postcode, l.country, l.pct, f.family_name, s.street, {_r('street_no', _H, 1000000)} AS sn,
    {_r('street_no_band', _H, 100)} AS band, 1 + {_r('unit_no', _H, 14)} AS unit, {_r('age_band', _H, 100)} AS ab, {_r('age_offset', _H, 1000)} AS ao,
      {_r('surname_pattern', _H, 100)} AS roll, {_r('apartment', _H, 100)} < l.pct AS flat
    FROM h1 JOIN {_values(LOCALITIES, 'culture, suburb, state, postcode, country, pct', 1)} AS l(culture, suburb, state, postcode, country, pct, lo,
      hi) ON l.culture = h1.culture AND {_r('locality', _H)} >= l.lo AND {_r('locality', _H)} < l.hi
    JOIN {_values(FAMILIES, 'culture, family_name', 1)} AS f(culture, family_name, lo, hi) ON f.culture = h1.culture AND {_r('surname', _H)} >= f.lo
      AND {_r('surname', _H)} < f.hi
    JOIN {_values(STREETS, 'street')} AS s(street, lo, hi) ON {_r('street', _H)} >= s.lo AND {_r('street', _H)} < s.hi),
  h3 AS (SELECT *, CAST(CASE WHEN band < 62 THEN 1 + sn % 48 WHEN band < 90 THEN 49 + sn % 152 ELSE 201 + sn % 420 END AS VARCHAR) AS no FROM h2),
  homes AS (SELECT household_index, k AS household_archetype, size AS household_size, culture, family_name,
    CASE WHEN size = 1 THEN 'individual' WHEN k = 'twins' THEN 'same' WHEN k = 'couple' AND roll < 35 THEN 'same'
      WHEN k = 'family' AND roll < 65 THEN 'same' WHEN k = 'family' AND roll < 95 THEN 'mixed'
      WHEN k = 'multigenerational' AND roll < 35 THEN 'same' WHEN k = 'multigenerational' AND roll < 85 THEN 'mixed'
        ELSE 'independent' END AS surname_pattern,
    CASE k WHEN 'solo' THEN CASE WHEN ab < 55 THEN 22 + ao % 19 WHEN ab < 85 THEN 41 + ao % 25
      ELSE 66 + ao % 20 END WHEN 'couple' THEN CASE WHEN ab < 50 THEN 25 + ao % 16 WHEN ab < 80 THEN 41 + ao % 20 ELSE 61 + ao % 22 END
      WHEN 'family' THEN 42 + ao % 23 WHEN 'multigenerational' THEN 70 + ao % 16 ELSE 20 + ao % 15 END AS anchor_age, flat AS is_apartment,
    CASE country WHEN 'AU' THEN concat(CASE WHEN flat THEN concat(CAST(unit AS VARCHAR), '/')
      ELSE '' END, no, ' ', street) WHEN 'US' THEN concat(no, ' ', street, CASE WHEN flat THEN concat(' Apt ', CAST(unit AS VARCHAR)) ELSE '' END)
      ELSE concat(CASE WHEN flat THEN concat('Flat ', CAST(unit AS VARCHAR), ', ')
        ELSE '' END, no, ' ', street) END AS address_line1, suburb, state, postcode, country FROM h3)"""
_P = "person_index"
PEOPLE = f"""{HOMES},
  p0 AS (SELECT m.person_index, m.household_index, m.member_ordinal AS o, m.household_role AS role, h.* EXCLUDE (household_index),
    {_r('household_sex', 'm.household_index', 2)} = 0 AS bit, {_r('same_sex_partner', 'm.household_index', 100)} < 7 AS alike,
    {_r('sex', _P, 2)} = 0 AS f,
      {_r('partner_age', _P, 11)} AS a1, {_r('parent_age', _P, 9)} AS a2, {_r('child_age', _P, 17)} AS a3, {_r('adult_age', _P, 12)} AS a4,
        {_r('younger_age', _P, 9)} AS a5, {_r('roommate_age', _P, 15)} AS a6, {_r('birthday', _P, 365)} AS bd FROM members m
        JOIN homes h ON h.household_index = m.household_index),
  p1 AS (SELECT *, CASE WHEN CASE WHEN household_archetype IN ('couple', 'family') AND o < 2 THEN bit = (o = 0 OR alike) ELSE f END THEN 'F'
    ELSE 'M' END AS sex,
    CAST(greatest(18, least(85, CASE WHEN household_archetype IN ('solo', 'twins') THEN anchor_age WHEN household_archetype = 'couple' THEN CASE
      WHEN o = 0 THEN anchor_age ELSE anchor_age - 4 + a1 END WHEN role = 'parent' THEN CASE WHEN o = 0 THEN anchor_age ELSE anchor_age - 4 + a2 END
      WHEN role = 'adult_child' THEN least(anchor_age - 22, greatest(18, anchor_age - 22 - a3)) WHEN role = 'older_relative' THEN anchor_age
        WHEN role = 'adult' THEN anchor_age - 22 - a4 WHEN role = 'younger_relative' THEN greatest(18, least(anchor_age - 52, 18 + a5))
        ELSE 20 + a6 END)) AS INT) AS years FROM p0),
  people AS (SELECT person_index, p1.household_index, role AS household_role, p1.culture, p1.sex, CASE
    WHEN household_archetype = 'twins' THEN DATE '1985-01-01' + CAST(household_index * 397 % 5000 AS INT)
    ELSE CAST(DATE '2025-12-31' - to_years(years) AS DATE) - CAST(bd AS INT) END AS date_of_birth,
      g.given_name, CASE WHEN surname_pattern IN ('same', 'individual') OR (surname_pattern = 'mixed' AND o < 2) THEN p1.family_name
        ELSE n.family_name END AS family_name, address_line1, suburb, state, postcode, country
    FROM p1 JOIN {_values(GIVEN, 'culture, sex, given_name', 2)} AS g(culture, sex, given_name, lo, hi) ON g.culture = p1.culture AND g.sex = p1.sex
      AND {_r('given_name', _P)} >= g.lo AND {_r('given_name', _P)} < g.hi
    JOIN {_values(FAMILIES, 'culture, family_name', 1)} AS n(culture, family_name, lo, hi) ON n.culture = p1.culture
      AND {_r('own_surname', _P)} >= n.lo AND {_r('own_surname', _P)} < n.hi)"""
HOMES, PEOPLE = (x.replace("t(culture, lo, hi) AS", "AS").replace("t(culture, suburb, state, postcode, country, pct, lo, hi) AS", "AS").replace("t(culture, family_name, lo, hi) AS", "AS").replace("t(street, lo, hi) AS", "AS").replace("t(culture, sex, given_name, lo, hi) AS", "AS") for x in (HOMES, PEOPLE))


@query(f"WITH {MEMBERS} SELECT * FROM members")
def household_members(spark, d):
    return members_of(spark, d)


@query(f"WITH {HOMES} SELECT * FROM homes")
def synthetic_households(spark, d):
    return homes_of(spark, members_of(spark, d))


@query(f"""WITH {HOMES}, anchors AS (SELECT household_index, household_index - 47 AS anchor FROM homes WHERE household_index % 5 = 0)
  SELECT h.household_index, coalesce(a.address_line1, h.address_line1) AS address_line1, coalesce(a.country, h.country) AS country FROM homes h
    LEFT JOIN anchors x ON x.household_index = h.household_index LEFT JOIN homes a ON a.household_index = x.anchor""")
def adopted_addresses(spark, d):
    homes = homes_of(spark, members_of(spark, d))
    pairs = homes.where("household_index % 5 = 0").select("household_index", (F.col("household_index") - 47).alias("anchor_household_index"))
    return population.adopt_addresses(homes, pairs).select("household_index", "address_line1", "country")


@query(f"WITH {PEOPLE} SELECT person_index, household_index, household_role, culture, sex, CAST(date_of_birth AS VARCHAR) AS date_of_birth, given_name, family_name, address_line1, country FROM people")
def canonical_people(spark, d):
    return persons_of(spark, d).select("person_index", "household_index", "household_role", "culture", "sex", F.col("date_of_birth").cast("string").alias("date_of_birth"), "given_name", "family_name", "address_line1", "country")


_AGE = "CAST(date_diff('year', date_of_birth, DATE '2025-12-31') - CASE WHEN strftime(date_of_birth, '%m%d') > '1231' THEN 1 ELSE 0 END AS INT)"
JOBS = f"""{PEOPLE},
  asked AS (SELECT *, CASE WHEN person_index BETWEEN 1000 AND 1099 THEN 900000000 + (person_index - 1000) // 10
    WHEN country = 'AU' AND {_r('employed', _P, 100)} < CASE WHEN {_AGE} < 23 THEN 35 WHEN {_AGE} < 65 THEN 74 WHEN {_AGE} < 71 THEN 25
    ELSE 4 END THEN person_index END AS k FROM people),
  hired AS (SELECT *, CASE WHEN k IS NOT NULL THEN {_r('employer', 'k')} // 1000000 END AS employer_key FROM asked)"""


def hired(spark, d) -> DataFrame:
    return materialize(population.employed(persons_of(spark, d), chance(), wheel(spark, EMPLOYERS, "employer_key long"), ((1000, 1099, 10),)), "employed")


@query(f"WITH {JOBS} SELECT person_index, employer_key FROM hired")
def employer_picks(spark, d):
    return hired(spark, d).select("person_index", "employer_key")


@query(f"""WITH {JOBS},
  told AS (SELECT *, least(DATE '2025-12-31', greatest(CAST(date_of_birth + to_months(228) AS DATE),
    DATE '2019-07-01' + CAST({_r('job_change_date', _P, 2190)} AS INT))) AS move, greatest(DATE '2018-01-01',
    CAST(date_of_birth + to_months(216) AS DATE)) AS start,
    {_r('previous_employer', _P, 10)} AS before, {_r('job_change', _P, 100)} < 18 AND {_r('previous_employer', _P, 10)} <> employer_key AS moved
      FROM hired WHERE employer_key IS NOT NULL)
  SELECT person_index, CASE WHEN moved THEN 2 ELSE 1 END AS sequence, employer_key, CAST(CASE WHEN moved THEN move
    ELSE start END AS VARCHAR) AS valid_from, CAST(NULL AS VARCHAR) AS valid_to FROM told
  UNION ALL SELECT person_index, 1, before, CAST(least(start, move - 180) AS VARCHAR), CAST(move - 1 AS VARCHAR) FROM told WHERE moved""")
def employment_history(spark, d):
    told = population.employment_history(hired(spark, d), spark.createDataFrame(EMPLOYERS, "employer_key long, w int"), chance())
    return told.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


CUTS = {"AU": (6600, 8800, 9690, 9960), "GB": (8800, 9880, 10000, 10000), "US": (3500, 6000, 8000, 9400)}
_CUT = lambda i: "CASE country " + " ".join(f"WHEN '{c}' THEN {v[i]}" for c, v in CUTS.items()) + " END"
_U = f"({_r('visit_depth', _P, 10000)} / 10000.0E0)"
COUNTED = f"""{PEOPLE},
  counted AS (SELECT *, CAST(CASE WHEN {_r('visit_tier', _P, 10000)} < {_CUT(0)} THEN 1 WHEN {_r('visit_tier', _P, 10000)} < {_CUT(1)} THEN CASE
    WHEN {_r('visit_pair', _P, 100)} < 66 THEN 2 ELSE 3 END WHEN {_r('visit_tier', _P, 10000)} < {_CUT(2)} THEN 4 + floor(5 * pow({_U}, 1.6))
    WHEN {_r('visit_tier', _P, 10000)} < {_CUT(3)} THEN 9 + floor(12 * pow({_U}, 1.8)) ELSE 21 + floor(40 * pow({_U}, 2.2)) END AS BIGINT) AS n
      FROM people),
  adult AS (SELECT *, least(2555, greatest(0, date_diff('day', DATE '2019-01-01', CAST(date_of_birth + to_months(216) AS DATE)))) AS a FROM counted),
  spanned AS (SELECT *, least(CASE WHEN n = 1 THEN 0 WHEN n <= 3 THEN 30 + {_r('span', _P, 1066)} WHEN n <= 8 THEN 365 + {_r('span', _P, 1462)}
    ELSE 1095 + {_r('span', _P, 1461)} END, greatest(0, 2555 - a)) AS s FROM adult),
  windowed AS (SELECT *, CAST(1546300800 + (a + {_r('start', _P)} % (2556 - a - s)) * 86400 AS BIGINT) AS start_secs,
    CAST(s * 86400 + 86399 AS BIGINT) AS span_secs FROM spanned)"""


def guests_of(spark, d) -> DataFrame:
    return population.relationship_window(population.record_counts(persons_of(spark, d), chance(), CUTS, "country"), chance())


@query(f"WITH {COUNTED} SELECT person_index, n AS record_count, start_secs, span_secs FROM windowed")
def relationship_windows(spark, d):
    return guests_of(spark, d).select("person_index", F.col("record_count").cast("long").alias("record_count"), "start_secs", "span_secs")


def _drift(kind: str) -> str:
    few, many = population.DRIFT[kind]
    return f"CASE WHEN n >= 2 AND {_r(f'drift_{kind}', _P, 1000)} < CASE WHEN n >= 4 THEN {many} ELSE {few} END THEN start_secs + CAST(floor(span_secs * (0.3E0 + {_r(f'drift_{kind}_at', _P, 500)} / 1000.0E0)) AS BIGINT) END AS {kind}_changed_at"


@query(f"WITH {COUNTED} SELECT person_index, {', '.join(map(_drift, population.DRIFT))} FROM windowed")
def contact_drift(spark, d):
    g = guests_of(spark, d)
    for kind in population.DRIFT:
        g = population.drift(g, chance(), kind)
    return g.select("person_index", *[f"{k}_changed_at" for k in population.DRIFT])


DOMAINS = ("a.example", "b.example", "c.example")


@query(f"""WITH p AS (SELECT c_custkey AS person_index, concat('u', CAST(c_custkey % 200 AS VARCHAR)) AS local, CASE c_custkey % 3 WHEN 0 THEN 'a.example'
      WHEN 1 THEN 'b.example' ELSE 'd.example' END AS dm FROM customer),
  w AS (SELECT *, concat(local, '@', dm) AS email, 1 + {_r('previous_domain', _P, 3)} AS x
    FROM p), v AS (SELECT *, concat(local, '@', CASE WHEN list_extract(['a.example', 'b.example', 'c.example'], x) = dm THEN list_extract(['a.example',
    'b.example', 'c.example'], x % 3 + 1) ELSE list_extract(['a.example', 'b.example', 'c.example'], x) END) AS wanted FROM w),
  s AS (SELECT wanted, count(*) > 1 AS many FROM v GROUP BY 1)
  SELECT person_index, CASE WHEN many OR v.wanted IN (SELECT email
    FROM w) THEN concat(local, CAST(10 + {_r('previous_tail', _P, 89)} AS VARCHAR), '@', split_part(v.wanted, '@', 2))
    ELSE v.wanted END AS previous_email FROM v JOIN s ON s.wanted = v.wanted""")
def previous_mailboxes(spark, d):
    k = F.col("c_custkey")
    p = spark.read.parquet(f"{d}/customer.parquet").select(k.alias("person_index"), F.concat(F.lit("u"), (k % 200).cast("string"), F.lit("@"), F.when(k % 3 == 0, "a.example").when(k % 3 == 1, "b.example").otherwise("d.example")).alias("email"))
    return population.previous_mailboxes(p, "email", DOMAINS, chance()).select("person_index", "previous_email")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND length(c_name) > 2 THEN upper(c_name)
      ELSE c_name END AS c_name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
  array_to_string(list_filter([CASE WHEN c_custkey % 3 = 0 AND upper(c_name) <> c_name THEN 'c_name_changed' END, CASE
    WHEN c_custkey % 5 = 0 THEN 'c_mktsegment_changed' END], lambda t: t IS NOT NULL), ',') AS corruption_tags FROM customer""")
def assembled_records(spark, d):
    k = F.col("c_custkey")
    c = spark.read.parquet(f"{d}/customer.parquet")
    told = population.assemble(c, ("c_custkey", "c_name", "c_mktsegment"), {"c_name": (k % 3 == 0, F.upper("c_name")), "c_mktsegment": (k % 5 == 0, F.lit(None).cast("string"))})
    return told.withColumn("corruption_tags", F.array_join("corruption_tags", ","))


@query("""WITH w AS (SELECT n_nationkey, n_name, pow(n_nationkey + 1 + 2.0, -1.1) AS raw
      FROM nation), z AS (SELECT n_nationkey, n_name, raw / sum(raw) OVER () AS weight FROM w),
  u AS (SELECT n_name, 1.0E0 / 12 AS weight FROM nation WHERE n_nationkey < 12)
  SELECT z.n_name, round(0.25 * z.weight + 0.75 * coalesce(u.weight, 0), 12) AS weight FROM z LEFT JOIN u ON u.n_name = z.n_name""")
def zipf_blend(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet").withColumn("rank", F.col("n_nationkey") + 1)
    zipf = population.zipf_weights(n, "rank", 1.1, 2.0)
    even = n.where("n_nationkey < 12").select("n_name", F.lit(1.0 / 12).alias("weight"))
    return population.blended(zipf, even, "n_name", 0.25).select("n_name", F.round("weight", 12).alias("weight"))


@query("""SELECT * FROM (VALUES ('김민준', 'gimminjun', '김민준'), ('Γιώργος Παπάς', 'giorgos papas', 'Γιώργος Παπάς'), ('o''neil-SMITH mcdonald',
      'o''neil-smith mcdonald', 'O''Neil-Smith McDonald'), ('한 글', 'han geul', '한 글')) t(name, latin, written)""")
def romanised_names(spark, d):
    names = spark.createDataFrame([(n,) for n in ("김민준", "Γιώργος Παπάς", "o'neil-SMITH mcdonald", "한 글")], "name string")
    return names.select("name", population.romanised(F.col("name")).alias("latin"), population.cased(F.col("name")).alias("written"))


_SPUN = "CAST(concat('0x', substring(sha256(concat('{}|', {})), 1, 13)) AS BIGINT) % 10000000"


@query(f"""WITH c AS (SELECT c_custkey AS k, c_name AS name, (c_custkey % 100) / 100.0E0 AS u FROM customer)
  SELECT k, CAST(3 + floor(pow(u, 2.0) * 8) AS BIGINT) AS tail, {_SPUN.format('owner', 'CAST(k AS VARCHAR)')} % 50 AS owner,
    CASE WHEN CAST(concat('0x', substring(sha256(CAST(k AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 70 THEN 'development'
      WHEN CAST(concat('0x', substring(sha256(CAST(k AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 90 THEN 'standard_holdout'
      ELSE 'challenge_holdout' END AS split,
    CASE k % 5 WHEN 1 THEN concat(substring(name, 1, 2), substring(name, 4))
      WHEN 2 THEN concat(substring(name, 1, 3), substring(name, 3, 1), substring(name, 4))
      WHEN 3 THEN concat(substring(name, 1, 2), substring(name, 4, 1), substring(name, 3, 1), substring(name, 5)) WHEN 4 THEN upper(name)
      ELSE name END AS slipped FROM c""")
def generator_draws(spark, d):
    """Heavy tails, owners of facts, splits by person, slips of the keyboard."""
    k = F.col("c_custkey")
    c = spark.read.parquet(f"{d}/customer.parquet")
    return c.select(k.alias("k"), generate.heavy_tail((k % 100) / 100, 3, 10, 2.0).alias("tail"), generate.owner_key(k, 50).alias("owner"), generate.split_of(k).alias("split"), generate.slip(F.col("c_name"), k % 5, F.lit(3)).alias("slipped"))


@query(f"""WITH o AS (SELECT c_custkey, name, -ln(({_SPUN.format('s', "CAST(c_custkey AS VARCHAR), '|', name")} + 0.5E0) / 10000000.0E0) / weight AS draw
      FROM customer, (VALUES ('web', 5.0E0), ('app', 3.0E0), ('pos', 2.0E0), ('mail', 1.0E0), ('fax', 0.1E0)) w(name, weight)),
  r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY draw, name) AS n
    FROM o) SELECT c_custkey, string_agg(name, ',' ORDER BY n) AS picked FROM r WHERE n <= 3 GROUP BY 1""")
def weighted_sample(spark, d):
    options = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in (("web", 5), ("app", 3), ("pos", 2), ("mail", 1), ("fax", 0.1))])
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.array_join(generate.sample_without_replacement(options, "s", F.col("c_custkey"), 3), ",").alias("picked"))


# --- records, truth, facts, gates --------------------------------------------------------------------------
NICK = (("Customer", "Cust"),)
_K = "c_custkey"


def _slip(c: str, purpose: str) -> str:
    at = f"CAST(1 + {_r(f'{purpose}_at', _K)} % greatest(length({c}) - 1, 1) AS INT)"
    return (f"CASE WHEN {_r(purpose, _K, 10000)} < {population.NOISE[purpose]} THEN CASE 1 + {_r(f'{purpose}_kind', _K, 3)} WHEN 1 THEN concat(substring({c}, 1, {at} - 1), substring({c}, {at} + 1)) "
            f"WHEN 2 THEN concat(substring({c}, 1, {at}), substring({c}, {at}, 1), substring({c}, {at} + 1)) ELSE concat(substring({c}, 1, {at} - 1), substring({c}, {at} + 1, 1), substring({c}, {at}, 1), substring({c}, {at} + 2)) END ELSE {c} END")


def _hit(kind: str) -> str:
    return f"{_r(kind, _K, 10000)} < {population.NOISE[kind]}"


@query(f"""WITH a AS (SELECT c_custkey, CASE WHEN {_r('nickname', _K, 100)} < 10 THEN 'Cust' ELSE 'Customer' END AS g, concat('Family', CAST(c_nationkey AS VARCHAR)) AS f, c_mktsegment AS s, concat('u', CAST(c_custkey AS VARCHAR), '@mail.example') AS e,
    lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS p FROM customer),
  b AS (SELECT *, {_slip('g', 'given_slip')} AS g1, {_slip('f', 'family_slip')} AS f1, {_slip('s', 'street_slip')} AS street FROM a),
  c AS (SELECT *, CASE WHEN {_hit('upper')} THEN upper(g1) ELSE g1 END AS g2, CASE WHEN {_hit('upper')} THEN upper(f1) ELSE f1 END AS f2 FROM b)
  SELECT c_custkey, CASE WHEN {_hit('swapped')} THEN f2 ELSE g2 END AS given_name, CASE WHEN {_hit('swapped')} THEN g2 ELSE f2 END AS family_name, street, CASE WHEN {_hit('domain_slip')} THEN replace(e, '@mail', '@ail') ELSE e END AS email,
    CASE WHEN {_hit('postcode_off')} THEN lpad(CAST((CAST(p AS INT) + 1) % 10000 AS VARCHAR), 4, '0') ELSE p END AS postcode,
    array_to_string(list_filter([{', '.join(f"CASE WHEN {_hit(k)} THEN '{k}' END" for k in population.NOISE)}], lambda k: k IS NOT NULL), ',') AS noise FROM c""")
def captured_records(spark, d):
    k = F.col("c_custkey")
    c = spark.read.parquet(f"{d}/customer.parquet").select(
        "c_custkey", F.lit("Customer").alias("given_name"), F.concat(F.lit("Family"), F.col("c_nationkey").cast("string")).alias("family_name"), F.col("c_mktsegment").alias("street"),
        F.concat(F.lit("u"), k.cast("string"), F.lit("@mail.example")).alias("email"), F.lpad((k % 10000).cast("string"), 4, "0").alias("postcode"))
    noisy = population.capture_noise(c, "c_custkey", chance(), spark.createDataFrame(NICK, "given_name string, nickname string"))
    return noisy.withColumn("noise", F.array_join("noise", ","))


def made_records(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    return spark.read.parquet(f"{d}/customer.parquet").select(
        F.concat(F.lit("r"), k.cast("string")).alias("record_key"), F.concat(F.lit("s"), (k % 3).cast("string")).alias("source_system"), F.when(k % 10 != 0, F.floor(k / 2)).alias("person"),
        F.filter(F.array(F.when(k % 4 == 0, "case"), F.when(k % 6 == 0, "typo")), lambda t: t.isNotNull()).alias("corruption_tags"))


_PART = "CAST('0x' || substring(sha256(CAST(person AS VARCHAR)), 1, 8) AS BIGINT) % 100"


@query(f"""WITH r AS (SELECT concat('r', CAST(c_custkey AS VARCHAR)) AS id, concat('s', CAST(c_custkey % 3 AS VARCHAR)) AS system, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey // 2 END AS person FROM customer)
  SELECT id AS identity_record_id, CAST(person AS VARCHAR) AS truth_person_id, system AS source_system, CASE WHEN {_PART} < 70 THEN 'development' WHEN {_PART} < 90 THEN 'standard_holdout' ELSE 'challenge_holdout' END AS evaluation_split, person IS NOT NULL AS include_in_benchmark FROM r""")
def record_truth(spark, d):
    return population.truth_tables(made_records(spark, d), "person")[0]


@query("""SELECT concat('r', CAST(c_custkey AS VARCHAR)) AS identity_record_id, cohort_name, cohort_value FROM customer, (VALUES ('source_system', 's0', 3, 0), ('source_system', 's1', 3, 1), ('source_system', 's2', 3, 2), ('corruption', 'case', 4, 0), ('corruption', 'typo', 6, 0)) v(cohort_name, cohort_value, m, n)
  WHERE c_custkey % m = n UNION ALL SELECT concat('r', CAST(c_custkey AS VARCHAR)), 'corruption', 'none' FROM customer WHERE c_custkey % 4 <> 0 AND c_custkey % 6 <> 0""")
def record_cohorts(spark, d):
    return population.truth_tables(made_records(spark, d), "person")[1]


def _facts(table: str) -> str:
    key, rows = population.FACTS[table]
    return f"""SELECT '{table}' AS name, source_record_id, count(*) AS facts, sum(CAST((500 + {_r(f'{table}_value', 'i', 45000)}) AS BIGINT)) AS cents, max(1546300800 + {_r(f'{table}_at', 'i')} * 20) AS last
      FROM range({rows // 100}) x(i) JOIN (SELECT c_custkey - 1 AS place, concat('R', CAST(c_custkey AS VARCHAR)) AS source_record_id FROM customer) o ON place = {_r(f'{table}_owner', 'i', '(SELECT count(*) FROM customer)')} GROUP BY 1, 2"""


@query(" UNION ALL ".join(map(_facts, population.FACTS)))
def activity_facts(spark, d):
    """The six activity tables at a hundredth of their size, summed up by owner."""
    k = F.col("c_custkey")
    owners = spark.read.parquet(f"{d}/customer.parquet").select((k - 1).alias("place"), F.concat(F.lit("R"), k.cast("string")).alias("source_record_id"))
    out = None
    for table in population.FACTS:
        facts = population.activity(spark, table, owners, chance(), 0.01)
        told = facts.groupBy(F.lit(table).alias("name"), "source_record_id").agg(F.count(F.lit(1)).alias("facts"), (F.sum("value_aud") * 100).cast("long").alias("cents"), F.max(F.unix_timestamp("at")).alias("last"))
        out = told if out is None else out.union(told)
    return out


_RATE = "avg(CASE WHEN {} THEN 1.0E0 ELSE 0.0E0 END)"
_GATES = {
    "rows": ("count(*)", 1, 1e15), "repeated_ids": ("count(*) - count(DISTINCT (source_system, source_record_id))", 0, 0), "missing_ids": ("count(*) FILTER (WHERE source_system IS NULL OR source_record_id IS NULL)", 0, 0), "unknown_systems": ("count(*) FILTER (WHERE source_system NOT IN ('sevenrooms', 'me_and_u', 'moshtix', 'momentus', 'pos', 'payments'))", 0, 0),
    "systems": ("count(DISTINCT source_system)", 6, 6), "emails_without_at": ("count(*) FILTER (WHERE personal_email NOT LIKE '%@%')", 0, 0), "phones_with_letters": ("count(*) FILTER (WHERE regexp_matches(personal_phone, '[A-Za-z]'))", 0, 0),
    "born_too_early": ("count(*) FILTER (WHERE date_of_birth < DATE '1900-01-01')", 0, 0), "born_too_late": ("count(*) FILTER (WHERE date_of_birth > DATE '2025-12-31')", 0, 0), "address_without_postcode": (_RATE.format("home_address_line1 IS NOT NULL AND home_postcode IS NULL"), 0, 0.2),
    "with_email": (_RATE.format("personal_email IS NOT NULL"), 0.5, 1), "with_phone": (_RATE.format("personal_phone IS NOT NULL"), 0.5, 1), "with_birth_date": (_RATE.format("date_of_birth IS NOT NULL"), 0.5, 1),
    "full_name_whole": (_RATE.format("full_name = concat_ws(' ', given_name, family_name)"), 0.99, 1)}


@query(f"WITH {BASE} " + " UNION ALL ".join(f"SELECT '{g}' AS gate, round(CAST({v} AS DOUBLE), 6) AS value, {float(lo)!r}::DOUBLE AS lo, {float(hi)!r}::DOUBLE AS hi, ({v}) BETWEEN {lo} AND {hi:.0f} AS passed FROM contacts" if hi > 1 else
                                            f"SELECT '{g}', round(CAST({v} AS DOUBLE), 6), {float(lo)!r}::DOUBLE, {float(hi)!r}::DOUBLE, ({v}) BETWEEN {lo} AND {hi} FROM contacts" for g, (v, lo, hi) in _GATES.items()))
def contract_gates(spark, d):
    return population.contract_gates(guests(spark, d), SYSTEMS)
