"""An unsupervised Fellegi-Sunter model: comparison levels, EM over level patterns, scores, pair features."""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions import text as norm
from kinweave.functions.variants import NICKNAMES, dob_variant, family_variant, given_variant
from kinweave.operators.profile import ROLE_MAILBOX  # noqa: F401  (part of the feature contract)
from kinweave.operators.skew import bounded, spread_join
from kinweave.operators.tables import Versions, fingerprint
from kinweave.runtime import materialize

# Comparisons as (column, similarity levels), whether term frequency adjusts the exact level, EM settings.
COMPARISONS = {"name_n": (0.9, 0.75), "personal_email_n": (), "personal_phone_n": (), "dob_usable": (), "home_address_n": (0.9, 0.75)}
TERM_FREQUENCY = ("name_n", "personal_email_n", "personal_phone_n", "home_address_n")
MAX_ITERATIONS, TOLERANCE, RECALL, PSEUDOCOUNT, U_PAIRS = 25, 0.001, 0.7, 0.5, 1_000_000
SESSIONS = (("personal_email_n",), ("personal_phone_n",), ("name_n", "dob_usable"))
# End of fixed values.


def gamma(column: str, left: Column, right: Column) -> Column:
    """-1 if either is null, else the agreement level: the highest for equal values, 0 for none."""
    cuts = COMPARISONS[column]
    out = F.when(left.isNull() | right.isNull(), -1).when(left == right, len(cuts) + 1)
    for i, cut in enumerate(cuts):
        out = out.when(norm.similarity(left, right) >= cut, len(cuts) - i)
    return out.otherwise(0)


def levels(column: str) -> int:
    return len(COMPARISONS[column]) + 2


def compare(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``pairs`` with a ``gamma_`` column for each comparison and the values ``_l`` and ``_r``, which are joined unless the pairs carry them."""
    out = pairs
    for side, key in (("l", "left_record_key"), ("r", "right_record_key")):
        if all(f"{c}_{side}" in pairs.columns for c in COMPARISONS):
            continue
        out = out.join(records.select(F.col("record_key").alias(key), *[F.col(c).alias(f"{c}_{side}") for c in COMPARISONS]), key)
    return out.withColumns({f"gamma_{c}": gamma(c, F.col(f"{c}_l"), F.col(f"{c}_r")) for c in COMPARISONS})


def with_counts(records: DataFrame) -> DataFrame:
    """``records``, a stage table, with ``n_<column>`` for the columns that term frequencies adjust: how many records have the value.

    Pairs that carry these are scored without a join. All records of a personal contact have it as their contact, so that the
    contact's own count is taken where the records have it.
    """
    out = records
    for c in TERM_FREQUENCY:
        if (told := c.removeprefix("personal_").removesuffix("_n") + "_record_count") in records.columns:
            out = out.withColumn(f"n_{c}", F.when(F.col(c).isNotNull(), F.col(told)))
            continue
        counts = materialize(records.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(f"n_{c}")), "counts")
        few = bounded(counts)
        out = out.join(few, c, "left") if few is not counts else spread_join(materialize(out, "counted"), counts, [c], ["record_key"], "left")
    return out


def patterns(compared: DataFrame) -> DataFrame:
    """Counts of the different level patterns: at most 5 * 3 * 3 * 3 * 5 rows, whatever the input."""
    return compared.groupBy(*[f"gamma_{c}" for c in COMPARISONS]).agg(F.count(F.lit(1)).alias("pairs"))


@dataclass
class Model:
    prior: float
    m: dict[str, list[float]] = field(default_factory=dict)  # by level, 0 first
    u: dict[str, list[float]] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"prior": self.prior, "m": self.m, "u": self.u}, sort_keys=True)

    @classmethod
    def from_json(cls, s: str) -> Model:
        return cls(**json.loads(s))


def em(rows: list[tuple[tuple[int, ...], int]], u: dict[str, list[float]], held_out: tuple[str, ...], prior: float = 0.1,
       iterations: int = MAX_ITERATIONS, tolerance: float = TOLERANCE) -> dict[str, list[float]]:
    """m of the comparisons that are not ``held_out``, by expectation-maximisation over (levels, pairs) rows with u fixed."""
    names = list(COMPARISONS)
    use = [i for i, c in enumerate(names) if c not in held_out]
    g = np.array([r[0] for r in rows]).reshape(-1, len(names))
    n = np.array([r[1] for r in rows], float)
    m = {i: np.array([0.1 / (levels(names[i]) - 1)] * (levels(names[i]) - 1) + [0.9]) for i in use}
    for _ in range(iterations):
        lm, lu = np.full(len(g), math.log(prior)), np.full(len(g), math.log(1 - prior))
        for i in use:
            there = g[:, i] >= 0
            lm[there] += np.log(np.maximum(m[i][g[there, i]], 1e-12))
            lu[there] += np.log(np.maximum(np.array(u[names[i]])[g[there, i]], 1e-12))
        match = n / (1 + np.exp(np.clip(lu - lm, -700, 700)))
        new = {i: np.array([match[g[:, i] == k].sum() for k in range(levels(names[i]))]) for i in use}
        new = {i: x / x.sum() if x.sum() else m[i] for i, x in new.items()}
        moved = max([abs(new[i] - m[i]).max() for i in use], default=0.0)
        m, prior = new, float(np.clip(match.sum() / max(n.sum(), 1), 1e-9, 1 - 1e-9))
        if moved < tolerance:
            break
    return {names[i]: x.tolist() for i, x in m.items()}


def smooth(p: list[float], mass: float, pseudocount: float = PSEUDOCOUNT) -> list[float]:
    """Level chances with a pseudocount on each, against an evidence mass of ``mass`` pairs."""
    if any(not 0 <= x <= 1 for x in p):
        raise ValueError(f"not chances: {p}")
    total = sum(x * mass + pseudocount for x in p)
    return [(x * mass + pseudocount) / total for x in p]


def exact_u(records: DataFrame) -> dict[str, float]:
    """Chance that two random records agree on each column, from value counts (columns present on both)."""
    out = {}
    for c in COMPARISONS:
        r = records.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).agg(
            F.sum(F.col("n").cast("double") * (F.col("n") - 1)).alias("same"), F.sum("n").alias("n")).first()
        out[c] = float(r.same or 0) / max(1.0, float(r.n or 0) * (float(r.n or 0) - 1))
    return out


def fuzzy_u(records: DataFrame, pairs: int = U_PAIRS) -> dict[str, list[float]]:
    """Level shares of about ``pairs`` random pairs, whatever the table's size: every record draws so many slots of about four
    records each by hash, and meets who is there. Of a small table pairs are drawn repeatedly; of a large one a share of what
    meets is kept. Hashes make the sample reproducible.
    """
    n = max(1, records.count())
    per = max(1, math.ceil(pairs / (4 * n)))
    slots = max(1, n // 4)
    base = records.select(*COMPARISONS, "record_key")
    a = base.select(*[F.col(c).alias(f"{c}_l") for c in COMPARISONS], F.col("record_key").alias("kl"), F.explode(F.sequence(F.lit(1), F.lit(per))).alias("t"))
    a = a.withColumn("slot", F.pmod(F.xxhash64(F.lit("u"), "kl", "t"), F.lit(slots)))
    b = base.select(*[F.col(c).alias(f"{c}_r") for c in COMPARISONS], F.col("record_key").alias("kr")).withColumn("slot", F.pmod(F.xxhash64(F.lit("v"), "kr"), F.lit(slots)))
    met = a.join(b, "slot").where("kl <> kr").where(F.pmod(F.xxhash64("kl", "kr", "t"), F.lit(1 << 20)) < min(1 << 20, int((1 << 20) * pairs / (n * per * 4.0)) + 1))
    # stage tables of few rows, here and in ``fit``, whose shuffles go with the write
    sums = materialize(met.agg(*[F.sum((gamma(c, F.col(f"{c}_l"), F.col(f"{c}_r")) == k).cast("long")).alias(f"{c}:{k}") for c in COMPARISONS for k in range(levels(c))]), "sums").first()
    out = {}
    for c in COMPARISONS:
        counts = [float(sums[f"{c}:{k}"] or 0) for k in range(levels(c))]
        out[c] = [x / max(1.0, sum(counts)) for x in counts]
    return out


def prior_pairs(records: DataFrame) -> int:
    """Pairs that agree on name, date and a personal contact, counted from group sizes without listing any pair."""
    def pairs(*by: str) -> Column:
        return records.where(" AND ".join(f"{c} IS NOT NULL" for c in by)).groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.expr("n * (n - 1) div 2")).alias("p")).first().p or 0

    core = ("name_n", "dob_usable")
    return int(pairs("personal_email_n", *core) + pairs("personal_phone_n", *core) - pairs("personal_email_n", "personal_phone_n", *core))


def session_patterns(records: DataFrame, block: tuple[str, ...]) -> DataFrame:
    """``patterns`` of all pairs of records that agree on the columns ``block``.

    Records alike in all comparisons are a class with a count; classes are compared, so that frequent values are in it
    at the cost of their different records.
    """
    alike = records.where(" AND ".join(f"{c} IS NOT NULL" for c in block)).groupBy(*COMPARISONS).agg(F.count(F.lit(1)).alias("n"), F.min("record_key").alias("k"))
    alike = materialize(alike, "alike")
    side = lambda s: alike.select(*block, *[F.col(c).alias(f"{c}_{s}") for c in COMPARISONS], F.col("n").alias(f"n_{s}"), F.col("k").alias(f"k_{s}"))
    met = side("l").join(side("r"), list(block)).where("k_l <= k_r").withColumn("pairs", F.when(F.col("k_l") == F.col("k_r"), F.expr("n_l * (n_l - 1) div 2")).otherwise(F.col("n_l") * F.col("n_r")))
    levelled = met.where("pairs > 0").select("pairs", *[gamma(c, F.col(f"{c}_l"), F.col(f"{c}_r")).alias(f"gamma_{c}") for c in COMPARISONS])
    return levelled.groupBy(*[f"gamma_{c}" for c in COMPARISONS]).agg(F.sum("pairs").alias("pairs"))


def fit(records: DataFrame) -> Model:
    """Prior by sure rules, u by random pairs and value counts, m by EM in three sessions over all pairs of a blocking rule, smoothed."""
    n = records.count()
    total = n * (n - 1) / 2
    prior = min(0.5, max(1e-12, prior_pairs(records) / RECALL / max(total, 1)))
    u, same = fuzzy_u(records), exact_u(records)
    for c, p in u.items():  # the exact level is known; the others share the rest as sampled
        rest = sum(p[:-1]) or 1.0
        u[c] = [x / rest * (1 - same[c]) for x in p[:-1]] + [same[c]]
    mass = max(1.0, prior * total)
    u = {c: smooth([min(1.0, max(0.0, x)) for x in p], U_PAIRS) for c, p in u.items()}
    found: dict[str, list[list[float]]] = {c: [] for c in COMPARISONS}
    for block in SESSIONS:
        rows = [(tuple(r)[:-1], r.pairs) for r in materialize(session_patterns(records, block), "patterns").collect()]  # few, see ``patterns``
        if rows:
            for c, p in em(rows, u, block).items():
                found[c].append(p)
    m = {c: smooth(np.mean(p, axis=0).tolist() if p else [0.1 / (levels(c) - 1)] * (levels(c) - 1) + [0.9], mass) for c, p in found.items()}
    return Model(prior, m, u)


def spec() -> str:
    """Hash of what a fitted model depends on besides the data."""
    told = {"comparisons": COMPARISONS, "term_frequency": TERM_FREQUENCY, "settings": [MAX_ITERATIONS, TOLERANCE, RECALL, PSEUDOCOUNT, U_PAIRS], "sessions": SESSIONS}
    return hashlib.sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()


def cached_model(store: Versions, records: DataFrame, train=fit) -> tuple[Model, bool]:
    """(model, whether it was fitted now): one that was fitted before is taken if neither specification nor data have changed."""
    used = records.select("record_key", *COMPARISONS)
    key = hashlib.sha256(f"{spec()}{fingerprint(used)}".encode()).hexdigest()
    name = f"model_{key}"
    if store.exists(name):
        return Model.from_json(store.read(name).first().model), False
    model = train(records)
    store.write(name, records.sparkSession.createDataFrame([(key, model.to_json())], "model_key string, model string"))
    return model, True


def gate_scores(scored: DataFrame, pairs: DataFrame) -> DataFrame:
    """``scored`` if it has a row for every pair and every probability lies in [0, 1]; anything else is an error."""
    n, bad, want = scored.count(), scored.where("match_probability IS NULL OR isnan(match_probability) OR match_probability < 0 OR match_probability > 1").count(), pairs.count()
    if n != want or bad:
        raise ValueError(f"{n} scores for {want} pairs, {bad} of them no probability")
    return scored


def score(compared: DataFrame, records: DataFrame, model: Model) -> DataFrame:
    """``compared`` with ``bf_`` and ``tf_`` factors, ``match_weight`` and ``match_probability``.

    Term frequencies of the values replace u at the exact level: a common value says less.
    """
    out = compared
    weight = F.lit(math.log2(model.prior / (1 - model.prior)))
    for c in COMPARISONS:
        bf = F.when(F.col(f"gamma_{c}") < 0, 1.0)
        for k in range(levels(c)):
            bf = bf.when(F.col(f"gamma_{c}") == k, model.m[c][k] / model.u[c][k])
        tf = F.lit(1.0)
        if c in TERM_FREQUENCY:
            values = records.where(F.col(c).isNotNull())
            if f"n_{c}_l" in compared.columns:
                out = out.withColumns({f"__n_{c}": F.col(f"n_{c}_l"), f"__all_{c}": F.lit(values.count())})
            else:
                share = values.groupBy(c).agg(F.count(F.lit(1)).alias("__n"))
                total = values.agg(F.count(F.lit(1)).alias("__all"))
                out = out.join(share.select(F.col(c).alias(f"{c}_l"), F.col("__n").alias(f"__n_{c}")), f"{c}_l", "left").join(F.broadcast(total.withColumnRenamed("__all", f"__all_{c}")))  # one row
            tf = F.when(F.col(f"gamma_{c}") == levels(c) - 1, F.lit(model.u[c][-1]) * F.col(f"__all_{c}") / F.col(f"__n_{c}")).otherwise(1.0)
        out = out.withColumns({f"bf_{c}": bf, f"tf_{c}": tf})
        weight = weight + F.log2(f"bf_{c}") + F.log2(f"tf_{c}")
    out = out.withColumn("match_weight", weight).withColumn("match_probability", F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(2.0), -F.col("match_weight"))))
    return out.drop(*[x for c in COMPARISONS for x in (f"__n_{c}", f"__all_{c}")])


FEATURE_FIELDS = ("source_system", "name_n", "given_name_n", "family_name_n", "email_n", "phone_n", "work_email_n", "work_phone_n", "personal_email_n", "personal_phone_n",
                  "email_is_shared", "phone_is_shared", "email_given_names", "phone_given_names", "dob_usable", "dob_is_source_default", "home_address_n", "postcode_n")


def pair_features(pairs: DataFrame, contacts: DataFrame, ann: DataFrame | None = None, nicknames=NICKNAMES) -> DataFrame:
    """Candidate pairs (with ``match_probability``) and the evidence the policy reads. Fields that the pairs carry as ``<field>_l`` and ``<field>_r`` are not joined."""
    out = pairs
    for side, key in (("l", "left_record_key"), ("r", "right_record_key")):
        if all(f"{c}_{side}" in pairs.columns for c in FEATURE_FIELDS):
            out = out.withColumnsRenamed({f"{c}_{side}": f"{side}_{c}" for c in FEATURE_FIELDS})
            continue
        out = out.join(contacts.select(F.col("record_key").alias(key), *[F.col(c).alias(f"{side}_{c}") for c in FEATURE_FIELDS]), key)
    if ann is None:
        out = out.withColumns({c: F.lit(None).cast(t) for c, t in (("ann_name_score", "double"), ("ann_name_rank", "int"), ("ann_address_score", "double"), ("ann_address_rank", "int"))})
    else:
        out = out.join(ann, ["left_record_key", "right_record_key"], "left")
    l, r = (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"r_{c}"))  # noqa: E741
    sure = lambda c: F.coalesce(c, F.lit(False))
    same = lambda c: sure(l(c) == r(c))
    differ = lambda c: sure(l(c) != r(c))
    tokens = lambda c: F.split(c, " ")
    far = lambda c: sure(c.rlike(norm.NON_ASCII))
    out = out.withColumns({
        "valid_dob_conflict": differ("dob_usable"), "dob_variant": dob_variant(l("dob_usable"), r("dob_usable")),
        "given_variant": given_variant(l("given_name_n"), r("given_name_n"), nicknames), "family_variant": family_variant(l("family_name_n"), r("family_name_n")),
        "source_default_dob": sure(l("dob_is_source_default")) | sure(r("dob_is_source_default")), "dob_agreement": same("dob_usable"),
        "email_exact": same("email_n"), "phone_exact": same("phone_n"), "personal_email_exact": same("personal_email_n"), "personal_phone_exact": same("personal_phone_n"),
        "shared_email_exact": same("email_n") & sure(l("email_is_shared")), "shared_phone_exact": same("phone_n") & sure(l("phone_is_shared")),
        "email_given_names": F.when(same("email_n"), l("email_given_names")), "phone_given_names": F.when(same("phone_n"), l("phone_given_names")),
        "personal_email_conflict": differ("personal_email_n"), "personal_phone_conflict": differ("personal_phone_n"),
        "name_exact": same("name_n"), "given_name_exact": same("given_name_n"), "family_name_exact": same("family_name_n"),
        "address_agreement": same("home_address_n"), "postcode_agreement": same("postcode_n"),
        "work_contact_exact": same("work_email_n") | same("work_phone_n"),
        "cross_script": far(l("name_n")) != far(r("name_n")),
        "name_edit_similarity": norm.similarity(l("name_n"), r("name_n")), "address_edit_similarity": norm.similarity(l("home_address_n"), r("home_address_n")),
        "name_token_overlap": F.size(F.array_intersect(tokens(l("name_n")), tokens(r("name_n")))) / F.least(F.size(F.array_distinct(tokens(l("name_n")))), F.size(F.array_distinct(tokens(r("name_n"))))),
    })
    out = out.withColumns({
        "personal_contact": F.col("personal_email_exact") | F.col("personal_phone_exact"),
        "name_agreement": F.col("name_exact") | sure(F.col("name_edit_similarity") >= 0.9),
        "given_name_conflict": sure(F.col("given_variant") == "CONFLICT"), "family_name_conflict": sure(F.col("family_variant") == "CONFLICT"),
        "shared_context": F.col("shared_email_exact") | F.col("shared_phone_exact") | F.col("work_contact_exact"),
    })
    return out.drop(*[f"{s}_{c}" for s in "lr" for c in FEATURE_FIELDS])
