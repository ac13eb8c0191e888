"""The match policy: an ordered table of rules, the first that holds decides. One CASE expression, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds, accepted variants.
AUTO, REVIEW = 0.90, 0.5
NAME_OK = ("EXACT", "NICKNAME", "PREFIX", "TYPO", "INITIAL")
FAMILY_OK = ("EXACT", "TOKEN", "TYPO")
DOB_OK = ("EXACT", "DAY_MONTH_SWAP")
# End of fixed values.


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def _is(c: str, *values: str) -> Column:
    return F.coalesce(F.col(c).isin(*values), F.lit(False))


# Rules of the policy's versions, their order, decisions and reasons; up to the end of ``earlier_rules``.
def rules(auto: float = AUTO, review: float = REVIEW, version: int = 4) -> list[tuple[Column, str, str]]:
    """(condition, decision, reason) in order of precedence, of versions 1 to 4."""
    if version not in (1, 2, 3, 4):
        raise ValueError(f"no policy version {version}")
    p = F.col("match_probability")
    given_bad, family_bad = _is("given_variant", "CONFLICT"), _is("family_variant", "CONFLICT")
    given_ok = F.col("given_variant").isNull() | _is("given_variant", *NAME_OK)
    family_ok = F.col("family_variant").isNull() | _is("family_variant", *FAMILY_OK)
    # the first version asked for a part of the name; later ones find that what is absent does not contradict
    said = F.lit(version > 1) | F.col("given_variant").isNotNull() | F.col("family_variant").isNotNull()
    dob_ok = _is("dob_variant", *DOB_OK)
    by_mail, by_phone = _flag("personal_email_exact"), _flag("personal_phone_exact")
    contact, name, home = by_mail | by_phone, _flag("name_exact"), _flag("address_agreement")
    mail_off, phone_off = _flag("personal_email_conflict"), _flag("personal_phone_conflict")
    near_home = F.coalesce(F.col("ann_address_rank") <= 5, F.lit(False))
    twin = _is("dob_variant", "EXACT") & _is("family_variant", "EXACT") & ~_is("given_variant", "EXACT") & F.col("given_variant").isNotNull()
    full_home = name & home & _flag("postcode_agreement")
    untouched = F.lit(version < 3) | (~mail_off & ~phone_off)
    yes, no, ask = "AUTO_MATCH", "REJECT", "REVIEW"
    table = [  # since which version
        (1, _is("dob_variant", "CONFLICT"), no, "VALID_DOB_CONFLICT"),
        (1, contact & given_bad & family_bad, no, "SHARED_CONTACT_DIFFERENT_PEOPLE"),
        (1, contact & dob_ok, yes, "PERSONAL_CONTACT_AND_DOB"),
        (1, by_mail & by_phone & ~given_bad & ~family_bad, yes, "BOTH_PERSONAL_CONTACTS"),
        (1, contact & given_ok & family_ok & said, yes, "PERSONAL_CONTACT_AND_NAME"),
        (2, contact & family_bad, no, "SHARED_CONTACT_DIFFERENT_FAMILY"),
        (4, contact & given_bad, no, "SHARED_CONTACT_DIFFERENT_GIVEN"),
        (1, contact, ask, "PERSONAL_CONTACT_NAME_CONFLICT"),
        (1, _flag("cross_script") & dob_ok & near_home, yes, "MULTILINGUAL_ADDRESS_AND_DOB"),
        (2, twin & given_bad, no, "SAME_BIRTH_FAMILY_GIVEN_CONFLICT"),
        (2, twin, no, "SAME_BIRTH_FAMILY_GIVEN_VARIANT"),
        (1, name & dob_ok & home, yes, "NAME_DOB_ADDRESS_CORROBORATION"),
        (2, name & dob_ok, yes, "NAME_AND_DOB"),
        (2, full_home & untouched, yes, "NAME_AND_FULL_ADDRESS"),
        (3, full_home & mail_off & phone_off, no, "NAME_ADDRESS_BOTH_CONTACTS_DIFFER"),
        (3, full_home, no if version > 3 else ask, "NAME_ADDRESS_CONTACT_CONFLICT"),
        (2, given_bad & home, no, "HOUSEHOLD_DIFFERENT_GIVEN"),
        (1, _flag("source_default_dob") & name & home & (p >= auto), yes, "SOURCE_DEFAULT_DOB_IGNORED"),
        (1, _flag("shared_context") & ~name, no, "SHARED_CONTEXT_NOT_IDENTITY"),
        (4, given_bad, no, "DIFFERENT_GIVEN_NAME"),
        (1, p >= review, ask, "INSUFFICIENT_EVIDENCE_REVIEW"),
        (1, F.lit(True), no, "LOW_MATCH_PROBABILITY"),
    ]
    return [row for since, *row in table if since <= version]


def earlier_rules(auto: float = 0.995, review: float = REVIEW) -> list[tuple[Column, str, str]]:
    """The frozen first policy, kept for comparison."""
    p = F.col("match_probability")
    contact, name, home = _flag("personal_contact"), _flag("name_exact"), _flag("address_agreement")
    agree, dob = _flag("name_agreement"), _flag("dob_agreement")
    near = F.coalesce(F.col("ann_address_rank") <= 5, F.lit(False))
    name_sim, home_sim = (F.coalesce(F.col(c), F.lit(0.0)) >= 0.7 for c in ("name_edit_similarity", "address_edit_similarity"))
    alone = name & home & ~contact & ~dob
    backed = contact & (agree | dob | (home & name_sim))
    yes, no, ask = "AUTO_MATCH", "REJECT", "REVIEW"
    return [
        (_flag("valid_dob_conflict"), no, "VALID_DOB_CONFLICT"),
        (alone & (_flag("personal_email_conflict") | _flag("personal_phone_conflict")), ask, "CONFLICTING_PERSONAL_CONTACTS_REVIEW"),
        (alone & (p < review), ask, "AMBIGUOUS_COMMON_NAME_ADDRESS"),
        (contact & dob, yes, "PERSONAL_CONTACT_AND_DOB"),
        (contact & home & (p >= auto), yes, "PERSONAL_CONTACT_AND_ADDRESS"),
        (name & dob & home, yes, "NAME_DOB_ADDRESS_CORROBORATION"),
        (_flag("source_default_dob") & name & home & (p >= auto), yes, "SOURCE_DEFAULT_DOB_IGNORED"),
        (_flag("cross_script") & dob & near, yes, "MULTILINGUAL_ADDRESS_AND_DOB"),
        ((p >= auto) & backed, yes, "INDEPENDENT_PERSONAL_EVIDENCE"),
        ((p >= max(auto, 0.97)) & name & home, yes, "NAME_ADDRESS_CORROBORATION"),
        (_flag("shared_context") & ~contact & ~(dob & agree), no, "SHARED_CONTEXT_NOT_IDENTITY"),
        (p >= review, ask, "INSUFFICIENT_EVIDENCE_REVIEW"),
        (near & name_sim & home_sim, ask, "SEMANTIC_CANDIDATE_REVIEW"),
        (F.lit(True), no, "LOW_MATCH_PROBABILITY"),
    ]


# End of fixed values.
def decide(table: list[tuple[Column, str, str]]) -> Column:
    """struct(decision, reason) of the first rule that holds."""
    out = None
    for condition, decision, reason in table:
        answer = F.struct(F.lit(decision).alias("decision"), F.lit(reason).alias("reason"))
        out = F.when(condition, answer) if out is None else out.when(condition, answer)
    return out


def safeguards() -> Column:
    """Names of the safeguards that a decided pair ran into, in fixed order."""
    found = [
        (_flag("valid_dob_conflict") & _is("dob_variant", "CONFLICT"), "VALID_DOB_CONFLICT"),
        (_is("dob_variant", "DAY_MONTH_SWAP", "YEAR_DIGIT", "DAY_DIGIT"), "DOB_ENTRY_VARIANT"),
        (_flag("source_default_dob"), "IGNORE_SOURCE_DEFAULT_DOB"),
        (_flag("shared_context"), "SHARED_CONTEXT_NOT_IDENTITY"),
        (_flag("cross_script") & F.coalesce(F.col("ann_address_rank") <= 5, F.lit(False)), "MULTILINGUAL_ANN_ADDRESS"),
        (_is("decision", "REVIEW"), "INSUFFICIENT_EVIDENCE_REVIEW"),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(n)) for c, n in found]), lambda x: x.isNotNull())
