"""Contact normalisation as column expressions (blank or unusable values become null)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Placeholder local parts, alias providers, street words.
PLACEHOLDERS = ("noreply", "noemail", "unknown", "guest", "test")
ALIAS_DOMAINS = ("gmail.com", "googlemail.com")
ALIAS_TO = "gmail.com"
STREET_WORDS = {"street": "st", "road": "rd", "avenue": "ave", "lane": "ln", "drive": "dr", "court": "ct", "apartment": "unit"}
# End of fixed values.
NON_ASCII = r"[^\x00-\x7F]"


@F.pandas_udf(T.StringType())
def _fold(values: pd.Series) -> pd.Series:
    """Compatibility form, case-folded, without combining marks, punctuation as blanks."""

    def fold(v):
        if v is None:
            return None
        plain = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", v).casefold())
        kept = (c if c.isalnum() or c == "_" or c.isspace() else " " for c in plain if unicodedata.combining(c) == 0)
        return " ".join("".join(kept).split()) or None

    return values.map(fold, na_action="ignore")


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def text(c: Column, unicode: bool = True) -> Column:
    """Comparable form of a name or line. Only values beyond ASCII visit Python, as an Arrow batch."""
    ascii_form = F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9_\s]", " "), r"\s+", " "))
    native = F.when(ascii_form != "", ascii_form)
    if not unicode:
        return native
    far = c.rlike(NON_ASCII)
    return F.when(far, _fold(F.when(far, c))).otherwise(native)


def email(c: Column) -> Column:
    """Lower-cased address; placeholder local parts give null; one spelling for alias providers."""
    v = F.lower(F.trim(c))
    at = F.locate("@", v)
    local, domain = F.substring_index(v, "@", 1), F.substr(v, at + 1, F.length(v))
    valid = v.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$") & ~local.rlike("^(" + "|".join(PLACEHOLDERS) + ")([+._-]|$)")
    plain = F.concat(F.replace(F.substring_index(local, "+", 1), F.lit("."), F.lit("")), F.lit("@" + ALIAS_TO))
    return F.when(valid, F.when(domain.isin(*ALIAS_DOMAINS), plain).otherwise(v))


def phone(c: Column, country_code: str = "61") -> Column:
    """International form: an approximation by digits. Numbers of fewer than 8 or more than 15 digits give null."""
    marked = F.regexp_replace(F.regexp_replace(F.trim(c), r"[^0-9+]", ""), r"(?<=.)\+", "")
    full = (F.when(marked.startswith("+"), F.substring(marked, 2, 40)).when(marked.startswith("00"), F.substring(marked, 3, 40))
            .when(marked.startswith("0"), F.concat(F.lit(country_code), F.substring(marked, 2, 40))).otherwise(F.concat(F.lit(country_code), marked)))
    return F.when((marked != "") & F.length(full).between(8, 15), F.concat(F.lit("+"), full))


def address(c: Column, unicode: bool = True) -> Column:
    """``text`` with street words shortened."""
    words = F.split(text(c, unicode), " ")
    short = F.create_map(*[F.lit(x) for pair in STREET_WORDS.items() for x in pair])
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(short, w), w)), " ")


def first_token(c: Column) -> Column:
    """First word of an already normalised value."""
    return F.substring_index(c, " ", 1)


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length (at least 1); null if either is."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))
