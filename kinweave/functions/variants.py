"""How two dates of birth or two names differ, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinweave.functions.text import first_token

#: Names that stand for each other; a name may be in several groups, which does not join these.
#: A default of common English short forms; pass your own to the functions that take ``nicknames``.
NICKNAMES: tuple[tuple[str, ...], ...] = (
    ("william", "will", "bill", "billy"), ("robert", "rob", "bob", "bobby"), ("richard", "rich", "rick", "dick"),
    ("james", "jim", "jimmy", "jamie"), ("john", "jack", "johnny"), ("margaret", "maggie", "meg", "peggy"),
    ("elizabeth", "liz", "beth", "betty", "eliza"), ("katherine", "kate", "katie", "kathy"), ("thomas", "tom", "tommy"),
    ("michael", "mike", "mick"), ("edward", "ed", "eddie", "ted"), ("charles", "charlie", "chuck"),
    ("alexander", "alex", "sandy"), ("alexandra", "alex", "sandra"), ("samuel", "sam", "sammy"), ("samantha", "sam", "sammy"),
)


def dob_variant(left: Column, right: Column) -> Column:
    """EXACT, DAY_MONTH_SWAP, YEAR_DIGIT, DAY_DIGIT or CONFLICT; null if either is."""
    ly, lm, ld = F.year(left), F.month(left), F.day(left)
    ry, rm, rd = F.year(right), F.month(right), F.day(right)

    def one_digit(a: Column, b: Column, width: int) -> Column:
        off = [(F.floor(a / 10**k) % 10 != F.floor(b / 10**k) % 10).cast("int") for k in range(width)]
        return sum(off[1:], off[0]) == 1

    return (
        F.when(left.isNull() | right.isNull(), F.lit(None).cast("string"))
        .when(left == right, "EXACT")
        .when((ly == ry) & (lm == rd) & (ld == rm), "DAY_MONTH_SWAP")
        .when((lm == rm) & (ld == rd) & one_digit(ly, ry, 4), "YEAR_DIGIT")
        .when((ly == ry) & (lm == rm) & one_digit(ld, rd, 2), "DAY_DIGIT")
        .otherwise("CONFLICT"))


def dob_compatible(left: Column, right: Column) -> Column:
    """Whether two dates can be one person's; null if either is."""
    return dob_variant(left, right).isin("EXACT", "DAY_MONTH_SWAP")


def osa(a: str, b: str) -> int:
    """Edits, with swapped neighbours as one, no part edited twice."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
    return last[-1]


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it reads it."""
    return F.transform(F.array(value), use)[0]


def _after_swap(a: Column, b: Column, use) -> Column:
    """``use`` of what follows in each if, past a common beginning, both go on with the same two characters in either order; else false."""
    least = F.least(F.length(a), F.length(b))
    same = F.aggregate(F.sequence(F.lit(1), F.greatest(least, F.lit(1))), F.lit(0), lambda n, i: F.when((n == i - 1) & (i <= least) & (F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1))), i).otherwise(n))
    at = lambda x, i: F.substr(x, i, F.lit(1))
    rest = lambda x, n: F.substr(x, n + 3, F.length(x))
    return _bound(same, lambda n: F.when((n + 2 <= least) & (at(a, n + 1) == at(b, n + 2)) & (at(a, n + 2) == at(b, n + 1)), use(rest(a, n), rest(b, n))).otherwise(F.lit(False)))


def swapped_within(a: Column, b: Column, limit: Column) -> Column:
    """Whether ``osa`` is at most ``limit``, 1 or 2, by at least one swap. Past their common beginning the first edit is the swap, or seen from the end the last one is."""
    equal = lambda x, y: x == y
    one_more = lambda x, y: (F.levenshtein(x, y) <= 1) | _after_swap(x, y, equal)
    return F.when(limit == 1, _after_swap(a, b, equal)).otherwise(_after_swap(a, b, one_more) | _after_swap(F.reverse(a), F.reverse(b), lambda x, y: F.levenshtein(x, y) <= 1))


def typo(a: Column, b: Column) -> Column:
    """One slip of the keyboard, two in names of 8 letters or more; names of under 3 letters have none.

    A swap costs two plain edits, so only pairs between the bound and twice it are looked at for swaps.
    """
    limit = F.when(F.greatest(F.length(a), F.length(b)) < 8, 1).otherwise(2)
    plain = F.levenshtein(a, b)
    unsure = (plain > limit) & (plain <= 2 * limit) & (F.least(F.length(a), F.length(b)) >= 3)
    swapped = F.when(unsure, swapped_within(a, b, limit))
    return (F.least(F.length(a), F.length(b)) >= 3) & ((plain <= limit) | F.coalesce(swapped, F.lit(False)))


def related(a: Column, b: Column, nicknames=NICKNAMES) -> Column:
    """Whether two names share a nickname group."""
    groups: dict[str, list[int]] = {}
    for i, group in enumerate(nicknames):
        for name in group:
            groups.setdefault(name, []).append(i)
    if not groups:
        return F.lit(False)
    of = F.create_map(*[x for name, g in groups.items() for x in (F.lit(name), F.array(*[F.lit(i) for i in g]))])
    return F.coalesce(F.arrays_overlap(F.try_element_at(of, a), F.try_element_at(of, b)), F.lit(False))


def given_variant(left: Column, right: Column, nicknames=NICKNAMES) -> Column:
    """EXACT, NICKNAME, INITIAL, PREFIX, TYPO or CONFLICT of normalised given names; null if either is."""
    a, b = first_token(left), first_token(right)
    # one opens with the other; how far, the shorter tells
    opens, letters = F.startswith(a, b) | F.startswith(b, a), F.least(F.length(a), F.length(b))
    told = [(a == b, "EXACT"), (related(a, b, nicknames), "NICKNAME"), (opens & (letters == 1), "INITIAL"), (opens & (letters >= 3), "PREFIX"), (typo(a, b), "TYPO")]
    answer = F.lit("CONFLICT")
    for holds, name in reversed(told):
        answer = F.when(holds, name).otherwise(answer)
    return F.when(a.isNotNull() & b.isNotNull(), answer)


def family_variant(left: Column, right: Column) -> Column:
    """EXACT (blanks aside), TOKEN (a shared word), TYPO or CONFLICT of normalised family names; null if either is."""
    joined_l, joined_r = F.replace(left, F.lit(" "), F.lit("")), F.replace(right, F.lit(" "), F.lit(""))
    return (
        F.when(left.isNull() | right.isNull(), F.lit(None).cast("string"))
        .when(joined_l == joined_r, "EXACT")
        .when(F.arrays_overlap(F.split(left, " "), F.split(right, " ")), "TOKEN")
        .when(typo(joined_l, joined_r), "TYPO").otherwise("CONFLICT"))
