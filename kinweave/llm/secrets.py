"""Secret scans over whole texts. DataFrame and SQL functions only.

Three base patterns find assigned passwords, access keys and hex strings. Beside them, every
long run of token characters is a candidate: a window slides over it, and the Shannon
entropy of the window is kept up from the counts of its characters, which change by the one that leaves and the one
that enters. A candidate whose entropy reaches the bound of its character class is a find,
unless the allow-list knows it; a piece that the list knows does not clear the rest. Of a candidate that overlaps base
finds, what they leave is judged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = (
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: A longer greedy run is the same match as the plain pattern's that is then dropped if short.
ACCESS, HEX = "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}"
WINDOW = 20
CANDIDATE = "[A-Za-z0-9+/_=-]{%d,}" % WINDOW
#: Bits a window of each character class must reach; ``letters`` and ``digits`` are runs without the other. Signs alone are no class.
BOUNDS = {"hex": 3.0, "alnum": 3.4, "mixed": 3.7, "letters": 3.7, "digits": 2.9}
#: A word, or several written as one with capitals: single letters only stand alone, and a word has fewer than ``WINDOW``.
#: Groups repeat possessively: a run of letters parts in one way only, and a greedy group would take the stack for each repeat.
WORDS = r"(?:[A-Za-z](?![A-Za-z])|(?:[A-Z]?[a-z]{2,19}(?![a-z])|[A-Z]{2,19}(?![A-Z]))++)"
#: Whole candidates that are let go: identifiers, slugs and paths of words, rulers.
ALLOWED = (
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    f"^[=_+/-]?{WORDS}([-_/]{WORDS})*+([-_/][0-9]{{1,4}})*+[=/]?$",
)
#: Pieces that are let go, wherever they are: placeholders, alphabets, a sign again and again. What they leave is judged.
PIECES = (
    "(?i)example|placeholder|dummy|changeme|your[-_]?(?:key|token)",
    "0123456789|abcdefghijkl|ABCDEFGHIJKL",
    r"([^\n])\1{7,}|^([=_+/-])\2{2,}",
)
KINDS = ("assign", "access", "hex", "entropy")
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,hit:string>>"


#: Finds of a text that are numbered at once; bounds what a text of very many finds takes.
GROUP = 256


def quoted(pattern: str) -> str:
    """A SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def find(text: str, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Leftmost matches that do not overlap, in code points; with ``least``, those whose ``group`` is that long.

    Places are running sums of the lengths of what lies between matches and of these. They are taken within groups of
    ``GROUP`` finds and over the groups, so that a list of many finds is never copied find by find.
    """
    p, rank = quoted(pattern), KINDS.index(kind)
    return F.expr(f"""
      CASE WHEN {text} RLIKE {p} THEN transform(array(
        arrays_zip(
          transform(split({text}, {p}, -1), x -> length(x)),
          regexp_extract_all({text}, {p}, 0),
          transform(regexp_extract_all({text}, {p}, {group}), x -> length(x)))), all -> transform(array(
        transform(sequence(0, (size(all) - 1) div {GROUP}), g -> aggregate(
          slice(all, CAST(g * {GROUP} + 1 AS INT), {GROUP}),
          named_struct('at', 0, 'found', CAST(array() AS {SPAN})),
          (acc, x) -> named_struct(
            'at', acc.at + x['0'] + coalesce(length(x['1']), 0),
            'found', CASE WHEN x['2'] >= {least} THEN concat(acc.found, array(named_struct(
              'start', acc.at + x['0'], 'rank', {rank}, 'kind', '{kind}', 'end', acc.at + x['0'] + length(x['1']), 'hit', x['1']))) ELSE acc.found END)))), groups ->
        transform(array(aggregate(groups, array(0), (acc, g) -> concat(acc, array(acc[size(acc) - 1] + g.at)))), bases ->
          flatten(transform(groups, (g, i) -> transform(g.found, s -> named_struct(
            'start', s.start + bases[i], 'rank', s.rank, 'kind', s.kind, 'end', s.end + bases[i], 'hit', s.hit)))))[0])[0])[0]
      ELSE CAST(array() AS {SPAN}) END""")


def top_entropy(run: str, window: int = WINDOW) -> str:
    """SQL: the highest Shannon entropy, in bits, of ``window`` characters of the string ``run``, which is at least as long.

    The run's different characters are numbered, and a count is kept of each. A step takes one from the character that leaves
    the window and gives one to that which enters; of the sum of n log n over the counts only these two terms change.
    """
    f = "array(" + ",".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(window + 1)) + ")"
    return f"""aggregate(array(split({run}, '')), CAST(0 AS DOUBLE), (top, s) ->
      aggregate(array(array_distinct(s)), CAST(0 AS DOUBLE), (t0, known) ->
      aggregate(array(transform(s, c -> CAST(array_position(known, c) - 1 AS INT))), CAST(0 AS DOUBLE), (t1, code) ->
      aggregate(array(transform(known, (c, j) -> size(filter(slice(code, 1, {window}), x -> x = j)))), CAST(0 AS DOUBLE), (t2, first) ->
      aggregate(
        sequence({window}, size(s)),
        named_struct('n', first,
          'sum', aggregate(first, CAST(0 AS DOUBLE), (a, n) -> a + {f}[n]),
          'low', CAST(1e9 AS DOUBLE)),
        (acc, i) -> CASE
          WHEN i = {window} THEN named_struct('n', acc.n, 'sum', acc.sum, 'low', acc.sum)
          WHEN code[i - {window} - 1] = code[i - 1] THEN acc
          ELSE aggregate(
            array(acc.sum + {f}[acc.n[code[i - {window} - 1]] - 1] - {f}[acc.n[code[i - {window} - 1]]] + {f}[acc.n[code[i - 1]] + 1] - {f}[acc.n[code[i - 1]]]),
            acc, (a, sum) -> named_struct(
              'n', transform(a.n, (n, j) -> n + CASE j WHEN code[i - 1] THEN 1 WHEN code[i - {window} - 1] THEN -1 ELSE 0 END),
              'sum', sum, 'low', least(a.low, sum))) END,
        acc -> {math.log2(window)!r}D - acc.low / {window})))))"""


def bound(run: str) -> str:
    """SQL: the bits that the string's character class asks for, null if it has none."""
    return (f"CASE WHEN NOT {run} RLIKE '[0-9A-Za-z]' THEN NULL WHEN NOT {run} RLIKE '[A-Za-z]' THEN {BOUNDS['digits']}D WHEN NOT {run} RLIKE '[0-9]' THEN {BOUNDS['letters']}D WHEN {run} RLIKE '^[0-9a-f]+$' OR {run} RLIKE '^[0-9A-F]+$' THEN {BOUNDS['hex']}D "
            f"WHEN {run} RLIKE '[a-z]' AND {run} RLIKE '[A-Z]' THEN {BOUNDS['mixed']}D ELSE {BOUNDS['alnum']}D END")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: tuple[str, ...] = ALLOWED,
                 pieces: tuple[str, ...] = PIECES) -> DataFrame:
    """``(id, spans)`` for every row: finds by start, then kind as listed in ``KINDS``; ``end`` is exclusive.

    A candidate is found if it, or one of the parts that the pieces let go leave of it, is at least ``WINDOW`` long,
    not allowed, and has a window of its class's entropy; the span is the whole candidate's. Positions are code points of the whole text. A null or empty text has no finds. Base finds
    of different kinds may overlap and all stay; an entropy find overlaps no base find. Repeated
    rows agree; a null id stays null. Other columns are not read. No rows give no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    base = rows.withColumn("base", F.concat(find("t", ASSIGN, "assign", 1, 12), find("t", ACCESS, "access"), find("t", HEX, "hex")))
    known = " OR ".join(f"p RLIKE {quoted(a)}" for a in allowed) or "false"
    left = "c.hit"
    for a in pieces:
        left = f"regexp_replace({left}, {quoted(a)}, '\n')"
    more = base.withColumn("more", find("t", CANDIDATE, "entropy")).drop("t")
    more = more.withColumn("more", F.expr(f"""flatten(transform(more, c -> CASE
        WHEN NOT exists(base, b -> b.start < c.end AND c.start < b.end) THEN array(c)
        ELSE filter(transform(
          aggregate(
            array_sort(filter(base, b -> b.start < c.end AND c.start < b.end)),
            named_struct('at', c.start, 'free', CAST(array() AS array<struct<start:int,end:int>>)),
            (acc, b) -> named_struct('at', greatest(acc.at, b.end), 'free', concat(acc.free, array(named_struct('start', acc.at, 'end', b.start)))),
            acc -> concat(acc.free, array(named_struct('start', acc.at, 'end', c.end)))),
          g -> named_struct('start', g.start, 'rank', c.rank, 'kind', c.kind, 'end', g.end, 'hit', substring(c.hit, g.start - c.start + 1, g.end - g.start))),
          g -> g.end - g.start >= {WINDOW}) END))"""))
    judged = f"length(p) >= {WINDOW} AND {bound('p')} IS NOT NULL AND NOT ({known})"
    more = more.withColumn("more", F.expr(f"""
        filter(more, c -> NOT ({known.replace("p RLIKE", "c.hit RLIKE")}) AND exists(split({left}, '\n'), p ->
          CASE WHEN {judged} THEN {top_entropy('p')} >= {bound('p')} ELSE false END))"""))
    return more.select("id", F.array_sort(F.concat("base", "more")).alias("spans"))
