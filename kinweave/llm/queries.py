"""The registered query of each operator, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinweave.llm.simhash import near_duplicates

    groups = near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinweave.llm.warc import archive_pages

    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinweave.llm.urlrules import filter_urls, mine

    pages = table(spark, sf_dir, "pages")
    judged = filter_urls(pages, mine(pages, table(spark, sf_dir, "labels")))
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinweave.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinweave.llm.langid import identify, train

    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    told = identify(docs, train(docs.where(~held_out)))
    return told.withColumnRenamed("id", "doc_id").select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 are the chosen and the rejected one of pair k."""
    from kinweave.llm.chatfmt import preference_turns

    turns = table(spark, sf_dir, "conversations")
    pairs = turns.select(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id")).where("pair_id IS NOT NULL").distinct()
    return preference_turns(turns, pairs.select("pair_id", (F.col("pair_id") * 2).alias("chosen"), (F.col("pair_id") * 2 + 1).alias("rejected")))


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinweave.llm.linededup import drop_repeated_lines

    kept = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinweave.llm.quality import COUNTS, judge, train

    docs = table(spark, sf_dir, "documents")
    judged = judge(docs, train(docs, table(spark, sf_dir, "labels")))
    return judged.select(F.col("id").alias("doc_id"), *COUNTS, "base_failed", "kept", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinweave.llm.decontam import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinweave.llm.secrets import KINDS, find_secrets

    found = find_secrets(table(spark, sf_dir, "documents"))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["rank"] < 3)
    counts = [F.size(F.filter("spans", lambda s, k=k: s["rank"] == k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS[:3])]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_warc": op2_warc,
    "op3_urlfilter": op3_urlfilter,
    "op4_mixing": op4_mixing,
    "op5_langid": op5_langid,
    "op6_preference": op6_preference,
    "op7_linededup": op7_linededup,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_secrets": op10_secrets,
}

SPACE_SQL = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _given(url_rules) -> tuple[str, str]:
    """CASE branches for the given rules, the longest first: (rule, verdict)."""
    fits = [(f"(host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')", h + p, v) for h, p, v in sorted(url_rules, key=lambda r: -len(r[0] + r[1]))]
    return tuple(" ".join(f"WHEN {c} THEN '{x[i]}'" for c, *x in fits) for i in (0, 1))


_RULE, _VERDICT = _given((("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")))
_AFTER = "CASE WHEN instr(u, '://') > 0 THEN substring(u, instr(u, '://') + 3) ELSE '' END"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = r"[^\x20\x09-\x0D]+"

#: What a learned model, a 64-bit hash or a spaced seed decides has no SQL and is held against brute force in the tests.
ORACLE_SQL: dict[str, str] = {
    # every token combination of every page is counted: a page has few tokens
    "op3_urlfilter": f"""
        WITH raw AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
        cut AS (SELECT page_id, u, translate(regexp_extract({_AFTER}, '^([^/?#]*)', 1), {_LOWER}) AS host, regexp_extract({_AFTER}, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(u, '\\?([^#]*)', 1) AS q FROM raw),
        marked AS (SELECT *, list_sort(list_distinct(list_concat(
            list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x), list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'p:' || x),
            list_transform(list_filter(string_split(q, '&'), lambda x: x <> ''), lambda x: 'q:' || split_part(x, '=', 1))))) AS t FROM cut),
        marks AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
        baskets AS (SELECT row_number() OVER () AS b, t, bad FROM marked JOIN marks ON doc_id = page_id),
        n AS (SELECT ceil(0.005 * count(*)) AS least FROM baskets),
        parts AS (SELECT bad, list_filter(t, lambda x, i: (m >> (i - 1)) & 1 = 1) AS items FROM (SELECT t, bad, unnest(range(1, (1 << len(t))::BIGINT)) AS m FROM baskets) x),
        counts AS (SELECT items, count(*) AS whole, sum(bad) AS hit FROM parts GROUP BY 1),
        rules AS (SELECT items FROM counts, n WHERE hit >= least AND hit / whole >= 0.8),
        urls AS (SELECT DISTINCT u, t FROM marked WHERE u <> ''),
        caught AS (SELECT DISTINCT u FROM (SELECT u, list_filter(t, lambda x, i: (m >> (i - 1)) & 1 = 1) AS items FROM (SELECT u, t, unnest(range(1, (1 << len(t))::BIGINT)) AS m FROM urls) x) y JOIN rules USING (items)),
        told AS (SELECT page_id, host, path, CASE {_RULE} END AS rule, CASE {_VERDICT} END AS given, caught.u IS NOT NULL AS met FROM marked LEFT JOIN caught ON caught.u = marked.u)
        SELECT page_id, host, path, rule, coalesce(given, CASE WHEN met THEN 'block' ELSE 'allow' END) AS verdict FROM told""",
    "op4_mixing": f"""
        WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0)::BIGINT AS size, CAST(concat('0x', substring(sha256(concat('7|', CAST(doc_id AS VARCHAR))), 1, 15)) AS BIGINT) AS h FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS words FROM d GROUP BY 1),
        w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src FROM s),
        b AS (SELECT *, CAST(1 + src % 3 AS DOUBLE) AS weight, 3.0E0 * words AS bound FROM w),
        t AS (SELECT sum(words)::DOUBLE AS total, sum(weight) AS whole FROM b),
        c AS (SELECT b.*, bound / weight < (total - coalesce(sum(bound) OVER earlier, 0)) / (whole - coalesce(sum(weight) OVER earlier, 0)) AS cut
          FROM b, t WINDOW earlier AS (ORDER BY bound / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        g AS (SELECT greatest(0, any_value(total) - coalesce(sum(bound) FILTER (WHERE cut), 0)) / nullif(any_value(whole) - coalesce(sum(weight) FILTER (WHERE cut), 0), 0) AS level FROM c, t),
        goals AS (SELECT source, words, CASE WHEN cut THEN bound ELSE least(bound, coalesce(level, 0) * weight) END AS target FROM c, g),
        placed AS (SELECT d.*, words, target, round_even(target, 0)::BIGINT AS owed,
            coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d JOIN goals ON goals.source IS NOT DISTINCT FROM d.source)
        SELECT doc_id, source, size, words AS source_size, target,
          (greatest(0, least(start + size, owed) - start) + greatest(0, least(start + words + size, owed) - start - words) + greatest(0, least(start + 2 * words + size, owed) - start - 2 * words))::BIGINT AS taken FROM placed""",
    "op2_warc": """
        WITH payloads AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        tops AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM payloads),
        judged AS (SELECT *, coalesce(payload_bytes >= 1000 AND page_id < top, false) AS again FROM tops)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to FROM judged""",
    "op6_preference": """
        WITH said AS (SELECT (conv_id // 2)::BIGINT AS pair_id, conv_id % 2 AS side, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
        odd AS (SELECT pair_id, turn FROM said GROUP BY pair_id, turn, role, text HAVING count(*) FILTER (WHERE side = 0) <> count(*) FILTER (WHERE side = 1)),
        ends AS (SELECT pair_id, min(turn) AS prefix_end FROM odd GROUP BY pair_id),
        placed AS (SELECT said.*, prefix_end, prefix_end IS NULL OR turn < prefix_end AS shared, '<|im_start|>' || role || chr(10) AS head FROM said LEFT JOIN ends USING (pair_id)),
        parts AS (SELECT *, CASE WHEN shared THEN 'prompt' WHEN side = 0 THEN 'chosen' ELSE 'rejected' END AS part, head || text || '<|im_end|>' || chr(10) AS rendered
          FROM placed WHERE NOT shared OR side = 0)
        SELECT pair_id, part, turn, role, rendered,
          CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(head) ELSE 0 END::BIGINT AS train_from,
          CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(rendered) ELSE 0 END::BIGINT AS train_to, prefix_end FROM parts""",
    "op7_linededup": f"""
        WITH cut AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        placed AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM cut),
        keyed AS (SELECT *, translate(trim(line, {SPACE_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM placed),
        common AS (SELECT line_key, max(doc_id) AS holder FROM keyed WHERE length(line_key) >= 20 GROUP BY line_key HAVING count(DISTINCT r) >= 3),
        judged AS (SELECT r, doc_id, line, place, coalesce(holder <> doc_id, false) AS gone FROM keyed LEFT JOIN common USING (line_key))
        SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM judged GROUP BY r, doc_id""",
}
