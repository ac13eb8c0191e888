"""URL filters: given host and path rules, and rules mined from labels. DataFrame operations only.

URLs that no given rule fits are judged by association rules: FP-growth mines combinations
of URL tokens that go with a "block" label, confidence and support prune them, and an
inverted index from each rule's rarest token finds the rules a URL may meet. A token of very
many URLs, a frequent URL and null URLs are dealt over tasks.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.operators.skew import spread_join
from kinweave.runtime import materialize

#: (host, path, verdict); a rule fits its host and all subdomains if the path starts with its path; the longest wins.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
BLOCK = "label=block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: str) -> tuple[Column, Column]:
    """Host and path of a URL column; both empty without ``://``."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    after = F.when(F.instr(u, "://") > 0, F.substring(u, F.instr(u, "://") + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def given_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest given rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens(url: str) -> Column:
    """Different host labels, path segments and query keys of a URL column."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host, path = parts(url)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    marked = lambda c, sign, mark: F.transform(F.filter(F.split(c, sign), lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("q:"), F.split(x, "=")[0]))
    return F.array_distinct(F.concat(marked(host, r"\.", "h:"), marked(path, "/", "p:"), keys))


def mine(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", label_id_col: str = "doc_id",
         min_support: float = 0.005, min_confidence: float = 0.8) -> DataFrame:
    """``(rule, antecedent, rarest, confidence, support)``: token combinations that go with a bad label.

    A page takes the label of the document of its number: block if that is toxic or of low
    quality. Pages without a label, or with null ids, teach nothing.
    """
    bad = F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0))
    marks = labels.where(F.col(label_id_col).isNotNull()).groupBy(F.col(label_id_col).cast("long").alias("__i")).agg(bad.alias("bad"))
    known = pages.select(F.col(id_col).cast("long").alias("__i"), tokens(url_col).alias("t")).join(marks, "__i")
    baskets = materialize(known.select(F.when(F.col("bad") == 1, F.concat("t", F.array(F.lit(BLOCK)))).otherwise(F.col("t")).alias("items")), "baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rules = model.associationRules.where(F.array_contains("consequent", BLOCK)).select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
    rules = materialize(rules.withColumn("rule", F.array_join("antecedent", " ")), "url-rules")
    seen = rules.select("rule", F.explode("antecedent").alias("token")).join(materialize(single, "url-tokens"), "token")
    rarest = seen.groupBy("rule").agg(F.min(F.struct("freq", "token")).alias("m")).select("rule", F.col("m.token").alias("rarest"))
    return rules.join(rarest, "rule")


def filter_urls(pages: DataFrame, mined: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """``(id, host, path, rule, verdict, mined)`` for every row.

    ``rule`` is the longest given rule that fits, which decides; else a mined rule that the
    URL's tokens hold blocks it (``mined``: the surest, by confidence, then name), and
    otherwise it is allowed. A null URL, or one without ``://``, has neither host nor path and is
    allowed. Repeated rows agree; a null id stays null. Other columns are not read. No rows, or no
    mined rules, are fine.
    """
    host, path = parts(url_col)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("u"), host.alias("host"), path.alias("path"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("given", verdict)
    open_urls = materialize(rows.where("rule IS NULL AND u IS NOT NULL").select("u").distinct().withColumn("t", tokens("u")), "open-urls")
    index = materialize(mined.select(F.col("rarest").alias("token"), F.col("rule").alias("r"), "antecedent", "confidence"), "rule-index")
    posted = open_urls.withColumn("token", F.explode("t"))
    met = spread_join(posted, index, ["token"], ["u"]).where(F.size(F.array_except("antecedent", "t")) == 0)
    best = met.groupBy("u").agg(F.min(F.struct(-F.col("confidence"), F.col("r").alias("r"))).alias("b")).select("u", F.col("b.r").alias("mined"))
    told = spread_join(rows, best, ["u"], ["id"], "left").withColumn("mined", F.when(F.col("rule").isNull(), F.col("mined")))
    final = F.coalesce("given", F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return told.select("id", "host", "path", "rule", final.alias("verdict"), "mined")
