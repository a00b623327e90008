"""URL filters: given rules first, then association rules mined from labels.

Only DataFrame and SQL functions (and Spark's FP-growth, which runs in the JVM).

* A URL's host stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end,
  with A-Z lower-cased; its path follows up to ``?``, ``#`` or the end.
* A given rule is ``host/path``; it fits its host and all subdomains if the path
  starts with the rule's. The longest fitting rule decides (of equal length the
  last in alphabetical order).
* For the other URLs, FP-growth mines combinations of URL tokens (scheme, host
  parts, path segments with digits folded, query keys) from labelled pages.
  Rules that conclude "block" are pruned by support, confidence and lift.
  Each rule is posted under its rarest token, and distinct token sets look rules up
  by their tokens: an inverted index, so no URL meets rules it has no token of.

Defined results: a null URL, or one without ``://``, has an empty host and path
and no tokens, so it is allowed; repeated pages are judged row by row; labels
without id or without any value are no labels, and a page is bad if any of its
label rows is; without labels no rule is mined; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stage

ALLOW, BLOCK = "allow", "block"
#: The given rules, as (verdict, host/path).
RULES = ((ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"), (ALLOW, "com/fr/"), (BLOCK, "com/de/"))
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE, MIN_LIFT = 0.001, 20, 0.4, 1.3
_BAD = "label:bad"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"\A[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"\A[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits: a struct of length, rule and verdict, or null."""
    fits = []
    for verdict, rule in rules:
        rule_host, _, rule_path = rule.partition("/")
        fit = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(f"/{rule_path}"))
        fits.append(F.when(fit, F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits))


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL; none where it has no ``://``."""
    fold = lambda x: F.regexp_replace(x, r"[0-9]+", "9")
    parts = F.split(F.regexp_replace(host, r":[0-9]*\z", ""), r"\.")
    whole = F.concat(F.lit("host:"), F.array_join(F.slice(parts, F.greatest(F.size(parts) - 2, F.lit(1)), F.lit(3)), "."))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    tokens = F.concat(
        F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))), whole),
        F.transform(parts, lambda x: F.concat(F.lit("part:"), x)),
        F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("path:"), F.lower(fold(x)))),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query:"), F.lower(F.substring_index(x, "=", 1)))),
        F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    empty = F.array(F.lit("part:"), F.lit("path:"), F.lit("query:"), F.lit("host:"))
    return F.when(F.instr(url, "://") > 0, F.array_sort(F.array_except(tokens, empty))).otherwise(F.array().cast("array<string>"))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """Rules (antecedent, confidence, lift, support) that conclude "bad" from
    ``labelled`` (tokens, bad). Support counts labelled pages: a rule needs
    ``min_support`` of them and ``min_count`` at least."""
    spark = labelled.sparkSession
    n = labelled.count()
    if n < min_count:
        return spark.createDataFrame([], "antecedent array<string>, confidence double, lift double, support double")
    support = min(1.0, max(min_support, min_count / n))
    items = labelled.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(_BAD))).otherwise(F.col("tokens")).alias("items"))
    # FPGrowth rounds the count up; a hair less keeps counts that equal the bound.
    model = FPGrowth(itemsCol="items", minSupport=math.nextafter(support, 0), minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where((F.col("consequent") == F.array(F.lit(_BAD))) & (F.col("lift") >= min_lift))
    return rules.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "lift", "support")


def matching(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Of distinct ``token_sets`` (tokens) those that some rule's antecedent is a
    subset of, with the best confidence."""
    exploded = token_sets.select("tokens", F.explode("tokens").alias("token"))
    numbered = rules.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
    often = exploded.join(numbered.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n"))
    # The rarest token is the one to look a rule up by; a rule with a token that no set has fits none.
    posted = numbered.join(often, "token").groupBy("antecedent", "confidence").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    met = exploded.join(posted, "token").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    return met.groupBy("tokens").agg(F.max("confidence").alias("confidence"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, id_column: str = "page_id", url_column: str = "url", **mining) -> DataFrame:
    """One row per page: its id, host, path, rule (or null) and verdict; confidence
    is that of the mined rule that blocks it, else null.

    ``labels`` has the pages' ids as doc_id, quality (0: bad) and toxic (1: bad).
    """
    url = F.col("url")
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"))
    rows = rows.select("id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.select("id", "host", "path", given_rule(F.col("host"), F.col("path"), rules).alias("given"), url_tokens(url, F.col("host"), F.col("path")).alias("tokens"))
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy(F.col("doc_id").alias("id")).agg(F.max(bad).alias("bad"))
    mined = stage(mine_rules(rows.where("size(tokens) > 0").select("id", "tokens").join(known, "id").select("tokens", "bad"), **mining), "url-rules")
    sets = rows.where("given is null and size(tokens) > 0").select("tokens").distinct()
    blocked = matching(sets, mined)
    out = rows.join(blocked, "tokens", "left")
    method = F.when(F.col("confidence").isNotNull(), BLOCK).otherwise(ALLOW)
    return out.select(F.col("id").alias(id_column), "host", "path", F.col("given.rule").alias("rule"), F.coalesce("given.verdict", method).alias("verdict"),
                      F.when(F.col("given").isNull(), F.col("confidence")).alias("confidence"))
