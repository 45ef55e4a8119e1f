"""URL filtering by association rules, in DataFrame operations only.

Each URL becomes a set of tokens (host suffixes, path segments, query keys, scheme). Spark's FP-growth
mines the token combinations of labelled URLs together with the label of the bad ones; rules that end in
that label are pruned by support and confidence, and again where a rule with fewer tokens is at least as
confident. Rules match through an inverted index: one posting per (token, rule), and a rule holds where
all its tokens are found.

Listed rules (host and path prefixes) come first: the longest that fits decides, else the mined ones.

Defined results: a null URL, or one without ``://``, has an empty host and path and no tokens, so it is
allowed. Without labels, or where no rule passes the limits, everything unlisted is allowed. Several
labels of one id count as bad if any is. Repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.llm.tables import stored

ALLOW, BLOCK = "allow", "block"
BAD = "\tbad"  # no URL token holds a tab
MIN_SUPPORT = 0.002
MIN_ROWS = 25
MIN_CONFIDENCE = 0.6


@dataclass(frozen=True)
class Listed:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"(?s)\A([^/?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)\A[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: list[Listed]) -> tuple[Column, Column]:
    """Name and verdict of the longest listed rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL: ``h:`` every suffix of the host, ``p:`` path segments with digits as
    ``0``, ``q:`` query keys, ``s:`` scheme."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    segments = F.transform(
        F.filter(F.split(path, "/"), lambda s: s != ""),
        lambda s: F.concat(F.lit("p:"), F.regexp_replace(s, "[0-9]+", "0")))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(query, "&"), lambda s: s != ""),
        lambda s: F.concat(F.lit("q:"), F.regexp_extract(s, r"(?s)\A([^=]*)", 1)))
    scheme = F.array(F.concat(F.lit("s:"), F.lower(F.substring_index(url, "://", 1))))
    every = F.transform(F.concat(suffixes, segments, keys, scheme), lambda t: F.replace(t, F.lit("\t"), F.lit(" ")))
    return F.when(F.instr(url, "://") > 0, F.array_distinct(every)).otherwise(
        F.array().cast("array<string>"))


def mine(labelled: DataFrame, tokens: str, bad: str, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE, min_rows: int = MIN_ROWS) -> DataFrame:
    """(rule_id, antecedent, confidence) of the rules ``tokens -> bad`` that hold for at least
    ``min_rows`` URLs and ``min_support`` of all."""
    items = F.when(F.col(bad), F.array_append(tokens, F.lit(BAD))).otherwise(F.col(tokens))
    baskets = labelled.select(items.alias("items")).where(F.size("items") > 0)
    count = baskets.count()
    if count < min_rows:
        return labelled.sparkSession.createDataFrame([], "rule_id long, antecedent array<string>, confidence double")
    support = max(min_support, min_rows / count)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
    rules = stored(rules.select(F.array_sort("antecedent").alias("antecedent"), "confidence").withColumn(
        "rule_id", F.xxhash64("antecedent")), "rules")
    # A rule says nothing new where one with fewer tokens is as confident: its tokens, one left out at a
    # time, lead to the rules it extends.
    shorter = rules.select(
        "rule_id", F.col("confidence").alias("own"),
        F.explode(F.transform("antecedent", lambda t: F.xxhash64(F.array_remove("antecedent", t)))).alias("less"))
    base = rules.select(F.col("rule_id").alias("less"), "confidence")
    beaten = shorter.join(base, "less").where(F.col("confidence") >= F.col("own")).select("rule_id")
    return rules.join(beaten.distinct(), "rule_id", "left_anti")


def matched(urls: DataFrame, key: str, tokens: str, rules: DataFrame) -> DataFrame:
    """Distinct values of ``key`` (a hash of the token set) whose tokens hold all tokens of a rule."""
    postings = rules.select("rule_id", F.size("antecedent").alias("needs"), F.explode("antecedent").alias("token"))
    sets = urls.groupBy(key).agg(F.first(tokens).alias("tokens"))
    found = sets.select(key, F.explode("tokens").alias("token")).join(postings, "token")
    full = found.groupBy(key, "rule_id").agg(F.count(F.lit(1)).alias("has"), F.first("needs").alias("needs"))
    return full.where(F.col("has") == F.col("needs")).select(key).distinct()


def judge(pages: DataFrame, page_id: str, url: str, labels: DataFrame, label_id: str, bad: Column,
          listed: list[Listed], min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``. ``bad`` is a condition on ``labels``."""
    address = F.col("url")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    rows = rows.select("page_id", "url", host_of(address).alias("host"), path_of(address).alias("path"))
    rows = rows.withColumn("tokens", tokens_of(address, F.col("host"), F.col("path")))
    verdicts = labels.groupBy(F.col(label_id).alias("label_of")).agg(
        F.max(F.coalesce(bad, F.lit(False))).alias("bad"))
    labelled = rows.join(verdicts, F.col("page_id") == F.col("label_of")).select("tokens", "bad")
    rules = mine(labelled, "tokens", "bad", min_support, min_confidence)
    rows = rows.withColumn("set_key", F.sha2(F.to_json("tokens"), 256))
    hits = stored(matched(rows, "set_key", "tokens", rules), "url-hits").withColumn("hit", F.lit(True))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), listed)
    judged = rows.select("page_id", "host", "path", "set_key", rule.alias("rule"), verdict.alias("listed"))
    judged = judged.join(hits, "set_key", "left")
    mined = F.when(F.col("hit"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.select(F.col("page_id").alias(page_id), "host", "path", "rule",
                         F.coalesce("listed", mined).alias("verdict"))
