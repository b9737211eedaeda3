"""URL filters by association rules, in DataFrame operations only.

A list of (host, path) rules is applied first: a rule fits its host and all
subdomains where the path starts with the rule's, and the longest rule wins.
Other URLs are judged by association rules.  Their transactions are the tokens
of labelled URLs (domain suffixes, path segments, query keys) with the label as one
more item; a URL's label is what the list says, else what a labels table says of
its id.  Tokens that always stand together (the constant parts of a host's URLs) count
as one, under the first of their names: they would fit the same URLs in every combination.
FP-growth mines what is left; rules with a label as their consequent are pruned
by confidence and by support, which is a share of the labelled URLs and ``LEAST_ROWS``
of them at least.  Each rule is posted under its rarest token, and what
it is posted under is looked up by the distinct token sets of the URLs, so equal
sets are judged once.  Of all rules that fit, the one with the highest
confidence (then the longest, then the one of most support, then allow) decides;
without one the URL is allowed.

NULL and URLs without ``://`` have an empty host and path and no token, and are
allowed.  Without a labelled URL there is no rule.  Repeated rows are judged alike, and
ties of rules are settled by their tokens.  Only id and URL are read, so other columns
may have any name; an empty table has an empty result.  URLs are read whole.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import written

MIN_SUPPORT = 0.002
LEAST_ROWS = 5
MIN_CONFIDENCE = 0.8
LABEL = "label="
#: Hosts, paths and verdicts of the list.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """Up to the first ``/``, ``?`` or ``#``, A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host on up to the first ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def list_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of its text and verdict, else NULL."""
    fitting = None
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = (((host == rule_host) | host.endswith("." + rule_host))
                & path.startswith(rule_path))
        rule = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, rule) if fitting is None else fitting.when(fits, rule)
    return fitting


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct domain suffixes, path segments (digits as one) and query keys."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(
        F.lit("d="), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    segments = F.transform(F.split(path, "/"), lambda s: F.concat(
        F.lit("s="), F.regexp_replace(s, "[0-9]+", "0")))
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda k: F.concat(
        F.lit("q="), F.substring_index(k, "=", 1)))
    found = F.array_sort(F.array_distinct(F.concat(suffixes, segments, keys)))
    found = F.filter(found, lambda t: ~t.isin("d=", "s=", "q="))
    return F.coalesce(found, F.array().cast("array<string>"))


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host, path, tokens and the list's rule and verdict."""
    u = F.col(url)
    return (pages.withColumn("host", host_of(u)).withColumn("path", path_of(u))
            .withColumn("tokens", tokens_of(u, F.col("host"), F.col("path")))
            .withColumn("__listed", list_rule(F.col("host"), F.col("path")))
            .withColumn("rule", F.col("__listed.rule"))
            .withColumn("verdict", F.col("__listed.verdict")).drop("__listed"))


def leading_tokens(rows: DataFrame, least: int) -> DataFrame:
    """``leaders``: one array of the tokens of at least ``least`` of the ``row, tokens``.

    Of tokens that stand in exactly the same rows, only the first is in it.  It holds at
    most the mean number of a row's tokens divided by the least share of the rows.
    """
    row = F.xxhash64("row")
    tokens = rows.select("row", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(row).alias("h1"),
        F.bit_xor(F.xxhash64(row, F.lit(1))).alias("h2"))
    alike = tokens.where(F.col("n") >= least).groupBy("n", "h1", "h2").agg(F.min("token").alias("token"))
    return alike.agg(F.collect_set("token").alias("leaders"))


def mined_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT,
                min_confidence: float = MIN_CONFIDENCE, least_rows: int = LEAST_ROWS) -> DataFrame:
    """``posted, antecedent, verdict, confidence, support`` of rows ``tokens, verdict``."""
    rows = written(labelled.withColumn("row", F.monotonically_increasing_id()), "labelled-urls")
    total = rows.count()
    least = max(least_rows, math.ceil(min_support * total))
    if total < least:
        return labelled.sparkSession.createDataFrame([], (
            "posted string, antecedent array<string>, verdict string, "
            "confidence double, support double"))
    usual = F.array_intersect("tokens", leading_tokens(rows, least).scalar())
    items = written(rows.select(F.array_append(
        usual, F.concat(F.lit(LABEL), F.col("verdict"))).alias("items")), "transactions")
    # Half a row less, so that no rounding leaves out a set of exactly that many.
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / total,
                     minConfidence=min_confidence).fit(items)
    label = F.element_at("consequent", 1)
    rules = model.associationRules.where(label.startswith(LABEL)).where(
        ~F.exists("antecedent", lambda t: t.startswith(LABEL)))
    rules = rules.select("antecedent", F.substr(label, F.lit(len(LABEL) + 1)).alias("verdict"),
                         "confidence", "support")
    frequency = model.freqItemsets.where(F.size("items") == 1).select(
        F.element_at("items", 1).alias("token"), "freq")
    rarest = (rules.select("antecedent", F.explode("antecedent").alias("token")).distinct()
              .join(frequency, "token").groupBy("antecedent")
              .agg(F.min_by("token", F.struct("freq", "token")).alias("posted")))
    return written(rules.join(rarest, "antecedent").select(
        "posted", "antecedent", "verdict", "confidence", "support"), "url-rules")


def matched(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Verdict of every distinct token set that a rule fits."""
    found = (sets.select("tokens", F.explode("tokens").alias("posted")).join(rules, "posted")
             .where(F.size(F.array_except("antecedent", "tokens")) == 0))
    order = F.struct("confidence", F.size("antecedent"), "support", F.col("verdict") == "allow")
    return found.groupBy("tokens").agg(
        F.max_by("verdict", order).alias("mined"),
        F.max_by("antecedent", F.struct(order, "antecedent")).alias("antecedent"),
        F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url"
          ) -> DataFrame:
    """Verdict of every URL.  ``labels``: ``page_id, verdict``, one row for an id."""
    rows = parsed(pages.select(page_id, url), url)
    said = labels.select(page_id, F.col("verdict").alias("said"))
    labelled = rows.join(said, page_id, "left").select(
        "tokens", F.coalesce("verdict", "said").alias("verdict")).where("verdict is not null")
    rules = mined_rules(labelled)
    sets = rows.where("verdict is null").select("tokens").distinct()
    verdicts = written(matched(sets, rules), "url-verdicts")
    return rows.join(verdicts, "tokens", "left").select(
        page_id, "host", "path", "rule",
        F.coalesce("verdict", "mined", F.lit("allow")).alias("verdict"),
        F.when(F.col("verdict").isNull(), F.array_join("antecedent", " ")).alias("antecedent"),
        F.when(F.col("verdict").isNull(), F.col("confidence")).alias("confidence"))
