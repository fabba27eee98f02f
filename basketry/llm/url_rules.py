"""URL filtering: explicit host and path rules, and association rules mined with Spark's FP-growth.

An explicit rule fits its host and all subdomains where the path starts with the
rule's; the longest wins.  The verdicts of explicit rules are the labels: each URL is
a set of tokens (host labels, path segments with numbers as ``#``, query keys), plus
its label if it has one.  FP-growth finds the frequent combinations, and rules
``tokens -> block`` of enough confidence judge the URLs that no explicit rule fits.  Confidence is
counted among the labelled URLs (block against allow) and a rule must also lie above the share of
blocked labels by more than chance, and holds only where all tokens are that its labelled URLs share; or, by parameter, it is counted over all URLs with these tokens, labelled or not.
The rules match by an inverted index on each rule's rarest token.

Defined cases: a null URL or one without ``://`` has empty host and path, no tokens
and is allowed; repeated rows and keys are judged each on their own; among equally long
explicit rules the first by name wins; without frequent combinations every other URL
is allowed; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Share of all URLs that a combination needs, and share of its URLs that must be blocked.
SUPPORT = 0.002
CONFIDENCE = 0.9
#: Among labelled URLs: how far above the share of blocked labels a rule must be, and by how much more than chance (log-likelihood).
LIFT = 1.2
MARGIN = 3.0
BLOCK_ITEM = "=block"
ALLOW_ITEM = "=allow"

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.lit("")), _CAPITALS, _CAPITALS.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def explicit(host: Column, path: Column, rules: list[UrlRule], field: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits; null if none does.  The rule list is a short parameter."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.lit(getattr(r, field))).otherwise(found)
    return found


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL."""
    tagged = lambda parts, tag: F.transform(F.array_remove(parts, ""), lambda x: F.concat(F.lit(tag), x))
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.array_distinct(F.concat(tagged(F.split(host, r"\."), "host:"), tagged(F.split(F.regexp_replace(path, r"[0-9]+", "#"), "/"), "path:"),
                                     tagged(keys, "key:")))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, among_labelled: bool = False) -> DataFrame:
    """(antecedent, confidence, support) of rules for blocking, from rows (tokens, label); only the shortest are kept.

    A rule whose tokens include those of another says nothing more, so it is pruned.
    ``among_labelled``: confidence is counted among the rows with a label, and lift and significance are asked for.
    """
    label = F.when(F.col("label") == "block", F.array(F.lit(BLOCK_ITEM))).when(F.col("label") == "allow", F.array(F.lit(ALLOW_ITEM))) \
        .otherwise(F.array().cast("array<string>"))
    known = labelled.where(F.size("tokens") > 0)
    least = support
    if among_labelled:
        n = known.agg(F.count(F.lit(1)).alias("all"), F.count("label").alias("labelled"), F.count_if(F.col("label") == "block").alias("block")).first()
        known = known.where(F.col("label").isNotNull())
        # the support stays a share of all URLs; where the labelled ones are fewer than that, nothing has it
        least = min(1.0, support * n["all"] / n["labelled"]) if n["labelled"] else 1.0
    baskets = known.select(F.concat("tokens", label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BLOCK_ITEM))) \
        .where(~F.array_contains("antecedent", ALLOW_ITEM)).select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
    rules = stored(rules, "url-rules")
    if among_labelled:
        rules = stored(closed(significant(rules, support, n["all"], n["labelled"], n["block"]), model.freqItemsets), "url-closed")
    # the number of frequent combinations depends on the support and the tokens of a URL, not on the number of URLs
    parts = rules.select(F.col("antecedent").alias("whole"), F.explode("antecedent").alias("token"))
    inner = rules.select(F.col("antecedent").alias("part"), F.col("antecedent")[0].alias("token"))
    covered = parts.join(inner, "token").where((F.size("part") < F.size("whole")) & (F.size(F.array_except("part", "whole")) == 0)) \
        .select(F.col("whole").alias("antecedent")).distinct()
    return rules.join(covered, "antecedent", "left_anti")


def significant(rules: DataFrame, support: float, n_all: int, n_labelled: int, n_block: int) -> DataFrame:
    """The rules that lift the share of blocked labels, by more than the best of so many rules would by chance."""
    base = n_block / max(1, n_labelled)
    bar = math.log(max(2, rules.count())) + MARGIN
    blocked = F.round(F.col("support") * n_labelled)
    allowed = F.round(F.col("support") / F.col("confidence") * n_labelled) - blocked
    every = blocked + allowed
    surprise = blocked * F.log(blocked / (every * base)) + F.when(allowed > 0, allowed * F.log(allowed / (every * (1 - base)))).otherwise(0.0)
    return rules.where((blocked >= support * n_all) & (F.col("confidence") >= LIFT * base) & (surprise >= bar))


def closed(rules: DataFrame, sets: DataFrame) -> DataFrame:
    """Each rule with all tokens that its labelled URLs share: of URLs without one of these, the labels say nothing."""
    sets = stored(sets.select(F.array_sort("items").alias("items"), "freq"), "url-sets")
    larger = sets.select("items", "freq", F.explode("items").alias("item")).where(~F.col("item").isin(BLOCK_ITEM, ALLOW_ITEM)) \
        .select(F.array_remove("items", F.col("item")).alias("antecedent"), "freq", "item")
    shared = sets.withColumnRenamed("items", "antecedent").join(larger, ["antecedent", "freq"]).groupBy("antecedent").agg(F.collect_set("item").alias("more"))
    whole = F.when(F.col("more").isNull(), F.col("antecedent")).otherwise(F.array_sort(F.array_union("antecedent", "more")))
    return rules.join(shared, "antecedent", "left").select(whole.alias("antecedent"), "confidence", "support").dropDuplicates(["antecedent"])


def judge(pages: DataFrame, rules: list[UrlRule], key: str = "page_id", url: str = "url", support: float = SUPPORT,
          confidence: float = CONFIDENCE, among_labelled: bool = False) -> DataFrame:
    """(key, host, path, rule, verdict, mined) of every row; ``mined``: the tokens of a mined rule that blocks it."""
    u = F.col(url)
    rows = pages.select(F.col(key).alias("k"), u.alias("u")).withColumn("host", host_of(F.col("u"))).withColumn("path", path_of(F.col("u")))
    rows = rows.withColumn("rule", explicit(F.col("host"), F.col("path"), rules, "name")) \
        .withColumn("label", explicit(F.col("host"), F.col("path"), rules, "verdict")) \
        .withColumn("tokens", tokens(F.col("u"), F.col("host"), F.col("path"))).drop("u")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "urls")  # stored: the ids stay as they are
    mined = mine(rows, support, confidence, among_labelled)
    counts = rows.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (mined.select("antecedent", F.explode("antecedent").alias("token")).join(counts, "token")
              .groupBy("antecedent").agg(F.min_by("token", F.struct("n", "token")).alias("token")))
    asked = rows.where(F.col("rule").isNull()).select("row", "tokens", F.explode("tokens").alias("token"))
    hits = (asked.join(rarest, "token").where(F.size(F.array_except("antecedent", "tokens")) == 0)
            .groupBy("row").agg(F.min("antecedent").alias("mined")))
    return rows.join(hits, "row", "left").select(
        F.col("k").alias(key), "host", "path", "rule",
        F.coalesce("label", F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias("verdict"), "mined")
