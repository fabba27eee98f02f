"""Decision lists: ordered rules over attributes with wildcards, first match wins.

A rule names a value for some of the attributes; the others are wildcards.  Each rule is indexed by one
of its values, the one that fewest rows have, so rows are matched by an equi-join on (attribute, value) and
only rows that have a rule's rarest value meet it.  That holds for rule tables of any size; no row is compared with
rules that share nothing with it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rule_table(spark: SparkSession, rules: list[tuple], attributes: list[str], results: list[str]) -> DataFrame:
    """(rule, attributes, results): rules in their order; None in an attribute is a wildcard."""
    names = ["rule bigint", *[f"`{c}` string" for c in [*attributes, *results]]]
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rules)], ", ".join(names))


def rule_index(rules: DataFrame, rows: DataFrame, attributes: list[str]) -> DataFrame:
    """``rules`` with the attribute ``_at`` and value ``_is`` that index each: of its values the one fewest ``rows`` have.

    A rule without any value has a NULL index.
    """
    cells = lambda df: F.explode(F.array(*[F.struct(F.lit(a).alias("at"), F.col(a).alias("is")) for a in attributes])).alias("c")
    wanted = rules.select("rule", cells(rules)).where(F.col("c.is").isNotNull()).select("rule", "c.at", "c.is")
    named = wanted.select("at", "is").distinct()
    seen = rows.select(cells(rows)).select("c.at", "c.is").join(named, ["at", "is"], "left_semi").groupBy("at", "is").agg(F.count(F.lit(1)).alias("n"))
    best = wanted.join(seen, ["at", "is"], "left").groupBy("rule").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("at"), F.col("is"))).alias("b"))
    return rules.join(best, "rule", "left").select(rules["*"], F.col("b.at").alias("_at"), F.col("b.is").alias("_is"))


def first_match(rows: DataFrame, key: str, rules: DataFrame, attributes: list[str], results: list[str]) -> DataFrame:
    """(key, rule, results) of the first rule that fits each row; rows that none fits are left out.

    ``key`` is unique; attributes are compared as they are, and NULL fits only a wildcard.
    """
    index = rule_index(rules, rows.select(*attributes), attributes).select(
        "rule", *[F.col(a).alias(f"_r_{a}") for a in attributes], *[F.col(r).alias(f"_v_{r}") for r in results], "_at", "_is")
    cells = F.explode(F.array(*[F.struct(F.lit(a).alias("at"), F.col(a).alias("is")) for a in attributes])).alias("_c")
    fits = reduce(lambda x, y: x & y, [F.col(f"_r_{a}").isNull() | (F.col(f"_r_{a}") == F.col(a)) for a in attributes])
    given = rows.select(key, *attributes)
    values = F.struct("rule", *[f"_v_{r}" for r in results]).alias("_m")
    met = (given.select("*", cells).where(F.col("_c.is").isNotNull())
           .join(index, (F.col("_c.at") == F.col("_at")) & (F.col("_c.is") == F.col("_is"))).where(fits).select(key, values))
    # rules of wildcards only fit every row: the first of them is one value
    general = index.where(F.col("_at").isNull()).agg(F.min(F.struct("rule", *[f"_v_{r}" for r in results])).alias("_m"))
    least = met.groupBy(key).agg(F.min("_m").alias("_m"))
    best = given.select(key).join(least, key, "left").withColumn("_g", general.scalar())
    best = best.select(key, F.when(F.col("_m.rule") <= F.coalesce(F.col("_g.rule"), F.col("_m.rule")), F.col("_m")).otherwise(F.coalesce("_g", "_m")).alias("_m"))
    return best.where(F.col("_m.rule").isNotNull()).select(key, "_m.rule", *[F.col(f"_m._v_{r}").alias(r) for r in results])
