"""Mixing sources: temperature weights by bisection, realised as budgeted block permutations.

Source shares of the tokens are raised to an exponent between 0 and 1 and normalised.
The exponent is bisected until the weights meet a target entropy (a share of the
largest possible), or until no source is repeated more than a limit.  Each source then
gets its weight's part of the token budget: whole blocks, each a permutation of all
its documents, and the beginning of one more permutation that stays within the rest.
With no budget given it is the smallest that holds every document at least once.

Permutations are orders by MD5 of seed, block and key.  The cut through the last one
is found from sums of hash buckets first, and only the bucket it falls in is ordered,
so that a source with a third of all rows is spread over its buckets.

Defined cases: a null source is a source of its own; null or empty texts have no
tokens; a source without tokens takes its documents once; repeated rows are
documents each, ties in a permutation go by key and tokens; null keys hash as empty;
one source alone gets weight 1; an empty table gives no rows; other columns are not
read, and ``mix_documents`` hands them through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, words

#: Exponents tried side by side, and rounds: the exponent is exact to about 1e-6.
GRID = 32
ROUNDS = 4
SEED = 17
#: Hash buckets of a source for the cut, as leading hex digits.
BUCKET_DIGITS = 3


def permuted(block: Column, key: Column) -> Column:
    """The place of a key in the permutation of a block, as text that sorts."""
    return F.md5(F.concat_ws(":", F.lit(str(SEED)), block.cast("string"), key.cast("string")).cast("binary"))


def exponent(totals: DataFrame, budget: float | None = None, max_repeat: float | None = None, target_entropy: float | None = None) -> float:
    """The exponent that meets the target, from (source, tokens); every round is one aggregate over the sources.

    ``max_repeat``: the smallest exponent (flattest weights) that repeats no source
    more often; ``target_entropy``: the largest (closest to the shares) with that
    share of the largest entropy.
    """
    if (max_repeat is None) == (target_entropy is None):
        raise ValueError("give one of max_repeat and target_entropy")
    total, n = totals.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not n or n == 1:
        return 1.0
    p = F.col("tokens") / F.lit(float(total))
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / GRID
        tried = [low + step * k for k in range(GRID + 1)]
        a = F.col("a")
        rows = (totals.select(p.alias("p"), F.explode(F.array(*map(F.lit, tried))).alias("a")).groupBy("a")
                .agg(F.sum(F.pow("p", a)).alias("z"), F.sum(F.pow("p", a) * F.log("p")).alias("s"),
                     F.max(F.pow("p", a - 1)).alias("up"), F.max(F.pow("p", 1 - a)).alias("down")).orderBy("a").collect())
        meets = []
        for r in rows:
            if max_repeat is not None:
                spent = r.down * r.z if budget is None else budget / total
                meets.append(spent * r.up / r.z <= max_repeat * (1 + 1e-12))
            else:
                meets.append(math.log(r.z) - r.a * r.s / r.z >= target_entropy * math.log(n) - 1e-12)
        if max_repeat is not None:  # more repetition the smaller the exponent
            first = next((k for k, m in enumerate(meets) if m), GRID)
            low, high = tried[max(first - 1, 0)], tried[first]
        else:                       # less entropy the larger the exponent
            last = max((k for k, m in enumerate(meets) if m), default=0)
            low, high = tried[last], tried[min(last + 1, GRID)]
        if low == high:
            break
    return round(high if max_repeat is not None else low, 6)


def budgets(totals: DataFrame, alpha: float, budget: float | None = None) -> DataFrame:
    """(source, tokens, weight, blocks, rest): whole blocks and tokens of the last one, for every source."""
    some = totals.where("tokens > 0")
    z, most, total = (some.withColumn("t", F.col("tokens").cast("double"))
                      .agg(F.sum(F.pow("t", F.lit(alpha))), F.max(F.pow("t", F.lit(1 - alpha))), F.sum("t")).first())
    z, spent = z or 1.0, ((most or 0.0) * (z or 0.0) if budget is None else float(budget))
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(alpha)) / F.lit(z)).otherwise(F.lit(0.0))
    given = F.lit(spent) * F.col("weight")
    blocks = F.when(F.col("tokens") > 0, F.floor(given / F.col("tokens") + F.lit(1e-9))).otherwise(F.lit(1)).cast("long")
    return (totals.withColumn("weight", weight).withColumn("blocks", blocks)
            .withColumn("rest", F.when(F.col("tokens") > 0, F.greatest(F.lit(0), F.round(given - F.col("blocks") * F.col("tokens")))).otherwise(0).cast("long")))


def copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows (k, source, n) with ``blocks`` and ``last``: whether the last, partial permutation takes the row too."""
    given = rows.join(plan.select(F.col("source").alias("_s"), "blocks", "rest"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    dealt = given.withColumn("place", permuted(F.col("blocks") + 1, F.col("k"))).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sums = dealt.groupBy("source", "bucket").agg(F.sum("n").alias("s"))
    before = F.coalesce(F.sum("s").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = sums.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), before.alias("before"), (before + F.col("s")).alias("after"))
    placed = dealt.join(cut, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b"))).drop("_s", "_b")
    names = ["k", "source", "n", "blocks"]
    clear = placed.where((F.col("after") <= F.col("rest")) | (F.col("before") >= F.col("rest"))) \
        .select(*names, ((F.col("after") <= F.col("rest")) & (F.col("rest") > 0)).alias("last"))
    within = F.sum("n").over(Window.partitionBy("source", "bucket").orderBy("place", "k", "n").rowsBetween(Window.unboundedPreceding, 0))
    split = placed.where((F.col("after") > F.col("rest")) & (F.col("before") < F.col("rest"))) \
        .select(*names, (F.col("before") + within <= F.col("rest")).alias("last"))
    return clear.unionByName(split)


def plan_mix(docs: DataFrame, max_repeat: float | None = None, target_entropy: float | None = None, budget: float | None = None,
             key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(k, source, n, blocks, last) of every document: how often each is taken."""
    rows = stored(docs.select(F.col(key).alias("k"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("n")), "mix-rows")
    totals = stored(rows.groupBy("source").agg(F.sum("n").alias("tokens")), "mix-totals")
    alpha = exponent(totals.where("tokens > 0"), budget, max_repeat, target_entropy)
    return copies(rows, budgets(totals, alpha, budget))


def draw(mix: DataFrame) -> DataFrame:
    """(k, source, n, block, place): a row for each time a document is taken; sorted by block and place it is the mixture of its source."""
    last = F.col("blocks") + F.col("last").cast("int")
    return mix.where(last > 0).select("k", "source", "n", F.explode(F.sequence(F.lit(1).cast("long"), last)).alias("block")) \
        .withColumn("place", permuted(F.col("block"), F.col("k")))


def mix_documents(docs: DataFrame, max_repeat: float | None = None, target_entropy: float | None = None, budget: float | None = None,
                  key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The documents with all their columns, each as often as the mixture takes it (rows that share a key: the most often)."""
    mix = plan_mix(docs, max_repeat, target_entropy, budget, key, source, text)
    taken = mix.groupBy("k").agg(F.max(F.col("blocks") + F.col("last").cast("int")).alias("times")).withColumnRenamed("k", "of")
    whole = docs.select(F.col(key).alias("k"), F.struct(*docs.columns).alias("doc"))  # own names cannot meet the documents'
    many = whole.join(taken, F.col("k").eqNullSafe(F.col("of"))).where(F.col("times") > 0)
    return many.select("doc", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("time")).select("doc.*")
