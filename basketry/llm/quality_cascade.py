"""Quality rules as a short-circuit cascade, ordered by rejections per unit of cost.

All work is DataFrame expressions on whole texts.  ``measure`` adds the counts,
``estimate`` runs every rule alone over a bounded sample (its time is the cost, its
share of rejected rows the selectivity), ``cascade`` then tests the rules in order of
rejections per cost inside one CASE, whose later branches are not evaluated once an
earlier one rejects.  The order changes the work and the reported first rule, never
which rows are kept.

Defined cases: a null or empty text has no words and is rejected by the rule on few
words; repeated rows are judged each on their own; keys may be null or tie; an empty
table gives an empty result (rules keep their given order); input columns whose names
clash with the measures are not read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, hash_sample, stored, words

#: Bound of the sample that costs and selectivities are estimated on (rows by hash order, and characters of each).
SAMPLE_ROWS = 400
SAMPLE_CHARS = 20_000

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``rejects``: a condition on the measures and ``text``, never null."""

    name: str
    rejects: Column


def base_rules() -> list[Rule]:
    return [
        Rule("few_words", F.col("n_words") < 10),
        Rule("repeated_windows", 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    ]


def production_rules() -> list[Rule]:
    """The base rules and four of the method's own, each far from what prose shows."""
    letters = F.regexp_count(F.col("text"), F.lit(r"\p{L}"))
    capitals = F.regexp_count(F.col("text"), F.lit(r"\p{Lu}"))
    return [
        *base_rules(),
        Rule("symbols", 10 * F.col("n_symbols") > 3 * F.col("n_words")),
        Rule("duplicate_lines", 2 * F.col("n_dup_lines") > F.col("n_lines")),
        Rule("word_length", (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 25 * F.col("n_words"))),
        Rule("capitals", F.coalesce(10 * capitals > 7 * letters, F.lit(True))),
    ]


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words).

    Windows of five words are compared by 64-bit hashes with the position packed into
    the low bits (as many as the number of words needs), so that sorting one array of
    longs puts equal windows side by side and keeps their places.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(F.col(key).alias(key), body.alias("text"), words(F.col(text)).alias("_w"),
                        F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    hashed = split.select(
        key, "text", "_w", F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.length(F.bin(F.size("_w"))).alias("_b"))
    packed = hashed.select(
        "*", F.expr(f"""CASE WHEN n_words >= {WINDOW} THEN sort_array(transform(sequence(0, size(_w) - {WINDOW}),
            i -> shiftleft(xxhash64({', '.join(f'_w[i + {k}]' for k in range(WINDOW))}), _b) | i)) ELSE array() END""").alias("_s"))
    twice = packed.select(
        "*", F.expr("""sort_array(transform(filter(_s, (x, i) ->
            (i > 0 AND shiftright(x ^ get(_s, i - 1), _b) = 0) OR (i < size(_s) - 1 AND shiftright(x ^ get(_s, i + 1), _b) = 0)),
            x -> x & (shiftleft(1L, _b) - 1)))""").alias("_p"))
    covered = F.expr(f"""aggregate(_p, named_struct('to', -1L, 'n', 0L),
        (a, x) -> named_struct('to', x + {WINDOW}, 'n', a.n + x + {WINDOW} - greatest(x, a.to)), a -> a.n)""")
    return twice.select(key, "text", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", covered.alias("n_repeat_words"))


def estimate(sampled: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, seconds for the measured sample, share rejected), highest rejections per second first."""
    sample = stored(sampled, "quality-sample")
    found = []
    for rule in rules:
        seconds = []
        for _ in range(2):  # the first run also compiles
            began = time.perf_counter()
            n, rejected = sample.agg(F.count(F.lit(1)), F.sum(rule.rejects.cast("int"))).first()
            seconds.append(time.perf_counter() - began)
        found.append((rule, min(seconds), (rejected or 0) / max(1, n)))
    return sorted(found, key=lambda x: -x[2] / x[1])


def cascade(measured: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``rejected_by``: the first rule, in the order given, that rejects a row; null if none does."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(rule.name)).otherwise(verdict)
    return measured.withColumn("rejected_by", verdict)


def judge(docs: DataFrame, rules: list[Rule] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures, ``rejected_by`` and ``kept`` for every row, with the rules in estimated order.

    The sample for the estimate is drawn before the measures are taken, so that they
    are computed once over the whole table.
    """
    rules = rules or production_rules()
    drawn = hash_sample(docs.select(key), docs.select(key, text), key, SAMPLE_ROWS).where(F.coalesce(F.length(text), F.lit(0)) <= SAMPLE_CHARS)
    order = [r for r, _, _ in estimate(measure(drawn, key, text), rules)]
    return cascade(measure(docs, key, text), order).withColumn("kept", F.col("rejected_by").isNull())
