"""Small tables with the cases every operator must handle."""
from __future__ import annotations

from pyspark.sql import SparkSession

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"

LONG = " ".join(f"word{k % 9173}" for k in range(40_000))
BODY = "the quick brown fox jumps over the lazy dog and then runs away from all of the other animals in this small wood"
EDGE_TEXTS = [
    None, "", " \n\t ", "a", "one two", "one two three four", BODY, BODY, BODY + " today", "x" * 5000, LONG, LONG + " end",
    "é à ü ß. Ça va,bien\r\nmerci  <|endoftext|> # $ %", "tab\tand\x0bvertical\x0cfeed", "line\nline\nline\n\nother",
    "İstanbul ΣΑΣ 日本語 \U0001F600 a\u0301", "12345 67890 !!! ...",
]


def edge_documents(spark: SparkSession):
    """Edge texts with null languages and sources, repeated rows, a null key, and extra columns with clashing names."""
    rows = [(k, t, [None, "en", "fr"][k % 3], ["a", "a", None][k % 3], k % 2) for k, t in enumerate(EDGE_TEXTS)]
    rows += [rows[6], (None, BODY, "en", "b", 0), (None, None, None, None, None)]
    wide = [(*r, "clash", 1, 2.0) for r in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, key string, n_tokens long, score double")


def empty_documents(spark: SparkSession):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
