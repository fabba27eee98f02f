"""The thin queries of the ten operators, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ball_tree, bin_completion, chat_format, common, compression_toxicity, cross_parsing, merkle_manifest, minhash, quality_cascade,
               simhash, temperature_mix, token_alignment, token_files, url_rules)

read = common.read_table

WORD_END_ID = 1
BYTE_END_ID = 2
CAPACITY = 1024
MAX_REPEAT = 2.0

URL_RULES = [
    url_rules.UrlRule("net", "/", "block"),
    url_rules.UrlRule("example.net", "/en/", "allow"),
    url_rules.UrlRule("example.com", "/de/", "block"),
    url_rules.UrlRule("org", "/fr/", "allow"),
]


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files of this machine are; never copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), WORD_END_ID)


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_cascade.judge(read(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "kept")


def op3_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return ball_tree.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    events = chat_format.rows_as_events(rows.unionByName(own))
    written = common.stored(chat_format.render(chat_format.fold(events)), "chat")
    return chat_format.digest(chat_format.parse(written))


def op5_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_completion.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), BYTE_END_ID, CAPACITY)[0]


def op6_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = common.crc_mod(F.col("doc_id"), 3) == 1
    model = cross_parsing.build(cross_parsing.sample(docs.where(~F.coalesce(held_out, F.lit(False))), "doc_id", "text", "lang"))
    return cross_parsing.predict(docs, model).select(
        "doc_id", F.coalesce(common.crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), 4, 80, 100).withColumnRenamed("key", "doc_id")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> compression_toxicity.Model:
    """Learned from the labels that are not held out, on the given documents."""
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic").where(F.coalesce(common.crc_mod(F.col("doc_id"), 4) != 2, F.lit(False)))
    return compression_toxicity.learn(*compression_toxicity.sample(docs, labels, "doc_id", "text", "toxic", "lang"))


def op8_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = compression_toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(common.crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= compression_toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read(spark, sf_dir, "pages"), URL_RULES, among_labelled=True).drop("mined")


def op10_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = temperature_mix.plan_mix(read(spark, sf_dir, "documents"), max_repeat=MAX_REPEAT)
    return temperature_mix.draw(mix).select(F.col("k").alias("doc_id"), "source", F.col("n").alias("n_tokens"), "block", "place")


LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = merkle_manifest.check(read(spark, sf_dir, "documents"), "source", "doc_id", LEAF_COLUMNS, {"text": lower},
                                 common.crc_mod(F.col("doc_id"), 5) == 0)
    return rows.withColumnRenamed("key", "doc_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), 4).withColumnRenamed("key", "doc_id")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return token_alignment.align_corpus(read(spark, sf_dir, "documents"), *paths).withColumnRenamed("key", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_files, op2_quality_cascade, op3_ball_tree, op4_chat_format, op5_bin_completion, op6_cross_parsing,
                            op7_minhash, op8_compression_toxicity, op9_url_rules, op10_temperature_mix, op11_merkle_manifest, op12_simhash,
                            op13_token_alignment)
}

_SPLIT = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLES: dict[str, str] = {
    "op2_quality_cascade": rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_SPLIT} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM documents),
windows AS (SELECT rid, i, array_to_string(w[i:i + 4], chr(10)) AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
repeated AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM repeated, range(0, 5) r(k) GROUP BY rid),
m AS (SELECT t.doc_id, t.text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t.text) - length(regexp_replace(t.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(t.text, '[^\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(t.text, '[^\p{{Lu}}]', '', 'g')) AS capitals
      FROM t LEFT JOIN covered c USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words
            OR word_chars > 25 * n_words OR 10 * capitals > 7 * letters) AS kept
FROM b""",
    "op3_ball_tree": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs) WHERE rank <= 10""",
    "op4_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(0, 2) r(k)),
m AS (SELECT *, length(role) + length(text) + 15
             + 2 * length(role) - length(replace(replace(role, '\', ''), '<', '')) - length(replace(role, '>', ''))
             + length(text) - length(replace(replace(text, '\', ''), '<', '')) AS n FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id""",
    "op10_temperature_mix": rf"""
WITH d AS (SELECT doc_id, source, len({_SPLIT})::BIGINT AS n FROM documents),
t AS (SELECT source, sum(n)::BIGINT AS tokens FROM d GROUP BY source),
a AS (SELECT CASE WHEN count(*) < 2 THEN 1.0 ELSE least(1.0, greatest(0.0,
             ceil(1e6 * (1 - ln({MAX_REPEAT}) / ln(max(tokens)::DOUBLE / min(tokens)))) / 1e6)) END AS alpha FROM t WHERE tokens > 0),
z AS (SELECT sum(pow(tokens, alpha)) AS z, max(pow(tokens, 1 - alpha)) * sum(pow(tokens, alpha)) AS budget FROM t, a WHERE tokens > 0),
g AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN budget * (pow(tokens, alpha) / z) END AS given FROM t, a, z),
p AS (SELECT source, tokens, given, CASE WHEN tokens > 0 THEN floor(given / tokens + 1e-9) ELSE 1 END::BIGINT AS blocks FROM g),
q AS (SELECT source, blocks, CASE WHEN tokens > 0 THEN greatest(0, round(given - blocks * tokens)) ELSE 0 END::BIGINT AS rest FROM p),
e AS (SELECT d.*, blocks, rest, md5('{temperature_mix.SEED}:' || (blocks + 1) || ':' || doc_id) AS last_place
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
f AS (SELECT *, rest > 0 AND sum(n) OVER (PARTITION BY source ORDER BY last_place, doc_id, n ROWS UNBOUNDED PRECEDING) <= rest AS last FROM e),
x AS (SELECT doc_id, source, n, unnest(range(1, blocks + last::INT + 1)) AS block FROM f)
SELECT doc_id, source, n AS n_tokens, block, md5('{temperature_mix.SEED}:' || block || ':' || doc_id) AS place FROM x""",
    "op11_merkle_manifest": """
WITH RECURSIVE fields AS (
  SELECT doc_id, coalesce('+' || source, '') AS g,
         list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda c, b:
             list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))) AS crc,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text
  FROM documents),
leaves AS (
  SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN sha256(head || coalesce(strlen(lower_text) || ':' || lower_text, '-')) END AS other
  FROM fields),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
nodes AS (
  SELECT g, 0 AS level, i, n, leaf AS h FROM ranked
  UNION ALL
  SELECT g, level + 1, i // 16, (max(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY g, level, i // 16),
subroots AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, (max(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 16),
sides AS (
  SELECT g, level, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY g, level, i // 16 ORDER BY i)),
top_sides AS (
  SELECT level, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM tops WHERE n > 1 WINDOW w AS (PARTITION BY level, i // 16 ORDER BY i)),
steps AS (
  SELECT k.g, k.i, s.level AS step, s.l, s.r FROM ranked k JOIN sides s ON s.g = k.g AND s.i = k.i >> (4 * s.level)
  UNION ALL
  SELECT k.g, k.i, 1000 + s.level, s.l, s.r FROM ranked k JOIN subroots b ON b.g = k.g JOIN top_sides s ON s.i = b.i >> (4 * s.level)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY g, i ORDER BY step) AS k FROM steps),
proof AS (SELECT g, i, sha256(string_agg(l || r, '' ORDER BY k)) AS p, count(*) AS n FROM ordered GROUP BY g, i),
folded AS (
  SELECT g, i, 0::BIGINT AS k, coalesce(other, leaf) AS h FROM ranked
  UNION ALL
  SELECT f.g, f.i, o.k, sha256(o.l || f.h || o.r) FROM folded f JOIN ordered o ON o.g = f.g AND o.i = f.i AND o.k = f.k + 1)
SELECT k.doc_id, k.leaf, b.h AS subroot, t.h AS root, coalesce(p.p, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM ranked k JOIN subroots b ON b.g = k.g JOIN tops t ON t.n = 1 LEFT JOIN proof p ON p.g = k.g AND p.i = k.i
JOIN folded f ON f.g = k.g AND f.i = k.i AND f.k = coalesce(p.n, 0)""",
}
