"""Token-id files: zstandard frames per document under one shared dictionary.

Layout of a token file set, a folder with two Parquet tables:

* ``dictionary``: one row (dict_hash, id_bytes, content), the shared zstandard
  dictionary trained on serialized id arrays, its xxh64 and the bytes of an id.
* ``blocks``: one row per block of documents in ascending key order: (bucket, block,
  first_key, last_key, keys, n_tokens, offsets, total_tokens, dict_hash, body).
  ``body`` is the frames one after another, ``offsets`` (one more than documents) the
  index: a document is read by decompressing ``body[offsets[i]:offsets[i + 1]]`` alone.

Keys ascend with (bucket, block, place in the block).  A block closes at
``BLOCK_BYTES``; a single longer frame is a block of its own.

Defined cases: a null or empty text has the end id only; a null key comes first;
rows that share a key are all kept, ordered by their frames; an empty table gives an
empty file set with an empty dictionary; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hash_sample, shared_path, ship
from .tokens import encoder, slices
from .tokens import id_bytes as least_id_bytes

#: Bounds of the dictionary's training sample: documents (by hash order of the key) and characters of each.
SAMPLE_DOCS = 1024
SAMPLE_CHARS = 20_000
DICT_BYTES = 64 << 10
LEVEL = 3
BLOCK_BYTES = 4 << 20

BLOCKS = ("bucket int, block int, first_key bigint, last_key bigint, keys array<bigint>, n_tokens array<bigint>, "
          "offsets array<bigint>, total_tokens bigint, dict_hash string, body binary")


def train_dictionary(docs: DataFrame, key: str, text: str, path: str, folds_case: bool, end_id: int, id_bytes: int) -> bytes:
    """Dictionary content from a bounded sample of documents; empty if there is too little to learn from."""
    import zstandard

    keyed = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"))
    sample = (hash_sample(keyed.select("k"), keyed, "k", SAMPLE_DOCS).groupBy("k").agg(F.min(F.substring("t", 1, SAMPLE_CHARS)).alias("t"))
              .where(F.length("t") > 0).toArrow().sort_by([("k", "ascending"), ("t", "ascending")]).select(["t"]))
    ids, at = encoder(path, folds_case).encode(sample.column(0).combine_chunks().cast(pa.string())) if sample.num_rows else ([], [0])
    rows = [np.append(ids[at[k]:at[k + 1]], end_id).astype(f"<u{id_bytes}").tobytes() for k in range(len(at) - 1)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, rows, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # fewer samples than the trainer needs
        return b""


def dictionary_hash(content: bytes) -> str:
    import xxhash

    return xxhash.xxh64_hexdigest(content)


def write_token_files(docs: DataFrame, out: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
                      folds_case: bool = True, id_bytes: int | None = None) -> None:
    """Encode every whole text, append ``end_id`` and write a token file set to the folder ``out``.

    Each text is encoded and compressed where it is read; only compressed frames are
    shuffled, by ranges of the key taken from its quantiles.
    """
    spark = docs.sparkSession
    ship(spark)
    id_bytes = id_bytes or least_id_bytes(tokenizer, end_id)
    content = train_dictionary(docs, key, text, tokenizer, folds_case, end_id, id_bytes)
    mark = dictionary_hash(content)
    spark.createDataFrame([(mark, id_bytes, bytearray(content))], "dict_hash string, id_bytes int, content binary") \
        .coalesce(1).write.parquet(f"{out}/dictionary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 4 * parts
    quantiles = docs.select(F.percentile_approx(F.col(key).cast("bigint"), [k / n for k in range(1, n)], 20 * n)).first()[0]
    bounds = np.unique(np.array(quantiles or [], np.int64))

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc = encoder(tokenizer, folds_case)
        given = {"dict_data": zstandard.ZstdCompressionDict(content)} if content else {}
        if content:
            given["dict_data"].precompute_compress(level=LEVEL)
        pack = zstandard.ZstdCompressor(level=LEVEL, **given).compress
        kind = f"<u{id_bytes}"
        for batch in batches:
            for i, j in slices(batch.column(1)):
                keys, (ids, at) = batch.column(0).slice(i, j - i), enc.encode(batch.column(1).slice(i, j - i))
                ids, at = ids.astype(kind), at.tolist()
                end = np.array([end_id], kind).tobytes()
                out_frames = [pack(ids[at[k]:at[k + 1]].tobytes() + end) for k in range(j - i)]
                where = np.searchsorted(bounds, keys.fill_null(0).to_numpy(), "right") + 1
                where[keys.is_null().to_numpy(zero_copy_only=False)] = 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where, pa.int32()), keys, pa.array(np.diff(at) + 1, pa.int64()), pa.array(out_frames, pa.binary())],
                    ["bucket", "k", "n", "frame"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in BLOCKS.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()),
                 pa.int64(), pa.string(), pa.binary()]
        held, size, number, now = [], 0, 0, None

        def closed() -> pa.RecordBatch:
            at = np.cumsum([0, *(len(x[2]) for x in held)])
            keys = [x[0] for x in held]
            row = [now, number, keys[0], keys[-1], keys, [x[1] for x in held], at, sum(x[1] for x in held), mark,
                   b"".join(x[2] for x in held)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for b, *doc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (b != now or size + len(doc[2]) > BLOCK_BYTES):
                    yield closed()
                    number, held, size = (number + 1 if b == now else 0), [], 0
                now = b
                held.append(doc)
                size += len(doc[2])
        if held:
            yield closed()

    (docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"))
     .mapInArrow(frames, "bucket int, k bigint, n bigint, frame binary")
     .repartition(parts, "bucket").sortWithinPartitions("bucket", "k", "n", "frame")
     .mapInArrow(blocks, BLOCKS)
     .write.option("compression", "none").option("parquet.block.size", str(16 << 20)).parquet(f"{out}/blocks"))


def read_tokens(spark: SparkSession, folder: str, first_key: int | None = None, last_key: int | None = None, checksums: bool = False) -> DataFrame:
    """Documents of a token file set: (bucket, block, place, before, key, n_tokens, ids), or ``ids_crc32`` in place of ids.

    ``before`` counts the ids of earlier documents of the block, ``ids`` holds
    little-endian unsigned ids of the width that ``dictionary`` gives.  With a range of
    keys only the blocks that reach into it are read (their first and last key are
    pushed down to the scan), and only its documents are decompressed.  Checksums are
    those of ``widened_crc32``, taken where a document is read: no second Python worker
    stands behind the first.
    """
    ship(spark)
    known = {r.dict_hash: (r.id_bytes, bytes(r.content)) for r in spark.read.parquet(f"{folder}/dictionary").limit(1).collect()}
    table = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    name = "ids_crc32" if checksums else "ids"
    if first_key is not None:
        table = table.where(F.col("last_key") >= first_key)
    if last_key is not None:
        table = table.where(F.col("first_key") <= last_key)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = {h: zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(c)} if c else {})).decompress
                  for h, (_, c) in known.items()}
        for batch in batches:
            for k in range(batch.num_rows):
                bucket, block, keys, n, at, mark, body = (c[k].as_py() for c in batch.columns)
                width = known[mark][0]
                before = np.cumsum([0, *n])
                picked = [i for i, x in enumerate(keys) if (first_key is None or x is not None and x >= first_key)
                          and (last_key is None or x is not None and x <= last_key)]
                for i in range(0, len(picked), 512):
                    some = picked[i:i + 512]
                    ids = [unpack[mark](body[at[x]:at[x + 1]]) for x in some]
                    last = pa.array([widened_crc32(x, width) for x in ids], pa.int64()) if checksums else pa.array(ids, pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bucket] * len(some), pa.int32()), pa.array([block] * len(some), pa.int32()), pa.array(some, pa.int32()),
                         pa.array([int(before[x]) for x in some], pa.int64()), pa.array([keys[x] for x in some], pa.int64()),
                         pa.array([n[x] for x in some], pa.int64()), last],
                        ["bucket", "block", "place", "before", "key", "n_tokens", name])

    return table.select("bucket", "block", "keys", "n_tokens", "offsets", "dict_hash", "body").mapInArrow(
        documents, f"bucket int, block int, place int, before bigint, key bigint, n_tokens bigint, {name} {'bigint' if checksums else 'binary'}")


def block_starts(spark: SparkSession, folder: str) -> DataFrame:
    """(bucket, block, start): ids in all blocks before each, by prefix sums inside buckets and then over bucket totals."""
    totals = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").select("bucket", "block", "total_tokens")
    before = lambda w: F.coalesce(F.sum("total_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = totals.withColumn("inside", before(Window.partitionBy("bucket").orderBy("block")))
    outer = (totals.groupBy("bucket").agg(F.sum("total_tokens").alias("total_tokens"))
             .select("bucket", before(Window.orderBy("bucket")).alias("outer")))  # a row for each bucket: 4 times the shuffle partitions
    return inside.join(outer, "bucket").select("bucket", "block", (F.col("inside") + F.col("outer")).alias("start"))


def widened_crc32(ids: bytes, id_bytes: int) -> int:
    """crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.frombuffer(ids, f"<u{id_bytes}").astype("<u4").tobytes())


def token_digest(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder, read them back, and give each document's place and checksum."""
    spark = docs.sparkSession
    folder = shared_path(spark, "token-files")
    write_token_files(docs, folder, tokenizer, end_id)

    rows = read_tokens(spark, folder, checksums=True)
    return rows.join(block_starts(spark, folder), ["bucket", "block"]).select(
        F.col("key").alias("doc_id"), (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
