"""Query on shards of documents."""

from pyspark.sql import functions as F

from labflow.llm import sharding
from labflow.llm.common import read_table

SHARDS = 16


def op8_byte_shards(spark, folder):
    """All documents in contiguous shards of near-equal bytes."""
    docs = read_table(spark, folder, "documents")
    narrow = docs.select(
        "doc_id",
        sharding.text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return sharding.shard(narrow, "doc_id", "size", SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# CRC-32 by its rule: 256 remainders of the reversed polynomial, then one step a byte.
OP8_SQL = f"""
WITH remainders AS (
  SELECT list(r ORDER BY n) AS table_of FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)),
      lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) AS r
    FROM range(256) t(n))),
sized AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, hex(encode(coalesce(text, ''))) AS hex FROM documents),
summed AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(size - 1), lambda i: ('0x' || substr(hex, 2 * i + 1, 2))::BIGINT)),
    lambda r, b: xor(r >> 8, table_of[1 + xor(r & 255, b)]))) AS crc
  FROM sized, remainders),
laid AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS ends, sum(size) OVER () AS total,
    row_number() OVER (ORDER BY doc_id) AS nth
  FROM summed),
cut AS (
  SELECT *, least({SHARDS - 1}, ((2 * ends - size) * {SHARDS}) // (2 * total))::INTEGER AS shard FROM laid)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (nth - min(nth) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""
