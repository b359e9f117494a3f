"""Queries on byte-level encoding, token counts and packing."""

import public_tokenizers
from pyspark.sql import functions as F

from labflow.llm import tokens
from labflow.llm.common import read_table

ROUND_TRIP_RANKS = "byte_bpe_multi_50k.tiktoken"
COUNT_MODEL = "piece_bpe_32k.model"
PACK_MODEL = "byte_bpe_50k.json"
TOKEN_LIMIT = 4096


def op3_bpe_round_trip(spark, folder):
    """Ids of every text, and the bytes that they decode to."""
    ranks = tokens.vocabulary(spark, public_tokenizers.path(ROUND_TRIP_RANKS))
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    encoded = tokens.encode(docs, ranks, public_tokenizers.PATTERN)
    decoded = tokens.decode(encoded.drop("text"), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        tokens.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_binary_pieces(spark, folder):
    """Every document cut into sequences of power-of-two lengths."""
    vocabulary = tokens.vocabulary(spark, public_tokenizers.path(PACK_MODEL))
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    packed = tokens.pack(docs, vocabulary, pattern=public_tokenizers.PATTERN)
    return digest_of_pieces(packed)


def digest_of_pieces(packed, *more):
    """The pieces with a digest for their ids, and ``more`` of their columns."""
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "bucket",
        *more,
    )


def op9_token_counts(spark, folder):
    """Tokens of every text, and whether they exceed the limit."""
    vocabulary = tokens.vocabulary(spark, public_tokenizers.path(COUNT_MODEL))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    docs = read_table(spark, folder, "documents").select("doc_id", "text", size.alias("n_bytes"))
    counted = tokens.count_tokens(docs, vocabulary, "sentencepiece", keep=["doc_id", "n_bytes"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))
