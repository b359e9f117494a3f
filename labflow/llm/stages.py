"""Stages of the corpus pipeline: each takes (spark, docs, folder) and returns a frame.

All but the last return the columns of the documents they are given. Rows with a null text or doc_id pass through every
stage; of rows with the same doc_id and text one is left after near-dedup, rows that share only a doc_id stay or go
together there.
"""

import public_tokenizers
from pyspark.sql import functions as F

from labflow.llm import bagminhash, secrets, tokens, toxicity
from labflow.llm.queries_documents import LEAST_SIMILARITY
from labflow.llm.queries_tokens import PACK_MODEL, digest_of_pieces
from labflow.llm.queries_toxicity import THRESHOLD, fitted


def drop_toxic(spark, docs, folder):
    """Documents that score below the threshold; the model is trained on the labelled ones among them."""
    scored = toxicity.score(docs, fitted(docs, spark, folder), out="_kept_score")
    return scored.where(F.col("_kept_score") < THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark, docs, folder):
    """One document of each class of near-duplicates, that with the smallest doc_id, and one row of each document."""
    found = bagminhash.near_duplicates(docs, LEAST_SIMILARITY)
    copies = found.where(~F.col("kept")).select(F.col("doc_id").alias("_copy")).distinct()
    kept = docs.join(copies, F.col("doc_id") == F.col("_copy"), "left_anti")
    whole = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    own = [F.col(f"`{c}`") for c in docs.columns]
    # Only rows whose doc_id comes more than once are compared; the others are not shuffled with their texts.
    repeated = kept.where(whole).groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_repeated"))
    same = F.col("doc_id") == F.col("_repeated")
    single = kept.join(repeated, same & whole, "left_anti")
    # A minimum is taken before the shuffle as well, and does not depend on how rows are dealt out.
    values = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "doc_id"])
    rest = kept.where(whole).join(repeated, same, "left_semi")
    one = rest.groupBy("doc_id", F.sha2(F.col("text").cast("binary"), 256)).agg(F.min(values).alias("_row"))
    one = one.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"_row.`{c}`") for c in docs.columns])
    return single.select(*own).unionByName(one)


def redact_secrets(spark, docs, folder):
    """All documents, every secret in their texts replaced by a mark and their length counted anew."""
    found = secrets.scan(docs, secrets.train(secrets.labelled_samples(docs)), out="_found")
    clean = found.withColumn("text", secrets.redact(F.col("text"), F.col("_found")))
    if "n_chars" in docs.columns:
        changed = F.size("_found") > 0
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark, docs, folder):
    """Pieces of power-of-two lengths, one row each, with their token ids (little-endian, 32 bits each)."""
    vocabulary = tokens.vocabulary(spark, public_tokenizers.path(PACK_MODEL))
    packed = tokens.pack(docs.select("doc_id", "text"), vocabulary, pattern=public_tokenizers.PATTERN)
    return digest_of_pieces(packed, "ids")
