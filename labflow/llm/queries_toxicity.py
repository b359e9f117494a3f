"""Query on the toxicity of documents."""

from pyspark.sql import functions as F

from labflow.llm import toxicity
from labflow.llm.common import read_table
from labflow.llm.toxicity import THRESHOLD


def fitted(docs, spark, folder):
    """A model trained on the labelled documents that are not held out."""
    return toxicity.train(*toxicity.labelled_sample(docs, read_table(spark, folder, "labels")))


def op1_gated_network_toxicity(spark, folder):
    """Score and prediction for every text."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, fitted(docs, spark, folder))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
