"""Query on secrets in documents."""

from pyspark.sql import functions as F

from labflow.llm import secrets
from labflow.llm.common import read_table


def op2_markov_secrets(spark, folder):
    """Secrets of every text."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(secrets.labelled_samples(docs)))
    spans = F.col("spans")

    def number(kind):
        return F.size(F.filter(spans, lambda x: x.kind == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in secrets.KINDS],
        F.sha2(secrets.spans_text(spans, secrets.KINDS[:3]).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(spans).alias("spans"),
    )
