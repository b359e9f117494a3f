"""Query on personal data in documents."""

from pyspark.sql import functions as F

from labflow.llm import pii
from labflow.llm.common import read_table


def op12_boosted_private_spans(spark, folder):
    """Personal data of every text."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = pii.scan(docs, pii.train(pii.labelled_candidates(docs)))
    spans = F.col("spans")

    def number(kind):
        return F.size(F.filter(spans, lambda x: x.kind == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in pii.KINDS],
        F.sha2(pii.spans_text(spans, pii.KINDS).cast("binary"), 256).alias("base_sha256"),
        pii.spans_text(spans).alias("spans"),
    )
