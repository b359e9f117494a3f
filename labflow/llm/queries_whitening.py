"""Query on whitened embeddings."""

from pyspark.sql import functions as F

from labflow.llm import whitening
from labflow.llm.common import read_table


def op13_polarised_whitening(spark, folder):
    """Every usable vector on the components of the distinct ones."""
    rows = whitening.on_grid(read_table(spark, folder, "embeddings").select("vec_id", "embedding")).drop("embedding")
    model = whitening.fit(rows)
    explained = F.array(*[F.lit(e).cast("double") for e in model.explained]).cast("array<double>")
    found = whitening.whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return found.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.count).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, "at").alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
