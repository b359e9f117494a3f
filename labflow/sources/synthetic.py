"""A deterministic feed for trying the pipeline out."""

from pyspark.sql import functions as F

# Negative results are twice as likely, one in five is a typo.
DRAWN_RESULTS = ["POS", "NEG", "NEG", "N/A", "Positive"]
MAX_LOAD = 5_000


def synthetic_feed(spark, end_date, weeks=5, per_week=5, seed=0):
    """``per_week`` text rows for each of the ``weeks`` weeks that end on ``end_date``, one feed file per week."""
    rows = spark.range(weeks * per_week)
    week = F.floor(F.col("id") / per_week).cast("int")
    sample = F.col("id") % per_week
    draw = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(n))
    day = F.date_sub(F.lit(end_date).cast("date"), week * 7)
    return rows.select(
        F.concat(F.lit("TEST-"), F.weekofyear(day), F.lit("-"), sample).alias("sample_id"),
        F.date_format(day, "yyyy-MM-dd").alias("test_date"),
        F.element_at(F.array(*[F.lit(r) for r in DRAWN_RESULTS]), (draw("result", 5) + 1).cast("int")).alias("result"),
        draw("load", MAX_LOAD + 1).cast("string").alias("viral_load"),
        F.concat(F.lit("Lab_Results_"), F.date_format(day, "yyyy-MM-dd"), F.lit(".csv")).alias("source_file"),
        F.col("id").alias("row_pos"),
    )
