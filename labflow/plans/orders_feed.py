"""Lab feeds derived from TPC-H-like tables, to drive the operators at any scale."""

from pyspark.sql import functions as F

FILES = 5


def orders_feed(orders, keep=()):
    """A text feed with wrong dates, codes and loads at fixed order keys; ``keep`` names order columns to pass on."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    code = F.when(F.col("o_orderstatus") == "F", "POS").when(F.col("o_orderstatus") == "O", "NEG").otherwise("N/A")
    load = F.floor("o_totalprice").cast("string")
    return orders.select(
        F.concat(F.lit("S-"), F.col("o_custkey")).alias("sample_id"),
        F.when(key % 41 == 0, "12/01/2025").otherwise(day).alias("test_date"),
        F.when(key % 17 == 0, "Positive").otherwise(code).alias("result"),
        F.when(key % 29 == 0, "x").when(key % 31 != 0, load).alias("viral_load"),
        F.concat(F.lit("Lab_Results_"), key % FILES, F.lit(".csv")).alias("source_file"),
        key.alias("row_pos"),
        *keep,
    )


def lax_feed(orders):
    """A feed whose dates and loads take every text form the contract admits, and some it does not."""
    key = F.col("row_pos")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    epoch = F.unix_date(F.col("o_orderdate").cast("date")) * F.lit(86400).cast("bigint")
    load = F.floor("o_totalprice").cast("string")
    return (
        orders_feed(orders, keep=["o_orderdate", "o_totalprice"])
        .withColumn(
            "test_date",
            F.when(key % 12 == 1, F.concat(day, F.lit("T00:00:00")))
            .when(key % 12 == 2, F.concat(day, F.lit(" 00:00Z")))
            .when(key % 12 == 3, F.concat(day, F.lit("t00:00:00.000+05:30")))
            .when(key % 12 == 4, F.concat(day, F.lit("T10:30:00")))
            .when(key % 12 == 5, epoch.cast("string"))
            .when(key % 12 == 6, F.concat((epoch * 1000).cast("string"), F.lit(".0")))
            .when(key % 12 == 7, (epoch + 1).cast("string"))
            .when(key % 12 == 8, F.concat(F.lit(" "), day))
            .when(key % 12 == 9, "2025-02-30")
            .when(key % 12 == 10, "0000-01-01")
            .otherwise(day),
        )
        .withColumn(
            "viral_load",
            F.when(key % 11 == 1, F.concat(F.lit("+"), load))
            .when(key % 11 == 2, F.concat(F.lit("-"), load))
            .when(key % 11 == 3, F.concat(F.lit("  00"), load, F.lit(" ")))
            .when(key % 11 == 4, F.concat(load, F.lit(".00")))
            .when(key % 11 == 5, F.concat(F.lit("1_"), load))
            .when(key % 11 == 6, F.concat(load, F.lit(".5")))
            .when(key % 11 == 7, F.concat(load, F.lit("e3")))
            .when(key % 11 == 8, F.concat(load, F.lit("99999999999999999999")))
            .when(key % 11 == 9, "")
            .otherwise(load),
        )
        .drop("o_orderdate", "o_totalprice")
    )


def moved_in_week(day):
    """Another day of the same calendar year and ISO week, where there is one."""
    before, after = F.date_sub(day, 1), F.date_add(day, 1)
    return (
        F.when((F.weekday(day) > 0) & (F.year(before) == F.year(day)), before)
        .when((F.weekday(day) < 6) & (F.year(after) == F.year(day)), after)
        .otherwise(day)
    )


def deletion_requests(customer, records, files=FILES):
    """Requests as typed ``sample_id`` and ``test_date``, for every tenth customer.

    Each asks for the customer's last record, by another day of its week. Every hundredth customer's sample is also
    asked for in a week that no record has, and every tenth customer but one in a week that has others' records.
    """
    number = F.col("c_custkey")
    source = F.concat(F.lit("Requests_"), F.col("c_nationkey") % files, F.lit(".csv")).alias("source_file")
    sample = F.concat(F.lit("S-"), number)
    asked = customer.filter("c_custkey % 10 = 0").select(sample.alias("sample_id"), "c_nationkey")
    last = records.groupBy("sample_id").agg(F.max("test_date").alias("test_date"))
    real = last.join(asked, "sample_id").select("sample_id", moved_in_week(F.col("test_date")).alias("test_date"), source)
    no_week = customer.filter("c_custkey % 100 = 0").select(
        sample.alias("sample_id"),
        F.date_add(F.lit("2031-01-06").cast("date"), (7 * F.col("c_nationkey")).cast("int")).alias("test_date"),
        source,
    )
    no_sample = customer.filter("c_custkey % 10 = 1").select(
        F.concat(F.lit("X-"), number).alias("sample_id"),
        F.date_add(F.lit("1992-01-06").cast("date"), (7 * (number % 331)).cast("int")).alias("test_date"),
        source,
    )
    return real.unionByName(no_week).unionByName(no_sample)
