"""The reference's inputs, derived from the test tables by Spark.

Each builder is a plain DataFrame plan over the given tables, so its cost grows
with them. The mapping is documented in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the log stand-in: country suffixes assigned by user id, the
# fake request shape and the time zone text of the original log.
LOG_SUFFIXES = ["de", "ca", "sg", "com"]
LOG_ZONE_TEXT = " -0400"


def access_log_lines(events: DataFrame) -> DataFrame:
    """Common-log-format text lines, one per event, column ``value``.

    host ``h<user_id>.<suffix>`` with the suffix chosen by ``user_id % 4``;
    bytes are ``floor(value*100)`` but ``-`` when ``value < 0.5``; the user field
    is ``bob`` instead of ``-`` when the props key ``k`` is 0 (the time then
    fails the parser's pattern, as in the original log); an ``error`` event is
    a 404.
    """
    suffix = F.element_at(F.array(*[F.lit(s) for s in LOG_SUFFIXES]),
                          (F.pmod(F.col("user_id"), F.lit(len(LOG_SUFFIXES))) + 1).cast("int"))
    host = F.concat(F.lit("h"), F.col("user_id").cast("string"), F.lit("."), suffix)
    user = F.when(F.get_json_object("props", "$.k").try_cast("int") == 0, F.lit("bob")).otherwise(F.lit("-"))
    when_text = F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(LOG_ZONE_TEXT))
    request = F.concat(F.lit("GET /"), F.col("event_type"), F.lit(" HTTP/1.0"))
    status = F.when(F.col("event_type") == "error", F.lit("404")).otherwise(F.lit("200"))
    size = F.when(F.col("value") < 0.5, F.lit("-")).otherwise(
        F.floor(F.col("value") * 100).cast("bigint").cast("string"))
    line = F.concat(host, F.lit(" - "), user, F.lit(" ["), when_text, F.lit('] "'), request,
                    F.lit('" '), status, F.lit(" "), size)
    return events.select(line.alias("value"))


def claims_table(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per order, shaped like the claim-frequency table.

    ``ClaimNb`` = lines with return flag R (0 for orders without lines),
    ``Exposure`` = (lines + 1) / 8; categorical: order priority, order status,
    market segment; numeric: total price, account balance.
    """
    lines = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))
    cust = customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left") \
        .join(cust, orders.o_custkey == cust.c_custkey, "left")
    return joined.select(
        F.col("o_orderkey").alias("IDpol"),
        F.coalesce(F.col("n_returned"), F.lit(0)).cast("int").alias("ClaimNb"),
        ((F.coalesce(F.col("n_lines"), F.lit(0)) + 1) / 8.0).alias("Exposure"),
        "o_orderpriority", "o_orderstatus", "c_mktsegment", "o_totalprice", "c_acctbal")


def collision_features(embeddings: DataFrame, width: int | None = None) -> DataFrame:
    """Binary label plus one double column per embedding position.

    Features ``x0..x{width-1}`` hold the whole vector (``width`` is read from
    the table if not given; vectors of different lengths raise). ``label`` is
    1.0 when ``x0 + x1 + 4 x2 x3 > 0``, so it can be learnt, but not by a
    linear model alone.
    """
    short, long = embeddings.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    n = width if width is not None else long or 0
    if short != long or (long is not None and long != n):
        raise ValueError(f"vectors of {short} to {long} positions where all must have {n}")
    if n < 4:
        raise ValueError("the label needs vectors of at least 4 positions")
    cols = [F.get(F.col("embedding"), i).cast("double").alias(f"x{i}") for i in range(n)]
    x = [F.get(F.col("embedding"), i).cast("double") for i in range(4)]
    label = (x[0] + x[1] + F.lit(4.0) * x[2] * x[3] > 0).cast("double")
    return embeddings.select(F.col("vec_id"), label.alias("label"), *cols)


def ratings_table(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One rating per (user, item): user = customer, item = part (keys stay
    bigint; the factorisation re-indexes them densely to int).

    rating = mean of ``l_quantity / 10`` over the pair's lines (summed as whole
    quantities so every engine gets the same double); timestamp = the pair's
    latest order date as epoch seconds, computed without a session zone.
    """
    lines = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    ords = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    pairs = lines.join(ords, lines.l_orderkey == ords.o_orderkey) \
        .groupBy("o_custkey", "l_partkey").agg(
            F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"),
            F.max("o_orderdate").alias("last_date"))
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', last_date)")
    return pairs.select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.col("q") / (F.col("n") * 10.0)).alias("rating"),
        epoch.alias("timestamp"))


def movies_table(part: DataFrame) -> DataFrame:
    """Items with ``|``-joined tags: the two words of the name, then the type.

    Parts of size 45 or more carry their first name word twice, so counting
    rows and counting items per tag give different answers.
    """
    words = F.split(F.col("p_name"), " ")
    tags = F.when(F.col("p_size") >= 45,
                  F.concat(words, F.array(F.col("p_type")), F.slice(words, 1, 1))) \
        .otherwise(F.concat(words, F.array(F.col("p_type"))))
    return part.select(F.col("p_partkey").alias("movieId"),
                       F.col("p_name").alias("title"),
                       F.array_join(tags, "|").alias("genres"))


def segments_table(customer: DataFrame) -> DataFrame:
    """A deterministic user segmentation: the customer's market segment."""
    return customer.select(F.col("c_custkey").alias("id"),
                           F.col("c_mktsegment").alias("cluster"))
