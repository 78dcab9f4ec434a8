"""Adapters: the driver's tables seen as the four retail sources.

Each adapter is a lazy DataFrame over whole tables; the mapping is the one in
FIXTURES.md (Part 2). ``SOURCE_SQL`` holds the same mapping as SQL for the
DuckDB oracle, so every oracle query starts from the same raw tables.

Join strategy: the fact side (events, lineitem, documents) is joined to
dimension tables with plain left equi-joins and no hints: a fact without its
dimension stays, with nulls. Spark's size estimate
(``autoBroadcastJoinThreshold``) and AQE's runtime statistics decide whether a
side is small enough to broadcast; otherwise both sides are shuffled on the
join key. Small dimension pairs (customer + nation) are joined first so that
the big side meets a single, already combined dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.functions.money import int_div, money
from emporia.functions.rules import sentiment_from_rating
from emporia.sources.tables import read_table


def weblogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type",
                    "value", "props")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nat = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    geo = cust.join(nat, cust.c_nationkey == nat.n_nationkey, "left").select("c_custkey", "n_name")
    k = F.get_json_object("props", "$.k").try_cast("bigint") % 3
    return (
        ev.join(geo, ev.user_id == geo.c_custkey, "left")
        .select(
            F.col("event_id"),
            F.col("ts").alias("timestamp"),
            F.concat(F.col("user_id").cast("string"), F.lit("-"),
                     F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
            F.col("user_id").alias("customer_id"),
            F.concat(F.lit("/"), F.col("event_type")).alias("page"),
            F.when(k == 0, "desktop").when(k == 1, "mobile").when(k == 2, "tablet")
             .alias("device"),
            F.col("n_name").alias("country"),
            F.floor("value").cast("bigint").alias("duration_sec"),
        )
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity",
                    "l_extendedprice", "l_discount", "l_returnflag")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_orderdate", "o_orderpriority")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    status = (F.when(F.col("l_returnflag") == "R", "returned")
              .when(F.col("o_orderstatus") == "P", "cancelled")
              .when(F.col("o_orderstatus") == "F", "delivered")
              .when(F.col("o_orderstatus") == "O", "shipped"))
    return (
        li.join(o, li.l_orderkey == o.o_orderkey, "left")
        .join(p, li.l_partkey == p.p_partkey, "left")
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("timestamp"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            money("l_extendedprice").alias("total_amount"),
            F.round(F.col("l_discount") * 100).cast("bigint").alias("discount_pct"),
            F.col("o_orderpriority").alias("payment_method"),
            status.alias("status"),
        )
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", "doc_id", "n_chars")
    lb = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name")
    rating = (F.when(F.col("toxic") == 1, F.lit(1) + F.col("n_chars") % 2)
              .when(F.col("quality") == 1, F.lit(4) + F.col("n_chars") % 2)
              .when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), F.lit(3))).cast("bigint")
    joined = (d.join(lb, "doc_id", "left")
              .withColumn("product_id", F.col("doc_id") % 50)
              .join(p, F.col("product_id") == p.p_partkey, "left"))
    return joined.select(
        F.col("doc_id").alias("review_id"),
        int_div(F.col("doc_id"), F.lit(4)).alias("customer_id"),
        F.col("product_id"),
        F.col("p_name").alias("product_name"),
        rating.alias("rating"),
        sentiment_from_rating(rating).alias("sentiment"),
    )


def social(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    n = F.length("text").cast("bigint")
    s = n % 3
    words = F.split(F.col("text"), " ")
    return c.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("post_id"),
        F.when(F.col("conv_id") % 10 < 3, F.lit(None).cast("bigint"))
         .otherwise(F.col("conv_id")).alias("customer_id"),
        F.col("role").alias("platform"),
        F.transform(words, lambda w: F.concat(F.lit("#"), w)).alias("hashtags"),
        F.when(s == 0, "positive").when(s == 1, "neutral").when(s == 2, "negative")
         .alias("sentiment"),
        ((n * 37) % 10001).alias("likes"),
        ((n * 13) % 1001).alias("shares"),
        (F.col("turn") % 2 == 0).alias("brand_mention"),
    )


ADAPTERS = {
    "weblogs": weblogs,
    "transactions": transactions,
    "reviews": reviews,
    "social": social,
}


def load_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in ADAPTERS.items()}


# The same mapping in SQL, for the DuckDB oracle (tables are pre-registered views).
SOURCE_SQL = {
    "weblogs": """
  SELECT e.event_id, e.ts AS "timestamp",
         CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y-%m-%d') AS session_id,
         e.user_id AS customer_id,
         '/' || e.event_type AS page,
         CASE TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 3
              WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' WHEN 2 THEN 'tablet' END AS device,
         n.n_name AS country,
         CAST(floor(e.value) AS BIGINT) AS duration_sec
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "transactions": """
  SELECT l.l_orderkey AS order_id, o.o_orderdate AS "timestamp", o.o_custkey AS customer_id,
         l.l_partkey AS product_id, p.p_name AS product_name, p.p_type AS category,
         CAST(l.l_quantity AS BIGINT) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_amount,
         CAST(round(l.l_discount * 100) AS BIGINT) AS discount_pct,
         o.o_orderpriority AS payment_method,
         CASE WHEN l.l_returnflag = 'R' THEN 'returned'
              WHEN o.o_orderstatus = 'P' THEN 'cancelled'
              WHEN o.o_orderstatus = 'F' THEN 'delivered'
              WHEN o.o_orderstatus = 'O' THEN 'shipped' END AS status
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "reviews": """
  SELECT review_id, customer_id, product_id, product_name, rating,
         CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative'
              WHEN rating IS NOT NULL THEN 'neutral' END AS sentiment
  FROM (
    SELECT d.doc_id AS review_id, d.doc_id // 4 AS customer_id, d.doc_id % 50 AS product_id,
           p.p_name AS product_name,
           CAST(CASE WHEN lb.toxic = 1 THEN 1 + d.n_chars % 2
                     WHEN lb.quality = 1 THEN 4 + d.n_chars % 2
                     WHEN lb.quality IS NOT NULL OR lb.toxic IS NOT NULL THEN 3 END AS BIGINT) AS rating
    FROM documents d
    LEFT JOIN labels lb ON d.doc_id = lb.doc_id
    LEFT JOIN part p ON p.p_partkey = d.doc_id % 50
  ) r""",
    "social": """
  SELECT conv_id * 100 + turn AS post_id,
         CASE WHEN conv_id % 10 < 3 THEN NULL ELSE conv_id END AS customer_id,
         role AS platform,
         list_transform(string_split(text, ' '), lambda w: '#' || w) AS hashtags,
         CASE length(text) % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'neutral'
              WHEN 2 THEN 'negative' END AS sentiment,
         CAST((length(text) * 37) % 10001 AS BIGINT) AS likes,
         CAST((length(text) * 13) % 1001 AS BIGINT) AS shares,
         turn % 2 = 0 AS brand_mention
  FROM conversations""",
}


def with_sources(*names: str) -> str:
    """``WITH`` prefix defining the named sources as CTEs."""
    return "WITH " + ",\n".join(f"{n} AS ({SOURCE_SQL[n]}\n)" for n in names) + "\n"
