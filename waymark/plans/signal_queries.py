"""q01 to q04: attention signals. Items are customers, countries nations, classes market segments, sources suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.attention import attention_scores, frequent_classes, mass_classes, source_rates, top_share
from ..runtime import table

MASS = 10
SHARE = 0.03


def _items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("item"), F.col("c_nationkey").alias("country"), F.col("c_mktsegment").alias("class"))


def _profile(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("item"))
    lines = table(spark, d, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("source"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("item", "source").distinct()


def q01_attention_signal(spark: SparkSession, d: str) -> DataFrame:
    s = attention_scores(_items(spark, d), _profile(spark, d), MASS)
    return s.select("item", "country", "class", "d", F.round("pct", 4).alias("pct"), top_share(F.col("pct"), SHARE).alias("admitted"))


def q02_mass_classes(spark: SparkSession, d: str) -> DataFrame:
    return mass_classes(_items(spark, d), MASS)


def q03_source_rates(spark: SparkSession, d: str) -> DataFrame:
    rows = _profile(spark, d).join(_items(spark, d).select("item", "class"), "item")
    return source_rates(rows, "class").select("class", "source", F.round("rate", 6).alias("rate"))


def q04_frequent_sources(spark: SparkSession, d: str) -> DataFrame:
    return frequent_classes(_profile(spark, d).select("item", F.col("source").alias("class")), 20)


QUERIES = {f.__name__: f for f in (q01_attention_signal, q02_mass_classes, q03_source_rates, q04_frequent_sources)}

_PROFILE = "profile AS (SELECT DISTINCT o_custkey item, l_suppkey source FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"

SQL = {
    "q01_attention_signal": f"""
        WITH {_PROFILE},
        mass AS (SELECT c_nationkey country, c_mktsegment class FROM customer GROUP BY ALL HAVING count(DISTINCT c_custkey) >= {MASS}),
        item AS (SELECT c_custkey item, c_nationkey country, m.class FROM customer LEFT JOIN mass m ON m.country = c_nationkey AND m.class = c_mktsegment),
        p AS (SELECT profile.*, item.country, item.class FROM profile JOIN item USING (item)),
        rc AS (SELECT class, source, count(*)::DOUBLE / any_value(n) rate FROM p JOIN (SELECT class, count(DISTINCT item) n FROM p GROUP BY 1) USING (class) GROUP BY ALL),
        rp AS (SELECT source, count(*)::DOUBLE / (SELECT count(DISTINCT item) FROM p) rate FROM p GROUP BY 1),
        s AS (SELECT p.item, p.country, p.class, round(sum(1 - CASE WHEN p.class IS NULL THEN rp.rate ELSE rc.rate END), 6) d
              FROM p LEFT JOIN rc ON rc.class = p.class AND rc.source = p.source LEFT JOIN rp ON rp.source = p.source GROUP BY ALL),
        w AS (SELECT *, CASE WHEN class IS NOT NULL THEN 100.0::DOUBLE * (2 * (rank() OVER (PARTITION BY country, class ORDER BY d) - 1) + count(*) OVER (PARTITION BY country, class, d))
                     / (2 * count(*) OVER (PARTITION BY country, class)) END pct FROM s)
        SELECT item, country, class, d, round(pct, 4) pct, pct >= {100.0 * (1 - SHARE)} admitted FROM w""",
    "q02_mass_classes": f"SELECT c_nationkey country, c_mktsegment class, count(DISTINCT c_custkey) members FROM customer GROUP BY ALL HAVING members >= {MASS}",
    "q03_source_rates": f"""
        WITH {_PROFILE}, p AS (SELECT c_mktsegment class, item, source FROM profile JOIN customer ON c_custkey = item)
        SELECT class, source, round(count(*)::DOUBLE / any_value(n), 6) rate FROM p JOIN (SELECT class, count(DISTINCT item) n FROM p GROUP BY 1) USING (class) GROUP BY ALL""",
    "q04_frequent_sources": f"WITH {_PROFILE} SELECT source AS class, count(*) items FROM profile GROUP BY 1 ORDER BY items DESC, class LIMIT 20",
}
