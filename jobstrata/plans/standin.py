"""Stand-in postings: the 22 raw string columns shaped from an order star schema.

One posting per line item. The view carries padded text, nulls, malformed numbers, three
flag spellings, embedded commas and scores exactly on the risk cuts. It only shapes input
data; the same text serves Spark and the independent SQL check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("lineitem", "orders", "customer", "nation", "region", "supplier", "part")

POSTINGS_SQL = """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING), '-',
              CAST(l_linenumber AS STRING)) AS job_id,
       CASE WHEN l_partkey % 89 = 0 THEN 'unknown'
            WHEN l_partkey % 83 = 0 THEN concat(CAST(year(o_orderdate) AS STRING), '.7')
            ELSE CAST(year(o_orderdate) AS STRING) END AS posting_year,
       CASE WHEN l_partkey % 79 = 0 THEN NULL
            ELSE concat(' ', lower(n_name), ' ') END AS country,
       lower(r_name) AS region,
       concat('city_', CAST(c_custkey % 7 AS STRING)) AS city,
       s_name AS company_name,
       CASE WHEN s_acctbal < 2000 THEN 'Small' WHEN s_acctbal < 6000 THEN 'Medium'
            ELSE 'Large' END AS company_size,
       lower(c_mktsegment) AS industry,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE p_name END AS job_title,
       lower(o_orderpriority) AS seniority_level,
       CASE WHEN l_linenumber = 5 THEN NULL WHEN l_returnflag = 'R' THEN 'True'
            WHEN l_returnflag = 'A' THEN 'true' ELSE 'False' END AS ai_mentioned,
       concat(p_brand, ',', p_type) AS ai_keywords,
       CAST(l_discount * 10 AS STRING) AS ai_intensity_score,
       p_type AS core_skills,
       p_brand AS ai_skills,
       CASE WHEN l_linenumber = 7 THEN 'N/A'
            ELSE CAST(l_extendedprice AS STRING) END AS salary_usd,
       CAST(l_linenumber AS STRING) AS salary_change_vs_prev_year_percent,
       CASE WHEN l_partkey % 97 = 0 THEN NULL
            ELSE CAST(l_quantity / 50 AS STRING) END AS automation_risk_score,
       CASE WHEN l_linestatus = 'O' THEN '1' ELSE 'False' END AS reskilling_required,
       CAST(l_tax * 10 AS STRING) AS ai_job_displacement_risk,
       CAST(l_suppkey % 20 AS STRING) AS job_description_embedding_cluster,
       CASE WHEN l_linestatus = 'O' THEN 'Emerging' ELSE 'Mature' END AS industry_ai_adoption_stage
FROM {lineitem} AS lineitem
JOIN {orders} AS orders ON l_orderkey = o_orderkey
JOIN {customer} AS customer ON o_custkey = c_custkey
JOIN {nation} AS nation ON c_nationkey = n_nationkey
JOIN {region} AS region ON n_regionkey = r_regionkey
JOIN {supplier} AS supplier ON l_suppkey = s_suppkey
JOIN {part} AS part ON l_partkey = p_partkey
"""


def _joined(tables: dict[str, DataFrame]) -> DataFrame:
    """The joins of the text in an order that shuffles the line items twice and with few columns:
    for the customers the orders are shuffled, which are fewer, and names of suppliers, nations
    and regions, small tables, come last."""
    orders = tables["orders"].join(tables["customer"], F.expr("o_custkey = c_custkey"))
    return (
        tables["lineitem"]
        .join(orders, F.expr("l_orderkey = o_orderkey"))
        .join(tables["part"], F.expr("l_partkey = p_partkey"))
        .join(tables["supplier"], F.expr("l_suppkey = s_suppkey"))
        .join(tables["nation"], F.expr("c_nationkey = n_nationkey"))
        .join(tables["region"], F.expr("n_regionkey = r_regionkey"))
    )


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in as a DataFrame. Join strategies are left to Spark's own size checks."""
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
    columns = POSTINGS_SQL[: POSTINGS_SQL.index("FROM {lineitem}")]
    return spark.sql(columns + "FROM {joined}", joined=_joined(tables))


def posting_bound(spark: SparkSession, sf_dir: str) -> int:
    """Upper bound of the stand-in's rows from Parquet footers: a posting is one line item,
    joined to primary keys only."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def postings_sql() -> str:
    """The stand-in as text over tables that are registered under their own names."""
    return POSTINGS_SQL.format(**{name: name for name in TABLES})
