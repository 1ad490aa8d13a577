"""Raw notices derived from the star schema, for queries at any scale.

The view's text is plain enough to mean the same in several SQL dialects, so that the SQL twins start from it as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_SQL = """
    SELECT lpad(CAST(l_orderkey AS STRING), 14, '0') || lpad(CAST(l_linenumber AS STRING), 4, '0')
             || lpad(CAST(l_partkey AS STRING), 14, '0') || lpad(CAST(l_suppkey AS STRING), 12, '0') AS ord,
           CAST(l_orderkey AS BIGINT) AS filing,
           CASE l_linenumber % 7
             WHEN 0 THEN c_name || ' LAX 35' WHEN 1 THEN '  ' || c_name || ' San X ' WHEN 2 THEN c_name || '  (12)'
             WHEN 3 THEN c_name || ' &amp; Labs' WHEN 4 THEN c_name || '&rsquo;s&nbsp;Shop'
             WHEN 5 THEN 'Amazon - ' || c_name ELSE c_name END AS company,
           CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS notice_date,
           CASE l_partkey % 23 WHEN 0 THEN NULL WHEN 1 THEN 'TBD' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS effective_date,
           CASE l_partkey % 29
             WHEN 0 THEN 'n/a' WHEN 1 THEN '1,' || lpad(CAST(CAST(l_quantity AS INT) AS STRING), 3, '0') WHEN 2 THEN '0'
             WHEN 3 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.9'
             ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS employees,
           CASE n_nationkey % 6
             WHEN 0 THEN '' WHEN 1 THEN n_name || ' Parish' WHEN 2 THEN '  ' || n_name || ' County ' WHEN 3 THEN NULL
             ELSE n_name || ' County' END AS county,
           CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE r_name END AS city,
           CASE l_returnflag || l_linestatus
             WHEN 'AF' THEN 'Layoff Permanent' WHEN 'AO' THEN 'Layoff Temporary' WHEN 'NF' THEN 'Closure Permanent'
             WHEN 'NO' THEN 'Closure Temporary' WHEN 'RF' THEN '' ELSE NULL END AS layoff_type,
           CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) || ' Main St <' || CAST(l_partkey % 5 AS STRING) || '>' END AS address,
           CASE l_suppkey % 9
             WHEN 0 THEN 'Information and ' || c_mktsegment WHEN 1 THEN 'Health Care' WHEN 2 THEN 'Retail Trade' WHEN 3 THEN ''
             WHEN 4 THEN 'nan' WHEN 5 THEN '56 Administrative and Support and Waste Management Services'
             WHEN 6 THEN NULL WHEN 7 THEN 'Aerospace' ELSE '23 Construction' END AS industry
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
         JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""
TABLES = ("lineitem", "orders", "customer", "nation", "region")


#: Head of the joins in the text; Spark reads all that a filing tells about itself as one table beside the lines.
FROM = RAW_SQL.index("FROM {lineitem}")
LINES = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag", "l_linestatus")
FILINGS = ("o_orderkey", "o_orderdate", "c_name", "c_mktsegment", "n_nationkey", "n_name", "r_name")


def filings(tables: dict[str, DataFrame]) -> DataFrame:
    """Orders with their customer, nation and region."""
    lands = tables["nation"].join(F.broadcast(tables["region"]), F.col("n_regionkey") == F.col("r_regionkey"))
    orders = tables["orders"].join(tables["customer"], F.col("o_custkey") == F.col("c_custkey"))
    return orders.join(F.broadcast(lands), F.col("c_nationkey") == F.col("n_nationkey")).select(*FILINGS)


def raw_notices(spark: SparkSession, sf_dir: str, by: Column | None = None) -> DataFrame:
    """The rows of ``RAW_SQL``.

    Joined in the text's order, lines are shuffled for their orders and again, with them, for their customers.  Orders find their customers
    first here, so that lines, four for each order, are shuffled once, by the key that they join by.  With ``by``, an
    expression of lines and filings, rows are dealt by it before their texts are made, which are twice as long.
    """
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    if tables["lineitem"].rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:  # few splits would keep all later work in few tasks
        tables["lineitem"] = tables["lineitem"].select(*LINES).repartition("l_orderkey")
    if by is not None:
        dealt = tables["lineitem"].join(filings(tables), F.col("l_orderkey") == F.col("o_orderkey")).select(*LINES, *FILINGS).repartition(by)
        return spark.sql(RAW_SQL[:FROM] + "FROM {dealt}", dealt=dealt)
    text = RAW_SQL[:FROM] + "FROM {lineitem} JOIN {filings} ON l_orderkey = o_orderkey"
    return spark.sql(text, lineitem=tables["lineitem"], filings=filings(tables))
