"""The input tables as views over the TPC-H-like test tables.

Each view is one SELECT that both Spark and DuckDB run; `{orders}` and the like
stand for the test tables.
"""

from pyspark.sql import DataFrame, SparkSession

SOURCE_NAME = "DELINQUENCY"

VIEWS: dict[str, str] = {
    "load_batches": """
        SELECT o_orderkey AS batch_id,
               o_custkey % 100 AS entity_id,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL
                    ELSE last_day(CAST(o_orderdate AS DATE)) END AS period_date,
               CASE WHEN o_orderstatus = 'P'
                    THEN CAST(o_orderdate AS DATE) END AS cancelled_at,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
                    THEN 8 ELSE 3 END AS source_type,
               concat('load_',
                      lpad(CAST((o_orderkey * 7919) % 100000 AS STRING), 5, '0'),
                      '.csv') AS file_name
          FROM {orders}""",
    "general_balances": """
        SELECT l_orderkey AS batch_id,
               l_partkey AS person_id,
               l_suppkey AS balance_id,
               last_day(CAST(l_shipdate AS DATE)) AS period_date
          FROM {lineitem}""",
    "microfinance_balances": """
        SELECT l.l_partkey AS person_id,
               l.l_suppkey AS balance_id,
               o.o_custkey % 100 AS entity_id
          FROM {lineitem} l
          JOIN {orders} o ON o.o_orderkey = l.l_orderkey
         WHERE l.l_linenumber <= 4""",
    "entity_sources": """
        SELECT c_custkey % 100 AS entity_id,
               concat('ENT-', CAST(c_custkey % 100 AS STRING),
                      CASE WHEN c_acctbal < 5000 THEN '-A' ELSE '-B' END)
                   AS description,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS status
          FROM {customer}""",
    "source_codes": """
        SELECT * FROM (VALUES ('DELINQUENCY', 8)) AS listed(name, code)""",
    # Codes and names of the priorities that the orders have.
    "priority_codes": """
        SELECT DISTINCT substring(o_orderpriority, 3) AS name,
               CAST(substring(o_orderpriority, 1, 1) AS INT) AS code
          FROM {orders}""",
}

_TEST_TABLES = ("orders", "lineitem", "customer")


def read_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view over the Parquet files in `sf_dir`."""
    text = VIEWS[name]
    tables = {
        table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
        for table in _TEST_TABLES
        if f"{{{table}}}" in text
    }
    return spark.sql(text, **tables)


def with_views(query: str) -> str:
    """`query` for DuckDB, with the views it names put in front as CTEs."""
    tables = {name: name for name in _TEST_TABLES}
    parts = [
        f"{view} AS ({text.format(**tables)})"
        for view, text in VIEWS.items()
        if view in query
    ]
    return f"WITH {', '.join(parts)}\n{query}"
