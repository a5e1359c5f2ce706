"""Loading test tables and pieces shared by several queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stable_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Rounding for comparison: exact ties go up whatever the order of a floating-point sum."""
    return df.selectExpr(*[
        f"round(`{n}` + 1e-7D, {digits}) as `{n}`" if t == "double" else f"`{n}`" for n, t in df.dtypes
    ])


def sql_stable(names: list[str]) -> str:
    return ", ".join(f"round({n} + 1e-7, 4) as {n}" for n in names)


# A landed feed with the usual dirt, derived from the values of every line item: missing keys,
# junk text in numbers and dates, zero line numbers, negative prices, and a slice sent twice.
RAW_LINES_SQL = """
raw_once as (
  select case when l_quantity = 7 and l_tax = 0.03 then null else l_orderkey end as l_orderkey,
         l_partkey, l_suppkey,
         case when l_quantity = 9 and l_tax = 0.05 then 0 else l_linenumber end as l_linenumber,
         case when l_quantity = 11 then null when l_quantity = 13 then 'n/a'
              else cast(l_quantity as varchar(20)) end as l_quantity,
         case when l_discount = 0.1 and l_tax = 0.08 then -l_extendedprice else l_extendedprice end
           as l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus,
         case when l_quantity = 19 then 'soon' when l_quantity = 21 then null
              else cast(cast(l_shipdate as date) as varchar(20)) end as l_shipdate
  from lineitem
),
raw_lines as (
  select * from raw_once
  union all
  select * from raw_once where l_returnflag = 'R' and l_linestatus = 'F'
)
"""


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty feed: the same text as in the check, run by Spark."""
    lines = table(spark, sf_dir, "lineitem")
    query = RAW_LINES_SQL.replace("from lineitem", "from {lineitem}")
    return spark.sql(f"with {query} select * from raw_lines", lineitem=lines)
