"""Query registry and the shared SQL preambles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


PANEL = """
per_order AS (
  SELECT l_orderkey, count(*) AS n_lines,
         sum(CAST(l_quantity AS DECIMAL(18,4))) AS qty,
         sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS price,
         sum(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))) AS disc,
         sum(CAST(l_extendedprice * l_tax AS DECIMAL(18,4))) AS tax
  FROM lineitem GROUP BY l_orderkey),
panel AS (
  SELECT c_custkey AS player_id, CAST(year(o_orderdate) AS INTEGER) AS year,
         max(n_name) AS team, max(r_name) AS conf, max(c_mktsegment) AS type,
         count(*) AS gp, CAST(sum(n_lines) AS DOUBLE) AS blk,
         CAST(sum(qty) AS DOUBLE) AS mp, CAST(sum(price) AS DOUBLE) AS pts,
         CAST(sum(disc) AS DOUBLE) AS ast, CAST(sum(tax) AS DOUBLE) AS stl,
         CAST(CASE WHEN sum(CAST(o_totalprice AS DECIMAL(18,4))) > 900000 THEN 1 ELSE 0 END AS INTEGER) AS drafted
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
       LEFT JOIN per_order ON o_orderkey = l_orderkey
  GROUP BY c_custkey, year(o_orderdate))
"""

RAW_PANEL = PANEL + """,
raw0 AS (
  SELECT *,
    CASE (player_id*7+year)%10 WHEN 1 THEN '0' WHEN 2 THEN 'Fr' WHEN 3 THEN 'Fr' WHEN 4 THEN 'So'
      WHEN 5 THEN 'So' WHEN 6 THEN 'Jr' WHEN 7 THEN 'Jr' WHEN 8 THEN 'Sr' WHEN 9 THEN 'Sr' END AS yr,
    CASE WHEN player_id%12 = 1 THEN '-' WHEN player_id%12 = 2 THEN 'Jr' WHEN player_id%12 = 3 THEN '76'
      WHEN player_id%12 IN (4,5,6) THEN CAST(5+player_id%3 AS VARCHAR) || '''' || CAST(player_id%11 AS VARCHAR)
      WHEN player_id%12 IN (7,8) THEN 'Jun-0' || CAST(player_id%10 AS VARCHAR)
      WHEN player_id%12 = 9 THEN 'Jul-00'
      WHEN player_id%12 IN (10,11) THEN CAST(1+player_id%11 AS VARCHAR)
        || CASE WHEN player_id%2 = 0 THEN '-Jun' ELSE '-May' END END AS ht,
    CASE WHEN player_id%9 = 1 THEN '23B' WHEN player_id%9 = 2 THEN '--'
      WHEN player_id%9 > 2 THEN CAST(player_id%50 AS VARCHAR) END AS num,
    CASE WHEN drafted = 1 THEN CAST(1+player_id%60 AS DOUBLE) END AS pick,
    CASE WHEN player_id%10 < 3 THEN CAST(player_id%100 AS DOUBLE) END AS Rec_Rank,
    CASE WHEN (player_id+year)%3 <> 0 THEN CAST((player_id+year)%40 AS DOUBLE) END AS dunksmade,
    CASE WHEN (player_id+year)%5 = 0 THEN NULL WHEN (player_id+year)%7 = 0 THEN 0.0::DOUBLE
      ELSE CAST((player_id+year)%40 + player_id%6 AS DOUBLE) END AS dunksmiss_dunksmade,
    CASE WHEN (player_id*3+year)%8 = 0 THEN 0.0::DOUBLE
      ELSE CAST((player_id*3+year)%25 AS DOUBLE) END AS TO_per,
    CAST((player_id+year*3)%35 AS DOUBLE) AS AST_per
  FROM panel),
raw_panel AS (
  SELECT *, CASE WHEN player_id%2 = 0 AND dunksmiss_dunksmade > 0
    THEN dunksmade / dunksmiss_dunksmade END AS dunks_ratio FROM raw0)
"""

EMB = """
emb AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label,
         CAST(CASE WHEN label = 0 THEN 1 ELSE 0 END AS INTEGER) AS drafted FROM embeddings)
"""

# What counts as a number, for SQL text.
NUMBER = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"


def sql_hash(key: str, salt: int = 0) -> str:
    first = f"((({key}) % 2147483648) * {(1103515245 + salt * 362436) % 2147483648} + 12345) % 2147483648"
    return f"(((({first}) % 65536 * 32768 + ({first}) // 65536) * 1103515245 + 12345) % 2147483648)"


def unpivot_sql(columns: list[str], template: str, source: str) -> str:
    """One SELECT per column, glued by UNION ALL. {c} in the template is the column."""
    return " UNION ALL ".join(f"SELECT {template.replace('{c}', c)} FROM {source}" for c in columns)
