"""The registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.plans.domain import Domain, domain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_FRAGMENTS: dict[str, tuple[str, tuple[str, ...]]] = {}


def fragment(name: str, sql: str, *needs: str) -> None:
    """A named common table expression for the check SQL."""
    _FRAGMENTS[name] = (sql.strip(), needs)


def with_fragments(select: str, needs: tuple[str, ...]) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for need in _FRAGMENTS[name][1]:
            add(need)
        order.append(name)

    for name in needs:
        add(name)
    head = ",\n".join(f"{name} AS ({_FRAGMENTS[name][0]})" for name in order)
    return f"WITH {head}\n{select.strip()}" if order else select.strip()


def query(name: str, sql: str | None = None, needs: tuple[str, ...] | str = ()):
    """Register a query on a Domain; without SQL it is checked by tests on small fixtures."""

    def register(build: Callable[[Domain], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(domain(spark, folder))
        if sql is not None:
            ORACLES[name] = with_fragments(sql, (needs,) if isinstance(needs, str) else tuple(needs))
        return build

    return register


def r6(column: str | Column, alias: str | None = None) -> Column:
    """Six decimals, the precision both engines are compared at."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, 6).alias(alias or column)


def big(column: str | Column, alias: str | None = None) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("long").alias(alias or column)


fragment("genes", """
SELECT o_orderkey AS key, 'g' || o_orderkey AS gene, 'HOG' || (o_orderkey // 20) AS hog,
       replace(r_name, ' ', '_') AS species, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""")
fragment("hog_genes", "SELECT hog, species, gene FROM genes WHERE priority <> '4-NOT SPECIFIED'", "genes")
fragment("de", """
SELECT species, gene, price AS "baseMean", (CAST(round(price) AS BIGINT) % 801 - 400) / 100 AS "log2FoldChange",
       (CAST(round(price * 100) AS BIGINT) % 100000) / 100000 AS pvalue,
       CASE WHEN status <> 'P' THEN (CAST(round(price * 100) AS BIGINT) % 1000) / 1000 END AS padj
FROM genes WHERE species <> 'MIDDLE_EAST'""", "genes")
fragment("family", """
SELECT 'HOG' || (o_orderkey // 20) AS hog, count(*) FILTER (o_orderstatus = 'F') / count(*) AS pvalue
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1""")
fragment("hits", """
SELECT 'q' || l_orderkey AS qseqid, 'q' || (l_partkey * 7 + l_linenumber) AS sseqid, l_quantity + 50 AS pident,
       l_discount * 1e-2 AS evalue, l_extendedprice / 100 AS bitscore FROM lineitem
UNION ALL
SELECT 'q' || o_orderkey, 'q' || o_orderkey, 100.0, 0.0, o_totalprice FROM orders""")
fragment("id_map", """
SELECT 'q' || o_orderkey AS seqid, 'g' || o_orderkey AS name FROM orders
WHERE o_orderpriority <> '5-LOW' OR o_orderstatus <> 'P'""")
fragment("annotation", """
SELECT species, gene, coalesce(terms, 'NA') AS terms FROM genes LEFT JOIN (
  SELECT l_orderkey, string_agg(term, ', ' ORDER BY term) AS terms FROM (
    SELECT DISTINCT l_orderkey, CASE WHEN l_discount = 0 THEN 'NA' ELSE p_brand END AS term
    FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1) ON l_orderkey = key""", "genes")
fragment("counts", """
SELECT 'p' || l_partkey AS gene, l_returnflag || '_' || l_linestatus AS sample,
       CAST(sum(l_quantity) AS BIGINT) AS count FROM lineitem GROUP BY 1, 2""")
fragment("sequences", """
SELECT source AS file, doc_id AS ord, doc_id || CASE lang WHEN 'fr' THEN '' WHEN 'de' THEN ' gene:' || source || '.de locus:x'
       ELSE ' gene:' || source || '.' || lang END AS header,
       CASE WHEN lang IN ('fr', 'de') THEN NULL ELSE source || '.' || lang END AS gene, text AS sequence FROM documents""")
