"""The registered queries of the llm operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheafline.llm import canonical, frequency, language, leakage, lookalikes, neardup, packing, residue, scannoise
from sheafline.session import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

QUERIES["p2_found"] = lambda spark, d: frequency.found(table(spark, d, "section_freq"))
SQL["p2_found"] = """
WITH l AS (
  SELECT run_id, normalized_title, arg_max(doc_count, (computed_at, doc_count)) AS doc_count, arg_max(raw_titles, (computed_at, doc_count)) AS raw_titles
  FROM section_freq GROUP BY ALL
), d AS (SELECT sum(t) AS docs FROM (SELECT run_id, arg_max(total_docs, computed_at) AS t FROM section_freq GROUP BY run_id)),
n AS (SELECT trim(normalized_title, ' ') AS title, sum(doc_count) AS n FROM l WHERE normalized_title IS NOT NULL GROUP BY 1),
e AS (SELECT unnest(map_entries(raw_titles)) AS e FROM l),
r AS (SELECT e.key AS title, sum(e.value) AS n FROM e GROUP BY 1)
SELECT * FROM (
  SELECT 'normalized_title' AS field, title, CASE WHEN n > 0.05 * docs THEN 'common' WHEN n <= 2 THEN 'rare' END AS mark FROM n, d
  UNION ALL
  SELECT 'raw_title', title, CASE WHEN n > 0.01 * (SELECT sum(n) FROM r) THEN 'common' WHEN n <= 1 THEN 'rare' END FROM r
) WHERE mark IS NOT NULL
"""

QUERIES["p7_found"] = lambda spark, d: canonical.found(
    table(spark, d, "sections"), table(spark, d, "section_columns_map"), table(spark, d, "canonical_titles")
)
SQL["p7_found"] = canonical.oracle_sql()

QUERIES["p6_found"] = lambda spark, d: lookalikes.found(table(spark, d, "text_lines"), table(spark, d, "sections"))

QUERIES["p9_found"] = lambda spark, d: leakage.found(table(spark, d, "documents"), table(spark, d, "eval_items"))
SQL["p9_found"] = leakage.oracle_sql()

QUERIES["p3_found"] = lambda spark, d: neardup.found(table(spark, d, "sections"))
SQL["p3_found"] = neardup.oracle_sql()
QUERIES["p3_groups"] = lambda spark, d: neardup.section_groups(table(spark, d, "sections"))
SQL["p3_groups"] = neardup.groups_sql()

QUERIES["p10_found"] = lambda spark, d: residue.found(table(spark, d, "documents"))

QUERIES["p5_found"] = lambda spark, d: language.found(table(spark, d, "sections"), table(spark, d, "canonical_titles"))
QUERIES["p5_segments"] = lambda spark, d: language.section_segments(table(spark, d, "sections"), table(spark, d, "canonical_titles"))

QUERIES["p4_found"] = lambda spark, d: scannoise.found(table(spark, d, "text_lines"), table(spark, d, "sections"), table(spark, d, "image_blocks"))

QUERIES["p4_paragraphs"] = lambda spark, d: scannoise.paragraphs(table(spark, d, "text_lines"), table(spark, d, "sections"), table(spark, d, "image_blocks"))

QUERIES["p8_containers"] = lambda spark, d: packing.containers(table(spark, d, "documents"), "doc_id", "text")
