"""The registered queries of the core, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheafline.operators import inlining
from sheafline.plans import analysis
from sheafline.session import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = dict(analysis.QUERIES)
SQL: dict[str, str] = dict(analysis.SQL)

QUERIES["p1_found"] = lambda spark, d: inlining.found(table(spark, d, "raw_records"))
SQL["p1_found"] = """
WITH r AS (
  SELECT record_id, arg_max(payload, received_at)::JSON AS j FROM raw_records WHERE json_valid(payload) GROUP BY record_id
), d AS (SELECT record_id, CASE WHEN json_exists(j, '$.result') THEN json_extract(j, '$.result') ELSE j END AS j FROM r),
s AS (SELECT record_id, unnest(json_extract(j, '$.sections[*]')) AS s FROM d),
l AS (
  SELECT record_id, s ->> '$.section_id' AS parent_id,
         coalesce(nullif(json_extract(s, '$.text_items'), 'null'::JSON), json_extract(s, '$.items')) AS v FROM s
), n AS (
  SELECT record_id, parent_id, CASE WHEN json_type(v) = 'VARCHAR' THEN (v ->> '$')::JSON ELSE v END AS v FROM l
), w AS (
  SELECT record_id, parent_id,
         CASE WHEN json_type(v) = 'ARRAY' THEN json_extract(v, '$[*]') WHEN json_type(v) = 'OBJECT' THEN [v] ELSE [] END AS items FROM n
), i AS (
  SELECT record_id, parent_id, unnest(items) AS item, unnest(range(len(items))) AS item_no FROM w
), t AS (SELECT record_id, unnest(json_extract(j, '$.tables[*]')) AS t FROM d),
q AS (
  SELECT record_id, parent_id, item_no, json_extract(item, '$.rows[*]') AS rows FROM i
  UNION ALL SELECT record_id, t ->> '$.table_id', -1, json_extract(t, '$.rows[*]') FROM t
)
SELECT record_id, parent_id, item_no::INT AS item_no, -1 AS row_no FROM i
UNION ALL
SELECT record_id, parent_id, item_no::INT, unnest(range(len(rows)))::INT FROM q
"""

QUERIES["p1_readings"] = lambda spark, d: inlining.raw_record_readings(table(spark, d, "raw_records"))
SQL["p1_readings"] = """
WITH l AS (SELECT record_id, arg_max(payload, received_at) AS p FROM raw_records GROUP BY record_id)
SELECT record_id, CASE WHEN p IS NULL OR trim(p) = '' THEN 'empty' WHEN NOT json_valid(p) THEN 'not JSON' WHEN json_type(p) NOT IN ('OBJECT', 'ARRAY') THEN 'no object' END AS reason FROM l
"""

QUERIES["p1_relations"] = lambda spark, d: inlining.raw_record_relations(table(spark, d, "raw_records"))
