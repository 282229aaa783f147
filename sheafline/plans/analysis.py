"""Queries of the document analysis over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from sheafline import config as C
from sheafline.functions import text as X
from sheafline.operators import contents, corpus, hints, lines as L, matrix, sections as S, tables as TB
from sheafline.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Titles that the matrix queries take as columns and as a map.
COLUMNS = ["safety", "installation", "maintenance", "technical_data", "warranty", "additional_content"]
TITLE_MAP = {"safety instructions": "safety", "cleaning and care": "maintenance", "technical data": "technical_data", "warranty terms": "warranty"}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return register


def lines_of(spark: SparkSession, d: str) -> DataFrame:
    return L.latest_lines(table(spark, d, "text_lines"))


def sections_of(spark: SparkSession, d: str) -> DataFrame:
    """The latest row of each section, with the number in its id."""
    s = table(spark, d, "sections")
    one = s.groupBy("section_uid").agg(F.max_by(F.struct(*[c for c in s.columns if c != "section_uid"]), F.struct("ingested_at", "extracted_at")).alias("s"))
    return one.select("section_uid", "s.*").withColumn("section_no", F.regexp_extract("section_id", "[0-9]+", 0).try_cast("int"))


def _one_each(df: DataFrame, uid: str) -> DataFrame:
    """One row per id, by the greatest of its other columns: redeliveries of tables and images carry no time."""
    rest = [c for c in df.columns if c != uid]
    return df.groupBy(uid).agg(F.max(F.struct(*rest)).alias("x")).select(uid, "x.*")


def tables_of(spark: SparkSession, d: str) -> DataFrame:
    return _one_each(table(spark, d, "table_blocks"), "table_uid")


def images_of(spark: SparkSession, d: str) -> DataFrame:
    return _one_each(table(spark, d, "image_blocks"), "image_uid")


def cell_lines(spark: SparkSession, d: str) -> DataFrame:
    """The cells of every table as lines of a page of its own: rows 20 below each other, columns 90 apart and a little askew."""
    t = tables_of(spark, d).select("table_uid", F.posexplode(F.concat(F.array("columns"), F.coalesce("rows", F.array().cast("array<array<string>>")))).alias("r", "cells"))
    cells = t.select("table_uid", "r", F.posexplode("cells").alias("k", "t")).where("btrim(t) <> ''")
    number = F.row_number().over(W.partitionBy("table_uid").orderBy("r", "k")) - 1
    x0, y0 = (F.lit(72) + 90 * F.col("k") + 2 * (F.col("r") % 3)).cast("double"), (20 * F.col("r")).cast("double")
    return cells.select(
        F.col("table_uid").cast("string").alias("doc_id"), F.lit(0).alias("page"), number.cast("int").alias("line_no"), F.btrim("t").alias("text"),
        x0.alias("x0"), y0.alias("y0"), (x0 + 80).alias("x1"), (y0 + 10).alias("y1"), F.lit(0).alias("column_id"),
    )


_SPACES = X.SPACES
LINES = "l AS (SELECT * FROM text_lines QUALIFY row_number() OVER (PARTITION BY doc_id, page, line_no ORDER BY ingested_at DESC, line_uid, text) = 1)"
SECTIONS = (
    "s AS (SELECT *, TRY_CAST(regexp_extract(section_id, '[0-9]+') AS INT) AS section_no FROM sections "
    "QUALIFY row_number() OVER (PARTITION BY section_uid ORDER BY ingested_at DESC, extracted_at DESC) = 1)"
)
TABLES = "t AS (SELECT * FROM table_blocks QUALIFY row_number() OVER (PARTITION BY table_uid ORDER BY doc_id DESC NULLS LAST, table_id DESC NULLS LAST, page DESC NULLS LAST, x0 DESC NULLS LAST, y0 DESC NULLS LAST, x1 DESC NULLS LAST, y1 DESC NULLS LAST, section_title_guess DESC NULLS LAST) = 1)"
IMAGES = "i AS (SELECT * FROM image_blocks QUALIFY row_number() OVER (PARTITION BY image_uid ORDER BY doc_id DESC NULLS LAST, image_id DESC NULLS LAST, page DESC NULLS LAST, x0 DESC NULLS LAST, y0 DESC NULLS LAST, x1 DESC NULLS LAST, y1 DESC NULLS LAST, width DESC NULLS LAST, height DESC NULLS LAST, path DESC NULLS LAST, ocr_text DESC NULLS LAST) = 1)"
ROWS = (
    "r0 AS (SELECT *, CASE WHEN abs(y0 - lag(y0) OVER w) <= 10 THEN 0 ELSE 1 END AS fresh FROM l WINDOW w AS (PARTITION BY doc_id, page, column_id ORDER BY y0, x0, line_no)), "
    "r AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, page, column_id ORDER BY y0, x0, line_no ROWS UNBOUNDED PRECEDING) AS row_no FROM r0)"
)


def _words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, '{_SPACES}'), lambda w: w <> ''))"


def _clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_SPACES}', ' ', 'g'))"


def _normal(x: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(lower({x}), '^{_SPACES}|{_SPACES}$', '', 'g'), '[:\\-_/]+', ' ', 'g'), '{_SPACES}', ' ', 'g')"


def _form(x: str) -> str:
    return _normal(f"translate(regexp_replace(coalesce({x}, ''), '[\\x{{300}}-\\x{{36F}}]', '', 'g'), '{X.ACCENTED}', '{X.PLAIN}')")


def _list(items) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


FLAGS = (
    f"f AS (SELECT doc_id, page, column_id, row_no, min(y0) AS top, min(x0) AS l0, count(*) AS cells, count(*) FILTER ({_words('text')} <= 8) AS short_cells FROM r GROUP BY ALL), "
    "g AS (SELECT *, cells >= 2 AND short_cells >= 2 AS flag, row_number() OVER (PARTITION BY doc_id, page ORDER BY top, l0, column_id, row_no) AS pos FROM f), "
    "h AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY pos) - row_number() OVER (PARTITION BY doc_id, page, flag ORDER BY pos) AS run FROM g), "
    "k AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page, flag, run) AS streak FROM h)"
)


@query("text_functions", f"WITH {SECTIONS} SELECT section_uid, {_clean('raw_title')} AS clean, {_normal('raw_title')} AS normal, {_form('raw_title')} AS form, CAST({_words('raw_title')} AS INT) AS n_words, substr({_clean('text_plain')}, 1, 320) AS head FROM s WHERE raw_title IS NOT NULL AND text_plain IS NOT NULL")
def text_functions(spark, d):
    x = sections_of(spark, d).where("raw_title is not null and text_plain is not null")
    t = F.col("raw_title")
    return x.select(
        "section_uid", X.clean_text(t).alias("clean"), X.normalize_title(t).alias("normal"), X.match_form(t).alias("form"),
        X.word_count(t).alias("n_words"), X.snippet(F.col("text_plain")).alias("head"),
    )


@query("upper_lines", f"WITH {LINES} SELECT doc_id, page, line_no FROM l WHERE length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) > 0 AND length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) > 0.8 * length(regexp_replace(text, '[^\\p{{L}}]', '', 'g'))")
def upper_lines(spark, d):
    return lines_of(spark, d).where(X.is_upper(F.col("text"))).select("doc_id", "page", "line_no")


_BARE = f"trim(regexp_replace(stem, '{C.FILENAME_NOISE}', ''))"


@query("product_codes", f"""WITH d AS (SELECT DISTINCT doc_id, file_name FROM documents_meta WHERE file_name IS NOT NULL),
  e AS (SELECT doc_id, file_name, regexp_replace(file_name, '\\.[^.]*$', '') AS stem FROM d),
  c AS (SELECT *, {_BARE} AS bare, regexp_extract_all({_BARE}, '{C.PRODUCT_CODE}', 1) AS c FROM e),
  u AS (SELECT *, list_filter(c, lambda x, i: list_position(c, x) = i) AS codes FROM c)
SELECT doc_id, file_name, stem, CASE WHEN len(codes) BETWEEN 1 AND 3 THEN array_to_string(codes, ' | ') END AS code,
  CASE WHEN len(codes) BETWEEN 1 AND 3 THEN nullif(trim(regexp_replace(bare, '{C.PRODUCT_CODE}', '', 'g'), ' -_'), '') END AS product_name FROM u""")
def product_codes(spark, d):
    x = table(spark, d, "documents_meta").select("doc_id", "file_name").where("file_name is not null").distinct()
    stem = X.file_stem(F.col("file_name"))
    return x.select("doc_id", "file_name", stem.alias("stem"), X.product_codes(stem).alias("code"), X.product_name(stem).alias("product_name"))


@query("visual_rows", f"WITH {LINES}, {ROWS} SELECT doc_id, page, line_no, CAST(row_no AS BIGINT) AS row_no FROM r")
def visual_rows(spark, d):
    return L.visual_rows(lines_of(spark, d)).select("doc_id", "page", "line_no", F.col("row_no").cast("bigint").alias("row_no"))


CELLS = f"""{TABLES}, ca AS (SELECT table_uid, list_concat([columns], coalesce(rows, [])) AS rs FROM t), cb AS (SELECT table_uid, unnest(rs) AS cells, generate_subscripts(rs, 1) - 1 AS r FROM ca),
  cc AS (SELECT table_uid, r, unnest(cells) AS t, generate_subscripts(cells, 1) - 1 AS k FROM cb),
  l AS (SELECT CAST(table_uid AS VARCHAR) AS doc_id, 0 AS page, CAST(row_number() OVER (PARTITION BY table_uid ORDER BY r, k) - 1 AS INT) AS line_no, trim(t) AS text, CAST(72 + 90 * k + 2 * (r % 3) AS DOUBLE) AS x0, CAST(20 * r AS DOUBLE) AS y0,
    CAST(152 + 90 * k + 2 * (r % 3) AS DOUBLE) AS x1, CAST(20 * r + 10 AS DOUBLE) AS y1, 0 AS column_id FROM cc WHERE trim(t) <> '')"""


@query("anchored_rows", f"""WITH RECURSIVE {LINES}, s AS (SELECT doc_id, page, line_no, y0, row_number() OVER (PARTITION BY doc_id, page ORDER BY round(y0, 1) NULLS FIRST, round(x0, 1) NULLS FIRST, line_no) AS n FROM l),
  a AS (SELECT doc_id, page, line_no, n, y0 AS first, 1 AS row_no FROM s WHERE n = 1
    UNION ALL SELECT s.doc_id, s.page, s.line_no, s.n, CASE WHEN coalesce(abs(s.y0 - a.first) <= 3, false) THEN a.first ELSE s.y0 END, a.row_no + CASE WHEN coalesce(abs(s.y0 - a.first) <= 3, false) THEN 0 ELSE 1 END
    FROM a JOIN s ON s.doc_id = a.doc_id AND s.page = a.page AND s.n = a.n + 1)
SELECT doc_id, page, CAST(row_no AS INT) AS row_no, CAST(line_no AS INT) AS line_no FROM a""")
def anchored_rows(spark, d):
    return L.anchored_rows(lines_of(spark, d))


@query("table_islands", f"WITH {CELLS}, {ROWS}, {FLAGS} SELECT doc_id, page, pos, flag, streak, flag AND streak >= 4 AS table_like FROM k")
def table_islands(spark, d):
    return L.row_islands(L.row_flags(cell_lines(spark, d))).select("doc_id", "page", F.col("pos").cast("bigint").alias("pos"), "flag", "streak", "table_like")


@query("table_like_lines", f"WITH {CELLS}, {ROWS}, {FLAGS} SELECT r.doc_id, r.page, r.line_no FROM r JOIN k USING (doc_id, page, column_id, row_no) WHERE k.flag AND k.streak >= 4")
def table_like_lines(spark, d):
    return L.mark_table_like(cell_lines(spark, d)).where("is_table_like").select("doc_id", "page", "line_no")


SPLITS = (
    "q AS (SELECT *, count(*) FILTER (NOT coalesce(is_table_like, false)) OVER (PARTITION BY doc_id, page) AS prose FROM l), "
    "a AS (SELECT * FROM q WHERE prose < 6 OR NOT coalesce(is_table_like, false)), "
    "p AS (SELECT doc_id, page, max(x1) AS width FROM l GROUP BY ALL), "
    "x AS (SELECT DISTINCT doc_id, page, round_even(x0, 0) AS x FROM a WHERE x0 IS NOT NULL), "
    "y AS (SELECT *, lead(x) OVER (PARTITION BY doc_id, page ORDER BY x) AS nxt, count(*) OVER (PARTITION BY doc_id, page) AS edges FROM x), "
    "z AS (SELECT * FROM y JOIN p USING (doc_id, page) WHERE edges >= 3 AND nxt - x >= width * 0.08 QUALIFY row_number() OVER (PARTITION BY doc_id, page ORDER BY nxt - x DESC, x) < 3), "
    "v AS (SELECT doc_id, page, list_sort(list((x + nxt) / 2)) AS splits FROM z GROUP BY ALL)"
)


@query("split_points", f"WITH {LINES}, {SPLITS} SELECT doc_id, page, CAST(splits[1] AS DOUBLE) AS first_split, CAST(len(splits) AS INT) AS n_splits FROM v")
def split_points(spark, d):
    return L.split_points(lines_of(spark, d)).select("doc_id", "page", F.element_at("splits", 1).alias("first_split"), F.size("splits").alias("n_splits"))


@query("column_layout", f"""WITH {LINES}, {SPLITS}, b AS (SELECT q.*, splits, width, prose < 6 OR NOT coalesce(is_table_like, false) AS anchor,
    len(list_filter(splits, lambda s: x0 >= s)) AS both_id, CASE WHEN x0 >= splits[1] THEN 1 ELSE 0 END AS one_id FROM q JOIN p USING (doc_id, page) LEFT JOIN v USING (doc_id, page)),
  n AS (SELECT *, count(*) FILTER (anchor) OVER w AS total, count(*) FILTER (anchor AND both_id = 0) OVER w AS b0, count(*) FILTER (anchor AND both_id = 1) OVER w AS b1,
    count(*) FILTER (anchor AND both_id = 2) OVER w AS b2, count(*) FILTER (anchor AND one_id = 0) OVER w AS o0, count(*) FILTER (anchor AND one_id = 1) OVER w AS o1
    FROM b WINDOW w AS (PARTITION BY doc_id, page)),
  c AS (SELECT *, CASE WHEN splits IS NULL THEN NULL WHEN len(splits) = 2 AND least(b0, b1, b2) >= 0.1 * total THEN splits WHEN least(o0, o1) >= 0.1 * total THEN splits[1:1] END AS active FROM n),
  e AS (SELECT *, list_concat([0.0], active, [width]) AS bounds FROM c),
  m AS (SELECT *, list_transform(range(1, len(bounds)), lambda i: abs(x0 - (bounds[i] + bounds[i + 1]) / 2)) AS far FROM e)
SELECT doc_id, page, line_no, CAST(CASE WHEN active IS NULL THEN 0 WHEN coalesce(is_table_like, false) THEN list_position(far, list_min(far)) - 1 ELSE len(list_filter(active, lambda s: x0 >= s)) END AS INT) AS column_id FROM m""")
def column_layout(spark, d):
    return L.detect_columns(lines_of(spark, d)).select("doc_id", "page", "line_no", "column_id")


BODY = (
    "bs AS (SELECT doc_id, page, arg_max(v, (n, -first)) AS body_size FROM (SELECT doc_id, page, round(font_size_avg, 1) AS v, count(*) AS n, min(line_no) AS first FROM l WHERE font_size_avg > 0 GROUP BY ALL) GROUP BY ALL), "
    "bp AS (SELECT doc_id, page, arg_max(v, (n, -first)) AS plain FROM (SELECT doc_id, page, font_name AS v, count(*) AS n, min(line_no) AS first FROM l WHERE coalesce(font_name, '') <> '' AND NOT coalesce(is_bold, false) GROUP BY ALL) GROUP BY ALL), "
    "ba AS (SELECT doc_id, page, arg_max(v, (n, -first)) AS anyf FROM (SELECT doc_id, page, font_name AS v, count(*) AS n, min(line_no) AS first FROM l WHERE coalesce(font_name, '') <> '' GROUP BY ALL) GROUP BY ALL), "
    "bf AS (SELECT doc_id, page, coalesce(body_size, 0) AS body_size, coalesce(plain, anyf, '') AS body_font FROM (SELECT DISTINCT doc_id, page FROM l) LEFT JOIN bs USING (doc_id, page) LEFT JOIN bp USING (doc_id, page) LEFT JOIN ba USING (doc_id, page))"
)


@query("body_font", f"WITH {LINES}, {BODY} SELECT doc_id, page, CAST(body_size AS DOUBLE) AS body_size, body_font FROM bf")
def body_font(spark, d):
    return L.body_font(lines_of(spark, d))


@query("bbox_union", f"WITH {LINES} SELECT doc_id, page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, list_sort(list(x0))[CAST(floor(count(*) / 2) AS INT) + 1] AS mid_x FROM l GROUP BY ALL")
def bbox_union(spark, d):
    return lines_of(spark, d).groupBy("doc_id", "page").agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), L.upper_median().alias("mid_x")
    )


INDEX = (
    f"ix AS (SELECT doc_id, page, avg(CASE WHEN regexp_matches(text, '{C.INDEX_LINE}') OR toc_page_number IS NOT NULL THEN 1 ELSE 0 END) >= 0.35 AS is_index FROM l GROUP BY ALL)"
)
_T = f"regexp_replace(coalesce(text, ''), '^{_SPACES}|{_SPACES}$', '', 'g')"
SCORE = f"""sc AS (SELECT *, {_T} AS t, coalesce(is_bold, false) AS bold, coalesce(is_upper, false) AS up, coalesce(font_size_avg > body_size + 0.5, false) AS larger,
    {_words('text')} AS n, coalesce(table_count, 0) AS table_count FROM l JOIN bf USING (doc_id, page) JOIN ix USING (doc_id, page) LEFT JOIN (SELECT doc_id, page, count(*) AS table_count FROM t GROUP BY ALL) USING (doc_id, page)),
  sd AS (SELECT *, regexp_matches(t, '{C.NUMBERED}') AS numbered, regexp_matches(t, '{C.HEADER_SHAPES[0]}') OR regexp_matches(t, '{C.HEADER_SHAPES[1]}') AS shaped,
    list_filter(regexp_split_to_array({_normal('t')}, '{_SPACES}'), lambda w: w <> '') AS st FROM sc),
  se AS (SELECT *, CASE WHEN is_index THEN -999
    WHEN t = '' OR regexp_matches(t, '{C.INDEX_LINE}') OR (length(t) <= 2 AND NOT regexp_matches(t, '^[0-9]+(\\.[0-9]+)*$')) OR regexp_matches(t, '^[0-9]+$') OR regexp_matches(lower(t), '^[ivxlcdm]+$')
      OR (regexp_matches(t, '^[A-Z0-9\\-]{{6,}}$') AND NOT (bold OR (body_size > 0 AND larger))) OR regexp_matches(t, '^[A-Z]{{1,4}}[0-9]{{1,4}}$') OR regexp_matches(t, '^\\(?[A-Z]\\)?$')
      OR regexp_matches(t, '^[•\\-*▪]') OR regexp_matches(t, '^[a-zA-Z]\\)(\\s|$)') OR regexp_matches(lower(t), '(^|[^\\p{{L}}\\p{{N}}_])(of the|of|and|or|the|a)\\s*$') THEN -999
    WHEN n <= 10 AND (st[1] IN ({_list(C.SECTION_STARTS)}) OR concat_ws(' ', st[1], st[2]) IN ({_list(C.SECTION_STARTS)})) THEN 10
    ELSE CASE WHEN NOT coalesce(is_table_like, false) THEN 0 WHEN bold AND up THEN -2 ELSE -6 END
      - CASE WHEN table_count > 2 AND NOT numbered THEN 4 ELSE 0 END - CASE WHEN n > 18 THEN 3 ELSE 0 END - CASE WHEN regexp_matches(t, '^[0-9]+\\.\\s') AND NOT numbered THEN 2 ELSE 0 END - CASE WHEN regexp_matches(t, '^[A-Z0-9\\-.\\[\\]/]+$') AND n <= 3 THEN 3 ELSE 0 END
      - CASE WHEN n <= 3 AND NOT up AND NOT suffix(t, ':') THEN 3 ELSE 0 END - CASE WHEN n <= 2 AND NOT up AND NOT shaped THEN 2 ELSE 0 END - CASE WHEN y0 > 400 AND n <= 3 AND NOT numbered THEN 3 ELSE 0 END
      + CASE WHEN larger THEN 3 ELSE 0 END + CASE WHEN bold THEN 2 ELSE 0 END + CASE WHEN body_font <> '' AND coalesce(font_name, '') <> '' AND font_name <> body_font THEN 2 ELSE 0 END
      + CASE WHEN up THEN 2 ELSE 0 END + CASE WHEN n BETWEEN 1 AND 10 THEN 1 ELSE 0 END + CASE WHEN suffix(t, ':') THEN 1 ELSE 0 END + CASE WHEN NOT suffix(t, '.') THEN 1 ELSE 0 END
      + CASE WHEN shaped THEN 2 ELSE 0 END + CASE WHEN numbered THEN 1 ELSE 0 END END AS score FROM sd),
  sf AS (SELECT *, max(CASE WHEN score > 0 THEN score END) OVER (PARTITION BY doc_id, page) AS best, count(*) OVER (PARTITION BY doc_id, page) AS lines FROM se)"""


@query("header_levels", f"""WITH {LINES}, {TABLES}, {BODY}, {INDEX}, {SCORE}
SELECT doc_id, page, line_no, CAST(score AS INT) AS header_score, CASE WHEN is_index THEN 'non_header'
  WHEN score >= greatest(CASE WHEN best = 5 THEN 5 ELSE 6 END, CASE WHEN lines < 20 THEN 9 ELSE 0 END) THEN 'section_header'
  WHEN score >= greatest(CASE WHEN best = 5 THEN 4 ELSE 5 END, CASE WHEN lines < 20 THEN 7 ELSE 0 END) THEN 'subheader' ELSE 'non_header' END AS header_level FROM sf""")
def header_levels(spark, d):
    return L.header_levels(lines_of(spark, d), tables_of(spark, d)).select("doc_id", "page", "line_no", "header_score", "header_level")


@query("contents_lines", f"""WITH {LINES} SELECT doc_id, page, line_no, CASE WHEN regexp_matches(text, '{C.DOT_LEADER}') THEN trim(regexp_extract(text, '{C.DOT_LEADER}', 1)) ELSE trim(regexp_replace(text, '\\s+[0-9]{{1,4}}\\s*$', '')) END AS title,
  CASE WHEN regexp_matches(text, '{C.DOT_LEADER}') THEN CAST(regexp_extract(text, '{C.DOT_LEADER}', 2) AS INT) ELSE CAST(toc_page_number AS INT) END AS target_page
FROM l WHERE regexp_matches(text, '{C.DOT_LEADER}') OR toc_page_number IS NOT NULL""")
def contents_lines(spark, d):
    return contents.line_entries(lines_of(spark, d)).select("doc_id", "page", "line_no", "title", "target_page")


@query("contents_entries")
def contents_entries(spark, d):
    return contents.contents_entries(lines_of(spark, d))


ORDER = "o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page, column_id, round(y0, 1), round(x0, 1), line_no) AS pos FROM l), oo AS (SELECT *, sum(CASE WHEN header_level = 'section_header' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS grp FROM o)"
_NULLS = "NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL, NULL"
SEGMENTS = f"""{LINES}, {TABLES}, {IMAGES}, {INDEX},
  kl AS (SELECT l.* FROM l JOIN ix USING (doc_id, page) WHERE NOT is_index), kt AS (SELECT t.* FROM t LEFT JOIN ix USING (doc_id, page) WHERE NOT coalesce(is_index, false)),
  ki AS (SELECT i.* FROM i LEFT JOIN ix USING (doc_id, page) WHERE NOT coalesce(is_index, false) AND ocr_text <> ''),
  inn AS (SELECT k.doc_id, k.page, k.line_no, arg_min(t.y0, t.table_id) AS ttop FROM kl k JOIN kt t ON k.doc_id = t.doc_id AND k.page = t.page AND k.x0 >= t.x0 AND k.y0 >= t.y0 AND k.x1 <= t.x1 AND k.y1 <= t.y1 GROUP BY ALL),
  o AS (SELECT kl.*, coalesce(header_level, 'non_header') AS lv, ttop, ttop IS NOT NULL AS inside, row_number() OVER (PARTITION BY doc_id ORDER BY page, column_id, round(y0, 1), round(x0, 1), line_no) AS pos FROM kl LEFT JOIN inn USING (doc_id, page, line_no)),
  oo AS (SELECT *, count(*) FILTER (lv = 'section_header') OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS grp FROM o),
  el AS (SELECT *, CASE WHEN inside THEN ttop - 0.001 ELSE y0 END AS reach, grp - (lv = 'section_header')::INT AS before FROM oo WHERE lv = 'section_header' OR NOT inside),
  ow AS (SELECT t.doc_id, t.page, t.table_id, min(el.pos) AS pos, arg_min(el.before, el.pos) AS grp FROM kt t JOIN el ON t.doc_id = el.doc_id AND t.page = el.page AND el.reach >= t.y0 GROUP BY ALL),
  la AS (SELECT doc_id, max(grp) AS last_grp, arg_max(page, pos) AS last_page, arg_min(page, pos) AS first_page FROM oo GROUP BY doc_id),
  tt AS (SELECT *, min(y0) OVER (PARTITION BY doc_id, page) AS page_top FROM kt),
  it AS (SELECT doc_id, grp, pos AS p, 1 AS kind, 0.0 AS a, 0.0 AS b, '' AS c, CASE WHEN lv = 'subheader' THEN 'subheader' ELSE 'text' END AS type, page, line_no, NULL AS id, column_id, text, x0, y0, x1, y1, NULL::VARCHAR[] AS columns, NULL::VARCHAR[][] AS rows
      FROM oo WHERE lv <> 'section_header' AND NOT inside
    UNION ALL SELECT doc_id, coalesce(ow.grp, last_grp), coalesce(ow.pos, 4611686018427387904), 0, CASE WHEN ow.pos IS NULL THEN page_top ELSE tt.y0 END, CASE WHEN ow.pos IS NULL THEN tt.y0 ELSE 0 END, table_id, 'table_text', page, NULL, table_id, NULL, NULL, tt.x0, tt.y0, tt.x1, tt.y1, tt.columns, tt.rows
      FROM tt JOIN la USING (doc_id) LEFT JOIN ow USING (doc_id, page, table_id)),
  gg AS (SELECT doc_id, grp, arg_min(text, pos) FILTER (lv = 'section_header') AS title, arg_min(page, pos) AS start FROM oo GROUP BY ALL UNION ALL SELECT doc_id, 0, NULL, first_page FROM la WHERE doc_id NOT IN (SELECT doc_id FROM oo WHERE grp = 0)),
  gn AS (SELECT *, lead(start) OVER (PARTITION BY doc_id ORDER BY grp) AS next_page FROM gg), cn AS (SELECT doc_id, grp, count(*) AS items FROM it GROUP BY ALL),
  gs AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY grp) AS section_no, CASE WHEN grp = 0 THEN 'OPENING' WHEN grp = last_grp AND trim(title) = 'OPENING' THEN 'CLOSING' ELSE trim(title) END AS raw_title,
    CASE WHEN grp = 0 THEN first_page ELSE start END + 1 AS page_start, coalesce(next_page, last_page) + 1 AS page_end FROM gn JOIN cn USING (doc_id, grp) JOIN la USING (doc_id)),
  im AS (SELECT ki.doc_id, ki.image_id, ki.page, ki.ocr_text, min(section_no) AS section_no FROM ki JOIN gs ON ki.doc_id = gs.doc_id AND ki.page + 1 BETWEEN page_start AND page_end GROUP BY ALL),
  al AS (SELECT section_no, it.* EXCLUDE (grp) FROM it JOIN gs USING (doc_id, grp) UNION ALL SELECT section_no, doc_id, 4611686018427387904, 1, page, 0, image_id, 'image_ocr', page, NULL, image_id, NULL, ocr_text, {_NULLS} FROM im),
  nu AS (SELECT *, row_number() OVER (PARTITION BY doc_id, section_no ORDER BY p, kind, a, b, c) AS item_no FROM al)"""


def _segments(spark, d):
    """Sections and items of lines, tables and images, without contents pages."""
    lines = lines_of(spark, d)
    return S.segment(lines, tables_of(spark, d), images_of(spark, d), L.index_page(lines).where("is_index"))


@query("segmented_sections", f"WITH {SEGMENTS} SELECT doc_id, 'sec_' || section_no AS section_id, CAST(page_start AS INT) AS page_start, CAST(page_end AS INT) AS page_end, raw_title, {_normal('raw_title')} AS normalized_title, items FROM gs")
def segmented_sections(spark, d):
    return _segments(spark, d)[0].drop("grp", "section_no")


@query("section_items", f"WITH {SEGMENTS} SELECT doc_id, CAST(section_no AS INT) AS section_no, CAST(item_no AS INT) AS item_no, type, page, CAST(line_no AS INT) AS line_no, id FROM nu")
def section_items(spark, d):
    return _segments(spark, d)[1].select("doc_id", F.col("section_no").cast("int").alias("section_no"), F.col("item_no").cast("int").alias("item_no"), "type", "page", "line_no", "id")


_GRID = """CASE WHEN len(coalesce(columns, [])) + len(coalesce(rows, [])) > 0 THEN chr(10) || array_to_string(list_concat(CASE WHEN len(coalesce(columns, [])) > 0 THEN [array_to_string(list_transform(columns, lambda x: coalesce(x, '')), ' | '), repeat('-', greatest(20, CAST(coalesce(list_sum(list_transform(columns, lambda x: length(coalesce(x, '')) + 3)), 0) AS INT)))] ELSE [] END,
  list_transform(list_filter(coalesce(rows, []), lambda r: r IS NOT NULL), lambda r: array_to_string(list_transform(r, lambda x: coalesce(x, '')), ' | '))), chr(10)) || chr(10) END"""


@query("section_text", f"""WITH {SEGMENTS}, pv AS (SELECT *, last_value(CASE WHEN type IN ('text', 'subheader') THEN {{'c': column_id, 'p': page, 'y': y1}} END IGNORE NULLS) OVER (PARTITION BY doc_id, section_no ORDER BY item_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b4 FROM nu),
  pt AS (SELECT doc_id, section_no, item_no, CASE WHEN type = 'table_text' THEN {_GRID} WHEN type = 'image_ocr' THEN CASE WHEN trim(text) <> '' THEN chr(10) || '[OCR] ' || trim(text) END
    WHEN type = 'subheader' OR coalesce(column_id <> b4.c OR page <> b4.p OR (page = b4.p AND y1 - y0 > 0 AND y0 - b4.y > 1.5 * (y1 - y0)), false) THEN chr(10) || trim(text) ELSE trim(text) END AS part FROM pv)
SELECT doc_id, CAST(section_no AS INT) AS section_no, regexp_replace(coalesce(string_agg(part, chr(10) ORDER BY item_no), ''), '^\\s+|\\s+$', '', 'g') AS text_plain FROM pt GROUP BY ALL""")
def section_text(spark, d):
    return S.section_text(_segments(spark, d)[1]).select("doc_id", F.col("section_no").cast("int").alias("section_no"), "text_plain")


@query("carried_title", f"""WITH {LINES}, c AS (SELECT doc_id, page, arg_min(text, line_no) FILTER (header_level = 'section_header') AS t FROM l GROUP BY ALL)
SELECT doc_id, page, last_value(t IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS title FROM c""")
def carried_title(spark, d):
    return S.carried_title(lines_of(spark, d))


@query("page_density", f"WITH {LINES} SELECT doc_id, page, CAST(sum(length(trim(text))) AS BIGINT) AS chars, max(x1) * max(y1) > 0 AND sum(length(trim(text))) / (max(x1) * max(y1)) < 0.002 AS sparse FROM l GROUP BY ALL")
def page_density(spark, d):
    return S.page_density(lines_of(spark, d), F.max("x1") * F.max("y1"))


@query("lines_in_tables", f"""WITH {LINES}, {TABLES} SELECT l.doc_id, l.page, l.line_no, arg_min(t.y0, t.table_id) AS table_top FROM l JOIN t ON l.doc_id = t.doc_id AND l.page = t.page
  AND l.x0 >= t.x0 - 5 AND l.y0 >= t.y0 - 5 AND l.x1 <= t.x1 + 5 AND l.y1 <= t.y1 + 5 GROUP BY ALL""")
def lines_in_tables(spark, d):
    return TB.lines_in_tables(lines_of(spark, d), tables_of(spark, d), 5).where("in_table").select("doc_id", "page", "line_no", "table_top")


@query("table_owner", f"""WITH {LINES}, {TABLES}, {ORDER}, b AS (SELECT doc_id, page, pos, y0, grp - CASE WHEN header_level = 'section_header' THEN 1 ELSE 0 END AS before FROM oo),
  m AS (SELECT t.doc_id, t.page, t.table_id, min(b.pos) AS pos, arg_min(b.before, b.pos) AS grp FROM t JOIN b ON t.doc_id = b.doc_id AND t.page = b.page AND b.y0 >= t.y0 GROUP BY ALL)
SELECT t.doc_id, t.page, t.table_id, CAST(m.pos AS BIGINT) AS pos, CAST(m.grp AS BIGINT) AS grp FROM t LEFT JOIN m USING (doc_id, page, table_id)""")
def table_owner(spark, d):
    owner = S.table_owner(S.reading_order(lines_of(spark, d)), tables_of(spark, d))
    return owner.select("doc_id", "page", "table_id", F.col("pos").cast("bigint").alias("pos"), F.col("grp").cast("bigint").alias("grp"))


@query("image_section", f"WITH {IMAGES}, {SECTIONS} SELECT i.doc_id, i.image_id, i.page, arg_min(s.section_id, s.section_no) AS section_id FROM i JOIN s ON i.doc_id = s.doc_id AND i.page + 1 BETWEEN s.page_start AND s.page_end GROUP BY ALL")
def image_section(spark, d):
    return S.image_section(images_of(spark, d), sections_of(spark, d))


@query("relevant_images", f"WITH {IMAGES} SELECT image_uid, width >= 120 AND height >= 60 AND width * height >= 50000 AND NOT (y0 < 80 AND (x1 - x0) / greatest(y1 - y0, 1) > 6) AS relevant, CASE WHEN length(ocr_text) >= 4 THEN ocr_text END AS ocr_text FROM i")
def relevant_images(spark, d):
    from sheafline.sources.images import relevant, usable_text

    return images_of(spark, d).select("image_uid", relevant().alias("relevant"), usable_text(F.col("ocr_text")).alias("ocr_text"))


@query("table_facts", f"""WITH {TABLES}, c AS (SELECT table_uid, coalesce(columns, []) AS columns, list_filter(coalesce(rows, []), lambda r: r IS NOT NULL) AS rows FROM t),
  e AS (SELECT *, list_concat(columns, flatten(rows)) AS cells FROM c)
SELECT table_uid, CAST(len(rows) AS INT) AS n_rows, CAST(len(columns) AS INT) AS n_columns, CAST(coalesce(list_max(list_transform(cells, lambda x: length(coalesce(x, '')))), 0) AS INT) AS longest,
  len(columns) > 6 OR coalesce(list_max(list_transform(rows, lambda r: len(r))), 0) > 8 OR coalesce(list_max(list_transform(cells, lambda x: length(coalesce(x, '')))), 0) > 120 AS odd,
  len(list_filter(cells, lambda x: regexp_matches(trim(coalesce(x, '')), '^[A-Z0-9\\-]{{6,}}$') OR regexp_matches(lower(trim(coalesce(x, ''))), '^[ivxlcdm]+$') OR regexp_matches(trim(coalesce(x, '')), '^[0-9]+$'))) > 0 AS footer FROM e""")
def table_facts(spark, d):
    return TB.table_facts(tables_of(spark, d), ["table_uid"])


@query("table_grid", f"""WITH {TABLES}, c AS (SELECT table_uid, columns, list_filter(rows, lambda r: r IS NOT NULL) AS rows FROM t WHERE columns IS NOT NULL AND rows IS NOT NULL)
SELECT table_uid, array_to_string(list_concat(CASE WHEN len(columns) > 0 THEN [array_to_string(list_transform(columns, lambda x: coalesce(x, '')), ' | '), repeat('-', greatest(20, CAST(coalesce(list_sum(list_transform(columns, lambda x: length(coalesce(x, '')) + 3)), 0) AS INT)))] ELSE [] END,
  list_transform(rows, lambda r: array_to_string(list_transform(r, lambda x: coalesce(x, '')), ' | '))), chr(10)) AS grid FROM c""")
def table_grid(spark, d):
    x = tables_of(spark, d).where("columns is not null and rows is not null")
    return x.select("table_uid", X.table_grid(F.col("columns"), F.col("rows")).alias("grid"))


@query("table_blocks", f"""WITH RECURSIVE {CELLS}, {ROWS}, {FLAGS}, c AS (SELECT r.doc_id, r.row_no, r.x0, r.text, r.line_no, row_number() OVER (PARTITION BY r.doc_id, r.row_no ORDER BY r.y0, r.x0, r.line_no) AS nth FROM r JOIN k USING (doc_id, page, column_id, row_no) WHERE k.flag AND k.streak >= 4),
  rr AS (SELECT doc_id, row_no, count(*) AS n, row_no - row_number() OVER (PARTITION BY doc_id ORDER BY row_no) AS run FROM c GROUP BY doc_id, row_no),
  rn AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY row_no) AS i, count(*) OVER (PARTITION BY doc_id, run) AS size FROM rr QUALIFY size >= 4),
  fit AS (SELECT a.doc_id, a.row_no AS above, b.row_no FROM rn a JOIN rn b ON a.doc_id = b.doc_id AND a.run = b.run AND a.row_no < b.row_no AND b.n < a.n
    WHERE NOT EXISTS (SELECT 1 FROM c x WHERE x.doc_id = b.doc_id AND x.row_no = b.row_no AND NOT EXISTS (SELECT 1 FROM c y WHERE y.doc_id = a.doc_id AND y.row_no = a.row_no AND abs(x.x0 - y.x0) <= {C.DEFAULT.cell_shift}))),
  fd AS (SELECT doc_id, run, i, row_no, row_no AS above FROM rn WHERE i = 1
    UNION ALL SELECT rn.doc_id, rn.run, rn.i, rn.row_no, CASE WHEN fit.row_no IS NOT NULL THEN f.above ELSE rn.row_no END FROM fd f JOIN rn ON rn.doc_id = f.doc_id AND rn.run = f.run AND rn.i = f.i + 1
      LEFT JOIN fit ON fit.doc_id = rn.doc_id AND fit.above = f.above AND fit.row_no = rn.row_no),
  o AS (SELECT f.doc_id, f.run, f.above, f.row_no, c.nth, c.text, CASE WHEN f.above = f.row_no THEN c.x0 ELSE (SELECT arg_min(y.x0, (abs(y.x0 - c.x0), y.nth)) FROM c y WHERE y.doc_id = f.doc_id AND y.row_no = f.above) END AS x FROM fd f JOIN c ON c.doc_id = f.doc_id AND c.row_no = f.row_no),
  w AS (SELECT doc_id, run, above, x, string_agg(text, ' ' ORDER BY row_no, nth) AS cell FROM o GROUP BY ALL),
  gr AS (SELECT doc_id, run, above, string_agg(cell, ' | ' ORDER BY x) AS line FROM w GROUP BY ALL),
  b AS (SELECT doc_id, run, count(*) AS n, string_agg(line, chr(10) ORDER BY above) AS grid FROM gr GROUP BY ALL HAVING count(*) >= 4)
SELECT doc_id, 'table_p1_' || row_number() OVER (PARTITION BY doc_id ORDER BY run) AS table_id, CAST(n - 1 AS INT) AS n_rows, grid FROM b""")
def table_blocks(spark, d):
    line = lambda r: F.array_join(r, " | ")
    grid = F.array_join(F.concat(F.array(line(F.col("columns"))), F.transform("rows", line)), "\n")
    return TB.table_blocks(L.mark_table_like(cell_lines(spark, d))).select("doc_id", "table_id", F.size("rows").alias("n_rows"), grid.alias("grid"))


_FIELDS = " UNION ALL ".join(f"SELECT {i} AS no, '{f}' AS target_field, [{_list(t)}] AS terms" for i, (f, t) in enumerate(C.FIELD_ALIASES.items()))


@query("title_hints", f"""WITH {SECTIONS}, f AS ({_FIELDS}), c AS (SELECT section_uid, target_field, greatest(len(list_filter(terms, lambda x: contains({_form('raw_title')}, x))), len(list_filter(terms, lambda x: contains({_form('normalized_title')}, x)))) AS n FROM s, f)
SELECT section_uid, target_field, CAST(round(least(0.78 + 0.08 * n, 0.95), 2) AS DOUBLE) AS confidence FROM c WHERE n > 0""")
def title_hints(spark, d):
    h = hints.title_hints(sections_of(spark, d).withColumn("doc_id", F.col("section_uid")))
    return h.select(F.col("doc_id").alias("section_uid"), "target_field", F.round("confidence", 2).alias("confidence"))


@query("column_hints", f"WITH {TABLES}, f AS ({_FIELDS}), c AS (SELECT table_uid, page, unnest(columns) AS name FROM t) SELECT table_uid, target_field, name AS source_text, CAST(page + 1 AS INT) AS page FROM c, f WHERE name IS NOT NULL AND len(list_filter(terms, lambda x: contains({_form('name')}, x))) > 0")
def column_hints(spark, d):
    h = hints.column_hints(tables_of(spark, d).withColumn("doc_id", F.col("table_uid")))
    return h.select(F.col("doc_id").alias("table_uid"), "target_field", "source_text", "page")


def _label_sql(labels) -> str:
    flat = _clean("text")
    pattern = lambda x: f"nullif(trim(regexp_extract({flat}, '(?i)(?:^|[.;])\\s*{x}\\s*[:\\-]\\s*([^.;]+)', 1), ' :-'), '')"
    return "coalesce(" + ", ".join(f"'{x}: ' || {pattern(x)}" for x in labels) + ")"


_VALUES = " UNION ALL ".join(f"SELECT doc_id, '{f}' AS target_field, {_label_sql(labels)} AS source_text FROM documents" for f, labels in C.VALUE_LABELS.items())
_ORIGIN = "coalesce(" + ", ".join(
    f"CASE WHEN regexp_extract({_clean('text')}, '{p}', 1) <> '' THEN regexp_extract({_clean('text')}, '{p}', 1) || ' ' || trim(regexp_extract({_clean('text')}, '{p}', 2)) END" for p in C.ORIGIN_PATTERNS
) + ")"


@query("value_hints", f"SELECT * FROM ({_VALUES} UNION ALL SELECT doc_id, 'origin', {_ORIGIN} FROM documents) WHERE source_text IS NOT NULL")
def value_hints(spark, d):
    x = table(spark, d, "documents").select("doc_id", F.lit("").alias("section_id"), F.lit(1).alias("section_no"), F.lit(1).alias("page_start"), F.col("text").alias("text_plain"))
    return hints.value_hints(x).select("doc_id", "target_field", "source_text")


@query("ranked_hints")
def ranked_hints(spark, d):
    s, t = sections_of(spark, d), tables_of(spark, d)
    docs = table(spark, d, "documents_meta").groupBy("doc_id").agg(F.max_by("title_metadata", F.struct("ingested_at", "title_metadata")).alias("title_metadata"))
    headers = hints.header_candidates(lines_of(spark, d), t)
    every = hints.name_hints(docs, headers).unionByName(hints.title_hints(s)).unionByName(hints.value_hints(s)).unionByName(hints.column_hints(t))
    return hints.ranked(every)


@query("section_facts", f"""WITH {SECTIONS}, c AS (SELECT *, coalesce(raw_title, '') IN ({_list(C.STRUCTURAL_TITLES)}) AS structural, length(coalesce(text_plain, '')) AS size FROM s)
SELECT doc_id, count(*) AS sections, count(*) FILTER (structural) AS untitled, count(*) FILTER (normalized_title = 'other') AS other, CAST(sum(size) AS BIGINT) AS total_chars,
  CAST(coalesce(floor(sum(size) FILTER (NOT structural) / count(*) FILTER (NOT structural)), 0) AS INT) AS avg_chars,
  count(*) FILTER (len(list_filter(regexp_split_to_array(lower(coalesce(raw_title, '')), '[/|\\\\]'), lambda p: trim(p) IN ({_list(C.LANGUAGE_NAMES)}))) > 0) AS language_titles FROM c GROUP BY doc_id""")
def section_facts(spark, d):
    return corpus.section_facts(sections_of(spark, d))


@query("header_facts", f"""WITH {LINES}, c AS (SELECT doc_id, page, header_level = 'section_header' AS h, header_level = 'subheader' AS u, trim(text) AS t, {_words('text')} AS n FROM l)
SELECT doc_id, count(*) FILTER (h) AS section_headers, count(*) FILTER (u) AS subheaders, count(*) FILTER (h AND (regexp_matches(lower(t), '^[a-z]\\)') OR regexp_matches(lower(t), '^[0-9]+\\.$'))) AS list_headers,
  count(*) FILTER (h AND (regexp_matches(t, '^[A-Z]{{2,5}}-[0-9]{{2,}}$') OR regexp_matches(t, '^[A-Z]-[A-Z0-9]{{4,}}$') OR regexp_matches(t, '^[A-Z]{{1,4}}[0-9]{{2,}}[A-Z0-9\\-]*$'))) AS code_headers,
  count(*) FILTER (h AND n > 12) AS long_headers, count(*) FILTER (h AND n > 18) AS very_long_headers,
  count(*) FILTER ((h OR u) AND page < 4 AND len(list_filter([{_list(C.LANGUAGE_NAMES)}], lambda x: contains(lower(t), x))) > 0) AS language_headers FROM c GROUP BY doc_id""")
def header_facts(spark, d):
    return corpus.header_facts(lines_of(spark, d))


def _counts(query_sql: str, name: str) -> str:
    """The CTEs and the last SELECT of a registered query as CTEs of another."""
    return query_sql.removeprefix("WITH ").rpartition("\nSELECT")[0], f"{name} AS (SELECT{query_sql.rpartition(chr(10) + 'SELECT')[2]})"


_FACTS = {n: _counts(SQL[n], x) for n, x in (("section_facts", "fs"), ("header_facts", "fh"), ("table_facts", "ft"))}


@query("document_problems", f"""WITH {SECTIONS}, {LINES}, {TABLES}, {IMAGES}, fs AS (WITH {_FACTS['section_facts'][0]}, {_FACTS['section_facts'][1]} SELECT * FROM fs), fh AS (WITH {_FACTS['header_facts'][0]}, {_FACTS['header_facts'][1]} SELECT * FROM fh),
  ft AS (WITH {_FACTS['table_facts'][0]}, {_FACTS['table_facts'][1]} SELECT * FROM ft), td AS (SELECT doc_id, count(*) AS tables, count(*) FILTER (odd) AS odd_tables, count(*) FILTER (footer) AS footer_tables FROM t JOIN ft USING (table_uid) GROUP BY doc_id),
  m AS (SELECT doc_id, arg_max(file_name, (ingested_at, file_name)) AS file_name, arg_max(page_count, (ingested_at, file_name)) AS page_count FROM documents_meta GROUP BY doc_id),
  lc AS (SELECT doc_id, count(*) AS lines FROM l GROUP BY doc_id), ic AS (SELECT doc_id, count(*) AS images FROM i GROUP BY doc_id),
  j AS (SELECT m.doc_id, m.file_name, coalesce(page_count, 0) AS pages, coalesce(lines, 0) AS lines, coalesce(images, 0) AS images, coalesce(sections, 0) AS sections, coalesce(untitled, 0) AS untitled, coalesce(other, 0) AS other, coalesce(total_chars, 0) AS total_chars,
    CAST(coalesce(avg_chars, 0) AS BIGINT) AS avg_chars, coalesce(language_titles, 0) AS language_titles, coalesce(section_headers, 0) AS section_headers, coalesce(subheaders, 0) AS subheaders, coalesce(list_headers, 0) AS list_headers, coalesce(code_headers, 0) AS code_headers,
    coalesce(long_headers, 0) AS long_headers, coalesce(very_long_headers, 0) AS very_long_headers, coalesce(language_headers, 0) AS language_headers, coalesce(tables, 0) AS tables, coalesce(odd_tables, 0) AS odd_tables, coalesce(footer_tables, 0) AS footer_tables
    FROM m LEFT JOIN lc USING (doc_id) LEFT JOIN ic USING (doc_id) LEFT JOIN fs USING (doc_id) LEFT JOIN fh USING (doc_id) LEFT JOIN td USING (doc_id))
SELECT *, concat_ws(' | ', CASE WHEN lines = 0 AND pages > 0 THEN 'no_text' END, CASE WHEN lines < 15 AND images >= 5 THEN 'mostly_images' END,
  CASE WHEN pages <= 4 AND sections > 8 OR pages BETWEEN 5 AND 10 AND sections > 15 OR pages > 10 AND sections > 2 * pages THEN 'too_many_sections' END, CASE WHEN sections >= 4 AND untitled > 0.30 * sections THEN 'many_untitled' END,
  CASE WHEN list_headers >= 2 THEN 'list_headers' END, CASE WHEN code_headers >= 1 THEN 'code_headers' END, CASE WHEN long_headers >= 2 OR very_long_headers >= 1 THEN 'long_headers' END, CASE WHEN sections >= 8 AND other > 0.60 * sections THEN 'poor_normalization' END,
  CASE WHEN odd_tables >= 1 THEN 'suspicious_tables' END, CASE WHEN footer_tables >= 1 THEN 'footer_tables' END, CASE WHEN sections >= 6 AND avg_chars < 150 THEN 'sections_too_short' END, CASE WHEN sections <= 4 AND avg_chars > 3000 THEN 'sections_too_long' END,
  CASE WHEN subheaders > 0 AND subheaders > greatest(6, 2 * section_headers) THEN 'many_subheaders' END, CASE WHEN language_titles >= 3 OR sections > 20 AND other > 0.85 * sections OR language_headers >= 4 THEN 'multilingual' END) AS problems FROM j""")
def document_problems(spark, d):
    facts = corpus.document_facts(table(spark, d, "documents_meta"), lines_of(spark, d), sections_of(spark, d), tables_of(spark, d), images_of(spark, d))
    return facts.withColumn("problems", F.array_join("problems", " | "))


FREQUENCY = """fb AS (SELECT doc_id, coalesce(nullif(normalized_title, ''), 'other') AS normalized_title, trim(coalesce(raw_title, '')) AS raw, length(coalesce(text_plain, '')) AS chars FROM s),
  fd AS (SELECT normalized_title, count(DISTINCT doc_id) AS doc_count, CAST(floor(avg(chars)) AS INT) AS avg_chars, count(DISTINCT nullif(raw, '')) AS unique_raw_titles FROM fb GROUP BY 1),
  fr AS (SELECT normalized_title, raw, count(*) AS n FROM fb WHERE raw <> '' GROUP BY normalized_title, raw QUALIFY row_number() OVER (PARTITION BY normalized_title ORDER BY count(*) DESC, raw) <= 6),
  fv AS (SELECT normalized_title, string_agg(raw || ' (' || n || ')', '; ' ORDER BY n DESC, raw) AS raw_variations FROM fr GROUP BY 1)"""


@query("title_frequency", f"WITH {SECTIONS}, {FREQUENCY} SELECT normalized_title, doc_count, unique_raw_titles, avg_chars, normalized_title IN ({_list(C.STRUCTURAL_NORMS)}) AS is_structural, coalesce(raw_variations, '') AS raw_variations FROM fd LEFT JOIN fv USING (normalized_title)")
def title_frequency(spark, d):
    return corpus.title_frequency(sections_of(spark, d))


@query("frequency_band", f"WITH {SECTIONS}, {FREQUENCY}, m AS (SELECT max(doc_count) AS top FROM fd) SELECT normalized_title, doc_count, CASE WHEN doc_count / top >= 0.75 THEN 'very common' WHEN doc_count / top >= 0.40 THEN 'common' WHEN doc_count / top >= 0.15 THEN 'some' ELSE 'few' END AS band FROM fd, m")
def frequency_band(spark, d):
    return corpus.frequency_band(corpus.title_frequency(sections_of(spark, d)))


@query("top_titles", f"""WITH {SECTIONS}, c AS (SELECT doc_id, raw_title, row_number() OVER (PARTITION BY doc_id ORDER BY section_no) AS n FROM s WHERE coalesce(raw_title, '') NOT IN ({_list(C.STRUCTURAL_TITLES)}) AND length(raw_title) > 2)
SELECT doc_id, string_agg(raw_title, ' | ' ORDER BY n) AS titles FROM c WHERE n <= 5 GROUP BY doc_id""")
def top_titles(spark, d):
    return corpus.top_titles(sections_of(spark, d))


_MAP = " UNION ALL ".join(f"SELECT '{k}' AS norm_title, '{v}' AS mapped" for k, v in TITLE_MAP.items())
RESOLVED = f"""mp AS ({_MAP}), rb AS (SELECT doc_id, section_id, section_no, trim(raw_title) AS raw_title, trim(coalesce(normalized_title, '')) AS norm_title, text_plain FROM s
    WHERE raw_title IS NOT NULL AND trim(raw_title) NOT IN ('', {_list(C.STRUCTURAL_TITLES)}) AND length(trim(raw_title)) >= 4),
  rm AS (SELECT rb.*, mapped, regexp_split_to_array(norm_title, '\\s+')[1] AS w FROM rb LEFT JOIN mp USING (norm_title)),
  rs AS (SELECT *, CASE WHEN mapped IS NOT NULL THEN mapped WHEN norm_title IN ({_list(COLUMNS)}) THEN norm_title WHEN norm_title <> '' AND w IN ({_list(COLUMNS[:-1])}) THEN w ELSE '{COLUMNS[-1]}' END AS col,
    CASE WHEN mapped IS NOT NULL THEN 'map' WHEN norm_title IN ({_list(COLUMNS)}) THEN 'title' WHEN norm_title <> '' AND w IN ({_list(COLUMNS[:-1])}) THEN 'first word' ELSE 'fallback' END AS step FROM rm)"""


def _resolved(spark, d):
    pairs = spark.createDataFrame(list(TITLE_MAP.items()), "norm_title string, column string")
    return matrix.resolve_columns(sections_of(spark, d), COLUMNS, pairs)


@query("resolved_columns", f'WITH {SECTIONS}, {RESOLVED} SELECT doc_id, section_id, raw_title, col AS "column", step FROM rs')
def resolved_columns(spark, d):
    return _resolved(spark, d).select("doc_id", "section_id", "raw_title", "column", "step")


@query("matrix_pivot", f"""WITH {SECTIONS}, {RESOLVED}, rk AS (SELECT *, min(section_no) OVER (PARTITION BY doc_id, raw_title) AS place FROM rs QUALIFY row_number() OVER (PARTITION BY doc_id, raw_title ORDER BY section_no DESC, section_id DESC) = 1),
  bk AS (SELECT doc_id, col, place, '[' || raw_title || ']' || CASE WHEN trim(coalesce(text_plain, '')) <> '' THEN chr(10) || trim(text_plain) ELSE '' END AS b FROM rk)
SELECT doc_id, {", ".join(f"coalesce(string_agg(b, chr(10) || chr(10) ORDER BY place) FILTER (col = '{c}'), '') AS {c}" for c in COLUMNS)} FROM bk GROUP BY doc_id""")
def matrix_pivot(spark, d):
    return matrix.matrix(_resolved(spark, d), COLUMNS)


@query("stale_rows", """WITH w AS (SELECT doc_id, max(ingested_at) AS at FROM sections GROUP BY doc_id), c AS (SELECT doc_id, min(ingested_at) AS at FROM sections GROUP BY doc_id)
SELECT w.doc_id, w.at FROM w LEFT JOIN c ON w.doc_id = c.doc_id AND w.at = c.at WHERE c.doc_id IS NULL""")
def stale_rows(spark, d):
    s = table(spark, d, "sections")
    wanted, cached = s.groupBy("doc_id").agg(F.max("ingested_at").alias("at")), s.groupBy("doc_id").agg(F.min("ingested_at").alias("at"))
    return matrix.missing_or_stale(wanted, cached, ["doc_id"], "at").select("doc_id", "at")


@query("reading_order", f"WITH {LINES}, {ORDER} SELECT doc_id, page, line_no, CAST(pos AS BIGINT) AS pos FROM oo")
def reading_order(spark, d):
    return S.reading_order(lines_of(spark, d)).select("doc_id", "page", "line_no", F.col("pos").cast("bigint").alias("pos"))


@query("page_records", f"""WITH {LINES}, {IMAGES}, {TABLES}, a AS (SELECT doc_id, page, count(*) AS text_line_count, count(*) FILTER (toc_page_number IS NOT NULL) AS toc_entry_count,
    coalesce(string_agg(text || ' ' || header_score, ' | ' ORDER BY line_no) FILTER (header_level <> 'non_header'), '') AS headers FROM l GROUP BY ALL),
  b AS (SELECT doc_id, page, count(*) AS image_count FROM i GROUP BY ALL), c AS (SELECT doc_id, page, count(*) AS table_count FROM t GROUP BY ALL)
SELECT doc_id, CAST(page + 1 AS INT) AS page, text_line_count, toc_entry_count, coalesce(image_count, 0) AS image_count, coalesce(table_count, 0) AS table_count, toc_entry_count > 0 AS is_toc_page, headers
FROM a LEFT JOIN b USING (doc_id, page) LEFT JOIN c USING (doc_id, page)""")
def page_records(spark, d):
    r = corpus.page_records(lines_of(spark, d), images_of(spark, d), tables_of(spark, d))
    return r.withColumn("headers", F.array_join(F.transform("header_candidates", lambda h: F.concat_ws(" ", h["text"], h["score"])), " | ")).drop("header_candidates")


@query("image_only_documents", f"WITH {IMAGES} SELECT doc_id, CAST(sum(length(ocr_text)) AS BIGINT) AS chars FROM i WHERE ocr_text IS NOT NULL GROUP BY doc_id HAVING sum(length(ocr_text)) < 100")
def image_only_documents(spark, d):
    # Every PDF here has lines enough; the recognised text of its images hasn't.
    return corpus.image_only(images_of(spark, d).where("ocr_text is not null").withColumn("text", F.col("ocr_text")))


@query("top_normalized", f"""WITH {SECTIONS}, c AS (SELECT doc_id, normalized_title, count(*) AS c, min(section_no) AS f FROM s WHERE normalized_title IS NOT NULL AND normalized_title NOT IN ({_list(C.STRUCTURAL_NORMS)}) GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY c DESC, f, normalized_title) AS n FROM c)
SELECT doc_id, string_agg(normalized_title, ' | ' ORDER BY n) AS categories FROM r WHERE n <= 8 GROUP BY doc_id""")
def top_normalized(spark, d):
    return corpus.top_normalized(sections_of(spark, d))


@query("column_prompt", f"""WITH {SECTIONS}, {FREQUENCY} SELECT 'Group these titles:' || chr(10) || string_agg('- ' || normalized_title || ' (' || doc_count || ' docs)', chr(10) ORDER BY doc_count DESC, normalized_title) AS prompt
FROM fd WHERE normalized_title NOT IN ({_list(C.STRUCTURAL_NORMS)}) AND doc_count >= 2""")
def column_prompt(spark, d):
    return matrix.prompt(corpus.title_frequency(sections_of(spark, d)).where("doc_count >= 2"), "Group these titles:")


@query("json_map", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE props IS NOT NULL")
def json_map(spark, d):
    fenced = F.concat(F.lit("```json\n"), "props", F.lit("\n```"))
    return table(spark, d, "events").where("props is not null").select("event_id", F.element_at(X.json_map(fenced), "k").alias("k"))


@query("titles_by_day", f"""SELECT date_trunc('day', ingested_at) AS day, coalesce(nullif({_normal('raw_title')}, ''), 'other') AS normalized_title, count(*) AS sections FROM sections GROUP BY ALL""")
def titles_by_day(spark, d):
    from sheafline.streaming.incremental import title_counts

    return title_counts(table(spark, d, "sections"))
