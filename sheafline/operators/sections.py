"""Lines to sections: assignment, table ownership, image placement, and a section's text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sheafline.config import DEFAULT, Config
from sheafline.functions import text as X
from sheafline.operators.lines import PAGE
from sheafline.operators.tables import lines_in_tables
from sheafline.session import cut


def _running(lines: DataFrame, value: Column, name: str, order: list) -> DataFrame:
    """``lines`` with the running sum of ``value`` (not negative) along a document: within each page by ``order``, plus the sums
    of the pages before. Only one row per page is ever brought together by document, so a long one is no hot group."""
    page = W.partitionBy(*PAGE).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    within = lines.withColumn(name, F.sum(value).over(page))
    pages = within.groupBy(F.col("doc_id").alias("_d"), F.col("page").alias("_p")).agg(F.max(name).alias("_sum"))
    before = W.partitionBy("_d").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    pages = pages.select("_d", "_p", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    joined = within.join(pages, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("page").eqNullSafe(F.col("_p")))
    return joined.withColumn(name, F.col(name) + F.col("_before")).drop("_d", "_p", "_before")


def reading_order(lines: DataFrame, drop_pages: DataFrame | None = None) -> DataFrame:
    """``lines`` with ``pos`` (from 1, per document): by page, column, then y0 and x0 to a tenth, then line_no. Pages in
    ``drop_pages`` (doc_id, page) are left out."""
    kept = lines if drop_pages is None else lines.join(drop_pages.select(*PAGE), [*PAGE], "left_anti")
    return _running(kept, F.lit(1), "pos", ["column_id", F.round("y0", 1), F.round("x0", 1), "line_no"])


def header_groups(lines: DataFrame) -> DataFrame:
    """``lines`` (with pos) and ``grp``: how many section headers a document has shown up to and with the line; 0 before the
    first."""
    header = F.coalesce((F.col("header_level") == "section_header").cast("int"), F.lit(0))
    return _running(lines, header, "grp", ["pos"])


ITEM = ["doc_id", "grp", "order", "type", "page", "line_no", "id", "column_id", "text", "x0", "y0", "x1", "y1", "columns", "rows"]


def _order(pos: Column, kind: int, first: Column, second: Column, name: Column) -> Column:
    return F.struct(pos.cast("bigint").alias("pos"), F.lit(kind).alias("kind"), first.cast("double").alias("a"), second.cast("double").alias("b"), name.cast("string").alias("c"))


def segment(lines: DataFrame, tables: DataFrame | None = None, images: DataFrame | None = None, index_pages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(sections, items) of documents.

    sections: doc_id, grp, section_no, section_id, page_start, page_end (from 1), raw_title, normalized_title, items. Lines before
    the first section header are OPENING; a header directly followed by another starts nothing, yet ends the section before it.

    items: doc_id, section_no, item_no, type (text, subheader, table_text, image_ocr), page, line_no, id of the table or image,
    column_id, text, x0, y0, x1, y1, columns, rows.

    Pages in ``index_pages`` (doc_id, page) are left out of all three inputs. ``tables`` (doc_id, page, table_id, x0, y0, x1, y1,
    columns, rows): lines wholly inside a table are its content and no items, unless they are section headers; a table
    stands before the first other line of its page, in reading order, at or below its top (a header inside a table counts
    as a hair above it, so that the table follows its title); tables below all lines come last. ``images`` (doc_id, page,
    image_id, ocr_text): recognised text ends the first section on whose pages the image is. Documents without lines have
    no sections; null levels are text.
    """
    spark = lines.sparkSession
    if index_pages is not None:
        index_pages = cut(index_pages.select(*PAGE))
    if tables is None:
        tables = spark.createDataFrame([], "doc_id string, page int, table_id string, x0 double, y0 double, x1 double, y1 double, columns array<string>, rows array<array<string>>")
    without = lambda df: df if index_pages is None else df.join(index_pages.select(*PAGE), [*PAGE], "left_anti")
    tables = without(tables).select(*PAGE, "table_id", "x0", "y0", "x1", "y1", "columns", "rows")
    level = F.coalesce("header_level", F.lit("non_header"))
    marked = lines_in_tables(lines.drop("in_table", "table_top"), tables, 0).withColumn("header_level", level)
    # Written once: everything below begins here.
    placed = cut(header_groups(reading_order(marked, index_pages)))
    header = F.col("header_level") == "section_header"
    # Where a page's tables go: its lines that are no table's content, and how far down each lets tables in.
    eligible = placed.where(header | ~F.col("in_table")).withColumn("reach", F.when(F.col("in_table"), F.col("table_top") - 0.001).otherwise(F.col("y0")))
    stops = eligible.select(*PAGE, F.struct("pos", F.col("reach"), (F.col("grp") - header.cast("int")).alias("before")).alias("stop"))
    tops = tables.select(*PAGE, "table_id", F.col("y0").alias("top"))
    owned = tops.join(stops, [*PAGE]).where("stop.reach >= top").groupBy(*PAGE, "table_id").agg(F.min_by("stop", "stop.pos").alias("stop"))
    last = placed.groupBy("doc_id").agg(F.max("grp").alias("last_grp"), F.max_by("page", "pos").alias("last_page"), F.min_by("page", "pos").alias("first_page"))
    rest = tables.groupBy(*PAGE).agg(F.min("y0").alias("page_top"))
    at = tables.join(owned, [*PAGE, "table_id"], "left").join(rest, [*PAGE]).join(last, "doc_id")
    end = F.lit((1 << 62))
    none = lambda t: F.lit(None).cast(t)
    of_tables = at.select(
        "doc_id",
        F.coalesce("stop.before", "last_grp").alias("grp"),
        F.when(F.col("stop").isNotNull(), _order(F.col("stop.pos"), 0, F.col("y0"), F.lit(0), F.col("table_id"))).otherwise(_order(end, 0, F.col("page_top"), F.col("y0"), F.col("table_id"))).alias("order"),
        F.lit("table_text").alias("type"), "page", none("int").alias("line_no"), F.col("table_id").alias("id"), none("int").alias("column_id"), none("string").alias("text"),
        "x0", "y0", "x1", "y1", "columns", "rows",
    )
    of_lines = placed.where(~header & ~F.col("in_table")).select(
        "doc_id", "grp", _order(F.col("pos"), 1, F.lit(0), F.lit(0), F.lit("")).alias("order"),
        F.when(F.col("header_level") == "subheader", "subheader").otherwise("text").alias("type"), "page", F.col("line_no").cast("int"), none("string").alias("id"), F.col("column_id").cast("int"), "text",
        "x0", "y0", "x1", "y1", none("array<string>").alias("columns"), none("array<array<string>>").alias("rows"),
    )
    items = cut(of_lines.unionByName(of_tables))
    groups = placed.groupBy("doc_id", "grp").agg(F.min_by(F.when(header, F.col("text")), "pos").alias("title"), F.min_by("page", "pos").alias("start"))
    # Before the first header a table alone may stand.
    opening = last.select("doc_id", F.lit(0).cast("bigint").alias("grp"), F.lit(None).cast("string").alias("title"), F.col("first_page").alias("start"))
    groups = groups.select("doc_id", F.col("grp").cast("bigint").alias("grp"), "title", "start").unionByName(opening).groupBy("doc_id", "grp").agg(F.max("title").alias("title"), F.min("start").alias("start"))
    by_doc = W.partitionBy("doc_id").orderBy("grp")
    # A header's own page ends the section before it. Headers number a fraction of the lines: one row each.
    groups = groups.withColumn("next_page", F.lead("start").over(by_doc)).join(items.groupBy("doc_id", "grp").agg(F.count("*").alias("items")), ["doc_id", "grp"])
    kept = groups.join(last, "doc_id").withColumn("section_no", F.row_number().over(by_doc))
    title = F.when(F.col("grp") == 0, "OPENING").when((F.col("grp") == F.col("last_grp")) & (F.btrim("title") == "OPENING"), "CLOSING").otherwise(F.btrim("title"))
    found = cut(kept.select(
        "doc_id",
        "grp",
        "section_no",
        F.concat(F.lit("sec_"), "section_no").alias("section_id"),
        (F.when(F.col("grp") == 0, F.col("first_page")).otherwise(F.col("start")) + 1).alias("page_start"),
        (F.coalesce("next_page", "last_page") + 1).alias("page_end"),
        title.alias("raw_title"),
        X.normalize_title(title).alias("normalized_title"),
        "items",
    ))
    placed_items = items.join(found.select("doc_id", "grp", "section_no"), ["doc_id", "grp"]).drop("grp")
    if images is not None:
        read = without(images).where("ocr_text <> ''")
        where = image_section(read, found).join(found.select("doc_id", "section_id", "section_no"), ["doc_id", "section_id"]).drop("section_id")
        of_images = read.join(where, ["doc_id", "image_id", "page"]).select(
            "doc_id", _order(end, 1, F.col("page"), F.lit(0), F.col("image_id")).alias("order"), F.lit("image_ocr").alias("type"), "page", none("int").alias("line_no"), F.col("image_id").alias("id"),
            none("int").alias("column_id"), F.col("ocr_text").alias("text"), *(none("double").alias(c) for c in ("x0", "y0", "x1", "y1")), none("array<string>").alias("columns"), none("array<array<string>>").alias("rows"), "section_no",
        )
        placed_items = placed_items.unionByName(of_images)
    number = F.row_number().over(W.partitionBy("doc_id", "section_no").orderBy("order"))
    return found, placed_items.withColumn("item_no", number).select("doc_id", "section_no", "item_no", *ITEM[3:])


def carried_title(lines: DataFrame) -> DataFrame:
    """doc_id, page, title: the first section header of the latest earlier page that has one; null before any."""
    firsts = lines.groupBy(*PAGE).agg(F.min_by(F.when(F.col("header_level") == "section_header", F.col("text")), F.when(F.col("header_level") == "section_header", F.col("line_no"))).alias("t"))
    before = W.partitionBy("doc_id").orderBy("page").rowsBetween(W.unboundedPreceding, -1)
    return firsts.select(*PAGE, F.last("t", ignorenulls=True).over(before).alias("title"))


def table_owner(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """doc_id, page, table_id, pos, grp: the first line in reading order on a table's page that lies at or below its top
    owns the table; grp counts the headers strictly before that line. Tables below all lines have pos and grp null."""
    header = (F.col("header_level") == "section_header").cast("int")
    placed = header_groups(lines).withColumn("before", F.col("grp") - header)
    tops = tables.select(*PAGE, "table_id", F.col("y0").alias("top"))
    first = tops.join(placed.select(*PAGE, "pos", "y0", "before"), [*PAGE]).where("y0 >= top").groupBy(*PAGE, "table_id").agg(
        F.min("pos").alias("pos"), F.min_by("before", "pos").alias("grp")
    )
    return tops.select(*PAGE, "table_id").join(first, [*PAGE, "table_id"], "left")


def image_section(images: DataFrame, sections: DataFrame) -> DataFrame:
    """``images`` columns doc_id, image_id, page with section_id: the first section (by section_no) whose pages hold the
    image's; images on no section's page are left out. ``page`` is 0-based, section pages count from 1.

    The first section of every page is found from the sections, a row for each page they span, and joined by page: a
    long document's images never meet all of its sections."""
    spans = sections.where("page_start <= page_end").select("doc_id", F.struct("section_no", "section_id").alias("s"), F.explode(F.sequence("page_start", "page_end")).alias("_page"))
    first = spans.groupBy("doc_id", "_page").agg(F.min("s").alias("s")).select("doc_id", (F.col("_page") - 1).alias("page"), F.col("s.section_id").alias("section_id"))
    return images.select("doc_id", "image_id", "page").distinct().join(first, ["doc_id", "page"]).select("doc_id", "image_id", "page", "section_id")


def section_text(items: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """doc_id, section_no, text_plain of the items of ``segment``: subheaders after a blank line; a blank line where the column,
    the page or more than ``paragraph_gap`` of a line's own height lies between two lines; tables as grids between blank
    lines; recognised text of images behind "[OCR]"."""
    line = F.col("type").isin("text", "subheader")
    order = W.partitionBy("doc_id", "section_no").orderBy("item_no").rowsBetween(W.unboundedPreceding, -1)
    last = F.last(F.when(line, F.struct("column_id", "page", "y1")), ignorenulls=True).over(order)
    height = F.col("y1") - F.col("y0")
    far = (F.col("page") == last["page"]) & (height > 0) & (F.col("y0") - last["y1"] > config.paragraph_gap * height)
    gap = (F.col("column_id") != last["column_id"]) | (F.col("page") != last["page"]) | far
    t = F.btrim("text")
    grid = F.when((F.size("columns") > 0) | (F.size("rows") > 0), F.concat(F.lit("\n"), X.table_grid(F.coalesce("columns", F.array().cast("array<string>")), F.coalesce("rows", F.array().cast("array<array<string>>"))), F.lit("\n")))
    part = (
        F.when(F.col("type") == "table_text", grid)
        .when(F.col("type") == "image_ocr", F.when(t != "", F.concat(F.lit("\n[OCR] "), t)))
        .when((F.col("type") == "subheader") | F.coalesce(gap, F.lit(False)), F.concat(F.lit("\n"), t))
        .otherwise(t)
    )
    parts = items.select("doc_id", "section_no", F.struct("item_no", part.alias("part")).alias("p")).where("p.part is not null or p.item_no = 1")
    text = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["part"]), "\n")
    return parts.groupBy("doc_id", "section_no").agg(F.regexp_replace(text, r"^\s+|\s+$", "").alias("text_plain"))


def page_density(lines: DataFrame, area: Column, config: Config = DEFAULT) -> DataFrame:
    """doc_id, page, chars, sparse (characters per area below the limit)."""
    pages = lines.groupBy(*PAGE).agg(F.sum(F.length(F.btrim("text"))).alias("chars"), area.alias("area"))
    return pages.select(*PAGE, "chars", (F.col("area") > 0).__and__(F.col("chars") / F.col("area") < config.sparse_page_density).alias("sparse"))
