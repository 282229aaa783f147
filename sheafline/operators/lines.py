"""Page layout from positioned lines: visual rows, table-like runs, columns, body font, header scores and levels.

All operators take and return a ``lines`` frame keyed (doc_id, page, line_no). Windows and groups are per page (the
vertical rows of one column of a page), so no document, however long, meets in one task. Ties follow ``line_no``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sheafline.config import CONTENTS_TITLES, DEFAULT, HEADER_SHAPES, INDEX_LINE, NUMBERED, SECTION_STARTS, Config
from sheafline.functions import text as X
from sheafline.session import cut

PAGE = ("doc_id", "page")


def latest_lines(lines: DataFrame) -> DataFrame:
    """One row per line: redeliveries of an item count once, the latest of them (ties: the smallest text)."""
    at = W.partitionBy("doc_id", "page", "line_no").orderBy(F.desc("ingested_at"), "line_uid", "text")
    return lines.withColumn("_n", F.row_number().over(at)).where("_n = 1").drop("_n")


def visual_rows(lines: DataFrame, by: tuple[str, ...] = (*PAGE, "column_id"), gap: float = DEFAULT.row_gap) -> DataFrame:
    """Adds ``row_no`` (from 1, per group): a line further than ``gap`` below the line before it begins a row.

    Chained: a row may be taller than ``gap``. Lines with null y0 form the group's first row."""
    order = W.partitionBy(*by).orderBy("y0", "x0", "line_no")
    new = F.when(F.abs(F.col("y0") - F.lag("y0").over(order)) <= gap, 0).otherwise(1)
    return lines.withColumn("_new", new).withColumn("row_no", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def anchored_rows(lines: DataFrame, by: tuple[str, ...] = PAGE, reach: float = DEFAULT.row_anchor) -> DataFrame:
    """doc_id, page, row_no, line_no: a line further than ``reach`` from its row's *first* line begins a row.

    What a row's first line is depends on the rows before it, hence a fold over the page's sorted lines."""
    line = F.struct(F.round("y0", 1).alias("y"), F.round("x0", 1).alias("x"), "line_no", "y0")
    start = F.struct(F.lit(None).cast("double").alias("first"), F.lit(0).alias("row"), F.array().cast("array<struct<row_no:int,line_no:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        same = F.coalesce(F.abs(x["y0"] - acc["first"]) <= reach, F.lit(False))
        row = F.when(same, acc["row"]).otherwise(acc["row"] + 1).cast("int")
        return F.struct(
            F.when(same, acc["first"]).otherwise(x["y0"]).alias("first"),
            row.alias("row"),
            F.concat(acc["out"], F.array(F.struct(row.alias("row_no"), x["line_no"].cast("int").alias("line_no")))).alias("out"),
        )

    pages = lines.groupBy(*by).agg(F.array_sort(F.collect_list(line)).alias("l"))
    return pages.select(*by, F.inline(F.aggregate("l", start, step, lambda a: a["out"])))


def row_flags(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One row per visual row of each column: place among the page's rows (``pos``), cells, and whether it reads like a
    table row (two or more lines of at most ``cell_words`` words)."""
    cells = visual_rows(lines, gap=config.row_gap)
    short = F.count_if(X.word_count(F.col("text")) <= config.cell_words)
    rows = cells.groupBy(*PAGE, "column_id", "row_no").agg(
        F.min("y0").alias("top"), F.min("x0").alias("left"), F.count("*").alias("cells"), short.alias("short_cells")
    )
    pos = F.row_number().over(W.partitionBy(*PAGE).orderBy("top", "left", "column_id", "row_no"))
    return rows.withColumn("flag", (F.col("cells") >= 2) & (F.col("short_cells") >= 2)).withColumn("pos", pos)


def row_islands(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Adds ``streak`` (length of the run of equal flags a row is in) and ``table_like`` (flagged, in a run of enough)."""
    page = W.partitionBy(*PAGE).orderBy("pos")
    alike = W.partitionBy(*PAGE, "flag").orderBy("pos")
    runs = rows.withColumn("run", F.row_number().over(page) - F.row_number().over(alike))
    streak = F.count("*").over(W.partitionBy(*PAGE, "flag", "run"))
    return runs.withColumn("streak", streak).withColumn("table_like", F.col("flag") & (F.col("streak") >= config.table_rows))


def mark_table_like(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """``lines`` with ``is_table_like`` set anew from the runs of table rows."""
    rows = row_islands(row_flags(lines, config), config).select(*PAGE, "column_id", "row_no", F.col("table_like").alias("is_table_like"))
    return visual_rows(lines.drop("is_table_like"), gap=config.row_gap).join(rows, [*PAGE, "column_id", "row_no"]).drop("row_no")


def split_points(lines: DataFrame, width: Column | None = None, config: Config = DEFAULT) -> DataFrame:
    """doc_id, page, splits: middles of the widest gaps between left edges, at most two, of pages that have any.

    Left edges are those of prose lines where a page has enough of them, else of all lines. ``width`` is an aggregate
    over a page's lines (the largest x1 by default)."""
    prose = ~F.coalesce("is_table_like", F.lit(False))
    counted = lines.withColumn("_prose", F.count_if(prose).over(W.partitionBy(*PAGE)))
    anchors = counted.where((F.col("_prose") < config.prose_lines) | prose)
    pages = lines.groupBy(*PAGE).agg((F.max("x1") if width is None else width).alias("width"))
    xs = anchors.select(*PAGE, F.bround("x0", 0).alias("x")).where("x is not null").distinct()
    page = W.partitionBy(*PAGE).orderBy("x")
    gaps = xs.withColumns({"next": F.lead("x").over(page), "edges": F.count("*").over(W.partitionBy(*PAGE))}).join(pages, [*PAGE])
    wide = gaps.where((F.col("edges") >= 3) & (F.col("next") - F.col("x") >= F.col("width") * config.column_gap))
    rank = F.row_number().over(W.partitionBy(*PAGE).orderBy(F.desc(F.col("next") - F.col("x")), "x"))
    kept = wide.withColumn("_n", rank).where(F.col("_n") < config.max_columns)
    return kept.groupBy(*PAGE).agg(F.array_sort(F.collect_list((F.col("x") + F.col("next")) / 2)).alias("splits"), F.first("width").alias("width"))


def detect_columns(lines: DataFrame, width: Column | None = None, config: Config = DEFAULT) -> DataFrame:
    """``lines`` with ``column_id`` set anew: both splits, else the left one, if every column holds enough anchor lines, else
    one column. Table-like lines go to the column whose centre is nearest."""
    prose = ~F.coalesce("is_table_like", F.lit(False))
    base = lines.drop("column_id").join(split_points(lines, width, config), [*PAGE], "left")
    base = base.withColumn("_prose", F.count_if(prose).over(W.partitionBy(*PAGE)))
    anchor = (F.col("_prose") < config.prose_lines) | prose
    of = lambda splits: F.size(F.filter(splits, lambda s: F.col("x0") >= s))
    first = F.slice("splits", 1, 1)
    page = W.partitionBy(*PAGE)
    share = lambda k, splits: F.count_if(anchor & (of(splits) == k)).over(page) / F.count_if(anchor).over(page)
    least = config.column_share
    both_ok = (F.size("splits") == 2) & F.least(*(share(k, F.col("splits")) for k in range(3))).__ge__(least)
    one_ok = (F.size("splits") >= 1) & F.least(*(share(k, first) for k in range(2))).__ge__(least)
    active = F.when(both_ok, F.col("splits")).when(one_ok, first)
    placed = base.withColumn("_splits", active)
    bounds = F.concat(F.array(F.lit(0.0)), F.col("_splits"), F.array(F.col("width")))
    centres = F.zip_with(F.slice(bounds, F.lit(1), F.size(bounds) - 1), F.slice(bounds, F.lit(2), F.size(bounds) - 1), lambda a, b: (a + b) / 2)
    nearest = F.array_min(F.transform(centres, lambda c, i: F.struct(F.abs(F.col("x0") - c), i.alias("i"))))["i"]
    column = F.when(F.col("_splits").isNull(), 0).when(F.coalesce("is_table_like", F.lit(False)), nearest).otherwise(of(F.col("_splits")))
    return placed.withColumn("column_id", column.cast("int")).drop("splits", "width", "_prose", "_splits")


def body_font(lines: DataFrame) -> DataFrame:
    """doc_id, page, body_size, body_font of every page: the usual size (to 0.1, positive ones) and font (of lines that
    aren't bold, else of all), of equally frequent ones the one met first; 0 and '' where none is known.

    Every line counts once for its page, size, plain font and font, so one count and one choice by page give all of them."""
    size, name = F.round("font_size_avg", 1), F.when(F.coalesce("font_name", F.lit("")) != "", F.col("font_name"))
    no_size, no_name = F.lit(None).cast("double"), F.lit(None).cast("string")
    vote = lambda kind, v, f: F.struct(F.lit(kind).alias("kind"), v.alias("v"), f.alias("f"))
    votes = F.array(
        vote("page", no_size, no_name),
        F.when(F.col("font_size_avg") > 0, vote("size", size, no_name)),
        F.when(~F.coalesce("is_bold", F.lit(False)), vote("plain", no_size, name)),
        vote("any", no_size, name),
    )
    counts = lines.select(*PAGE, "line_no", F.explode(votes).alias("vote")).where("vote is not null").groupBy(*PAGE, "vote").agg(F.count("*").alias("n"), F.min("line_no").alias("first"))
    usual = lambda kind, value: F.max_by(f"vote.{value}", F.when((F.col("vote.kind") == kind) & F.col(f"vote.{value}").isNotNull(), F.struct("n", -F.col("first"))))
    modes = counts.groupBy(*PAGE).agg(usual("size", "v").alias("size"), usual("plain", "f").alias("plain"), usual("any", "f").alias("any"))
    return modes.select(*PAGE, F.coalesce("size", F.lit(0.0)).alias("body_size"), F.coalesce("plain", "any", F.lit("")).alias("body_font"))


def upper_median(x: str = "x0") -> Column:
    """Aggregate: the element at n // 2 of the sorted values."""
    xs = F.array_sort(F.collect_list(x))
    return F.element_at(xs, (F.size(xs) / 2).cast("int") + 1)


def index_page(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """doc_id, page, is_index: pages whose lines end in dotted page numbers or carry contents numbers often enough, or that
    bear a contents title over rows of titles and numbers."""
    text = F.btrim("text")
    number = text.rlike("^[0-9]{1,3}$")
    entry = F.coalesce(F.col("text").rlike(INDEX_LINE), F.lit(False)) | F.col("toc_page_number").isNotNull()
    title = X.normalize_title(F.col("text")).isin(*CONTENTS_TITLES) & (F.col("y0") <= 300)
    only = text.rlike("^[0-9]{1,4}$")
    middle = F.collect_list(F.when(only, F.col("x0")))
    pages = lines.groupBy(*PAGE).agg(
        F.avg(entry.cast("int")).alias("share"), F.bool_or(title).alias("titled"), F.max("x1").alias("width"), F.array_sort(middle).alias("numbers")
    )
    # One row per page, read three times below. Rows matter only on pages that bear a contents title.
    pages = cut(pages)
    bearing = lines.join(pages.where("titled").select(*PAGE), [*PAGE], "left_semi")
    rows = anchored_rows(bearing, reach=config.row_anchor).join(bearing.select(*PAGE, "line_no", "x0", "x1", text.alias("t"), number.alias("number")), [*PAGE, "line_no"])
    word = ~F.col("number") & (F.length("t") >= 3)
    per_row = rows.groupBy(*PAGE, "row_no").agg(
        F.max(F.when(F.col("number"), F.col("x0"))).alias("right"),
        F.min_by(F.when(word, F.col("x1")), F.when(word, F.struct("x0", "line_no"))).alias("left"),
    )
    wide = per_row.join(pages.select(*PAGE, "width"), [*PAGE]).where(F.col("right") - F.col("left") > 0.10 * F.col("width"))
    toc_rows = wide.groupBy(*PAGE).agg(F.count("*").alias("toc_rows"))
    median = F.element_at("numbers", (F.size("numbers") / 2).cast("int") + 1)
    spatial = F.when(F.size("numbers") >= 3, F.size(F.filter("numbers", lambda x: F.abs(x - median) < 60)) >= 3).otherwise(False)
    judged = pages.join(toc_rows, [*PAGE], "left")
    titled = F.coalesce("titled", F.lit(False)) & ((F.coalesce("toc_rows", F.lit(0)) >= 5) | spatial)
    return judged.select(*PAGE, ((F.col("share") >= config.index_share) | titled).alias("is_index"))


def scored(lines: DataFrame, table_count: Column) -> DataFrame:
    """``lines`` (with body_size and body_font) and ``header_score``: exclusions, then the titles that always are, then points.

    What several rules ask for is a column of its own first, so that it is computed once and the rules stay one short
    expression."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), f"^{X.SPACES}|{X.SPACES}$", "")
    facts = lines.withColumn("_t", text).withColumns(
        {
            "_n": X.word_count(F.col("_t")),
            "_bold": F.coalesce("is_bold", F.lit(False)),
            "_upper": F.coalesce("is_upper", F.lit(False)),
            "_larger": F.coalesce(F.col("font_size_avg") > F.col("body_size") + 0.5, F.lit(False)),
            "_numbered": F.col("_t").rlike(NUMBERED),
            "_shaped": F.col("_t").rlike(HEADER_SHAPES[0]) | F.col("_t").rlike(HEADER_SHAPES[1]),
            "_starts": F.slice(X.words(X.normalize_title(F.col("_t"))), 1, 2),
        }
    )
    text, n, bold, upper, larger, numbered, shaped, starts = (F.col(c) for c in ("_t", "_n", "_bold", "_upper", "_larger", "_numbered", "_shaped", "_starts"))
    body_size, body_name = F.col("body_size"), F.col("body_font")
    first, second = F.get(starts, F.lit(0)), F.array_join(starts, " ")
    never = (
        (text == "")
        | text.rlike(INDEX_LINE)
        | (F.length(text) <= 2) & ~text.rlike(r"^[0-9]+(\.[0-9]+)*$")
        | text.rlike("^[0-9]+$")
        | F.lower(text).rlike("^[ivxlcdm]+$")
        | text.rlike(r"^[A-Z0-9\-]{6,}$") & ~(bold | (body_size > 0) & larger)
        | text.rlike("^[A-Z]{1,4}[0-9]{1,4}$")
        | text.rlike(r"^\(?[A-Z]\)?$")
        | text.rlike(r"^[•\-*▪]")
        | text.rlike(r"^[a-zA-Z]\)(\s|$)")
        | F.lower(text).rlike(r"(^|[^\p{L}\p{N}_])(of the|of|and|or|the|a)\s*$")
    )
    points = lambda condition, k: F.when(condition, k).otherwise(0)
    score = (
        F.when(~F.coalesce("is_table_like", F.lit(False)), 0).when(bold & upper, -2).otherwise(-6)
        + points((table_count > 2) & ~numbered, -4)
        + points(n > 18, -3)
        + points(text.rlike(r"^[0-9]+\.\s") & ~numbered, -2)
        + points(text.rlike(r"^[A-Z0-9\-.\[\]/]+$") & (n <= 3), -3)
        + points((n <= 3) & ~upper & ~F.endswith(text, F.lit(":")), -3)
        + points((n <= 2) & ~upper & ~shaped, -2)
        + points((F.col("y0") > 400) & (n <= 3) & ~numbered, -3)
        + points(larger, 3)
        + points(bold, 2)
        + points((body_name != "") & (F.coalesce("font_name", F.lit("")) != "") & (F.col("font_name") != body_name), 2)
        + points(upper, 2)
        + points(n.between(1, 10), 1)
        + points(F.endswith(text, F.lit(":")), 1)
        + points(~F.endswith(text, F.lit(".")), 1)
        + points(shaped, 2)
        + points(numbered, 1)
    )
    always = (n <= 10) & (first.isin(*SECTION_STARTS) | second.isin(*SECTION_STARTS))
    done = facts.withColumn("header_score", F.when(never, -999).when(always, 10).otherwise(score).cast("int"))
    return done.drop("_t", "_n", "_bold", "_upper", "_larger", "_numbered", "_shaped", "_starts")


def header_levels(lines: DataFrame, tables: DataFrame | None = None, config: Config = DEFAULT) -> DataFrame:
    """``lines`` with ``header_score`` and ``header_level`` set anew.

    Pages that are an index have no headers. Thresholds fall by one on a page whose best line misses the section threshold by
    one, and rise on pages of few lines. ``tables`` (doc_id, page) tells how many tables a page holds."""
    page = W.partitionBy(*PAGE)
    base = lines.drop("header_score", "header_level").join(body_font(lines), [*PAGE]).join(index_page(lines, config), [*PAGE])
    count = F.lit(0)
    if tables is not None:
        base = base.join(tables.groupBy(*PAGE).agg(F.count("*").alias("_tables")), [*PAGE], "left")
        count = F.coalesce("_tables", F.lit(0))
    marked = scored(base, count).withColumn("header_score", F.when(F.col("is_index"), -999).otherwise(F.col("header_score")))
    best = F.max(F.when(F.col("header_score") > 0, F.col("header_score"))).over(page)
    near = best == config.section_score - 1
    few = F.count("*").over(page) < config.sparse_lines
    section = F.greatest(F.when(near, best).otherwise(config.section_score), F.when(few, config.section_score + 3).otherwise(0))
    sub = F.greatest(F.when(near, F.greatest(F.lit(1), best - 1)).otherwise(config.subheader_score), F.when(few, config.subheader_score + 2).otherwise(0))
    limits = marked.withColumns({"_section": section, "_sub": sub})
    level = F.when(F.col("is_index"), "non_header").when(F.col("header_score") >= F.col("_section"), "section_header")
    level = level.when(F.col("header_score") >= F.col("_sub"), "subheader").otherwise("non_header")
    return limits.withColumn("header_level", level).drop("_section", "_sub", "body_size", "body_font", "is_index", "_tables")
