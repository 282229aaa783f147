"""Entries of tables of contents, by the three ways they are laid out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from sheafline.config import CONTENTS_TITLES, DEFAULT, DOT_LEADER, Config
from sheafline.functions import text as X
from sheafline.operators.lines import PAGE, anchored_rows, index_page, upper_median
from sheafline.session import cut

ENTRY = ["doc_id", "page", "line_no", "title", "target_page", "path"]


def line_entries(lines: DataFrame) -> DataFrame:
    """Entries that are one line: a title, dots and a number, or a title whose number the reader set apart."""
    title = F.btrim(F.regexp_extract("text", DOT_LEADER, 1))
    dotted = F.col("text").rlike(DOT_LEADER)
    apart = F.btrim(F.regexp_replace("text", r"\s+[0-9]{1,4}\s*$", ""))
    found = lines.where(dotted | F.col("toc_page_number").isNotNull()).select(
        *PAGE,
        "line_no",
        F.when(dotted, title).otherwise(apart).alias("title"),
        F.when(dotted, F.regexp_extract("text", DOT_LEADER, 2).try_cast("int")).otherwise(F.col("toc_page_number").cast("int")).alias("target_page"),
        F.lit("line").alias("path"),
    )
    return found.where("title <> ''")


def spatial_entries(lines: DataFrame) -> DataFrame:
    """Entries whose titles and numbers are lines of their own: a number takes the titles on its row, left of it, and the
    wrapped lines above them back to the number before."""
    text = F.btrim("text")
    only = text.rlike("^[0-9]{1,4}$")
    numbers = lines.where(only).select(*PAGE, "line_no", "x0", "y0", text.try_cast("int").alias("target_page"))
    middle = numbers.groupBy(*PAGE).agg(upper_median().alias("mid"), F.count("*").alias("n")).where("n >= 3").select(*PAGE, "mid")
    numbers = numbers.join(middle, [*PAGE]).where(F.abs(F.col("x0") - F.col("mid")) < 60)
    page = W.partitionBy(*PAGE).orderBy("y0", "line_no")
    numbers = numbers.withColumn("above", F.coalesce(F.lag("y0").over(page), F.lit(-1e9)))
    numbers = numbers.withColumn("n", F.count("*").over(W.partitionBy(*PAGE))).where("n >= 3")
    headed = X.normalize_title(F.col("text")).isin(*CONTENTS_TITLES) & (F.col("y0") <= 300)
    titles = lines.where(~only & (F.length(text) >= 3) & ~headed).join(middle, [*PAGE]).where("x0 < mid")
    edge = titles.groupBy(*PAGE).agg(upper_median().alias("edge"))
    titles = titles.join(edge, [*PAGE]).where(F.abs(F.col("x0") - F.col("edge")) < 30)
    titles = titles.select(*PAGE, F.col("line_no").alias("t_no"), F.col("x0").alias("tx"), F.col("x1").alias("tx1"), F.col("y0").alias("ty"), text.alias("t"))
    pairs = numbers.join(titles, [*PAGE]).where(F.col("ty") > F.col("above") + 1)
    direct = pairs.where((F.abs(F.col("ty") - F.col("y0")) <= 3) & (F.col("tx1") <= F.col("x0") + 5))
    heads = direct.groupBy(*PAGE, "line_no").agg(F.min("ty").alias("top"), F.min("tx").alias("left"))
    taken = numbers.select(*PAGE, F.col("y0").alias("ny"))
    rest = pairs.join(heads, [*PAGE, "line_no"]).where(
        (F.col("ty") < F.col("top") - 1) & (F.abs(F.col("tx") - F.col("left")) < 10) & ~F.col("t").rlike(r"(^|\s)[0-9]{1,4}$")
    )
    own = titles.join(taken, [*PAGE]).where(F.abs(F.col("ny") - F.col("ty")) <= 3).select(*PAGE, "t_no")
    wrapped = rest.join(own, [*PAGE, "t_no"], "left_anti")
    cols = [*PAGE, "line_no", "target_page", "t", "t_no", "ty", "tx"]
    parts = wrapped.select(*cols, F.lit(0).alias("late")).unionByName(direct.select(*cols, F.lit(1).alias("late")))
    order = F.when(F.col("late") == 0, F.col("ty")).otherwise(F.col("tx"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("late", order.alias("o"), "t_no", "t"))), lambda p: p["t"]), " ")
    entries = parts.groupBy(*PAGE, "line_no", "target_page").agg(whole.alias("title"), F.max("late").alias("late"))
    return entries.where("late = 1").select(*PAGE, "line_no", "title", "target_page", F.lit("spatial").alias("path"))


def row_entries(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Entries whose title and number stand on one row far apart; rows with a line that is an entry by itself are left out."""
    text = F.btrim("text")
    rows = anchored_rows(lines, reach=config.row_anchor).join(
        lines.select(*PAGE, "line_no", "x0", "x1", text.alias("t"), text.rlike("^[0-9]{1,3}$").alias("number")), [*PAGE, "line_no"]
    )
    handled = line_entries(lines).select(*PAGE, "line_no", F.lit(True).alias("handled"))
    width = lines.groupBy(*PAGE).agg(F.max("x1").alias("width"))
    word = ~F.col("number") & (F.length("t") >= 3)
    whole = rows.join(handled, [*PAGE, "line_no"], "left").groupBy(*PAGE, "row_no").agg(
        F.coalesce(F.bool_or("handled"), F.lit(False)).alias("handled"),
        F.max(F.when(F.col("number"), F.struct("x0", "line_no", "t"))).alias("right"),
        F.min(F.when(word, F.struct("x0", "line_no", "x1"))).alias("left"),
        F.array_sort(F.collect_list(F.when(word, F.struct("x0", "line_no", "x1", "t")))).alias("words"),
    )
    fits = F.filter("words", lambda w: w["x1"] <= F.col("right.x0") + 5)
    found = whole.join(width, [*PAGE]).where(~F.col("handled") & (F.col("right.x0") - F.col("left.x1") > 0.10 * F.col("width")) & (F.size(fits) > 0))
    return found.select(
        *PAGE,
        F.col("right.line_no").alias("line_no"),
        F.array_join(F.transform(fits, lambda w: w["t"]), " ").alias("title"),
        F.col("right.t").try_cast("int").alias("target_page"),
        F.lit("row").alias("path"),
    )


def contents_entries(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Entries of all index pages: spatial ones if a page has any, else those of single lines and rows."""
    pages = index_page(lines, config).where("is_index").select(*PAGE)
    # A few pages of a document, read by each of the three ways.
    on = cut(lines.join(pages, [*PAGE], "left_semi"))
    spatial = spatial_entries(on)
    other = line_entries(on).unionByName(row_entries(on, config)).join(spatial.select(*PAGE).distinct(), [*PAGE], "left_anti")
    return spatial.unionByName(other).select(*ENTRY)
