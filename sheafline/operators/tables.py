"""Tables from runs of table-like lines, and facts about tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sheafline.config import DEFAULT, Config
from sheafline.operators.lines import PAGE, visual_rows

BLOCK = (
    "doc_id STRING, page INT, column_id INT, run INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, "
    "columns ARRAY<STRING>, rows ARRAY<ARRAY<STRING>>"
)


def table_runs(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """The lines of visual rows that are wholly table-like, with ``run``: rows of a column that follow each other."""
    rows = visual_rows(lines, gap=config.row_gap)
    row = W.partitionBy(*PAGE, "column_id", "row_no")
    whole = rows.withColumn("_all", F.bool_and(F.coalesce("is_table_like", F.lit(False))).over(row)).where("_all").drop("_all")
    column = W.partitionBy(*PAGE, "column_id").orderBy("row_no")
    whole = whole.withColumn("run", (F.col("row_no") - F.dense_rank().over(column)).cast("int"))
    return whole.withColumn("_first", F.min("row_no").over(W.partitionBy(*PAGE, "column_id", "run"))).withColumn(
        "_rows", F.max("row_no").over(W.partitionBy(*PAGE, "column_id", "run")) - F.col("_first") + 1
    ).where(F.col("_rows") >= config.table_rows).drop("_first", "_rows")


def table_blocks(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One row per table (``BLOCK`` and table_id): the first row names the columns.

    A row with fewer cells than the one it would continue, all of them below one of its cells, is merged into it cell by
    cell; that depends on the rows merged before, so each run (a few rows of one column of one page) is folded by itself."""
    shift, least = config.cell_shift, config.table_rows

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        merged: list[list[list]] = []
        for _, row in group.groupby("row_no", sort=True):
            cells = [[x, t or ""] for x, t in zip(row["x0"], row["text"])]
            above = merged[-1] if merged else []
            if above and len(cells) < len(above) and all(any(abs(c[0] - a[0]) <= shift for a in above) for c in cells):
                for c in cells:
                    into = min(above, key=lambda a: abs(a[0] - c[0]))
                    into[1] = f"{into[1].rstrip()} {c[1].strip()}"
            else:
                merged.append(cells)
        if len(merged) < least:
            return pd.DataFrame(columns=[c.split()[0] for c in BLOCK.split(", ")])
        grid = [[t for _, t in sorted(r, key=lambda c: c[0])] for r in merged]
        head = group.iloc[0]
        return pd.DataFrame(
            [[head["doc_id"], head["page"], head["column_id"], head["run"], group["x0"].min(), group["y0"].min(), group["x1"].max(), group["y1"].max(), grid[0], grid[1:]]],
            columns=[c.split()[0] for c in BLOCK.split(", ")],
        )

    def ordered(group: pd.DataFrame) -> pd.DataFrame:
        return fold(group.sort_values(["row_no", "y0", "x0", "line_no"], kind="stable"))

    runs = table_runs(lines, config).select(*PAGE, "column_id", "run", "row_no", "line_no", "text", "x0", "y0", "x1", "y1")
    found = runs.groupBy(*PAGE, "column_id", "run").applyInPandas(ordered, BLOCK)
    number = F.row_number().over(W.partitionBy(*PAGE).orderBy("column_id", "run"))
    return found.withColumn("table_id", F.format_string("table_p%d_%d", F.col("page") + 1, number))


def first_source(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Tables of ``primary``; those of ``fallback`` only on pages where it has none."""
    return primary.unionByName(fallback.join(primary.select(*PAGE).distinct(), [*PAGE], "left_anti"), allowMissingColumns=True)


def lines_in_tables(lines: DataFrame, tables: DataFrame, reach: float = 0.0) -> DataFrame:
    """``lines`` with in_table and table_top: the y0 of the first table (smallest table_id) of the page whose box, widened by
    ``reach``, holds the line; null where none does."""
    boxes = tables.select(*PAGE, "table_id", *(F.col(c).alias(f"t{c}") for c in ("x0", "y0", "x1", "y1")))
    inside = (
        (F.col("x0") >= F.col("tx0") - reach) & (F.col("y0") >= F.col("ty0") - reach) & (F.col("x1") <= F.col("tx1") + reach) & (F.col("y1") <= F.col("ty1") + reach)
    )
    held = lines.select(*PAGE, "line_no", "x0", "y0", "x1", "y1").join(boxes, [*PAGE]).where(inside)
    first = held.groupBy(*PAGE, "line_no").agg(F.min_by("ty0", "table_id").alias("table_top"))
    return lines.join(first, [*PAGE, "line_no"], "left").withColumn("in_table", F.col("table_top").isNotNull())


def footer_like(cell: Column) -> Column:
    """A cell that reads like a page footer: a code, letters of a Roman number, digits only."""
    t = F.btrim(F.coalesce(cell, F.lit("")))
    return t.rlike(r"^[A-Z0-9\-]{6,}$") | F.lower(t).rlike("^[ivxlcdm]+$") | t.rlike("^[0-9]+$")


def table_facts(tables: DataFrame, key: list[str]) -> DataFrame:
    """``key``, n_rows, n_columns, longest (cell), odd (too wide or a very long cell), footer (a footer-like cell or name)."""
    columns = F.coalesce("columns", F.array().cast("array<string>"))
    rows = F.filter(F.coalesce("rows", F.array().cast("array<array<string>>")), lambda r: r.isNotNull())
    cells = F.concat(columns, F.flatten(rows))
    widest = F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))
    longest = F.coalesce(F.array_max(F.transform(cells, lambda c: F.length(F.coalesce(c, F.lit(""))))), F.lit(0))
    return tables.select(
        *key,
        F.size(rows).alias("n_rows"),
        F.size(columns).alias("n_columns"),
        longest.alias("longest"),
        ((F.size(columns) > 6) | (widest > 8) | (longest > 120)).alias("odd"),
        F.exists(cells, footer_like).alias("footer"),
    )
