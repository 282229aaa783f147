"""Sources of documents and lines: files of records, plain text, HTML, and PDF where a reader is installed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from sheafline.functions import text as X

#: The lines contract: what every layout operator reads.
LINE_SCHEMA = (
    "doc_id STRING, page INT, line_no INT, text STRING, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, font_size_avg DOUBLE, "
    "is_bold BOOLEAN, is_upper BOOLEAN, font_name STRING, column_id INT, header_level STRING, is_table_like BOOLEAN, toc_page_number INT"
)


def json_files(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(documents, unreadable): one row per JSON file under ``path``; unreadable files give their path only."""
    wide = f"{schema}, _corrupt_record STRING"
    raw = spark.read.schema(wide).option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json").json(path)
    raw = raw.withColumn("path", F.input_file_name())
    good = raw.where("_corrupt_record is null").drop("_corrupt_record")
    return good, raw.where("_corrupt_record is not null").select("path")


def spans_to_lines(spans: DataFrame) -> DataFrame:
    """Lines from text spans (doc_id, page, line_no, span_no, text, x0, y0, x1, y1, size, flags, font): box around all,
    mean of the known sizes, bold by flag or font name, the most frequent font (the first of equals), upper case by
    share of letters, and a number of one to four digits standing far right as the line's page number. Blank lines go."""
    bold_name = F.lower(F.coalesce("font", F.lit(""))).rlike("bold|black|heavy|demi")
    by = ["doc_id", "page", "line_no"]
    fonts = spans.where("font <> ''").groupBy(*by, F.lower("font").alias("f")).agg(F.count("*").alias("n"), F.min("span_no").alias("first"))
    font = fonts.groupBy(*by).agg(F.max_by("f", F.struct("n", -F.col("first"))).alias("font_name"))
    ordered = F.array_sort(F.collect_list(F.struct("span_no", "text", "x0", "x1")))
    lines = spans.groupBy(*by).agg(
        ordered.alias("s"), *(F.min(c).alias(c) for c in ("x0", "y0")), *(F.max(c).alias(c) for c in ("x1", "y1")),
        F.coalesce(F.avg(F.when(F.col("size") > 0, F.col("size"))), F.lit(0.0)).alias("font_size_avg"),
        F.bool_or(F.col("flags").bitwiseAND(F.lit(16)).__ne__(0) | bold_name).alias("is_bold"),
    )
    text = X.clean_text(F.array_join(F.transform("s", lambda s: s["text"]), " "))
    last = F.element_at("s", -1)
    before = F.array_max(F.transform(F.slice("s", F.lit(1), F.greatest(F.size("s") - 1, F.lit(0))), lambda s: s["x1"]))
    width = F.col("x1") - F.col("x0")
    apart = (F.size("s") >= 2) & F.btrim(last["text"]).rlike("^[0-9]{1,4}$") & (last["x0"] - before > 15) & ((last["x0"] - F.col("x0")) / width > 0.4)
    done = lines.withColumns({"text": text, "toc_page_number": F.when(apart, F.btrim(last["text"]).try_cast("int"))}).where("text <> ''")
    done = done.withColumns({"is_upper": X.is_upper(F.col("text")), "column_id": F.lit(0), "header_level": F.lit("non_header"), "is_table_like": F.lit(False)})
    return done.join(font, by, "left").withColumn("font_name", F.coalesce("font_name", F.lit(""))).drop("s")


def text_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", page_lines: int = 40) -> DataFrame:
    """Plain text as lines on pages of ``page_lines``, 12 points apart; null and empty texts have none."""
    each = documents.where(F.col(text) != "").select(F.col(doc_id).cast("string").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("n", "t"))
    y = F.lit(72.0) + 12.0 * (F.col("n") % page_lines)
    return each.select(
        "doc_id", F.floor(F.col("n") / page_lines).cast("int").alias("page"), F.col("n").alias("line_no"), F.col("t").alias("text"), F.lit(72.0).alias("x0"), y.alias("y0"),
        (F.lit(72.0) + 5.0 * F.length("t")).alias("x1"), (y + 10.0).alias("y1"), F.lit(10.0).alias("font_size_avg"), F.lit(False).alias("is_bold"),
        X.is_upper(F.col("t")).alias("is_upper"), F.lit("").alias("font_name"), F.lit(0).alias("column_id"), F.lit("non_header").alias("header_level"),
        F.lit(False).alias("is_table_like"), F.lit(None).cast("int").alias("toc_page_number"),
    ).where(F.btrim("text") != "")


def html_lines(pages: DataFrame, doc_id: str, html: str) -> DataFrame:
    """HTML as lines: scripts, styles, navigation and footers dropped, block elements as breaks, h1 to h3 bold and larger."""
    t = F.col(html)
    for pattern, to in (
        (r"(?is)<!--.*?-->|<(script|style|nav|head|footer)\b.*?</\1\s*>", ""), (r"\s+", " "), (r"(?i)<h[1-3]\b[^>]*>", "\n\u0001"),
        (r"(?i)</h[1-3]>|<(p|li|br|div|tr|article|section)\b[^>]*>", "\n"), (r"<[^>]*>", ""), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"),
    ):
        t = F.regexp_replace(t, pattern, to)
    plain = text_lines(pages.select(F.col(doc_id).alias("doc_id"), t.alias("text")))
    head = F.startswith("text", F.lit("\u0001"))
    clean = F.btrim(F.regexp_replace("text", "\u0001", ""))
    return plain.withColumns({"is_bold": head, "font_size_avg": F.when(head, 18.0).otherwise(10.0), "text": clean}).where("text <> ''")


def pdf_spans(spark: SparkSession, path: str, open_pdf: Callable[[bytes], Iterator[tuple]] | None = None) -> DataFrame:
    """Text spans of the PDF files under ``path``, a file a row, read in parallel. ``open_pdf`` yields (page, line_no, span_no,
    text, x0, y0, x1, y1, size, flags, font) of one file's bytes; without it PyMuPDF must be installed on the executors.
    A file that can't be read gives no spans."""
    schema = "doc_id STRING, page INT, line_no INT, span_no INT, text STRING, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, size DOUBLE, flags INT, font STRING"

    def by_pymupdf(content: bytes) -> Iterator[tuple]:
        import fitz

        for number, page in enumerate(fitz.open(stream=content, filetype="pdf")):
            n = 0
            for block in page.get_text("dict")["blocks"]:
                for line in block.get("lines", ()):
                    for k, s in enumerate(line["spans"]):
                        yield (number, n, k, s["text"], *s["bbox"], s["size"], s["flags"], s["font"])
                    n += 1

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    rows += [(path, *span) for span in (open_pdf or by_pymupdf)(content)]
                except ImportError:
                    raise
                except Exception:  # noqa: BLE001, S112 - an unreadable file has no spans
                    continue
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "content")
    return files.mapInPandas(read, schema)


def with_recognised_lines(lines: DataFrame, recognised: DataFrame) -> DataFrame:
    """Lines of the document itself, then those a recogniser read (confidence, and the same columns): blank ones and those
    below 0.3 dropped, numbered on behind the page's own lines."""
    own = lines.groupBy("doc_id", "page").agg((F.max("line_no") + 1).alias("_from"))
    good = recognised.where((F.col("confidence") >= 0.3) & (F.btrim("text") != "")).join(own, ["doc_id", "page"], "left")
    number = F.row_number().over(W.partitionBy("doc_id", "page").orderBy("y0", "x0", "line_no")) - 1
    good = good.withColumn("line_no", (number + F.coalesce("_from", F.lit(0))).cast("int"))
    return lines.unionByName(good.drop("_from", "confidence"), allowMissingColumns=True)
