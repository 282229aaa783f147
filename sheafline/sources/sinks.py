"""Sinks: nested document records, partitioned matrices, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def document_records(documents: DataFrame, sections: DataFrame, tables: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """One nested row per document: document, sections, tables, hints, each list in its own order.

    A document is the unit that is written, so its parts meet in one row; a part's text is not copied elsewhere."""

    def nested(part: DataFrame, order: list[str], name: str) -> DataFrame:
        rest = [c for c in part.columns if c not in ("doc_id", *order)]
        return part.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name))

    out = documents.select("doc_id", F.struct(*[c for c in documents.columns if c != "doc_id"]).alias("document"))
    out = out.join(nested(sections, ["section_no"], "sections"), "doc_id", "left").join(nested(tables, ["page", "table_id"], "tables"), "doc_id", "left")
    return out if hints is None else out.join(nested(hints, ["target_field", "rank"], "hints"), "doc_id", "left")


def write_records(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, a document a line; characters beyond ASCII stay as they are."""
    records.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_sheets(matrix: DataFrame, path: str, sheet: str = "sheet", mode: str = "overwrite") -> None:
    """A matrix as Parquet, one folder per sheet; empty sheets have none."""
    matrix.write.mode(mode).partitionBy(sheet).parquet(path)


def write_frequency(frequency: DataFrame, total_docs: int, path: str) -> None:
    frequency.withColumn("total_docs", F.lit(total_docs)).write.mode("overwrite").json(path)


def write_workbook(frames: dict[str, DataFrame], path: str) -> None:
    """An .xlsx file with a sheet per frame, written by the driver row by row; needs openpyxl. For reports a person reads."""
    from openpyxl import Workbook

    book = Workbook(write_only=True)
    for name, df in frames.items():
        rows = df.toLocalIterator()
        first = next(rows, None)
        if first is None:
            continue
        sheet = book.create_sheet(name)
        sheet.append(df.columns)
        sheet.append([str(v) if isinstance(v, (list, dict)) else v for v in first])
        for r in rows:
            sheet.append([str(v) if isinstance(v, (list, dict)) else v for v in r])
    book.save(path)
