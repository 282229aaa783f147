"""Nulls in any column, repeated rows, long texts, ties, empty tables and clashing extra columns, for the registered queries' operators."""

import pytest
from pyspark.sql import functions as F

from sheafline.llm import canonical, frequency, language, leakage, lookalikes, neardup, packing, residue, scannoise

SECTIONS = "section_uid bigint, doc_id string, section_id string, page_start int, page_end int, raw_title string, normalized_title string, text_plain string, lang string, extracted_at timestamp, ingested_at timestamp"
LINES = "line_uid bigint, doc_id string, page int, line_no int, text string, header_level string, is_table_like boolean, toc_page_number int, font_name string"
DOCS = "doc_id bigint, text string"
LONG = "Inspect the upper pump before every cleaning. " * 2000


def rows(schema, good):
    """Rows of nulls, of one good value among nulls, the good row twice and with a very long text."""
    names = [c.split()[0] for c in schema.split(", ")]
    out = [tuple(None for _ in names), tuple(good[n] for n in names), tuple(good[n] for n in names)]
    for n in names:
        out += [tuple(good[m] if m == n else None for m in names), tuple(None if m == n else good[m] for m in names)]
    return out + [tuple(LONG if m in ("text", "text_plain") else "" if m == "raw_title" else good[m] for m in names)]


@pytest.fixture(scope="module")
def frames(spark):
    s = {"section_uid": 1, "doc_id": "d", "section_id": "sec_1", "page_start": 1, "page_end": 2, "raw_title": "Care", "normalized_title": "care", "text_plain": "Inspect the pump.", "lang": "en", "extracted_at": None, "ingested_at": None}
    ln = {"line_uid": 1, "doc_id": "d", "page": 0, "line_no": 0, "text": "some words", "header_level": "non_header", "is_table_like": False, "toc_page_number": None, "font_name": ""}
    clash = lambda df: df.withColumns({c: F.lit("x") for c in ("key", "kind", "n", "cid", "tokens", "form", "record_id", "field", "term", "item", "t", "i")})
    return {
        "sections": clash(spark.createDataFrame(rows(SECTIONS, s), SECTIONS)),
        "lines": clash(spark.createDataFrame(rows(LINES, ln), LINES)),
        "docs": clash(spark.createDataFrame(rows(DOCS, {"doc_id": 1, "text": "Inspect the pump."}), DOCS)),
        "images": clash(spark.createDataFrame([(1, "d", 0, "text"), (None, None, None, None)], "image_uid bigint, doc_id string, page int, ocr_text string")),
        "canon": spark.createDataFrame([(1, "en", "Care"), (None, None, None)], "canon_id int, lang string, title string"),
        "maps": spark.createDataFrame([(1, {"care": "c"}), (2, None), (None, {"x y z w": "c"})], "map_version int, title_map map<string,string>"),
        "items": spark.createDataFrame([(1, LONG), (None, "a"), (2, None)], "item_id bigint, text string"),
        "freq": spark.createDataFrame([(1, 40, "a", 1, {"A": 1}, None), (None,) * 6, (1, None, None, None, None, None)], "run_id int, total_docs int, normalized_title string, doc_count int, raw_titles map<string,int>, computed_at timestamp"),
    }


CALLS = {
    "frequency": lambda f: frequency.found(f["freq"]),
    "neardup": lambda f: neardup.found(f["sections"]),
    "neardup groups": lambda f: neardup.section_groups(f["sections"]),
    "paragraphs": lambda f: scannoise.paragraphs(f["lines"], f["sections"], f["images"]),
    "segments": lambda f: language.section_segments(f["sections"], f["canon"]),
    "scannoise": lambda f: scannoise.found(f["lines"], f["sections"], f["images"]),
    "language": lambda f: language.found(f["sections"], f["canon"]),
    "lookalikes": lambda f: lookalikes.found(f["lines"], f["sections"]),
    "canonical": lambda f: canonical.found(f["sections"], f["maps"], f["canon"]),
    "packing": lambda f: packing.containers(f["docs"], "doc_id", "text"),
    "leakage": lambda f: leakage.found(f["docs"], f["items"]),
    "residue": lambda f: residue.found(f["docs"]),
}


@pytest.mark.parametrize("name", sorted(CALLS))
def test_runs(frames, name):
    CALLS[name](frames).collect()
    CALLS[name]({k: v.limit(0) for k, v in frames.items()}).collect()
