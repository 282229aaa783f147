"""Facts about documents and about the whole collection: sizes, structure problems, title frequencies, bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sheafline.config import DEFAULT, LANGUAGE_NAMES, STRUCTURAL_NORMS, STRUCTURAL_TITLES, Config
from sheafline.functions import text as X


def code_header(text: Column) -> Column:
    t = F.btrim(text)
    return t.rlike(r"^[A-Z]{2,5}-[0-9]{2,}$") | t.rlike(r"^[A-Z]-[A-Z0-9]{4,}$") | t.rlike(r"^[A-Z]{1,4}[0-9]{2,}[A-Z0-9\-]*$")


def list_header(text: Column) -> Column:
    t = F.lower(F.btrim(text))
    return t.rlike(r"^[a-z]\)") | t.rlike(r"^[0-9]+\.$")


def language_title(title: Column) -> Column:
    """Whether any part of a title, split at slashes, pipes and backslashes, is the name of a language."""
    return F.exists(F.split(F.lower(F.coalesce(title, F.lit(""))), r"[/|\\]"), lambda p: F.btrim(p).isin(*LANGUAGE_NAMES))


def header_facts(lines: DataFrame) -> DataFrame:
    """doc_id and counts of section headers, subheaders, of headers that are lists, codes, long or very long, and of headers of
    the first four pages that hold a language's name."""
    section = F.col("header_level") == "section_header"
    n = X.word_count(F.col("text"))
    names = F.exists(F.array(*map(F.lit, LANGUAGE_NAMES)), lambda x: F.contains(F.lower("text"), x))
    return lines.groupBy("doc_id").agg(
        F.count_if(section).alias("section_headers"),
        F.count_if(F.col("header_level") == "subheader").alias("subheaders"),
        F.count_if(section & list_header(F.col("text"))).alias("list_headers"),
        F.count_if(section & code_header(F.col("text"))).alias("code_headers"),
        F.count_if(section & (n > 12)).alias("long_headers"),
        F.count_if(section & (n > 18)).alias("very_long_headers"),
        F.count_if((F.col("header_level") != "non_header") & (F.col("page") < 4) & names).alias("language_headers"),
    )


def section_facts(sections: DataFrame) -> DataFrame:
    """doc_id and sizes of a document's sections; ``avg_chars`` is the whole part of the mean over real sections, 0 if none."""
    structural = F.coalesce("raw_title", F.lit("")).isin(*STRUCTURAL_TITLES)
    size = F.length(F.coalesce("text_plain", F.lit("")))
    return sections.groupBy("doc_id").agg(
        F.count("*").alias("sections"),
        F.count_if(structural).alias("untitled"),
        F.count_if(F.col("normalized_title") == "other").alias("other"),
        F.sum(size).cast("bigint").alias("total_chars"),
        F.coalesce(F.try_divide(F.sum(F.when(~structural, size)), F.count_if(~structural)).cast("int"), F.lit(0)).alias("avg_chars"),
        F.count_if(language_title(F.col("raw_title"))).alias("language_titles"),
    )


def structure_problems(documents: DataFrame) -> DataFrame:
    """``documents`` (doc_id, pages, lines, images and the facts above) with ``problems``: names of what is structurally
    wrong, in a fixed order."""
    c = F.col
    s, p = c("sections"), c("pages")
    # The names of the problems and their order.
    rules = [
        ("no_text", (c("lines") == 0) & (p > 0)),
        ("mostly_images", (c("lines") < 15) & (c("images") >= 5)),
        ("too_many_sections", (p <= 4) & (s > 8) | p.between(5, 10) & (s > 15) | (p > 10) & (s > 2 * p)),
        ("many_untitled", (s >= 4) & (c("untitled") > 0.30 * s)),
        ("list_headers", c("list_headers") >= 2),
        ("code_headers", c("code_headers") >= 1),
        ("long_headers", (c("long_headers") >= 2) | (c("very_long_headers") >= 1)),
        ("poor_normalization", (s >= 8) & (c("other") > 0.60 * s)),
        ("suspicious_tables", c("odd_tables") >= 1),
        ("footer_tables", c("footer_tables") >= 1),
        ("sections_too_short", (s >= 6) & (c("avg_chars") < 150)),
        ("sections_too_long", (s <= 4) & (c("avg_chars") > 3000)),
        ("many_subheaders", (c("subheaders") > 0) & (c("subheaders") > F.greatest(F.lit(6), 2 * c("section_headers")))),
        ("multilingual", (c("language_titles") >= 3) | (s > 20) & (c("other") > 0.85 * s) | (c("language_headers") >= 4)),
    ]
    names = F.array_compact(F.array(*(F.when(condition, F.lit(name)) for name, condition in rules)))
    return documents.withColumn("problems", names)


def document_facts(documents: DataFrame, lines: DataFrame, sections: DataFrame, tables: DataFrame, images: DataFrame) -> DataFrame:
    """One row per document (the latest of its rows): pages, counts of its parts, their facts, problems."""
    from sheafline.operators.tables import table_facts

    one = documents.groupBy("doc_id").agg(F.max_by(F.struct("file_name", "page_count"), F.struct("ingested_at", "file_name")).alias("d")).select("doc_id", "d.*")
    facts = table_facts(tables, ["doc_id"]).groupBy("doc_id").agg(
        F.count("*").alias("tables"), F.count_if("odd").alias("odd_tables"), F.count_if("footer").alias("footer_tables")
    )
    parts = [
        lines.groupBy("doc_id").agg(F.count("*").alias("lines")),
        images.groupBy("doc_id").agg(F.count("*").alias("images")),
        section_facts(sections),
        header_facts(lines),
        facts,
    ]
    joined = one.select("doc_id", "file_name", F.coalesce("page_count", F.lit(0)).alias("pages"))
    for part in parts:
        joined = joined.join(part, "doc_id", "left")
    counts = [c for c in joined.columns if c not in ("doc_id", "file_name", "pages")]
    return structure_problems(joined.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in counts}))


def title_frequency(sections: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """normalized_title ('other' for none), doc_count, unique_raw_titles, avg_chars, is_structural, raw_variations (the most
    frequent raw titles with their counts; of equally frequent ones the smallest first).

    Two levels: a row per (title, raw title) first, so that a title in a third of all rows is summed before it moves."""
    base = sections.select(
        "doc_id",
        F.coalesce(F.nullif("normalized_title", F.lit("")), F.lit("other")).alias("normalized_title"),
        F.btrim(F.coalesce("raw_title", F.lit(""))).alias("raw"),
        F.length(F.coalesce("text_plain", F.lit(""))).alias("chars"),
    )
    docs = base.groupBy("normalized_title", "doc_id").agg(F.lit(1).alias("one")).groupBy("normalized_title").agg(F.count("*").alias("doc_count"))
    raws = base.groupBy("normalized_title", "raw").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
    rank = F.row_number().over(W.partitionBy("normalized_title").orderBy(F.when(F.col("raw") == "", 1).otherwise(0), F.desc("n"), "raw"))
    top = raws.withColumn("rank", rank)
    shown = F.when((F.col("rank") <= config.top_variants) & (F.col("raw") != ""), F.struct("rank", F.concat("raw", F.lit(" ("), "n", F.lit(")")).alias("t")))
    titles = top.groupBy("normalized_title").agg(
        F.count_if(F.col("raw") != "").alias("unique_raw_titles"),
        F.floor(F.sum("chars") / F.sum("n")).cast("int").alias("avg_chars"),
        F.array_join(F.transform(F.array_sort(F.collect_list(shown)), lambda v: v["t"]), "; ").alias("raw_variations"),
    )
    joined = titles.join(docs, "normalized_title").withColumn("is_structural", F.col("normalized_title").isin(*STRUCTURAL_NORMS))
    return joined.select("normalized_title", "doc_count", "unique_raw_titles", "avg_chars", "is_structural", "raw_variations")


def frequency_band(frequency: DataFrame) -> DataFrame:
    """normalized_title, doc_count, band by the share of the largest doc_count: 0.75, 0.40, 0.15."""
    top = frequency.agg(F.max("doc_count").alias("_top"))
    share = F.col("doc_count") / F.col("_top")
    band = F.when(share >= 0.75, "very common").when(share >= 0.40, "common").when(share >= 0.15, "some").otherwise("few")
    return frequency.join(F.broadcast(top)).select("normalized_title", "doc_count", band.alias("band"))  # one row


def top_titles(sections: DataFrame, n: int = 5) -> DataFrame:
    """doc_id, titles: the first ``n`` real titles of more than two characters, in the document's order."""
    real = sections.where(~F.coalesce("raw_title", F.lit("")).isin(*STRUCTURAL_TITLES) & (F.length("raw_title") > 2))
    order = F.row_number().over(W.partitionBy("doc_id").orderBy("section_no"))
    first = real.withColumn("_n", order).where(F.col("_n") <= n)
    return first.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "raw_title"))), lambda s: s["raw_title"]), " | ").alias("titles"))


def top_normalized(sections: DataFrame, n: int = 8) -> DataFrame:
    """doc_id, categories: the ``n`` most frequent real normalized titles of a document, of equal ones the first met."""
    real = sections.where(F.col("normalized_title").isNotNull() & ~F.col("normalized_title").isin(*STRUCTURAL_NORMS))
    counts = real.groupBy("doc_id", "normalized_title").agg(F.count("*").alias("c"), F.min("section_no").alias("first"))
    rank = F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("c"), "first", "normalized_title"))
    kept = counts.withColumn("_n", rank).where(F.col("_n") <= n)
    return kept.groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "normalized_title"))), lambda s: s["normalized_title"]), " | ").alias("categories")
    )


def page_records(lines: DataFrame, images: DataFrame, tables: DataFrame) -> DataFrame:
    """doc_id, page (from 1), counts of lines, images, tables and contents entries, and the page's header candidates in
    order: struct(line_no, text, score, header_level)."""
    header = F.col("header_level") != "non_header"
    pages = lines.groupBy("doc_id", "page").agg(
        F.count("*").alias("text_line_count"),
        F.count_if(F.col("toc_page_number").isNotNull()).alias("toc_entry_count"),
        F.array_sort(F.collect_list(F.when(header, F.struct("line_no", "text", F.col("header_score").alias("score"), "header_level")))).alias("header_candidates"),
    )
    count = lambda df, name: df.groupBy("doc_id", "page").agg(F.count("*").alias(name))
    pages = pages.join(count(images, "image_count"), ["doc_id", "page"], "left").join(count(tables, "table_count"), ["doc_id", "page"], "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("image_count", "table_count")}
    return pages.withColumns(zero | {"page": F.col("page") + 1, "is_toc_page": F.col("toc_entry_count") > 0})


def image_only(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """doc_id, chars of the documents whose lines hold hardly any text, as scans and drawings do."""
    return lines.groupBy("doc_id").agg(F.sum(F.length("text")).cast("bigint").alias("chars")).where(F.col("chars") < config.image_only_chars)
