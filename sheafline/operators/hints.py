"""Typed hints: where a document names its product, codes, origin and the like, ranked by confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sheafline.config import DEFAULT, GENERIC_TITLES, Config
from sheafline.functions import text as X
from sheafline.operators.lines import header_levels, index_page

COLUMNS = ["doc_id", "target_field", "confidence", "hint_type", "page", "section_id", "source_text", "supporting_text", "matched_terms", "seq"]


def fields(config: Config = DEFAULT) -> Column:
    """array of struct(no, target_field, terms), in the order of the configuration."""
    return F.array(*(F.struct(F.lit(i).alias("no"), F.lit(f).alias("target_field"), X.alias_terms(t).alias("terms")) for i, (f, t) in enumerate(config.aliases.items())))


def title_hints(sections: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """A hint for every field one of whose terms occurs in the section's title; more terms, more confidence."""
    formed = sections.select(
        "doc_id", "section_id", "section_no", "page_start", "raw_title", "text_plain",
        X.match_form(F.col("raw_title")).alias("raw_form"), X.match_form(F.col("normalized_title")).alias("norm_form"),
    )
    # The forms are compared with every term of every field: compute them once a section.
    some = "|".join(sorted({t for terms in config.aliases.values() for t in terms}))
    each = formed.where(F.col("raw_form").rlike(some) | F.col("norm_form").rlike(some)).withColumn("f", F.explode(fields(config)))
    hits = lambda c: F.filter("f.terms", lambda t: F.contains(F.col(c), t))
    count = F.greatest(F.size(hits("raw_form")), F.size(hits("norm_form")))
    confidence = F.round(F.least(0.78 + 0.08 * count, F.lit(0.95)), 4)
    return each.where(count > 0).select(
        "doc_id", "f.target_field", confidence.alias("confidence"), F.lit("section_title_similarity").alias("hint_type"), F.col("page_start").alias("page"), "section_id",
        F.col("raw_title").alias("source_text"), X.snippet(F.col("text_plain")).alias("supporting_text"), hits("raw_form").alias("matched_terms"),
        F.struct(F.lit(1).alias("group"), F.col("section_no").cast("bigint").alias("a"), F.col("f.no").alias("b")).alias("seq"),
    )


def value_hints(sections: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Hints from "label: value" in a section's text, and from phrases that tell the origin."""
    found = [
        F.struct(F.lit(f).alias("target_field"), F.lit(0.89).alias("confidence"), X.label_value(F.col("found"), F.col("values"), labels).alias("v"), F.lit(": ").alias("sep"), F.lit(100 + i).alias("no"))
        for i, (f, labels) in enumerate(config.value_labels.items())
    ]
    found.append(F.struct(F.lit("origin").alias("target_field"), F.lit(0.9).alias("confidence"), X.origin_value(F.col("flat")).alias("v"), F.lit(" ").alias("sep"), F.lit(200).alias("no")))
    labels = [x for of in config.value_labels.values() for x in of]
    flat = sections.where("text_plain is not null").select("doc_id", "section_id", "section_no", "page_start", X.clean_text(F.col("text_plain")).alias("flat"))
    named, values = X.labelled_values(F.col("flat"), labels)
    flat = flat.withColumns({"found": named, "values": values})
    flat = flat.where((F.size("found") > 0) | F.col("flat").rlike("(?i)origin|origen|made in|manufactured in|fabricado en|hecho en"))
    each = flat.select("doc_id", "section_id", "section_no", "page_start", F.explode(F.array(*found)).alias("f")).where("f.v is not null")
    return each.select(
        "doc_id", "f.target_field", "f.confidence", F.lit("pattern_match").alias("hint_type"), F.col("page_start").alias("page"), "section_id",
        F.concat("f.v.label", "f.sep", "f.v.value").alias("source_text"), X.snippet(F.col("f.v.value")).alias("supporting_text"),
        F.array(X.match_form(F.col("f.v.label"))).alias("matched_terms"), F.struct(F.lit(1).alias("group"), F.col("section_no").cast("bigint").alias("a"), F.col("f.no").alias("b")).alias("seq"),
    )


def column_hints(tables: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """A hint for every table column whose name holds a field's term; the first two rows support it."""
    rows = F.slice(F.filter(F.coalesce("rows", F.array().cast("array<array<string>>")), lambda r: r.isNotNull()), 1, 2)
    preview = F.array_join(F.transform(rows, lambda r: F.array_join(F.transform(r, lambda c: F.coalesce(c, F.lit(""))), " ")), " | ")
    each = tables.select("doc_id", "page", "table_uid", preview.alias("preview"), F.posexplode("columns").alias("pos", "name")).where("name is not null")
    each = each.withColumn("form", X.match_form(F.col("name"))).withColumn("f", F.explode(fields(config)))
    hits = F.filter("f.terms", lambda t: F.contains(F.col("form"), t))
    return each.where(F.size(hits) > 0).select(
        "doc_id", "f.target_field", F.lit(0.84).alias("confidence"), F.lit("table_header_similarity").alias("hint_type"), (F.col("page") + 1).alias("page"),
        F.lit(None).cast("string").alias("section_id"), F.col("name").alias("source_text"), X.snippet(F.col("preview")).alias("supporting_text"), hits.alias("matched_terms"),
        F.struct(F.lit(2).alias("group"), F.col("table_uid").cast("bigint").alias("a"), (F.col("pos") * 10 + F.col("f.no")).cast("int").alias("b")).alias("seq"),
    )


def name_hints(documents: DataFrame, headers: DataFrame | None = None, config: Config = DEFAULT) -> DataFrame:
    """The product's name: a document's title metadata unless it is generic, else the best header of its first two pages
    that aren't contents (``headers``: doc_id, page_rank, page, text, score, line_no) with 2 to 12 words and a score of 7."""
    title = F.btrim("title_metadata")
    good = (title != "") & ~X.match_form(title).isin(*GENERIC_TITLES)
    none = F.lit(None).cast("string")
    row = lambda text, confidence, kind, page, term: [
        "doc_id", F.lit("product_name").alias("target_field"), F.lit(confidence).alias("confidence"), F.lit(kind).alias("hint_type"), page.cast("int").alias("page"),
        none.alias("section_id"), text.alias("source_text"), none.alias("supporting_text"), F.array(F.lit(term)).alias("matched_terms"),
        F.struct(F.lit(0).alias("group"), F.lit(0).cast("bigint").alias("a"), F.lit(0).alias("b")).alias("seq"),
    ]
    named = documents.where(good).select(*row(title, 0.93, "document_metadata", F.lit(1), "title_metadata"))
    if headers is None:
        return named
    others = [t for f, terms in config.aliases.items() if f != "product_name" for t in terms]
    form = X.match_form(F.col("text"))
    fit = (F.col("page_rank") <= 2) & ~form.isin(*GENERIC_TITLES) & ~F.exists(X.alias_terms(tuple(others)), lambda t: F.contains(form, t))
    fit &= X.word_count(F.col("text")).between(2, 12) & (F.col("score") >= 7)
    best = headers.where(fit).groupBy("doc_id").agg(F.min_by(F.struct("text", "page"), F.struct("page_rank", -F.col("score"), "line_no")).alias("h"))
    spare = best.join(named.select("doc_id"), "doc_id", "left_anti")
    return named.unionByName(spare.select(*row(F.btrim("h.text"), 0.58, "page_header_candidate", F.col("h.page") + 1, "header_candidate")))


def header_candidates(lines: DataFrame, tables: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """The headers of ``lines`` as ``name_hints`` takes them; ``page_rank`` counts a document's pages that aren't contents from 1."""
    pages = index_page(lines, config).where("not is_index").select("doc_id", "page").distinct()
    ranks = pages.withColumn("page_rank", F.row_number().over(W.partitionBy("doc_id").orderBy("page")))
    levels = header_levels(lines, tables, config).where("header_level in ('section_header', 'subheader')")
    return levels.join(ranks, ["doc_id", "page"]).select("doc_id", "page_rank", "page", "text", F.col("header_score").alias("score"), "line_no")


def ranked(hints: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """``hints`` once per field, page, section, comparable source and type (the most confident, at the place of the first),
    with ``rank`` within document and field: by confidence, page, length of the source, place."""
    key = ["doc_id", "target_field", "page", "section_id", "hint_type"]
    keyed = hints.withColumn("_form", X.match_form(F.col("source_text")))
    value = [c for c in COLUMNS if c not in (*key, "seq")]
    # max_by takes an arbitrary one of equals, so the order within equal confidence is part of it: earliest first.
    first = keyed.groupBy(*key, "_form").agg(
        F.min_by(F.struct(*value), F.struct((-F.col("confidence")).alias("c"), "seq")).alias("h"), F.min("seq").alias("seq")
    )
    rank = F.row_number().over(W.partitionBy("doc_id", "target_field").orderBy(F.desc("confidence"), F.coalesce("page", F.lit(10**9)), F.length("source_text"), "seq"))
    return first.select(*key, "h.*", "seq").withColumn("rank", rank).drop("seq")
