"""Sections to columns: which columns a collection has, which column a section goes to, and the pivoted matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sheafline.config import DEFAULT, STRUCTURAL_NORMS, STRUCTURAL_TITLES, Config


def frequent_columns(frequency: DataFrame, total_docs: int, config: Config = DEFAULT) -> list[str]:
    """Titles found in enough documents, most frequent first, then the fallback column; each name once.

    The list is bounded by 1 / ``column_ratio`` times the mean number of titles a document has."""
    rows = (
        frequency.where((F.col("doc_count") >= max(1, total_docs * config.column_ratio)) & ~F.col("is_structural"))
        .select(F.btrim("normalized_title").alias("c"), "doc_count", "unique_raw_titles")
        .where(~F.col("c").isin(*STRUCTURAL_NORMS))
        .orderBy(F.desc("doc_count"), F.desc("unique_raw_titles"), "c")
        .collect()
    )
    return list(dict.fromkeys([*(r["c"] for r in rows), config.fallback_column]))


def capped_columns(columns: list[str], title_map: dict[str, str], config: Config = DEFAULT) -> tuple[list[str], dict[str, str]]:
    """At most ``max_matrix_columns`` columns: the ones most titles map to, then the fallback; other titles go there."""
    if len(columns) <= config.max_matrix_columns:
        return columns, title_map
    used = {c: 0 for c in columns}
    for c in title_map.values():
        used[c] = used.get(c, 0) + 1
    order = sorted((c for c in columns if c != config.fallback_column), key=lambda c: -used[c])
    kept = [*order[: config.max_matrix_columns - 1], config.fallback_column]
    return kept, {t: c if c in kept else config.fallback_column for t, c in title_map.items()}


def resolve_columns(sections: DataFrame, columns: list[str], title_map: DataFrame | None = None) -> DataFrame:
    """doc_id, section_id, raw_title, column, step of every section with a real title of four or more characters.

    Tried in order: the map (norm_title, column), the title itself, its first word against the columns' first words, the
    last column. ``title_map`` is joined; Spark broadcasts it only if it is small."""
    raw, norm = F.btrim("raw_title"), F.btrim(F.coalesce("normalized_title", F.lit("")))
    base = sections.where(raw.isNotNull() & ~raw.isin("", *STRUCTURAL_TITLES) & (F.length(raw) >= 4))
    base = base.select("doc_id", "section_id", "section_no", raw.alias("raw_title"), norm.alias("norm_title"), "text_plain")
    names = F.array(*map(F.lit, columns))
    if title_map is None:
        base = base.withColumn("mapped", F.lit(None).cast("string"))
    else:
        base = base.join(title_map.select("norm_title", F.col("column").alias("mapped")), "norm_title", "left")
    first = F.element_at(F.split("norm_title", r"\s+"), 1)
    by_word = F.get(F.filter(F.slice(names, 1, max(0, len(columns) - 1)), lambda c: F.element_at(F.split(c, r"\s+"), 1) == first), F.lit(0))
    by_word = F.when(F.col("norm_title") != "", by_word)
    known = F.array_contains(names, F.col("mapped"))
    itself = F.array_contains(names, F.col("norm_title"))
    column = F.when(known, F.col("mapped")).when(itself, F.col("norm_title")).otherwise(F.coalesce(by_word, F.lit(columns[-1])))
    step = F.when(known, "map").when(itself, "title").when(by_word.isNotNull(), "first word").otherwise("fallback")
    return base.select("doc_id", "section_id", "section_no", "raw_title", column.alias("column"), step.alias("step"), "text_plain")


def matrix(resolved: DataFrame, columns: list[str]) -> DataFrame:
    """One row per document, one column per name: the blocks '[title]' and text of its sections, in order, a blank line
    between. Of sections repeating a title in a document only the last one's text counts, at the first one's place."""
    title = W.partitionBy("doc_id", "raw_title")
    last = F.row_number().over(title.orderBy(F.desc("section_no"), F.desc("section_id")))
    place = F.min("section_no").over(title)
    kept = resolved.withColumns({"_last": last, "_place": place}).where("_last = 1")
    text = F.btrim(F.coalesce("text_plain", F.lit("")))
    block = F.concat(F.lit("["), "raw_title", F.lit("]"), F.when(text != "", F.concat(F.lit("\n"), text)).otherwise(""))
    cells = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_place", block.alias("b")))), lambda c: c["b"]), "\n\n")
    wide = kept.groupBy("doc_id").pivot("column", columns).agg(cells)
    return wide.na.fill("", columns)


def missing_or_stale(wanted: DataFrame, cached: DataFrame, key: list[str], version: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of ``wanted`` that ``cached`` doesn't hold with the same ``version`` (a fingerprint of what they are made from).

    With ``columns`` a cached row counts only if it has all of them and one isn't null or empty."""
    if columns is not None:
        has_all = set(columns) <= set(cached.columns)
        some = [F.coalesce(F.col(c).cast("string"), F.lit("")) != "" for c in columns if c in cached.columns]
        filled = F.lit(False)
        for s in some:
            filled = filled | s
        cached = cached.where(filled if has_all else F.lit(False))
    return wanted.join(cached.select(*key, version), [*key, version], "left_anti")


def fingerprint(*columns: str) -> Column:
    return F.xxhash64(*columns)


def prompt(frequency: DataFrame, head: str) -> DataFrame:
    """One row, prompt: ``head`` and a line 'title (documents)' per real title, most frequent first.

    It gathers title names, one per distinct title, for a person or a model to group; filter ``frequency`` first."""
    rows = frequency.where(~F.col("is_structural"))
    line = F.struct((-F.col("doc_count")).alias("n"), "normalized_title", F.concat(F.lit("- "), "normalized_title", F.lit(" ("), "doc_count", F.lit(" docs)")).alias("l"))
    return rows.agg(F.concat(F.lit(head + "\n"), F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["l"]), "\n")).alias("prompt"))
