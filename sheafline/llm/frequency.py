"""Frequency of every distinct term by heavy-light aggregation.

1. *Detect*: every task keeps a bounded Misra-Gries summary of its terms; summaries merge into at most ``slots``
   candidates, so every term whose weight exceeds ``1 / slots`` of the total is among them, whatever the data's size.
2. *Heavy*: the candidates are broadcast and indexed; each task adds their weights into exact counter arrays and emits
   one row per candidate it met. A term that holds a third of all rows costs one row per task instead of a hot partition.
3. *Light*: all other terms are shuffled by term and summed.
4. The two count tables, disjoint by construction, are united.

Counts are exact; the summary only decides which way a term takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

COUNTS = "field STRING, term STRING, n BIGINT, records BIGINT"


_OUT = pa.schema([("field", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("records", pa.int64()), ("heavy", pa.bool_())])


def _squeezed(keys: np.ndarray, weights: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Misra-Gries merge step: subtract the (slots+1)-th largest weight, keep what stays positive."""
    if len(keys) > slots:
        weights = weights - np.partition(weights, len(weights) - slots - 1)[len(weights) - slots - 1]
        keep = weights > 0
        keys, weights = keys[keep], weights[keep]
    return keys, weights


def heavy_terms(terms: DataFrame, slots: int = 256) -> list[tuple[str, str]]:
    """At most ``slots`` (field, term) candidates holding every term above ``1 / slots`` of the total weight.

    ``terms`` has columns field, term, n. Summaries merge in two rounds, so the driver gets at most ``slots`` rows.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = pa.schema([("field", pa.string()), ("term", pa.string()), ("n", pa.int64())]).empty_table()
        for batch in batches:
            t = pa.concat_tables([kept, pa.Table.from_batches([batch]).cast(kept.schema)])
            t = t.group_by(["field", "term"]).aggregate([("n", "sum")]).select(["field", "term", "n_sum"])
            at, n = _squeezed(np.arange(len(t)), t["n_sum"].to_numpy(), slots)
            t = t.take(pa.array(at))
            kept = pa.table([t["field"], t["term"], pa.array(n, pa.int64())], schema=kept.schema)
        yield from kept.combine_chunks().to_batches()

    schema = "field STRING, term STRING, n BIGINT"
    part = terms.select("field", "term", F.col("n").cast("bigint").alias("n")).where(F.col("n") > 0).mapInArrow(summary, schema)
    n = max(1, terms.sparkSession.sparkContext.defaultParallelism)
    merged = part.repartition(n).mapInArrow(summary, schema).coalesce(1).mapInArrow(summary, schema)
    return sorted((r["field"], r["term"]) for r in merged.collect() if r["term"] is not None)


def term_counts(terms: DataFrame, slots: int = 256) -> DataFrame:
    """field, term, n (sum of weights), records (rows that carry the term); null terms are no terms.

    A term occurring in several rows counts once in ``records`` per row; a row with weight null counts as weight 0. An
    empty table gives no rows. Terms differing only in case or outer spaces are different terms.
    """
    heavy = heavy_terms(terms, slots)
    index = pa.array([f"{f}\0{t}" for f, t in heavy], pa.string())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros(len(index), np.int64), np.zeros(len(index), np.int64)
        for batch in batches:
            at = pc.index_in(pc.binary_join_element_wise(batch["field"], batch["term"], "\0"), index)
            known = pc.is_valid(at).to_numpy(zero_copy_only=False)
            where, weights = at.drop_null().to_numpy(), batch["n"].to_numpy(zero_copy_only=False)[known]
            np.add.at(sums, where, weights)
            rows += np.bincount(where, minlength=len(index))
            light = batch.filter(pa.array(~known))
            if light.num_rows:
                t = pa.Table.from_batches([light]).group_by(["field", "term"]).aggregate([("n", "sum"), ("n", "count")])
                t = t.rename_columns(["field", "term", "n", "records"]).append_column("heavy", pa.repeat(False, len(t)))
                yield from t.select(_OUT.names).cast(_OUT).combine_chunks().to_batches()
        met = np.flatnonzero(rows)
        if len(met):
            names = [pa.array([heavy[i][k] for i in met], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*names, pa.array(sums[met]), pa.array(rows[met]), pa.repeat(True, len(met))], schema=_OUT)

    rows = (
        terms.where(F.col("term").isNotNull())
        .select("field", "term", F.coalesce(F.col("n").cast("bigint"), F.lit(0)).alias("n"))
        .mapInArrow(split, COUNTS + ", heavy BOOLEAN")
    )
    # One exchange carries both count tables; the flag in the key keeps the few partial arrays apart from the light terms.
    return rows.groupBy("heavy", "field", "term").agg(F.sum("n").alias("n"), F.sum("records").alias("records")).drop("heavy")


def marked(counts: DataFrame, rare: Column, common: Column) -> DataFrame:
    """``counts`` with mark 'rare', 'common' or null; a term that is both (tiny collections) is common."""
    return counts.withColumn("mark", F.when(common, "common").when(rare, "rare"))


def latest_titles(section_freq: DataFrame) -> DataFrame:
    """The latest row of each (run_id, normalized_title); rows of one time are redeliveries, the greatest is taken."""
    pick = F.struct("computed_at", "doc_count", "total_docs")
    return section_freq.groupBy("run_id", "normalized_title").agg(
        F.max_by(F.struct("total_docs", "doc_count", "raw_titles"), pick).alias("r"), F.max("computed_at").alias("at")
    )


def title_counts(section_freq: DataFrame) -> DataFrame:
    """Totals of every normalized and every raw title over all runs.

    Null titles, null maps and null counts add nothing; titles are stripped of U+0020 only.
    """
    latest = latest_titles(section_freq)
    terms = latest.select(
        F.explode(
            F.concat(
                F.array(
                    F.struct(F.lit("normalized_title").alias("field"), F.btrim("normalized_title", F.lit(" ")).alias("term"), F.col("r.doc_count").alias("n"))
                ),
                F.transform(
                    F.coalesce(F.map_entries("r.raw_titles"), F.array().cast("array<struct<key:string,value:int>>")),
                    lambda e: F.struct(F.lit("raw_title").alias("field"), e["key"].alias("term"), e["value"].alias("n")),
                ),
            )
        ).alias("t")
    ).select("t.*")
    return term_counts(terms)


def found(section_freq: DataFrame, rare_title: int = 2, common_title: float = 0.05, rare_raw: int = 1, common_raw: float = 0.01) -> DataFrame:
    """Titles too rare or too common to become columns."""
    counts = title_counts(section_freq)
    runs = section_freq.groupBy("run_id").agg(F.max_by("total_docs", F.struct("computed_at", "total_docs")).alias("total"))
    docs = runs.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("docs"))
    raws = counts.where(F.col("field") == "raw_title").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("raws"))
    both = counts.join(F.broadcast(docs.crossJoin(raws)))  # one row of totals
    raw = F.col("field") == "raw_title"
    common = F.when(raw, F.col("n") > common_raw * F.col("raws")).otherwise(F.col("n") > common_title * F.col("docs"))
    rare = F.when(raw, F.col("n") <= rare_raw).otherwise(F.col("n") <= rare_title)
    return marked(both, rare, common).where("mark is not null").select("field", F.col("term").alias("title"), "mark")
