"""Documents that keep arriving: each is analysed once, redeliveries are dropped, counts follow event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sheafline.functions import text as X
from sheafline.operators.matrix import missing_or_stale


def without_redeliveries(stream: DataFrame, key: list[str], at: str, delay: str = "7 days") -> DataFrame:
    """The first delivery of each key within ``delay`` of event time; the state of older keys is let go."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(key)


def title_counts(sections: DataFrame, at: str = "ingested_at", window: str = "1 day", delay: str = "7 days") -> DataFrame:
    """window, normalized_title, sections: how many sections of each title arrive per window of event time. Late rows count
    as long as the watermark lets them; works on streams and on tables."""
    title = F.coalesce(F.nullif(X.normalize_title(F.col("raw_title")), F.lit("")), F.lit("other"))
    counted = sections.withWatermark(at, delay).groupBy(F.window(at, window).alias("w"), title.alias("normalized_title")).agg(F.count("*").alias("sections"))
    return counted.select(F.col("w.start").alias("day"), "normalized_title", "sections")


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder of Parquet files exists and holds a finished write."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(path) and any(f.getPath().getName().endswith(".parquet") or f.isDirectory() and "=" in f.getPath().getName() for f in files.listStatus(path))


def each_new_document(stream: DataFrame, analyse: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: list[str], version: str, once: bool = True) -> StreamingQuery:
    """Append ``analyse`` of every document whose (key, version) isn't in the Parquet folder ``out`` yet. A batch that is
    run again after a failure finds its rows there and adds nothing. Only a folder that doesn't exist counts as empty: what
    else goes wrong while reading it stops the stream. Of ``out`` the keys and versions alone are read."""

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        done = spark.read.parquet(out).select(*key, version) if exists(spark, out) else None
        todo = df.dropDuplicates([*key, version])
        analyse(todo if done is None else missing_or_stale(todo, done, key, version)).write.mode("append").parquet(out)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
