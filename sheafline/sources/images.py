"""Images: which are worth reading, and which of what was read is text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sheafline.config import DEFAULT, Config


def banner() -> Column:
    """A flat strip at the top of its page."""
    return (F.col("y0") < 80) & ((F.col("x1") - F.col("x0")) / F.greatest(F.col("y1") - F.col("y0"), F.lit(1.0)) > 6)


def relevant(config: Config = DEFAULT) -> Column:
    width, height, area = config.min_image
    return (F.col("width") >= width) & (F.col("height") >= height) & (F.col("width") * F.col("height") >= area) & ~banner()


def usable_text(text: Column, least: int = 4) -> Column:
    return F.when(F.length(text) >= least, text)
