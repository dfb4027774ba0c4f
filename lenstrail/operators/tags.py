"""Tag vocabulary per region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lenstrail.config import STOP_WORDS
from lenstrail.functions.columns import is_known_roi

# Plain letters only.  \z, unlike $, does not let a trailing line break pass.
WORD = r"^[a-z]+\z"


def roi_word_counts(df: DataFrame, *, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Uses of each word per known region, over all tags."""
    words = (
        df.filter(is_known_roi())
        .select("roi", F.explode("tags").alias("word"))
        .withColumn("word", F.lower("word"))
    )
    return (
        words.filter(F.col("word").rlike(WORD) & ~F.col("word").isin(list(stop_words)))
        .groupBy("roi", "word")
        .agg(F.count("*").alias("count"))
    )


def _top_words(counts: DataFrame, n: int) -> DataFrame:
    # Ranked inside each input task first, so a region's whole vocabulary never meets in one.
    rank = F.row_number().over(Window.partitionBy("roi").orderBy(F.desc("count"), "word"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= n)


def roi_tags(df: DataFrame, *, n: int = 20, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """The `n` most used words of each region; ties go to the earlier word."""
    return _top_words(roi_word_counts(df, stop_words=stop_words), n).drop("rank")


def roi_word_weights(tags: DataFrame, n: int = 50) -> DataFrame:
    """Word weights of every region for a word cloud: rank and share of the shown uses."""
    shown = _top_words(tags, n)
    whole = F.sum("count").over(Window.partitionBy("roi"))
    return shown.withColumn("share", F.col("count") / whole)
