"""Counts that describe a corpus and a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def corpus_catalogue(
    df: DataFrame, groups: Sequence[str] = ("type", "focus"), text: str = "page_content"
) -> DataFrame:
    """Documents and mean size per group, with subtotals; NULL groups mark the totals.

    Texts are measured first, since the rollup repeats its input once per level.
    """
    return df.select(*groups, F.char_length(text).alias("_chars")).rollup(*groups).agg(
        F.count(F.lit(1)).alias("documents"),
        F.avg("_chars").alias("mean_chars"),
        F.grouping_id().alias("level"),
    )


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass, without a job of their own.

    The count is read from the returned observation after the first action.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
