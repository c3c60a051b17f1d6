"""Dealing rows to tasks before work that is far dearer than a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str | None) -> DataFrame:
    """Rows dealt by a hash of their keys; without a key, as they are.

    For work on whole texts or many patterns a row, which handles a few MB a second and
    core: a scan has a task per row group, and those may be few or hold texts of very
    uneven length. Give keys that are (nearly) unique, so that no task gets much more
    than others; a later join or aggregate by the same keys needs no shuffle of its own.
    """
    named = [k for k in keys if k]
    return df.repartition(*named) if named else df
