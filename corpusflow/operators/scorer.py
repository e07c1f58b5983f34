"""Plug-in batch scorers: a caller's function over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

Batches = Iterator[pd.DataFrame]


def score_with(df: DataFrame, fn: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """Run ``fn`` once per partition over its batches, so a model loads once and scores many."""
    return df.mapInPandas(fn, schema)
