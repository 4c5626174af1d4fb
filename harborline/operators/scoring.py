"""Batch scoring with one model instance per Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def score_rows(
    df: DataFrame,
    load_model: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """Apply a model to Arrow batches of rows.

    ``load_model`` runs once per task, then scores one batch after the other;
    only the columns the model needs should be selected beforehand.
    """
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for batch in batches:
            yield model(batch)

    return df.mapInPandas(score, schema)
