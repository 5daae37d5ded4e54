"""User-written mappers over batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

Batch = Callable[[pd.DataFrame], pd.DataFrame]


def map_rows(df: DataFrame, mapper: Batch, schema: str) -> DataFrame:
    """``mapper`` turns a batch of rows into any number of rows; side data goes in its closure."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield mapper(batch)

    return df.mapInPandas(run, schema)
