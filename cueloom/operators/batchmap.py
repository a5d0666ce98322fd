"""The hook for models, feature extractors, resamplers and tokenizers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

BatchFunction = Callable[[pd.DataFrame], pd.DataFrame]


def map_batches(
    df: DataFrame, factory: Callable[[], BatchFunction], schema: str, partitions: int | None = None
) -> DataFrame:
    """Map Arrow batches through ``factory()``, which runs once per task.

    Put whatever is costly to load in the factory. Filter and drop columns
    before: nothing is pushed down through the function. Give ``partitions``
    when the input has few files and the function is slow.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        apply = factory()
        for batch in batches:
            yield apply(batch)

    spread = df.repartition(partitions) if partitions else df
    return spread.mapInPandas(run, schema)
