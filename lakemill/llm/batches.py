"""How many rows a Python worker gets at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
_DEFAULT = 10_000
#: Rows of text in a batch: some MB, where the engine's default would be tens of MB on either side.
ROWS = 1_000


def small(spark: SparkSession) -> None:
    """Bound the batches of this session, unless somebody has chosen a size."""
    if int(spark.conf.get(_KEY, str(_DEFAULT))) == _DEFAULT:
        spark.conf.set(_KEY, ROWS)
