"""Standard scaling of numeric features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.fixed import NUMERIC_FEATURES


def scaler_stats(df: DataFrame, features: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """(feature, mean, scale): population deviation, 1 for a constant feature."""
    wide = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in features],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in features],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"m_{c}").alias("mean"),
                F.when(F.col(f"s_{c}") == 0, 1.0).otherwise(F.col(f"s_{c}")).alias("scale"),
            )
            for c in features
        ]
    )
    return wide.select(F.inline(rows))


@dataclass(frozen=True)
class ScalerModel:
    features: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, features: list[str] = NUMERIC_FEATURES) -> ScalerModel:
        by_name = {r["feature"]: r for r in scaler_stats(df, features).collect()}
        return cls(
            tuple(features),
            tuple(by_name[c]["mean"] for c in features),
            tuple(by_name[c]["scale"] for c in features),
        )

    def scaled(self) -> dict[str, Column]:
        return {
            c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
            for c, m, s in zip(self.features, self.mean, self.scale)
        }

    def vectors(self, df: DataFrame, text: str = "tfidf", out: str = "features") -> DataFrame:
        """Append the scaled numerics behind the text block."""
        names = [f"_z_{c}" for c in self.features]
        df = df.withColumns({f"_z_{c}": z for c, z in self.scaled().items()})
        return VectorAssembler(inputCols=[text, *names], outputCol=out).transform(df).drop(*names)
