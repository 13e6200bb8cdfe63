"""Text labels to double indexes; what is unknown becomes -1.0."""

from __future__ import annotations

from pyspark.sql import types as T

from rankfold.operators.base import IndexEstimator, IndexModel, IndexParams


class _LabelParams(IndexParams):
    index_type = T.DoubleType()
    index_nullable = False

    def _check_key(self, data_type: T.DataType) -> None:
        if not isinstance(data_type, T.StringType):
            raise ValueError(
                f"{self.uid}: column {self.getInputCol()!r} is {data_type.simpleString()}, "
                "not string"
            )


class LabelIndexerModel(_LabelParams, IndexModel):
    """Adds the rank of each label; unknown labels and nulls get -1.0."""

    missing = -1.0


class LabelIndexer(_LabelParams, IndexEstimator):
    """Ranks the distinct labels of a string column in ascending order, from 0."""

    model_class = LabelIndexerModel
