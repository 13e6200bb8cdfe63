"""Categories of any sortable type to int indexes; what is unknown becomes null."""

from __future__ import annotations

from pyspark.sql import types as T

from rankfold.functions.schemas import is_orderable
from rankfold.operators.base import IndexEstimator, IndexModel, IndexParams


class _CategoryParams(IndexParams):
    index_type = T.IntegerType()
    index_nullable = True

    def _check_key(self, data_type: T.DataType) -> None:
        if not is_orderable(data_type):
            raise ValueError(
                f"{self.uid}: column {self.getInputCol()!r} of type "
                f"{data_type.simpleString()} has no fixed order"
            )


class CategoryMapperModel(_CategoryParams, IndexModel):
    """Adds the index of each category; unknown categories and nulls get null."""

    missing = None


class CategoryMapper(_CategoryParams, IndexEstimator):
    """Ranks the distinct values of a column in ascending order, from 0."""

    model_class = CategoryMapperModel
