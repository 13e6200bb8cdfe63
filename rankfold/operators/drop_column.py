"""Dropping a column as a stage."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rankfold.functions.schemas import without_field
from rankfold.operators.lookup import note_source


class DropColumn(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Drops one column; an absent column, or none set, leaves the table as it is."""

    column = Param(
        Params._dummy(), "column", "name of the column that the result leaves out", typeConverter=TypeConverters.toString
    )

    def __init__(self, column=None):
        super().__init__()
        self._setDefault(column=None)
        self.setParams(column)

    def setParams(self, column=None):
        return self._set(column=column) if column else self

    def setDropCol(self, value):
        return self._set(column=value)

    def getDropCol(self):
        return self.getOrDefault(self.column)

    def output_schema(self, schema: T.StructType) -> T.StructType:
        """The schema of the result for an input of this schema."""
        column = self.getDropCol()
        return without_field(schema, column) if column else schema

    def _transform(self, dataset: DataFrame) -> DataFrame:
        column = self.getDropCol()
        return note_source(dataset.drop(column), dataset, column) if column else dataset

    def __repr__(self):
        return f"{type(self).__name__}: uid={self.uid}, column={self.getDropCol()}"
