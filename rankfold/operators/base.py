"""What the two indexing estimators and their models have in common."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping as PairsByKey
from dataclasses import replace

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsWritable,
    MLReadable,
    MLWritable,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfold.functions.names import quoted
from rankfold.functions.schemas import common_key_type, input_field, with_field
from rankfold.operators.domain import Wanted, hot_values, learn_mappings
from rankfold.operators.limits import Limits
from rankfold.operators.lookup import add_index, note_source
from rankfold.operators.mapping import Mapping, freeze_given
from rankfold.sources.model_files import MappingModelReader, MappingModelWriter
from rankfold.sources.bucketed import MOST_BUCKETS, write_buckets
from rankfold.sources.store import new_folder, qualified, remove_folder


# Types whose values a literal gives back exactly.
_BOUNDED = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType)


class IndexParams(HasInputCol, HasOutputCol):
    """Input and output column, and the schema rule both stages follow."""

    # Set by each kind of stage.
    index_type: T.DataType
    index_nullable: bool

    planLimits = Param(
        Params._dummy(), "planLimits", "size limits in place of the session's, by option name"
    )

    textOrder = Param(
        Params._dummy(), "textOrder", "order of text: codepoint, or utf16 by units of UTF-16", TypeConverters.toString
    )

    def __init__(self):
        super().__init__()
        self._setDefault(outputCol=self.uid + "__output", planLimits={}, textOrder="codepoint")

    def _set_given(self, **params):
        return self._set(**{name: v for name, v in params.items() if v is not None})

    def setInputCol(self, value):
        return self._set(inputCol=value)

    def setOutputCol(self, value):
        return self._set(outputCol=value)

    def setPlanLimits(self, **limits):
        """Limits of this stage, named as the session's options; they change no result."""
        return self._set(planLimits={name: str(value) for name, value in limits.items()})

    def getPlanLimits(self) -> dict[str, str]:
        return self.getOrDefault(self.planLimits)

    def setTextOrder(self, value):
        """``utf16`` numbers text as the JVM compares strings; the default is by code point."""
        if value not in ("codepoint", "utf16"):
            raise ValueError(f"text order is codepoint or utf16, not {value!r}")
        return self._set(textOrder=value)

    def getTextOrder(self) -> str:
        return self.getOrDefault(self.textOrder)

    def _limits(self, spark: SparkSession) -> Limits:
        return Limits.of(spark, self.getPlanLimits())

    def _check_key(self, data_type: T.DataType) -> None:
        """Raise ValueError if the stage cannot index values of this type."""
        raise NotImplementedError

    def output_schema(self, schema: T.StructType) -> T.StructType:
        """The schema of the result for an input of this schema, or ValueError."""
        if not self.isDefined(self.inputCol):
            raise ValueError(f"{self.uid}: inputCol is not set")
        key_type = input_field(schema, self.getInputCol()).dataType
        self._check_key(key_type)
        if self.getTextOrder() == "utf16" and key_type != T.StringType():
            raise ValueError(f"{self.uid}: {key_type.simpleString()} has no order by UTF-16 units")
        added = T.StructField(self.getOutputCol(), self.index_type, self.index_nullable)
        return with_field(schema, added)

    def __repr__(self):
        return f"{type(self).__name__}: uid={self.uid}"


class IndexEstimator(IndexParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the sorted distinct values of the input column."""

    model_class: type[IndexModel]

    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self.setParams(inputCol=inputCol, outputCol=outputCol)

    def setParams(self, *, inputCol=None, outputCol=None):
        return self._set_given(inputCol=inputCol, outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> IndexModel:
        self.output_schema(dataset.schema)
        return self._fitted(learn_mappings(dataset, [self._wanted(dataset.sparkSession)])[0])

    def _wanted(self, spark: SparkSession) -> Wanted:
        utf16 = self.getTextOrder() == "utf16"
        return Wanted(self.getInputCol(), self.index_type, self._limits(spark), utf16)

    def _fitted(self, mapping: Mapping) -> IndexModel:
        model = self.model_class()
        model._mapping = mapping
        model._resetUid(self.uid)
        return self._copyValues(model)


class IndexModel(IndexParams, Model, MLReadable, MLWritable):
    """Replaces values by the index they have in a frozen mapping."""

    # Index of a value without an entry; None leaves it null.
    missing: float | None

    def __init__(self, *, inputCol=None, outputCol=None, mappingCat=None):
        super().__init__()
        self._mapping: Mapping | None = None
        self.setParams(inputCol=inputCol, outputCol=outputCol, mappingCat=mappingCat)

    def setParams(self, *, inputCol=None, outputCol=None, mappingCat=None):
        self._set_given(inputCol=inputCol, outputCol=outputCol)
        return self if mappingCat is None else self.setMappingCat(mappingCat)

    @classmethod
    def from_mapping(cls, mapping, inputCol=None, outputCol=None):
        """A model from a table of (category, index), a dict, or a list of pairs."""
        return cls(inputCol=inputCol, outputCol=outputCol, mappingCat=mapping)

    def setMappingCat(self, value: DataFrame | PairsByKey | Iterable):
        if not isinstance(value, DataFrame):
            pairs = list(value.items() if isinstance(value, PairsByKey) else value)
            spark = SparkSession.active()
            if pairs:
                value = spark.createDataFrame([tuple(p) for p in pairs], ["category", "idx"])
            else:
                value = spark.createDataFrame([], "category void, idx int")
        self._mapping = freeze_given(value, self.index_type, self._limits(value.sparkSession))
        return self

    def learn_hot(self, rows: DataFrame):
        """Note which values of the input column are frequent in ``rows``, known or not.

        A shuffled lookup then spreads their rows. Fitting a large mapping does this with
        the fitted rows; results are the same either way.
        """
        limits = self._limits(rows.sparkSession)
        self._mapping = replace(self._frozen(), hot=hot_values(rows, self.getInputCol(), limits))
        return self

    def co_partition(self, buckets: int | None = None):
        """Deal a mapping too large to broadcast into buckets by key, once.

        Lookups, each micro-batch of a stream among them, then shuffle their rows alone; so do
        those of the model as it is saved and loaded. ``buckets`` is the least number of tasks a
        lookup has, by default that of shuffle partitions; a mapping whose buckets would go beyond
        ``bucketBytes`` gets a multiple of it. Smaller mappings stay as they are, and
        so do those with frequent values, whose rows are spread in another way.
        """
        frozen = self._frozen()
        spark = SparkSession.active()
        limits = self._limits(spark)
        if frozen.buckets is None and not frozen.broadcastable(limits):
            least = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            count = frozen.bucket_count(least, int(spark.conf.get(MOST_BUCKETS)), limits)
            dealt = write_buckets(frozen.frame(spark), new_folder(spark, "mapping"), count)
            self._mapping = replace(frozen, buckets=dealt)
        return self

    def release(self) -> None:
        """Remove the working table of a mapping that has one; the model has no mapping then.

        Saved models stay, and so does a mapping that is read from one. Copies of this
        model share the table.
        """
        frozen, self._mapping = self._frozen(), None
        spark = SparkSession.active()
        if frozen.buckets is not None:
            frozen.buckets.forget(spark)
            # A saved mapping's buckets are its own files, by their whole address.
            if qualified(spark, frozen.buckets.folder) != qualified(spark, frozen.folder):
                remove_folder(spark, frozen.buckets.folder)
        if frozen.folder is not None and frozen.own_folder:
            remove_folder(spark, frozen.folder)

    @property
    def mapping(self) -> DataFrame:
        """The mapping as a table ``category, idx``, whatever its size."""
        return self._frozen().frame(SparkSession.active())

    def mapping_pairs(self) -> Iterator[tuple]:
        """All (category, index) pairs in index order; the driver holds a partition at a time.

        Categories of a type Python has no value for, year-month intervals, are numbers
        of months.
        """
        rows = self.mapping
        if isinstance(self._frozen().key_type, T.YearMonthIntervalType):
            months = F.expr("12 * extract(YEAR FROM category) + extract(MONTH FROM category)")
            rows = rows.orderBy("idx", "category").select(months.cast("int").alias("category"), "idx")
        else:
            rows = rows.orderBy("idx", "category")
        return ((row["category"], row["idx"]) for row in rows.toLocalIterator())

    def mapping_dict(self, limit: int | None = None) -> dict:
        """The mapping as a dict; past ``limit`` entries use ``mapping_pairs``."""
        self._refuse_above(limit)
        return dict(self.mapping_pairs())

    def getMappingCat(self, limit: int | None = None) -> list[tuple]:
        """The mapping as (category, index) pairs in index order, as ``mapping_dict``."""
        self._refuse_above(limit)
        return list(self.mapping_pairs())

    def _refuse_above(self, limit: int | None) -> None:
        labels = self._frozen().labels
        if limit is None:
            limit = self._limits(SparkSession.active()).collected_labels
        if labels > limit:
            raise ValueError(f"{labels} labels: read .mapping or .mapping_pairs(), or give a limit")

    @property
    def mapping_cat(self) -> dict:
        return self.mapping_dict()

    def _frozen(self) -> Mapping:
        if self._mapping is None:
            raise ValueError(f"{self.uid}: the model has no mapping")
        return self._mapping

    def output_schema(self, schema: T.StructType) -> T.StructType:
        declared = super().output_schema(schema)
        frozen = self._frozen()
        data_type = schema[self.getInputCol()].dataType
        if common_key_type(data_type, frozen.key_type) is None:
            raise ValueError(
                f"{self.uid}: the mapping has {frozen.key_type.simpleString()} keys, "
                f"column {self.getInputCol()!r} is {data_type.simpleString()}"
            )
        return declared

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.output_schema(dataset.schema)
        indexed = add_index(
            dataset,
            self.getInputCol(),
            self.getOutputCol(),
            self._frozen(),
            self.missing,
            self._limits(dataset.sparkSession),
        )
        return note_source(indexed, dataset, self.getOutputCol())

    def transform_between(self, dataset: DataFrame, low, high) -> DataFrame:
        """``transform``, then the rows whose index is from ``low`` to ``high``.

        The least and the greatest category with such an index bound the input column before
        the lookup, so the scan of the rows can skip what lies outside. An index in the range
        always has its category within these bounds, whatever the order of the mapping.
        """
        self.output_schema(dataset.schema)
        index = F.col(quoted(self.getOutputCol()))
        rows, column = dataset, self.getInputCol()
        if self.missing is None or not low <= self.missing <= high:
            category = F.col("category")
            wanted = self._frozen().frame(dataset.sparkSession).where(F.col("idx").between(low, high))
            least, greatest = wanted.agg(F.min(category), F.max(category)).head()
            key = F.col(quoted(column))
            key_type = dataset.schema[column].dataType
            if least is None:
                rows = dataset.where(F.lit(False))
            elif key_type == self._frozen().key_type and isinstance(key_type, _BOUNDED):
                rows = dataset.where(key.between(F.lit(least).cast(key_type), F.lit(greatest).cast(key_type)))
        return self.transform(rows).where(index.between(low, high))

    def write(self) -> MappingModelWriter:
        return MappingModelWriter(self)

    @classmethod
    def read(cls) -> MappingModelReader:
        return MappingModelReader(cls)
