"""Feature-preparation stages for Spark DataFrames: label ranks and column dropping."""

from rankfold.operators.category_mapper import CategoryMapper, CategoryMapperModel
from rankfold.operators.drop_column import DropColumn
from rankfold.operators.index_pipeline import IndexPipeline
from rankfold.operators.label_indexer import LabelIndexer, LabelIndexerModel

__all__ = [
    "CategoryMapper",
    "CategoryMapperModel",
    "DropColumn",
    "IndexPipeline",
    "LabelIndexer",
    "LabelIndexerModel",
]
