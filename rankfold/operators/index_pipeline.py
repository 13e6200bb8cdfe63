"""A pipeline that learns the domains of several columns in one scan."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.pipeline import PipelineReader
from pyspark.sql import DataFrame

from rankfold.operators.base import IndexEstimator
from rankfold.operators.domain import learn_mappings
from rankfold.operators.drop_column import DropColumn


class IndexPipeline(Pipeline):
    """A ``Pipeline`` whose indexing stages are fitted together where they do not depend on each other.

    Neighbouring indexers and drops form a run. None of them changes which rows there are, so a
    run's indexers learn from the rows that enter it, all in one scan; a run ends at an indexer
    that reads what the run has made. Models, and what is declared and refused, are those of
    ``Pipeline``, and so is the fitted ``PipelineModel``.
    """

    @classmethod
    def read(cls) -> PipelineReader:
        return _Reader(cls)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        stages = self.getStages()
        fitted: list[Transformer] = []
        learning = max((i for i, stage in enumerate(stages) if not isinstance(stage, Transformer)), default=-1)
        at = 0
        while at < len(stages):
            run = self._run(stages, at, dataset)
            made = self._fit_run(run, dataset) if run else [self._fit_one(stages[at], dataset)]
            fitted += made
            at += len(made)
            if at <= learning:
                for model in made:
                    dataset = model.transform(dataset)
        return PipelineModel(fitted)

    @staticmethod
    def _fit_one(stage, dataset: DataFrame) -> Transformer:
        return stage if isinstance(stage, Transformer) else stage.fit(dataset)

    @staticmethod
    def _run(stages: list, start: int, dataset: DataFrame) -> list:
        """The stages from ``start`` on that read nothing that one of them has made or dropped."""
        run, schema, touched = [], dataset.schema, set()
        for stage in stages[start:]:
            if isinstance(stage, IndexEstimator):
                reads = stage.getInputCol() if stage.isDefined(stage.inputCol) else ""
                changes = stage.getOutputCol()
            elif isinstance(stage, DropColumn):
                reads, changes = None, stage.getDropCol() or ""
            else:
                break
            if reads is not None and reads.lower() in touched:
                break
            schema = stage.output_schema(schema)
            # Names that differ in case alone may name one column.
            touched.add(changes.lower())
            run.append(stage)
        return run

    @staticmethod
    def _fit_run(run: list, dataset: DataFrame) -> list[Transformer]:
        indexers = [stage for stage in run if isinstance(stage, IndexEstimator)]
        mappings = iter(learn_mappings(dataset, [stage._wanted(dataset.sparkSession) for stage in indexers]))
        return [stage._fitted(next(mappings)) if isinstance(stage, IndexEstimator) else stage for stage in run]


class _Reader(PipelineReader):
    def load(self, path: str) -> IndexPipeline:
        loaded = super().load(path)
        return IndexPipeline(stages=loaded.getStages())._resetUid(loaded.uid)
