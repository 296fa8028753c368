"""Feature scaling as a pipeline stage that can be fitted in folds, saved, loaded and used again.

The arithmetic is that of ``ml.scale_fit`` and ``ml.scaled``; transforming is Column
expressions.  Null features give null, an all-null or constant feature gives 0.5
(null where the row's own value is null).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from skyfare.operators.ml import _check_label, scale_fit, scaled


class _Columns(HasInputCols, HasOutputCols):
    """Columns to scale and the names of their scaled forms (default: ``<name>_scaled``)."""

    def outputs(self) -> list[str]:
        return self.getOutputCols() if self.isDefined(self.outputCols) else [f"{c}_scaled" for c in self.getInputCols()]


class MinMaxColumns(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fits each column's smallest and largest value in one aggregation pass."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: list(v) for k, v in self._input_kwargs.items() if v is not None})
        if self.isDefined(self.outputCols) and len(self.getOutputCols()) != len(self.getInputCols()):
            raise ValueError("as many output as input columns")

    def _fit(self, dataset: DataFrame) -> MinMaxColumnsModel:
        found = scale_fit(dataset, self.getInputCols())
        known = {c: v if None not in v else (0.0, 0.0) for c, v in found.items()}
        model = MinMaxColumnsModel()
        model._set(inputCols=self.getInputCols(), outputCols=self.outputs(),
                   lows=[float(known[c][0]) for c in self.getInputCols()],
                   highs=[float(known[c][1]) for c in self.getInputCols()])
        return model


class MinMaxColumnsModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the scaled columns; values outside the fitted range leave [0, 1]."""

    lows = Param(Params._dummy(), "lows", "smallest value of each column", TypeConverters.toListFloat)
    highs = Param(Params._dummy(), "highs", "largest value of each column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        places = zip(self.getInputCols(), self.outputs(), self.getOrDefault(self.lows), self.getOrDefault(self.highs),
                     strict=True)
        return dataset.withColumns({out: scaled(c, lo, hi) for c, out, lo, hi in places})


def feature_pipeline(cols: Sequence[str], label: str, *stages, features: str = "features") -> Pipeline:
    """Scaled columns, one vector of them (rows with a null feature are skipped), then ``stages``.

    The label is refused as a feature.  The fitted pipeline can be saved with
    ``write().save`` and read with ``PipelineModel.load``.
    """
    _check_label(cols, label)
    scaler = MinMaxColumns(inputCols=list(cols))
    return Pipeline(stages=[scaler, VectorAssembler(inputCols=scaler.outputs(), outputCol=features,
                                                    handleInvalid="skip"), *stages])
