"""The scaling stage: equal to the plain functions, saved and loaded, fitted on training folds only."""

import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from skyfare.operators import ml
from skyfare.operators.stages import MinMaxColumns, MinMaxColumnsModel, feature_pipeline

ROWS = "x DOUBLE, c DOUBLE, n DOUBLE, y DOUBLE, fold INT"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(float(i), 3.0, None, 2.0 * i + 1, i % 3) for i in range(30)]
                                 + [(None, 3.0, None, 1.0, 0), (1000.0, 3.0, None, 2001.0, 2)], ROWS)


def test_scaling_equals_the_plain_functions_and_survives_saving(spark, rows, tmp_dir):
    stage = MinMaxColumns(inputCols=["x", "c", "n"])
    stage.write().overwrite().save(os.path.join(tmp_dir, "stage"))
    model = MinMaxColumns.load(os.path.join(tmp_dir, "stage")).fit(rows)
    want = ml.scale_apply(rows, ml.scale_fit(rows, ["x", "c", "n"])).collect()
    assert model.transform(rows).collect() == want
    model.write().overwrite().save(os.path.join(tmp_dir, "model"))
    again = MinMaxColumnsModel.load(os.path.join(tmp_dir, "model"))
    assert again.transform(rows).collect() == want
    named = MinMaxColumns(inputCols=["x"], outputCols=["z"]).fit(rows)
    assert named.transform(rows).columns == [*rows.columns, "z"]
    with pytest.raises(ValueError):
        MinMaxColumns(inputCols=["x", "c"], outputCols=["z"])


def test_a_saved_pipeline_predicts_the_same(spark, rows, tmp_dir):
    with pytest.raises(ValueError):
        feature_pipeline(["x", "y"], "y")
    fitted = feature_pipeline(["x", "c"], "y", LinearRegression(labelCol="y")).fit(rows)
    path = os.path.join(tmp_dir, "pipeline")
    fitted.write().overwrite().save(path)
    a = fitted.transform(rows).select("x", "prediction").collect()
    b = PipelineModel.load(path).transform(rows).select("x", "prediction").collect()
    assert a == b and len(a) == 31  # the row without x is skipped
    assert all(abs(r.prediction - (2 * r.x + 1)) < 1e-6 for r in a)


def test_cross_validation_fits_the_scaler_on_training_folds(spark, rows):
    lr = LinearRegression(labelCol="y")
    cv = CrossValidator(estimator=feature_pipeline(["x"], "y", lr), numFolds=3, foldCol="fold",
                        estimatorParamMaps=ParamGridBuilder().addGrid(lr.regParam, [0.0, 1.0]).build(),
                        evaluator=RegressionEvaluator(labelCol="y"), collectSubModels=True).fit(rows)
    for fold, models in enumerate(cv.subModels):
        highest = rows.where(F.col("fold") != fold).agg(F.max("x")).first()[0]
        assert all(m.stages[0].getOrDefault("highs") == [highest] for m in models)
    assert cv.subModels[2][0].stages[0].getOrDefault("highs") == [28.0]  # 1000 is in fold 2
    best = cv.bestModel.transform(rows).select(vector_to_array("features")[0].alias("f"))
    assert best.agg(F.max("f")).first()[0] == 1.0
