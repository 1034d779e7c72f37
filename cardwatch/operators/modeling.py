"""Spark ML training, tuning and scoring of fraud classifiers."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType

from cardwatch.operators.confusion import metric_table
from cardwatch.operators.ranking import area_under_roc
from cardwatch.operators.rows import side_by_side

SEED = 42


def numeric_features(df: DataFrame, label: str, exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns a model can take, in table order.  Ids have to be excluded by name."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (NumericType, BooleanType)) and f.name not in (label, *exclude)
    ]


def assemble(features: list[str], handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(
        inputCols=features, outputCol="features_raw", handleInvalid=handle_invalid
    )


def standardize() -> StandardScaler:
    return StandardScaler(
        inputCol="features_raw", outputCol="features", withMean=True, withStd=True
    )


def classifier(kind: str, label: str):
    if kind == "rf":
        return RandomForestClassifier(
            labelCol=label, featuresCol="features", numTrees=10, maxDepth=5, seed=SEED
        )
    if kind == "lr":
        return LogisticRegression(labelCol=label, featuresCol="features")
    raise ValueError(f"model type is rf or lr, not {kind}")


def model_stages(
    features: list[str], label: str, kind: str = "rf", handle_invalid: str = "error"
) -> Pipeline:
    stages = [assemble(features, handle_invalid), standardize(), classifier(kind, label)]
    return Pipeline(stages=stages)


def parameter_grid(estimator: Pipeline) -> list[dict]:
    """Trees 10, 20 by depth 5, 10; regularization 0, 0.01, 0.1 for lr."""
    last = estimator.getStages()[-1]
    grid = ParamGridBuilder()
    if isinstance(last, RandomForestClassifier):
        grid = grid.addGrid(last.numTrees, [10, 20]).addGrid(last.maxDepth, [5, 10])
    else:
        grid = grid.addGrid(last.regParam, [0.0, 0.01, 0.1])
    return grid.build()


def cross_validate(
    df: DataFrame,
    features: list[str],
    label: str,
    kind: str = "rf",
    fold: str = "fold",
    folds: int = 3,
    parallelism: int = 2,
    handle_invalid: str = "error",
) -> CrossValidatorModel:
    """Tune on the AUC over the folds in column ``fold``, then refit the best point."""
    estimator = model_stages(features, label, kind, handle_invalid)
    tuning = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=parameter_grid(estimator),
        evaluator=BinaryClassificationEvaluator(labelCol=label, numBins=0),
        numFolds=folds,
        foldCol=fold,
        parallelism=parallelism,
        seed=SEED,
    )
    return tuning.fit(df)


def grid_results(tuned: CrossValidatorModel, spark) -> DataFrame:
    """One row per grid point: its parameters, mean AUC, and whether the model was refitted with it."""
    best = best_params(tuned.bestModel)
    rows = []
    for point, auc in zip(tuned.getEstimatorParamMaps(), tuned.avgMetrics):
        params = {param.name: float(value) for param, value in point.items()}
        rows.append((params, float(auc), params == best))
    return spark.createDataFrame(rows, "params map<string,double>, auc double, is_best boolean")


def best_params(model: PipelineModel) -> dict[str, float]:
    """The parameters the winning classifier was tuned over."""
    last = model.stages[-1]
    if hasattr(last, "getNumTrees"):
        return {"numTrees": float(last.getNumTrees), "maxDepth": float(last.getMaxDepth())}
    return {"regParam": float(last.getRegParam())}


def fraud_probability(probability: Column) -> Column:
    """Element 1, else element 0, else null."""
    parts = F.when(probability.isNotNull(), vector_to_array(probability))
    return F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))


def decode_prediction(prediction: Column) -> Column:
    return F.coalesce(prediction.try_cast("int"), F.lit(-1))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def calls(scored: DataFrame, label: str) -> DataFrame:
    """What evaluation needs of a scored table: ``label``, ``called`` and ``score``."""
    return scored.select(
        F.col(label).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("called"),
        fraud_probability(F.col("probability")).alias("score"),
    )


def evaluate(made: DataFrame) -> DataFrame:
    """One row: exact AUC, accuracy and class-weighted F1 of :func:`calls`.

    Reads its input several times; write the calls first when the model is costly.
    """
    by_count = metric_table(made, "label", "called")
    both = side_by_side(area_under_roc(made, "score", "label"), by_count)
    return both.select("auc", "accuracy", F.col("f1_weighted").alias("f1"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
