"""``pyspark.ml`` model specs, training with failure isolation, importances.

Two hyperparameter profiles, as in the reference:

* ``fast``: linear (scaled, no centring, 20 iterations), tree depth 6, forest 5x5
* ``full``: linear (scaled and centred, 50 iterations), tree depth 8,
  forest 30x10, boosted trees 30x6

All fitting is Spark ML's distributed code: the linear model takes the
normal-equation solver (one aggregation of a 10x10 Gram matrix), and the
trees aggregate split statistics per level on the executors. Only model
parameters come back to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.evaluate import evaluation_table, metrics_dict
from meterline.operators.validate import require_columns
from meterline.schemas import FEATURE_COLUMNS, IMPORTANCE_SCHEMA, LABEL

# Model display names.
LINEAR = "Linear Regression"
TREE = "Decision Tree Regression"
FOREST = "Random Forest Regression"
BOOSTED = "GBT Regression"
TREE_MODELS = (TREE, FOREST, BOOSTED)

SEED = 42


@dataclass(frozen=True)
class Profile:
    linear_center: bool
    linear_max_iter: int
    tree_depth: int
    forest_trees: int
    forest_depth: int
    boosted_iter: int | None
    boosted_depth: int
    reg_param: float = 0.1


# The two hyperparameter profiles.
PROFILES = {
    "fast": Profile(linear_center=False, linear_max_iter=20, tree_depth=6, forest_trees=5, forest_depth=5, boosted_iter=None, boosted_depth=6),
    "full": Profile(linear_center=True, linear_max_iter=50, tree_depth=8, forest_trees=30, forest_depth=10, boosted_iter=30, boosted_depth=6),
}


@dataclass
class ModelSpec:
    """A model as the stages after feature assembly, plus the shared assembler.

    ``pipeline`` is the whole thing (assembler first) for raw-column frames;
    ``tail`` fits on frames that already carry the assembled ``features``
    vector, which lets a job assemble once for all models.
    """

    name: str
    assembler: VectorAssembler
    tail: list

    @property
    def pipeline(self) -> Pipeline:
        return Pipeline(stages=[self.assembler, *self.tail])


@dataclass
class ModelResult:
    name: str
    position: int
    success: bool
    model: PipelineModel | None = None
    predictions: DataFrame | None = None
    rmse: float | None = None
    mae: float | None = None
    r2: float | None = None
    error: str | None = field(default=None, repr=False)
    # Error range and maxima from the same metrics pass (histogram bounds, axis bound).
    extras: dict = field(default_factory=dict, repr=False)


def _assembler(features: list[str], out: str) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=out)


def model_specs(profile: str = "fast", features: list[str] = FEATURE_COLUMNS, checkpoint_interval: int = 10) -> list[ModelSpec]:
    p = PROFILES[profile]
    specs = [
        ModelSpec(
            LINEAR,
            _assembler(features, "features"),
            [
                StandardScaler(inputCol="features", outputCol="scaled_features", withStd=True, withMean=p.linear_center),
                LinearRegression(
                    featuresCol="scaled_features", labelCol=LABEL, maxIter=p.linear_max_iter,
                    regParam=p.reg_param, elasticNetParam=0.0,
                ),
            ],
        ),
        ModelSpec(
            TREE,
            _assembler(features, "features"),
            [DecisionTreeRegressor(featuresCol="features", labelCol=LABEL, maxDepth=p.tree_depth, seed=SEED)],
        ),
        ModelSpec(
            FOREST,
            _assembler(features, "features"),
            [
                RandomForestRegressor(
                    featuresCol="features", labelCol=LABEL, numTrees=p.forest_trees, maxDepth=p.forest_depth,
                    seed=SEED, cacheNodeIds=True, checkpointInterval=checkpoint_interval,
                )
            ],
        ),
    ]
    if p.boosted_iter:
        specs.append(
            ModelSpec(
                BOOSTED,
                _assembler(features, "features"),
                [
                    GBTRegressor(
                        featuresCol="features", labelCol=LABEL, maxIter=p.boosted_iter, maxDepth=p.boosted_depth,
                        seed=SEED, checkpointInterval=checkpoint_interval,
                    )
                ],
            )
        )
    return specs


def assembled(df: DataFrame, features: list[str] = FEATURE_COLUMNS, keep: list[str] | None = None) -> DataFrame:
    """Add the ``features`` vector once; ``keep`` narrows the other columns
    (a training cache needs only ``label`` and the vector)."""
    out = _assembler(features, "features").transform(df)
    return out.select(*keep, "features") if keep is not None else out


def model_input(clean: DataFrame, features: list[str] = FEATURE_COLUMNS, keep: tuple[str, ...] = ("key",)) -> DataFrame:
    """Clean table -> ``key``, ``label`` and the ordered features."""
    df = clean.withColumnRenamed("fare_amount", LABEL)
    require_columns(df, [LABEL, *features], "model input")
    kept = [c for c in keep if c in df.columns]
    return df.select(*kept, LABEL, *features)


def failure_text(error: Exception) -> str:
    """Exception type and message, without the engine's stack."""
    message = str(error).strip().split("\n\tat ")[0].split("JVM stacktrace")[0].strip()
    return f"{type(error).__name__}: {message}"


def train_one(
    spec: ModelSpec, position: int, train: DataFrame, test: DataFrame, isolate: bool = True, pre_assembled: bool = False
) -> ModelResult:
    """Fit on ``train``, score ``test``, and compute all three metrics in one pass.

    With ``pre_assembled`` both frames already carry ``features``. Only the
    stages after assembly are fitted, and the assembler is put back in front,
    so the returned ``PipelineModel`` still scores raw clean rows. With
    ``isolate`` a failure is recorded on the result (the other models still
    run); without it the error propagates.
    """
    try:
        if pre_assembled:
            fitted_tail = Pipeline(stages=spec.tail).fit(train)
            model = PipelineModel(stages=[spec.assembler, *fitted_tail.stages])
            predictions = fitted_tail.transform(test)
        else:
            model = spec.pipeline.fit(train)
            predictions = model.transform(test)
        m = metrics_dict(predictions)
        extras = {k: v for k, v in m.items() if k not in ("rmse", "mae", "r2")}
        return ModelResult(spec.name, position, True, model, predictions, m["rmse"], m["mae"], m["r2"], extras=extras)
    except Exception as error:  # noqa: BLE001 - failure isolation is the feature
        if not isolate:
            raise
        return ModelResult(spec.name, position, False, error=failure_text(error))


def train_all(
    specs: list[ModelSpec],
    train: DataFrame,
    test: DataFrame,
    isolate: bool = True,
    parallelism: int = 1,
    pre_assembled: bool = False,
) -> list[ModelResult]:
    """Train every spec; results keep the spec order.

    With ``parallelism > 1`` the fits are submitted from that many driver
    threads, so their Spark jobs share the cluster, as ``pyspark.ml``'s
    tuners do with their ``parallelism`` parameter. Each model is
    independent, so the results equal a sequential run.
    """
    if parallelism <= 1 or len(specs) <= 1:
        return [train_one(s, i, train, test, isolate, pre_assembled) for i, s in enumerate(specs)]
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.util import inheritable_thread_target

    with ThreadPoolExecutor(max_workers=min(parallelism, len(specs))) as pool:
        # Wrapped here, in the calling thread, so each fit's jobs inherit the
        # caller's local properties (job group, scheduler pool).
        futures = [
            pool.submit(inheritable_thread_target(train.sparkSession)(train_one), s, i, train, test, isolate, pre_assembled)
            for i, s in enumerate(specs)
        ]
        return [f.result() for f in futures]


def successful(results: list[ModelResult]) -> list[ModelResult]:
    """Only the models that trained; raises if none did."""
    ok = [r for r in results if r.success]
    if not ok:
        errors = "; ".join(f"{r.name}: {r.error or 'no error text'}" for r in results)
        raise RuntimeError(f"every model failed, nothing to evaluate ({errors})")
    return ok


def best_result(results: list[ModelResult]) -> ModelResult:
    """Lowest RMSE among successful models; ties go to the earlier model, one without an RMSE comes last."""
    return min(successful(results), key=lambda r: (r.rmse is None, r.rmse or 0.0, r.position))


def results_table(spark: SparkSession, results: list[ModelResult]) -> DataFrame:
    """(model, rmse, mae, r2, position): one row per successful model."""
    return evaluation_table(spark, [(r.name, r.rmse, r.mae, r.r2) for r in successful(results)])


def feature_importances(spark: SparkSession, result: ModelResult, features: list[str] = FEATURE_COLUMNS) -> DataFrame | None:
    """(feature, importance) for a tree model, else ``None``.

    Importances are a property of the fitted model (one value per feature),
    so this table is as small as the feature list.
    """
    if result.name not in TREE_MODELS or result.model is None:
        return None
    values = result.model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, values)], IMPORTANCE_SCHEMA)


def ranked_importances(importances: DataFrame | None) -> DataFrame | None:
    """Importances ordered largest first, with feature order breaking ties."""
    if importances is None:
        return None
    pos = F.array_position(F.array(*[F.lit(f) for f in FEATURE_COLUMNS]), F.col("feature"))
    return importances.orderBy(F.col("importance").desc(), pos)


def prediction_frame(result: ModelResult) -> DataFrame:
    """Predictions without the ML vector columns."""
    return result.predictions.drop("features", "scaled_features")
