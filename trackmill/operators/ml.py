"""Weighted boosted-tree regression, per-group and ensemble training, imputation by models."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.operators.cleaning import numeric_columns
from trackmill.operators.percentiles import exact_percentiles
from trackmill.operators.sampling import part_counts, split_train_test, undersample, weights_inverse_freq
from trackmill.operators.stats import corr_matrix, rmse_expr, topk_per_group
from trackmill.operators.target_means import CrossFittedMeans, fold_of
from trackmill.session import materialise, shared_dir


#: Column with the fold of a row that a model learns from.
FOLD = "_fold"
FOLDS = 5


@dataclass(frozen=True)
class Features:
    """What a model reads.  ``wide`` categories have too many values for tree splits: each value is encoded by its mean
    label, learnt from the training rows only, and for these from the other folds' rows."""

    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    wide: Sequence[str] = ()
    label: str = "tow"
    weight: str | None = None
    key: str = "flight_id"

    def only(self, names: Iterable[str]) -> Features:
        chosen = set(names)
        return Features(
            [c for c in self.numeric if c in chosen], [c for c in self.categorical if c in chosen],
            [c for c in self.wide if c in chosen], self.label, self.weight, self.key,
        )


@dataclass(frozen=True)
class Boosting:
    """Parameters of the boosted trees.  ``max_bins`` grows to the largest category.

    Fixed values: the defaults are the published settings, as far as level-wise trees have them.
    """

    iterations: int = 680
    step: float = 0.0511
    depth: int = 8
    feature_fraction: str = "0.5022"
    row_fraction: float = 1.0
    min_rows: int = 36
    max_bins: int = 64
    seed: int = 42


#: A small size, to try things out.
TRIAL = Boosting(iterations=20, step=0.1, depth=5, feature_fraction="all", min_rows=1)


def build_pipeline(features: Features, params: Boosting) -> Pipeline:
    """Indexing, encoding, missing-value indicators, median filling, assembly and the regressor."""
    stages = []
    inputs: list[str] = []
    if features.categorical:
        text = ", ".join(f"CAST(`{c}` AS STRING) AS `{c}_text`" for c in features.categorical)
        stages.append(SQLTransformer(statement=f"SELECT *, {text} FROM __THIS__"))
        stages.append(StringIndexer(
            inputCols=[f"{c}_text" for c in features.categorical], outputCols=[f"{c}_index" for c in features.categorical],
            handleInvalid="keep",
        ))
        inputs += [f"{c}_index" for c in features.categorical]
    if features.wide:
        stages.append(CrossFittedMeans(
            inputCols=list(features.wide), outputCols=[f"{c}_level" for c in features.wide], labelCol=features.label, foldCol=FOLD, folds=FOLDS,
        ))
        inputs += [f"{c}_level" for c in features.wide]
    if features.numeric:
        marks = ", ".join(
            f"CAST(`{c}` AS DOUBLE) AS `{c}_value`, IF(`{c}` IS NULL, 1D, 0D) AS `{c}_missing`" for c in features.numeric
        )
        stages.append(SQLTransformer(statement=f"SELECT *, {marks} FROM __THIS__"))
        stages.append(Imputer(
            strategy="median", inputCols=[f"{c}_value" for c in features.numeric],
            outputCols=[f"{c}_filled" for c in features.numeric],
        ))
        inputs += [f"{c}_filled" for c in features.numeric] + [f"{c}_missing" for c in features.numeric]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    boosted = GBTRegressor(
        featuresCol="features", labelCol=features.label, predictionCol="tow_pred", maxIter=params.iterations,
        stepSize=params.step, maxDepth=params.depth, maxBins=params.max_bins, seed=params.seed,
        subsamplingRate=params.row_fraction, featureSubsetStrategy=params.feature_fraction,
        minInstancesPerNode=params.min_rows, checkpointInterval=10,
    )
    if features.weight:
        boosted.setWeightCol(features.weight)
    return Pipeline(stages=[*stages, boosted])


def fitting(df: DataFrame, features: Features, params: Boosting) -> tuple[Features, Boosting]:
    """Without numeric columns that have no known value in ``df`` (they cannot be filled), and with a bin per category."""
    counts = df.agg(
        F.count(F.lit(1)), *[F.count(c).alias(f"n_{c}") for c in features.numeric],
        *[F.count_distinct(c).alias(f"d_{c}") for c in features.categorical],
    ).first()
    # One bin more is for values that the training rows do not hold.
    bins = max([params.max_bins, *[counts[f"d_{c}"] + 1 for c in features.categorical]])
    return replace(features, numeric=[c for c in features.numeric if counts[f"n_{c}"]]), replace(params, max_bins=bins)


def fit(df: DataFrame, features: Features, params: Boosting = Boosting()) -> PipelineModel:
    shared_dir(df.sparkSession)  # boosting checkpoints its residuals there
    taught = df.withColumn(FOLD, fold_of(F.col(features.key), FOLDS, params.seed)) if features.wide else df
    return build_pipeline(*fitting(df, features, params)).fit(taught)


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predictions with exactly the columns the model was fitted on."""
    return model.transform(df).select(*keep, "tow_pred")


@dataclass
class Trained:
    """Outcome of one training run."""

    holdout: PipelineModel
    full: PipelineModel
    predictions: DataFrame
    submission: DataFrame
    scores: Mapping[str, float | None]
    extra: dict = field(default_factory=dict)


def gbt_fit_predict(df: DataFrame, features: Features, params: Boosting = Boosting(), test_percent: int = 20,
                    unlabelled: DataFrame | None = None, keep: Sequence[str] = ("aircraft_type",),
                    weigh: Callable[[DataFrame], DataFrame] | None = None, also: Sequence[str] = ()) -> Trained:
    """Fit on the train part, score on the test part, refit on all labelled rows, predict the others.

    ``weigh`` adds the weight column (from ``also``, if it needs more columns), to the train part for the first fit and to all
    labelled rows for the second: no weight knows of test rows.  Labelled rows are materialised once as they are read several times
    in a fit; weights are computed at every reading.
    """
    label, key = features.label, features.key
    given = [features.weight] if features.weight and weigh is None else []
    used = list(dict.fromkeys([key, label, *features.numeric, *features.categorical, *features.wide, *given, *keep, *also]))

    def weighted(part: DataFrame) -> DataFrame:
        return part if weigh is None else weigh(part)

    labelled = materialise(
        split_train_test(df.filter(F.col(label).isNotNull()).select(*used), key, test_percent), "labelled"
    )
    holdout = fit(weighted(labelled.filter("test = 0")), features, params)
    predictions = materialise(predict(holdout, labelled, [key, *keep, "test", label]), "predictions")
    rows = predictions.groupBy("test").agg(rmse_expr(label).alias("rmse")).collect()
    by_part = {r["test"]: r["rmse"] for r in rows}
    full = fit(weighted(labelled), features, params)
    rest = df.filter(F.col(label).isNull()) if unlabelled is None else unlabelled
    submission = predict(full, rest, [key, *keep]).select(key, *keep, F.col("tow_pred").alias(label))
    return Trained(holdout, full, predictions, submission, {"train": by_part.get(0), "test": by_part.get(1)})


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(feature, importance)`` of a fitted pipeline, best first; importances sum to one."""
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_run(trained: Trained, folder: str, model_id: int, spark: SparkSession) -> None:
    """Both models of a training run, and the importances of the one that was scored."""
    save_model(trained.full, f"{folder}/model_{model_id}")
    save_model(trained.holdout, f"{folder}/holdout_{model_id}")
    feature_importance(spark, trained.holdout).write.mode("overwrite").parquet(f"{folder}/importance_{model_id}")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_jobs(tasks: Sequence[Callable], parallel: int = 4) -> list:
    """Submit independent Spark fits from a few driver threads; the cluster runs their jobs side by side."""
    if parallel <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPool(min(parallel, len(tasks))) as pool:
        return pool.map(lambda task: inherit(task)(), tasks)


def train_per_group(df: DataFrame, features: Features, groups: Sequence, by: str = "aircraft_type",
                    params: Boosting = Boosting(), boosted=None, share: float = 0.85,
                    parallel: int = 4, save_to: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One model per group, on a set where the other groups are capped at ``share`` of its size.

    Returns long predictions and submissions tagged ``model_id``, and the scores of each model overall and
    on its own group.  ``groups`` is a short list (types above the rarity threshold).  The cap counts
    labelled and unlabelled rows, before the unlabelled ones are set aside.  ``save_to`` gets what :func:`save_run` writes.
    """
    source = materialise(df, "group_source")
    unlabelled = source.filter(F.col(features.label).isNull())
    weighted = Features(features.numeric, features.categorical, features.wide, features.label, "weight", features.key)
    counts = part_counts(source, by, features.key)

    def one(model_id: int, group) -> Trained:
        chosen = undersample(source, by, group, share, features.key, counts=counts).filter(F.col(features.label).isNotNull())
        chosen = chosen.withColumn("_boosted", F.lit(False) if boosted is None else F.coalesce(boosted, F.lit(False)))
        trained = gbt_fit_predict(
            chosen, weighted, params, unlabelled=unlabelled, keep=[by], also=["_boosted"],
            weigh=lambda part: weights_inverse_freq(part, by, group, None if boosted is None else F.col("_boosted")),
        )
        trained.extra["own"] = trained.predictions.filter((F.col("test") == 1) & F.col(by).eqNullSafe(F.lit(group))).agg(
            rmse_expr(features.label)
        ).first()[0]
        if save_to:
            save_run(trained, save_to, model_id, df.sparkSession)
        return trained

    results = run_jobs([lambda i=i, g=g: one(i, g) for i, g in enumerate(groups)], parallel)
    return _stack(df.sparkSession, results, [str(g) for g in groups])


def _stack(spark: SparkSession, results: Sequence[Trained], names: Sequence[str]):
    def tagged(frames: Iterable[tuple[int, DataFrame]]) -> DataFrame:
        out = None
        for i, frame in frames:
            frame = frame.withColumn("model_id", F.lit(i))
            out = frame if out is None else out.unionByName(frame)
        return out

    done = [(i, r) for i, r in enumerate(results) if r is not None]
    predictions = tagged((i, r.predictions) for i, r in done)
    submissions = tagged((i, r.submission) for i, r in done)
    scores = spark.createDataFrame(
        [(i, names[i], r.scores["train"], r.scores["test"], r.extra.get("own")) for i, r in done],
        "model_id int, name string, rmse_train double, rmse_test double, rmse_own double",
    )
    return predictions, submissions, scores


def train_ensemble(df: DataFrame, features: Features, plan: Sequence[tuple[int, Sequence[str]]],
                   params: Boosting = Boosting(), parallel: int = 4,
                   failed: Callable[[int, Exception], None] | None = None, save_to: str | None = None):
    """One model per feature list of ``plan``; a failing fit is reported and skipped.  ``save_to`` gets what :func:`save_run` writes.

    Returns predictions, submissions and scores as :func:`train_per_group` does.
    """
    source = materialise(df, "ensemble_source")

    def one(model_id: int, names: Sequence[str]) -> Trained | None:
        try:
            trained = gbt_fit_predict(source, features.only(names), params)
            if save_to:
                save_run(trained, save_to, model_id, df.sparkSession)
            return trained
        except Exception as error:  # go on with the other models
            (failed or (lambda i, e: print(f"model {i} failed: {e}")))(model_id, error)
            return None

    results = run_jobs([lambda i=i, f=f: one(i, f) for i, f in plan], parallel)
    return _stack(df.sparkSession, results, [f"subset {i}" for i, _ in plan])


def impute_by_model(df: DataFrame, cols: Sequence[str] | None = None, k: int = 50, label: str = "tow",
                    key: str = "flight_id", allow_label: bool = False, method: str = "gbt",
                    iterations: int = 100, depth: int = 5, step: float = 0.05, cut_every: int = 4) -> DataFrame:
    """Fill NULLs of numeric columns one after the other, each from its most correlated columns.

    ``method``: ``gbt`` (boosted trees), ``linear`` (ridge) or ``median``.  Later columns see
    earlier fills.  Lineage is cut by writing the table every ``cut_every`` columns.
    """
    shared_dir(df.sparkSession)
    spare = {key} | (set() if allow_label else {label})
    numeric = [c for c in numeric_columns(df) if c not in spare]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in numeric], F.count(F.lit(1)).alias("_rows")).first()
    # A column without any known value has nothing to learn from.
    usable = [c for c in numeric if counts[c] < counts["_rows"]]
    todo = [c for c in (cols or usable) if c in usable and c != label and counts[c] > 0]
    if not todo:
        return df
    out = materialise(df, "impute")
    if method == "median":
        everything = out.withColumn("_all", F.lit(0))
        medians = exact_percentiles(everything, ["_all"], {c: (F.col(c), 0.5) for c in todo}).first()
        kinds = dict(out.dtypes)
        return out.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c]).cast(kinds[c])) for c in todo})
    partners: dict[str, list[str]] = {}
    for row in topk_per_group(corr_matrix(out, usable), k).filter(F.col("a").isin(todo)).orderBy("a", "rank").collect():
        partners.setdefault(row["a"], []).append(row["b"])
    kinds = dict(out.dtypes)

    def median_filled(frame: DataFrame, c: str) -> DataFrame:
        middle = exact_percentiles(frame.withColumn("_all", F.lit(0)), ["_all"], {c: (F.col(c), 0.5)}).first()[c]
        return frame.withColumn(c, F.coalesce(F.col(c), F.lit(middle).cast(kinds[c])))

    for done, c in enumerate(todo, 1):
        if not partners.get(c):  # nothing to predict it from
            out = median_filled(out, c)
            continue
        inputs = [f"_in_{p}" for p in partners[c]]
        ready = out.withColumns({f"_in_{p}": F.col(p).cast("double") for p in partners[c]})
        train = ready.filter(F.col(c).isNotNull()).withColumn("_y", F.col(c).cast("double"))
        if method == "gbt":
            model = GBTRegressor(featuresCol="_x", labelCol="_y", predictionCol="_fill", maxIter=iterations,
                                 maxDepth=depth, stepSize=step, seed=42, checkpointInterval=10)
        elif method == "linear":
            model = LinearRegression(featuresCol="_x", labelCol="_y", predictionCol="_fill", regParam=1e-3)
        else:
            raise ValueError(f"unknown method {method!r}")
        # A predictor known only where the target is not would have no median: use those known in training.
        have = train.agg(*[F.count(i).alias(i) for i in inputs]).first()
        inputs = [i for i in inputs if have[i]]
        if not inputs:
            out = median_filled(out, c)
            continue
        fitted = Pipeline(stages=[
            Imputer(strategy="median", inputCols=inputs, outputCols=inputs),
            VectorAssembler(inputCols=inputs, outputCol="_x"), model,
        ]).fit(train)
        kind = dict(out.dtypes)[c]
        filled = fitted.transform(ready).withColumn(c, F.coalesce(F.col(c), F.col("_fill").cast(kind)))
        out = filled.select(*df.columns)
        if done % cut_every == 0 and done < len(todo):
            out = materialise(out, "impute")
    return out


__all__ = [
    "Boosting", "Features", "TRIAL", "Trained", "build_pipeline", "feature_importance", "fit",
    "gbt_fit_predict", "impute_by_model", "load_model", "predict", "run_jobs", "save_model", "save_run", "train_ensemble",
    "train_per_group",
]
