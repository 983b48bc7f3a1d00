"""Choosing, voting and blending predictions.  Predictions are long: one row per flight and model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.operators.cleaning import dedup_first
from trackmill.operators.stats import rmse_expr

#: Error assigned to a group a model cannot be scored on.  Fixed value.
UNSCORED = 100_000.0


def rmse_by_group(preds: DataFrame, by: str = "aircraft_type", model: str = "model_id", test_only: bool = False,
                  actual: str = "tow", predicted: str = "tow_pred") -> DataFrame:
    """Error of each model on each type, over all rows or the test rows: ``(type, model, n, rmse)``.

    The full type x model grid; a combination without rows, or with a NULL among them, is unscored.
    """
    scored = preds.withColumns({"_use": (F.col("test") == 1) if test_only else F.lit(True)})
    used = F.col("_use")
    gap = F.count_if(used & (F.col(actual).isNull() | F.col(predicted).isNull()))
    error = F.sqrt(F.avg(F.when(used, F.pow(F.col(actual) - F.col(predicted), 2.0))))
    cells = scored.groupBy(by, model).agg(
        F.count_if(used).alias("n"), gap.alias("_gap"), error.alias("_error")
    )
    # Models are few by nature; their list is one scalar, expanded per type.
    models = preds.agg(F.collect_set(model)).scalar()
    grid = cells.select(by).distinct().withColumn(model, F.explode(models))
    score = F.when((F.coalesce("n", F.lit(0)) == 0) | (F.col("_gap") > 0), F.lit(UNSCORED)).otherwise(F.col("_error"))
    return grid.join(cells, [by, model], "left").select(
        by, model, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), score.alias("rmse")
    )


def error_report(preds: DataFrame, by: str = "aircraft_type", model: str = "model_id", part: str = "test",
                 actual: str = "tow", predicted: str = "tow_pred") -> DataFrame:
    """Errors at every level of model, type and part in one pass over the predictions.

    One row per group: the three columns (NULL where all are taken together), ``level`` (the bits of the columns taken together, the model's
    highest, which tells such a NULL from a value that is missing), ``n``, ``missing`` predictions, ``rmse``, ``bias`` and the ``worst``
    error of the others.  Rows are added up before the shuffle, each once for every level.
    """
    sets = [[model, by, part], [model, by], [model, part], [by, part], [model], [by], []]
    off = F.col(predicted) - F.col(actual)
    return preds.groupingSets([[F.col(c) for c in one] for one in sets], model, by, part).agg(
        F.grouping_id().cast("bigint").alias("level"), F.count(F.lit(1)).alias("n"), F.count_if(F.col(predicted).isNull()).alias("missing"),
        F.sqrt(F.avg(off * off)).alias("rmse"), F.avg(off).alias("bias"), F.max(F.abs(off)).alias("worst"))


def argmin_model(scores: DataFrame, by: str = "aircraft_type", model: str = "model_id") -> DataFrame:
    """The model with the lowest error per type; the lowest id wins a tie."""
    best = F.min(F.struct("rmse", model))
    return scores.groupBy(by).agg(best.alias("_b")).select(by, F.col(f"_b.{model}").alias("best_model"),
                                                           F.col("_b.rmse").alias("best_rmse"))


def select_best_model(preds: DataFrame, best: DataFrame, by: str = "aircraft_type", model: str = "model_id",
                      key: str = "flight_id", predicted: str = "tow_pred", name: str = "best_tow_pred") -> DataFrame:
    """Each flight's prediction by the best model of its type, or by the next model if that is NULL.

    The next model is the one that follows in the sorted list of models: ids may have gaps.  One pass over the
    predictions: both candidate rows of a flight are picked by comparing ids.
    """
    picked = preds.join(best.select(by, "best_model"), by, "left")
    return picked.groupBy(key).agg(
        F.min(by).alias(by),
        F.min("best_model").alias("best_model"),
        chosen_prediction(F.col("best_model"), model_list(preds, model), model, predicted).alias(name),
    )


def model_list(preds: DataFrame, model: str = "model_id") -> Column:
    """The sorted model ids.  Models are few by nature; their list is one scalar."""
    return preds.agg(F.sort_array(F.collect_set(model))).scalar()


def chosen_prediction(wanted: Column, models: Column, model: str = "model_id", predicted: str = "tow_pred") -> Column:
    """Aggregate over a flight's rows: the prediction of the wanted model, else of its successor in ``models``."""
    # Positions count from one, so the position of a model is the zero-based place of its successor.
    place = F.nullif(F.array_position(models, wanted), F.lit(0))
    return F.coalesce(
        F.max(F.when(F.col(model) == wanted, F.col(predicted))),
        F.max(F.when(F.col(model) == F.get(models, place.cast("int")), F.col(predicted))),
    )


def select_twice(preds: DataFrame, scored: DataFrame, by: str = "aircraft_type", model: str = "model_id", key: str = "flight_id",
                 actual: str = "tow", predicted: str = "tow_pred") -> DataFrame:
    """Best model per type by error over all rows and over test rows: ``(key, tow_all, tow_test)``, in one pass over each input."""
    error = F.pow(F.col(actual) - F.col(predicted), 2.0)
    missing = F.col(actual).isNull() | F.col(predicted).isNull()
    tested = F.col("test") == 1
    cells = scored.groupBy(by, model).agg(
        F.when(F.count_if(missing) > 0, UNSCORED).otherwise(F.sqrt(F.avg(error))).alias("_all"),
        F.when((F.count_if(tested) == 0) | (F.count_if(tested & missing) > 0), UNSCORED)
        .otherwise(F.sqrt(F.avg(F.when(tested, error)))).alias("_test"),
    )
    # A model without rows of a type is unscored, which matters where no model can be scored: the lowest id wins then.
    first = F.struct(F.lit(UNSCORED).alias("r"), F.get(model_list(scored, model), F.lit(0)).alias("m"))
    best = cells.groupBy(by).agg(*[
        F.least(F.min(F.struct(F.col(c).alias("r"), F.col(model).alias("m"))), F.any_value(first))[F.lit("m")].alias(c) for c in ("_all", "_test")
    ])
    models = model_list(preds, model)
    return preds.join(best, by, "left").groupBy(key).agg(
        chosen_prediction(F.col("_all"), models, model, predicted).alias("tow_all"),
        chosen_prediction(F.col("_test"), models, model, predicted).alias("tow_test"),
    )


def selection_report(preds: DataFrame, chosen: DataFrame, outputs: Sequence[str], key: str = "flight_id", actual: str = "tow") -> DataFrame:
    """One row per output column of ``chosen``: error over all and over test flights, and the first submission rule it breaks.

    Flights without a prediction leave the error, and are told by ``status``.
    """
    known = preds.groupBy(key).agg(F.max(actual).alias("_actual"), F.max("test").alias("_test"))
    long = known.join(chosen, key, "left").select("_actual", "_test", F.explode(F.array(*[
        F.struct(F.lit(o).alias("output"), F.col(o).alias("_got")) for o in outputs
    ])).alias("_o")).select("_actual", "_test", "_o.*")
    error = F.pow(F.col("_actual") - F.col("_got"), 2.0)
    return long.groupBy("output").agg(
        F.sqrt(F.avg(error)).alias("rmse_all"), F.sqrt(F.avg(F.when(F.col("_test") == 1, error))).alias("rmse_test"),
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_got").isNull()).alias("nulls"),
    ).withColumn("status", F.when(F.col("nulls") > 0, "missing predictions").otherwise("ok"))


def pivot_predictions(preds: DataFrame, models: Sequence[int], key: str = "flight_id", model: str = "model_id",
                      predicted: str = "tow_pred") -> DataFrame:
    """One column ``tow_<model>`` per model."""
    return preds.groupBy(key).agg(*[
        F.max(F.when(F.col(model) == m, F.col(predicted))).alias(f"tow_{m}") for m in models
    ])


def median_vote(preds: DataFrame, key: str = "flight_id", predicted: str = "tow_pred", name: str = "tow") -> DataFrame:
    """Median over all models per flight: a group holds one row per model, and models are few by nature."""
    return preds.groupBy(key).agg(F.percentile(predicted, F.lit(0.5)).alias(name))


def weighted_vote(preds: DataFrame, weight: str, key: str = "flight_id", predicted: str = "tow_pred",
                  name: str = "tow") -> DataFrame:
    """Weighted mean over the models that predicted the flight."""
    w = F.when(F.col(predicted).isNotNull(), F.col(weight))
    return preds.groupBy(key).agg(F.try_divide(F.sum(w * F.col(predicted)), F.sum(w)).alias(name))


def blend(left: DataFrame, right: DataFrame, key: str = "flight_id", col: str = "tow", share: float = 0.5) -> DataFrame:
    """Weighted mean of two submissions, matched by key."""
    other = right.select(key, F.col(col).alias("_other"))
    return left.select(key, col).join(other, key, "left").select(
        key, (F.col(col) * share + F.col("_other") * (1.0 - share)).alias(col)
    )


def in_submission_order(ids: DataFrame, preds: DataFrame, key: str = "flight_id", col: str = "tow") -> DataFrame:
    """Every official id once, with its prediction or NULL."""
    return dedup_first(ids.select(key), [key]).join(preds.select(key, col), key, "left")


def submission_check(result: DataFrame, expected: DataFrame, col: str = "tow") -> DataFrame:
    """One row: row count, NULL count, and the first rule the submission breaks."""
    width = len(result.columns)
    wanted = expected.agg(F.count(F.lit(1))).scalar()
    counted = result.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(col).isNull()).alias("nulls"))
    status = (
        F.when(F.col("rows") != F.col("expected"), "row count differs")
        .when(F.col("nulls") != 0, "missing predictions")
        .when(F.lit(width) != 2, "unexpected columns")
        .otherwise("ok")
    )
    return counted.withColumn("expected", wanted).withColumn("status", status)


def leaderboard(preds: DataFrame, n: int | None = None, model: str = "model_id") -> DataFrame:
    """Models by error, best first."""
    scores = preds.groupBy(model).agg(rmse_expr().alias("rmse"), F.count(F.lit(1)).alias("n"))
    ordered = scores.orderBy("rmse", model)
    return ordered.limit(n) if n else ordered
