"""Encoding of categories with any number of values by their mean label, out of fold on the rows that teach it."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.session import materialise


def fold_of(key: Column, folds: int, seed: int = 42) -> Column:
    """Fold of a row by its key, the same wherever and whenever it is computed."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(folds)).cast("int")


class _Shared(HasInputCols, HasOutputCols, HasLabelCol):
    foldCol = Param(Params._dummy(), "foldCol", "fold of a row that takes part in the fit; rows without one, or tables without the column, are new", TypeConverters.toString)
    folds = Param(Params._dummy(), "folds", "number of folds", TypeConverters.toInt)
    smoothing = Param(Params._dummy(), "smoothing", "rows of the overall mean that each value's mean is mixed with", TypeConverters.toFloat)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(foldCol="fold", folds=5, smoothing=10.0)


class CrossFittedMeans(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the mean label of each value of the input columns.

    Every value has its own mean, however many there are: sums and counts per value and fold are one aggregation per column, written
    as Parquet and joined when they are used, so neither the driver nor the model in memory grows with the values.  A row with a fold
    gets the mean of the other folds' rows, so that no label teaches its own row; a new row gets the mean of all.  A mean
    is mixed with the overall one by ``smoothing``; a missing or unknown value gets the overall mean.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, labelCol="label", foldCol="fold", folds=5, smoothing=10.0):  # noqa: N803
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CrossFittedMeansModel:
        label, fold = F.col(self.getLabelCol()).cast("double"), F.col(self.getOrDefault("foldCol")).cast("int")
        rows = dataset.filter(label.isNotNull() & fold.isNotNull())
        # One row of the overall sums (column -1), and one per column, value and fold; sums are made before the shuffle.
        entries = [F.struct(F.lit(-1).alias("at"), F.lit(None).cast("string").alias("value"))]
        entries += [F.struct(F.lit(k).alias("at"), F.col(c).cast("string").alias("value")) for k, c in enumerate(self.getInputCols())]
        each = rows.select(fold.alias("fold"), label.alias("y"), F.inline(F.array(*entries))).filter("at < 0 or value is not null")
        sums = each.groupBy("at", "value", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("total"))
        by_fold = F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "total"))))  # as many entries as folds at most
        means = sums.groupBy("at", "value").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), by_fold.alias("folds"))
        return self._copyValues(CrossFittedMeansModel(materialise(means, "means")))


class CrossFittedMeansModel(Model, _Shared, MLReadable, MLWritable):
    """Means per column and value, as a table; see ``CrossFittedMeans``."""

    def __init__(self, means: DataFrame | None = None):
        super().__init__()
        self.means = means

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fold_name, mix = self.getOrDefault("foldCol"), float(self.getOrDefault("smoothing"))
        fold = F.col(fold_name).cast("int") if fold_name in dataset.columns else F.lit(None).cast("int")
        overall = self.means.filter("at < 0").first()
        out, kept = dataset, list(dataset.columns)

        def without(n: Column, total: Column, folds: Column) -> tuple[Column, Column]:
            own = folds[fold]
            return n - F.coalesce(own["n"], F.lit(0)), total - F.coalesce(own["total"], F.lit(0.0))

        if overall is None:
            return dataset.withColumns({name: F.lit(None).cast("double") for name in self.getOutputCols()})
        per_fold = F.create_map(*[F.lit(x) for f, s in overall["folds"].items() for x in (f, s["total"])])
        per_fold_n = F.create_map(*[F.lit(x) for f, s in overall["folds"].items() for x in (f, s["n"])])
        all_n = F.lit(overall["n"]) - F.coalesce(per_fold_n[fold], F.lit(0))
        prior = (F.lit(overall["total"]) - F.coalesce(per_fold[fold], F.lit(0.0))) / F.nullif(all_n, F.lit(0))
        for k, (column, name) in enumerate(zip(self.getInputCols(), self.getOutputCols())):
            table = self.means.filter(F.col("at") == k).select(*[F.col(c).alias(f"_mean_{c}") for c in ("value", "n", "total", "folds")])
            joined = out.join(table, F.col(column).cast("string") == F.col("_mean_value"), "left")
            n, total = without(F.coalesce("_mean_n", F.lit(0)), F.coalesce("_mean_total", F.lit(0.0)), F.col("_mean_folds"))
            # Without smoothing, a value that no other row has still needs the overall mean.
            mean = F.when(n + mix > 0, (total + mix * prior) / F.nullif(n + mix, F.lit(0.0))).otherwise(prior)
            out = joined.withColumn(name, mean).select(*kept, *self.getOutputCols()[:k + 1])
        return out

    def write(self) -> MLWriter:
        return _MeansWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _MeansReader(cls)


class _MeansWriter(MLWriter):
    def __init__(self, instance: CrossFittedMeansModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.means.write.parquet(f"{path}/means")


class _MeansReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CrossFittedMeansModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.cls(self.sparkSession.read.parquet(f"{path}/means"))
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        return instance
