"""Regression models, their training samples and outlier damping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.rank import top_n


def simulated_subsets(sets: DataFrame, key: str, member: str, levels: Sequence[float], repeats: int, seed: int = 42) -> DataFrame:
    """(key, level, repeat, member): for each level and repeat, that share of the key's members, at least one, in hashed order.

    The order comes from hashes, so a lost task draws the same rows again.
    """
    grid = F.array(*(F.struct(F.lit(lv).alias("level"), F.lit(r).alias("repeat")) for lv in levels for r in range(repeats)))
    sizes = sets.groupBy(key).agg(F.count_distinct(member).alias("_n"))
    each = sets.select(key, member).distinct().join(sizes, key).select(key, member, "_n", F.explode(grid).alias("g")).select(key, member, "_n", "g.*")
    drawn = F.row_number().over(_window([key, "level", "repeat"], _order(seed, key, "level", "repeat", member), F.col(member)))
    need = F.greatest(F.bround(F.col("_n") * F.col("level")), F.lit(1))
    return each.withColumn("_rn", drawn).where(F.col("_rn") <= need).select(key, "level", "repeat", member)


def _order(seed: int, *parts: str) -> Column:
    """A text by which rows are in seeded order, the same wherever it is computed."""
    return F.md5(F.concat_ws(":", F.lit(seed).cast("string"), *(F.col(p).cast("string") for p in parts)).cast("binary"))


def _window(keys, *order):
    from pyspark.sql import Window as W

    return W.partitionBy(*keys).orderBy(*order)


def capped_sample(df: DataFrame, key: str, cap: int, unit: Sequence[str], seed: int = 42) -> DataFrame:
    """At most cap rows of each key, in hashed order: the feature of this operator."""
    return top_n(df, [key], [_order(seed, *unit).asc(), *(F.col(u).asc() for u in unit)], cap)


def folds(df: DataFrame, group: str, n: int, seed: int = 42) -> DataFrame:
    """fold: rows of one group share a fold."""
    return df.withColumn("fold", F.pmod(F.conv(F.substring(_order(seed, group), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int"))


def choose_regressor(df: DataFrame, features: Sequence[str], target: str, group: str, n_folds: int = 3, seed: int = 42):
    """(name, mae, r2, model): the best of three MLlib regressors by grouped cross-validation, by MAE then R2, fitted on all rows."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

    data = folds(VectorAssembler(inputCols=list(features), outputCol="_x").transform(df), group, n_folds, seed).persist()
    models = {
        "forest": RandomForestRegressor(featuresCol="_x", labelCol=target, numTrees=30, maxDepth=6, seed=seed),
        "boosted": GBTRegressor(featuresCol="_x", labelCol=target, maxIter=15, maxDepth=4, seed=seed),
        "linear": LinearRegression(featuresCol="_x", labelCol=target, regParam=0.01),
    }
    score = lambda rows, metric: RegressionEvaluator(labelCol=target, metricName=metric).evaluate(rows)
    tried = []
    for name, model in models.items():
        out = None
        for f in range(n_folds):
            train, test = data.where(F.col("fold") != f), data.where(F.col("fold") == f)
            if train.isEmpty() or test.isEmpty():
                continue
            guessed = model.fit(train).transform(test).select(target, "prediction")
            out = guessed if out is None else out.unionByName(guessed)
        tried.append((score(out, "mae"), -score(out, "r2"), name))
    mae, r2, name = min(tried)
    fitted = models[name].fit(data)
    data.unpersist()
    return name, mae, -r2, fitted


def predict(model, df: DataFrame, features: Sequence[str], low: float = 0.0, high: float = 100.0) -> DataFrame:
    """df with prediction, clipped and rounded to two digits."""
    from pyspark.ml.feature import VectorAssembler

    out = model.transform(VectorAssembler(inputCols=list(features), outputCol="_x").transform(df)).drop("_x")
    return out.withColumn("prediction", F.round(F.least(F.greatest("prediction", F.lit(low)), F.lit(high)), 2))


def damp_outliers(df: DataFrame, keys: Sequence[str], value: str, least_rows: int = 10, cut: float = 3.5) -> DataFrame:
    """damped: values whose robust z-score exceeds cut are halved, in groups of enough rows.

    A stand-in for an isolation forest, which Spark has not: on one column both single out what is far from the bulk.
    """
    mid = df.groupBy(*keys).agg(F.median(value).alias("_m"), F.count("*").alias("_n"))
    off = df.join(mid, list(keys)).withColumn("_d", F.abs(F.col(value) - F.col("_m")))
    mad = off.groupBy(*keys).agg(F.median("_d").alias("_mad"))
    far: Column = (F.col("_n") >= least_rows) & (F.col("_mad") > 0) & (F.col("_d") * 0.6745 > F.col("_mad") * cut)
    return off.join(mad, list(keys)).withColumn("damped", F.when(far, F.col(value) * 0.5).otherwise(F.col(value))).drop("_m", "_n", "_d", "_mad")
