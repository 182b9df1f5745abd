"""Learned fills: features to targets with pyspark.ml, group folds, hold-outs and error measures."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmark.session import cut

# Fields that are known only after detection and must not be features.
FORBIDDEN = ["t0", "t2", "t3", "t0_hour", "t2_hour", "t3_hour", "p_hr", "min_speed_mph"]


def guard(features: list[str]) -> list[str]:
    """The features, or an error if one of them leaks the target."""
    bad = [f for f in features if f.lower() in FORBIDDEN]
    if bad:
        raise ValueError(f"features known only after detection: {bad}")
    return features


def boundaries_to_targets(t0: Column, t2: Column, t3: Column, start: Column) -> Column:
    """Struct of unbounded targets: t2 from the period's start in minutes, log of the span, logit of t2's place in it."""
    span = (t3 - t0) * 60
    place = F.greatest(F.least((t2 - t0) / F.nullif(t3 - t0, F.lit(0.0)), F.lit(1 - 1e-4)), F.lit(1e-4))
    return F.struct(((t2 - start) * 60).alias("t2_rel"), F.log(F.when(span > 0, span)).alias("log_span"), F.log(place / (1 - place)).alias("logit_place"))


def targets_to_boundaries(t2_rel: Column, log_span: Column, logit_place: Column, start: Column, hours: Column) -> Column:
    """Struct (t0, t2, t3) in hours: t2 within the period, spans of 15 to 900 minutes, logits within 20."""
    t2 = start + F.least(F.greatest(t2_rel / 60, F.lit(0.0)), hours)
    span = F.least(F.greatest(F.exp(log_span), F.lit(15.0)), F.lit(900.0)) / 60
    place = 1 / (1 + F.exp(-F.least(F.greatest(logit_place, F.lit(-20.0)), F.lit(20.0))))
    return F.struct((t2 - span * place).alias("t0"), t2.alias("t2"), (t2 + span * (1 - place)).alias("t3"))


def group_fold(group: Column, folds: int = 5) -> Column:
    """Fold of a group by its hash: all rows of a group share it. Folds are even in groups, not balanced in rows."""
    return F.pmod(F.xxhash64(group), F.lit(folds)).cast("int")


def temporal_holdout(day: Column, cut_day: Column) -> Column:
    return F.when(day < cut_day, "train").otherwise("test")


def pipeline(numbers: list[str], texts: list[str], target: str, model: str = "ridge", alpha: float = 10.0, rows: int = 1, spread: float = 1.0) -> Pipeline:
    """Median imputation, scaling, one-hot texts and a regressor: ridge (penalty alpha on the sum of squares), forest or boosted.

    The solver divides the penalty by rows and by the label's deviation, so both are given for ridge.
    """
    guard(numbers + texts)
    stages = [Imputer(strategy="median", inputCols=numbers, outputCols=[f"{n}_i" for n in numbers]), VectorAssembler(inputCols=[f"{n}_i" for n in numbers], outputCol="_num"), StandardScaler(inputCol="_num", outputCol="_scaled", withMean=True)]
    if texts:
        stages += [StringIndexer(inputCols=texts, outputCols=[f"{t}_x" for t in texts], handleInvalid="keep"), OneHotEncoder(inputCols=[f"{t}_x" for t in texts], outputCols=[f"{t}_h" for t in texts], dropLast=False)]
    stages.append(VectorAssembler(inputCols=["_scaled", *(f"{t}_h" for t in texts)], outputCol="_features"))
    common = {"featuresCol": "_features", "labelCol": target, "predictionCol": "prediction"}
    if model == "ridge":
        stages.append(LinearRegression(**common, regParam=alpha / max(rows, 1) * spread, elasticNetParam=0.0, standardization=False, solver="normal"))
    elif model == "forest":
        stages.append(RandomForestRegressor(**common, numTrees=30, maxDepth=8, seed=17))
    else:
        stages.append(GBTRegressor(**common, maxIter=20, maxDepth=4, seed=17))
    return Pipeline(stages=stages)


def cross_predict(df: DataFrame, numbers: list[str], texts: list[str], target: str, group: Column, model: str = "ridge", folds: int = 3) -> DataFrame:
    """df with fold and prediction, each row predicted by a model of the other folds."""
    d = cut(df.where(F.col(target).isNotNull()).withColumn("fold", group_fold(group, folds)), "folds")  # read by every stage of every fold
    out = None
    moments = d.groupBy("fold").agg(F.count("*").alias("n"), F.sum(target).alias("s"), F.sum(F.col(target) * F.col(target)).alias("q")).collect()  # one row per fold
    for k in range(folds):
        train, test = d.where(F.col("fold") != k), d.where(F.col("fold") == k)
        n, s, q = (sum(m[c] for m in moments if m["fold"] != k) for c in ("n", "s", "q"))
        if not n:
            continue
        fitted: PipelineModel = pipeline(numbers, texts, target, model, rows=n, spread=max(q / n - (s / n) ** 2, 0.0) ** 0.5).fit(train)
        part = fitted.transform(test).select(*d.columns, "prediction")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else d.withColumn("prediction", F.lit(None).cast("double"))


def error_measures(df: DataFrame, by: list[str], target: str, prediction: str = "prediction") -> DataFrame:
    e = F.abs(F.col(prediction) - F.col(target))
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(e).alias("mae"), F.median(e).alias("median"), F.percentile(e, F.lit(0.9)).alias("p90"), F.sqrt(F.avg(e * e)).alias("rmse"))


def bootstrap_delta(df: DataFrame, group: str, a: str, b: str, rounds: int = 200, seed: int = 17) -> DataFrame:
    """(n_groups, mean, low, high): mean difference a - b with a 90 % interval, by a Poisson bootstrap of groups (weights from a hash)."""
    g = df.groupBy(group).agg(F.sum(F.col(a) - F.col(b)).alias("s"), F.count("*").alias("n"))
    u = (F.pmod(F.xxhash64(F.col(group), F.col("r"), F.lit(seed)), F.lit(1_000_000)) + 0.5) / 1_000_000
    weight = sum((F.when(u > c, 1).otherwise(0) for c in (0.367879, 0.735759, 0.919699, 0.981012, 0.996340, 0.999406)), F.lit(0))
    drawn = g.withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(rounds)))).withColumn("w", weight).groupBy("r").agg((F.sum(F.col("w") * F.col("s")) / F.nullif(F.sum(F.col("w") * F.col("n")), F.lit(0))).alias("m"))
    return drawn.agg(F.avg("m").alias("mean"), F.percentile("m", F.lit(0.05)).alias("low"), F.percentile("m", F.lit(0.95)).alias("high")).join(g.agg(F.count("*").alias("n_groups")))


def importance(df: DataFrame, features: list[str], target: str, n: int) -> DataFrame:
    """(feature, importance, place): the n features with the greatest absolute correlation with the target; ties by name. One row per feature is ranked."""
    from pyspark.sql import Window

    row = df.agg(*(F.round(F.abs(F.corr(target, f)), 7).alias(f) for f in features))
    long = row.unpivot([], features, "feature", "importance").where("importance is not null and not isnan(importance)")
    place = F.row_number().over(Window.orderBy(F.desc("importance"), "feature")).cast("bigint")
    return long.withColumn("place", place).where(F.col("place") <= n)


def leave_group_out(df: DataFrame, group: str, by: list[str], value: str) -> DataFrame:
    """(group, by..., n_others, prior): the mean of a class without the group's own rows; null where it has no others. Sums are made once per class, not per group."""
    own = df.groupBy(group, *by).agg(F.sum(value).alias("s"), F.count("*").alias("n"))
    whole = own.groupBy(*by).agg(F.sum("s").alias("ws"), F.sum("n").alias("wn"))
    rest = F.col("wn") - F.col("n")
    return own.join(whole, by).select(group, *by, rest.alias("n_others"), ((F.col("ws") - F.col("s")) / F.nullif(rest, F.lit(0))).alias("prior"))
