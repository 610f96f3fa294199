"""Modelling operators (MLO-*) on Spark ML.

Training sets are player-season pairs (thousands to millions of rows, one
row per entity-season), assembled into vectors and fitted by Spark ML's
distributed estimators; nothing is collected to the driver except fitted
coefficients and scalar metrics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from seamstat.functions.exprs import inf_to_null, nan_to_null


# --------------------------------------------------------------- split --
def season_split(pairs: DataFrame, features: DataFrame, season: str = "season",
                 latest: int | None = None) -> DataFrame:
    """Label pairs ``train`` (season <= L-2) or ``test`` (season = L-1),
    where L is the latest season of ``features`` (a one-row aggregate)."""
    top = F.lit(latest) if latest is not None else features.select(F.max(season)).scalar()
    lab = (F.when(F.col(season) <= top - 2, "train")
           .when(F.col(season) == top - 1, "test").otherwise("other"))
    return pairs.withColumn("split", lab)


# ------------------------------------------------------ feature columns --
def numeric_features(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Numeric columns not excluded (schema walk; ids and targets out)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in ex]


def impute_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null, NaN and +-inf to 0 (MLO-03, SCA-12)."""
    return df.withColumns({c: F.coalesce(inf_to_null(nan_to_null(F.col(c).cast("double"))),
                                         F.lit(0.0)) for c in cols})


# ---------------------------------------------------------- standardize --
def standardize_stats(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column from ONE
    aggregate; a zero deviation is read as 1 (MLO-06). Only 2 scalars per
    column reach the driver."""
    row = train.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = row[f"m_{i}"], row[f"s_{i}"]
        out[c] = (m if m is not None else 0.0, s if s not in (None, 0.0) else 1.0)
    return out


def standardize(df: DataFrame, stats: dict[str, tuple[float, float]],
                suffix: str = "") -> DataFrame:
    return df.withColumns({c + suffix: (F.col(c) - F.lit(m)) / F.lit(s)
                           for c, (m, s) in stats.items()})


# ------------------------------------------------------------- fitting --
def _assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def fit_ridge(train: DataFrame, cols: Sequence[str], label: str, alpha: float = 1.0):
    """Ridge with an unpenalised intercept on already-standardised columns
    (MLO-07). Spark scales the label by its deviation internally, so the
    squared-error objective ``||y - Xw||^2 + alpha ||w||^2`` corresponds to
    ``regParam = alpha / n * std_pop(y)``."""
    from pyspark.ml.regression import LinearRegression
    agg = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("sy")).first()
    n, sy = agg["n"], agg["sy"] or 0.0
    reg = alpha / n * sy if n else 0.0
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="pred_ridge",
                          regParam=reg, elasticNetParam=0.0, standardization=False,
                          solver="normal", fitIntercept=True)
    return lr.fit(_assemble(train, cols))


def gbt(params: dict | None = None, label: str = "label", seed: int = 42,
        subsample: float = 0.8, colsample: float = 0.8):
    """Boosted regression trees (MLO-08): trees, depth, learning rate, and
    the minimum rows per leaf for the minimum child weight (squared loss)."""
    from pyspark.ml.regression import GBTRegressor
    p = {"n_estimators": 200, "max_depth": 4, "learning_rate": 0.05, "min_child_weight": 1}
    p.update(params or {})
    return GBTRegressor(featuresCol="features", labelCol=label, predictionCol="pred_gbt",
                        maxIter=int(p["n_estimators"]), maxDepth=int(p["max_depth"]),
                        stepSize=float(p["learning_rate"]),
                        minInstancesPerNode=int(p["min_child_weight"]),
                        subsamplingRate=subsample, featureSubsetStrategy=str(colsample),
                        seed=seed, checkpointInterval=10)


def select_features(train: DataFrame, cols: Sequence[str], label: str,
                    threshold: float = 0.005, params: dict | None = None) -> list[str]:
    """Keep columns whose boosted-tree importance is >= threshold (MLO-04)."""
    p = {"n_estimators": 200, "max_depth": 4, "learning_rate": 0.05}
    p.update(params or {})
    model = gbt(p, label, subsample=1.0, colsample=1.0).fit(_assemble(train, cols))
    imp = model.featureImportances.toArray()
    return [c for c, v in zip(cols, imp) if v >= threshold]


def feature_importances(spark, train: DataFrame, cols: Sequence[str], label: str,
                        params: dict | None = None) -> DataFrame:
    """Importance per feature as a DataFrame (feature, importance)."""
    model = gbt(params, label, subsample=1.0, colsample=1.0).fit(_assemble(train, cols))
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(c, float(v)) for c, v in zip(cols, imp)],
                                 "feature string, importance double")


def with_folds(df: DataFrame, keys: Sequence[str], k: int = 3, col: str = "fold") -> DataFrame:
    """Deterministic fold id from a hash of the keys (no global sort)."""
    return df.withColumn(col, F.pmod(F.xxhash64(*keys), F.lit(k)).cast("int"))


def tune(train: DataFrame, cols: Sequence[str], label: str, grid: dict,
         folds: int = 3, keys: Sequence[str] = ("player_id", "season"),
         parallelism: int = 4) -> dict:
    """Grid search with k-fold cross-validation on R^2 (MLO-05); returns the
    best parameter dict."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    est = gbt(None, label)
    names = list(grid)
    pmap = {"n_estimators": est.maxIter, "max_depth": est.maxDepth,
            "learning_rate": est.stepSize, "min_child_weight": est.minInstancesPerNode}
    b = ParamGridBuilder()
    for n in names:
        b = b.addGrid(pmap[n], list(grid[n]))
    maps = b.build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps,
                        evaluator=RegressionEvaluator(labelCol=label, predictionCol="pred_gbt",
                                                      metricName="r2"),
                        foldCol="fold", numFolds=folds, parallelism=parallelism, seed=42)
    data = with_folds(_assemble(train, cols), list(keys), folds)
    model = cv.fit(data)
    best = max(range(len(maps)), key=lambda i: (model.avgMetrics[i], -i))
    return {n: maps[best][pmap[n]] for n in names}


# --------------------------------------------------------------- scores --
def regression_scores(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE and R^2 (MLO-10) as one aggregate (optionally per group)."""
    e = F.col(y) - F.col(yhat)
    g = df.groupBy(*by) if by else df
    sst = F.var_pop(y) * F.count(y)   # no cancellation on a large mean
    return g.agg(F.avg(F.abs(e)).alias("mae"),
                 (1 - F.sum(e * e) / F.nullif(sst, F.lit(0.0))).alias("r2"))


def best_blend(df: DataFrame, y: str, a: str, b: str, steps: int = 20,
               by: Sequence[str] = ()) -> DataFrame:
    """Best blend weight w in {0, 1/steps, ..., 1} of ``(1-w) a + w b`` by
    R^2 (first maximum, i.e. the smallest weight on ties), with its R^2
    (MLO-09). A constant target has no R^2 (null) and keeps weight 0.

    One pass computes four aggregates; R^2(w) for every w follows from them
    (residual = e0 - w d with e0 = y - a, d = b - a), so no copy of the
    data per weight is made.
    """
    e0 = F.col(y) - F.col(a)
    d = F.col(b) - F.col(a)
    g = df.groupBy(*by) if by else df
    s = g.agg(F.sum(e0 * e0).alias("see"), F.sum(e0 * d).alias("sed"), F.sum(d * d).alias("sdd"),
              (F.var_pop(y) * F.count(y)).alias("sst"))
    w = F.col("i") / F.lit(float(steps))
    ssr = F.col("see") - 2 * w * F.col("sed") + w * w * F.col("sdd")
    cand = s.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(steps)))) \
        .withColumn("w", w).withColumn("r2", 1 - ssr / F.nullif(F.col("sst"), F.lit(0.0)))
    pick = cand.groupBy(*by).agg(F.min_by(F.struct("w", "r2"),
                                          F.struct(-F.col("r2"), F.col("i"))).alias("b")) \
        if by else cand.agg(F.min_by(F.struct("w", "r2"), F.struct(-F.col("r2"), F.col("i"))).alias("b"))
    return pick.select(*by, F.col("b")["w"].alias("best_weight"), F.col("b")["r2"].alias("r2"))


def ratio_scores(df: DataFrame, num_pred: str, den_pred: str, num: str, den: str) -> DataFrame:
    """Derived ratio (K/BB) scores with a zero denominator read as 1
    (MLO-11)."""
    r = lambda a, b: F.col(a) / F.when(F.col(b) == 0, 1).otherwise(F.col(b))
    return regression_scores(df.withColumns({"__y": r(num, den), "__p": r(num_pred, den_pred)}),
                             "__y", "__p")


# ------------------------------------------------------ train / project --
def fit_target(train: DataFrame, test: DataFrame, cols: Sequence[str], target: str,
               params: dict, threshold: float = 0.005,
               select_params: dict | None = None, alpha: float = 1.0,
               blend_steps: int = 20, evaluate: DataFrame | None = None, moments=None) -> dict:
    """One target of the ensemble: importance selection, ridge on
    standardised columns, boosted trees on raw columns, best blend weight on
    ``test``, MAE / R^2 of the blend on ``evaluate`` (default ``test``)
    (MLO-04, -06, -07, -08, -09, -10). ``moments`` are the cross moments of
    ``train`` over ``cols`` and every target; the ridge fit reads no row."""
    from seamstat.operators.gram import cross_moments, ridge
    keep = select_features(train, cols, target, threshold, select_params) or list(cols)
    if moments is None:
        moments = cross_moments(train, [*cols, target])
    linear = ridge(moments, keep, target, alpha)
    trees = gbt(params, target).fit(_assemble(train, keep))
    scored = score(test, {"features": keep, "ridge": linear, "gbt": trees, "weight": 0.0})
    blend = best_blend(scored, target, "pred_ridge", "pred_gbt", blend_steps).first()
    w = float(blend["best_weight"])
    model = {"target": target, "features": keep, "ridge": linear, "gbt": trees, "weight": w}
    final = score(evaluate, model) if evaluate is not None else \
        scored.withColumn("pred", (1 - w) * F.col("pred_ridge") + w * F.col("pred_gbt"))
    sc = regression_scores(final, target, "pred").first()
    model.update({"r2": sc["r2"], "mae": sc["mae"]})
    return model


def fit_targets(train: DataFrame, test: DataFrame, cols: Sequence[str], targets: Sequence[str],
                params: dict, parallelism: int = 4, **kw) -> list[dict]:
    """Fit every target's ensemble; the per-target fits are independent
    Spark jobs submitted from a small pool of driver threads (as
    cross-validation does), so short jobs overlap on the cluster."""
    from concurrent.futures import ThreadPoolExecutor

    from seamstat.operators.gram import cross_moments
    # One pass serves the ridge fits of every target.
    kw = {"moments": cross_moments(train, [*cols, *targets]), **kw}
    if parallelism <= 1 or len(targets) <= 1:
        return [fit_target(train, test, cols, t, params, **kw) for t in targets]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(targets))) as pool:
        return list(pool.map(lambda t: fit_target(train, test, cols, t, params, **kw), targets))


def score(df: DataFrame, model: dict, out: str = "pred") -> DataFrame:
    """Ridge and tree predictions and their blend for a fitted target."""
    keep, w = model["features"], model["weight"]
    r = df.withColumn("pred_ridge", model["ridge"].predict())
    g = model["gbt"].transform(_assemble(r, keep)).drop("features")
    return g.withColumn(out, (1 - w) * F.col("pred_ridge") + w * F.col("pred_gbt"))


def metrics_frame(spark, fitted: Sequence[dict]) -> DataFrame:
    """Per-target blend weight, R^2, MAE and feature count as a DataFrame."""
    return spark.createDataFrame(
        [(m["target"], m["weight"], m["r2"], m["mae"], len(m["features"])) for m in fitted],
        "target string, blend_weight double, r2 double, mae double, n_features int")


def project(latest: DataFrame, fitted: Sequence[dict], id_cols: Sequence[str],
            digits: dict[str, int], prefix: str = "next_") -> DataFrame:
    """Score the latest season with every target's blend and round per
    target, half to even (MLO-13). Each target adds one prediction column."""
    from seamstat.functions.exprs import np_round
    out = latest
    for m in fitted:
        name = m["target"][len(prefix):] if m["target"].startswith(prefix) else m["target"]
        out = score(out, m, "__p").withColumn(name + "_proj", np_round("__p", digits.get(name, 0))) \
            .drop("__p", "pred_ridge", "pred_gbt")
    return out.select(*id_cols, *[(m["target"][len(prefix):] if m["target"].startswith(prefix)
                                   else m["target"]) + "_proj" for m in fitted])


# ------------------------------------------------------------- reports --
def leaderboard(df: DataFrame, by: str, k: int, where: Column | None = None,
                tie: Sequence[str] = ("player_id",)) -> DataFrame:
    """Top ``k`` rows by ``by`` descending, ties by ``tie`` (SRT-02, FLT-07,
    MLO-15); planned as a per-partition top-k merged once."""
    if where is not None:
        df = df.where(where)
    return df.orderBy(F.col(by).desc(), *tie).limit(k)


def compare(preds: DataFrame, actuals: DataFrame, names: DataFrame, keys: Sequence[str],
            targets: Sequence[str], by: str, k: int = 20) -> DataFrame:
    """Prediction-vs-actual rows with names, top ``k`` by a prediction
    (MLO-12)."""
    p = preds.select(*keys, *[F.col(t).alias(f"pred_{t}") for t in targets])
    a = actuals.select(*keys, *[F.col(t).alias(f"actual_{t}") for t in targets])
    out = p.join(a, list(keys), "inner").join(names, "player_id", "left")
    return out.orderBy(F.col(f"pred_{by}").desc(), *keys).limit(k)


def derive_ratio(df: DataFrame, num: str, den: str, name: str, digits: int = 2) -> DataFrame:
    """A ratio of already rounded projections, zero denominator read as 1
    (MLO-14)."""
    from seamstat.functions.exprs import np_round
    d = F.when(F.col(den) == 0, F.lit(1)).otherwise(F.col(den))
    return df.withColumn(name, np_round(F.col(num) / d, digits))
