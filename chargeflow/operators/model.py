"""Regression of the minutes left, with Spark ML."""

from __future__ import annotations

import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import guarded, soc_weight, to_double
from ..functions.quantiles import quantiles
from ..settings import FEATURES, LABEL
from ..storage import owned


def impute_standardize(train: DataFrame, features: Sequence[str] = FEATURES, scale: bool = True) -> PipelineModel:
    """Stages fitted on the training rows: their medians for what is unknown, and (for
    linear models) mean 0 and deviation 1 of the filled columns; one vector,
    ``features``. Medians are exact and the deviation is the population's; a column
    that does not vary is only shifted, one without values is 0 throughout.

    Medians come from counts of equal values of all columns at once (see
    ``quantiles``), sums from one aggregation.
    """
    known = train.select(*[to_double(F.col(f)).alias(f) for f in features])
    with owned(known) as (known,):
        long = known.select(F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in features])).alias("x")).select("x.f", "x.v")
        medians = {r.f: r.quantiles[0] for r in quantiles(long, F.col("v"), [0.5], ["f"]).collect()}
        middle = {f: float(medians.get(f) or 0.0) for f in features}
        # About the median, so that sums of squares lose nothing to a large mean.
        away = {f: F.coalesce(F.col(f), F.lit(middle[f])) - middle[f] for f in features}
        sums = known.agg(F.count(F.lit(1)).alias("n"), *[F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("dev")).alias(f"s{i}") for i, x in enumerate(away.values())]).first()
    parts = []
    for i, f in enumerate(features):
        shift, dev = (middle[f] + (sums[f"s{i}"]["mean"] or 0.0), sums[f"s{i}"]["dev"] or 1.0) if scale else (0.0, 1.0)
        filled = f"coalesce(nullif(try_cast(`{f}` AS DOUBLE), double('NaN')), {middle[f]!r}D)"
        parts.append(f"({filled} - {shift!r}D) / {dev!r}D AS `{f}_filled`" if scale else f"{filled} AS `{f}_filled`")
    fill = SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")
    return PipelineModel(stages=[fill, VectorAssembler(inputCols=[f"{f}_filled" for f in features], outputCol="features")])


def ridge_baseline(train: DataFrame, features: Sequence[str] = FEATURES, alpha: float = 1.0) -> PipelineModel:
    """Least squares with the penalty ``alpha`` on the sum of squares."""
    found = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(LABEL).alias("dev")).first()
    prep = impute_standardize(train, features)
    # Spark means squares over the rows, and divides the penalty by the label's deviation.
    penalty = alpha / max(1, found["n"]) * (found["dev"] or 1.0)
    fit = LinearRegression(featuresCol="features", labelCol=LABEL, elasticNetParam=0.0, regParam=penalty, standardization=False)
    return PipelineModel(stages=[*prep.stages, fit.fit(prep.transform(train))])


def predict_batch(rows: DataFrame, model: PipelineModel | None, fallback: PipelineModel | None = None) -> DataFrame:
    """Adds ``prediction``, not below 0, by ``model``, or by the linear ``fallback``
    where there is none; the model's own columns are dropped."""
    used = model or fallback
    if used is None:
        raise ValueError("neither a model nor a fallback")
    out = used.transform(rows)
    return out.select(*rows.columns, F.greatest("prediction", F.lit(0.0)).alias("prediction"))


#: What the search draws from. Spark's trees know no penalties on leaf weights; the least gain of a split stands in for them.
SPACE = {
    "maxDepth": (4, 12), "minInstancesPerNode": (1, 20), "stepSize": (0.01, 0.2), "subsamplingRate": (0.6, 1.0),
    "featureSubsetStrategy": (0.6, 1.0), "minInfoGain": (0.0, 0.02), "validationTol": (0.0, 0.01),
}


def drawn(rng: random.Random) -> dict:
    """A value of each parameter; the share of features is text, as Spark takes it."""
    draw = {k: rng.randint(a, b) if isinstance(a, int) else round(rng.uniform(a, b), 4) for k, (a, b) in SPACE.items()}
    return draw | {"featureSubsetStrategy": str(draw["featureSubsetStrategy"])}


def rungs_of(trials: int, rounds: int, rungs: int) -> list[tuple[int, int]]:
    """(trials, rounds) of each rung of successive halving: half the trials go on to
    twice the rounds, the last rung has all ``rounds``."""
    out = [(max(1, -(-trials // 2**i)), max(1, rounds // 2 ** (rungs - 1 - i))) for i in range(rungs)]
    return [(n, rounds if i == rungs - 1 else r) for i, (n, r) in enumerate(out)]


def gbt_search(rows: DataFrame, features: Sequence[str] = FEATURES, trials: int = 48, rounds: int = 100, seed: int = 42, rungs: int = 3, at_once: int = 4) -> tuple[PipelineModel | None, list[dict]]:
    """The best of ``trials`` boosted-tree models by error on the val rows, and all
    trials with the last ``rung`` that each reached. ``rows`` have ``split``; training
    stops early on val, whose rows weigh 1; training rows of low charge weigh more.

    All trials are fitted with few rounds, the better half with twice as many, and so
    on (``rungs_of``); ``at_once`` fits run beside each other over one written table of
    assembled rows. Each fit has its own seed and draw, so that the outcome doesn't
    depend on their order. No model (None) without trials or train rows; without val
    rows nothing tells trials apart, and the first is it."""
    features = guarded(features)
    train = rows.filter("split = 'train'")
    if trials < 1 or not train.take(1):
        return None, []
    prep = impute_standardize(train, features, scale=False)
    val = F.col("split") == "val"
    used = rows.filter("split in ('train', 'val')").withColumns({"is_val": val, "weight": F.when(val, 1.0).otherwise(soc_weight(F.col("soc")))})
    rng = random.Random(seed)
    draws = [drawn(rng) for _ in range(trials)]
    tried = [d | {"rung": -1, "rmse": None, "trees": 0} for d in draws]
    fits: dict[int, object] = {}
    key = F.xxhash64(*features, LABEL, "is_val").alias("_key")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with owned(prep.transform(used).select("features", LABEL, "is_val", "weight", key)) as (table,):
        # Samples of trees go by the place of a row: rows are dealt and ordered by their values, so that reruns agree.
        table = table.repartition(parts, "_key").sortWithinPartitions("_key").drop("_key")
        stops = {"validationIndicatorCol": "is_val"} if table.filter("is_val").take(1) else {}

        def fitted(i: int, budget: int):
            fit = GBTRegressor(featuresCol="features", labelCol=LABEL, weightCol="weight", maxIter=budget, seed=seed + i, **draws[i], **stops).fit(table)
            error = F.col("prediction") - F.col(LABEL)
            rmse = fit.transform(table.filter("is_val")).agg(F.sqrt(F.avg(error * error)).alias("rmse")).first()["rmse"]
            return fit, rmse

        alive = list(range(trials))
        for rung, (n, budget) in enumerate(rungs_of(trials, rounds, rungs)):
            alive = alive[:n]
            with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
                results = list(pool.map(lambda i, b=budget: fitted(i, b), alive))
            fits = {}
            for i, (fit, rmse) in zip(alive, results):
                fits[i] = fit
                tried[i] |= {"rung": rung, "rmse": rmse, "trees": fit.getNumTrees}
            alive.sort(key=lambda i: (float("inf") if tried[i]["rmse"] is None else tried[i]["rmse"], i))
    return PipelineModel(stages=[*prep.stages, fits[alive[0]]]), tried


def top_importances(model: PipelineModel, rows: DataFrame, features: Sequence[str] = FEATURES, k: int = 50) -> DataFrame:
    """The features of most gain in the trees."""
    gains = model.stages[-1].featureImportances.toArray().tolist()
    table = rows.sparkSession.createDataFrame(list(zip(features, gains)), "feature string, gain double")
    return table.orderBy(F.desc("gain"), "feature").limit(k)
