"""Scaling, clustering and projection of numeric columns with ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from obsloom.operators.aggregate import group_mean
from obsloom.operators.centres import BLOCK, POINT, assigned, fit_all, points_of, silhouettes, worth
from obsloom.operators.sizes import FIT_PARTITIONS, kept, measured
from obsloom.operators.splitting import hash_sample
from obsloom.session import checkpointed

SCALED = "__scaled"
#: Numbers about clusters that go to every task, at most: 200 MB.
MOST_NUMBERS = 25_000_000


def scaling_stages(features: Sequence[str], out: str = SCALED) -> list:
    """Assemble complete rows into a vector, then mean 0 and standard deviation 1."""
    return [
        VectorAssembler(inputCols=list(features), outputCol="__raw", handleInvalid="skip"),
        StandardScaler(inputCol="__raw", outputCol=out, withMean=True, withStd=True),
    ]


def scaled_vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` without rows that lack a feature, plus the scaled vector."""
    return Pipeline(stages=scaling_stages(features)).fit(df).transform(df).drop("__raw")


def standard_scale(df: DataFrame, columns: Sequence[str], prefix: str = "z_") -> DataFrame:
    """``(x - mean) / sample sd`` as plain columns; a constant column becomes 0.

    Two numbers per column come from one aggregate.
    """
    parts = []
    for name in columns:
        parts += [F.avg(name).alias(f"m_{name}"), F.stddev_samp(name).alias(f"s_{name}")]
    stats = df.agg(*parts).first()
    scaled = {}
    for name in columns:
        mean, spread = stats[f"m_{name}"], stats[f"s_{name}"]
        centred = F.col(name) - F.lit(mean)
        scaled[f"{prefix}{name}"] = centred / F.lit(spread) if spread else centred * 0.0
    return df.withColumns(scaled)


def scaled_point(df: DataFrame, features: Sequence[str]) -> Column:
    """The features as one array with mean 0 and standard deviation 1; a constant feature becomes 0."""
    parts = []
    for i, name in enumerate(features):
        parts += [F.avg(name).alias(f"m{i}"), F.stddev_samp(name).alias(f"s{i}")]
    stats = df.agg(*parts).first()
    centred = [F.col(c).cast("double") - F.lit(stats[f"m{i}"]) for i, c in enumerate(features)]
    return F.array(*[c / F.lit(stats[f"s{i}"]) if stats[f"s{i}"] else F.lit(0.0) for i, c in enumerate(centred)])


def scaled_points(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The scaled features of complete rows, as the array ``x``."""
    return df.select(scaled_point(df, features).alias(POINT))


def kmeans_fit(df: DataFrame, k: int, features_col: str, seed: int, max_iter: int, restarts: int = 1):
    """The cheapest of ``restarts`` fits."""
    best = None
    for i in range(restarts):
        model = KMeans(k=k, seed=seed + i, maxIter=max_iter, featuresCol=features_col, predictionCol="cluster").fit(df)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    return best


def kmeans_sweep(
    df: DataFrame,
    features: Sequence[str],
    ks: Iterable[int] = range(2, 9),
    key: Sequence[str] | None = None,
    sample: float = 1.0,
    seed: int = 42,
    max_iter: int = 20,
    restarts: int = 1,
    partitions: int = FIT_PARTITIONS,
) -> DataFrame:
    """``k, cost, silhouette`` for each k, over a sample by ``key`` when ``sample`` is below 1.

    All k and restarts are fitted in the same passes.
    """
    chosen = df.select(*dict.fromkeys([*(key or []), *features])).dropna(subset=list(features))
    if sample < 1.0:
        if not key:
            raise ValueError("a sample needs the row key")
        chosen = hash_sample(chosen, key, sample, seed)
    points = kept(scaled_points(chosen, features), partitions)
    try:
        fits = fit_all(points, list(ks), restarts, seed, max_iter)
        worths = silhouettes(points, fits)
    finally:
        points.unpersist()
    rows = [(f.k, f.cost, worth) for f, worth in zip(fits, worths)]
    return df.sparkSession.createDataFrame(rows, "k int, cost double, silhouette double")


def best_k(sweep: DataFrame) -> int:
    """The k with the highest silhouette, the smaller one on ties."""
    return sweep.orderBy(F.desc("silhouette"), "k").first()["k"]


def cluster_rows(
    df: DataFrame,
    features: Sequence[str],
    k: int,
    seed: int = 42,
    max_iter: int = 30,
    restarts: int = 1,
    partitions: int = FIT_PARTITIONS,
) -> tuple[PipelineModel, DataFrame]:
    """The fitted pipeline, and all rows with their ``cluster``, NULL where a feature lacks."""
    scaling = Pipeline(stages=scaling_stages(features)).fit(df)
    vectors = kept(scaling.transform(df.select(*features)).select(SCALED), partitions)
    try:
        model = kmeans_fit(vectors, k, SCALED, seed, max_iter, restarts)
    finally:
        vectors.unpersist()
    pipeline = PipelineModel(stages=[*scaling.stages, model])
    return pipeline, with_incomplete(pipeline.transform(df).drop("__raw", SCALED), df, features)


def with_incomplete(found: DataFrame, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``found``, made from the complete rows of ``df``, and the other rows, whose new columns are NULL."""
    lacks = F.lit(False)
    for name in features:
        lacks = lacks | F.col(name).isNull() | F.isnan(F.col(name).cast("double"))
    return found.unionByName(df.where(lacks), allowMissingColumns=True)


def cluster_means(clustered: DataFrame, features: Sequence[str], digits: int = 3) -> DataFrame:
    return group_mean(clustered.where(F.col("cluster").isNotNull()), ["cluster"], features, digits)


def cluster_entities(
    df: DataFrame, entity: str, features: Sequence[str], seed: int = 42, max_k: int = 10, restarts: int = 10, max_iter: int = 20
) -> tuple[DataFrame, DataFrame]:
    """Cluster entities by their mean readings: (k sweep, entity means with ``cluster``).

    One fit of all k and restarts gives the sweep and the clusters of the best k.
    """
    means = group_mean(df.where(F.col(entity).isNotNull()), [entity], features, None, "").dropna()
    scaled = kept(means.withColumn(POINT, scaled_point(means, features)))
    try:
        top = min(max_k, scaled.count() - 1)
        if top < 2:
            raise ValueError("at least 3 entities are needed")
        fits = fit_all(scaled, range(2, top + 1), restarts, seed, max_iter)
        worths = silhouettes(scaled, fits)
        rows = [(f.k, f.cost, worth) for f, worth in zip(fits, worths)]
        sweep = df.sparkSession.createDataFrame(rows, "k int, cost double, silhouette double")
        best = next(f for f in fits if f.k == best_k(sweep))
        clustered = checkpointed(assigned(scaled, F.col(POINT), best.centres, "cluster").drop(POINT))
    finally:
        scaled.unpersist()
    return sweep, clustered


def project(df: DataFrame, features: Sequence[str], k: int = 2) -> tuple[list[float], DataFrame]:
    """Principal components: (explained variance shares, all rows with ``pc1`` .. ``pck``, NULL where a feature lacks)."""
    stages = [*scaling_stages(features), PCA(k=k, inputCol=SCALED, outputCol="__pc")]
    model = Pipeline(stages=stages).fit(df)
    shares = [float(v) for v in model.stages[-1].explainedVariance]
    points = model.transform(df).withColumn("__pc", vector_to_array("__pc"))
    out = points.withColumns({f"pc{i + 1}": F.col("__pc")[i] for i in range(k)})
    return shares, with_incomplete(out.drop("__raw", SCALED, "__pc"), df, features)


def silhouette(df: DataFrame, features: Sequence[str], cluster: str, max_numbers: int = MOST_NUMBERS) -> DataFrame:
    """``silhouette, n`` by squared Euclidean distance, without comparing rows with rows.

    The mean squared distance from a point to a cluster follows from the cluster's size, mean and mean
    squared norm. A point alone in its cluster scores 0. Complete rows only. The statistics of the clusters,
    ``max_numbers`` numbers at most, go to every task, which compares a block of rows with all of them.
    """
    rows = df.select(F.col(cluster).alias("c"), F.array(*[F.col(c).cast("double") for c in features]).alias(POINT), *features)
    rows = rows.dropna().select("c", POINT)
    norm = F.aggregate(POINT, F.lit(0.0), lambda total, v: total + v * v)
    sums = [F.sum(F.col(POINT)[i]).alias(f"s{i}") for i in range(len(features))]
    stats = rows.groupBy("c").agg(F.count("*").alias("n"), F.sum(norm).alias("norms"), *sums)
    stats = measured(stats)
    clusters = stats.count()
    if clusters < 2 or clusters * (len(features) + 2) > max_numbers:
        raise ValueError(f"from 2 clusters to {max_numbers} numbers about them are needed, found {clusters} clusters")
    # numbered here, so that a row carries the place of its cluster and not its name
    table = stats.orderBy("c").toPandas()
    places = df.sparkSession.createDataFrame(
        pa.table({"c": pa.array(table["c"].tolist(), to_arrow_type(stats.schema["c"].dataType)), "at": pa.array(range(clusters), pa.int64())})
    )
    placed = rows.join(places, "c").select("at", POINT)
    n, norms = table["n"].to_numpy(dtype=float), table["norms"].to_numpy(dtype=float)
    totals = table[[f"s{i}" for i in range(len(features))]].to_numpy(dtype=float)
    shared = df.sparkSession.sparkContext.broadcast((n, norms, totals))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, norms, totals = shared.value
        total, seen, step = 0.0, 0, max(1, BLOCK // len(n))
        for batch in batches:
            points, own = points_of(batch, totals.shape[1]), batch.column("at").to_numpy()
            for start in range(0, len(own), step):
                part = slice(start, start + step)
                total += worth(points[part], own[part], n, norms, totals).sum()
            seen += len(own)
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([seen], pa.int64())], names=["total", "n"])

    judged = placed.mapInArrow(judge, "total double, n long")
    return judged.agg((F.sum("total") / F.sum("n")).alias("silhouette"), F.sum("n").alias("n"))
