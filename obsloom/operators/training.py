"""Train and choose classifiers with ``pyspark.ml``; nothing is collected but scores."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    OneVsRestModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Imputer, IndexToString, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark import SparkContext
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.storagelevel import StorageLevel

from obsloom.operators.boosting import BoostedClasses, BoostedTrees, alike, grow_together, predictions
from obsloom.operators.evaluate import MacroF1, macro_metrics
from obsloom.operators.oversample import with_class_weights
from obsloom.operators.sizes import kept, measured
from obsloom.operators.splitting import cap_rows

WEIGHT = "weight"
#: Fits that run side by side, and rows of one partition of a fit.
PARALLEL, FIT_ROWS = 8, 50_000


def label_index(df: DataFrame, label: str, out: str = "label") -> StringIndexerModel:
    """Labels numbered in alphabetical order; :func:`label_names` reads them back."""
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc").fit(
        df.withColumn(label, F.col(label).cast("string"))
    )


def label_names(index: StringIndexerModel, prediction: str = "prediction", out: str = "predicted") -> IndexToString:
    return IndexToString(inputCol=prediction, outputCol=out, labels=list(index.labels))


def model_frame(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The kept columns and the features as doubles, read tolerantly."""
    numbers = [F.col(c).cast("string").try_cast("double") if df.schema[c].dataType.typeName() == "string"
               else F.col(c).cast("double") for c in features]
    return df.select(*keep, *[n.alias(c) for n, c in zip(numbers, features)])


def preparation(features: Sequence[str], missing: str = "mean") -> list[Estimator]:
    """Fill gaps (``mean``, ``median`` or ``zero``) and assemble; saved with the model, so that training,
    evaluation and scoring use one feature list."""
    if missing == "zero":
        filled = ", ".join(f"coalesce(`{c}`, 0D) as `__{c}`" for c in features)
        fill = SQLTransformer(statement=f"select *, {filled} from __THIS__")
    else:
        fill = Imputer(inputCols=list(features), outputCols=[f"__{c}" for c in features], strategy=missing)
    return [fill, VectorAssembler(inputCols=[f"__{c}" for c in features], outputCol="features", handleInvalid="keep")]


def random_forest(trees: int = 100, depth: int = 8, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, weightCol=WEIGHT)


def boosted_trees(rounds: int = 100, rate: float = 0.1, depth: int = 3, seed: int = 42, classes: int = 2) -> Estimator:
    """Gradient boosting; one model per class against the rest when there are more than two."""
    single = BoostedTrees(maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed)
    return single.setWeightCol(WEIGHT) if classes == 2 else BoostedClasses(classifier=single, weightCol=WEIGHT, parallelism=PARALLEL)


# The grids searched by default.
FOREST_GRID = [{"trees": t, "depth": d} for t in (100, 200) for d in (8, 12)]
BOOST_GRID = [{"rounds": 100, "rate": r, "depth": d} for r in (0.05, 0.1) for d in (3, 5)]
WIDE_BOOST_GRID = [{"rounds": n, "rate": r, "depth": d} for n in (100, 150) for d in (4, 6) for r in (0.05, 0.1)]


@dataclass
class Candidate:
    """A family of models: ``make(**point)`` for each grid point.

    ``grows`` names the parameter that counts an ensemble's trees, if there is one: of points that differ in it alone
    only the largest is fitted, and the others are the first trees of that fit.
    """

    name: str
    make: Callable[..., Estimator]
    grid: Sequence[Mapping[str, object]] = field(default_factory=lambda: [{}])
    grows: str | None = None


@dataclass(frozen=True)
class Race:
    """How a search goes on: rungs of (share of the trees, folds), and what part of a family a rung leaves.

    Every point of every grid takes part in the first rung. After each rung the best 1/``cut`` of a family's points,
    one at least, go on. Unless told otherwise the first rung is the whole search: all points with all trees on three
    folds. ``rows`` bounds the labelled rows of a fit, by seeded order of the key; without it a fit has all of them.
    Scores are always taken from all rows of the tested fold.
    """

    rungs: Sequence[tuple[float, int]] = ((1.0, 3),)
    cut: int = 4
    rows: int | None = None


LEADERBOARD = "candidate string, point string, rung int, trees_share double, folds int, score double, accuracy double, recall double"


def first_trees(model: Model, n: int) -> Model:
    """The ensemble of a fitted ensemble's first ``n`` trees."""
    if isinstance(model, OneVsRestModel):
        return OneVsRestModel(models=[first_trees(m, n) for m in model.models])
    java, gateway = model._java_obj, SparkContext.getOrCreate()._gateway
    boosted = isinstance(model, GBTClassificationModel)
    models, ml = gateway.jvm.org.apache.spark.ml.classification, gateway.jvm.org.apache.spark.ml
    whole = java.trees()
    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel if boosted else models.DecisionTreeClassificationModel, n)
    for i in range(n):
        trees[i] = whole[i]
    if not boosted:
        return RandomForestClassificationModel(models.RandomForestClassificationModel(java.uid(), trees, java.numFeatures(), java.numClasses()))
    weights = gateway.new_array(gateway.jvm.double, n)
    for i, weight in enumerate(model.treeWeights[:n]):
        weights[i] = float(weight)
    return GBTClassificationModel(models.GBTClassificationModel(java.uid(), trees, weights))


@dataclass
class _Fold:
    """One fold, prepared for all fits on it: training vectors with weights, and test vectors."""

    train: DataFrame
    test: DataFrame


def cross_validate(
    df: DataFrame,
    candidates: Sequence[Candidate],
    features: Sequence[str],
    fold: str,
    folds: int,
    label: str = "label",
    evaluator: Evaluator | None = None,
    missing: str = "mean",
    resample: Callable[[DataFrame], DataFrame] | None = None,
    key: Sequence[str] = (),
    race: Race | None = None,
) -> DataFrame:
    """Mean scores of every grid point over the folds that it reached: ``candidate, point, rung, trees_share, folds,
    score, accuracy, recall``.

    Without ``race`` every point is fitted whole on every fold, which is the last rung of a race. ``resample`` changes
    the training part of each fold only, so that no made-up neighbour of a test row is trained on. It gets the training
    rows with gaps filled. ``key`` names a row uniquely and is needed where ``race`` bounds the rows.
    """
    evaluator = evaluator or MacroF1(labelCol=label)
    rungs = race.rungs if race else ((1.0, folds),)
    rungs = [(share, min(n, folds)) for share, n in rungs]
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    prepared: dict[int, _Fold] = {}
    board: dict[tuple[int, int], tuple] = {}
    left = {c: list(range(len(candidate.grid))) for c, candidate in enumerate(candidates)}
    try:
        for rung, (share, n) in enumerate(rungs):
            for i in range(n):
                if i not in prepared:
                    prepared[i] = _prepare(df, features, fold, i, label, missing, resample, key, race.rows if race else None)
            fits = [
                (c, groups, i)
                for c, members in left.items()
                for groups in _side_by_side(candidates[c], _together(candidates[c], members), prepared[0].train)
                for i in range(n)
            ]
            fits.sort(key=lambda fit: -len(fit[1]))
            with ThreadPoolExecutor(PARALLEL) as pool:
                found = pool.map(lambda one: _scores(candidates[one[0]], one[1], share, prepared[one[2]], label, evaluator), fits)
                sums: dict[tuple[int, int], list[float]] = {}
                for (c, groups, _), rows in zip(fits, found):
                    for point, row in zip((point for points in groups for point in points), rows):
                        total = sums.setdefault((c, point), [0.0, 0.0, 0.0])
                        for j, value in enumerate(row):
                            total[j] += value / n
            for (c, point), scores in sums.items():
                board[c, point] = (candidates[c].name, str(dict(candidates[c].grid[point])), rung, float(share), n, *scores)
            if race and rung + 1 < len(rungs):
                for c, members in left.items():
                    best = sorted(members, key=lambda point: [-round(v, 6) for v in sums[c, point]] + [point])
                    left[c] = best[: max(1, len(best) // race.cut)]
    finally:
        for one in prepared.values():
            one.train.unpersist()
            one.test.unpersist()
        df.unpersist()
    return df.sparkSession.createDataFrame(list(board.values()), LEADERBOARD)


def _together(candidate: Candidate, members: Sequence[int]) -> list[list[int]]:
    """The points by fit: those that differ in the number of trees alone share one, largest first."""
    groups: dict[str, list[int]] = {}
    for point in members:
        rest = {k: v for k, v in candidate.grid[point].items() if k != candidate.grows}
        groups.setdefault(str(sorted(rest.items())) if candidate.grows else str(point), []).append(point)
    size = (lambda point: -candidate.grid[point].get(candidate.grows, 0)) if candidate.grows else (lambda point: 0)
    return [sorted(points, key=size) for points in groups.values()]


def _prepare(df, features, fold, i, label, missing, resample, key, max_rows) -> _Fold:
    train, _ = bounded(df.where(F.col(fold) != i), key, max_rows)
    filling = Pipeline(stages=preparation(features, missing)).fit(train)
    test = kept(filling.transform(df.where(F.col(fold) == i)).select(label, "features"), 1)
    if resample is not None:
        filled = filling.transform(train)
        train = resample(filled.select(*[c for c in df.columns if c not in features], *[F.col(f"__{c}").alias(c) for c in features]))
    weighted = measured(filling.transform(with_class_weights(train, label, WEIGHT)).select(label, WEIGHT, "features"))
    parts = max(1, -(-weighted.count() // FIT_ROWS))
    return _Fold(weighted.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK), test)


def _side_by_side(candidate: Candidate, groups: list[list[int]], rows: DataFrame) -> list[list[list[int]]]:
    """The groups by fit: boosted ones that can be grown in the same passes, and each of the others for itself."""
    found: dict[object, list[list[int]]] = {}
    for i, points in enumerate(groups):
        found.setdefault(alike(candidate.make(**candidate.grid[points[0]]), rows) or i, []).append(points)
    return list(found.values())


def _scores(
    candidate: Candidate, groups: Sequence[Sequence[int]], share: float, data: _Fold, label: str, evaluator: Evaluator
) -> list[tuple]:
    """(score, accuracy, recall) of each point, from one fit of each group's largest."""
    grown = candidate.grows

    def trees(point: int) -> int:
        return max(1, round(share * candidate.grid[point][grown]))

    estimators = []
    for points in groups:
        largest = dict(candidate.grid[points[0]])
        if grown in largest:
            largest[grown] = trees(points[0])
        estimators.append(candidate.make(**largest).setLabelCol(label))
    if alike(estimators[0], data.train):
        fits = grow_together(estimators, data.train)
        sizes = [
            (fit, len(fit.ensembles[0].trees) if point == points[0] else trees(point))
            for fit, points in zip(fits, groups)
            for point in points
        ]
        scored = predictions(data.test, "features", [label], sizes).persist(StorageLevel.MEMORY_AND_DISK)
        frames = (scored.select(label, F.col(f"p{i}").alias("prediction")) for i in range(len(sizes)))
    else:
        scored = None
        models = [(estimator.fit(data.train), points) for estimator, points in zip(estimators, groups)]
        frames = (
            (model if point == points[0] else first_trees(model, trees(point))).transform(data.test).select(label, "prediction")
            for model, points in models
            for point in points
        )
    found = []
    for predicted in frames:
        predicted = predicted if scored is not None else predicted.persist(StorageLevel.MEMORY_AND_DISK)
        plain = macro_metrics(predicted, label, "prediction").first()
        found.append((evaluator.evaluate(predicted), plain["accuracy"], plain["recall"]))
        predicted.unpersist()
    if scored is not None:
        scored.unpersist()
    return found


def bounded(df: DataFrame, key: Sequence[str], max_rows: int | None) -> tuple[DataFrame, int]:
    """At most ``max_rows`` rows of ``df`` by seeded order of ``key``, and how many were left out."""
    if max_rows is None:
        return df, 0
    over = max(0, df.count() - max_rows)
    if over and not key:
        raise ValueError("a bound on the rows needs the row key")
    return (cap_rows(df, key, max_rows) if over else df), over


def rank_candidates(board: DataFrame, digits: int = 6) -> DataFrame:
    """The leaderboard with its ``place``, best first: what came further in a race, then by score, accuracy and recall;
    close scores are equal."""
    order = [F.desc(F.round(c, digits)) for c in ("score", "accuracy", "recall")]
    if "rung" in board.columns:
        order = [F.desc("rung"), *order]
    placed = board.withColumn("place", F.row_number().over(W.orderBy(*order, "candidate", "point")).cast("bigint"))
    return placed.orderBy("place")


def choose(board: DataFrame, candidates: Sequence[Candidate]) -> tuple[str, Estimator]:
    best = rank_candidates(board).first()
    for candidate in candidates:
        for point in candidate.grid:
            if candidate.name == best["candidate"] and str(dict(point)) == best["point"]:
                return candidate.name, candidate.make(**point)
    raise ValueError("the leaderboard names no known candidate")


def fit_classifier(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    estimator: Estimator,
    missing: str = "mean",
    resample: Callable[[DataFrame], DataFrame] | None = None,
    key: Sequence[str] = (),
    max_rows: int | None = None,
) -> PipelineModel:
    """One pipeline from raw features to a class name, fitted with balanced class weights.

    ``max_rows`` bounds the labelled rows that are fitted, by seeded order of ``key``; the model's attribute
    ``rows_left_out`` says how many that leaves out. Evaluation and scoring have no such bound.
    """
    index = label_index(df, target)
    known = index.transform(df.withColumn(target, F.col(target).cast("string")))
    known, left_out = bounded(known, key, max_rows)
    prepared = Pipeline(stages=preparation(features, missing)).fit(known)
    train = known
    if resample is not None:
        filled = prepared.transform(known)
        train = resample(filled.select(*[c for c in known.columns if c not in features], *[F.col(f"__{c}").alias(c) for c in features]))
    weighted = with_class_weights(train, "label", WEIGHT)
    vectors = measured(prepared.transform(weighted).select("label", WEIGHT, "features"))
    vectors = vectors.repartition(max(1, -(-vectors.count() // FIT_ROWS))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = estimator.setLabelCol("label").fit(vectors)
    finally:
        vectors.unpersist()
    fitted = PipelineModel(stages=[*prepared.stages, model, label_names(index)])
    fitted.rows_left_out = left_out
    return fitted


def fit_best(
    df: DataFrame,
    board: DataFrame,
    candidates: Sequence[Candidate],
    features: Sequence[str],
    target: str,
    **fit: object,
) -> tuple[str, PipelineModel]:
    """The family at the head of the leaderboard, and its point fitted on ``df`` by :func:`fit_classifier`."""
    name, estimator = choose(board, candidates)
    return name, fit_classifier(df, features, target, estimator, **fit)
