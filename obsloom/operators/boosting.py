"""Boosted trees for any number of classes and settings, grown side by side in the same passes.

``pyspark.ml`` grows one tree at a time, each a chain of jobs over its own copy of the rows. Here the rows are kept once,
a byte for each feature, with one running margin per ensemble; a pass counts the next level of all ensembles' trees. Up
to ``HERE`` rows go to the tasks instead, and each task grows one ensemble without further passes. The trees are those of
``GBTClassifier``: its candidate cuts, its sums, gains and ties, its loss and its leaves.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, OneVsRest, OneVsRestModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from obsloom.operators.sizes import FIT_PARTITIONS

#: Rows that are summed up in one go, and rows that one task may hold.
BLOCK, HERE = 1 << 16, 1 << 18
#: Rounds after which the margins are kept, and after which they are taken from all trees, so that what leads to them
#: stays short.
KEPT, ANEW = 4, 24
#: Bytes of sums that the tasks of a pass send to the driver, about.
SENT = 1 << 26
#: Impurities below the first are none; so are gains below the second, as a part of the node's own sum of squares,
#: where squares are not summed up.
EPSILON, ROUNDING = 2.0**-52, 1e-14


@dataclass
class Tree:
    """A perfect binary tree: node i goes on in 2i + 1 and 2i + 2; ``feature`` is -1 where it ends."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)
    #: Weight, sum, sum of squares and number of rows, by node.
    sums: np.ndarray = field(init=False)

    def __post_init__(self):
        nodes = 2 ** (self.depth + 1) - 1
        self.feature, self.cut = np.full(nodes, -1, dtype=np.int64), np.zeros(nodes, dtype=np.int64)
        self.gain, self.sums = np.zeros(nodes), np.zeros((nodes, 4))

    def leaves(self) -> np.ndarray:
        """What each place of the last level gives; places below an end give what the end gives."""
        value = mean(self.sums)
        for node in range(2**self.depth - 1):
            if self.feature[node] < 0:
                value[2 * node + 1] = value[2 * node + 2] = value[node]
        return value[2**self.depth - 1 :]

    def places(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The place of each row in the level after so many cuts; a row at an end goes on to the left."""
        at = np.zeros(bins.shape[1], dtype=np.uint8 if levels <= 8 else np.int64)
        for level in range(levels):
            first, right = 2**level - 1, np.zeros(bins.shape[1], dtype=bool)
            for place in range(2**level):
                if (f := self.feature[first + place]) >= 0:
                    beyond = bins[f] > self.cut[first + place]
                    right |= beyond if level == 0 else beyond & (at == place)
            at = 2 * at + right
        return at


@dataclass(eq=False)
class Ensemble:
    """What is to be grown, class ``target`` against the rest, and the trees so far."""

    target: int
    rounds: int
    rate: float
    depth: int
    trees: list[Tree] = field(default_factory=list)


@dataclass
class Grown:
    """Fitted ensembles with the candidate cuts of each feature that they count in."""

    cuts: list[np.ndarray]
    ensembles: list[Ensemble]


def mean(sums: np.ndarray) -> np.ndarray:
    return np.divide(sums[..., 1], sums[..., 0], out=np.zeros(sums.shape[:-1]), where=sums[..., 0] != 0)


def impurity(sums: np.ndarray) -> np.ndarray:
    weight = np.where(sums[..., 0] == 0, 1.0, sums[..., 0])
    return np.where(sums[..., 0] == 0, 0.0, (sums[..., 2] - sums[..., 1] * sums[..., 1] / weight) / weight)


def _single_object(package, name: str):
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def candidate_cuts(dataset: DataFrame, estimator: GBTClassifier, classes: int | None) -> tuple[list[np.ndarray], int]:
    """The cuts that Spark's own fit would choose from, and the number of rows. Labels, weights and features are checked
    as that fit checks them."""
    jvm = dataset.sparkSession._jvm
    estimator._transfer_params_to_java()
    java, apache = estimator._java_obj, jvm.org.apache.spark
    wanted = jvm.scala.Option.apply(classes)
    instances = _single_object(apache.ml.util, "DatasetUtils").extractInstances(java, dataset._jdf, wanted)
    none = apache.api.python.PythonUtils.toScalaMap(jvm.java.util.HashMap())
    strategy = java.getOldBoostingStrategy(none, apache.mllib.tree.configuration.Algo.Classification()).treeStrategy()
    metadata = apache.ml.tree.impl.DecisionTreeMetadata.buildMetadata(instances, strategy, 1, "all")
    found = _single_object(apache.ml.tree.impl, "RandomForest").findSplits(instances, metadata, estimator.getSeed())
    return [np.array([split.threshold() for split in splits], dtype=np.float64) for splits in found], metadata.numExamples()


def in_bins(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """One row of bin numbers per feature; a value that equals a cut lies below it."""
    kind = np.uint8 if max(map(len, cuts), default=0) < 256 else np.int32
    return np.stack([np.searchsorted(c, values[:, f], side="left").astype(kind) for f, c in enumerate(cuts)])


def _values(batches: Sequence[pa.RecordBatch], width: int) -> np.ndarray:
    return np.concatenate([b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for b in batches])


def blocks(dataset: DataFrame, label: str, weight: str | None, features: str, cuts: Sequence[np.ndarray]) -> RDD:
    """The rows as (bins, labels, weights), up to ``BLOCK`` of a partition together."""
    weighing = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = dataset.select(F.col(label).cast("int").alias("y"), weighing.alias("w"), vector_to_array(features).alias("x"))

    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        y, w = (np.concatenate([b.column(c).to_numpy() for b in batches]) for c in ("y", "w"))
        content = [in_bins(_values(batches, len(cuts)), cuts).tobytes(), y.astype(np.int32).tobytes(), w.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in content], names=["bins", "y", "w"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if n and n + batch.num_rows > BLOCK:
                yield packed(held)
                held, n = [], 0
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
        if held:
            yield packed(held)

    kind = np.uint8 if max(map(len, cuts), default=0) < 256 else np.int32

    def unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bins = np.frombuffer(row["bins"], dtype=kind).reshape(len(cuts), -1)
        return bins, np.frombuffer(row["y"], dtype=np.int32), np.frombuffer(row["w"], dtype=np.float64)

    made = rows.mapInArrow(gathered, "bins binary, y binary, w binary").rdd
    most = max(FIT_PARTITIONS, made.context.defaultParallelism)
    return (made.coalesce(most) if made.getNumPartitions() > most else made).map(unpacked)


def margins(bins: np.ndarray, trees: Sequence[Tree], rate: float, start: np.ndarray | None = None, first: int = 0) -> np.ndarray:
    """The running sum of the trees, numbered from ``first``; the first of all counts whole, the others by the rate."""
    total = np.zeros(bins.shape[1]) if start is None else start
    for i, tree in enumerate(trees, first):
        total = total + tree.leaves()[tree.places(bins, tree.depth)] * (rate if i else 1.0)
    return total


def _moved(block: tuple, since: Sequence[tuple[int, Sequence[Tree], float]], first: int) -> tuple:
    """The block with margins moved on by the trees from ``first`` on."""
    bins, margin = block[0], block[3]
    return (*block[:3], np.stack([margins(bins, trees, rate, None if margin is None else margin[i], first) for i, trees, rate in since]))


def residuals(labels: np.ndarray, target: int, margin: np.ndarray | None) -> np.ndarray:
    """What the next tree is to give: the label itself at first, then the loss's slope."""
    y = np.where(labels == target, 1.0, -1.0)
    return y if margin is None else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


def level_sums(
    block: tuple, targets: Sequence[int], asked: Sequence[tuple[Tree, int, list[int]] | None], width: int, wanted: Sequence[str], pairs: bool
) -> list[np.ndarray | None]:
    """For each ensemble the wanted sums of the nodes it asks for by feature and bin: (nodes, features, bins, sums).

    With ``pairs`` two features are counted in one go, which adds the rows up in another order.
    """
    bins, labels, weights, margin = block
    wide, size = bins.astype(np.intp), width * width
    # bin numbers by feature, or of two features together
    twos = [wide[f] + wide[f + 1] * width for f in range(0, len(bins) - 1, 2)] if pairs else []
    found = []
    for i, (target, one) in enumerate(zip(targets, asked)):
        if one is None:
            found.append(None)
            continue
        tree, level, nodes = one
        y = residuals(labels, target, None if margin is None else margin[i])
        wy = weights * y
        stats = [s for name, s in (("w", weights), ("wy", wy)) if name in wanted]
        if "wyy" in wanted:
            stats += [wy * y, None]
        slot = np.full(2**level, len(nodes), dtype=np.intp)
        slot[np.array(nodes) - (2**level - 1)] = np.arange(len(nodes))
        place = slot[tree.places(bins, level)]
        joint = twos if len(nodes) * size <= len(y) else []
        alone, rows = wide[2 * len(joint) :], place < len(nodes)
        if np.count_nonzero(rows) < 0.7 * len(rows):
            place, stats = place[rows], [None if s is None else s[rows] for s in stats]
            joint, alone = [b[rows] for b in joint], alone[:, rows]
        sums = np.zeros((len(nodes), len(bins), width, len(stats)))
        offset = place * size
        for f, both in enumerate(joint):
            at = offset + both
            for j, s in enumerate(stats):
                table = np.bincount(at, s, (len(nodes) + 1) * size).reshape(-1, width, width)[: len(nodes)]
                sums[:, 2 * f, :, j], sums[:, 2 * f + 1, :, j] = table.sum(axis=1), table.sum(axis=2)
        offset = place * width
        for f, one in enumerate(alone, 2 * len(joint)):
            at = offset + one
            for j, s in enumerate(stats):
                sums[:, f, :, j] = np.bincount(at, s, (len(nodes) + 1) * width).reshape(-1, width)[: len(nodes)]
        found.append(sums)
    return found


def _added(left: list | None, right: list) -> list:
    return right if left is None else [a if b is None else a + b for a, b in zip(left, right)]


def split_nodes(tree: Tree, level: int, nodes: list[int], sums: np.ndarray, numbers: np.ndarray) -> list[int]:
    """Cut the nodes where it gains most, the first of equals; the children that may be cut in turn.

    ``sums`` hold weight and sum, and perhaps the sum of squares and the number of rows.
    """
    squares = sums.shape[3] > 2
    running = np.cumsum(sums, axis=2)
    left, right = running[:, :, :-1], running[:, :, -1:] - running[:, :, :-1]
    cuttable, kept = np.flatnonzero(numbers), sums.shape[3]
    if level == 0:
        first = cuttable[0] if len(cuttable) else 0
        tree.sums[0, :kept] = left[0, first, 0] + right[0, first, 0] if left.shape[2] else running[0, first, -1]
    if not len(cuttable):
        return []
    allowed = (left[..., 0] > 0) & (right[..., 0] > 0) & (np.arange(left.shape[2]) < numbers[:, None])[None]
    both = left[..., 0] + right[..., 0]
    both = np.where(both == 0, 1.0, both)
    parent = tree.sums[nodes]
    if squares:
        whole = impurity(parent)[:, None, None]
        gain = whole - left[..., 0] / both * impurity(left) - right[..., 0] / both * impurity(right)
    else:
        own = (mean(parent) ** 2)[:, None, None]
        gain = (mean(left) * left[..., 1] + mean(right) * right[..., 1]) / both - own
        gain = np.where(gain > ROUNDING * own, gain, -1.0)
    gain = np.where(allowed & (gain >= 0), gain, -1.0).reshape(len(nodes), -1)
    following = []
    for i, best in enumerate(gain.argmax(axis=1)):
        if gain[i, best] <= 0:
            continue
        node, (f, cut) = nodes[i], divmod(int(best), left.shape[2])
        tree.feature[node], tree.cut[node], tree.gain[node] = f, cut, gain[i, best]
        for child, side in ((2 * node + 1, left), (2 * node + 2, right)):
            tree.sums[child, :kept] = side[i, f, cut]
            if level + 1 < tree.depth and not (squares and abs(impurity(tree.sums[child])) < EPSILON):
                following.append(child)
    return following


def _portions(asked: Sequence[list[int]], size: int) -> list[list[int]]:
    """The ensembles that ask for anything, so many together as have ``size`` nodes."""
    found, held = [], 0
    for i, nodes in enumerate(asked):
        if nodes:
            if not found or held + len(nodes) > size:
                found.append([])
                held = 0
            found[-1].append(i)
            held += len(nodes)
    return found


def grow_here(ensemble: Ensemble, block: tuple, numbers: np.ndarray, told: bool = False) -> Ensemble:
    """The ensemble with all its trees, from rows that are at hand.

    Up to ``BLOCK`` rows are summed up as Spark's own fit of one partition does it, beyond that as :func:`grow` does.
    """
    width, margin, weighed = int(numbers.max(initial=0)) + 1, None, None
    bins, labels, weights = block
    exact = len(labels) <= BLOCK
    for done in range(ensemble.rounds):
        tree, nodes, level = Tree(ensemble.depth), [0], 0
        while nodes:
            wanted = ("w", "wy", "wyy", "rows") if exact else ("w", "wy") if weighed is None or level else ("wy",)
            held = (bins, labels, weights, None if margin is None else margin[None])
            [sums] = level_sums(held, [ensemble.target], [(tree, level, nodes)], width, wanted, not exact)
            weighed = sums[..., :1] if weighed is None else weighed
            nodes = split_nodes(tree, level, nodes, np.concatenate([weighed, sums], axis=3) if wanted == ("wy",) else sums, numbers)
            level += 1
        ensemble.trees.append(tree)
        margin = margins(bins, [tree], ensemble.rate, margin, done)
    if told and not exact:
        _fill_in(ensemble, _ends(ensemble, bins, labels, weights))
    return ensemble


def grow(rows: RDD, numbers: np.ndarray, ensembles: Sequence[Ensemble], told: bool = False) -> None:
    """Add all their trees to the ensembles; every pass counts one level of the current tree of each.

    The sums are added up in the order of the partitions. Squares are left out, as gains are the same without them, and
    the weights by feature and bin are summed up once for all first levels. ``told`` then adds to each node its squares
    and rows, from one pass more.

    The margins stay with the rows: they are moved on every ``KEPT`` rounds, every ``ANEW`` rounds from all trees, and
    what is no longer needed is let go.
    """
    width = int(numbers.max(initial=0)) + 1
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    state, old, weighed = rows.map(lambda b: (*b, None)), None, None
    live, placed, upto = list(ensembles), list(ensembles), 0  # the margins are of ``placed`` and their first ``upto`` trees
    try:
        for done in range(max(e.rounds for e in ensembles)):
            grown, asked, level = [Tree(e.depth) for e in live], [[0] for _ in live], 0
            targets, since = [e.target for e in live], [(placed.index(e), e.trees[upto:], e.rate) for e in live]

            current = partial(_moved, since=since, first=upto) if done else None
            if done and done % KEPT == 0:
                if done % ANEW == 0:
                    since = [(0, e.trees, e.rate) for e in live]
                    source, current = rows.map(lambda b: (*b, None)), partial(_moved, since=since, first=0)
                else:
                    source = state
                old, state = state, source.map(current).persist(StorageLevel.MEMORY_AND_DISK)
                placed, upto, current = list(live), done, None
            while any(asked):
                wanted = ("w", "wy") if weighed is None or level else ("wy",)
                size = max(1, SENT // (8 * len(numbers) * width * len(wanted) * state.getNumPartitions()))
                following = [[] for _ in live]
                for portion in _portions(asked, size):
                    now = [(t, level, a) if i in portion else None for i, (t, a) in enumerate(zip(grown, asked))]

                    def counted(part, now=now, targets=targets, wanted=wanted, current=current):
                        whole = None
                        for block in part:
                            whole = _added(whole, level_sums(current(block) if current else block, targets, now, width, wanted, True))
                        return [] if whole is None else [whole]

                    whole = None
                    for sums in state.mapPartitions(counted).collect():
                        whole = _added(whole, sums)
                    for i in portion:
                        sums = whole[i]
                        if wanted == ("wy",):
                            sums = np.concatenate([weighed, sums], axis=3)
                        following[i] = split_nodes(grown[i], level, asked[i], sums, numbers)
                    if weighed is None:
                        weighed = whole[portion[0]][..., :1]
                if old is not None:
                    if old.is_cached:
                        old.unpersist()
                    old = None
                asked = following
                level += 1
            for ensemble, tree in zip(live, grown):
                ensemble.trees.append(tree)
            live = [e for e in live if e.rounds > done + 1]
        if told:
            for ensemble, ends in zip(ensembles, _all_ends(rows, ensembles)):
                _fill_in(ensemble, ends)
    finally:
        for kept in (old, state, rows):
            if kept is not None and kept.is_cached:
                kept.unpersist()


def _ends(ensemble: Ensemble, bins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Squares and rows at each tree's last level: the rounds are gone through once more, without choosing."""
    margin, size = None, 2**ensemble.depth
    found = np.zeros((len(ensemble.trees), 2, size))
    for i, tree in enumerate(ensemble.trees):
        y, place = residuals(labels, ensemble.target, margin), tree.places(bins, tree.depth)
        found[i] = np.bincount(place, weights * y * y, size), np.bincount(place, None, size)
        margin = margins(bins, [tree], ensemble.rate, margin, i)
    return found


def _all_ends(rows: RDD, ensembles: Sequence[Ensemble]) -> list[np.ndarray]:
    shared = rows.context.broadcast(ensembles)

    def counted(part):
        whole = None
        for block in part:
            whole = _added(whole, [_ends(e, *block) for e in shared.value])
        return [] if whole is None else [whole]

    whole = None
    for found in rows.mapPartitions(counted).collect():
        whole = _added(whole, found)
    return whole


def _fill_in(ensemble: Ensemble, ends: np.ndarray) -> None:
    """Squares and rows of all nodes from those of the last level; rows at an end went on to the left."""
    for tree, end in zip(ensemble.trees, ends):
        tree.sums[2**tree.depth - 1 :, 2:] = end.T
        for node in reversed(range(2**tree.depth - 1)):
            tree.sums[node, 2:] = tree.sums[2 * node + 1, 2:] + tree.sums[2 * node + 2, 2:]


def _single(estimator) -> GBTClassifier:
    """The fit of one class against the rest, with the columns of the whole."""
    if isinstance(estimator, GBTClassifier):
        return estimator
    single = estimator.getClassifier().copy()
    single.setLabelCol(estimator.getLabelCol()).setFeaturesCol(estimator.getFeaturesCol())
    return single.setWeightCol(estimator.getWeightCol()) if estimator.isDefined("weightCol") else single


def grow_together(estimators: Sequence, dataset: DataFrame, told: bool = False) -> list[Grown]:
    """All estimators' ensembles from the same passes. They differ in rounds, rate and depth alone, and have either two
    classes each or one ensemble per class. :func:`as_model` needs ``told``."""
    single = _single(estimators[0])
    label, several = single.getLabelCol(), not isinstance(estimators[0], GBTClassifier)
    targets = range(int(dataset.agg(F.max(label)).first()[0]) + 1) if several else [1]
    cuts, n = candidate_cuts(dataset, single, None if several else 2)
    grown = []
    for one in map(_single, estimators):
        setting = one.getMaxIter(), one.getStepSize(), one.getMaxDepth()
        grown.append(Grown(cuts, [Ensemble(target, *setting) for target in targets]))
    weight = single.getWeightCol() if single.isDefined("weightCol") else None
    rows, numbers = blocks(dataset, label, weight, single.getFeaturesCol(), cuts), np.array([len(c) for c in cuts])
    if n > HERE:
        grow(rows, numbers, [e for g in grown for e in g.ensembles], told)
        return grown
    context, held = rows.context, [np.concatenate(parts, axis=-1) for parts in zip(*rows.collect())]
    shared = context.broadcast(held)
    asked = sorted(((e.rounds * e.depth, i, j, e) for i, g in enumerate(grown) for j, e in enumerate(g.ensembles)), key=lambda one: -one[0])
    tasks = context.parallelize([one[1:] for one in asked], len(asked))
    for i, j, ensemble in tasks.map(lambda one: (*one[:2], grow_here(one[2], shared.value, numbers, told))).collect():
        grown[i].ensembles[j] = ensemble
    shared.destroy()
    return grown


def predictions(df: DataFrame, features: str, keep: Sequence[str], grown: Sequence[tuple[Grown, int]]) -> DataFrame:
    """The kept columns and, for each of the fits and its first so many trees, ``p0``, ``p1``, ...: all in one pass."""
    cuts = grown[0][0].cuts
    firsts = [[Ensemble(e.target, n, e.rate, e.depth, e.trees[:n]) for e in g.ensembles] for g, n in grown]
    shared = df.sparkSession.sparkContext.broadcast((cuts, firsts))
    names = [f"p{i}" for i in range(len(firsts))]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, firsts = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = in_bins(_values([batch], len(cuts)), cuts)
            found = []
            for ensembles in firsts:
                raw = np.stack([margins(bins, e.trees, e.rate) for e in ensembles])
                found.append(pa.array((raw.argmax(axis=0) if len(raw) > 1 else raw[0] > 0).astype(np.float64)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *found], names=[*keep, *names])

    rows = df.select(*keep, vector_to_array(features).alias("x"))
    shape = ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep], *[f"{n} double" for n in names]])
    return rows.mapInArrow(scored, shape)


def as_model(spark: SparkSession, grown: Grown, ensemble: Ensemble, single: GBTClassifier) -> GBTClassificationModel:
    """The ensemble as Spark's own model."""
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    apache, copied = jvm.org.apache.spark, jvm.java.util.Arrays.copyOfRange
    regression, boosting = apache.ml.regression.DecisionTreeRegressionModel, apache.ml.classification.GBTClassificationModel
    calculator, leaf, inner, continuous = (
        apache.mllib.tree.impurity.VarianceCalculator, apache.ml.tree.LeafNode, apache.ml.tree.InternalNode, apache.ml.tree.ContinuousSplit,
    )

    def numbers(values: np.ndarray):
        array = gateway.new_array(gateway.jvm.double, values.size)
        jvm.java.nio.ByteBuffer.wrap(bytearray(values.astype(">f8").tobytes())).asDoubleBuffer().get(array)
        return array

    def node(tree: Tree, at: int, sums):
        """(the node, what it gives if it ends); two ends that give the same become one."""
        value, apart = float(means[at]), float(impurities[at])
        counted = calculator(copied(sums, 3 * at, 3 * at + 3), int(tree.sums[at, 3]))
        if tree.feature[at] < 0:
            return leaf(value, apart, counted), value
        (left, low), (right, high) = node(tree, 2 * at + 1, sums), node(tree, 2 * at + 2, sums)
        if low is not None and low == high:
            return leaf(low, apart, counted), low
        f = int(tree.feature[at])
        split = continuous(f, float(grown.cuts[f][tree.cut[at]]))
        return inner(value, apart, float(tree.gain[at]), left, right, split, counted), None

    trees = gateway.new_array(regression, len(ensemble.trees))
    for i, tree in enumerate(ensemble.trees):
        means, impurities = mean(tree.sums), impurity(tree.sums)
        trees[i] = regression(f"dtr_{single.uid}_{i}", node(tree, 0, numbers(tree.sums[:, :3]))[0], len(grown.cuts))
    weights = numbers(np.array([ensemble.rate if i else 1.0 for i in range(len(ensemble.trees))]))
    return single._copyValues(GBTClassificationModel(boosting(single.uid, trees, weights, len(grown.cuts), 2)))


#: Settings of a fit that :func:`grow` knows with these values alone.
USUAL = {
    "minInstancesPerNode": 1, "minWeightFractionPerNode": 0.0, "minInfoGain": 0.0, "subsamplingRate": 1.0,
    "featureSubsetStrategy": "all", "lossType": "logistic",
}


def alike(estimator, dataset: DataFrame) -> tuple | None:
    """What estimators of one :func:`grow_together` have in common; None for those that Spark itself must fit, as for
    rows with categories among the features."""
    if not isinstance(estimator, (BoostedTrees, BoostedClasses)) or not isinstance(single := _single(estimator), GBTClassifier):
        return None
    attributes = dataset.schema[single.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    usual = all(single.getOrDefault(name) == value for name, value in USUAL.items()) and not single.isDefined("validationIndicatorCol")
    if attributes.get("nominal") or attributes.get("binary") or not usual:
        return None
    weight = single.getWeightCol() if single.isDefined("weightCol") else None
    return type(estimator), single.getLabelCol(), single.getFeaturesCol(), weight, single.getSeed(), single.getMaxBins()


class BoostedTrees(GBTClassifier):
    """``GBTClassifier`` fitted by :func:`grow`."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        if not alike(self, dataset):
            return super()._fit(dataset)
        [grown] = grow_together([self], dataset, told=True)
        return as_model(dataset.sparkSession, grown, grown.ensembles[0], self)


class BoostedClasses(OneVsRest):
    """``OneVsRest`` over boosted trees whose classes are fitted in the same passes."""

    def _fit(self, dataset: DataFrame) -> OneVsRestModel:
        if not alike(self, dataset):
            return super()._fit(dataset)
        [grown] = grow_together([self], dataset, told=True)
        single = _single(self)
        with ThreadPoolExecutor(len(grown.ensembles)) as pool:
            models = list(pool.map(lambda e: as_model(dataset.sparkSession, grown, e, single), grown.ensembles))
        return self._copyValues(OneVsRestModel(models=models))
