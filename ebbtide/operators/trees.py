"""Per-row Shapley values of boosted trees, and clustering of them.

The value of a set of features is the tree's expectation when the others follow the rows
that were fitted on (path-dependent, by cover). For one leaf only the features on its
path matter: feature j keeps the row on the path (o = 1) or not (o = 0) when it is known,
and with the share z of the cover that goes on when it is not. The leaf's part in feature
i is value * (o_i - z_i) * sum over subsets S of the other path features of
|S|! (d-1-|S|)! / d! * prod_S o * prod_not-S z, whose products by size are the coefficients
of the polynomial prod (z_j + o_j t). Contributions plus the bias add up to the raw margin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.boosting import NULL, Tree, added
from ebbtide.operators.learning import ChurnModel, inputs
from ebbtide.session import settle


@dataclass
class Paths:
    """Leaves of one tree: per leaf and path feature its number (-1: none), the bins it lets pass, and its cover share."""

    value: np.ndarray
    feature: np.ndarray
    passes: np.ndarray  # (leaf, place, bin)
    share: np.ndarray
    expected: float
    table: tuple | None = None

    def masked(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Per place the parts (way, leaf) for every way to pass the places, and per leaf, place and bin the bit it sets; made once."""
        if self.table is None:
            leaves, depth = self.feature.shape
            ways = np.arange(1 << depth)[:, None]
            # Places without a feature always pass.
            known = [((ways >> j & 1) | (self.feature[:, j] < 0)).astype(float) for j in range(depth)]
            bits = (self.passes << np.arange(depth)[None, :, None]).astype(np.uint8)
            self.table = [np.asfortranarray(part) for part in _parts(self, known)], bits
        return self.table


def leaf_paths(tree: Tree) -> Paths:
    leaves = []
    bins = np.arange(NULL + 1)
    todo = [(0, {})]
    while todo:
        n, held = todo.pop()
        f = tree.feature[n]
        if f < 0:
            leaves.append((tree.value[n], held))
            continue
        goes_left = np.where(bins == NULL, tree.null_left[n], bins <= tree.bin[n])
        for child, way in ((tree.left[n], goes_left), (tree.right[n], ~goes_left)):
            passes, share = held.get(f, (np.ones(NULL + 1, bool), 1.0))
            todo.append((child, {**held, f: (passes & way, share * tree.cover[child] / max(tree.cover[n], 1e-12))}))
    depth = max(len(held) for _, held in leaves)
    feature, share = np.full((len(leaves), depth), -1), np.ones((len(leaves), depth))
    passes = np.ones((len(leaves), depth, NULL + 1), bool)
    for k, (_, held) in enumerate(leaves):
        for j, (f, (way, z)) in enumerate(held.items()):
            feature[k, j], passes[k, j], share[k, j] = f, way, z
    value = np.array([v for v, _ in leaves])
    return Paths(value, feature, passes, share, float((value * share.prod(axis=1)).sum()))


MASKED = 7  # path features up to which a leaf's parts are made once for all 2 ** features ways to pass


def shapley(paths: Paths, codes: np.ndarray, out: np.ndarray) -> None:
    """Add one tree's Shapley values of rows of bins to ``out`` (rows, features).

    A leaf's parts depend on which of its path features let the row pass alone. With few
    path features they are made for every such way and looked up; with many, row by row.
    Places that a leaf does not use have o = z = 1: players that change nothing.
    """
    depth = paths.feature.shape[1]
    if not depth:
        return
    used = paths.feature >= 0
    if depth > MASKED:
        leaf = np.arange(len(paths.value))
        known = [paths.passes[leaf, j, codes[:, paths.feature[:, j]]].astype(float) for j in range(depth)]  # (rows, leaves)
        for i, part in enumerate(_parts(paths, known)):
            for k in np.flatnonzero(used[:, i]).tolist():
                out[:, paths.feature[k, i]] += part[:, k]
        return
    table, bits = paths.masked()
    for k, (features, places) in enumerate(zip(paths.feature, used, strict=True)):
        way = np.zeros(len(codes), np.uint8)
        for j in np.flatnonzero(places).tolist():
            way |= bits[k, j].take(codes[:, features[j]])
        for j in np.flatnonzero(places).tolist():
            out[:, features[j]] += table[j][:, k].take(way)


def _parts(paths: Paths, known: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Per place the parts (rows, leaves) of the feature there; ``known`` holds o by place."""
    depth = len(known)
    weight = [math.factorial(k) * math.factorial(depth - 1 - k) / math.factorial(depth) for k in range(depth)]
    for i in range(depth):
        poly = [np.ones_like(known[0])]
        for j in range(depth):
            if j == i:
                continue
            z, o = paths.share[:, j], known[j]
            longer = [c * z for c in poly] + [np.zeros_like(poly[0])]
            for k, c in enumerate(poly):
                longer[k + 1] = longer[k + 1] + c * o
            poly = longer
        yield paths.value * (known[i] - paths.share[:, i]) * sum(w * c for w, c in zip(weight, poly, strict=True))


_ROWS = 4096  # rows explained at a time


def tree_contributions(df: DataFrame, model: ChurnModel, keep: list[str], name: str = "contributions") -> DataFrame:
    """``keep`` columns, margin, bias and the contribution array of every row."""
    spark = df.sparkSession
    boosted, features = model.model, list(model.features)
    shared = spark.sparkContext.broadcast((boosted, [leaf_paths(t) for t in boosted.trees]))  # bounded by rounds and leaves
    # One array, not a renamed column per feature: Spark would derive constraints for every choice of names.
    x = df.select(*keep, F.array(*inputs(df, features)).alias("_x"))
    kinds = dict(df.dtypes)
    entry = "array<struct<feature: string, contribution: double, value: double>>"
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", margin double, bias double, `{name}` {entry}"

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, paths = shared.value
        bias, width = sum(p.expected for p in paths), len(features)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                n = part.num_rows
                m = part.column("_x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, width)
                share = np.zeros((n, width), order="F")
                codes = np.asfortranarray(fitted.codes(m))
                for p in paths:
                    shapley(p, codes, share)
                cells = pa.StructArray.from_arrays([pa.array(features * n, pa.string()), pa.array(share.ravel()), pa.array(m.ravel(), mask=np.isnan(m).ravel())], ["feature", "contribution", "value"])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), cells)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(share.sum(axis=1) + bias), pa.array(np.full(n, bias)), lists], names=[*keep, "margin", "bias", name])

    return x.mapInArrow(explain, schema)


# ---- clusters ------------------------------------------------------------------------------------
PASSES, SHIFT = 50, 1e-4  # Lloyd steps at most, and the movement below which a start has settled


def _seeds(points: DataFrame, k: int, seed: int, starts: int) -> np.ndarray:
    """Centres (start, cluster, place): per start the k points that its hash puts first, different ones if there are."""
    out = []
    for s in range(starts):
        place = F.xxhash64(F.lit(seed + s), "x")
        rows = points.groupBy("x").agg(F.min(place).alias("h")).orderBy("h", "x").limit(k).collect()
        x = [r["x"] for r in rows]
        out.append([x[i % len(x)] for i in range(k)])
    return np.array(out, float)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Each row's nearest centre, ties to the first one: by one product, and by differences where that is too close to call."""
    square = (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)
    far = square - 2 * (x @ centres.T)
    near = far.argmin(axis=1)
    low = far[np.arange(len(x)), near]
    close = np.flatnonzero((far <= low[:, None] + 1e-9 * square.max(axis=1, keepdims=True)).sum(axis=1) > 1)
    near[close] = ((x[close, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    return near


def joint_lloyd(points: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and costs of all starts after Lloyd steps that share each pass over ``points`` (x array<double>)."""
    starts, k, width = centres.shape

    def step(now: np.ndarray) -> np.ndarray:
        shared = points.sparkSession.sparkContext.broadcast(now)

        def run(batches):
            total = np.zeros((starts, k, width + 2))  # sums, rows, cost
            for batch in batches:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, width)
                for s, c in enumerate(shared.value):
                    near = nearest(x, c)
                    cost = ((x - c[near]) ** 2).sum(axis=1)
                    total[s] += (near == np.arange(k)[:, None]).astype(float) @ np.column_stack([x, np.ones(len(x)), cost])
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

        out = added(points.mapInArrow(run, "sums binary"), starts * k * (width + 2)).reshape(starts, k, width + 2)
        shared.unpersist()
        return out

    moving = np.ones(starts, bool)
    for _ in range(PASSES):
        sums = step(centres)
        n = sums[..., width]
        new = np.where(n[..., None] > 0, sums[..., :width] / np.maximum(n, 1)[..., None], centres)
        moving = ((new - centres) ** 2).sum(axis=2).max(axis=1) > SHIFT**2
        centres = new
        if not moving.any():
            break
    return centres, step(centres)[..., width + 1].sum(axis=1)


def cluster_contributions(df: DataFrame, k: int = 4, seed: int = 42, starts: int = 10, contributions: str = "contributions", name: str = "cluster") -> DataFrame:
    """K-means on standardised contributions, the cheapest of ``starts`` seeded starts; adds the cluster id."""
    values = F.transform(F.col(contributions), lambda e: e["contribution"])
    data = settle(df.withColumn("_v", array_to_vector(values)))
    scaled = StandardScaler(inputCol="_v", outputCol="_s", withMean=True, withStd=True).fit(data).transform(data).withColumn("_s", vector_to_array("_s"))
    points = settle(scaled.select(F.col("_s").alias("x")))
    if not points.limit(1).count():
        return df.withColumn(name, F.lit(0))
    centres, cost = joint_lloyd(points, _seeds(points, k, seed, starts))
    best = centres[int(cost.argmin())]
    far = [F.aggregate(F.zip_with("_s", F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b) for c in best]
    near = F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(far)])
    return scaled.withColumn(name, F.array_min(near)["i"]).drop("_v", "_s")


# --- fixed values: default names of the four segments ------------------------------------------
SEGMENT_NAMES = {0: "Contract Expiry Risk", 1: "Service Quality Issue", 2: "Price Sensitive", 3: "Financial Risk"}


def segment_label(cluster: str = "cluster"):
    pairs = [F.lit(x) for kv in SEGMENT_NAMES.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(cluster)), F.lit("Other"))
