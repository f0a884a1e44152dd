"""Approximate nearest neighbours: stable projections, kd-trees, incremental search, chi-square stop.

Vectors are projected to a few dimensions with Gaussian (2-stable) vectors: the squared projected
distance over the squared true distance follows a chi-square distribution with that many degrees of
freedom. A query takes projected neighbours in shells of growing distance, verifies them on the original
vectors, and stops once a neighbour better than its k-th best would already have come with the wanted
probability. Each point is judged by its own projected distance; the boxes of a kd-tree only save the
computing of it. Inner product is brought to distance by one more coordinate, sqrt(M^2 - |x|^2), with M the
greatest length among vectors of about the same length, so a long vector does not blur the short ones.

On Spark: the upper levels of one kd-tree (fitted on a bounded sample) deal all vectors into cells, and they are
stored in the order of cell and length. Queries go out in blocks of bounded size. A query first meets its home
cell, which bounds its k-th best, and then every chunk that is nearer in the projection than the bound
allows; each task keeps k rows for each query. Equal vectors are kept with their smallest ids only, so
copies cost nothing. Vectors are not shuffled after they are placed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.shared import columns_of, stored
from marquee.llm.vectors import finite, matrix, same_length
from marquee.session import shuffle_partitions


@dataclass(frozen=True)
class Settings:
    k: int = 20
    every: int = 20  # queries are the rows whose id is divisible by this
    projected: int = 16  # dimensions of the projection
    certainty: float = 0.95  # with which a true neighbour has come before the search stops
    sample: int = 65_536  # rows that the upper levels of the tree are fitted on, at most
    cells: int = 4_096  # leaves of the upper levels, at most; as many as there are chunks below that
    chunk: int = 4096  # vectors searched with one kd-tree
    slice: int = 1024  # queries searched together
    leaf: int = 64
    shells: tuple[float, ...] = (0.25, 0.5, 1.0)  # of the squared radius of the stop
    block_values: int = 4 << 20  # components of the queries that go out together, about
    margin: float = 1e-9  # for rounding, as a share of |q||x|
    seed: int = 5


def chi_square_cdf(x: np.ndarray, degrees: int) -> np.ndarray:
    """For an even number of degrees: 1 - exp(-x/2) * sum (x/2)^i / i!."""
    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_quantile(p: float, degrees: int) -> float:
    if degrees % 2 or degrees < 2:
        raise ValueError("the projection needs an even number of dimensions")
    low, high = 0.0, 10.0 * degrees + 100
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, degrees) < p else (low, mid)
    return high


@dataclass(frozen=True)
class Projection:
    """From a vector (and the greatest length of its band) to its augmented form and its projection."""

    matrix: np.ndarray  # (dimensions + 1) x projected

    @staticmethod
    def of(dimensions: int, s: Settings) -> Projection:
        return Projection(np.random.default_rng(s.seed).normal(size=(dimensions + 1, s.projected)))

    def points(self, x: np.ndarray, top: np.ndarray | float) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, top**2 - (x**2).sum(1)))
        return x @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.matrix[:-1]


@dataclass(frozen=True)
class Tree:
    """kd-tree whose leaves are boxes: axis -1 marks a leaf, ``child`` then is its number."""

    axis: np.ndarray
    cut: np.ndarray
    child: np.ndarray  # (nodes, 2)
    low: np.ndarray  # (leaves, dims)
    high: np.ndarray

    @staticmethod
    def fit(points: np.ndarray, leaf: int, most: int) -> tuple[Tree, np.ndarray]:
        """The tree and each point's leaf. At most ``most`` leaves; equal points are never split."""
        axis, cut, child, boxes = [], [], [], []
        home = np.zeros(len(points), np.int64)
        dims = points.shape[1]
        budget = {0: most}
        todo = [(0, np.arange(len(points)), np.full(dims, -np.inf), np.full(dims, np.inf))]
        axis.append(-1), cut.append(0.0), child.append((0, 0))
        while todo:
            node, rows, low, high = todo.pop()
            spread = np.ptp(points[rows], axis=0) if len(rows) else np.zeros(dims)
            a = int(np.argmax(spread))
            if len(rows) <= leaf or budget[node] < 2 or spread[a] == 0:
                child[node] = (len(boxes), len(boxes))
                home[rows] = len(boxes)
                boxes.append((low, high))
                continue
            values = points[rows, a]
            at = float(np.median(values))
            if at >= values.max():
                at = float(values[values < values.max()].max())
            left = values <= at
            axis[node], cut[node] = a, at
            child[node] = (len(axis), len(axis) + 1)
            upper, lower = high.copy(), low.copy()
            upper[a], lower[a] = at, at
            budget[len(axis)], budget[len(axis) + 1] = budget[node] // 2, budget[node] - budget[node] // 2
            for _ in range(2):
                axis.append(-1), cut.append(0.0), child.append((0, 0))
            todo.append((child[node][0], rows[left], low, upper))
            todo.append((child[node][1], rows[~left], lower, high))
        low, high = (np.array([b[i] for b in boxes]).reshape(len(boxes), dims) for i in (0, 1))
        return Tree(np.array(axis), np.array(cut), np.array(child), low, high), home

    def leaves(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        while True:
            inner = np.flatnonzero(self.axis[node] >= 0)
            if not len(inner):
                return self.child[node, 0]
            n = node[inner]
            right = points[inner, self.axis[n]] > self.cut[n]
            node[inner] = self.child[n, right.astype(int)]

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distances of points to every leaf's box, one dimension at a time."""
        out = np.zeros((len(points), len(self.low)))
        for low, high, x in zip(self.low.T, self.high.T, points.T, strict=True):
            gap = np.maximum(low[None] - x[:, None], x[:, None] - high[None])
            out += np.maximum(gap, 0) ** 2
        return out


def _boxes(points: np.ndarray, home: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Tight boxes of the points of each leaf."""
    low, high = np.full((count, points.shape[1]), np.inf), np.full((count, points.shape[1]), -np.inf)
    np.minimum.at(low, home, points)
    np.maximum.at(high, home, points)
    return low, high


class Chunk:
    """Vectors of one band of lengths with a kd-tree over their projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, cells: np.ndarray, top: float, projection: Projection, s: Settings):
        points = projection.points(vectors, top)
        tree, home = Tree.fit(points, s.leaf, len(points))
        order = np.argsort(home, kind="stable")
        self.ids, self.vectors, self.cells, self.points, self.top = ids[order], vectors[order], cells[order], points[order], top
        self.home = home[order]
        self.lengths = np.sqrt((self.vectors**2).sum(1))
        self.squares = (self.points**2).sum(1)
        self.tree = Tree(tree.axis, tree.cut, tree.child, *_boxes(points, home, len(tree.low)))


class Search:
    """The best k of each query among the chunks shown so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, cells: np.ndarray, bound: np.ndarray, projection: Projection, s: Settings):
        self.ids, self.vectors, self.cells, self.s = ids, vectors, cells, s
        self.bound = bound.astype(np.float64).copy()  # a score that k candidates are known to reach
        self.lengths = np.sqrt((vectors**2).sum(1))
        self.points = projection.queries(vectors)
        self.squares = (self.points**2).sum(1)
        self.limit = chi_square_quantile(s.certainty, s.projected)
        self.who, self.found, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.verified = 0

    def radius(self, who: np.ndarray, chunk: Chunk) -> np.ndarray:
        """The squared projected distance from which on better neighbours have come with the wanted certainty."""
        distance = chunk.top**2 + self.lengths[who] ** 2 - 2 * self.bound[who]
        return self.limit * np.maximum(distance, 0)

    def show(self, chunk: Chunk, at_home: bool) -> None:
        """Meets the queries whose home cell is in the chunk, or all the others."""
        asking = np.flatnonzero(np.isin(self.cells, chunk.cells)) if at_home else np.arange(len(self.ids))
        for start in range(0, len(asking), self.s.slice):
            self._meet(asking[start : start + self.s.slice], chunk, at_home)

    def _meet(self, who: np.ndarray, chunk: Chunk, at_home: bool) -> None:
        near = chunk.tree.distances(self.points[who]) <= self.radius(who, chunk)[:, None]
        rows, there = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0)[chunk.home])
        if not len(rows) or not len(there):
            return
        who = who[rows]
        far = self.squares[who][:, None] + chunk.squares[there][None] - 2 * self.points[who] @ chunk.points[there].T
        same = self.cells[who][:, None] == chunk.cells[there][None]
        left = (same if at_home else ~same) & (self.ids[who][:, None] != chunk.ids[there][None])
        for share in self.s.shells:
            reach = self.radius(who, chunk)[:, None] * share
            shell = left & (far <= reach) if np.isfinite(reach).any() else left
            self._verify(who, there, shell, chunk)
            left &= ~shell

    def _verify(self, who: np.ndarray, there: np.ndarray, shell: np.ndarray, chunk: Chunk) -> None:
        rows, cols = np.flatnonzero(shell.any(1)), np.flatnonzero(shell.any(0))
        if not len(rows):
            return
        who, there, shell = who[rows], there[cols], shell[np.ix_(rows, cols)]
        self.verified += int(shell.sum())
        score = self.vectors[who] @ chunk.vectors[there].T
        slack = self.s.margin * self.lengths[who] * chunk.lengths.max()
        score[~shell] = -np.inf
        floor = self.bound[who] - slack
        if score.shape[1] > self.s.k:
            floor = np.maximum(floor, np.partition(score, -self.s.k, axis=1)[:, -self.s.k] - 2 * slack)
        i, j = np.nonzero(shell & (score >= floor[:, None]))
        # Scores that count are computed pair by pair, so equal vectors get equal ones.
        asking, given = who[i], there[j]
        exact = np.concatenate([np.zeros(0), *[
            np.einsum("ij,ij->i", self.vectors[asking[a : a + 65536]], chunk.vectors[given[a : a + 65536]])
            for a in range(0, len(asking), 65536)
        ]])
        self._take(asking, chunk.ids[given], exact)

    def _take(self, who: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        who, ids, score = (np.concatenate(p) for p in ((self.who, who), (self.found, ids), (self.scores, score)))
        order = np.lexsort((ids, -score, who))
        who, ids, score = who[order], ids[order], score[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        full = place == self.s.k - 1
        self.bound[who[full]] = np.maximum(self.bound[who[full]], score[full])
        best = place < self.s.k
        self.who, self.found, self.scores = who[best], ids[best], score[best]


FOUND = "query_id bigint, vec_id bigint, score double"


def nearest_neighbours(
    embeddings: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """For every query row its ``k`` rows of largest inner product: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows with another id. Scores are
    double-precision inner products of the original vectors; ties go to the smaller id. With fewer
    candidates than ``k`` all are returned. Rows with a null id, and vectors that are null, empty, zero or hold
    null or non-finite components, take no part. Rows that share an id are candidates each; repeated query
    rows ask once, and different vectors under one query id share one ranking. All vectors that take part must have
    the same length, else ValueError. An empty table gives an empty result.
    """
    s = settings
    spark = embeddings.sparkSession
    narrow = columns_of(embeddings, vec_id=id_col, vector=vector_col).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector")
    )
    v = F.col("vector")
    usable = narrow.where(F.col("vec_id").isNotNull() & finite(v)).where(F.exists(v, lambda x: x != 0))
    # Of rows that are equal in id and vector k count at most, and of equal vectors those of the k + 1 smallest ids: for
    # any query these hold all copies that can be among its k.
    alike = usable.groupBy("vec_id", "vector").agg(F.least(F.count(F.lit(1)), F.lit(s.k)).alias("copies"))
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    distinct = stored(
        alike.withColumn("_place", F.row_number().over(smallest)).where(F.col("_place") <= s.k + 1).drop("_place"), "distinct"
    )
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))

    def with_band(df: DataFrame) -> DataFrame:
        return df.withColumn("_length", length).withColumn("band", F.round(F.log2("_length")).cast("int"))

    banded = with_band(distinct)
    facts = banded.groupBy("band").agg(
        F.max("_length").alias("top"), F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most"),
        F.count(F.lit(1)).alias("rows"),
    ).toArrow().to_pylist()  # a row for each power of two of the length
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if not facts:
        return spark.createDataFrame([], result)
    dims = same_length((min(f["least"] for f in facts), max(f["most"] for f in facts)))
    total = sum(f["rows"] for f in facts)
    tops = {f["band"]: f["top"] * (1 + 1e-12) for f in facts}
    projection = Projection.of(dims, s)

    def top_of(bands: np.ndarray) -> np.ndarray:
        return np.array([tops[b] for b in bands.tolist()], float)

    # Upper levels of the tree, on a sample of bounded size chosen by a hash of the id.
    share = min(1.0, s.sample / total)
    drawn = banded.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = drawn.limit(2 * s.sample).select("vector", "band").toArrow()
    bands = sample["band"].to_numpy()
    points = projection.points(matrix(sample["vector"]), top_of(bands)) if len(bands) else np.zeros((0, s.projected))
    tree, _ = Tree.fit(points, 1, int(min(s.cells, max(1, total // s.chunk))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, own = matrix(b.column("vector")), b.column("band").to_numpy(zero_copy_only=False)
                cell = tree.leaves(projection.points(x, top_of(own)))
                yield pa.RecordBatch.from_pydict({
                    **{c: b.column(c) for c in ("vec_id", "vector", "copies", "band")}, "cell": pa.array(cell, pa.int64()),
                })

    kinds = "vec_id bigint, vector array<double>, copies bigint, band int, cell bigint"
    names = ["vec_id", "vector", "copies", "band"]
    order = ["cell", "band", "_spread"]
    tasks = max(-(-total // (64 * s.chunk)), min(shuffle_partitions(spark), -(-total // s.chunk)))
    placed = stored(
        banded.select(names).mapInArrow(place, kinds).withColumn("_spread", F.xxhash64("vec_id")).repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order).select("vec_id", "vector", "copies", "band", "cell"),
        "placed",
    )

    def asked(queries: tuple[np.ndarray, ...], bound: np.ndarray, at_home: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = Search(*queries, bound, projection, s)
            for batch in batches:
                for start in range(0, batch.num_rows, s.chunk):
                    some = batch.slice(start, s.chunk)
                    times = some.column("copies").to_numpy(zero_copy_only=False)
                    ids, cells, own = (some.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "cell", "band"))
                    x = matrix(some.column("vector"))
                    for band in np.unique(own).tolist():
                        at = np.repeat(np.flatnonzero(own == band), times[own == band])
                        search.show(Chunk(ids[at], x[at], cells[at], tops[band], projection, s), at_home)
            yield pa.RecordBatch.from_pydict(
                {"query_id": search.ids[search.who], "vec_id": search.found, "score": search.scores}
            )

        return stored(placed.mapInArrow(run, FOUND), "found")

    every = usable.where(F.col("vec_id") % s.every == 0).distinct().withColumn("copies", F.lit(1).cast("bigint"))
    asking = stored(with_band(every).select(names).mapInArrow(place, kinds).select("vec_id", "vector", "cell"), "asking")
    count = asking.count()
    blocks = -(-count * dims // s.block_values)
    block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(max(1, blocks)))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = spark.createDataFrame([], FOUND)
    for number in range(blocks):  # each holds about ``block_values`` components
        some = asking.where(block == number).toArrow()
        if not some.num_rows:
            continue
        queries = some["vec_id"].to_numpy(), matrix(some["vector"]), some["cell"].to_numpy()
        home = asked(queries, np.full(some.num_rows, -np.inf), True)
        # A bound needs k answers, which a query has at its home or not.
        kth = home.withColumn("r", F.row_number().over(best)).where(F.col("r") == s.k).select("query_id", "score").toArrow()
        known = dict(zip(kth["query_id"].to_pylist(), kth["score"].to_pylist(), strict=True))
        bound = np.array([known.get(i, -np.inf) for i in queries[0].tolist()])
        found = found.union(home).union(asked(queries, bound, False))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
