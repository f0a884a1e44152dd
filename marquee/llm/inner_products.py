"""Exact top-k search by inner product: norm-sorted vectors, rotated partial sums, Cauchy-Schwarz bounds.

Vectors are range-partitioned by falling length and stored in that order. A query meets the longest ones
first, which gives it k scores; from then on a vector matters only if its bound reaches the k-th score.
The bounds grow tighter step by step: |q||x| for whole bands and batches, then, in the basis of the right
singular vectors, the inner product over the first dimensions plus |rest of q||rest of x|. The rotation moves
most of the length into the first dimensions, so the rest is small early. Pairs that pass all bounds are
scored in whole numbers; the bounds carry a margin for rounding, so none is lost.

On Spark: the Gram matrix behind the rotation is summed over tasks. Queries go out in blocks of bounded size
and are searched against all bands, task by task; a task keeps k rows for each query of the block, and
a window over those picks the best. Vectors are never shuffled after they are sorted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.shared import stored
from marquee.llm.vectors import EXACT, matrix, same_length, summed, whole_vectors
from marquee.session import shuffle_partitions


@dataclass(frozen=True)
class Settings:
    k: int = 5
    every: int = 50  # queries are the rows whose id is divisible by this
    scale: int = 256
    steps: tuple[float, ...] = (0.25, 0.5, 0.75)  # shares of the rotated dimensions after which bounds are tested
    block_values: int = 4 << 20  # components of the queries that go out together, about
    band_rows: int = 1 << 18  # vectors of one band of lengths, about
    batch_rows: int = 4096  # vectors and queries compared in one product
    margin: float = 1e-9  # for rounding, as a share of |q||x|


FOUND = "query_id bigint, vec_id bigint, score bigint"


class Rotated:
    """Vectors with their rotated form, their lengths, and what is left of the length after each step."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, rotation: np.ndarray, cuts: list[int]):
        self.ids, self.x = ids, x
        self.turned = x.astype(np.float64) @ rotation
        squares = self.turned**2
        self.length = np.sqrt(squares.sum(1))
        self.rest = [np.sqrt(squares[:, cut:].sum(1)) for cut in cuts]


class Search:
    """The best k of each query among the vectors shown so far."""

    def __init__(self, queries: Rotated, bound: np.ndarray, cuts: list[int], exact: bool, s: Settings):
        self.queries, self.cuts, self.exact, self.s = queries, cuts, exact, s
        self.bound = bound.astype(np.float64).copy()  # a score that k candidates are known to reach
        self.who, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.scored = 0  # pairs that no bound could rule out

    def show(self, vectors: Rotated) -> None:
        if not len(vectors.ids):
            return
        reach = self.queries.length * (vectors.length.max() * (1 + self.s.margin))
        active = np.flatnonzero(reach >= self.bound)
        for start in range(0, len(active), self.s.batch_rows):
            self._meet(active[start : start + self.s.batch_rows], vectors)

    def _meet(self, who: np.ndarray, vectors: Rotated) -> None:
        q, floor = self.queries, self.bound[who]
        there = np.arange(len(vectors.ids))
        partial, done = np.zeros((len(who), len(there))), 0
        keep = np.ones(partial.shape, bool)
        for step, cut in enumerate(self.cuts):
            partial = partial + q.turned[who, done:cut] @ vectors.turned[there, done:cut].T
            slack = self.s.margin * np.outer(q.length[who], vectors.length[there])
            keep &= partial + np.outer(q.rest[step][who], vectors.rest[step][there]) + slack >= floor[:, None]
            rows, cols = np.flatnonzero(keep.any(1)), np.flatnonzero(keep.any(0))
            who, there, floor, done = who[rows], there[cols], floor[rows], cut
            partial, keep = partial[np.ix_(rows, cols)], keep[np.ix_(rows, cols)]
            if not keep.size:
                return
        i, j = np.nonzero(keep)
        self.scored += len(i)
        if self.exact and 8 * len(i) > keep.size:  # whole numbers below 2^53: the product is exact
            score = (q.x[who].astype(np.float64) @ vectors.x[there].astype(np.float64).T)[i, j].astype(np.int64)
        else:
            score = np.concatenate([
                np.einsum("ij,ij->i", q.x[who[i[a : a + 65536]]], vectors.x[there[j[a : a + 65536]]])
                for a in range(0, len(i), 65536)
            ])
        ids, asking = vectors.ids[there[j]], who[i]
        good = (ids != q.ids[asking]) & (score >= self.bound[asking])
        self._take(asking[good], ids[good], score[good])

    def _take(self, who: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(who):
            return
        who, ids, score = (np.concatenate(p) for p in ((self.who, who), (self.ids, ids), (self.scores, score)))
        order = np.lexsort((ids, -score, who))
        who, ids, score = who[order], ids[order], score[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        best = place < self.s.k
        full = place == self.s.k - 1
        self.bound[who[full]] = np.maximum(self.bound[who[full]], score[full])
        self.who, self.ids, self.scores = who[best], ids[best], score[best]


def top_inner_products(
    embeddings: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """For every query row its ``k`` highest inner products: query_id, rank, vec_id, score.

    Each component c, as double, becomes the whole number floor(scale * c). Queries are the rows whose id is
    divisible by ``every``; candidates are all rows with another id; ties go to the smaller id; with
    fewer candidates than ``k`` all are returned. The result is exact. Rows with a null id, and
    vectors that are null, empty or hold null or non-finite components, take no part; zero vectors do. Rows
    that share an id are candidates each; repeated query rows ask once, and different vectors under one query
    id share one ranking. All vectors must have the same length, else ValueError; scores that could leave 64 bits
    raise ValueError. An empty table gives an empty result; extra columns are not looked at.
    """
    s = settings
    spark = embeddings.sparkSession
    usable = whole_vectors(embeddings, s.scale, 0, id_col, vector_col).where(F.col("vec_id").isNotNull())
    most = F.array_max(F.transform("x", lambda c: F.abs(c)))
    facts = usable.agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most"),
        F.max(most).alias("largest"),
    ).first()
    result = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not facts["rows"]:
        return spark.createDataFrame([], result)
    dims = same_length((facts["least"], facts["most"]))
    limit = dims * facts["largest"] ** 2
    if limit >= 1 << 63:
        raise ValueError("inner products of these vectors may leave 64 bits")
    exact = limit < EXACT

    square = F.aggregate("x", F.lit(0).cast("bigint"), lambda a, c: a + c * c)
    bands = max(-(-facts["rows"] // s.band_rows), min(shuffle_partitions(spark), -(-facts["rows"] // s.batch_rows)))
    falling = [F.col("square").desc(), F.xxhash64("vec_id", "x").asc()]  # equal lengths can be cut anywhere
    placed = stored(
        usable.withColumn("square", square).repartitionByRange(bands, *falling).sortWithinPartitions(*falling)
        .withColumn("band", F.spark_partition_id()),
        "by-length",
    )

    def gram(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column("x"))
        return (x.T @ x).ravel()

    # Right singular vectors of the whole table, longest first. Any rotation is right; this one is quick.
    rotation = np.linalg.eigh(summed(placed, gram, dims * dims).reshape(dims, dims))[1][:, ::-1].copy()
    cuts = sorted({max(1, round(dims * share)) for share in s.steps} | {dims})
    # One row for each band.
    longest = placed.groupBy("band").agg(F.sqrt(F.max("square")).alias("length")).toArrow().to_pylist()
    heads = sorted((r["band"], r["length"]) for r in longest)

    def asked(queries: Rotated, bound: np.ndarray, where: list[int]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = Search(queries, bound, cuts, exact, s)
            for batch in batches:
                for start in range(0, batch.num_rows, s.batch_rows):
                    some = batch.slice(start, s.batch_rows)
                    ids = some.column("vec_id").to_numpy(zero_copy_only=False)
                    search.show(Rotated(ids, matrix(some.column("x"), np.int64), rotation, cuts))
            yield pa.RecordBatch.from_pydict(
                {"query_id": queries.ids[search.who], "vec_id": search.ids, "score": search.scores}
            )

        within = placed.where(F.col("band").between(min(where), max(where))) if where else placed.limit(0)
        return stored(within.select("vec_id", "x").mapInArrow(run, FOUND), "found")

    asking = placed.where(F.col("vec_id") % s.every == 0).select("vec_id", "x").distinct()
    blocks = -(-asking.count() * dims // s.block_values)
    asking = stored(asking.withColumn("block", F.pmod(F.xxhash64("vec_id", "x"), F.lit(max(1, blocks)))), "queries")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = spark.createDataFrame([], FOUND)
    for block in range(blocks):  # each holds about ``block_values`` components
        rows = asking.where(F.col("block") == block).toArrow()
        if not rows.num_rows:
            continue
        queries = Rotated(rows["vec_id"].to_numpy(), matrix(rows["x"], np.int64), rotation, cuts)
        nothing = np.full(len(queries.ids), -np.inf)
        first = asked(queries, nothing, [heads[0][0]])
        kth = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == s.k)
        there = kth.select("query_id", "score").toArrow()  # one row for each query of the block
        known = dict(zip(there["query_id"].to_pylist(), there["score"].to_pylist(), strict=True))
        bound = np.array([known.get(i, -np.inf) for i in queries.ids.tolist()])
        # Bands are in falling order: those too short for every query are not read at all.
        needed = [b for b, top in heads[1:] if (queries.length * top * (1 + s.margin) >= bound).any()]
        found = found.union(first).union(asked(queries, bound, needed) if needed else first.limit(0))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
