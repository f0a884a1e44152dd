"""Near copies by word shingles: SimHash groups and min-hash bands propose, exact set Jaccard decides.

A text is the set of its five-word shingles. Texts of equal sets are one node. A node has a SimHash fingerprint,
linked by the bit planes of ``near_duplicates``; each group of linked fingerprints forms a bucket. At a Jaccard
of 0.8 some ten of 64 bits differ, out of reach of the fingerprints' block keys, so min-hash bands form buckets
besides. Of two sets with Jaccard J a band of ``rows`` min-hashes agrees with probability J^rows; with 36 bands of 5 a pair at 0.8 shares no band
with probability 6e-7, at 0.85 with 2e-10. Nodes that share a band form a bucket. All members of a bucket of either kind are
first compared, by whole sets, with its smallest node, which links nearly all of a group of copies at one
comparison a member. Where a bucket then still holds several components, their members are compared with
each other, never those of one component: a large one is dealt into parts that meet only the others' parts.
So no pair is linked below the similarity, and one above it is lost only if its two texts share no band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.near_duplicates import components, fingerprint_groups, first_rows, majority, row_keys, smallest_row
from marquee.llm.shared import map_rows, spaced_words, stored, texts_of


@dataclass(frozen=True)
class Settings:
    shingle: int = 5  # words
    similarity: float = 0.8  # Jaccard of the shingle sets from which two texts are near copies
    bands: int = 36
    rows: int = 5  # min-hashes of a band
    seed: int = 42
    part_rows: int = 1024  # members of a bucket that meet in a task's cell, on average at most
    part_shingles: int = 2_000_000  # their shingles
    lead_rows: int = 128  # members that are compared with a copy of their lead's set in one task


def shingle_set(text: str, s: Settings = Settings()) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a text of fewer words is one shingle, without words none."""
    words = spaced_words(text)
    digest, seed = xxhash.xxh64_intdigest, s.seed
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= s.shingle:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: -s.shingle])).tolist()
    return np.unique(np.array(
        [digest(joined[a:b], seed) for a, b in zip(starts, (ends[s.shingle - 1 :] - 1).tolist(), strict=True)],
        dtype=np.uint64,
    ))


def band_keys(shingles: np.ndarray, s: Settings = Settings()) -> list[int]:
    """A signed 64-bit key for each band of min-hashes; none for an empty set."""
    if not len(shingles):
        return []
    factors = np.random.default_rng(s.seed).integers(0, 1 << 63, s.bands * s.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(len(factors), ~np.uint64(0))
    for at in range(0, len(shingles), 512):
        np.minimum(least, (shingles[at : at + 512, None] * factors).min(0), out=least)
    keys = [xxhash.xxh64_intdigest(band.tobytes(), b) for b, band in enumerate(least.reshape(s.bands, s.rows))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def jaccard_to(lead: np.ndarray, other: np.ndarray) -> float:
    """Jaccard of two sorted sets that are not empty."""
    at = np.minimum(np.searchsorted(lead, other), len(lead) - 1)
    common = np.count_nonzero(lead[at] == other)
    return common / (len(lead) + len(other) - common)


def exact_links(sets: list[np.ndarray], group: list[int], similarity: float) -> list[tuple[int, int]]:
    """Pairs (i, j) of sets of different groups with at least that Jaccard, enough to connect all that such
    pairs connect. Sets of one group are connected already and are not compared with each other."""
    sizes, group_of = np.array([len(x) for x in sets]), np.array(group)
    every, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    ids = np.split(numbers, np.cumsum(sizes)[:-1])
    mark = np.zeros(len(every), bool)
    links: list[tuple[int, int]] = []
    left = np.argsort(sizes, kind="stable")  # not yet linked, by size

    def take(groups: np.ndarray) -> list[int]:
        nonlocal left
        taken = np.isin(group_of[left], groups)
        members, left = left[taken].tolist(), left[~taken]
        return members

    while len(left):
        queue = take(group_of[left[:1]])
        while queue and len(left):
            c = queue.pop()
            # Jaccard is at most the quotient of the sizes; one more on each side for the rounding.
            low = np.searchsorted(sizes[left], sizes[c] * similarity - 1)
            high = np.searchsorted(sizes[left], sizes[c] / similarity + 1, side="right")
            if low == high:
                continue
            mark[ids[c]] = True
            common = np.array([np.count_nonzero(mark[ids[j]]) for j in left[low:high].tolist()])
            mark[ids[c]] = False
            near = left[low + np.flatnonzero(common / (sizes[c] + sizes[left[low:high]] - common) >= similarity)]
            if len(near):
                links += [(c, j) for j in near.tolist()]
                queue += take(group_of[near])
    return links


def _lead_links(buckets: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Links (u, v) of the members of a bucket with its smallest node v.

    A lead's set goes to one task for each ``lead_rows`` members, each member's set once for each of its
    distinct leads. A task holds one lead's set at a time.
    """
    # Jaccard is at most the quotient of the sizes.
    pairs = buckets.where("node != lead").where(
        F.least("size", "lead_size") + 1 >= F.greatest("size", "lead_size") * s.similarity
    ).select("node", "size", "lead").distinct()
    parts = pairs.groupBy("lead").agg(_parts(F.count(F.lit(1)), F.sum("size"), s.lead_rows, s.part_shingles).alias("parts"))
    places = pairs.join(parts, "lead").select(
        "node", "lead", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")
    ).union(parts.select(F.col("lead").alias("node"), "lead", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    gathered = places.join(sets, "node").repartition("lead", "part").sortWithinPartitions(
        "lead", "part", F.col("node") != F.col("lead")
    )

    def link(batches: Iterator[dict]) -> Iterator[dict]:
        held = np.zeros(0, np.uint64)
        for b in batches:
            out: dict[str, list] = {"u": [], "v": []}
            for node, lead, shingles in zip(b["node"], b["lead"], b["shingles"], strict=True):
                own = np.frombuffer(shingles, "<u8")
                if node == lead:
                    held = own
                elif jaccard_to(held, own) >= s.similarity:
                    out["u"].append(node)
                    out["v"].append(lead)
            yield out

    return map_rows(gathered, link, "u bigint, v bigint")


def _parts(rows: F.Column, shingles: F.Column, most_rows: int, most_shingles: int) -> F.Column:
    """How many parts so many rows and shingles are dealt into."""
    return F.greatest(F.ceil(rows / most_rows), F.ceil(shingles / most_shingles)).cast("int")


def _cells(buckets: DataFrame, roots: DataFrame, s: Settings) -> DataFrame:
    """(key, a, b, node, root): the members of buckets that hold several components, by pairs of parts.

    Leads are left out, since all members have met them, and so are buckets that hold the same members as
    another one. A component of more than a part has parts of its own, which never meet each other; the
    smaller ones share parts. Two parts make one cell of ``part_rows`` rows.
    """
    rows = buckets.where("node != lead").join(roots, "node", "left").select(
        "key", "node", "size", F.coalesce("root", "node").alias("root")
    )
    half = max(1, s.part_rows // 2), max(1, s.part_shingles // 2)
    by_root = stored(
        rows.groupBy("key", "root").agg(
            F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"), F.bit_xor(F.xxhash64("node")).alias("name")
        ).withColumn("parts", _parts(F.col("n"), F.col("words"), *half)),
        "parts-of-buckets",
    )
    small = F.col("parts") <= 1
    by_key = by_root.groupBy("key").agg(
        F.count(F.lit(1)).alias("roots"), F.sum("n").alias("n"), F.bit_xor("name").alias("name"),
        F.coalesce(_parts(F.sum(F.when(small, F.col("n"))), F.sum(F.when(small, F.col("words"))), *half), F.lit(0)).alias("mixed"),
        F.coalesce(F.sum(F.when(~small, F.col("parts"))), F.lit(0)).cast("int").alias("own_parts"),
    ).where("roots > 1")
    once = by_key.groupBy("n", "name").agg(F.min(F.struct("key", "mixed", "own_parts")).alias("k")).select(
        "k.key", "k.mixed", (F.col("k.mixed") + F.col("k.own_parts")).alias("all")
    )
    once = stored(once, "open-buckets")
    # One row for each component of more than a part, so a bucket has n / part_rows of them at most.
    before = Window.partitionBy("key").orderBy("root").rowsBetween(Window.unboundedPreceding, -1)
    ranges = by_root.where(~small).select(
        "key", "root", "parts", F.coalesce(F.sum("parts").over(before), F.lit(0)).cast("int").alias("base")
    )
    placed = rows.join(once, "key").join(ranges, ["key", "root"], "left")
    first = F.when(F.col("parts").isNotNull(), F.col("mixed") + F.col("base"))
    part = F.coalesce(first + F.pmod(F.xxhash64("node"), F.col("parts")), F.pmod(F.xxhash64("node"), F.col("mixed"))).cast("int")
    placed = placed.select("key", "node", "root", "all", "parts", first.alias("first"), part.alias("own"))
    meets = F.filter(
        F.sequence(F.lit(0), F.col("all") - 1),
        lambda p: F.when(F.col("first").isNull(), (p != F.col("own")) | (F.col("all") == 1))
        .otherwise((p < F.col("first")) | (p >= F.col("first") + F.col("parts"))),
    )
    return placed.select("key", "node", "root", "own", F.explode(meets).alias("with")).select(
        "key", F.least("own", "with").alias("a"), F.greatest("own", "with").alias("b"), "node", "root"
    )


def _cell_links(cells: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Links (u, v), v < u, between members of different components that meet in a cell."""
    gathered = cells.join(sets, "node").repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")

    def link(batches: Iterator[dict]) -> Iterator[dict]:
        out: dict[str, list] = {"u": [], "v": []}
        cell, nodes, roots, held = None, [], [], []

        def compare() -> None:
            for i, j in exact_links(held, roots, s.similarity):
                out["u"].append(max(nodes[i], nodes[j]))
                out["v"].append(min(nodes[i], nodes[j]))

        names = ("node", "root", "key", "a", "b", "shingles")
        for batch in batches:
            for node, root, key, a, b, shingles in zip(*(batch[c] for c in names), strict=True):
                if (key, a, b) != cell:
                    if len(held) > 1:
                        compare()
                    cell, nodes, roots, held = (key, a, b), [], [], []
                nodes.append(node)
                roots.append(root)
                held.append(np.frombuffer(shingles, "<u8"))
            yield out
            out = {"u": [], "v": []}
        if len(held) > 1:
            compare()
        yield out

    return map_rows(gathered, link, "u bigint, v bigint")


def simhash_buckets(nodes: DataFrame) -> DataFrame:
    """(node, size, key) of the nodes whose fingerprint ``fp`` is linked to that of another node, or equal to it."""
    roots = fingerprint_groups(nodes.select("fp").distinct())
    linked = nodes.select("node", "size", "fp").join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    return linked.select("node", "size", F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp")).alias("key"))


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with one row of each group of near copies: that with the smallest id.

    Near copies have a Jaccard of at least ``similarity`` between their sets of shingles, words parted by
    white space, A-Z as a-z; groups are what such pairs connect. Texts without words are equal to one
    another. All columns stay; equal and null ids are treated as by ``near_duplicates.keep_one``. 64-bit
    hashes stand for shingles and for sets.
    """
    s = settings
    texts = texts_of(docs).withColumn("digest", F.xxhash64("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            sets = [shingle_set(t, s) for t in b["text"]]
            names = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], np.uint64)
            yield {
                "doc_id": b["doc_id"], "digest": b["digest"], "node": names.view(np.int64),
                "size": [len(x) for x in sets], "fp": np.array([majority(x) for x in sets], np.uint64).view(np.int64),
                "keys": [band_keys(x, s) for x in sets],
            }

    rows = map_rows(texts, sketch, f"doc_id {kind}, digest bigint, node bigint, size bigint, fp bigint, keys array<bigint>")
    nodes = stored(
        rows.groupBy("node").agg(smallest_row().alias("first"), *[F.first(c).alias(c) for c in ("size", "fp", "keys")]),
        "sets-of-texts",
    )
    keyed = nodes.select("node", "size", F.explode("keys").alias("key")).union(simhash_buckets(nodes.where("size > 0")))
    shared = keyed.groupBy("key").agg(F.min(F.struct("node", "size")).alias("lead"), F.max("node").alias("most")).where("lead.node < most")
    buckets = stored(
        keyed.join(shared.select("key", F.col("lead.node").alias("lead"), F.col("lead.size").alias("lead_size")), "key"),
        "buckets",
    )
    members = buckets.select("node").distinct().join(nodes.select("node", "first"), "node")
    wanted = stored(members.select("node", *row_keys(F.col("first.doc_id"), F.col("first.digest"))), "members")
    asked = first_rows(texts.select("text", *row_keys(F.col("doc_id"), F.col("digest"))), wanted)

    def sets_of(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield {"node": b["node"], "shingles": [shingle_set(t, s).astype("<u8").tobytes() for t in b["text"]]}

    sets = stored(map_rows(asked, sets_of, "node bigint, shingles binary"), "sets")
    roots = components(_lead_links(buckets, sets, s))
    rest = _cell_links(stored(_cells(buckets, roots, s), "cells"), sets, s)
    roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(rest))
    first = nodes.select("node", "first").join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(
        F.min("first").alias("first")
    )
    kept = stored(first.select(*row_keys(F.col("first.doc_id"), F.col("first.digest"))).distinct(), "kept")
    names = docs.columns
    digest = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    numbered = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)], *row_keys(docs["doc_id"], digest))
    return first_rows(numbered, kept).toDF(*names)
