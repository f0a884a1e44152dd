"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint has a bit for each of 64 majorities over the hashes of a text's shingles. Fingerprints
within the radius agree in at least two of four 16-bit blocks, so equal pairs of blocks (six keys) bring
every such pair together. In a bucket, fingerprints are stored as vertical bit planes; carry-save counters
add up 64 distances in each machine word, plane by plane, and words in which every pair has passed the
radius are abandoned. Links within a block of rows are reduced to a spanning forest at once, and
components are found by alternating star contraction over shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import map_rows, spaced_words, stored, texts_of


@dataclass(frozen=True)
class Settings:
    shingle: int = 3  # words
    seed: int = 42  # of XXH64
    radius: int = 2  # differing bits of a link; the four-block keys are exact up to 2
    chunk: int = 4096  # rows of a bucket that are compared with one another in one go

    def __post_init__(self) -> None:
        if not 0 <= self.radius <= 2:
            raise ValueError("the block keys find all pairs up to 2 differing bits")


def fingerprint(text: str, s: Settings = Settings()) -> int:
    """64-bit SimHash: a bit is 1 if set in over half the shingle hashes; 0 for a text without words."""
    words = spaced_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= s.shingle:
        return xxhash.xxh64_intdigest(joined, s.seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: -s.shingle])).tolist()
    digest, seed = xxhash.xxh64_intdigest, s.seed
    hashes = np.array(
        [digest(joined[a:b], seed) for a, b in zip(starts, (ends[s.shingle - 1 :] - 1).tolist(), strict=True)],
        dtype=np.uint64,
    )
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half the hashes; 0 for none."""
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65_536 + 1):
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _planes(prints: np.ndarray) -> np.ndarray:
    """Bit planes: row k holds bit k of 64 fingerprints in each word; one spare word at the end."""
    count = -(-len(prints) // 64) + 1
    bits = np.zeros((count * 64, 64), np.uint8)
    bits[: len(prints)] = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def _bits(flags: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words * 64, np.uint8)
    out[: len(flags)] = flags
    return np.packbits(out, bitorder="little").view("<u8")


def close_pairs(prints: np.ndarray, bucket: np.ndarray, part: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows of the same bucket within the radius, in arrays.

    Rows are sorted by bucket. Row i meets row i + d for d = 1, 2, ...: the planes shifted by d bits. Where
    a bucket was dealt in two parts, ``part`` is 0 or 1 and only rows of different parts meet; -1 means
    that all rows meet.
    """
    planes = _planes(prints)
    words = planes.shape[1] - 1
    d = 0
    rows = np.arange(len(prints))
    while True:
        d += 1
        rows = rows[rows + d < len(prints)]
        rows = rows[bucket[rows] == bucket[rows + d]]
        if not len(rows):
            return
        meet = rows[(part[rows] < 0) | (part[rows] != part[rows + d])]
        if not len(meet):
            continue
        flags = np.zeros(len(prints), bool)
        flags[meet] = True
        valid = _bits(flags, words + 1)[:words]
        at = np.flatnonzero(valid)  # words in which some pair is still to be judged
        over = ~valid[at]
        low, high = np.zeros_like(over), np.zeros_like(over)
        jump, shift = divmod(d, 64)
        left, right = np.uint64(shift), np.uint64(64 - shift) if shift else None
        for k in range(64):
            near = np.minimum(at + jump, words)
            other = planes[k, near]
            if shift:
                other = (other >> left) | (planes[k, np.minimum(near + 1, words)] << right)
            bit = planes[k, at] ^ other
            carry = low & bit
            low ^= bit
            over |= high & carry  # four or more
            high ^= carry
            if k % 8 == 7:
                passed = over | (high & low if radius == 2 else high if radius == 1 else high | low)
                going = np.flatnonzero(passed != ~np.uint64(0))
                if len(going) < len(at):  # abandon the words in which all pairs are too far apart
                    at, over, low, high = at[going], over[going], low[going], high[going]
                    if not len(at):
                        break
        if len(at):
            far = over | (high & low if radius == 2 else high if radius == 1 else high | low)
            close = np.unpackbits((~far).view(np.uint8).reshape(len(at), 8), axis=1, bitorder="little")
            word, bit_at = np.nonzero(close)
            i = at[word] * 64 + bit_at
            yield i, i + d


def forest(nodes: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> dict[int, int]:
    """node -> smallest node of its component, for the nodes that have a smaller one."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while x in up:
            if up[x] in up:
                up[x] = up[up[x]]
            x = up[x]
        return x

    for i, j in pairs:
        for a, b in zip(nodes[i].tolist(), nodes[j].tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


KEYS = list(combinations(range(4), 2))


def _links(prints: DataFrame, s: Settings) -> DataFrame:
    """Links (node, smaller node) that connect all fingerprints within the radius.

    ``prints``: distinct fingerprints ``fp`` with their node, any number. Buckets of more than
    ``chunk`` rows are dealt into parts, every two of which meet in a task of their own.
    """
    fp = F.col("fp")
    block = [F.shiftrightunsigned(fp, 16 * b).bitwiseAND(F.lit(0xFFFF)) for b in range(4)]
    keys = F.array(*[
        (F.lit(n) * F.lit(1 << 32) + F.shiftleft(block[a], 16) + block[b]) for n, (a, b) in enumerate(KEYS)
    ])
    keyed = prints.select("node", "fp", F.explode(keys).alias("key"))
    large = stored(
        keyed.groupBy("key").count().where(F.col("count") > s.chunk)
        .select("key", F.ceil(F.col("count") / s.chunk).cast("int").alias("parts")),
        "hotkeys",
    )
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = keyed.join(large, "key", "left").select(
        "node", "fp", "key", own.alias("own"),
        F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))).alias("with"),
    ).select(
        "node", "fp", "key",
        F.coalesce(F.least("own", "with"), F.lit(-1)).alias("a"),
        F.coalesce(F.greatest("own", "with"), F.lit(-1)).alias("b"),
        F.when(F.col("own").isNull() | (F.col("own") == F.col("with")), -1)
        .otherwise((F.col("own") > F.col("with")).cast("int")).alias("part"),
    )
    gathered = dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")

    def link(batches: Iterator[dict]) -> Iterator[dict]:
        held: list[np.ndarray] = []
        for b in batches:
            new = [np.array(b[c], dtype=np.int64) for c in ("node", "fp", "key", "a", "b", "part")]
            held = [np.concatenate(x) for x in zip(held, new, strict=True)] if held else new
            # The last bucket may go on in the next batch.
            same = (held[2] == held[2][-1]) & (held[3] == held[3][-1]) & (held[4] == held[4][-1])
            whole = int(np.argmax(same))
            if whole >= 2048:
                yield compare([x[:whole] for x in held])
                held = [x[whole:] for x in held]
        if held:
            yield compare(held)

    def compare(rows: list[np.ndarray]) -> dict:
        node, fp, key, a, b, part = rows
        new = np.ones(len(node), bool)
        new[1:] = (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        bucket = np.cumsum(new)
        alone = new & np.append(new[1:], True)
        kept = np.flatnonzero(~alone)
        found = forest(
            node[kept], close_pairs(fp[kept].view(np.uint64), bucket[kept], part[kept], s.radius)
        )
        return {"u": list(found.keys()), "v": list(found.values())}

    return map_rows(gathered, link, "u bigint, v bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node each linked node reaches. ``links``: (u, v) with v < u.

    Alternating large-star and small-star steps; each keeps at most one edge for each edge before it, and
    a node's smallest neighbour is found by an aggregate that is combined before its shuffle.
    """
    edges = stored(links.distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first())

    now = state(edges)
    while now[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("v < u").distinct()
        )
        large = stored(large, "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        meet = large.join(least, "u")
        small = meet.select(F.col("v").alias("u"), F.col("m").alias("v")).where("v < u").union(
            least.select("u", F.col("m").alias("v"))
        )
        edges = stored(small.distinct(), "edges")
        before, now = now, state(edges)
        if now == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def fingerprint_groups(prints: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(node, root): the smallest fingerprint that each linked one reaches. ``prints``: distinct ``fp``."""
    return components(_links(prints.select(F.col("fp").alias("node"), "fp"), settings))


def fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, digest (xxhash64 of the text), fp (signed long) of every row; written once."""
    texts = texts_of(docs).withColumn("digest", F.xxhash64("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            prints = np.array([fingerprint(t, settings) for t in b["text"]], dtype=np.uint64)
            yield {"doc_id": b["doc_id"], "digest": b["digest"], "fp": prints.view(np.int64)}

    return stored(map_rows(texts, rows, f"doc_id {kind}, digest bigint, fp bigint"), "prints")


def label_components(prints: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``prints`` with ``root``, a number of the component, and ``component_id``, its smallest doc_id."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = fingerprint_groups(nodes, settings)
    placed = stored(
        nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")),
        "placed",
    )
    least = stored(placed.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    label = stored(placed.join(least, "root").select("fp", "root", "component_id"), "labels")
    return prints.join(label, "fp", "left")


def find_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row for each document row: doc_id, fingerprint (16 hex digits), component_id.

    Null, empty and word-less texts have fingerprint zero and link like any other. Rows with a null id
    link too; the component_id of a component without any id is null. Repeated rows repeat in the result.
    Fingerprints, not ids, are linked: rows that share an id keep the components of their own texts. An
    empty table gives an empty result.
    """
    labelled = label_components(fingerprints(docs, settings), settings)
    return labelled.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


KEYS_OF_ROW = ["_none", "_key", "_digest"]


def row_keys(an_id: F.Column, digest: F.Column) -> list:
    """Columns that name a row by id and text hash; a null id is a value of its own."""
    return [an_id.isNull().alias("_none"), F.coalesce(an_id.cast("string"), F.lit("")).alias("_key"), digest.alias("_digest")]


def smallest_row() -> F.Column:
    """Aggregate: the smallest id with its smallest text hash; a null id comes last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "digest"))


def first_rows(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """One of the rows for each row key in ``wanted``, with the columns of both, without the keys."""
    # The wanted rows grow with the documents: one plan at every size. Grouping needs no further shuffle.
    both = rows.join(wanted.hint("merge"), KEYS_OF_ROW)
    once = both.groupBy(*KEYS_OF_ROW).agg(*[F.first(c).alias(c) for c in both.columns if c not in KEYS_OF_ROW])
    return once.drop(*KEYS_OF_ROW)


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that with the smallest id.

    All columns stay. Of rows with the same smallest id the one with the smallest text hash stays, of rows
    repeated in id and text any one. A null id comes last.
    """
    labelled = label_components(fingerprints(docs, settings), settings)
    first = labelled.groupBy("root").agg(smallest_row().alias("first"))
    kept = stored(first.select(*row_keys(F.col("first.doc_id"), F.col("first.digest"))).distinct(), "kept")
    names = docs.columns
    digest = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    numbered = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)], *row_keys(docs["doc_id"], digest))
    return first_rows(numbered, kept).toDF(*names)
