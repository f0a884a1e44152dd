"""Best-fit packing into sequences of several permitted lengths.

Pieces go, longest first, into the open bin that they leave fullest. If none has room, the bin size with
the least cost per word is opened, judged by what is still to be placed. In the end every bin shrinks to
the shortest permitted length that holds its contents. Pieces are dealt at random into shards of bounded
size and each shard is packed by itself, so no task ever sees more than a shard.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import stored


@dataclass(frozen=True)
class Settings:
    lengths: tuple[int, ...] = (512, 1024, 2048, 4096)  # permitted sequence lengths, in words
    bin_cost: int = 16  # what a sequence costs beside its words
    attention: int = 16384  # a sequence of so many words costs as much again for attention
    shard: int = 8192  # pieces that are packed together, on average

    def __post_init__(self) -> None:
        if not self.lengths or min(*self.lengths, self.attention, self.shard) < 1 or self.bin_cost < 0:
            raise ValueError("lengths, attention and shard must be positive")


def pack(sizes: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset in it) of every size between 1 and the longest permitted length, and bin lengths."""
    lengths = sorted(set(s.lengths))
    order = np.argsort(-sizes, kind="stable")
    # up_to[x]: words in pieces of at most x words. Pieces go by falling size, so of those smaller than the
    # present one all are still to be placed, and of its own size all but the ``placed`` words.
    up_to = np.cumsum(np.bincount(sizes, np.asarray(sizes, float), minlength=lengths[-1] + 1))
    placed, last = 0, -1
    home, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    used: list[int] = []
    room: dict[int, list[int]] = {}  # free words -> bins
    free = 0  # bit x is set if a bin has x free words
    for i in order.tolist():
        size = int(sizes[i])
        placed, last = (placed if size == last else 0) + size, size
        fits = free >> size
        if fits:  # best fit: the least room that suffices
            space = size + (fits & -fits).bit_length() - 1
            b = room[space].pop()
            if not room[space]:
                free ^= 1 << space
        else:
            space = _cheapest(size, lengths, up_to, placed, s)
            b = len(used)
            used.append(0)
        home[i], offset[i] = b, used[b]
        used[b] += size
        if space > size:
            room.setdefault(space - size, []).append(b)
            free |= 1 << (space - size)
    final = np.array([lengths[bisect_left(lengths, u)] for u in used], dtype=np.int64)
    return home, offset, final


def _cheapest(size: int, lengths: list[int], up_to: np.ndarray, placed: int, s: Settings) -> int:
    """The permitted length that costs least per word, if what can still fill it does."""

    def cost(length: int) -> float:
        room = length - size
        left = float(up_to[min(room, size)]) - (placed if room >= size else 0)
        filled = size + min(room, left)
        return (length + length**2 / s.attention + s.bin_cost) / filled

    return min((x for x in lengths if x >= size), key=lambda x: (cost(x), x))


BINS = "bin_id bigint, bin_offset bigint, bin_words bigint, bin_length bigint"


def word_count() -> Column:
    """Words between white space; 0 for a null text."""
    return F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"\S+")).cast("bigint")


def pack_documents(docs: DataFrame, settings: Settings = Settings(), size: Column | None = None) -> DataFrame:
    """One row for each piece: doc_id, piece, first_word, n_words, bin_id, bin_offset, bin_words, bin_length.

    ``size`` is the column that measures a document (words between white space by default). A document
    longer than the longest permitted length is cut into pieces of that length and a rest, numbered from
    0. Null, empty and word-less texts have one piece of 0 words and no bin (null bin columns). Repeated
    rows are packed each. Only ``doc_id``, and what ``size`` reads, leaves the scan. An empty table gives
    an empty result.
    """
    longest, size = max(settings.lengths), word_count() if size is None else size
    sized = docs.select(F.col("doc_id"), F.coalesce(size, F.lit(0)).cast("bigint").alias("n"))
    pieces = sized.select(
        "doc_id", "n",
        F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.expr(f"cast((n - 1) div {longest} as int)")))).alias("piece"),
    ).select(
        "doc_id", F.col("piece").cast("bigint").alias("piece"),
        (F.col("piece") * longest).cast("bigint").alias("first_word"),
        F.least(F.lit(longest), F.col("n") - F.col("piece") * longest).cast("bigint").alias("n_words"),
        F.monotonically_increasing_id().alias("_row"),
    )
    pieces = stored(pieces, "pieces")  # from here on the row numbers are fixed
    shards = pieces.count() // settings.shard + 1
    dealt = pieces.where("n_words > 0").withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))

    schema = dealt.drop("_shard", "_row").schema.toDDL() + ", " + BINS

    def packed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_row")  # the same bins whatever order the rows came in
        sizes = rows["n_words"].to_numpy()
        home, offset, length = pack(sizes, settings)
        filled = np.bincount(home, sizes, len(length)).astype(np.int64)
        shard = rows["_shard"][0].as_py()
        out = rows.drop_columns(["_row", "_shard"])
        for name, values in (
            ("bin_id", shard * (1 << 32) + home), ("bin_offset", offset),
            ("bin_words", filled[home]), ("bin_length", length[home]),
        ):
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out

    empty = pieces.where("n_words <= 0").drop("_row")
    return dealt.groupBy("_shard").applyInArrow(packed, schema).unionByName(empty, allowMissingColumns=True)
