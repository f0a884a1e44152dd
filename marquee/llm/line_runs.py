"""Line dedup: a suffix array over line ids by distributed prefix doubling, later copies of repeated runs deleted.

Every text is a sequence of line ids (128-bit hashes; blank lines do not count). The distinct lines that
repeat are sorted over range partitions; a line's place in that order is its rank. Round k ranks the suffixes
by their first 2^k lines: their key is the pair of ranks of the two halves, and the distinct keys
that repeat are sorted and numbered again. A suffix whose key stands once has no common prefix of that length
with any other and drops out, so a round sorts only what is still tied, each key once however often it stands.

Suffixes of one rank are an interval of the suffix array whose longest common prefix is 2^k at least; for a
length between 2^k and 2^(k+1) the two overlapping halves give it. A repeated run counts from ``min_words`` words
on, so of the intervals those count whose common prefix reaches that. Words are parted by white space;
each character of a script written without spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese) counts as a
word. A maximal repeated run is the union of the shortest sufficient runs that start or end at its lines. So the
order beyond them is not needed, doubling stops there, and the number of rounds does not grow with the data.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import map_rows, stored, texts_of
from marquee.operators.ranking import row_numbers


@dataclass(frozen=True)
class Settings:
    min_words: int = 40  # words of a repeated run whose later copies are deleted


# Thai, Lao, Burmese, Khmer; kana, Bopomofo and Han with their extensions and half-width forms.
UNSPACED = re.compile(
    "[\u0e01-\u0e4e\u0e81-\u0ede\u0edf\u1000-\u103f\u1780-\u17d3\u3005-\u3007\u3041-\u30ff\u3105-\u312f\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af]"
)


def count_words(line: str) -> int:
    """Words by white space, each character of an unspaced script as one."""
    if line.isascii() or not UNSPACED.search(line):
        return len(line.split())
    return len(UNSPACED.sub(" x ", line).split())


def line_ids(text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Of the lines that are not blank: number in the text, id (two columns), words."""
    lines = [(i, x) for i, line in enumerate(text.split("\n")) if (x := line.strip())]
    if not lines:
        return [], np.zeros((0, 2), np.uint64), np.zeros(0, np.int64)
    ids = b"".join(xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for _, x in lines)
    words = np.array([count_words(x) for _, x in lines], dtype=np.int64)
    return [i for i, _ in lines], np.frombuffer(ids, "<u8").reshape(-1, 2), words


def dense(hits: list[dict] | None, count: int) -> np.ndarray:
    """Ranks by place from (place, rank) pairs; -1 where a prefix stands nowhere else."""
    out = np.full(max(0, count), -1, np.int64)
    if hits:
        out[[h["place"] for h in hits]] = [h["rank"] for h in hits]
    return out


def candidates(words: np.ndarray, level: int, halves: np.ndarray | None, least: int) -> np.ndarray:
    """Places whose prefix of 2^level lines needs a rank: both halves have one, and without its first or
    without its last line it has too few words."""
    size = 1 << level
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    sums = np.concatenate(([0], np.cumsum(words)))
    total = sums[size:] - sums[:count]
    short = (total - words[:count] < least) | (total - words[size - 1 :] < least)
    if halves is not None:
        short &= (halves[:count] >= 0) & (halves[size // 2 : size // 2 + count] >= 0)
    return np.flatnonzero(short)


def shortest_runs(words: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, lines) of the shortest runs with enough words from each start and to each end."""
    sums = np.concatenate(([0], np.cumsum(words)))
    n = len(words)
    ends = np.searchsorted(sums, sums[:-1] + least)  # first end with enough words
    runs = {(s, int(e) - s) for s, e in enumerate(ends.tolist()) if e <= n}
    starts = np.searchsorted(sums, sums[1:] - least, side="right") - 1
    runs |= {(int(s), e - int(s)) for e, s in enumerate(starts.tolist(), start=1) if s >= 0 and sums[e] - sums[s] >= least}
    return sorted((s, m) for s, m in runs if m > 0)


def _repeated(keyed: DataFrame, key: list[str], name: str) -> DataFrame:
    """Keys that stand more than once, with the smallest document id. Counted before the shuffle."""
    found = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("times"), F.min("doc_id").alias("first_doc"))
    return stored(found.where("times > 1").drop("times"), name)


def repeated_runs(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, digest (xxhash64 of the text) and ``runs`` (start line, lines) to delete.

    Only documents that have runs to delete are listed. Lines are counted without blank ones.
    """
    least = max(1, settings.min_words)
    texts = texts_of(docs).withColumn("digest", F.xxhash64("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    key = f"doc_id {kind}, digest bigint"

    def read(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            lines = [line_ids(t) for t in b["text"]]
            yield {
                "doc_id": b["doc_id"], "digest": b["digest"], "words": [x[2] for x in lines],
                "h1": [x[1][:, 0].view(np.int64) for x in lines],
                "h2": [x[1][:, 1].view(np.int64) for x in lines],
            }

    lines = stored(
        map_rows(texts, read, f"{key}, words array<bigint>, h1 array<bigint>, h2 array<bigint>"), "lines"
    )
    first = F.explode(F.arrays_zip("h1", "h2")).alias("line")
    found = _repeated(lines.select("doc_id", first).select("doc_id", "line.*"), ["h1", "h2"], "repeated0")
    state, level = lines, 0
    while not found.isEmpty():
        pair = [c for c in found.columns if c != "first_doc"]
        ranks = row_numbers(found.select(*pair), [F.col(c) for c in pair], "rank")
        if level:
            places = keyed
        else:
            each = F.posexplode(F.arrays_zip("h1", "h2")).alias("place", "line")
            places = lines.select("doc_id", "digest", each).select("doc_id", "digest", "place", "line.*")
        hits = (
            places.join(ranks, pair).groupBy("doc_id", "digest")
            .agg(F.collect_set(F.struct(F.col("place").cast("bigint").alias("place"), "rank")).alias(f"r{level}"))
        ).withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
        match = state["doc_id"].eqNullSafe(hits["_id"]) & (state["digest"] == hits["_digest"])
        # A text without repeated lines has no repeated run. Behind the first round the lines themselves are not carried on.
        state = stored(state.join(hits, match, "left" if level else "inner").drop("_id", "_digest", "h1", "h2"), f"state{level}")
        level += 1

        def halves(batches: Iterator[dict], level: int = level) -> Iterator[dict]:
            half = 1 << (level - 1)
            for b in batches:
                out: dict[str, list] = {c: [] for c in ("doc_id", "digest", "place", "n1", "n2")}
                for i, doc in enumerate(b["doc_id"]):
                    words = np.array(b["words"][i], dtype=np.int64)
                    before = dense(b[f"r{level - 1}"][i], len(words) - half + 1)
                    at = candidates(words, level, before, least)
                    out["doc_id"] += [doc] * len(at)
                    out["digest"] += [b["digest"][i]] * len(at)
                    out["place"] += at.tolist()
                    out["n1"] += before[at].tolist()
                    out["n2"] += before[at + half].tolist()
                yield out

        last = state.select("doc_id", "digest", "words", f"r{level - 1}").where(F.col(f"r{level - 1}").isNotNull())
        keyed = stored(map_rows(last, halves, f"{key}, place bigint, n1 bigint, n2 bigint"), f"keys{level}")
        found = _repeated(keyed, ["n1", "n2"], f"repeated{level}")
    levels = level

    def prefixes(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "digest", "place", "lines", "again", "n1", "n2")}
            for i, doc in enumerate(b["doc_id"]):
                words = np.array(b["words"][i], dtype=np.int64)
                ranks = [dense(b[f"r{k}"][i], len(words) - (1 << k) + 1) for k in range(levels)]
                seen: set[tuple[int, int, int]] = set()
                for s, m in shortest_runs(words, least):
                    k = m.bit_length() - 1
                    if k >= levels:
                        continue
                    n1, n2 = int(ranks[k][s]), int(ranks[k][s + m - (1 << k)])
                    if n1 >= 0 and n2 >= 0:
                        again = (m, n1, n2) in seen
                        for column, value in zip(out, (doc, b["digest"][i], s, m, again, n1, n2), strict=True):
                            out[column].append(value)
                        seen.add((m, n1, n2))
            yield out

    if not levels:
        schema = f"{key}, runs array<struct<place: bigint, lines: bigint>>"
        return docs.sparkSession.createDataFrame([], schema)
    runs = stored(
        map_rows(state, prefixes, f"{key}, place bigint, lines bigint, again boolean, n1 bigint, n2 bigint"),
        "prefixes",
    )
    interval = ["lines", "n1", "n2"]
    later = runs.join(_repeated(runs, interval, "intervals"), interval).where(
        F.col("again") | (F.col("first_doc") < F.col("doc_id"))
        | (F.col("doc_id").isNull() & F.col("first_doc").isNotNull())
    )
    return later.groupBy("doc_id", "digest").agg(F.collect_set(F.struct("place", "lines")).alias("runs"))


def without_runs(text: str, runs: list[dict]) -> tuple[str, int]:
    """The text without the lines of the runs, and how many lines went. Blank lines stay."""
    lines = text.split("\n")
    filled = [i for i, line in enumerate(lines) if line.strip()]
    gone = {filled[r["place"] + k] for r in runs for k in range(r["lines"])}
    return "\n".join(line for i, line in enumerate(lines) if i not in gone), len(gone)


def dedup_lines(docs: DataFrame, settings: Settings = Settings(), count: str | None = "deleted_lines") -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``.

    The column ``count`` is added (replaced if there is one): how many lines went. None adds no column.

    All rows and other columns stay as they are. A run is later if an equal one stands in a document of
    a smaller id, or earlier in the same text. Ties: rows with the same id are not later than each other;
    a null id comes after all others and null ids are not later than each other. Null and empty texts
    stay (0 deleted lines); a text whose every line is a later copy becomes empty. Lines are compared
    without white space at their ends. Empty tables give empty results.
    """
    names = [c for c in docs.columns if c != count]
    at = names.index("text")
    runs = stored(repeated_runs(docs, settings), "runs").toDF("_id", "_digest", "_runs")
    numbered = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)])
    digest = F.xxhash64(F.coalesce(F.col(f"c{at}"), F.lit("")))
    match = F.col(f"c{names.index('doc_id')}").eqNullSafe(F.col("_id")) & (digest == F.col("_digest"))
    # The runs grow with the documents: one plan at every size, never a broadcast.
    both = numbered.join(runs.hint("merge"), match, "left").drop("_id", "_digest")

    def delete(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            out = [(t, 0) if not r else without_runs(t, r) for t, r in zip(b[f"c{at}"], b.pop("_runs"), strict=True)]
            yield b | {f"c{at}": [x[0] for x in out], "gone": [x[1] for x in out]}

    cleaned = map_rows(both, delete, f"{numbered.schema.toDDL()}, gone bigint")
    return cleaned.drop("gone").toDF(*names) if count is None else cleaned.toDF(*names, count)
