"""Benchmark decontamination: SimHash windows of an item's size, multi-index Hamming blocks, exact check.

Every benchmark item has a SimHash of 192 bits of its five-word shingles. In a document, the windows that have
as many words as an item are fingerprinted wherever they share at least one shingle with one of that size:
elsewhere the similarity is zero. Twelve block tables propose the items: a fingerprint within the radius
of 47 bits has a block of 16 bits with at most 3 of them, so none within the radius is missed, while a
random fingerprint is proposed for about one item in eight. An item is listed under the values up to two
bits away, a window asks with those up to one bit away. Of what is proposed within the radius,
weighted-shingle (multiset) Jaccard decides.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import columns_of, map_rows, plain_words, stored, texts_of


@dataclass(frozen=True)
class Settings:
    shingle: int = 5  # words
    similarity: float = 0.8  # weighted Jaccard from which an item counts as contained
    block_bytes: int = 8 << 20  # benchmark text that one pass over the documents carries
    block_items: int = 4096  # items of it, each some ten kilobytes of index


BLOCKS = 12  # of 16 bits
RUN = 2048  # windows that are fingerprinted at a time


def _ball(bits: int) -> np.ndarray:
    """All differences of a block in at most that many bits."""
    return np.array([sum(1 << i for i in c) for k in range(bits + 1) for c in combinations(range(16), k)], np.uint16)


def block_bits(similarity: float) -> int:
    """Bits in which some block of two fingerprints differs at most, if their bags have that weighted Jaccard.

    Fingerprints of bags at a cosine of 2J / (1 + J) differ in a bit with the share that their angle has of
    a half turn; allowed are 3.6 deviations above the mean, that is 47 bits of 192 at 0.8.
    """
    share = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    most = 16 * BLOCKS * share + 3.6 * math.sqrt(16 * BLOCKS * share * (1 - share))
    return min(15, max(1, math.ceil(most) // BLOCKS))


def _shingles(words: list[bytes], size: int) -> list[int]:
    """Hashes of the shingles in order; fewer words than a shingle has make one shingle."""
    return [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + size]))
        for i in range(max(1, len(words) - size + 1))
    ] if words else []


def _signs(hashes: np.ndarray) -> np.ndarray:
    """One row for each hash: +1 or -1 for each of 192 bits, 64 of them the hash itself."""
    wide = np.empty((len(hashes), BLOCKS // 4), "<u8")
    for k in range(wide.shape[1]):
        x = hashes + np.uint64((k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        if k:
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
        wide[:, k] = x
    return np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as twelve blocks each, from the sums of signs."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u2")


def _nth(shingle: int, n: int) -> int:
    """Hash of the n-th occurrence (from 1) of a shingle: numbered, a bag is a set."""
    return shingle if n == 1 else xxhash.xxh64_intdigest(shingle.to_bytes(8, "little"), n)


def _numbered(shingles: list[int]) -> np.ndarray:
    seen: Counter = Counter()
    out = []
    for x in shingles:
        seen[x] += 1
        out.append(_nth(x, seen[x]))
    return np.array(out, dtype=np.uint64)


def _window_sums(shingles: list[int], starts: list[int], ends: list[int]) -> np.ndarray:
    """Sums of the signs of the numbered shingles of windows; each starts one shingle after the one before."""
    first = _signs(_numbered(shingles[starts[0] : ends[0]])).sum(0, dtype=np.int32)
    inside, gone, come = Counter(shingles[starts[0] : ends[0]]), [], []
    for w in range(1, len(starts)):
        out = shingles[starts[w] - 1]
        gone.append((w, _nth(out, inside[out])))
        inside[out] -= 1
        for x in shingles[ends[w - 1] : ends[w]]:
            inside[x] += 1
            come.append((w, _nth(x, inside[x])))
    sums = np.zeros((len(starts), 16 * BLOCKS), np.int32)
    sums[0] = first
    for changes, sign in ((gone, -1), (come, 1)):
        if changes:
            np.add.at(sums, np.array([w for w, _ in changes]), sign * _signs(np.array([h for _, h in changes], np.uint64)))
    return np.cumsum(sums, axis=0, dtype=np.int32)


class Index:
    """A block of benchmark items: shingles, fingerprints and, by size in words, the Hamming block tables."""

    def __init__(self, items: list[tuple], s: Settings):
        """items: (item_id, text)."""
        self.settings = s
        bits = block_bits(s.similarity)
        # A block differs in more than ``bits`` everywhere only if there are more bits than this in all.
        self.radius = (bits + 1) * BLOCKS - 1
        self.listed, self.asked = _ball(bits - 1), _ball(1)
        self.ids: list = []
        self.words: list[list[bytes]] = []
        for item_id, text in items:
            if words := plain_words((text or "").lower()):
                self.ids.append(item_id)
                self.words.append(words)
        self.vocabulary: dict[bytes, int] = {}
        for words in self.words:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary))
        hashes = [_shingles(w, s.shingle) for w in self.words]
        self.bags = [Counter(h) for h in hashes]
        self.prints = np.concatenate([_packed(_signs(_numbered(h)).sum(0, keepdims=True)) for h in hashes]) if hashes else np.zeros((0, BLOCKS), np.uint16)
        # shingle -> [(item, place)], by the word numbers of the shingle
        self.anchors: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for item, words in enumerate(self.words):
            ids = [self.vocabulary[w] for w in words]
            for place in range(max(1, len(ids) - s.shingle + 1)):
                self.anchors.setdefault(tuple(ids[place : place + s.shingle]), []).append((item, place))
        self.sizes = sorted({len(a) for a in self.anchors})
        self.known = {n: np.array(sorted({self._key(a) for a in self.anchors if len(a) == n}), np.uint64) for n in self.sizes}
        # tables[size][b]: sorted values near block b of an item of that size, and whose they are
        by_size: dict[int, list[int]] = {}
        for item, words in enumerate(self.words):
            by_size.setdefault(len(words), []).append(item)
        self.tables = {n: [self._table(np.array(items), b) for b in range(BLOCKS)] for n, items in by_size.items()}

    def _table(self, items: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        values = (self.prints[items, block][:, None] ^ self.listed).ravel()
        order = np.argsort(values, kind="stable")
        return values[order], np.repeat(items, len(self.listed))[order].astype(np.int32)

    @staticmethod
    def _key(ids) -> np.uint64:
        key = 0
        for i in ids:
            key = (key * 1_000_003 + i + 1) & 0xFFFFFFFFFFFFFFFF
        return np.uint64(key)

    def anchors_in(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(place in the text, item, place in the item) of every shared shingle."""
        for n in self.sizes:
            if len(ids) < n:
                continue
            key = np.zeros(len(ids) - n + 1, np.uint64)
            inside = np.ones(len(key), bool)
            for k in range(n):
                part = ids[k : len(ids) - n + 1 + k]
                inside &= part >= 0
                key = key * np.uint64(1_000_003) + part.astype(np.uint64) + np.uint64(1)
            places = np.flatnonzero(inside)
            known, wanted = self.known[n], key[places]
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            places = places[known[at] == wanted]
            for place in places.tolist():
                for item, at in self.anchors.get(tuple(ids[place : place + n].tolist()), ()):
                    yield place, item, at

    def matches(self, text: str) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, last word) of the best window of every item contained.

        Windows start wherever one of an item's size holds a shingle shared with an item of that size. Of
        two shingle bags with a weighted Jaccard of 0.8 the fingerprints differ in about 29 of 192 bits
        (standard deviation 5), so a radius of 47 is over three and a half deviations away (one in some
        ten thousand such windows lies beyond, fewer of more similar ones). Fingerprints are of pairs of a
        shingle and its occurrence number, so that this holds for repeated shingles too.
        """
        s = self.settings
        words = plain_words(text.lower())
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        starts: dict[int, set[int]] = {}
        for place, item, _ in self.anchors_in(ids):
            size = len(self.words[item])
            width = min(s.shingle, size)
            low, high = max(0, place + width - size), min(place, max(0, len(words) - size))
            starts.setdefault(size, set()).update(range(low, high + 1))
        best: dict[int, tuple[float, int, int]] = {}
        for size, places in starts.items():
            width = min(s.shingle, size)
            at = np.array(sorted(places))
            for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                for run in np.split(run, range(RUN, len(run), RUN)):
                    first, last = int(run[0]), min(int(run[-1]) + size, len(words))
                    hashes = _shingles(words[first:last], width)
                    ends = np.minimum(run - first + size - width + 1, len(hashes)).tolist()
                    prints = _packed(_window_sums(hashes, (run - first).tolist(), ends))
                    for w, item in zip(*(x.tolist() for x in self.within(prints, size)), strict=True):
                        bag = Counter(hashes[run[w] - first : ends[w]])
                        both = sum((bag & self.bags[item]).values())
                        value = both / (bag.total() + self.bags[item].total() - both)
                        if value >= s.similarity and value > best.get(item, (0.0, 0, 0))[0]:
                            best[item] = (value, int(run[w]), int(min(run[w] + size, len(words))) - 1)
        return [(item, *found) for item, found in sorted(best.items())]

    def proposed(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Window and item, each pair once, that agree in some block but for at most 3 bits; windows in order."""
        pairs = []
        for b, (values, owners) in enumerate(self.tables.get(size, ())):
            wanted, back = np.unique(prints[:, b], return_inverse=True)
            asked = (wanted[:, None] ^ self.asked).ravel()
            low, high = np.searchsorted(values, asked), np.searchsorted(values, asked, side="right")
            many = high - low
            hits = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            found = np.unique(np.repeat(np.arange(len(asked)) // len(self.asked), many) * len(self.ids) + owners[hits])
            value, item = np.divmod(found, len(self.ids))
            # The windows of each value, one after the other.
            times = np.bincount(back, minlength=len(wanted))
            begin, order = np.cumsum(times) - times, np.argsort(back, kind="stable")
            each = times[value]
            window = order[np.repeat(begin[value] - np.cumsum(each) + each, each) + np.arange(each.sum())]
            pairs.append(window * len(self.ids) + np.repeat(item, each))
        every = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        return every // max(1, len(self.ids)), every % max(1, len(self.ids))

    def within(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The proposed pairs whose fingerprints lie within the radius."""
        window, item = self.proposed(prints, size)
        near = np.bitwise_count(prints[window] ^ self.prints[item]).sum(1) <= self.radius
        return window[near], item[near]


def _blocks(benchmark: DataFrame, s: Settings) -> Iterator[list[tuple]]:
    """The benchmark in blocks of bounded size, so that neither driver nor task holds more than one.

    A block holds about ``block_bytes`` of text and ``block_items`` items: items are dealt by the hash of id and
    text into as many blocks as the whole asks for.
    """
    items = columns_of(benchmark, item_id="item_id", text="text").where(F.col("text").isNotNull()).distinct()
    total, rows = items.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    count = max((total or 0) // s.block_bytes, rows // s.block_items) + 1
    if count > 1:
        items = stored(items.withColumn("_b", F.pmod(F.xxhash64("item_id", "text"), F.lit(count))), "benchmark")
    for b in range(count):
        part = items if count == 1 else items.where(F.col("_b") == b)
        yield sorted(((r["item_id"], r["text"]) for r in part.toLocalIterator()), key=str)


def find_contamination(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Documents that contain a benchmark item: doc_id, item_id, similarity, first_word, last_word.

    One row for each document row and item whose best window of the item's size has a weighted Jaccard of
    at least ``settings.similarity``; words are letters and digits without case, counted from 0. Null,
    empty or word-less texts and items match nothing; an item of fewer words than a shingle is one
    shingle; a document shorter than the item is compared whole. Rows that repeat in ``docs`` repeat in
    the result; equal items are reported once each. Empty tables give an empty result. The documents are
    scanned once for every ``block_bytes`` of benchmark text; nothing is shuffled.
    """
    texts = texts_of(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, similarity double, first_word bigint, last_word bigint"
    context, result = docs.sparkSession.sparkContext, None
    for items in _blocks(benchmark, settings):
        index = context.broadcast(Index(items, settings))  # of a block of bounded size

        def rows(batches: Iterator[dict], index=index) -> Iterator[dict]:
            for b in batches:
                found = [
                    (d, index.value.ids[item], value, first, last)
                    for d, t in zip(b["doc_id"], b["text"], strict=True)
                    for item, value, first, last in index.value.matches(t)
                ]
                yield {
                    name: [f[i] for f in found]
                    for i, name in enumerate(("doc_id", "item_id", "similarity", "first_word", "last_word"))
                }

        part = map_rows(texts, rows, schema)
        result = part if result is None else result.union(part)
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item, all columns as they are.

    The text is judged where it stands: no join, and rows that share an id do not touch each other.
    """
    names, schema = docs.columns, docs.schema
    at = names.index("text")
    result = docs.toDF(*[f"c{i}" for i in range(len(names))])
    ddl = result.schema.toDDL()
    for items in _blocks(benchmark, settings):
        index = docs.sparkSession.sparkContext.broadcast(Index(items, settings))

        def rows(batches: Iterator[dict], index=index) -> Iterator[dict]:
            for b in batches:
                clean = [i for i, t in enumerate(b[f"c{at}"]) if not (t and index.value.matches(t))]
                yield {n: [v[i] for i in clean] for n, v in b.items()}

        result = map_rows(result, rows, ddl)
    return result.toDF(*names).to(schema)
