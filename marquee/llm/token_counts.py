"""Token counts: a unigram tokenizer's best segmentation, computed once per shared prefix in a trie.

The distinct pre-tokens of a batch are put into a trie, level by level as numpy arrays. The best score
of a prefix (the forward score of the unigram model) depends on the prefix alone, so it is computed once
for all pre-tokens below it; the number of pieces at a pre-token's last node is its token count.
"""

from __future__ import annotations

import importlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from marquee.llm.shared import map_rows, texts_of

MARK = "▁"  # stands for the space before a word
REMEMBERED = 300_000  # pre-tokens whose counts a worker keeps before it starts afresh
_BASE = np.uint64(1_000_003)
_LOW = np.uint64((1 << 20) - 1)


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    """Place of one of the installed public vocabulary files."""
    return importlib.import_module("public_tokenizers").path(name)


def read_pieces(path: str) -> dict[str, float]:
    """Piece -> log-probability. The file ranks its pieces by frequency; the log-probability is that of
    Zipf's law over the rank, so nothing is trained."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    ranked = sorted(normal, key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / r for r in range(1, len(ranked) + 1)))
    return {model.id_to_piece(i): -math.log(r) - total for r, i in enumerate(ranked, start=1)}


def _mix(key: np.ndarray) -> np.ndarray:
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ (key >> np.uint64(29))


@dataclass(frozen=True)
class Unigram:
    """Pieces as sorted hashes. ``unknown`` is the score of a character no piece covers; it is spelt in
    its UTF-8 bytes, one token each."""

    keys: np.ndarray
    scores: np.ndarray
    maybe: np.ndarray  # by the last 20 bits of a hash: may a piece have it?
    longest: int
    unknown: float

    @staticmethod
    def of(pieces: dict[str, float]) -> Unigram:
        if not pieces:
            return Unigram(np.zeros(1, np.uint64), np.full(1, -np.inf), np.zeros(1 << 20, bool), 1, -10.0)
        keys = np.array([int(_hash_of(p)) for p in pieces], dtype=np.uint64)
        order = np.argsort(keys)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces share a hash")
        scores = np.array(list(pieces.values()))[order]
        maybe = np.zeros(1 << 20, bool)
        maybe[keys & _LOW] = True
        return Unigram(keys[order], scores, maybe, max(map(len, pieces)), float(scores.min()) - 10)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are pieces, and their scores."""
        hit = np.flatnonzero(self.maybe[keys & _LOW])
        at = np.minimum(np.searchsorted(self.keys, keys[hit]), len(self.keys) - 1)
        true = self.keys[at] == keys[hit]
        return hit[true], self.scores[at[true]]

    def token_counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each distinct non-empty pre-token; ties of the score go to fewer tokens."""
        words = sorted(words)
        n, count = len(words), np.zeros(len(words), np.int64)
        length = np.fromiter(map(len, words), np.int64, n)
        width = int(length.max(initial=0))
        start = np.cumsum(length) - length
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        # Level 0 is the root. node: number, on its level, of each word's prefix; words are sorted, so
        # the words below a node stand side by side.
        node = np.zeros(n, np.int64)
        best, tokens = [np.zeros(1)], [np.zeros(1, np.int64)]
        up: list[np.ndarray] = [np.zeros(1, np.int64)]  # node -> its parent on the level above
        letters: list[np.ndarray] = [np.zeros(1, np.uint64)]
        alive = np.arange(n)
        for level in range(1, width + 1):
            alive = alive[length[alive] >= level]
            letter = code[start[alive] + level - 1]
            new = np.ones(len(alive), bool)
            new[1:] = (node[alive][1:] != node[alive][:-1]) | (letter[1:] != letter[:-1])
            parent, letter_of = node[alive][new], letter[new].astype(np.uint64)
            node[alive] = np.cumsum(new) - 1
            up.append(parent)
            letters.append(letter_of)
            size = np.where(letter_of < 0x80, 1, np.where(letter_of < 0x800, 2, np.where(letter_of < 0x10000, 3, 4)))
            score = best[level - 1][parent] + self.unknown
            used = tokens[level - 1][parent] + size
            # Pieces that end here, from one character up: the key grows to the left along the path.
            key, power, at = np.zeros(len(parent), np.uint64), np.uint64(1), np.arange(len(parent))
            for back in range(min(level, self.longest)):
                key = key + letters[level - back][at] * power
                power = np.uint64(int(power) * int(_BASE) & 0xFFFFFFFFFFFFFFFF)
                at = up[level - back][at]
                hit, value = self.look_up(_mix(key + np.uint64(back + 1)))
                through = best[level - back - 1][at[hit]] + value
                fewer = tokens[level - back - 1][at[hit]] + 1
                better = (through > score[hit]) | ((through == score[hit]) & (fewer < used[hit]))
                score[hit[better]], used[hit[better]] = through[better], fewer[better]
            best.append(score)
            tokens.append(used)
            ends = alive[length[alive] == level]
            count[ends] = used[node[ends]]
            old = level - self.longest
            if old >= 0:  # no piece reaches further back
                best[old], tokens[old], up[old], letters[old] = (np.zeros(0),) * 4
        return words, count


def _hash_of(piece: str) -> np.uint64:
    key, power = 0, 1
    for c in reversed(piece):
        key = (key + ord(c) * power) % (1 << 64)
        power = power * int(_BASE) % (1 << 64)
    return _mix(np.array([(key + len(piece)) % (1 << 64)], dtype=np.uint64))[0]


class Counter:
    """Counts tokens of whole texts; remembers a bounded number of pre-tokens."""

    def __init__(self, unigram: Unigram):
        self.unigram, self.known = unigram, {}

    def counts(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """(pre-tokens, tokens) of each text. A pre-token is a word between white space with the mark in
        front."""
        docs = [t.split() for t in texts]
        words = set().union(*docs) if docs else set()
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED and self.known:
            self.known, new = {}, list(words)
        if new:
            ordered, count = self.unigram.token_counts([MARK + w for w in new])
            self.known.update(zip((w[1:] for w in ordered), count.tolist(), strict=True))
        known = self.known
        return [len(d) for d in docs], [sum(map(known.__getitem__, d)) for d in docs]


def count_tokens(docs: DataFrame, path: str | None = None, pieces: dict[str, float] | None = None) -> DataFrame:
    """Per document: doc_id, n_pretokens, n_tokens (both long), over the whole text.

    ``path`` names a sentencepiece file (default: the installed 32k one); ``pieces`` may give
    piece -> log-probability instead. A null, empty or white-space text has 0 tokens. Repeated rows are
    counted each; an empty table gives an empty result. No shuffle: a worker's memory is bounded by
    ``REMEMBERED`` pre-tokens and one batch.
    """
    unigram = Unigram.of(read_pieces(path or vocabulary_path()) if pieces is None else pieces)
    texts = texts_of(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        counter = Counter(unigram)
        for b in batches:
            pretokens, tokens = counter.counts(b["text"])
            yield {"doc_id": b["doc_id"], "n_pretokens": pretokens, "n_tokens": tokens}

    return map_rows(texts, rows, f"doc_id {kind}, n_pretokens bigint, n_tokens bigint")
