"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with word marks), so a misspelt or inflected word shares
most vectors with the word it hides. A passage of ``window`` words is the mean of the vectors of its
words (a word that comes again counts once) and a linear softmax scores it; a document counts by its most
toxic passage, so that one insult in a long text is not averaged away. Training first takes passages of
labelled documents at random, then, round by round, each document's worst passage, and moves embeddings
and softmax together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import held_out, map_rows, plain_words, texts_of, training_rows

REMEMBERED = 400_000  # distinct words a worker remembers before it starts afresh


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18  # rows of the embedding table; n-grams are hashed into them
    size: int = 8  # numbers in a vector
    shortest: int = 3  # characters of an n-gram
    longest: int = 5
    own: float = 0.2  # weight of the word itself among its n-grams
    window: int = 4  # words of a passage; passages overlap by half
    most: int = 1500  # training documents of each label, at most
    chars: int = 10_000  # characters of a training document, at most
    warm: int = 8  # rounds on passages drawn at random
    drawn: int = 6  # passages drawn from a document in each of them
    rounds: int = 12  # rounds on the worst passages
    start: float = 0.01  # spread of the first, random vectors
    rate: float = 0.3
    least_docs: int = 5  # training documents that must hold an n-gram for it to learn
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Inference needs the embeddings only through the softmax: one number for each n-gram."""

    settings: Settings
    gram_logit: np.ndarray  # softmax difference (toxic minus clean) of every embedding row
    bias: float


_POWERS = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, np.uint64))


def _rows(key: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (key ^ (key >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def grams_of(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding row of every n-gram of every ``<word>``, the index of the word it is from, its weight.

    The word itself is a gram too, with a weight of ``own``, so that a word whose parts
    are all common can still stand out. Weights of a word add up to 1.
    """
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), length)
    left = np.repeat(np.cumsum(length), length) - np.arange(len(code))  # characters to the word's end
    key = code.astype(np.uint64)
    place = np.concatenate(([0], np.cumsum(length)[:-1]))
    whole_key = np.add.reduceat(code.astype(np.uint64) * _POWERS[np.arange(len(code)) - np.repeat(place, length) & 1023], place)
    ids, owners = [_rows(whole_key, s.buckets)], [np.arange(len(words))]
    for n in range(2, s.longest + 1):
        key = key[:-1] * np.uint64(1_000_003) + code[n - 1 :]  # of the n characters from each place on
        if n >= s.shortest:
            whole = np.flatnonzero(left[: len(key)] >= n)
            ids.append(_rows(key[whole] + np.uint64(n), s.buckets))
            owners.append(owner[whole])
    parts = np.concatenate(owners[1:])
    share = (1 - s.own) / np.maximum(1, np.bincount(parts, minlength=len(words)))
    weight = np.concatenate((np.full(len(words), s.own), share[parts]))
    return np.concatenate(ids), np.concatenate(owners), weight


@dataclass(frozen=True)
class Passages:
    """Half-overlapping passages of some documents, as the distinct words of each.

    ``word`` and ``passage`` are parallel: word number and passage number, once for each distinct word
    of a passage. ``first`` is the first passage of every document; a document without words has one
    empty passage.
    """

    word: np.ndarray
    passage: np.ndarray
    first: np.ndarray
    count: int

    @staticmethod
    def of(docs: list[np.ndarray], window: int) -> Passages:
        step = max(1, window // 2)
        size = np.array([len(d) for d in docs], dtype=np.int64)
        passages = np.maximum(1, -(-size // step) - 1)
        first = np.concatenate(([0], np.cumsum(passages)))
        doc = np.repeat(np.arange(len(docs)), size)
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        word = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        # Where the same word stood last in the same document.
        order = np.lexsort((word, doc))
        same = (word[order][1:] == word[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        last = np.full(len(word), -1)
        last[order[1:][same]] = place[order[:-1][same]]
        words, numbers = [], []
        for back in (0, 1):  # a word stands in at most two passages
            number = place // step - back
            new = (number >= 0) & (number < passages[doc]) & (last < number * step)
            words.append(word[new])
            numbers.append((first[doc] + number)[new])
        return Passages(np.concatenate(words), np.concatenate(numbers), first[:-1], int(first[-1]))


def _words(text: str) -> list[bytes]:
    return plain_words(text.lower())


def train(rows: list[tuple[str, int]], s: Settings = Settings()) -> Model:
    """Learn from [(text, label)]. Without rows of both labels every score is the share of label 1
    (0 with no rows at all)."""
    rows = [(w, y) for t, y in rows if (w := _words(t))]
    n_toxic = sum(y for _, y in rows)
    if not rows or n_toxic in (0, len(rows)):
        share = min(max(n_toxic / len(rows) if rows else 0.0, 1e-6), 1 - 1e-6)
        return Model(s, np.zeros(s.buckets), float(np.log(share / (1 - share))))

    vocabulary: dict[bytes, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words]) for words, _ in rows]
    label = np.array([y for _, y in rows])
    gram, owner, gram_weight = grams_of([w.decode("utf-8", "surrogatepass") for w in vocabulary], s)
    by_word = np.argsort(owner, kind="stable")
    gram, gram_weight = gram[by_word], gram_weight[by_word]
    n_grams = np.bincount(owner, minlength=len(vocabulary))
    gram_start = np.cumsum(n_grams) - n_grams
    # A gram of few documents would only learn those by heart: it keeps a vector of zeros.
    in_docs = np.zeros(s.buckets, np.int64)
    for d in docs:
        word = np.unique(d)
        grams = n_grams[word]
        at = np.repeat(gram_start[word] - np.cumsum(grams) + grams, grams) + np.arange(grams.sum())
        in_docs[np.unique(gram[at])] += 1
    learns = in_docs >= s.least_docs
    passages = Passages.of(docs, s.window)
    by_passage = np.argsort(passages.passage, kind="stable")
    passage_word = passages.word[by_passage]
    n_words = np.bincount(passages.passage, minlength=passages.count)
    word_start = np.cumsum(n_words) - n_words

    rng = np.random.default_rng(s.seed)
    table = rng.normal(0, s.start, (s.buckets, s.size)) * learns[:, None]
    softmax = rng.normal(0, 1, (2, s.size))
    bias = np.zeros(2)
    seen_table = np.full(s.buckets, 1e-4)
    seen_softmax, seen_bias = np.full((2, s.size), 1e-4), np.full(2, 1e-4)
    balance = np.where(label == 1, 0.5 * len(docs) / n_toxic, 0.5 * len(docs) / (len(docs) - n_toxic))

    end = np.append(passages.first[1:], passages.count)
    for number in range(s.warm + s.rounds):
        if number < s.warm:
            # Any passages of a document first: what only toxic documents hold stands out, wherever it is.
            drawn = np.repeat(np.arange(len(docs)), s.drawn)
            chosen = passages.first[drawn] + rng.integers(0, (end - passages.first)[drawn])
        else:
            gram_logit = table @ (softmax[1] - softmax[0])
            word_logit = np.add.reduceat(gram_logit[gram] * gram_weight, gram_start)
            score = np.bincount(passages.passage, word_logit[passages.word], passages.count)
            drawn = np.arange(len(docs))
            chosen = np.array([a + np.argmax(score[a:b]) for a, b in zip(passages.first, end, strict=True)])
        order = rng.permutation(len(drawn))
        for rows_of in np.array_split(order, max(1, len(order) // 128)):
            batch, picked = drawn[rows_of], chosen[rows_of]
            size = n_words[picked]
            word = passage_word[np.repeat(word_start[picked] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            grams = n_grams[word]
            at = np.repeat(gram_start[word] - np.cumsum(grams) + grams, grams) + np.arange(grams.sum())
            ids, weight = gram[at], gram_weight[at] / s.window
            part = np.repeat(np.repeat(np.arange(len(batch)), size), grams)
            mean = np.stack(
                [np.bincount(part, weight * table[ids, k], len(batch)) for k in range(s.size)], 1
            )
            z = mean @ softmax.T + bias
            p = np.exp(z - z.max(1, keepdims=True))
            error = p / p.sum(1, keepdims=True)
            error[np.arange(len(batch)), label[batch]] -= 1
            error *= balance[batch, None]  # both labels weigh the same, whatever their share
            grad_mean = error @ softmax
            grad_softmax, grad_bias = error.T @ mean / len(batch), error.mean(0)
            used = learns[ids]
            ids, part, weight = ids[used], part[used], weight[used]
            hit, back = np.unique(ids, return_inverse=True)
            grad = np.stack(
                [np.bincount(back, weight * grad_mean[part, k], len(hit)) for k in range(s.size)], 1
            )
            seen_table[hit] += (grad**2).mean(1)
            table[hit] -= s.rate * grad / np.sqrt(seen_table[hit])[:, None]
            seen_softmax += grad_softmax**2
            softmax -= s.rate * grad_softmax / np.sqrt(seen_softmax)
            seen_bias += grad_bias**2
            bias -= s.rate * grad_bias / np.sqrt(seen_bias)
    return Model(s, table @ (softmax[1] - softmax[0]), float(bias[1] - bias[0]))


class Scorer:
    """Scores whole texts; remembers the numbers of a bounded count of words."""

    def __init__(self, model: Model):
        self.model, self.number, self.logit = model, {}, np.zeros(0)

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > REMEMBERED and self.number:
            self.number, self.logit, new = {}, np.zeros(0), list(words)
        if new:
            ids, owner, weight = grams_of([w.decode("utf-8", "surrogatepass") for w in new], self.model.settings)
            logit = np.bincount(owner, self.model.gram_logit[ids] * weight, len(new))
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            self.logit = np.append(self.logit, logit)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        docs = [_words(t) for t in texts]
        self._learn(set().union(*docs))
        number, s = self.number, self.model.settings
        passages = Passages.of([np.array([number[w] for w in d], dtype=np.int64) for d in docs], s.window)
        mean = np.bincount(passages.passage, self.logit[passages.word], passages.count) / s.window
        logit = np.maximum.reduceat(mean, passages.first) + self.model.bias
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), cut: float = 0.3
) -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted.

    Only ``doc_id`` and ``text`` of ``docs`` and ``doc_id`` and ``toxic`` of ``labels`` are read; ids
    serve to join and to split, never as inputs of a score. A null or empty text, or one without
    words, gets the score of the bias alone. Repeated rows are scored each. An empty ``docs`` gives an
    empty result; without labels of both kinds the score is the share of label 1 among them. The
    model is learnt on the driver from a bounded sample (``shared.training_rows``) and is a table of
    ``settings.buckets`` numbers.
    """
    model = train(training_rows(docs, labels, "toxic", settings.most, settings.chars), settings)
    shared_model = docs.sparkSession.sparkContext.broadcast(model)  # buckets x 8 bytes

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        scorer = Scorer(shared_model.value)
        for b in batches:
            yield {
                "doc_id": b["doc_id"],
                "held_out": b["held_out"],
                "score": scorer.scores(b["text"]),
            }

    texts = texts_of(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = map_rows(
        texts.withColumn("held_out", held_out(F.col("doc_id"))),
        rows,
        f"doc_id {kind}, held_out boolean, score double",
    )
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))
