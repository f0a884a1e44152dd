"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``window`` words. Each passage is encoded by a small tanh layer
over its surface features, a gated attention (tanh branch times sigmoid branch) learns from document
labels alone which passages matter, and the attention-weighted passage representation is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import held_out, map_rows, texts_of, training_rows


@dataclass(frozen=True)
class Settings:
    window: int = 64  # words of a passage
    encoded: int = 16  # numbers that represent a passage
    attention: int = 8  # width of the attention's two branches
    most: int = 2000  # training documents of each label, at most
    chars: int = 20_000  # characters of a training document, at most
    epochs: int = 60
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 11


# Classes of a UTF-8 byte: other symbols, lower case, upper case, digits, white space, full stops and
# commas, exclamation and question marks, bars, other quotes and brackets, bytes of non-ASCII letters.
KINDS = 10
_KIND = np.zeros(256, dtype=np.int64)
for _kind, _bytes in enumerate(
    (range(97, 123), range(65, 91), range(48, 58), (9, 10, 11, 12, 13, 32), b".,;:", b"!?", b"|", b"\"'()[]{}<>-", range(128, 256)),
    start=1,
):
    _KIND[list(_bytes)] = _kind
N_FEATURES = KINDS + 8


def passage_features(text: str, window: int) -> np.ndarray:
    """One row of surface features for each passage; a text without words has a single row of zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros((1, N_FEATURES))
    count = -(-n // window)
    passage = np.arange(n) // window
    data = " ".join(words).encode("utf-8", "surrogatepass")
    data = np.frombuffer(data, np.uint8)
    length = np.diff(np.flatnonzero(data == 32), prepend=-1, append=len(data)) - 1  # bytes of a word
    owner = np.repeat(passage, length + 1)[: len(data)]
    kind = np.bincount(owner * KINDS + _KIND[data], minlength=count * KINDS)
    out = np.empty((count, N_FEATURES))
    out[:, :KINDS] = kind.reshape(count, KINDS) / np.bincount(owner, minlength=count)[:, None]
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    size = np.bincount(passage, minlength=count)
    pair, times = np.unique(passage * len(number) + ids, return_counts=True)
    home = pair // len(number)
    most = np.zeros(count)
    np.maximum.at(most, home, times)
    again = np.zeros(n)
    again[1:] = (ids[1:] == ids[:-1]) & (passage[1:] == passage[:-1])
    mean = np.bincount(passage, length, count) / size
    out[:, KINDS] = np.bincount(home, minlength=count) / size  # share of distinct words
    out[:, KINDS + 1] = most / size  # share of the commonest word
    out[:, KINDS + 2] = np.bincount(passage, again, count) / size  # words that repeat the last one
    out[:, KINDS + 3] = mean / 10
    out[:, KINDS + 4] = np.sqrt(np.maximum(0, np.bincount(passage, length**2, count) / size - mean**2)) / 10
    out[:, KINDS + 5] = np.bincount(passage, length <= 1, count) / size
    out[:, KINDS + 6] = np.log1p(size) / 5
    out[:, KINDS + 7] = len(number) / n  # share of distinct words in the whole document
    return out


@dataclass(frozen=True)
class Model:
    settings: Settings
    shift: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def _forward(self, x: np.ndarray, first: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        doc = np.repeat(np.arange(len(size)), size)
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        s = (t * g) @ w["attend"]
        e = np.exp(s - np.maximum.reduceat(s, first)[doc])
        a = e / np.add.reduceat(e, first)[doc]
        z = np.add.reduceat(a[:, None] * h, first)
        logit = np.clip(z @ w["score"] + w["bias"], -500, 500)
        return {"doc": doc, "h": h, "t": t, "g": g, "a": a, "z": z, "p": 1 / (1 + np.exp(-logit))}

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        bags = [passage_features(t, self.settings.window) for t in texts]
        size = np.array([len(b) for b in bags])
        x = (np.concatenate(bags) - self.shift) / self.scale
        return self._forward(x, np.cumsum(size) - size, size)["p"]


def train(rows: list[tuple[str, int]], s: Settings = Settings()) -> Model:
    """Learn from [(text, label)]. Without rows of both labels every score is about the share of
    label 1 (one half with no rows at all)."""
    rng = np.random.default_rng(s.seed)
    d, k, m = N_FEATURES, s.encoded, s.attention
    w = {
        "encode": rng.normal(0, d**-0.5, (d, k)), "encode_bias": np.zeros(k),
        "tanh": rng.normal(0, k**-0.5, (k, m)), "gate": rng.normal(0, k**-0.5, (k, m)),
        "attend": rng.normal(0, m**-0.5, m), "score": rng.normal(0, k**-0.5, k), "bias": np.zeros(1),
    }
    label = np.array([y for _, y in rows], dtype=float)
    if len(set(label.tolist())) < 2:
        share = float(np.clip(label.mean(), 1e-6, 1 - 1e-6)) if len(label) else 0.5
        w["score"], w["bias"] = np.zeros(k), np.array([np.log(share / (1 - share))])
        return Model(s, np.zeros(d), np.ones(d), w)
    bags = [passage_features(t, s.window) for t, _ in rows]
    every = np.concatenate(bags)
    model = Model(s, every.mean(0), every.std(0) + 1e-3, w)
    bags = [(b - model.shift) / model.scale for b in bags]
    balance = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    mean = {n: np.zeros_like(v) for n, v in w.items()}
    square = {n: np.zeros_like(v) for n, v in w.items()}
    step = 0
    for _ in range(s.epochs):
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 128)):
            size = np.array([len(bags[i]) for i in batch])
            first = np.cumsum(size) - size
            x = np.concatenate([bags[i] for i in batch])
            f = model._forward(x, first, size)
            doc, h, t, g, a = f["doc"], f["h"], f["t"], f["g"], f["a"]
            error = (f["p"] - label[batch]) * balance[batch] / len(batch)
            dz = error[:, None] * w["score"]
            da = (dz[doc] * h).sum(1)
            ds = a * (da - np.add.reduceat(a * da, first)[doc])
            dt, dg = ds[:, None] * w["attend"] * g * (1 - t**2), ds[:, None] * w["attend"] * t * g * (1 - g)
            dh = (a[:, None] * dz[doc] + dt @ w["tanh"].T + dg @ w["gate"].T) * (1 - h**2)
            grads = {
                "encode": x.T @ dh, "encode_bias": dh.sum(0), "tanh": h.T @ dt, "gate": h.T @ dg,
                "attend": (t * g).T @ ds, "score": f["z"].T @ error, "bias": error.sum(keepdims=True),
            }
            step += 1
            for n, grad in grads.items():
                mean[n] = 0.9 * mean[n] + 0.1 * grad
                square[n] = 0.999 * square[n] + 0.001 * grad**2
                move = mean[n] / (1 - 0.9**step) / (np.sqrt(square[n] / (1 - 0.999**step)) + 1e-8)
                w[n] -= s.rate * (move + s.decay * w[n])
    return model


def score_quality(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), cut: float = 0.7
) -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted.

    Only ``doc_id`` and ``text`` of ``docs`` and ``doc_id`` and ``quality`` of ``labels`` are read; ids
    serve to join and to split, never as inputs of a score. A null or empty text, or one of white
    space, is one passage of zeros. Repeated rows are scored each. An empty ``docs`` gives an empty
    result; without labels of both kinds the score is the share of label 1 among them. The model is
    learnt on the driver from a bounded sample (``shared.training_rows``) and has under a thousand
    numbers.
    """
    model = train(training_rows(docs, labels, "quality", settings.most, settings.chars), settings)

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            yield {"doc_id": b["doc_id"], "held_out": b["held_out"], "score": model.scores(b["text"])}

    texts = texts_of(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = map_rows(
        texts.withColumn("held_out", held_out(F.col("doc_id"))),
        rows,
        f"doc_id {kind}, held_out boolean, score double",
    )
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), cut: float = 0.7) -> DataFrame:
    """``docs`` without the rows whose text the classifier rejects, all columns and rows as they are.

    The text is scored where it stands, so no join is needed and repeated ids do no harm.
    """
    model = train(training_rows(docs, labels, "quality", settings.most, settings.chars), settings)
    names, schema = docs.columns, docs.schema
    at = names.index("text")
    bare = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            score = model.scores([t or "" for t in b[f"c{at}"]])
            good = np.flatnonzero(score >= cut).tolist()
            yield {n: [v[i] for i in good] for n, v in b.items()}

    return map_rows(bare, rows, bare.schema.toDDL()).toDF(*names).to(schema)
