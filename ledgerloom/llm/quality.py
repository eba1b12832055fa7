"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line's evidence are features of itself and of the lines
next to it; a chain over the lines lets each decision lean on its neighbours. Forward-backward
gives the probability of good for each line, and a document's score is their mean weighted with
the lines' lengths.

Lines inherit the label of their document when the weights are learned, by maximum likelihood, on
a bounded sample: at most ``SAMPLE_DOCS`` labelled documents (those with the smallest hash of
their id) in runs of at most ``RUN`` consecutive lines, ``SAMPLE_LINES`` lines in all. Scoring
reads every line of every text.

Defined results: a null or empty text is one empty line. Without labelled rows of both kinds all
scores are 0.5. Documents with a null or repeated id get a row each. Several labels of one id:
each counts as a labelled row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import WHITE, as_bytes, run_hashes, spans, word_hashes

SAMPLE_DOCS = 4000
SAMPLE_LINES = 60_000
RUN = 64
THRESHOLD = 0.7

_KINDS = 11


def _kinds() -> np.ndarray:
    kind = np.full(256, 10, dtype=np.int64)  # other punctuation
    for code in range(256):
        c = chr(code)
        if code >= 0x80:
            kind[code] = 3
        elif c.islower():
            kind[code] = 0
        elif c.isupper():
            kind[code] = 1
        elif c.isdigit():
            kind[code] = 2
    kind[[0x20, *range(0x09, 0x0E)]] = 4
    for k, chars in ((5, "."), (6, ","), (7, "!?"), (8, "|<>{}[]_~^\\"), (9, "#$%&*@+=")):
        kind[[ord(c) for c in chars]] = k
    return kind


_KIND = _kinds()
BASE = _KINDS + 8
#: own features, those of the line before and after, first and last line, constant
WIDTH = 3 * BASE + 3


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x WIDTH) and weights of the lines of one text."""
    data = as_bytes(text)
    breaks = data == 10
    line = np.cumsum(breaks) - breaks
    lines = int(breaks.sum()) + 1
    size = np.bincount(line[~breaks], minlength=lines).astype(np.float64)
    kinds = np.bincount(line[~breaks] * _KINDS + _KIND[data[~breaks]], minlength=lines * _KINDS)
    own = np.zeros((lines, BASE), dtype=np.float32)
    safe = np.maximum(size, 1)
    own[:, :_KINDS] = np.sqrt(kinds.reshape(lines, _KINDS) / safe[:, None])
    starts, ends = spans(data, WHITE)
    words = word_hashes(data, starts, ends)
    at = line[starts] if len(starts) else np.empty(0, dtype=np.int64)
    count = np.bincount(at, minlength=lines)
    many = np.maximum(count, 1)
    own[:, _KINDS] = np.log1p(size) / 8
    own[:, _KINDS + 1] = np.log1p(np.bincount(at, ends - starts, minlength=lines) / many)
    # words that the same line had before, and runs of three that the text had before
    marked = words ^ (at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(marked, return_index=True)
    own[:, _KINDS + 2] = 1 - np.bincount(at[first], minlength=lines) / many
    runs = run_hashes(words, 3)
    _, first = np.unique(runs, return_index=True)
    seen = np.ones(len(runs), dtype=bool)
    seen[first] = False
    own[:, _KINDS + 3] = np.bincount(at[: len(runs)][seen], minlength=lines) / many
    texts = (text or "").split("\n")
    earlier: set[str] = set()
    for i, t in enumerate(texts):
        own[i, _KINDS + 4] = t in earlier
        earlier.add(t)
    own[:, _KINDS + 5] = [t.rstrip().endswith((".", "!", "?")) for t in texts]
    own[:, _KINDS + 6] = [t[:1].isupper() for t in texts]
    own[:, _KINDS + 7] = size == 0
    out = np.zeros((lines, WIDTH), dtype=np.float32)
    out[:, :BASE] = own
    out[1:, BASE : 2 * BASE] = own[:-1]
    out[:-1, 2 * BASE : 3 * BASE] = own[1:]
    out[0, -3] = out[-1, -2] = 1
    out[:, -1] = 1
    return out, size + 1


@dataclass
class Chain:
    """Weights for the log odds of good per line, and the log potentials of staying or changing."""

    weights: np.ndarray
    step: np.ndarray  # 2 x 2, [from, to]

    def marginals(self, features: np.ndarray) -> np.ndarray:
        """Probability of good for every line, by forward-backward."""
        odds = (features @ self.weights).astype(np.float64)
        lines = len(odds)
        (bb, bg), (gb, gg) = np.exp(self.step).tolist()
        up = np.exp(np.clip(odds, -30, 30)).tolist()
        forward = [0.0] * lines  # share of good among the paths up to here
        b, g = 1.0, 1.0
        for i, u in enumerate(up):
            nb, ng = (1.0, u) if i == 0 else (b * bb + g * gb, (b * bg + g * gg) * u)
            b, g = nb / (nb + ng), ng / (nb + ng)
            forward[i] = g
        out = np.empty(lines)
        b, g = 1.0, 1.0
        for i in range(lines - 1, -1, -1):
            good, bad = forward[i] * g, (1 - forward[i]) * b
            out[i] = good / (good + bad)
            nb, ng = bb * b + bg * up[i] * g, gb * b + gg * up[i] * g
            b, g = nb / (nb + ng), ng / (nb + ng)
        return out

    def score(self, text: str | None) -> float:
        features, weight = line_features(text)
        return float(np.dot(self.marginals(features), weight) / weight.sum())


def learn(runs: list[np.ndarray], labels: list[int], rounds: int = 250, decay: float = 1e-3) -> Chain:
    """Maximum likelihood with a small quadratic penalty; all runs are worked on side by side."""
    if len(set(labels)) < 2:
        return Chain(np.zeros(WIDTH), np.zeros((2, 2)))
    order = sorted(range(len(runs)), key=lambda i: -len(runs[i]))
    runs, y = [runs[i] for i in order], np.array([labels[i] for i in order], dtype=np.int64)
    sizes = np.array([len(r) for r in runs])
    flat = np.concatenate(runs)
    mean, spread = flat.mean(axis=0), flat.std(axis=0)
    spread[spread < 1e-6] = 1
    mean[-1], spread[-1] = 0, 1
    flat = (flat - mean) / spread
    top = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    alive = [int((sizes > t).sum()) for t in range(sizes.max())]  # runs are sorted by length
    truth = np.repeat(y, sizes)
    weights, step = np.zeros(WIDTH), np.zeros((2, 2))
    moments = [np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)]
    for turn in range(1, rounds + 1):
        odds = flat @ weights
        up = np.exp(np.clip(odds, -30, 30))
        move = np.exp(step)
        forward = []
        for t, n in enumerate(alive):
            u = up[top[:n] + t]
            a = np.ones((n, 2)) if t == 0 else forward[-1][:n] @ move
            a[:, 1] *= u
            forward.append(a / a.sum(axis=1, keepdims=True))
        good = np.empty(len(flat))
        pairs = np.zeros((2, 2))
        back = np.ones((alive[-1], 2))
        for t in range(len(alive) - 1, -1, -1):
            n = alive[t]
            if len(back) < n:
                back = np.concatenate([back, np.ones((n - len(back), 2))])
            both = forward[t] * back
            good[top[:n] + t] = both[:, 1] / both.sum(axis=1)
            if t:
                u = np.stack([np.ones(n), up[top[:n] + t]], axis=1) * back
                joint = forward[t - 1][:n, :, None] * move * u[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                back = u @ move.T
                back /= back.sum(axis=1, keepdims=True)
        seen = np.zeros((2, 2))
        for label in (0, 1):
            seen[label, label] = (sizes[y == label] - 1).sum()
        n = len(flat)
        slope = np.concatenate([flat.T @ (truth - good) / n - decay * weights, ((seen - pairs) / n - decay * step).ravel()])
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope**2
        change = 0.05 * (moments[0] / (1 - 0.9**turn)) / (np.sqrt(moments[1] / (1 - 0.99**turn)) + 1e-8)
        weights += change[:WIDTH]
        step += change[WIDTH:].reshape(2, 2)
    plain = weights / spread
    plain[-1] -= float(np.dot(plain, mean))
    return Chain(plain, step)


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality") -> Chain:
    """Learn from the bounded sample; its lines' features come to the driver, no texts."""
    chosen = (
        labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col(target).isin(0, 1))
        .select("doc_id", F.col(target).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(SAMPLE_DOCS)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most SAMPLE_DOCS rows

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text, y in zip(batch["doc_id"], batch["text"], batch["y"]):
                x, _ = line_features(text)
                for at in range(0, len(x), RUN):
                    rows.append((doc, at, y, len(x[at : at + RUN]), x[at : at + RUN].tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "at", "y", "n", "x"])

    runs = texts.mapInPandas(features, "doc_id bigint, at int, y int, n int, x binary")
    order = F.xxhash64("doc_id", "at")
    bounded = runs.orderBy(order, "doc_id", "at", "y").limit(SAMPLE_LINES)
    x, y, lines = [], [], 0
    for row in bounded.toLocalIterator():
        if lines + row["n"] > SAMPLE_LINES:
            break
        lines += row["n"]
        x.append(np.frombuffer(row["x"], dtype=np.float32).reshape(-1, WIDTH))
        y.append(row["y"])
    return learn(x, y)


def scores(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``score``."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([chain.score(t) for t in texts], dtype="float64")

    return docs.withColumn("score", score(F.col(text)))
