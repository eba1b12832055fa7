"""Periodic runs of words, by online dynamic programming on sparse diagonals.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends and that is
``max(LEAST, 3 * q)`` words or longer. Two equal words ``q`` apart are a match on the diagonal of lag
``q``; a run is a diagonal that matches without a gap for ``length - q`` words.

Taking every earlier occurrence of every word would visit the square of a frequent word's count. So
a word counts as occurring earlier only where the ``k`` words that start with it do, and only the nearest
such place counts. That loses nothing for lags from ``k / 2`` to ``k``: a run of smallest period ``q``
matches on its diagonal for ``2 * q`` words or more, so its words from the second period on, but for
the last ``k - 1``, all have such an occurrence at lag ``q``; a nearer one would give ``q <= k`` words
at two places less than ``q`` apart, which a smallest period rules out. Lengths of ``k`` double from
``GRAM``, so a text is passed over once per doubling of the periods in it; a text without any
repeated stretch of ``GRAM`` words is done after one pass. In a pass an occurrence adds one to the match length
of its lag, or starts it; a lag that gets no match at a word has ended, and is emitted if long enough.

Hashes of stretches propose; every run is compared word by word before it counts.

Defined results: a null text has no words; empty and white texts neither. Null ids are allowed (``rebuilt`` leaves
such rows as they are). Repeated rows get a row each. Other columns are ignored, whatever their names.
Texts are taken one at a time, whatever their length, and rows never meet: nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import mix, run_hashes

LEAST = 24
TIMES = 3
#: the shortest match of a run on its diagonal: ``LEAST - q`` words up to 8, ``2 * q`` above
GRAM = 16
#: rows that a worker takes at once
ROWS = 64

_PAIR = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


def text_words(text: str | None) -> list[bytes]:
    """What stands between white space (ASCII: space and 09 to 0D), as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def diagonals(grams: np.ndarray, k: int, least: int, most: int) -> Iterator[tuple[int, int, int]]:
    """Matching stretches ``lag, first word, end`` between the grams of ``k`` words, for lags in the bounds.

    Every gram adds to the diagonal of its nearest earlier occurrence.
    """
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    word, lag = order[same + 1], order[same + 1] - order[same]
    inside = (lag >= least) & (lag <= most)
    word, lag = word[inside], lag[inside]
    if not len(word):
        return
    order = np.lexsort((word, lag))
    word, lag = word[order], lag[order]
    # a diagonal goes on where the next word of its lag is the next word of the text
    ends = np.flatnonzero((np.diff(word) != 1) | (np.diff(lag) != 0))
    first = np.concatenate(([0], ends + 1))
    last = np.concatenate((ends, [len(word) - 1]))
    yield from zip(lag[first].tolist(), word[first].tolist(), (word[last] + k).tolist())


def runs(words: list[bytes]) -> list[Run]:
    """All runs of a text as ``start, length, period``, by start and then period."""
    n = len(words)
    if n < LEAST:
        return []
    found = _runs(np.fromiter(map(hash, words), np.int64, n).view(np.uint64), n)
    if all(words[s + q : s + size] == words[s : s + size - q] for s, size, q in found):
        return found
    # two words share a hash: number them instead
    known: dict[bytes, int] = {}
    numbers = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    return _runs(numbers.view(np.uint64), n, numbers)


def _runs(hashes: np.ndarray, n: int, numbers: np.ndarray | None = None) -> list[Run]:
    found: list[Run] = []
    k, grams = GRAM, run_hashes(mix(hashes), GRAM)
    while True:
        for q, at, end in diagonals(grams, k, k // 2 + 1 if k > GRAM else 1, min(k, n // TIMES)):
            start = at - q
            if end - start >= max(LEAST, TIMES * q):
                if numbers is None or np.array_equal(numbers[at:end], numbers[start : end - q]):
                    found.append((start, end - start, q))
        # longer periods need longer grams, twice as long each time
        if n // TIMES <= k or n < 2 * k or not _repeats(grams):
            return sorted(found, key=lambda run: (run[0], run[2]))
        grams = mix(grams[:-k] * _PAIR + grams[k:])
        k *= 2


def _repeats(grams: np.ndarray) -> bool:
    ranked = np.sort(grams)
    return bool((ranked[1:] == ranked[:-1]).any())


def longest(found: list[Run]) -> Run | None:
    """The run with the most repetitions, by exact fractions; of equals the first, then the shortest period."""
    best = None
    for run in found:  # by start and period, so only a greater one replaces it
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words without those that a run repeats after its first period."""
    if not found:
        return words
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for start, size, q in found:
        dropped[start + q] += 1
        dropped[start + size] -= 1
    return [w for w, d in zip(words, np.cumsum(dropped)[:-1].tolist()) if not d]


def rebuilt(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents made periodic from a word on, as the query's input is defined."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * -(-(n - a) // p))[: n - a]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=None) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs`` (array of start, length, period), ``best`` (the run with the
    most repetitions, null without runs) and ``collapsed`` (the text without repetitions, words joined by a space).

    ``change(doc_id, words)`` gives the words to look at in place of the text's own.
    """
    span = "struct<start:bigint,length:bigint,period:bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids, sizes, all_runs, best, kept = batch.column("id").to_pylist(), [], [], [], []
                for doc, text in zip(ids, batch.column("body")):
                    words = text_words(text.as_py())
                    words = words if change is None else change(doc, words)
                    found = runs(words)
                    sizes.append(len(words))
                    all_runs.append([_named(r) for r in found])
                    best.append(_named(longest(found)))
                    kept.append(b" ".join(collapsed(words, found)).decode("utf-8", "surrogatepass"))
                kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("id"),
                    "n_words": pa.array(sizes, pa.int64()),
                    "runs": pa.array(all_runs, pa.list_(kind)),
                    "best": pa.array(best, kind),
                    "collapsed": pa.array(kept, pa.string()),
                })

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    return rows.mapInArrow(
        run, f"doc_id bigint, n_words bigint, runs array<{span}>, best {span}, collapsed string"
    )


def _named(run: Run | None) -> dict[str, int] | None:
    return run and {"start": run[0], "length": run[1], "period": run[2]}


def run_lines(found: Column) -> Column:
    """``start,length,period`` and a line feed for every run, as a column expression."""
    lines = F.transform(found, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return F.when(F.size(found) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
