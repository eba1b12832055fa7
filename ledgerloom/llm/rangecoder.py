"""An adaptive context-mixing range coder for token ids, over many blocks side by side.

Blocks are independent: each starts from the same empty model, so any of them can be decoded
alone. Many blocks are worked on in step, one array element per block (a lane), which is what
makes an adaptive coder usable from array operations. All arithmetic is on integers, so that
every machine decodes what another has written.

Per id, with the two ids before it as contexts:

* order 2 and order 1 each predict one id, the last that followed their context, with a
  confidence and adaptive probabilities per confidence. The id of order 2 has what these give when mixed in the
  logistic domain by weights that are learned per block (order 1 joins in if it predicts the same), the id of
  order 1, if another, its own probability of the remainder,
* what these leave of the range is dealt by order-0 shares: those given for all blocks, or else the same for every id.

An id takes one step of the coder, whichever of the three it comes from. A step divides the range, of up to 62
bits, by 2**24; 32 bits are moved when 30 are left, once a step at most. ``low`` has a bit more for a carry, which
is added to the words before when all are written.
"""

from __future__ import annotations

import numpy as np

#: ids in a block
BLOCK = 2048
_SLOT_BITS = 8
_SLOTS = 1 << _SLOT_BITS
_LEVELS = 8
#: order-0 shares are of 65536, those of a step of 2**24
_SHARE = 1 << 16
_WHOLE = 1 << 24
#: bits of ``low`` and of the range: a word's, and those below it
_WORD, _LEFT = np.uint64(32), np.uint64(30)
_LOW32, _BELOW = np.uint64((1 << 32) - 1), np.uint64((1 << 30) - 1)
_SMALL = np.uint64(1 << 30)
_RANGE = (1 << 62) - 1
#: odds and weights learn from that many ids at a block's start, and from every fourth one of the rest
_EAGER = 128


def _logistic() -> tuple[np.ndarray, np.ndarray]:
    """Tables of squash (from -32768..32767, negative ones at the end, to 0..4095) and its inverse, by whole numbers alone."""
    # fixed values: 4096 / (1 + exp(-x / 256)) for x = -2048, -1920 ... 2048, rounded, at most 4095
    knots = [1, 2, 4, 6, 10, 17, 27, 45, 74, 120, 194, 311, 488, 747, 1102, 1546, 2048, 2550, 2994, 3349, 3608, 3785,
             3902, 3976, 4022, 4051, 4069, 4079, 4086, 4090, 4092, 4094, 4095]
    x = np.arange(4096, dtype=np.int64)
    low, part = np.array(knots, dtype=np.int64)[x >> 7], x & 127
    high = np.array([*knots, knots[-1]], dtype=np.int64)[(x >> 7) + 1]
    squash = ((low * (128 - part) + high * part + 64) >> 7).astype(np.int32)
    stretch = (np.searchsorted(squash, np.arange(4096)).clip(0, 4095) - 2048).astype(np.int32)
    sums = np.arange(1 << 16).astype(np.uint16).view(np.int16).astype(np.int64)
    return squash[(sums + 2048).clip(0, 4095)], stretch


_SQUASH, _STRETCH = _logistic()
#: hashes of contexts by order 2 and 1: their upper bits
_HASHES = np.array([[2_654_435_769], [2_246_822_519]], dtype=np.uint32)
_HASH_BEFORE = np.uint32(3_266_489_917)


class _Coder:
    """Encoder of one stream per lane, or the decoder of such streams."""

    def __init__(self, lanes: int, words: np.ndarray | None = None, at: np.ndarray | None = None):
        self.range = np.full(lanes, _RANGE, dtype=np.uint64)
        self.decodes = words is not None
        if self.decodes:  # every 32 bits that follow the first 62, 94 ... of a stream
            self.code = words[at].astype(np.uint64) << _LEFT | words[at + 1] >> np.uint32(2)
            self.words = words[:-1] << np.uint32(30) | words[1:] >> np.uint32(2)
            self.at = at + 1
        else:
            self.low = np.zeros(lanes, dtype=np.uint64)
            #: lanes, and the word that each of them gets, with the carry above it
            self.moved: list[tuple[np.ndarray, np.ndarray]] = []

    def targets(self, lanes: slice) -> np.ndarray:
        """Where in 0..2**24 - 1 the next id of each lane lies."""
        return (self.code[lanes] // (self.range[lanes] >> np.uint64(24))).astype(np.int32)

    def step(self, lanes: slice, start: np.ndarray, size: np.ndarray) -> None:
        """Narrow each lane to ``start .. start + size`` of 2**24. ``lanes``: the first ones."""
        span = self.range[lanes]
        span >>= np.uint64(24)
        if self.decodes:
            self.code[lanes] -= span * start.astype(np.uint64)
        else:
            self.low[lanes] += span * start.astype(np.uint64)
        span *= size.astype(np.uint64)
        need = (span < _SMALL).nonzero()[0]
        span[need] = span.take(need) << _WORD
        if self.decodes:
            at = self.at.take(need)
            self.code[need] = self.code.take(need) << _WORD | self.words.take(at, mode="clip")
            at += 1
            self.at[need] = at
        else:
            low = self.low.take(need)
            self.moved.append((need.astype(np.int32), low >> _LEFT))
            low &= _BELOW
            low <<= _WORD
            self.low[need] = low

    def finish(self) -> list[bytes]:
        """The words of each lane, with those of ``low`` as they are: a value within the lane's range."""
        every = np.arange(len(self.low), dtype=np.int32)
        self.moved += [(every, self.low >> _LEFT), (every, (self.low & _BELOW) << np.uint64(2))]
        lanes, words = (np.concatenate(column) for column in zip(*self.moved))
        self.moved.clear()
        words = words[np.argsort(lanes, kind="stable")]
        carried = (words >> _WORD).nonzero()[0]
        words &= _LOW32
        while len(carried):  # never from a lane's first word
            words[carried - 1] += np.uint64(1)
            carried = carried[words[carried - 1] > _LOW32] - 1
            words[carried] = 0
        ends = np.cumsum(np.bincount(lanes, minlength=len(every))).tolist()
        data = words.astype("<u4").tobytes()
        return [data[4 * i : 4 * j] for i, j in zip([0, *ends], ends)]


class Shares:
    """Order-0 shares of all ids: ``sizes`` of 65536 by id, 0 for ids that do not occur."""

    def __init__(self, sizes: np.ndarray):
        if len(sizes) != _SHARE or int(sizes.sum()) != _SHARE:
            raise ValueError("shares do not add up")
        self.sizes = sizes.astype(np.uint32)
        self.widths = self.sizes.astype(np.int32)
        self.starts = np.cumsum(self.widths, dtype=np.int32) - self.widths
        self.id_at = np.repeat(np.arange(_SHARE, dtype=np.int32), self.sizes)

    @classmethod
    def counted(cls, blocks: list[np.ndarray]) -> Shares:
        """By how often ids are in the blocks; each that is there has a share."""
        counts = np.zeros(_SHARE, dtype=np.int64)
        for i in range(0, len(blocks), 128):
            counts += np.bincount(np.concatenate(blocks[i : i + 128]), minlength=_SHARE)
        if not counts.any():
            return FLAT
        there = counts > 0
        sizes = there + counts * (_SHARE - int(there.sum())) // int(counts.sum())
        sizes[counts.argmax()] += _SHARE - int(sizes.sum())
        return cls(sizes)


FLAT = Shares(np.ones(_SHARE, dtype=np.uint32))


class _Model:
    """Of order 2 and order 1, in the rows of each array."""

    def __init__(self, lanes: int):
        #: by context: 8 times (id + 1) and how often in a row it followed, 1 to 7, or 0
        self.seen = np.zeros(2 * lanes * _SLOTS, dtype=np.int32)
        self.odds = np.full(2 * lanes * _LEVELS, 400, dtype=np.int32)
        self.weights = np.repeat(np.array([[40_000], [20_000]], dtype=np.int32), lanes, axis=1)


def _run(coder: _Coder, sizes: np.ndarray, ids: np.ndarray, shares: Shares) -> None:
    """Code all lanes; ``sizes`` must not increase. ``ids`` (step x lane) is read when encoding, filled when decoding."""
    model = _Model(len(sizes))
    longest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right").tolist()
    every = np.arange(2 * len(sizes)).reshape(2, -1)
    came, before = np.zeros((2, len(sizes)), dtype=np.uint32)  # the id before, + 1, and a hash of the one before it
    n = -1
    for t in range(longest):
        if n != alive[t]:
            n = alive[t]
            lanes, slot, level, came, before = slice(0, n), every[:, :n] * _SLOTS, every[:, :n] * _LEVELS, came[:n], before[:n]
            weights = model.weights[:, :n]
        hashes = _HASHES * came
        hashes[0] += before
        before = came * _HASH_BEFORE
        hashes >>= np.uint32(32 - _SLOT_BITS)
        slots = hashes.astype(np.int64)
        slots += slot
        seen = model.seen.take(slots)
        guess = seen >> 3
        same = (guess[0] == guess[1]).astype(np.int32)
        sure = seen & 7
        at = sure.astype(np.int64)
        at += level
        chance = model.odds.take(at)
        pull = _STRETCH.take(chance)
        pull[1] *= same
        total = pull * weights
        p = _SQUASH.take(total[0] + total[1] >> 16)
        size0 = p * 3840  # at most 15,724,800: room for the others
        size1 = (16_640_000 - size0 >> 12) * ((chance[1] | 1) & same - 1)
        both = size0 + size1
        rest = _WHOLE - both >> 16
        if coder.decodes:
            target = coder.targets(lanes)
            now = shares.id_at.take((target - both) // rest, mode="clip")
            told = (target < both).nonzero()[0]
            now[told] = np.where(target.take(told) < size0.take(told), guess[0].take(told), guess[1].take(told)) - 1
            ids[t, :n] = now
        else:
            now = ids[t, :n].astype(np.int32)
        start = shares.starts.take(now, mode="clip")
        start *= rest
        start += both
        size = shares.widths.take(now, mode="clip")
        size *= rest
        now += 1
        came = now.view(np.uint32)
        right = guess == now
        told = (right[0] | right[1]).nonzero()[0]
        first, share = right[0].take(told), size0.take(told)
        start[told] = np.where(first, 0, share)
        size[told] = np.where(first, share, size1.take(told))
        coder.step(lanes, start, size)
        if t < _EAGER or t & 3 == 0:
            full = right * np.int32(4095)
            pull *= full[0] - p
            pull >>= 8
            weights += pull
            np.clip(weights, -250_000, 250_000, out=weights)
            full -= chance
            full >>= 5
            full += chance
            model.odds[at.ravel()] = full.ravel()
        sure *= right
        sure += sure < 7
        sure += now << 3
        model.seen[slots.ravel()] = sure.ravel()


def _by_step(sizes: np.ndarray) -> np.ndarray:
    """Room for all lanes' ids, step by step; a step's rows do not begin at the same place of the processor's cache."""
    return np.zeros((int(sizes.max(initial=0)), len(sizes) + 40), dtype=np.uint16)[:, : len(sizes)]


def encode(blocks: list[np.ndarray], shares: Shares = FLAT) -> list[bytes]:
    """Each block of up to 65536 ids of 16 bits as bytes of its own; ``shares`` has a share of each id."""
    sizes = np.array([len(b) for b in blocks], dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    ids = _by_step(sizes)
    for lane, i in enumerate(order):
        ids[: sizes[i], lane] = blocks[i]
    coder = _Coder(len(blocks))
    _run(coder, sizes[order], ids, shares)
    out: list[bytes] = [b""] * len(blocks)
    for i, data in zip(order, coder.finish()):
        out[i] = data
    return out


def decode(payloads: list[bytes], sizes: list[int], shares: Shares = FLAT) -> list[np.ndarray]:
    """The blocks' ids again."""
    lengths = np.array(sizes, dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    at = np.cumsum([0, *(len(p) // 4 for p in payloads)], dtype=np.int64)[:-1]
    words = np.frombuffer(b"".join(payloads) + bytes(16), dtype="<u4").astype(np.uint32)
    ids = _by_step(lengths)
    _run(_Coder(len(sizes), words, at[order]), lengths[order], ids, shares)
    by_lane = np.ascontiguousarray(ids.T)
    out: list[np.ndarray] = [by_lane[:0].ravel()] * len(sizes)
    for lane, i in enumerate(order):
        out[i] = by_lane[lane, : lengths[i]]
    return out
