"""Token ids of whole texts by a public tokenizer, as little-endian unsigned 32-bit bytes.

Both vocabularies used here cut a text into units (letters, digits, marks, white space) that never
merge with each other. Texts of ASCII and Latin letters are cut the same way here, so their ids are those of
their units in a row, and units that have been seen are looked up instead of encoded again. In other
texts this holds for the words that are plain; the rest goes to the tokenizer word by word, since nothing
merges across the start of a word either: white space is dropped or opens the following word. Texts for
which that does not hold go to the tokenizer whole. Strings of special tokens count as ordinary text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

#: units remembered by one worker, about 170 bytes each, and characters of them: 16 times as many; then it starts anew,
#: with those of before at hand for units that come again
REMEMBERED = 400_000
#: characters of the texts that are encoded together, about
_GROUP = 1 << 16
#: characters that Python counts as white space and the tokenizers do not
_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: letters of one code point in every normal form used here, whose lower case is among them
_L = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_ODD = re.compile(f"[^\x00-\x1b\x20-\x7f{_L}]")
_SHORT = "'(?:s|t|re|ve|m|ll|d)"
#: white space has no ids; digits stand alone
_DROPPED = re.compile(rf"[{_L}]+|[0-9]|{_SHORT}|[^\s0-9{_L}]+")
#: a space opens the unit behind it
_OPENS = re.compile(rf" ?[{_L}]+| ?[0-9]+|{_SHORT}| ?[^\s0-9{_L}]+|\s+(?!\S)|\s+")
#: a space between white space, or between white space and the end: its run is one unit
_RUNS = re.compile(r"\s (?=\s|$)|^ (?=\s|$)")


def _byte_chars() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself where it is visible."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in seen else chr(next(others)) for b in range(256)]


#: written between units, as no unit has the character; it becomes the space that the units are split at
_BETWEEN = "\x1c"
_BYTE_CHARS = dict(enumerate(_byte_chars())) | {ord(_BETWEEN): " "}


class WordTokenizer:
    """``kind`` "dropped": white space separates words and has no ids. "opens": a space belongs to
    the word that follows."""

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        # the merges alone, for units that are cut and written as byte characters already
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        # bytes that each id stands for
        end = self.whole.model.end_of_word_suffix or ""
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        self.lengths = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.lengths[i] = len(token.removesuffix(end))
        self.opens = kind == "opens"
        self.cut = (_OPENS if self.opens else _DROPPED).findall
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}
        self.chars = 0

    def _encode(self, text: str, coder=None) -> np.ndarray:
        return np.array((coder or self.whole).encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, units: set[str]) -> None:
        """Encode what is new among the units, in one call."""
        new = list(units.difference(self.known))
        self.chars += sum(map(len, new))
        if self.before:
            found = list(map(self.before.get, new))
            self.known.update((u, ids) for u, ids in zip(new, found) if ids is not None)
            new = [u for u, ids in zip(new, found) if ids is None]
        if new:
            self.known.update(zip(new, self._merged(new)))

    def _merged(self, units: list[str]) -> list[bytes]:
        """The ids of each unit; told apart by the bytes they stand for."""
        text = _BETWEEN.join(units).encode()
        ids = self._encode(text.decode("latin-1").translate(_BYTE_CHARS), self.merges)
        between = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == ord(_BETWEEN))
        ends = np.append(between, len(text)) - np.arange(len(units))
        reached = np.cumsum(self.lengths[ids])
        cuts = np.searchsorted(reached, ends) + 1
        if reached[-1] != ends[-1] or not np.array_equal(reached[cuts - 1], ends):  # an id that stands for other bytes than it says
            return [self._encode(u.encode().decode("latin-1").translate(_BYTE_CHARS), self.merges).tobytes() for u in units]
        data, at = ids.tobytes(), (4 * cuts).tolist()
        return [data[i:j] for i, j in zip([0, *at], at)]

    def _units(self, text: str) -> list[str]:
        return self.cut(text if self.opens else text.lower())

    def _parts(self, text: str) -> list[str] | None:
        if _ODD_SPACE.search(text):
            return None
        if not self.opens:
            return text.split()
        if _RUNS.search(text):
            return None
        first, *rest = text.split(" ")
        return [*([first] if first else []), *[" " + w for w in rest]]

    def _mixed(self, text: str) -> bytes:
        """A text that is not plain: its plain words unit by unit, the others as they are."""
        parts = self._parts(text)
        if parts is None:
            return self._encode(text).tobytes()
        plain = {}
        for part in set(parts):
            if not _ODD.search(part):
                plain[part] = self._units(part)
            elif part not in self.odd:
                self.odd[part] = self._encode(part).tobytes()
                self.chars += 10 * len(part)
        self._learn(set().union(*plain.values()))
        known = self.known.__getitem__
        return b"".join(b"".join(map(known, plain[p])) if p in plain else self.odd[p] for p in parts)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text; a null text has none. Texts are taken in small groups."""
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size > _GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.known) > REMEMBERED or self.chars > 16 * REMEMBERED:
            self.before, self.known = self.known, {}
            self.odd.clear()
            self.chars = 0
        cut = [None if _ODD.search(t) else self._units(t) for t in texts]
        found = [list(map(self.known.get, units or ())) for units in cut]
        gaps = [[i for i, ids in enumerate(row) if ids is None] for row in found]
        self._learn({units[i] for units, row in zip(cut, gaps) for i in row})
        for text, units, row, missing in zip(texts, cut, found, gaps):
            for i in missing:
                row[i] = self.known[units[i]]
            yield self._mixed(text) if units is None else b"".join(row)


_loaded: dict[tuple[str, str], WordTokenizer] = {}


def tokenizer(path: str, kind: str) -> WordTokenizer:
    """One per worker process."""
    if (path, kind) not in _loaded:
        _loaded[path, kind] = WordTokenizer(path, kind)
    return _loaded[path, kind]
