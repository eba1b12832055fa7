"""City spelling: exact names as column expressions, close spellings in a small Arrow function."""

from __future__ import annotations

import difflib
import string
import unicodedata
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, functions as F

ASCII_SPACE = r"[\t-\r\x1c-\x20]+"


def _plain_letters() -> dict[int, str]:
    """The ASCII letter of every Latin letter that is one with marks."""
    parts = {code: unicodedata.normalize("NFKD", chr(code)) for code in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00))}
    return {code: p[0] for code, p in parts.items() if p[0].isascii() and not any(c.isascii() for c in p[1:])}


PLAIN_LETTERS = _plain_letters()


def city_form(c: Column) -> Column:
    """The form in which spellings are compared: unaccented ASCII letters, single spaces, a capital at the start of each word."""
    codes = sorted(PLAIN_LETTERS)
    plain = F.translate(c, "".join(map(chr, codes)), "".join(PLAIN_LETTERS[k] for k in codes))
    return F.initcap(F.trim(F.regexp_replace(F.regexp_replace(plain, r"[^\x00-\x7f]", ""), ASCII_SPACE, " ")))


def name_form(name: str) -> str:
    """``city_form`` of a canonical name, which the driver needs."""
    return string.capwords("".join(c for c in name.translate(PLAIN_LETTERS) if c.isascii()))


class Spellings:
    """Canonical names, and the one that a spelling, given in its ``city_form``, is closest to."""

    def __init__(self, canonical: Sequence[str], cutoff: float):
        self.cutoff = cutoff
        self.by_form = {name_form(name): name for name in canonical}

    def closest(self, own: str) -> str | None:
        """The name with the most in common, ``cutoff`` or more; of equals the last in the alphabet."""
        best = (self.cutoff, "")
        scorer = difflib.SequenceMatcher(b=own)
        for form in self.by_form:
            scorer.set_seq1(form)
            # two cheap bounds first: they leave out most names
            if scorer.real_quick_ratio() >= best[0] and scorer.quick_ratio() >= best[0]:
                best = max(best, (scorer.ratio(), form))
        return self.by_form.get(best[1])


def exact_city(c: Column, canonical: Sequence[str], mappings: dict[str, str]) -> Column:
    """Listed spelling, or an ASCII value that equals a canonical name but for case and spaces."""
    out = F.when(c.isin(list(mappings)), F.try_element_at(literal_map(mappings), c)) if mappings else F.lit(None).cast("string")
    names = {name_form(name).lower(): name for name in canonical}
    if not names:
        return out
    tidy = F.lower(F.trim(F.regexp_replace(c, ASCII_SPACE, " ")))
    return F.coalesce(out, F.when(c.rlike(r"^[\x00-\x7f]*$"), F.try_element_at(literal_map(names), tidy)))


def literal_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def close_city(canonical: Sequence[str], cutoff: float):
    """Arrow function: closest canonical name to a ``city_form`` by difflib's ratio, null below the cutoff.

    Callers pass null for values that the exact rules already resolve. Each distinct
    spelling is looked up once per task; no shuffle and no join is needed.
    """
    names = Spellings(canonical, cutoff)

    @F.pandas_udf("string")
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, str | None] = {}
        for batch in batches:
            known.update({raw: names.closest(raw) for raw in set(batch.dropna()).difference(known)})
            yield pd.Series([known.get(raw) for raw in batch], index=batch.index, dtype=object)

    return match
