"""Text expressions that follow Python's idea of white space."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Tokens a CSV scan reads as null.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# (?U) makes \s Unicode-aware; Python also counts the four separators 1c-1f.
SPACE = r"[\s\x1c-\x1f]"
# The same characters one by one, for functions that take no pattern.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                           0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U){SPACE}+", " ")


def null_tokens(c: Column) -> Column:
    return F.when(~c.isin(NULL_TOKENS), c)


def lookup(c: Column, table: dict[str, str]) -> Column:
    """``table[c]`` where present, else ``c``."""
    if not table:
        return c
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, c), c)
