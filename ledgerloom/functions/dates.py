"""Date text to dates, with strptime-style formats."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Strptime directives and the matching Spark pattern letters (reading, writing).
READ = {"d": "d", "m": "M", "Y": "yyyy", "y": "yy", "b": "MMM", "B": "MMMM", "H": "H", "M": "m", "S": "s", "f": "SSSSSS"}
WRITE = {**READ, "d": "dd", "m": "MM", "H": "HH", "M": "mm", "S": "ss"}

# what each directive may look like; checked before parsing, since a failed parse is costly
SHAPE = {"d": r"\d{1,2}", "m": r"\d{1,2}", "Y": r"\d{4}", "y": r"\d{2}", "b": "[A-Za-z]{3}", "B": "[A-Za-z]+",
         "H": r"\d{1,2}", "M": r"\d{1,2}", "S": r"\d{1,2}", "f": r"\d{1,6}"}

# A two-digit year above 68 belongs to the previous century.
LAST_SHORT_YEAR = 2068


def spark_pattern(strptime: str, directives: dict[str, str]) -> str:
    out, chars = [], iter(strptime)
    for ch in chars:
        if ch == "%":
            out.append(directives[next(chars)])
        elif ch.isalpha():
            out.append(f"'{ch}'")
        else:
            out.append(ch)
    return "".join(out)


def shape_of(strptime: str) -> str:
    out, chars = [], iter(strptime)
    for ch in chars:
        out.append(SHAPE[next(chars)] if ch == "%" else re.escape(ch))
    return "^" + "".join(out) + "$"


def as_iso(strptime: str) -> tuple[str, str] | None:
    """Pattern and replacement that turn text of a format of day, month and year in numbers into an ISO day."""
    found = re.findall("%(.)", strptime)
    if sorted(found) not in (["Y", "d", "m"], ["d", "m", "y"]):
        return None
    shape, chars = "", iter(strptime)
    for ch in chars:
        shape += f"({SHAPE[next(chars)]})" if ch == "%" else re.escape(ch)
    at = {d: f"${i}" for i, d in enumerate(found, 1)}
    return rf"^{shape}\z", f"{at.get('Y') or '20' + at['y']}-{at['m']}-{at['d']}"


def parse_with(c: Column, strptime: str) -> Column:
    """Formats of numbers alone are turned into ISO days, whose cast costs a small part of a formatter's parse."""
    if iso := as_iso(strptime):
        parsed = F.when(c.rlike(iso[0]), F.regexp_replace(c, *iso).try_cast("date"))
    else:
        parsed = F.when(c.rlike(shape_of(strptime)), F.try_to_date(c, spark_pattern(strptime, READ)))
    if "%y" in strptime:
        parsed = F.when(F.year(parsed) > LAST_SHORT_YEAR, F.add_months(parsed, -1200)).otherwise(parsed)
    return parsed


def parse_iso(c: Column) -> Column:
    """``2020-1-5``, or the same followed by a time of day."""
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), c.try_cast("date")).when(
        c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d"), c.try_cast("date"))


# Names of months; their first three letters are names too.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
# every notation has a number, which words between dashes lack
DATE_SHAPE = r"(?i)^(?=[^0-9]*[0-9])\s*[a-z0-9]+([\s,/.\-]+[a-z0-9]+){2}([ t]+\d{1,2}:\d{2}(:\d{2}([.]\d+)?)?( ?[ap]m)?)?\s*$"


def month_number(word: Column) -> Column:
    names = {n: i for i, name in enumerate(MONTHS, 1) for n in (name, name[:3])} | {"sept": 9}
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.try_element_at(table, word)


def read_parts(parts: Column) -> Column:
    """A date from three lower-case parts, whose order follows from what they are.

    A year of four digits in front is followed by month and day; a month's name may stand first or second, the
    year last. Of two numbers before the year one must be above 12, which makes it the day; where both
    could be the month, only a given format can tell, and there is no date.
    """
    a, b, c = (F.get(parts, F.lit(i)) for i in range(3))
    x, y = (F.when(p.rlike(r"^\d{1,2}$"), p.try_cast("int")) for p in (a, b))
    z = F.when(c.rlike(r"^(\d{2}|\d{4})$"), c.try_cast("int"))
    year = F.when(F.length(c) == 4, z).otherwise(z + F.when(z > LAST_SHORT_YEAR % 100, 1900).otherwise(2000))

    def day(y: Column, m: Column, d: Column) -> Column:
        return F.try_to_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), m, d), "yyyy-M-d")

    known = lambda *cs: F.array_size(F.array_compact(F.array(*cs))) == len(cs)
    in_front = F.coalesce(month_number(b), y)
    last = F.when(c.rlike(r"^\d{1,2}$"), c.try_cast("int"))
    return (
        F.when(a.rlike(r"^\d{4}$"), F.when(known(in_front, last), day(a.try_cast("int"), in_front, last)))
        .when(known(month_number(a), y, year), day(year, month_number(a), y))
        .when(known(x, month_number(b), year), day(year, month_number(b), x))
        .when(known(x, y, year) & (x > 12) & (y <= 12), day(year, y, x))
        .when(known(x, y, year) & (y > 12) & (x <= 12), day(year, x, y))
        .when(known(x, y, year) & (x == y), day(year, x, y))
    )


def parse_general(c: Column) -> Column:
    """Dates in the usual notations: ``2021/03/04``, ``Jan 5, 2021``, ``5th January 2021``, ``13.2.99``, ``20210304``; a time behind is cut off."""
    text = F.lower(F.trim(c))
    text = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    text = F.regexp_replace(F.regexp_replace(text, r"[ t]+\d{1,2}:.*$", ""), r"(\d)(st|nd|rd|th)\b", "$1")
    # an array of one, so that the parts are split once and named
    dates = F.transform(F.array(F.split(text, r"[\s,/.\-]+")), read_parts)
    return F.when(c.rlike(DATE_SHAPE) | c.rlike(r"^\s*\d{8}\s*$"), F.get(dates, F.lit(0)))


def parse_date(c: Column, formats: Sequence[str] = (), iso_first: bool = True) -> Column:
    """First reading that works: ISO and the formats in their order, or the formats and then ISO; last any usual notation."""
    tries = [parse_with(c, f) for f in formats]
    tries = [parse_iso(c), *tries] if iso_first else [*tries, parse_iso(c)]
    return F.coalesce(*tries, parse_general(c))


def render(c: Column, strptime: str) -> Column:
    return F.date_format(c, spark_pattern(strptime, WRITE))


def date_key(c: Column) -> Column:
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def key_of(iso_day: str) -> int:
    return int(str(iso_day).replace("-", ""))
