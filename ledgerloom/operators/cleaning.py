"""The cleaning job: eleven configured steps and their counters.

Each step maps a DataFrame to a DataFrame. Where a step needs a statistic of a whole column
(median, mean, mode) it comes from a small aggregate: one row for one input, or one row per
input file when ``by`` names the file column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from ledgerloom.config import (
    Booleans, Categorical, CleaningConfig, Dates, Dedup, Delivery, Geo, Missing, Outliers, Payment, Price, Ratings,
)
from ledgerloom.functions import dates as fd, parsing
from ledgerloom.functions.cities import city_form, close_city, exact_city
from ledgerloom.functions.numeric import half_even, to_number
from ledgerloom.functions.order_stats import quantiles_of_counts, same_key
from ledgerloom.functions.text import lookup
from ledgerloom.session import cut_lineage

REPORT = ["step", "field", "metric", "value"]


# --- statistics -------------------------------------------------------------

def attach(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the columns of ``stats``: one row in all, or one row per value of ``by``.

    A single row is read once and becomes literals, so later steps do not plan its
    aggregate again. ``by`` is the input file: a row per file, broadcast only where Spark finds
    the table small enough.
    """
    if by:
        return df.join(cut_lineage(stats), list(by), "left")
    row = stats.first()
    return df.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in stats.schema.fields})


def value_counts(df: DataFrame, columns: Sequence[str], kind: str, by: Sequence[str]) -> DataFrame:
    """(by, column, value, n): how often each value occurs in each column, nulls and NaN left out.

    Every column is counted on its own, so ``df`` should be a stored table: each count then reads one
    column of it, and rows are never multiplied. Nulls are told by their count: a filter on the value would be pushed
    below the rules that made it, and work them through once more.
    """
    whole = None
    for c in columns:
        values = df.select(*by, F.col(c).cast(kind).alias("value"))
        known = F.nanvl("value", F.lit(None).cast(kind)) if kind == "double" else F.col("value")
        counts = values.groupBy(*by, "value").agg(F.count(known).alias("n")).filter("n > 0")
        part = counts.select(*by, F.lit(c).alias("column"), "value", "n")
        whole = part if whole is None else whole.unionByName(part)
    return whole


def stored(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``df`` cut to some columns; written once if several counts are to read it."""
    narrow = df.select(*by, *columns)
    return cut_lineage(narrow) if len(columns) > 1 else narrow


def widen(long: DataFrame, value: str, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    return long.groupBy(*by).agg(*[
        F.max(F.when(F.col("column") == c, F.col(value))).alias(f"_stat_{c}") for c in columns])


def column_centres(df: DataFrame, columns: Sequence[str], strategy: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean or median of each column as ``_stat_<column>``."""
    if strategy == "mean":
        return df.groupBy(*by).agg(*[F.avg(F.col(c).cast("double")).alias(f"_stat_{c}") for c in columns])
    counts = value_counts(df, columns, "double", by).withColumnsRenamed({"value": "_v", "n": "_c"})
    found = quantiles_of_counts(counts, [*by, "column"], [0.5], "_q").withColumn("m", F.col("_q")[0])
    return widen(found, "m", columns, by)


def column_modes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value of each column as text, the smallest one on ties."""
    counts = value_counts(df, columns, "string", by)
    # no value is carried along while the largest count is looked for
    most = counts.groupBy(*by, "column").agg(F.max("n").alias("most"))
    best = counts.alias("a").join(most.alias("b"), same_key("a", "b", [*by, "column"]) & (F.col("a.n") == F.col("b.most")))
    best = best.groupBy(*[F.col(f"a.{k}").alias(k) for k in [*by, "column"]]).agg(F.min("a.value").alias("m"))
    return widen(best, "m", columns, by)


# --- steps ------------------------------------------------------------------

def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def imputed_columns(df: DataFrame, cfg: Missing, by: Sequence[str] = ()) -> list[str]:
    wanted = cfg.include or [c for c in df.columns if not c.startswith("_") and c not in by]
    return [c for c in wanted if c in df.columns and c not in cfg.exclude]


def impute_numeric(df: DataFrame, columns: Sequence[str], strategy: str = "median", by: Sequence[str] = ()) -> DataFrame:
    """Nulls and NaN of numeric columns become the mean or median; the columns become doubles."""
    if not columns:
        return df
    df = df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns})
    with_stats = attach(df, column_centres(df, columns, strategy, by), by)
    return with_stats.withColumns({
        c: F.coalesce(F.col(c), F.col(f"_stat_{c}")) for c in columns}).drop(*[f"_stat_{c}" for c in columns])


def impute_mode(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    if not columns:
        return df
    kinds = {c: df.schema[c].dataType for c in columns}
    return fill(attach(df, column_modes(stored(df, columns, by), columns, by), by), kinds)


def fill(df: DataFrame, kinds: dict[str, T.DataType]) -> DataFrame:
    """Nulls of text and other columns by the statistic that stands beside them."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.col(f"_stat_{c}").cast(k)) for c, k in kinds.items()}).drop(*[f"_stat_{c}" for c in kinds])


def impute_missing(df: DataFrame, cfg: Missing, by: Sequence[str] = (), holes: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns by their mean or median, all others by their mode.

    A column's type decides; scans of files settle it per file (``sources.types``). ``holes`` are the columns
    that have nulls at all, where a caller knows them; others are left as they are.
    """
    targets = [c for c in imputed_columns(df, cfg, by) if holes is None or c in holes]
    columns = df.columns
    if holes is None:
        df, holes = copied(df, targets)
        targets = [c for c in targets if c in holes]
    numeric = [c for c in targets if is_numeric(df, c)]
    text = [c for c in targets if c not in numeric]
    filled = impute_numeric(df, numeric, cfg.numeric_strategy, by)
    modes = attach(filled, column_modes(df, text, by), by) if text else filled
    return fill(modes, {c: df.schema[c].dataType for c in text}).select(*columns)


def copied(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` written once, with a row id ``_place``, and those of ``columns`` that hold a null or NaN.

    Everything later reads columns of the copy, so the input, its joins and its parsing are worked through
    once. The nulls are noted while it is written.
    """
    df = df.withColumn("_place", F.monotonically_increasing_id())
    if not columns:
        return cut_lineage(df), []
    seen = Observation()
    missing = {c: F.col(c).isNull() | F.isnan(c) if isinstance(df.schema[c].dataType, T.FractionalType) else F.col(c).isNull() for c in columns}
    observed = df.observe(seen, *[F.max(F.when(m, 1)).alias(f"n{i}") for i, m in enumerate(missing.values())])
    copy = cut_lineage(observed)
    row = seen.get
    return copy, [c for i, c in enumerate(columns) if row.get(f"n{i}")]


class Counted:
    """A frame to which steps are applied, with 0/1 counter columns when a report is wanted."""

    def __init__(self, df: DataFrame, keep: bool):
        self.df, self.keep, self.flags, self.helpers = df, keep, [], 0

    def let(self, c: Column) -> Column:
        """Name an expression, so that it is computed once however often it is used."""
        self.helpers += 1
        name = f"_let_{self.helpers}"
        self.df = self.df.withColumn(name, c)
        return F.col(name)

    def change(self, new: dict[str, Column], *counters: tuple[str, str, str, Column]) -> None:
        """Set columns; each counter (step, field, metric, condition) is taken before the change."""
        added = {}
        for step, field, metric, condition in counters if self.keep else ():
            name = f"_flag_{len(self.flags)}"
            self.flags.append((step, field, metric, name))
            added[name] = F.when(condition, 1).otherwise(0)
        self.df = self.df.withColumns({**added, **new}).drop(*[c for c in self.df.columns if c.startswith("_let_")])

    def flag_names(self) -> list[str]:
        return [name for *_, name in self.flags]

    def items(self) -> list[tuple[str, str, str, Column]]:
        return [(s, f, m, F.coalesce(F.sum(name), F.lit(0))) for s, f, m, name in self.flags]

    def clean(self) -> DataFrame:
        return self.df.drop(*self.flag_names())


def dates_step(t: Counted, cfg: Dates) -> None:
    for f in [f for f in cfg.fields if f in t.df.columns]:
        text = F.col(f).cast("string")
        parsed = t.let(fd.parse_date(text, cfg.input_formats))
        shown = fd.render(parsed, cfg.target_format)
        t.change({f: shown if cfg.invalid_to_null else F.coalesce(shown, text)},
                 ("dates", f, "converted", parsed.isNotNull() & (F.length(text) > 0)))


def prices_step(t: Counted, cfg: Price) -> None:
    """Unreadable prices become null; unless they are to be dropped, the text stays in ``<field>_raw``."""
    for f in [f for f in cfg.fields if f in t.df.columns]:
        parsed = t.let(parsing.price_value(t.let(parsing.price_text(F.col(f)))))
        new = {f: half_even(parsed, cfg.decimal_places)}
        if not cfg.coerce_invalid_to_null:
            new = {f"{f}_raw": F.when(parsed.isNull(), F.col(f).cast("string")), **new}
        t.change(new, ("price", f, "standardized", parsed.isNotNull()))


def ratings_step(t: Counted, cfg: Ratings, by: Sequence[str]) -> None:
    """Ratings on the scale, unreadable ones by a statistic of those that were read."""
    parse_ratings(t, cfg)
    t.df = fill_ratings(t.df, cfg, by)


def parse_ratings(t: Counted, cfg: Ratings) -> None:
    f = cfg.column
    if not f or f not in t.df.columns:
        return
    parsed = parsing.within_scale(t.let(parsing.rating_value(t.let(parsing.plain_text(F.col(f))))))
    t.change({f: parsed}, ("ratings", f, "changed", parsed.isNotNull()), ("ratings", f, "imputed", F.col(f).isNull()))


def fill_ratings(df: DataFrame, cfg: Ratings, by: Sequence[str]) -> DataFrame:
    f = cfg.column
    if not f or f not in df.columns:
        return df
    if isinstance(cfg.impute_strategy, (int, float)):
        filled, value = df, F.lit(float(cfg.impute_strategy))
    else:
        filled = attach(df, column_centres(df, [f], cfg.impute_strategy, by), by)
        value = F.col(f"_stat_{f}")
    return filled.withColumn(f, half_even(F.coalesce(F.col(f), value), cfg.decimal_places)).drop(f"_stat_{f}")


def categories_step(t: Counted, cfg: Categorical) -> None:
    for f in [f for f in cfg.fields if f in t.df.columns]:
        text = t.let(parsing.category_text(F.col(f), cfg.lowercase, cfg.strip, cfg.collapse_spaces, cfg.replace_ampersand))
        new = lookup(text, cfg.mappings.get(f, {}))
        t.change({f: new}, ("categorical", f, "standardized", ~new.eqNullSafe(F.col(f).cast("string"))))


def cities_step(t: Counted, cfg: Geo) -> None:
    f = cfg.city_field
    if f and f in t.df.columns:
        exact = t.let(exact_city(F.col(f), cfg.canonical_cities, cfg.city_mappings))
        found = exact
        if cfg.canonical_cities:
            near = close_city(cfg.canonical_cities, cfg.fuzzy_threshold)(F.when(exact.isNull(), city_form(F.col(f))))
            found = t.let(F.coalesce(exact, t.let(near)))
        t.change({f: F.coalesce(found, F.col(f))}, ("geo", f, "resolved", found.isNotNull()))


def booleans_step(t: Counted, cfg: Booleans) -> None:
    for f in [f for f in cfg.fields if f in t.df.columns]:
        if isinstance(t.df.schema[f].dataType, T.BooleanType):
            t.change({}, ("booleans", f, "standardized", F.lit(False)))
        else:
            lower = t.let(parsing.lower_text(F.col(f)))
            t.change({f: parsing.boolean_of(lower)}, ("booleans", f, "standardized", F.col(f).isNotNull()))


def delivery_step(t: Counted, cfg: Delivery) -> None:
    f = cfg.column
    if f and f in t.df.columns:
        days = t.let(parsing.delivery_days(t.let(parsing.lower_text(F.col(f))), cfg.max_days, cfg.clip_max))
        was_text = isinstance(t.df.schema[f].dataType, T.StringType)
        changed = F.col(f).isNotNull() if was_text else ~days.eqNullSafe(F.col(f))
        t.change({f: days}, ("delivery", f, "changed", changed), ("delivery", f, "nullified", days.isNull()))


def payment_step(t: Counted, cfg: Payment) -> None:
    f = cfg.column
    if f and f in t.df.columns:
        text = t.let(parsing.payment_text(F.col(f)))
        new = t.let(parsing.payment_label(F.col(f).cast("string"), text, cfg.extra_mappings))
        t.change({f: new}, ("payment", f, "standardized", ~new.eqNullSafe(F.col(f).cast("string"))))


def usable_keys(df: DataFrame, cfg: Dedup) -> list[str]:
    return [k for k in cfg.key_fields if k in df.columns]


def adds_up(df: DataFrame, cfg: Dedup) -> bool:
    return bool(cfg.strategy == "aggregate" and cfg.quantity_field in df.columns and usable_keys(df, cfg))


def deduplicate(df: DataFrame, cfg: Dedup, order: Column, by: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per key, or one row per key with the quantities added up."""
    keys = usable_keys(df, cfg)
    if not keys:
        return df
    keys = [*by, *[k for k in keys if k not in by]]
    if adds_up(df, cfg):
        quantity = cfg.quantity_field
        rest = [c for c in df.columns if c not in keys and c != quantity]
        units = F.coalesce(F.sum(to_number(F.col(quantity))), F.lit(0.0)).alias(quantity)
        return df.groupBy(*keys).agg(units, *[
            F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in rest])
    return without_later(df, keys, order)


def without_later(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Drop the rows that are not the first of their key."""
    own = df if "_place" in df.columns else cut_lineage(df.withColumn("_place", F.monotonically_increasing_id()))
    kept = own.join(later_rows(own, keys, order), "_place", "left_anti")
    return kept if "_place" in df.columns else kept.drop("_place")


def later_rows(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """``_place`` of the rows that are not the first of their key, written once.

    Only keys and positions are grouped: the first position of every key that occurs several times, then the
    rows behind it. Those are few and named by ``_place``, so whole rows are not sorted, and shuffled
    only if the copies are too many to broadcast. A position that is one number is a hash aggregate.
    The rows of a repeated key are found by one hash of the key, a number, and then compared key by key. Keys and positions
    are written once, since rules and joins may lie behind them.
    """
    single = isinstance(df.select(order.alias("o")).schema["o"].dataType, T.IntegralType)
    at = order if single else F.struct(order.alias("o"), F.col("_place"))
    narrow = cut_lineage(df.select(*keys, "_place", at.alias("_at"), F.xxhash64(*keys).alias("_hash")))
    first = F.min_by("_place", "_at") if single else F.min("_at")["_place"]
    several = narrow.groupBy(*keys).agg(first.alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    several = cut_lineage(several.select(*keys, "_first", F.xxhash64(*keys).alias("_hash")))
    # added up, so that the keys themselves are not sorted and shuffled by
    unlike = sum((F.when(F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")), 0).otherwise(1) for k in keys), F.lit(0))
    found = narrow.alias("a").join(several.alias("b"), (F.col("a._hash") == F.col("b._hash")) & (unlike == 0))
    return cut_lineage(found.filter(F.col("a._place") != F.col("b._first")).select("a._place"))


def outliers_step(t: Counted, cfg: Outliers, by: Sequence[str]) -> Column | None:
    """Scale down values that slipped a decimal; returns the median used."""
    f = cfg.column
    if not f or f not in t.df.columns:
        return
    number = F.col(f).cast("double") if is_numeric(t.df, f) else to_number(F.col(f))
    t.df = t.df.withColumn(f, number)
    t.df = attach(t.df, column_centres(t.df, [f], "median", by).withColumnRenamed(f"_stat_{f}", "_median"), by)
    value, corrected, flagged = parsing.downscaled(F.col(f), F.col("_median"), cfg.high_factor, list(cfg.downscale_candidates))
    t.change({f: half_even(value, cfg.decimal_places)},
             ("outliers", f, "corrected", corrected), ("outliers", f, "flagged", flagged))


# --- report -----------------------------------------------------------------

def measure(df: DataFrame, items: Sequence[tuple[str, str, str, Column]], by: Sequence[str] = ()) -> DataFrame:
    """One pass over ``df``; long form (by, step, field, metric, value)."""
    totals = df.groupBy(*by).agg(*[c.cast("double").alias(f"_m{i}") for i, (*_, c) in enumerate(items)])
    rows = F.array(*[
        F.struct(F.lit(s).alias("step"), F.lit(f).alias("field"), F.lit(m).alias("metric"), F.col(f"_m{i}").alias("value"))
        for i, (s, f, m, _) in enumerate(items)])
    return totals.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def null_counts(df: DataFrame, step: str, metric: str, columns: Sequence[str]) -> list[tuple[str, str, str, Column]]:
    return [(step, c, metric, F.count_if(F.col(c).isNull())) for c in columns]


def quality_report(before: DataFrame, after: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row counts and nulls per column on both sides."""
    sides = []
    for df, suffix in ((before, "before"), (after, "after")):
        columns = [c for c in df.columns if not c.startswith("_") and c not in by]
        rows = [("dq", "", f"rows_{suffix}", F.count(F.lit(1)))]
        sides.append(measure(df, rows + null_counts(df, "dq", f"missing_{suffix}", columns), by))
    return sides[0].unionByName(sides[1])


def value_steps(t: Counted, cfg: CleaningConfig, by: Sequence[str], ratings) -> None:
    """The steps that look at one row, in their fixed order; ``ratings`` does what is to be done to these."""
    dates_step(t, cfg.dates)
    prices_step(t, cfg.price)
    ratings(t)
    categories_step(t, cfg.categorical)
    cities_step(t, cfg.geo)
    booleans_step(t, cfg.booleans)
    delivery_step(t, cfg.delivery)


def run_cleaning(df: DataFrame, cfg: CleaningConfig, order: Column | None = None, by: Sequence[str] = (),
                 report: bool = True, holes: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """All steps in their fixed order. Returns the cleaned frame and the long-form report.

    The input is written to the shared folder once, unless it lies there already: then it has ``_place``, and
    ``holes`` names its columns with nulls. The modes and the duplicate keys read the columns they need of that copy.
    The steps that look at one row are worked through once, for all columns, counters and the mark of a later
    duplicate together, and their result is written; the other statistics, the report and the result read that.
    """
    columns = [c for c in df.columns if not c.startswith("_")]
    checked = [c for c in columns if c not in by]
    targets = imputed_columns(df, cfg.missing, by)
    copy = df
    if holes is None:
        copy, holes = copied(df if order is None else df.withColumn("_order", order), targets)
    t = Counted(copy, report)
    t.change({}, ("dq", "", "rows_before", F.lit(True)),
             *[("dq", c, "missing_before", F.col(c).isNull()) for c in checked])
    t.df = impute_missing(t.df, cfg.missing, by, holes)

    keys, added_up = usable_keys(df, cfg.dedup), adds_up(df, cfg.dedup)
    position = F.col("_order") if order is not None else F.col("_position")
    if keys and added_up and order is None:
        t.df = with_position(t.df)
    if keys and not added_up:
        keyed = Counted(t.df if order is not None else with_position(t.df), False)
        value_steps(keyed, cfg, by, lambda k: ratings_step(k, cfg.ratings, by) if cfg.ratings.column in keys else None)
        later = later_rows(keyed.df, [*by, *[k for k in keys if k not in by]], position)
        t.df = t.df.join(later.withColumn("_later", F.lit(True)), "_place", "left")
    # the statistic of ratings is taken from what is written, unless a step after it looks at them
    at_once = cfg.ratings.column in (*cfg.categorical.fields, cfg.geo.city_field, *cfg.booleans.fields, cfg.delivery.column)
    value_steps(t, cfg, by, lambda k: ratings_step(k, cfg.ratings, by) if at_once else parse_ratings(k, cfg.ratings))
    raw_texts = [f"{f}_raw" for f in cfg.price.fields if f"{f}_raw" in t.df.columns and f"{f}_raw" not in columns]
    helpers = [c for c in ("_later", "_order", "_position") if c in t.df.columns and (added_up or c == "_later")]
    t.df = cut_lineage(t.df.select(*columns, *raw_texts, *t.flag_names(), *helpers))
    if not at_once:
        t.df = fill_ratings(t.df, cfg.ratings, by)

    unique = t.clean()
    if added_up:
        unique = cut_lineage(deduplicate(unique, cfg.dedup, position, by))
    elif keys:
        unique = unique.filter(F.col("_later").isNull())
    u = Counted(unique, report)
    outliers_step(u, cfg.outliers, by)
    payment_step(u, cfg.payment)
    cleaned = u.clean().select(*columns, *raw_texts)
    if not report:
        return cleaned, None
    earlier = cut_lineage(measure(t.df, t.items(), by))
    imputed = earlier.filter((F.col("metric") == "missing_before") & F.col("field").isin(targets))
    imputed = imputed.withColumns({"step": F.lit("missing"), "metric": F.lit("imputed")})
    median = [("outliers", cfg.outliers.column, "median", F.max("_median"))] if "_median" in u.df.columns else []
    later = cut_lineage(measure(u.df, u.items() + median + [("dq", "", "rows_after", F.count(F.lit(1)))] +
                                null_counts(u.df, "dq", "missing_after", [*checked, *raw_texts]), by))
    whole = earlier.unionByName(imputed).unionByName(later)
    return cleaned, whole.unionByName(dedup_report(whole, df, cfg.dedup, by)) if cfg.dedup.key_fields else whole


def with_position(df: DataFrame) -> DataFrame:
    """Add ``_position``: the place of a scanned row in the order of files, as one number.

    Splits are numbered in the order of files and starts (a row for every 128 MB of input or so, broadcast); a running id
    orders the rows inside a split.
    """
    split = ["_src", "_start"]
    rows = df.withColumn("_start", F.col("_row.start"))
    splits = rows.select(*split).distinct()
    splits = cut_lineage(splits.withColumn("_split", F.row_number().over(Window.orderBy(*split))))
    inside = F.col("_row.n").bitwiseAND((1 << 33) - 1)
    placed = rows.join(F.broadcast(splits), split)
    return placed.withColumn("_position", F.shiftleft(F.col("_split").cast("long"), 33) + inside).drop("_split", "_start")


def dedup_report(counted: DataFrame, df: DataFrame, cfg: Dedup, by: Sequence[str]) -> DataFrame:
    """Rows dropped and kept, and a line for each key column that the input lacks, from the rows before and after."""
    sides = counted.filter(F.col("metric").isin("rows_before", "rows_after")).groupBy(*by).pivot(
        "metric", ["rows_before", "rows_after"]).agg(F.sum("value")).fillna(0, ["rows_before", "rows_after"])
    absent = [k for k in cfg.key_fields if k not in df.columns]
    lines = [("", "dropped", F.col("rows_before") - F.col("rows_after")), ("", "kept", F.col("rows_after")),
             *[(k, "missing_key", F.lit(1.0)) for k in absent]]
    rows = F.array(*[F.struct(F.lit("dedup").alias("step"), F.lit(f).alias("field"), F.lit(m).alias("metric"), v.alias("value"))
                     for f, m, v in lines])
    return sides.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def clean_one(step, df: DataFrame, *settings) -> DataFrame:
    """Apply a single step on its own, without counters."""
    t = Counted(df, False)
    step(t, *settings)
    return t.clean().drop("_median")
