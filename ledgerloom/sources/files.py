"""CSV folders: listing, scanning, routing to a configuration, and the outputs of a cleaning run."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Callable
from urllib.parse import unquote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.functions.numeric import to_number
from ledgerloom.functions.parsing import boolean
from ledgerloom.functions.text import null_tokens
from ledgerloom.session import cut_lineage, shared_folder
from ledgerloom.sources.types import column_kinds, is_plain_text, type_of

CSV_NAME = "*.[cC][sS][vV]"


def dataset_name(path: Column) -> Column:
    """Name of the CSV a path belongs to: the file itself, or the ``x.csv`` folder of part files it lies in."""
    decoded = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    # worked out for every row, so without patterns and lists
    last = F.substring_index(F.when(path.contains("%"), decoded).otherwise(path), "/", -2)
    folder = F.substring_index(last, "/", 1)
    name = F.when(F.lower(folder).endswith(".csv"), folder).otherwise(F.substring_index(last, "/", -1))
    # a cleaned file keeps the name of its input
    mark = "source_file="
    return F.when(name.startswith(mark), F.substring(name, F.lit(len(mark) + 1), F.length(name))).otherwise(name)


def list_csv(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name) of the CSVs directly inside ``folder``; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", CSV_NAME)
    try:
        found = files.load(f"{folder}/{CSV_NAME}").select("path")
    except AnalysisException:  # nothing matches
        found = spark.createDataFrame([], "path string")
    return found.select("path", dataset_name(F.col("path")).alias("name")).orderBy("path")


def csv_writer(df: DataFrame):
    """A CSV writer that keeps spaces at the edges of values."""
    return (df.write.option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def reader(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line).option("mode", "PERMISSIVE"))


def positioned(df: DataFrame) -> DataFrame:
    """Add ``source_file``, ``_src`` and ``_row``; (``_src``, ``_row``) sorts rows in file order.

    A split is read by one task from start to end, so the running id orders rows inside a
    split and the split's start orders the splits of a file.
    """
    return df.select(
        "*", dataset_name(F.col("_metadata.file_path")).alias("source_file"),
        F.col("_metadata.file_path").alias("_src"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n")).alias("_row"))


def read_tokens(df: DataFrame, casts: dict[str, str] | None = None) -> DataFrame:
    """Null tokens to null in every text column, then the casts a caller names ("double", "int", "boolean", …)."""
    return typed(df, casts or {}, null_tokens)


def typed(df: DataFrame, kinds: dict[str, str], prepare: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """Text columns, prepared, cast to the kinds that are named."""

    def value(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, T.StringType) or f.name in ("source_file", "_src"):
            return c
        c = prepare(c)
        kind = kinds.get(f.name, "string")
        if kind == "boolean":
            c = boolean(c)
        elif kind == "double":
            c = to_number(c)
        elif kind != "string":
            c = c.try_cast(kind)
        return c.alias(f.name)

    return df.select(*[value(f) for f in df.schema.fields])


def scan_csv(spark: SparkSession, path: str | list[str], casts: dict[str, str] | None = None,
             columns: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """CSV files with one common header, every column read as text first.

    Without inference no extra pass is needed and ids keep their leading zeros.
    """
    source = reader(spark, multi_line)
    if columns:
        source = source.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return read_tokens(positioned(source.csv(path)), casts)


def unreadable(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The reason for each path that is not there. Only asked once a scan of them all was refused."""
    reasons = {}
    for path in paths:
        try:
            spark.read.text(path)
        except AnalysisException as error:
            reasons[path] = str(error).splitlines()[0]
    return reasons


def column_names(header: str) -> list[str]:
    """Names of a header line as the CSV reader gives them: numbered where empty or, but for case, not unique."""
    names = next(csv.reader([header]))
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def headers(spark: SparkSession, paths: list[str]) -> tuple[dict[tuple[str, ...], list[str]], dict[str, str]]:
    """Files by their column names, and the reason for each path that cannot be read.

    One scan for all files: of each the first line that is not blank, the one with the smallest place.
    """
    failed = {}
    try:
        lines = spark.read.text(paths)
    except AnalysisException:
        failed = unreadable(spark, paths)
        paths = [p for p in paths if p not in failed]
        if not paths:
            return {}, failed
        lines = spark.read.text(paths)
    place = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    # the reader drops a header's byte order mark only at the start of a file, where it stands
    first = (lines.filter(F.trim("value") != "").select(F.col("_metadata.file_path").alias("path"), "value", place.alias("at"))
             # with a set beside it the text is aggregated in a map of one entry per file; on its own all lines would be sorted
             .groupBy("path").agg(F.min_by("value", "at").alias("header"), F.collect_set("at.start").alias("splits"))
             .filter(F.size("splits") > 0))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    groups = defaultdict(list)
    for row in sorted(found, key=lambda r: r["paths"]):
        groups[tuple(column_names(row["header"]))] += [plain_path(p) for p in row["paths"]]
    return dict(groups), failed


def plain_path(uri: str) -> str:
    """A path as readers take it from the encoded one that rows carry."""
    return unquote(uri)


def scan_groups(spark: SparkSession, paths: list[str], casts: dict[str, str] | None = None,
                multi_line: bool = False, skip_unreadable: bool = False, types: bool = False) -> list[DataFrame]:
    """One scan per distinct header, not per file. An unreadable file is an error unless it is to be skipped.

    With ``types`` columns get the type that all values of their CSV agree on, and there is a scan per header and list
    of types: a column can be a number in one file and text in another. The kinds are found in one pass over
    each header's files; ``casts`` go before what is found.
    """
    known, failed = headers(spark, paths)
    if failed and not skip_unreadable:
        raise ValueError("unreadable files: " + "; ".join(f"{path}: {reason}" for path, reason in sorted(failed.items())))
    for path, reason in failed.items():
        print(f"skipped {path}: {reason}")
    scans = []
    for names, members in known.items():
        if not types:
            scans.append(scan_csv(spark, members, casts, list(names), multi_line))
            continue
        for kinds, own in typed_groups(spark, members, list(names), multi_line).items():
            found = {n: type_of(k) for n, k in zip(names, kinds)}
            scans.append(scan_csv(spark, own, found | (casts or {}), list(names), multi_line))
    return scans


def typed_groups(spark: SparkSession, paths: list[str], names: list[str], multi_line: bool = False) -> dict[tuple[int, ...], list[str]]:
    """Files with one header by the kinds of their columns; part files of a CSV go together."""
    rows = scan_csv(spark, paths, None, names, multi_line)
    # one scan: kinds by part file, then those of the part files together
    parts = column_kinds(rows, names, ["source_file", "_src"])
    kinds = F.array(*[F.bit_or(F.col("kinds")[i]) for i in range(len(names))])
    files = parts.groupBy("source_file").agg(kinds.alias("kinds"), F.collect_set("_src").alias("paths"))
    groups = defaultdict(list)
    for row in files.orderBy("source_file").collect():
        groups[tuple(row["kinds"])] += sorted(map(plain_path, row["paths"]))
    counted = {p for members in groups.values() for p in members}
    # files with a header and no rows
    bare = [p for p in paths if p not in counted]
    if bare:
        groups[(0,) * len(names)] += bare
    return dict(groups)


def stored_groups(spark: SparkSession, paths: list[str], multi_line: bool = False) -> list[tuple[DataFrame, list[str]]]:
    """Typed tables like those of ``scan_groups``, each with its columns that hold a null; the CSVs are worked through once.

    The text is written to the shared folder, with a row id ``_place``; types are found in that copy and are casts of it.
    """
    known, failed = headers(spark, paths)
    if failed:
        raise ValueError("unreadable files: " + "; ".join(f"{path}: {reason}" for path, reason in sorted(failed.items())))
    stored = []
    for names, members in known.items():
        text = cut_lineage(scan_csv(spark, members, None, list(names), multi_line))
        groups = defaultdict(list)
        holes = defaultdict(set)
        for name, types, empty in settled_types(text, list(names)):
            groups[types].append(name)
            holes[types] |= empty
        # files with a header and no rows
        groups = dict(groups) or {("string",) * len(names): []}
        parts = by_group(text, list(groups.values())) if len(groups) > 1 else [text]
        for (types, _), part in zip(groups.items(), parts):
            rows = typed(part, dict(zip(names, types))).withColumn("_place", F.col("_row.n"))
            stored.append((rows, [n for n in names if n in holes[types]]))
    return stored


def settled_types(text: DataFrame, names: list[str]) -> list[tuple[str, tuple[str, ...], set[str]]]:
    """(file, types of its columns, its columns with nulls) of a stored table: one row per file.

    A column is text as soon as one value is, which most values tell by their first character; kinds are only asked
    of columns that this leaves open.
    """
    plain = [F.max(is_plain_text(F.col(f"`{c}`"))).alias(f"_plain_{i}") for i, c in enumerate(names)]
    empty = [F.max(F.col(f"`{c}`").isNull()).alias(f"_null_{i}") for i, c in enumerate(names)]
    files = text.groupBy("source_file").agg(*plain, *empty).orderBy("source_file").collect()
    unsettled = [i for i in range(len(names)) if not all(row[f"_plain_{i}"] for row in files)]
    kinds = {}
    if unsettled:
        found = column_kinds(text, [names[i] for i in unsettled], ["source_file"]).collect()
        kinds = {row["source_file"]: dict(zip(unsettled, row["kinds"])) for row in found}
    return [(
        row["source_file"],
        tuple("string" if row[f"_plain_{i}"] else type_of(kinds[row["source_file"]][i]) for i in range(len(names))),
        {c for i, c in enumerate(names) if row[f"_null_{i}"]},
    ) for row in files]


def by_group(text: DataFrame, groups: list[list[str]]) -> list[DataFrame]:
    """The rows of each group of files: the table is written once more, in a folder per group."""
    spark = text.sparkSession
    of = spark.createDataFrame([(name, i) for i, group in enumerate(groups) for name in group], "source_file string, _group int")
    path = f"{shared_folder(spark)}/groups-{uuid4().hex}"
    text.join(F.broadcast(of), "source_file").write.partitionBy("_group").parquet(path)
    return [spark.read.schema(text.schema).parquet(f"{path}/_group={i}") for i in range(len(groups))]


def scan_files(spark: SparkSession, paths: list[str], casts: dict[str, str] | None = None,
               multi_line: bool = False, skip_unreadable: bool = False) -> DataFrame | None:
    """Union of CSV files with different headers, as text; missing columns are null."""
    whole = None
    for part in scan_groups(spark, paths, casts, multi_line, skip_unreadable):
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole


def scan_folder(spark: SparkSession, folder: str, casts: dict[str, str] | None = None) -> DataFrame | None:
    """All CSVs of a folder for a first look: files that cannot be read are named and left out."""
    return scan_files(spark, [row.path for row in list_csv(spark, folder).collect()], casts, skip_unreadable=True)


def processed_files(spark: SparkSession, out_folder: str) -> DataFrame:
    """File names that an earlier run has reported on."""
    try:
        return spark.read.schema("file string").json(f"{out_folder}/report").select(F.col("file").alias("name")).distinct()
    except AnalysisException:
        return spark.createDataFrame([], "name string")


def route_files(spark: SparkSession, folder: str, out_folder: str | None = None, overwrite: bool = False) -> DataFrame:
    """(path, name, config): catalog files by their name, all others are transactions;
    files reported on before are left out unless they are to be overwritten."""
    files = list_csv(spark, folder).withColumn(
        "config", F.when(F.lower("name").contains("catalog"), F.lit("catalog")).otherwise(F.lit("transactions")))
    if out_folder and not overwrite:
        files = files.join(processed_files(spark, out_folder), "name", "left_anti").select("path", "name", "config")
    return files.orderBy("path")


def write_clean(cleaned: DataFrame, report: DataFrame, out_folder: str) -> None:
    """Cleaned rows as CSV, one folder per source file, and the report as JSON lines.

    Rows are dealt by file first, in parts of the advisory size: a file's folder gets as many parts as its
    size asks for, not one from every task. Writing a file again replaces its folder only. The report is written
    last: a file counts as done once it is there.
    """
    (csv_writer(cleaned.hint("rebalance", "source_file")).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source_file").csv(f"{out_folder}/data"))
    (report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("config", "file")
     .json(f"{out_folder}/report"))
