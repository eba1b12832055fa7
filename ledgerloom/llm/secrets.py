"""Secret scan: candidate strings, and a random forest that removes the false ones.

A candidate is a run of ``SHORTEST`` or more ASCII letters, digits and ``+ / = _ -``, and any value,
whatever its length and characters, that is assigned to a name with one of ``NAMES`` in it: what a
quotation mark closes on the same line, otherwise what stands before white space or the next such
assignment. Both are looked for independently and may overlap; equal ones are one candidate. Its features are its length, how its characters
follow each other (changes between letters and digits, upper and lower case, repeated characters,
vowels next to consonants), how much of it words of a dictionary cover, the kind of path it was
found under and the words around it. The forest is trained on labelled findings, rows of features
with a ``label``; anything that can be labelled will do. ``findings`` here labels a bounded
sample by rules that the forest does not see as such: an assignment of a random-looking value to
a name that means a secret is one; everything else is none.

All steps are DataFrame and ``pyspark.ml`` operations.

Bounds (parameters): at most ``SAMPLE`` findings of either label train the forest, those with the
smallest hashes; the dictionary has the ``DICTIONARY`` most frequent four-letter pieces of words,
counted over all documents. Candidates come from whole texts, and all are scored.

Defined results: a null or empty text has no candidates. With fewer than two labels in the sample
every candidate has the share of positive labels as its probability (0 without any). Repeated rows
and null ids give rows each. Other columns are ignored, but for ``path``.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import keep

SHORTEST = 16
SAMPLE = 4000
DICTIONARY = 400
TREES = 30
DEPTH = 6
THRESHOLD = 0.5

CANDIDATE = rf"[A-Za-z0-9+/=_\-]{{{SHORTEST},}}"
#: names that announce a secret (fixed values)
NAMES = r"(?i)(api[_-]?key|access[_-]?key|auth|bearer|credential|passwd|password|private[_-]?key|secret|token)"
_ASSIGNED = NAMES + r"""\w{0,30}["'`\])]{0,3}\s{0,20}(?::\s{1,20}[\w.\[\]]{1,40}\s{1,20}(?==))?[:=]{1,3}>?\s{0,20}(?:(?i:bearer|basic)\s{1,20})?"""
#: an assignment; its third group is a value in quotation marks, the fourth any other
VALUE = (
    _ASSIGNED
    + r"""(?:("{3}|'{3}|["'`])(.+?)(?<!\\)(?=\2)|["'`]{0,3}+((?!["'`])(?:(?!"""
    + _ASSIGNED.replace("(api", "(?:api")
    + r""")\S)++))"""
)

FEATURES = [
    "length", "digits", "uppers", "symbols", "switches", "case_switches", "repeats", "vowel_turns", "distinct",
    "covered", "hex_only", "named", "assigned", "quoted", "words_before", "words_after", "path_test", "path_code",
]


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """``doc_id, nth, start, finding, before, after, path``: each candidate with up to 60 characters around it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    path = F.coalesce(F.col(path_col), F.lit("")) if path_col else F.lit("")
    found = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        path.alias("path"),
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("runs"),
        F.regexp_extract_all(text, F.lit(VALUE), F.lit(0)).alias("values"),
    ).where((F.size("runs") > 0) | (F.size("values") > 0))
    quoted, bare = (F.regexp_extract_all("text", F.lit(VALUE), F.lit(group)) for group in (3, 4))
    some = F.size("values") > 0
    cut = found.select(
        "row", "doc_id", "path", "runs", "values",
        F.split("text", CANDIDATE, -1).alias("run_gaps"),
        F.when(some, F.split("text", VALUE, -1)).alias("value_gaps"),
        F.when(some, F.zip_with(quoted, bare, lambda a, b: F.concat(a, b))).alias("assigned"),
    )
    runs = _around("runs", "run_gaps", lambda hit, i: hit)
    values = F.when(some, _around("values", "value_gaps", lambda hit, i: F.get("assigned", i)))
    each = cut.select(
        "row",
        "doc_id",
        "path",
        F.explode(F.concat(_marked(0, F.coalesce(values, F.array().cast(_AROUND))), _marked(1, runs))).alias("e"),
    ).select("row", "doc_id", "path", "e.kind", "e.nth", "e.c")
    # one deal by the row serves both windows
    moved = F.sum(F.expr("c.gap + length(c.finding)")).over(_by_row())
    placed = each.repartition("row").withColumn("start", moved - F.length("c.finding"))
    first = F.row_number().over(Window.partitionBy("row", "start", F.length("c.finding")).orderBy("kind"))
    return placed.withColumn("first", first).where("first = 1").select(
        "doc_id", "nth", "start", "c.finding", "c.before", "c.after", "path"
    )


_AROUND = "array<struct<finding:string,gap:int,before:string,after:string>>"


def _around(hits: str, gaps: str, value) -> Column:
    """Of every hit its value, the characters between the last value and it, and the text around it."""

    def one(hit: Column, i: Column) -> Column:
        found, gap = value(hit, i), F.get(gaps, i)
        lead = F.concat(gap, F.left(hit, F.length(hit) - F.length(found)))
        return F.struct(
            found.alias("finding"),
            F.length(lead).alias("gap"),
            F.right(lead, F.lit(60)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(60)).alias("after"),
        )

    return F.transform(hits, one)


def _marked(kind: int, all_of: Column) -> Column:
    return F.transform(all_of, lambda c, i: F.struct(F.lit(kind).alias("kind"), i.alias("nth"), c.alias("c")))


def _by_row():
    return Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def dictionary(docs: DataFrame, text_col: str = "text") -> list[str]:
    """The most frequent four-letter pieces of the words of all documents; at most ``DICTIONARY`` strings."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit("[a-z]{4,}"), F.lit(0))).alias("w"))
    # equal words are counted first, so each is cut into pieces once; there are 26**4 pieces at most
    counted = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    cut = F.transform(F.sequence(F.lit(1), F.length("w") - 3), lambda i: F.substring("w", i, 4))
    pieces = counted.select("n", F.explode(cut).alias("p"))
    top = pieces.groupBy("p").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "p").limit(DICTIONARY)
    return [r["p"] for r in top.collect()]


def with_features(found: DataFrame, known: list[str]) -> DataFrame:
    f, size = F.col("finding"), F.length("finding").cast("double")
    before, after = F.col("before"), F.col("after")
    # what is left when every piece of the dictionary is taken out; the pieces are plain letters
    rest = F.regexp_replace(F.lower(f), "|".join(known), "") if known else f
    return found.withColumns({
        "length": F.log1p(size),
        "digits": _count(f, "[0-9]") / size,
        "uppers": _count(f, "[A-Z]") / size,
        "symbols": _count(f, r"[+/=_\-]") / size,
        "switches": _count(f, "(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])") / size,
        "case_switches": _count(f, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])") / size,
        "repeats": _count(f, r"(.)(?=\1)") / size,
        "vowel_turns": _count(f, "(?i)(?<=[aeiou])(?=[b-df-hj-np-tv-z])|(?<=[b-df-hj-np-tv-z])(?=[aeiou])") / size,
        "distinct": F.size(F.array_distinct(F.split(f, ""))).cast("double"),
        "covered": 1 - F.length(rest) / size,
        "hex_only": F.lower(f).rlike("^[0-9a-f]+$").cast("double"),
        "named": before.rlike(NAMES + r"\W{0,8}$").cast("double"),
        "assigned": before.rlike(r"[:=]\s*[\"']?$").cast("double"),
        "quoted": (before.rlike("[\"']$") & after.rlike("^[\"']")).cast("double"),
        "words_before": _count(before, r"[A-Za-z]{2,}"),
        "words_after": _count(after, r"[A-Za-z]{2,}"),
        "path_test": F.col("path").rlike("(?i)test|example|sample|fixture|doc").cast("double"),
        "path_code": F.col("path").rlike(r"(?i)\.(py|js|java|go|rb|ya?ml|env|json|ini|toml)$").cast("double"),
    })


def findings(scored: DataFrame) -> DataFrame:
    """Label candidates by rule: a random-looking value assigned to the name of a secret."""
    random_looking = (F.col("digits") > 0.1) & (F.col("distinct") >= 8) & (F.col("repeats") < 0.3)
    named = F.col("before").rlike(NAMES + "[\"']?\\s*[:=]\\s*[\"']?$")
    return scored.withColumn("label", (named & random_looking).cast("double"))


def train(labelled: DataFrame):
    """A forest, or the share of positive labels where there is but one label."""
    order = F.xxhash64("finding", "before", "nth")
    parts = [labelled.where(F.col("label") == v).orderBy(order).limit(SAMPLE) for v in (0.0, 1.0)]
    sample = keep(parts[0].unionByName(parts[1]).select(*FEATURES, "label"), "findings")
    share = [r["label"] for r in sample.groupBy("label").agg(F.count(F.lit(1))).collect()]
    if len(share) < 2:
        return share[0] if share else 0.0
    grown = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=11,
        featureSubsetStrategy="sqrt", subsamplingRate=0.8,
    )
    return grown.fit(_vectors(sample))


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(df)


def judge(scored: DataFrame, forest) -> DataFrame:
    """Add ``probability`` and ``is_secret``."""
    if isinstance(forest, float):
        out = scored.withColumn("probability", F.lit(forest))
    else:
        voted = forest.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("votes").transform(_vectors(scored))
        out = voted.withColumn("probability", vector_to_array("votes")[1]).drop("votes", "features")
    return out.withColumn("is_secret", F.col("probability") >= THRESHOLD)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """Every candidate with its probability: ``doc_id, start, length, finding, probability, is_secret``."""
    found = candidates(docs, id_col, text_col, path_col)
    scored = keep(with_features(found, dictionary(docs, text_col)), "candidates")
    return judge(scored, train(findings(scored))).select(
        "doc_id", "start", F.length("finding").alias("length"), "finding", "probability", "is_secret"
    )
