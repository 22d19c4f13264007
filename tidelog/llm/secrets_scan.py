"""Secret scans: random candidates in text, and a random forest that removes the false positives.

A candidate is a maximal run of at least 16 of A-Z a-z 0-9 + / _ = - that holds a digit. Its features are its length, its
character classes and the transitions between them, how much of it dictionary words cover, the path it stands in, and the
words beside it. The forest learns from labelled findings; `weak_labels` makes such labels from what is certain either
way. The dictionary is the words that stand near candidates anywhere in the corpus, with their counts. Only DataFrame
functions and Spark's own random forest are used.

Labelled findings of equal features are one row, weighted by their number. The forest is fitted on at most `labelled_rows`
such rows, half of them for each label, or more where the other label has fewer (those of the least hashes); weights bring
each label back to its number of findings. Every candidate is judged.

Defined results: a null text has no candidate; rows with equal or null ids are scanned one by one, each candidate of a
text is a finding of its own, at its own start (characters before it); without labels of both kinds every finding gets
the label that there is (false, without any). Only the id, text and source are read.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.scratch import keep

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+"
#: Names of what a secret is assigned to; fixed values.
CREDENTIAL = r"(token|secret|passw(or)?d|passphrase|pwd|api[_ -]?key|access[_ -]?key|private[_ -]?key|credentials?|bearer)"
FEATURES = (
    "length", "digit_share", "upper_share", "symbol_share", "hex_only", "digits_only", "distinct_share", "transition_share",
    "dictionary_share", "path_depth", "path_length", "in_address", "assigned", "quoted", "credential_word", "before_count", "after_count",
)


def _share(text: Column, others: str) -> Column:
    """Share of characters left when those of the class `others` are gone."""
    return F.length(F.regexp_replace(text, others, "")) / F.length(text)


def candidates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """key, path (the source), start, candidate, before, after: each candidate with up to 80 and 40 characters beside it."""
    found = docs.filter(F.col(text).rlike(CANDIDATE)).select(
        F.col(key), F.col(source).cast("string").alias("path"), F.monotonically_increasing_id().alias("row"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("runs"), F.split(text, CANDIDATE, -1).alias("between"),
    )
    # Each candidate with the pieces of text on both sides, cut before the rows are made: a row holds nothing of the others.
    n = F.size("runs")
    beside = F.arrays_zip(F.col("runs").alias("run"), F.slice("between", F.lit(1), n).alias("left"), F.slice("between", F.lit(2), n).alias("right"))
    cut = F.transform(
        beside,
        lambda piece, i: F.struct(
            i.alias("i"), piece["run"].alias("candidate"), F.length(piece["left"]).alias("gap"),
            F.right(piece["left"], F.lit(80)).alias("before"), F.left(piece["right"], F.lit(40)).alias("after"),
        ),
    )
    each = found.select(key, "path", "row", F.explode(cut).alias("piece")).select(key, "path", "row", "piece.*")
    behind = Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("candidate")).over(behind)
    return each.select(key, "path", (end - F.length("candidate")).cast("int").alias("start"), "candidate", "before", "after")


def features(found: DataFrame) -> DataFrame:
    """Adds FEATURES."""
    found = keep(found, "candidates")  # else each feature would repeat the expressions that cut the text
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    kinds = F.translate(c, digits + ascii_lowercase + ascii_uppercase, "d" * 10 + "l" * 26 + "u" * 26)
    attached = F.regexp_extract(before, r"\S*$", 0)
    found = found.withColumns(
        {
            "length": F.length(c).cast("double"),
            "digit_share": _share(c, "[^0-9]"),
            "upper_share": _share(c, "[^A-Z]"),
            "symbol_share": _share(c, "[A-Za-z0-9]"),
            "hex_only": c.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
            "digits_only": c.rlike("^[0-9]+$").cast("double"),
            "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / F.length(c),
            "transition_share": (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / F.length(c),
            "path_depth": F.length(F.regexp_replace(F.concat(attached, c), r"[^/\\]", "")).cast("double"),
            "path_length": F.length(F.coalesce("path", F.lit(""))).cast("double"),
            "in_address": F.concat(attached, F.regexp_extract(after, r"^\S*", 0)).rlike(r"://|@|\.[a-z]{2,6}(/|$)").cast("double"),
            "assigned": before.rlike(r"[:=]>?\s*[\"'`]?$").cast("double"),
            "quoted": (before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]")).cast("double"),
            "credential_word": before.rlike(rf"(?i){CREDENTIAL}[^A-Za-z0-9]*$").cast("double"),
            "word_before": F.lower(F.regexp_extract(before, r"(\p{L}+)[^\p{L}]*$", 1)),
            "word_after": F.lower(F.regexp_extract(after, r"^[^\p{L}]*(\p{L}+)", 1)),
        }
    )
    found = keep(found, "findings")
    near = F.explode(F.regexp_extract_all(F.lower(F.concat_ws(" ", "before", "after")), F.lit(r"\p{L}+"), F.lit(0)))
    known = keep(found.select(near.alias("word")).groupBy("word").agg(F.count("*").alias("n")), "dictionary")
    # Letters of the candidate that lie in dictionary words of four letters and more.
    inside = found.select("candidate").distinct().select("candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{4,}"), F.lit(0))).alias("word"))
    covered = inside.join(known.filter("n > 1"), "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("covered"))
    beside = {side: known.select(F.col("word").alias(f"word_{side}"), F.log1p("n").alias(f"{side}_count")) for side in ("before", "after")}
    found = found.join(covered, "candidate", "left").withColumn("dictionary_share", F.coalesce("covered", F.lit(0)) / F.col("length"))
    for side, words in beside.items():
        found = found.join(words, f"word_{side}", "left").withColumn(f"{side}_count", F.coalesce(f"{side}_count", F.lit(0.0)))
    return found


def weak_labels(found: DataFrame) -> DataFrame:
    """Adds `label`: 1 if a quoted or assigned value follows a credential word, 0 if it is a bare number, part of an address
    or path, or made of words; null where neither is certain."""
    value = (F.col("credential_word") == 1) & ((F.col("assigned") == 1) | (F.col("quoted") == 1)) & (F.col("digits_only") == 0)
    other = (F.col("credential_word") == 0) & (
        ((F.col("digits_only") == 1) & (F.col("assigned") == 0)) | (F.col("in_address") == 1) | (F.col("path_depth") > 1) | (F.col("dictionary_share") > 0.5)
    )
    return found.withColumn("label", F.when(value, 1.0).when(other, 0.0))


def judge(found: DataFrame, labelled: DataFrame, *, labelled_rows: int = 20_000, trees: int = 32, depth: int = 6, limit: float = 0.5) -> DataFrame:
    """Adds probability and is_secret (probability >= limit) to findings with FEATURES; `labelled` has FEATURES and label."""
    rows = labelled.filter(F.col("label").isNotNull()).select(F.col("label").cast("double").alias("label"), *FEATURES)
    rows = keep(rows.groupBy("label", *FEATURES).agg(F.count("*").cast("double").alias("copies")), "labelled")
    sizes = {r["label"]: r for r in rows.groupBy("label").agg(F.count("*").alias("n"), F.sum("copies").alias("copies")).collect()}
    if len(sizes) < 2:
        only = max(sizes, default=0.0)
        return found.withColumns({"probability": F.lit(float(only)), "is_secret": F.lit(bool(only))})
    # Taken label by label: a rare label keeps its rows however many the other one has.
    least = {label: max(labelled_rows // 2, labelled_rows - sum(r["n"] for other, r in sizes.items() if other != label)) for label in sizes}
    taken = [rows.filter(F.col("label") == label).orderBy(F.xxhash64("label", *FEATURES)).limit(n) for label, n in least.items()]
    rows = keep(reduce(DataFrame.unionByName, taken), "sample")
    held = {r["label"]: r["copies"] for r in rows.groupBy("label").agg(F.sum("copies").alias("copies")).collect()}
    share = reduce(lambda c, label: c.when(F.col("label") == label, sizes[label]["copies"] / held[label]), held, F)
    rows = rows.withColumn("weight", F.col("copies") * share)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="weight", probabilityCol="votes", numTrees=trees, maxDepth=depth, seed=7)
    model = forest.fit(vectors.transform(rows))
    voted = model.transform(vectors.transform(found)).withColumn("probability", vector_to_array("votes")[1])
    return voted.drop("features", "votes", "rawPrediction", "prediction").withColumn("is_secret", F.col("probability") >= limit)


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", labelled: DataFrame | None = None, **options) -> DataFrame:
    """One row per candidate: key, path, start, candidate, before, after, FEATURES, probability, is_secret."""
    found = keep(weak_labels(features(candidates(docs, key=key, text=text, source=source))), "features")
    judged = judge(found, labelled if labelled is not None else found, **options)
    return judged.select(key, "path", "start", "candidate", "before", "after", *FEATURES, "probability", "is_secret")


def redact(docs: DataFrame, judged: DataFrame, *, key: str = "doc_id", text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """`docs` with the accepted findings replaced in the texts of their documents; the columns stay as they were.

    A document's secrets are distinct strings, so the list joined to it is no longer than its text.
    """
    secrets = judged.filter("is_secret").groupBy(F.col(key).alias("secret_key")).agg(F.collect_set("candidate").alias("secrets"))
    names = [f"own_{i}" for i in range(len(docs.columns))]  # whatever the columns are called
    own = dict(zip(docs.columns, names))
    masked = F.aggregate(F.array_sort("secrets", lambda a, b: F.length(b) - F.length(a)), F.col(own[text]), lambda t, s: F.replace(t, s, F.lit(mask)))
    joined = docs.toDF(*names).join(secrets, F.col(own[key]).eqNullSafe(F.col("secret_key")), "left")
    return joined.withColumn(own[text], F.when(F.col("secrets").isNull(), F.col(own[text])).otherwise(masked)).select(*names).toDF(*docs.columns)
