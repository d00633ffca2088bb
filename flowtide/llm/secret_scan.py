"""Secret scans: candidates by form, false positives removed by a random forest.

A candidate is a run of 16 characters or more of letters, digits and ``+/_=-`` that has a digit; a
word between blanks may hold many, as in minified JSON, and each is a candidate of its own. A name that
is assigned to a run within its word counts as the word before it. The forest sees its length, its changes between kinds of characters, shares of digits, capitals and
hexadecimal digits, how much of it is words of the corpus, the path of its document and the words
next to it. It learns from labelled findings, ``SAMPLE`` rows at most, the first by a hash.

Whole texts are scanned; only candidates leave the scan. A run of letters counts as a word of the
corpus if it stands alone ``COMMON`` times or more in all documents.

Null and empty texts have no findings, a null path is empty. Repeated rows and ids are scanned each.
Without labelled findings of both kinds nothing is removed. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm import common

SAMPLE, TREES, DEPTH, SEED, COMMON = 20_000, 30, 6, 42, 10
_RUN = r"[A-Za-z0-9+/_=-]{16,}"
_ASSIGNED = r"([A-Za-z0-9+/_.-]+)[\"'\]]*[=:]+[\"'\[{(]*$"
_NAMES = r"(?i)(token|secret|passw|api|key|auth|bearer|credential)"
_NUMBERS = ("length", "changes", "digits", "capitals", "hexadecimal", "covered", "path_length", "path_depth",
            "path_test", "path_bucket", "named", "assigned", "quoted", "before_bucket", "after_bucket", "before_length", "after_length")


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """key, path, word (its place, from 0), run (its place in the word), candidate, the word or, where it has several
    runs, the run's part of it (``whole``), the two words before and the one after."""
    split = docs.select(F.col(key).alias("key"), F.coalesce(F.col(path), F.lit("")).alias("path"),
                        F.split(F.coalesce(F.col(text), F.lit("")), r"\s+").alias("w"))
    at = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: (F.length(F.get("w", i)) >= 16) & F.get("w", i).rlike("[0-9]") & F.get("w", i).rlike(_RUN))
    word = lambda i: F.coalesce(F.when(i >= 0, F.get("w", i)), F.lit(""))
    found = split.select("key", "path", F.explode(F.transform(at, lambda i: F.struct(
        i.alias("word"), word(i).alias("whole"), word(i - 1).alias("before"), word(i - 2).alias("before2"), word(i + 1).alias("after")
    ))).alias("c")).select("key", "path", "c.*")
    # Between n runs lie n + 1 gaps, the first and the last of which may be empty.
    runs = found.withColumns({"runs": F.regexp_extract_all("whole", F.lit(_RUN), F.lit(0)), "gaps": F.split("whole", _RUN, -1)})
    runs = runs.select("*", F.posexplode("runs").alias("run", "candidate")).filter(F.col("candidate").rlike("[0-9]"))
    gap, last = F.get("gaps", F.col("run")), F.when(F.col("run") > 0, F.get("runs", F.col("run") - 1))
    runs = runs.withColumn("name", F.regexp_extract(F.concat(F.coalesce(last, F.lit("")), gap), _ASSIGNED, 1))
    own = F.concat(F.when((gap == "") | ~gap.rlike("[A-Za-z0-9]"), F.col("name")).otherwise(F.lit("")), gap, "candidate",
                   F.regexp_extract(F.get("gaps", F.col("run") + 1), "^[^=:,]*", 0))
    inside = F.col("name") != ""
    return runs.select(
        "key", "path", "word", "run", "candidate", F.when(F.size("runs") == 1, F.col("whole")).otherwise(own).alias("whole"),
        F.when(inside, F.concat("name", F.lit(":"))).otherwise(F.col("before")).alias("before"),
        F.when(inside, F.col("before")).otherwise(F.col("before2")).alias("before2"), "after",
    )


def _share(text: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kind}]", "")) / F.length(text)


def _bucket(text: Column, n: int = 16) -> Column:
    return F.pmod(F.xxhash64(F.lower(F.regexp_replace(text, r"[^\p{L}=:]", ""))), F.lit(n))


def covered(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """For each different candidate, the share of its characters in runs of letters that are common words."""
    runs = F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{3,}"), F.lit(0))
    parts = found.select("candidate").distinct().select("candidate", F.explode(runs).alias("run"))
    asked = common.stored_side(parts.select("run").distinct(), "candidate-runs")
    words = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^a-z]+")).alias("run"))
    known = words.join(asked, "run", "left_semi").groupBy("run").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= COMMON).select("run")
    return parts.join(known, "run").groupBy("candidate").agg((F.sum(F.length("run")) / F.length("candidate")).alias("covered"))


def features(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The findings with their features."""
    c, near = F.col("candidate"), F.concat_ws(" ", "before2", "before")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]+", "l"), "[A-Z]+", "L"), "[0-9]+", "d"), "[^lLd]+", "o")
    return found.join(covered(found, docs, text), "candidate", "left").na.fill({"covered": 0.0}).select(
        "*", F.length(c).alias("length"), ((F.length(kinds) - 1) / F.length(c)).alias("changes"),
        _share(c, "0-9").alias("digits"), _share(c, "A-Z").alias("capitals"), _share(c, "0-9a-fA-F").alias("hexadecimal"),
        F.length("path").alias("path_length"), F.size(F.split("path", "/")).alias("path_depth"),
        F.col("path").rlike("(?i)(test|example|sample|mock|doc)").cast("int").alias("path_test"), _bucket(F.col("path")).alias("path_bucket"),
        (near.rlike(_NAMES) | F.col("whole").rlike(_NAMES)).cast("int").alias("named"),
        (F.col("before").rlike(r"[=:]$") | F.col("whole").rlike(r"^[^=:]+[=:]")).cast("int").alias("assigned"),
        F.col("whole").rlike("[\"'].*[\"']").cast("int").alias("quoted"),
        _bucket(F.col("before")).alias("before_bucket"), _bucket(F.col("after")).alias("after_bucket"),
        F.length("before").alias("before_length"), F.length("after").alias("after_length"),
    )


def scan(featured: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Findings with ``probability`` (null without a forest) and ``is_secret``.

    ``labelled`` are findings with features and ``label``, 1 for secrets and 0 for false positives.
    """
    place = F.xxhash64(F.lit(SEED), "key", "word", "run", "candidate")
    taught = common.store(labelled.select(place.alias("place"), *_NUMBERS, F.col("label").cast("double").alias("label")).filter("label is not null")
                          .orderBy("place", "label", *_NUMBERS).limit(sample), "labelled-findings")
    if taught.select("label").distinct().count() < 2:
        return featured.withColumn("probability", F.lit(None).cast("double")).withColumn("is_secret", F.lit(True))
    assembler = VectorAssembler(inputCols=list(_NUMBERS), outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxMemoryInMB=64).fit(
        assembler.transform(taught).select("features", "label"))
    judged = forest.transform(assembler.transform(featured)).withColumn("probability", vector_to_array("probability")[1])
    return judged.withColumn("is_secret", F.col("probability") > 0.5).drop("features", "rawPrediction", "prediction")


def assigned_name() -> Column:
    """A label by form alone: a long mixed value that is assigned to a name which says secret."""
    return (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("length") >= 20) & F.col("candidate").rlike("[A-Za-z]")
