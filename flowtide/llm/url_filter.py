"""URL filters: rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from labelled URLs: here those that a rule decides. Features are lengths, depth,
digit ratio, entropy, parameter counts and, for the host's last one and two labels, how many
labelled URLs there are and what share of them is blocked (drawn towards the overall share where
there are few). The fit takes ``SAMPLE`` labelled rows at most, the first by a hash of the URL; the
statistics and the verdicts cover all rows.

A URL that is null or has no ``://`` has an empty host and path, and takes part like any other.
Without labelled rows the verdict is allow; where all have one verdict, it is that one. Repeated
rows and ids are judged each. Extra columns are carried along, one named like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm import common

SAMPLE, ROUNDS, DEPTH, SEED = 20_000, 20, 4, 42
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_NUMBERS = ("length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "parameters",
            "hyphens", "suffix_n", "suffix_share", "domain_n", "domain_share")


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host and the beginning of the path, like ``example.com/en/``

    def fits(self, host: Column, path: Column) -> Column:
        name, _, rest = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)


def host_of(url: Column) -> Column:
    return common.ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def apply_rules(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """All columns with host, path and the longest rule that fits; of equal lengths the first by text."""
    parts = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = [F.when(r.fits(F.col("host"), F.col("path")), F.lit(r.text)) for r in ordered]
    return parts.withColumn("rule", F.coalesce(*fits, F.lit(None).cast("string")))


def entropy(text: Column) -> Column:
    """Bits of a character, by how often each one comes."""
    n = F.length(text)

    def more(total: Column, char: Column) -> Column:
        share = (n - F.length(F.replace(text, char))) / n
        return total - share * F.log2(share)

    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), more)


def features(parts: DataFrame, url: str = "url") -> DataFrame:
    """Adds the lexical features and the names of the host's suffix and domain."""
    text = F.coalesce(F.col(url), F.lit(""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    return parts.select(
        "*", F.length(text).alias("length"), F.length("host").alias("host_length"), F.length("path").alias("path_length"),
        F.size(F.filter(F.split("path", "/"), lambda x: x != "")).alias("depth"),
        F.size(F.split("host", r"\.")).alias("labels"),
        (digits / F.greatest(F.length(text), F.lit(1))).alias("digits"),
        F.when(text == "", 0.0).otherwise(entropy(text)).alias("entropy"),
        F.size(F.filter(F.split(query, "&"), lambda x: x != "")).alias("parameters"),
        (F.length("host") - F.length(F.replace("host", F.lit("-")))).alias("hyphens"),
        F.substring_index("host", ".", -1).alias("suffix"), F.substring_index("host", ".", -2).alias("domain"),
    )


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url", sample: int = SAMPLE) -> DataFrame:
    """All columns with host, path, rule, verdict and blocked, the trees' probability (null without trees)."""
    pages = pages.select(*[c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "blocked")])
    ruled = apply_rules(pages, rules, url)
    said = {r.text: r.verdict for r in rules}
    by_rule = F.lit(None).cast("string")
    for text, verdict in said.items():
        by_rule = F.when(F.col("rule") == text, verdict).otherwise(by_rule)
    ruled = ruled.withColumn("__said", by_rule)
    label = (F.col("__said") == "block").cast("double")
    rows = ruled.select(F.struct(*pages.columns).alias("__row"), F.col(url).alias("url"), "host", "path", "rule", "__said")
    rows = features(rows)
    labelled = rows.filter("__said is not null").withColumn("label", label)
    overall = labelled.agg(F.avg("label").alias("share"), F.count(F.lit(1)).alias("n")).first()
    share = overall["share"]
    for name in ("suffix", "domain"):
        known = labelled.groupBy(name).agg(
            F.count(F.lit(1)).alias(f"{name}_n"), ((F.sum("label") + 10 * F.lit(share or 0.0)) / (F.count(F.lit(1)) + 10)).alias(f"{name}_share")
        )
        rows = rows.join(common.stored_side(known, f"url-{name}"), name, "left").na.fill({f"{name}_n": 0, f"{name}_share": share or 0.0})
    if share in (None, 0.0, 1.0):
        judged = rows.withColumn("blocked", F.lit(None).cast("double"))
        own = F.lit("block" if share == 1.0 else "allow")
    else:
        assembler = VectorAssembler(inputCols=list(_NUMBERS), outputCol="features")
        taught = rows.filter("__said is not null").select(*_NUMBERS, label.alias("label"), F.xxhash64(F.lit(SEED), "url").alias("place"))
        taught = common.store(taught.orderBy("place", *_NUMBERS).limit(sample), "labelled-urls")
        trees = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, seed=SEED, maxMemoryInMB=64, cacheNodeIds=False).fit(
            assembler.transform(taught).select("features", "label"))
        from pyspark.ml.functions import vector_to_array

        judged = trees.transform(assembler.transform(rows)).withColumn("blocked", vector_to_array("probability")[1])
        own = F.when(F.col("blocked") > 0.5, "block").otherwise("allow")
    return judged.select("__row.*", "host", "path", "rule", F.coalesce("__said", own).alias("verdict"), "blocked")
