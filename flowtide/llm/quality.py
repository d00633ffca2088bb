"""Quality classifier: perplexity under a Kneser-Ney bigram model of trusted text.

The model (``lm``) is fitted on one half of the trusted documents, by the MD5 of the id, all of them and whole. It is counted
in Spark and lies in sorted arrays that workers map into memory, so nothing of its size passes through the driver.

The other half of the trusted documents, all of them, gives each language's threshold: the ``QUANTILE`` of
their log10 perplexity a token, plus ``MARGIN``. Documents without a language take the threshold of all. Documents of a language with
fewer than ``ENOUGH`` such documents have none and are kept: the model may never have seen their words. Perplexities are per token, the end of the text being a token. As the mean of few tokens says
little, a text of n tokens is rejected only beyond the threshold plus ``CAUTION / sqrt(n)``.

Null text is an empty text. Rows with equal id, text and language are one row kept twice and get the same result; ids
may repeat and may be null (those are never trusted). Without trusted documents, or without any for thresholds, all
documents are kept, their perplexities or thresholds are null, and a warning says so. Extra columns are carried along by ``keep_good``.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtide.llm import common, lm

# The operator fits on ``CHARACTERS`` only where a caller asks for a bound; its SQL check names it too, and stays below it.
CHARACTERS, QUANTILE, MARGIN, ENOUGH, CAUTION = 8_000_000, 0.995, 0.05, 30, 1.0


def _pool(key: Column) -> Column:
    """Whether a trusted document is fitted on; the others set thresholds."""
    return F.md5(key.cast("string")) < "8"


def row_key(key: Column, text: Column, lang: Column) -> Column:
    return F.xxhash64(key, lang, text)


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          characters: int | None = None, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """For each different row of key, language and text: __key, key, lang, tokens, log10_perplexity, threshold, kept.

    ``labels`` has ``key`` and, of trusted documents, quality 1 and toxic 0. ``characters`` bounds what is fitted on (``_taught``);
    without it the whole half is.
    """
    trusted = labels.filter("quality = 1 and toxic = 0").select(F.col(key).alias("key")).distinct()
    trusted = common.stored_side(trusted.filter("key is not null"), "trusted")
    rows = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    pool = rows.filter(_pool(F.col("key"))).join(trusted, "key", "left_semi")
    model = lm.fit(pool if characters is None else _taught(pool, characters))
    rows = rows.withColumn("__key", row_key(F.col("key"), F.col("text"), F.col("lang")))
    if not model.n_texts:
        warnings.warn("no trusted document to fit on: all documents are kept", stacklevel=2)
        nothing = F.lit(None).cast("double")
        return rows.select("__key", "key", "lang", F.lit(None).cast("long").alias("tokens"), nothing.alias("log10_perplexity"), nothing.alias("threshold"), F.lit(True).alias("kept"))
    scored = lm.score(rows, model, keep=["__key", "key", "lang"], finite=True)
    each = F.round(-F.col("score") / F.col("n_tokens"), 4).alias("log10_perplexity")
    judged = scored.select("__key", "key", "lang", F.col("n_tokens").alias("tokens"), each)
    judged = common.store(judged.dropDuplicates(["__key", "key", "lang"]), "perplexities")
    calm = judged.filter(~_pool(F.col("key"))).join(trusted, "key", "left_semi")
    limits = thresholds(calm, quantile).withColumn("threshold", F.round(F.col("threshold") + margin, 4))
    common_limit = limits.filter("__all").select("threshold").first()
    own = common.stored_side(limits.filter(~F.col("__all") & (F.col("n") >= ENOUGH) & F.col("lang").isNotNull()).select("lang", "threshold"), "language-thresholds")
    of_all = F.lit(common_limit[0] if common_limit else None).cast("double")
    threshold = F.coalesce("threshold", F.when(F.col("lang").isNull(), of_all))
    return judged.join(own, "lang", "left").select(
        "__key", "key", "lang", "tokens", "log10_perplexity", threshold.alias("threshold"),
        F.coalesce(F.col("log10_perplexity") <= threshold + CAUTION / F.sqrt("tokens"), F.lit(True)).alias("kept"),
    )


def _taught(pool: DataFrame, characters: int) -> DataFrame:
    """Whole documents of about ``characters``, in equal shares for each language: of each language those whose draw, the first 32 bits of the MD5, is in its share."""
    sizes = pool.groupBy("lang").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("size"))
    sizes = common.store(sizes.select(F.col("lang").alias("of"), "size"), "language-sizes")
    share = F.least(F.lit(1.0), F.lit(characters / max(1, sizes.count())) / F.greatest("size", F.lit(1)))
    drawn = F.conv(F.substring(F.md5(F.col("key").cast("string")), 1, 8), 16, 10).cast("long")
    limits = common.stored_side(sizes.select("of", share.alias("share")), "language-shares")
    return pool.join(limits, F.col("lang").eqNullSafe(F.col("of"))).filter(drawn < F.col("share") * 2.0**31).select("key", "lang", "text")


def thresholds(rows: DataFrame, quantile: float) -> DataFrame:
    """The smallest perplexity, in thousandths, that the share ``quantile`` of a language's rows doesn't exceed; and of all rows.

    Counted by value first: a language has some thousand values however many rows it has.
    """
    counted = rows.groupBy("lang", F.round("log10_perplexity", 3).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    both = counted.select("lang", F.lit(False).alias("__all"), "value", "n").union(
        counted.groupBy("value").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), F.lit(True), "value", "n"))
    group = Window.partitionBy("lang", "__all")
    placed = both.select("lang", "__all", "value", F.sum("n").over(group).alias("n"), F.sum("n").over(group.orderBy("value")).alias("upto"))
    return placed.filter(F.col("upto") >= quantile * F.col("n")).groupBy("lang", "__all", "n").agg(F.min("value").alias("threshold"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **options: float) -> DataFrame:
    """The documents within their language's threshold, with all their columns."""
    judged = judge(docs, labels, key, text, lang, **options)
    bad = common.stored_side(judged.filter("not kept").select("__key").distinct(), "rejected")
    # The caller's columns travel in one, so none of their names can clash.
    packed = docs.select(F.struct("*").alias("own"), row_key(F.col(key), F.col(text), F.col(lang)).alias("__key"))
    return packed.join(bad, "__key", "left_anti").select("own.*")
