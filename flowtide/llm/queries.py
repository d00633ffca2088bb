"""The registered queries of the operators, each over its whole table, and their checks in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.llm import (
    common, decontamination, exact_dedup, language_id, lm, periodic_runs, personal_data, pieces, quality, secret_scan, sharding,
    simhash, sql, url_filter, vector_codes,
)
from flowtide.llm.common import documents, ship

PIECES = "/opt/tokenizers/piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        QUERIES[name] = run
        if check is not None:
            ORACLES[name] = check
        return query

    return add


def _remainder(key: Column, by: int) -> Column:
    """CRC-32 of a key as text; a null key has remainder 0."""
    return F.coalesce(F.crc32(key.cast("string")), F.lit(0)) % by


@_register("op2_lm_scoring", f"""with {sql.CRC_TABLE},
texts as (select doc_id as key, text, {sql.crc32('cast(doc_id as varchar)')} % 10 <> 0 as train
    from documents cross join crc_table),
{sql.kneser_ney('texts')}
select key as doc_id, not train as held_out, tokens as n_tokens, known as n_known,
    cast((select tokens from all_words) as bigint) as train_tokens, round(base, 6) as base_score, round(score, 6) as score
from scored join texts using (key)""")
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = _remainder(F.col("doc_id"), 10) == 0
    model = lm.fit(docs.filter(~held_out))
    return lm.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"),
    )


@_register("op3_exact_dedup", """select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    digest = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return exact_dedup.classes(digest, keep="largest").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


@_register("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(documents(spark, sf_dir).select("doc_id", "text"), 8)
    return sharded.select(
        "doc_id", sharding.record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit(sharding.LAW).alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


_PHRASE_WORDS = "regexp_extract_all(" + sql.LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_register("op7_decontamination", f"""with
items as (select cast(item_id as varchar) as item, {_PHRASE_WORDS} as w from benchmark),
phrases as (select distinct item, w[i : i + least(10, len(w)) - 1] as p from (select item, w,
    unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)),
sizes as (select distinct len(p) as n from phrases),
docs as (select doc_id, {_PHRASE_WORDS} as w from documents),
places as (select doc_id, n, i, w[i : i + n - 1] as p from (select doc_id, w, n,
    unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) as i from docs cross join sizes)),
hits as (select doc_id, n, i, item from places join phrases using (p)),
covered as (select doc_id, count(distinct x) as n_hit from (select doc_id, unnest(range(i, i + n)) as x from hits) group by doc_id),
found as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids from hits group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (doc_id) left join found using (doc_id)""")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = decontamination.phrases(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    index, terms = decontamination.build(documents(spark, sf_dir), tests)
    return decontamination.report(index, decontamination.search(index, terms, tests)).select(
        F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


@_register("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )


@_register("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.load(spark, PIECES)
    encoded = pieces.encode(documents(spark, sf_dir).select("doc_id", "text"), model, decoded="decoded")
    return encoded.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_ids"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


@_register("op4_secret_scans")
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = common.store(secret_scan.features(secret_scan.candidates(docs), docs), "findings")
    # Findings in the documents of the labels table are labelled by their form.
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("key")).distinct()
    labelled = found.join(labels, "key", "left_semi").withColumn("label", secret_scan.assigned_name().cast("int"))
    return secret_scan.scan(found, labelled).select(
        F.col("key").alias("doc_id"), F.col("word").cast("long").alias("word"),
        F.sha2("candidate", 256).alias("candidate_sha256"), F.col("length").cast("long").alias("length"),
        F.round("probability", 6).alias("probability"), "is_secret",
    )


#: Fixed values of the contract.
URL_RULES = [
    url_filter.Rule("allow", "com/"), url_filter.Rule("block", "example.com/en/"),
    url_filter.Rule("allow", "www.example.com/en/"), url_filter.Rule("block", "net/es/"),
    url_filter.Rule("block", "net/fr/"),
]


@_register("op6_url_filters")
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", F.round("blocked", 6).alias("blocked"))


@_register("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = _remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.filter(~held_out))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@_register("op1_quality_classifier", f"""with
trusted as (select distinct doc_id from labels where quality = 1 and toxic = 0 and doc_id is not null),
pool as (select doc_id, lang, text, cast('0x' || md5(cast(doc_id as varchar))[1:8] as bigint) as drawn
    from documents join trusted using (doc_id) where md5(cast(doc_id as varchar)) < '8'),
sizes as (select lang, sum(coalesce(length(text), 0)) as size from pool group by lang),
sample as (select doc_id from pool join sizes on pool.lang is not distinct from sizes.lang
    where drawn < least(1, {quality.CHARACTERS} / (select count(*) from sizes) / greatest(size, 1)) * 2147483648.0),
texts as (select doc_id as key, text, doc_id in (select doc_id from sample) as train from documents),
{sql.kneser_ney('texts')},
judged as (select doc_id, lang, tokens, round(-score / tokens, 4) as p from scored join documents on key = doc_id),
counted as (select lang, false as everything, round(p, 3) as value, count(*) as n from judged join trusted using (doc_id)
    where md5(cast(doc_id as varchar)) >= '8' group by 1, 3),
all_values as (select * from counted union all select null, true, value, sum(n) from counted group by value),
placed as (select lang, everything, value, sum(n) over (partition by lang, everything) as n,
    sum(n) over (partition by lang, everything order by value) as upto from all_values),
limits as (select lang, everything, n, round(min(value) + {quality.MARGIN}, 4) as threshold from placed
    where upto >= {quality.QUANTILE} * n group by 1, 2, 3),
found as (select judged.*, coalesce(own.threshold, case when lang is null then (select threshold from limits where everything) end) as threshold from judged
    left join (select * from limits where not everything and n >= {quality.ENOUGH} and lang is not null) as own using (lang))
select doc_id, lang, tokens as n_tokens, p as log10_perplexity, threshold,
    coalesce(p <= threshold + {quality.CAUTION} / sqrt(tokens), true) as kept from found""")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    judged = quality.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select(F.col("key").alias("doc_id"), "lang", F.col("tokens").alias("n_tokens"), "log10_perplexity", "threshold", "kept")


@_register("op11_pii")
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, added = F.col("base"), F.col("added")
    found = personal_data.find(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id", *[personal_data.count_of(base, k).alias(f"n_{k}") for k in personal_data.KINDS],
        F.sha2(personal_data.listed(base), 256).alias("base_sha256"),
        personal_data.listed(personal_data.all_spans(base, added)).alias("spans"), F.size(added).cast("long").alias("n_added"),
    )


_RUN_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@_register("op12_periodic_runs", f"""with {sql.CRC_TABLE},
docs as (select doc_id, {_RUN_WORDS} as o, {sql.crc32('cast(doc_id as varchar)')} as h from documents cross join crc_table),
looped as (select doc_id, o, len(o) as n, h % 10 = 0 and len(o) > 0 as loops, (h // 10) % greatest(len(o), 1) as a,
    1 + (len(o) - (h // 10) % greatest(len(o), 1)) // (3 + (h // 10) % 8) as p from docs),
texts as (select doc_id, n, case when loops then list_transform(range(n),
    lambda i: o[1 + case when i < a then i else a + (i - a) % p end]) else o end as w from looped),
words as (select doc_id, n, unnest(w) as x, unnest(range(n)) as i from texts),
lags as (select doc_id, n, w, unnest(range(1, n // 4 + 1)) as q from texts),
marks as (select doc_id, q, w, unnest(range(0, greatest((n - 1) // q - 2, 0))) as k from lags),
likely as (select distinct doc_id, q from marks where w[1 + k * q] = w[1 + k * q + q]
    and w[1 + k * q] = w[1 + k * q + 2 * q] and w[1 + k * q] = w[1 + k * q + 3 * q]),
same as (select l.doc_id, l.q, s.i, s.i - row_number() over (partition by l.doc_id, l.q order by s.i) as island
    from likely l join words s using (doc_id) join words t on t.doc_id = l.doc_id and t.i = s.i + l.q where s.x = t.x),
wide as (select doc_id, q, min(i) as start, count(*) + q as length from same group by doc_id, q, island
    having count(*) + q >= greatest(6, 4 * q)),
runs as (select * from wide r where not exists (select 1 from wide s where s.doc_id = r.doc_id and s.q < r.q
    and s.start <= r.start and s.start + s.length >= r.start + r.length)),
longest as (select distinct on (doc_id) * from runs order by doc_id, length desc, start, q),
listed as (select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' order by start, q) as t
    from runs group by doc_id),
gone as (select distinct doc_id, unnest(range(start + q, start + length)) as i from runs),
kept as (select w.doc_id, string_agg(x, ' ' order by w.i) as t from words w anti join gone using (doc_id, i) group by w.doc_id)
select d.doc_id, coalesce(n_runs, 0) as n_runs, l.start, l.length, cast(l.q as bigint) as period,
    cast(1000 * l.length // l.q as bigint) as exponent_milli, sha256(coalesce(r.t, '')) as runs_sha256,
    sha256(coalesce(k.t, '')) as collapsed_sha256
from texts d left join longest l using (doc_id) left join listed r using (doc_id) left join kept k using (doc_id)""")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = periodic_runs.detect(docs.select("doc_id", _looped(F.col("doc_id"), F.col("text")).alias("text")), keep=["doc_id"])
    runs = F.col("periodic.runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")]))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.floor(F.col("longest.length") * -1000 / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"),
    )


def _looped(key: Column, text: Column) -> Column:
    """The contract's texts: where a key's CRC-32 ends in 0, the words from place a on repeat those from a with period p."""
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, F.greatest(n, F.lit(1)))
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        loops = F.transform(places, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(loops, " ")).otherwise(text)

    # A lambda's variable holds the words, so that they are split once for a text.
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), repeat), F.lit(0))).otherwise(text)


def _vector_rounds() -> str:
    """The rounds of op13 in SQL, one after another."""
    def assigned(books: str) -> str:
        return f"""select p.position, p.part, p.weight, arg_min(b.entry, (d, b.entry)) as entry, min(d) as d from (
            select p.*, b.entry, list_sum(list_transform(list_zip(p.part, b.part), lambda z: (z[1] - z[2]) ** 2)) as d
            from parts p join {books} b using (position)) p join {books} b using (position, entry) group by 1, 2, 3"""

    steps = []
    for r in range(vector_codes.ROUNDS):
        steps.append(f"""near{r} as materialized ({assigned(f'books{r}')}),
books{r + 1} as materialized (select b.position, b.entry, coalesce(n.part, b.part) as part from books{r} b left join (
    select position, entry, list(cast(floor(s / w) as bigint) order by place) as part from (
        select position, entry, place, sum(value * weight) as s, sum(weight) as w from (select position, entry, weight,
            unnest(part) as value, unnest(range(len(part))) as place from near{r}) group by 1, 2, 3) group by 1, 2) n
    using (position, entry))""")
    return ",\n".join([*steps, f"near as materialized ({assigned(f'books{vector_codes.ROUNDS}')})"])


@_register("op13_vector_codes", f"""with
whole as (select vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as v
    from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
cut as (select vec_id, label, unnest(range(8)) as position, unnest(list_transform(range(8),
    lambda p: v[1 + p * (len(v) // 8) : (p + 1) * (len(v) // 8)])) as part from whole),
parts as materialized (select position, part, count(*) as weight from cut group by 1, 2),
books0 as materialized (select position, row_number() over (partition by position order by vec_id) - 1 as entry, part
    from cut where vec_id in (select vec_id from whole order by vec_id limit 16)),
{_vector_rounds()},
coded as (select vec_id, label, string_agg(printf('%02x', entry), '' order by position) as code, cast(sum(d) as bigint) as error
    from cut join near using (position, part) group by 1, 2),
digest as (select sha256(string_agg(array_to_string(part, ','), ',' order by position, entry)) as t from books{vector_codes.ROUNDS})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, t as codebooks_sha256
from coded cross join digest""")
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    books = vector_codes.fit(vectors)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = common.store(vector_codes.encode(vectors, books), "codes")
    of_label = common.stored_side(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
