
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtide.operators import (
    aggregates, chunks, combine, encode, histograms, learning, quantiles, reshape, select,
)
from flowtide.plans import dashboard, training
from flowtide.schema import (
    ENCODED_COLUMNS, ENCODED_FLOW, LABELLED_COLUMNS, LABELLED_FLOW, RAW_FLOW, TABLE_COLUMNS,
    TRAINING_COLUMNS, TRAINING_FLOW,
)
from flowtide.session import scratch_path
from flowtide.sources import files, topics
from flowtide.sources.events import FLOWS_SQL, RULE, flows_of, read_flows, stream_events
from flowtide.streaming import jobs, live

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

FLOW_ID = T.StructField("flow_id", T.LongType())
RAW_WITH_ID = T.StructType([FLOW_ID, *RAW_FLOW])
ENCODED_WITH_ID = T.StructType([FLOW_ID, *ENCODED_FLOW])
LABELLED_WITH_ID = T.StructType([FLOW_ID, *LABELLED_FLOW])
TRAINING_WITH_ID = T.StructType([FLOW_ID, *TRAINING_FLOW])
RAW_COLUMNS = [f.name for f in RAW_WITH_ID]


def _register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Flow times have no zone; a fixed session zone keeps their microseconds as they are.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return query(spark, sf_dir)

        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = _WITH + sql
        return query

    return add


# ---- SQL building blocks of the checks -------------------------------------------------------

_LABEL = """case when contains(Label, 'Background') then '0' when contains(Label, 'Normal') then '2'
     when contains(Label, 'Botnet') then '1' else Label end"""
_FILL = "(select quantile_disc(sTos, 0.5) from flows where not isnan(sTos))"


def _port(column: str) -> str:
    return f"""case when regexp_matches({column}, '^0[xX][0-9a-fA-F]+$') then try_cast({column} as int)
     when lower({column}) = 'nan' then null
     else cast(trunc(try_cast({column} as double)) as int) end"""


_COMPUTED = {
    "Label": _LABEL,
    "Proto_tcp": "coalesce(cast(Proto = 'tcp' as int), 0)",
    "Proto_udp": "coalesce(cast(Proto = 'udp' as int), 0)",
    "Proto_others": "coalesce(cast(Proto not in ('tcp', 'udp') as int), 0)",
    "Dir_one": "coalesce(cast(trim(Dir) = '<->' as int), 0)",
    "Dir_others": "coalesce(cast(trim(Dir) <> '<->' as int), 0)",
    "sTosone": f"cast(coalesce(sTos, {_FILL}) = 1.0 as int)",
    "sTos": f"coalesce(sTos, {_FILL})",
}


def _columns(names: list[str], **replaced: str) -> str:
    computed = {**_COMPUTED, **replaced}
    return ", ".join(f"{computed[c]} as {c}" if c in computed else c for c in names)


_TABLE_ROW = _columns(
    TABLE_COLUMNS,
    Sport=_port("Sport"),
    Dport=_port("Dport"),
    sTos=f"cast(coalesce(sTos, {_FILL}) as varchar)",
)

_WITH = f"""with flows as ({FLOWS_SQL.format(events='events')}),
latest100 as (select * from flows order by StartTime desc, flow_id desc limit 100),
latest300 as (select * from flows order by StartTime desc, flow_id desc limit 300),
latest1000 as (select * from flows order by StartTime desc, flow_id desc limit 1000),
latest5000 as (select * from flows order by StartTime desc, flow_id desc limit 5000),
numbered as (select *, row_number() over (order by StartTime, flow_id) - 1 as r from flows),
chunked as (select *, r // 10 as chunk, cast(r % 10 as int) as idx from numbered)
"""


# ---- Encoding --------------------------------------------------------------------------------

@_register("parse_start_time", "select flow_id, StartTime from flows")
def _parse_start_time(spark, sf_dir):
    time = F.col("StartTime")
    text = F.when(F.col("flow_id") % 2 == 0, time.cast("string")).otherwise(
        F.date_format(time, "yyyy/MM/dd HH:mm:ss.SSSSSS")
    )
    texts = read_flows(spark, sf_dir).select("flow_id", text.alias("StartTime"))
    return encode.parse_start_time(texts)


@_register("encode_label", f"select flow_id, {_LABEL} as Label from flows")
def _encode_label(spark, sf_dir):
    return encode.encode_label(read_flows(spark, sf_dir)).select("flow_id", "Label")


@_register("label_to_int", f"select flow_id, try_cast({_LABEL} as int) as Label from flows")
def _label_to_int(spark, sf_dir):
    coded = encode.encode_label(read_flows(spark, sf_dir))
    return encode.label_to_int(coded).select("flow_id", "Label")


@_register("proto_buckets",
           f"select flow_id, {_columns(['Proto_tcp', 'Proto_udp', 'Proto_others'])} from flows")
def _proto_buckets(spark, sf_dir):
    return encode.proto_buckets(read_flows(spark, sf_dir)).select(
        "flow_id", "Proto_tcp", "Proto_udp", "Proto_others"
    )


@_register("dir_buckets", f"select flow_id, {_columns(['Dir_one', 'Dir_others'])} from flows")
def _dir_buckets(spark, sf_dir):
    return encode.dir_buckets(read_flows(spark, sf_dir)).select("flow_id", "Dir_one", "Dir_others")


@_register("stos_indicator", f"select flow_id, {_columns(['sTosone'])} from flows")
def _stos_indicator(spark, sf_dir):
    flows = read_flows(spark, sf_dir)
    return encode.stos_indicator(flows, encode.fit_stos_fill(flows)).select("flow_id", "sTosone")


@_register("fill_missing",
           "select flow_id, coalesce(sTos, 7.0) as sTos, coalesce(dTos, 7.0) as dTos from flows")
def _fill_missing(spark, sf_dir):
    flows = read_flows(spark, sf_dir).select("flow_id", "sTos", "dTos")
    return encode.fill_missing(encode.fill_missing(flows, "sTos", 7.0), "dTos", 7.0)


@_register("cast_stos", "select flow_id, cast(sTos as varchar) as sTos from flows")
def _cast_stos(spark, sf_dir):
    text = encode.cast_stos(read_flows(spark, sf_dir), "string")
    return encode.cast_stos(encode.cast_stos(text, "double"), "string").select("flow_id", "sTos")


@_register("one_hot_proto", "select flow_id, " + ", ".join(
    f"coalesce(cast(Proto = '{v}' as int), 0) as Proto_{v}" for v in ("arp", "icmp", "tcp", "udp")
) + " from flows")
def _one_hot_proto(spark, sf_dir):
    hot = encode.one_hot(read_flows(spark, sf_dir), "Proto")
    return hot.select("flow_id", *[c for c in hot.columns if c.startswith("Proto_")])


@_register("one_hot_dir", "select flow_id, " + ", ".join(
    f"""coalesce(cast(trim(Dir) = '{v}' as int), 0) as "Dir_{v}" """
    for v in ("->", "<->", "<?>", "who")
) + " from flows")
def _one_hot_dir(spark, sf_dir):
    hot = encode.one_hot(read_flows(spark, sf_dir), "Dir", trim=True)
    return hot.select("flow_id", *[c for c in hot.columns if c.startswith("Dir_")])


@_register("one_hot_stos",
           """select flow_id, coalesce(cast(sTos = 1.0 as int), 0) as "sTos_1.0" from flows""")
def _one_hot_stos(spark, sf_dir):
    text = encode.cast_stos(read_flows(spark, sf_dir), "string")
    return encode.one_hot(text, "sTos", values=["1.0"]).select("flow_id", F.col("`sTos_1.0`"))


@_register("ensure_column", "select flow_id, StartTime, 0 as Proto_gre, Proto from flows")
def _ensure_column(spark, sf_dir):
    flows = read_flows(spark, sf_dir).select("flow_id", "StartTime", "Proto")
    return encode.ensure_column(encode.ensure_column(flows, "Proto_gre", 0, 2), "Proto", "-", 0)


@_register("normalize_ports",
           f"select flow_id, {_port('Sport')} as Sport, {_port('Dport')} as Dport from flows")
def _normalize_ports(spark, sf_dir):
    return encode.normalize_ports(read_flows(spark, sf_dir)).select("flow_id", "Sport", "Dport")


@_register("preprocess_flows", f"select flow_id, {_columns(ENCODED_COLUMNS)} from flows")
def _preprocess_flows(spark, sf_dir):
    flows = read_flows(spark, sf_dir)
    return encode.preprocess_flows(flows, encode.fit_stos_fill(flows), keep=["flow_id"])


@_register("preprocess_flows_training", f"select flow_id, {_columns(TRAINING_COLUMNS)} from flows")
def _preprocess_flows_training(spark, sf_dir):
    flows = read_flows(spark, sf_dir)
    fill = encode.fit_stos_fill(flows)
    return encode.preprocess_flows(flows, fill, layout="training", keep=["flow_id"])


@_register("with_train_flags",
           "select flow_id, true as isVal, cast(1.0 as double) as weight from flows")
def _with_train_flags(spark, sf_dir):
    return encode.with_train_flags(read_flows(spark, sf_dir).select("flow_id"), True)


@_register("assemble_features", "select flow_id, Dur as f0, cast(TotPkts as double) as f1, "
           "cast(TotBytes as double) as f2, cast(SrcBytes as double) as f3, "
           + ", ".join(f"cast({_COMPUTED[c]} as double) as f{i}" for i, c in enumerate(
               ["Proto_tcp", "Proto_udp", "Dir_one", "sTosone", "Proto_others", "Dir_others"], 4))
           + " from flows")
def _assemble_features(spark, sf_dir):
    encoded = learning.assemble_features(_preprocess_flows(spark, sf_dir))
    cells = learning.vector_to_array("features")
    return encoded.select("flow_id", *[cells[i].alias(f"f{i}") for i in range(10)])


@_register("prediction_name", """select flow_id, prediction, case prediction when 0 then 'Background'
    when 1 then 'Botnet' when 2 then 'Normal' end as category from flows""")
def _prediction_name(spark, sf_dir):
    return encode.with_prediction_name(read_flows(spark, sf_dir)).select(
        "flow_id", "prediction", "category"
    )


@_register("row_severity", """select flow_id, prediction, case prediction when 0 then 'yellow'
    when 1 then 'red' when 2 then 'green' end as severity from flows""")
def _row_severity(spark, sf_dir):
    return encode.with_severity(read_flows(spark, sf_dir)).select(
        "flow_id", "prediction", "severity"
    )


@_register("project_flow_columns",
           "select StartTime, SrcAddr, DstAddr, Proto, State, prediction from flows")
def _project_flow_columns(spark, sf_dir):
    return select.project_flow_columns(read_flows(spark, sf_dir), ["Proto", "State"])


# ---- Filters and newest rows -----------------------------------------------------------------

_SHOWN = "flow_id, StartTime, Dur, TotPkts, TotBytes, SrcBytes, Proto, SrcAddr, Sport, Dir, " \
         "DstAddr, Dport, State, sTos, dTos, prediction"
_START, _END = "2024-01-05 00:00:00", "2024-01-20 12:00:00"
_IN_RANGE = f"StartTime between timestamp '{_START}' and timestamp '{_END}'"


def _shown(df: DataFrame) -> DataFrame:
    return df.select(*_SHOWN.split(", "))


@_register("latest_flows", f"select {_SHOWN} from latest1000")
def _latest_flows(spark, sf_dir):
    return _shown(select.latest_flows(read_flows(spark, sf_dir), 1000))


@_register("flows_between", f"""select {_SHOWN} from flows where {_IN_RANGE}
    order by StartTime desc, flow_id desc limit 1000""")
def _flows_between(spark, sf_dir):
    return _shown(select.flows_between(read_flows(spark, sf_dir), _START, _END, 1000))


@_register("search_flows", f"""select StartTime, SrcAddr, DstAddr, Proto, Dport, prediction from flows
    where {_IN_RANGE} and prediction = 1 order by StartTime desc, flow_id desc limit 100""")
def _search_flows(spark, sf_dir):
    flows = read_flows(spark, sf_dir)
    return select.search_flows(flows, _START, _END, ["Proto", "Dport"], 1)


@_register("head_n", f"select {_SHOWN} from latest300")
def _head_n(spark, sf_dir):
    return _shown(reshape.head_n(read_flows(spark, sf_dir), 300))


@_register("isin_filter", f"""select {_SHOWN} from flows where DstAddr in (
    select DstAddr from flows group by DstAddr order by count(*) desc, DstAddr limit 10)""")
def _isin_filter(spark, sf_dir):
    return _shown(aggregates.isin_filter(read_flows(spark, sf_dir), "DstAddr", 10))


@_register("filter_attacks", f"select {_SHOWN} from flows where prediction = 1")
def _filter_attacks(spark, sf_dir):
    return _shown(select.filter_attacks(read_flows(spark, sf_dir)))


# ---- Joins, unions, splits -------------------------------------------------------------------

@_register("attach_predictions", f"select flow_id, {_columns(LABELLED_COLUMNS)} from flows")
def _attach_predictions(spark, sf_dir):
    flows = read_flows(spark, sf_dir)
    encoded = encode.preprocess_flows(flows, encode.fit_stos_fill(flows), keep=["flow_id"])
    joined = combine.attach_predictions(encoded, flows.select("flow_id", "prediction"))
    return joined.select("flow_id", *LABELLED_COLUMNS)


@_register("attach_predictions_bucketed", f"select flow_id, {_columns(LABELLED_COLUMNS)} from flows")
def _attach_predictions_bucketed(spark, sf_dir):
    """Both sides lie in the same buckets, so the join moves no rows."""
    flows = read_flows(spark, sf_dir)
    encoded = encode.preprocess_flows(flows, encode.fit_stos_fill(flows), keep=["flow_id"])
    mark = uuid.uuid4().hex
    sides = {f"encoded_{mark}": encoded, f"predictions_{mark}": flows.select("flow_id", "prediction")}
    for table, rows in sides.items():
        files.write_bucketed(rows, table, scratch_path(spark, table), buckets=8)
    return combine.attach_predictions(*map(spark.table, sides)).select("flow_id", *LABELLED_COLUMNS)


_SPLIT = """case when p < 70 then 'train' when p < 85 then 'validation' else 'test' end"""
_SPLITS = f"""(select *, {_SPLIT} as split from (select *,
    cast('0x' || md5(cast(flow_id as varchar) || ':42')[1:8] as bigint) % 100 as p from flows))"""


@_register("split_train_val_test", f"select flow_id, split from {_SPLITS}")
def _split_train_val_test(spark, sf_dir):
    return combine.with_split(read_flows(spark, sf_dir)).select("flow_id", "split")


@_register("union_train_val", f"""select flow_id, Dur, split = 'validation' as isVal,
    cast(1.0 as double) as weight from {_SPLITS} where split <> 'test'""")
def _union_train_val(spark, sf_dir):
    flows = read_flows(spark, sf_dir).select("flow_id", "Dur")
    train, validation, _ = combine.split_train_val_test(flows)
    return combine.union_train_val(train, validation)


@_register("distinct_values", "select distinct Proto from flows")
def _distinct_values(spark, sf_dir):
    return encode.distinct_values(read_flows(spark, sf_dir), "Proto")


# ---- Counts, shares, histograms --------------------------------------------------------------

_NAMES = "case prediction when 0 then 'Background' when 1 then 'Botnet' when 2 then 'Normal' end"


def _counts_sql(source: str) -> str:
    return f"select prediction, {_NAMES} as category, count(*) as n from {source} group by prediction"


def _metrics_sql(source: str) -> str:
    return f"""select count(*) as total_records, count(distinct SrcAddr) as unique_addresses,
        count(*) filter (where prediction = 1) as attacks_detected from {source}"""


def _top_sql(source: str, column: str) -> str:
    return f"""select value, n, round(n / sum(n) over (), 6) as share from (
        select {column} as value, count(*) as n from {source} where {column} is not null
        group by 1 order by n desc, value limit 10)"""


def _top_all_sql(source: str) -> str:
    parts = " union all ".join(
        f"select '{c}' as \"column\", cast({c} as varchar) as value from {source}"
        for c in aggregates.TOP_COLUMNS
    )
    return f"""select "column", value, n, rank, round(n / sum(n) over (partition by "column"), 6)
        as share from (select *, cast(row_number() over (partition by "column" order by n desc, value)
        as int) as rank from (select "column", value, count(*) as n from ({parts})
        where value is not null group by 1, 2)) where rank <= 10"""


def _histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""select bin, round(lo + bin * w, 6) as bin_start, round(lo + (bin + 1) * w, 6) as bin_end,
        count(*) as n from (select lo, w, cast(case when w = 0 then 0 else
        least(floor((x - lo) / w), {bins - 1}) end as int) as bin from (
        select cast({column} as double) as x, b.lo, (b.hi - b.lo) / {bins}.0::double as w from {source},
        (select cast(min({column}) as double) as lo, cast(max({column}) as double) as hi
         from {source}) b where {column} is not null)) group by bin, lo, w"""


def _protocol_sql(source: str) -> str:
    return f"""select cast((t - lo) // w as int) as bin,
        make_timestamp(lo + ((t - lo) // w) * w) as bin_start, Proto, count(*) as n
        from (select epoch_us(StartTime) as t, Proto, lo, (hi - lo) // 100 + 1 as w from {source},
        (select epoch_us(min(StartTime)) as lo, epoch_us(max(StartTime)) as hi from {source}))
        group by 1, 2, 3"""


def _correlation_sql(source: str) -> str:
    cells = " union all ".join(
        f"""select '{a}' as a, '{b}' as b, round(covar_pop({a}, {b})
        / nullif(stddev_pop({a}) * stddev_pop({b}), 0), 6) as r from {source}"""
        for a in aggregates.CORRELATED for b in aggregates.CORRELATED
    )
    return cells


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _panel_query(name: str, build, sql: Callable[[str], str], rounded: tuple[str, ...] = ()):
    """Register a panel over the whole table and over the newest 1000 and 5000 flows."""

    @_register(name, sql("flows"))
    def whole(spark, sf_dir):
        return _rounded(build(read_flows(spark, sf_dir)), *rounded)

    for n in (1000, 5000):
        @_register(f"{name}_latest_{n}", sql(f"latest{n}"))
        def newest(spark, sf_dir, n=n):
            return _rounded(build(dashboard.newest(read_flows(spark, sf_dir), n)), *rounded)


_panel_query("prediction_counts", aggregates.prediction_counts, _counts_sql)
_panel_query("dashboard_metrics", aggregates.dashboard_metrics, _metrics_sql)
_panel_query("top_values_all", aggregates.top_values_all, _top_all_sql, ("share",))
_panel_query("protocol_over_time", histograms.protocol_over_time, _protocol_sql)
_panel_query("duration_histogram", histograms.duration_histogram,
             lambda s: _histogram_sql(s, "Dur", 100), ("bin_start", "bin_end"))
_panel_query("totpkts_histogram", histograms.totpkts_histogram,
             lambda s: _histogram_sql(s, "TotPkts", 20), ("bin_start", "bin_end"))
_panel_query("correlation_matrix", aggregates.correlation_matrix, _correlation_sql, ("r",))

for _column in aggregates.TOP_COLUMNS:
    _panel_query(
        f"top_values_{_column.lower()}",
        lambda df, c=_column: aggregates.top_values(df, c),
        lambda s, c=_column: _top_sql(s, c),
        ("share",),
    )


@_register("dashboard_metrics_approx", """select count(*) as total_records, true as within,
    count(*) filter (prediction = 1) as attacks_detected from flows""")
def _dashboard_metrics_approx(spark, sf_dir):
    """The estimate lies within three standard errors (5 % each) of the exact number of addresses."""
    flows = read_flows(spark, sf_dir)
    return _within(aggregates.dashboard_metrics(flows, approximate=True), flows, 0.15)


def _within(estimated: DataFrame, flows: DataFrame, error: float) -> DataFrame:
    exact = aggregates.dashboard_metrics(flows).select(F.col("unique_addresses").alias("exact")).scalar()
    off = F.abs(F.col("unique_addresses") - exact)
    return estimated.select("total_records", (off <= error * exact).alias("within"), "attacks_detected")


@_register("labelled_metrics", """select count(*) as total_records, true as within,
    count(*) filter (prediction = 1) as attacks_detected from flows""")
def _labelled_metrics(spark, sf_dir):
    """Metrics of the stored table from its records; the estimate lies within three standard errors (1.6 % each)."""
    labelled, path = _labelled(spark, sf_dir), scratch_path(spark, "loads")
    for i in range(2):
        files.write_labelled(labelled.where(F.col("flow_id") % 2 == i), path)
    return _within(files.labelled_metrics(spark, path), read_flows(spark, sf_dir), 0.05)


@_register("duration_rug", "select Dur from flows where Dur is not null")
def _duration_rug(spark, sf_dir):
    return histograms.duration_rug(read_flows(spark, sf_dir))


@_register("category_metric", f"""select 'Botnet' as category, count(*) as n from (
    select prediction from flows where {_IN_RANGE} and prediction = 1
    order by StartTime desc, flow_id desc limit 100)""")
def _category_metric(spark, sf_dir):
    shown = select.search_flows(read_flows(spark, sf_dir), _START, _END, [], 1)
    return aggregates.category_metric(shown, 1)


@_register("column_median", """select (select quantile_disc(sTos, 0.5) from flows) as stos,
    (select quantile_disc(Dur, 0.5) from flows) as dur,
    (select quantile_disc(TotBytes, 0.5) from flows) as totbytes""")
def _column_median(spark, sf_dir):
    flows = read_flows(spark, sf_dir)
    medians = quantiles.column_medians(flows, ["sTos", "Dur", "TotBytes"])
    return spark.range(1).select(*[F.lit(v).cast(flows.schema[c].dataType).alias(c.lower()) for c, v in medians.items()])


_INFINITE = "case when flow_id % 50 = 0 then cast('Infinity' as double) else Dur end"
_FEW_INFINITE = f"(select flow_id, {_INFINITE} as Dur from flows)"


@_register("column_median_infinite", f"select quantile_disc(Dur, 0.5) as dur from {_FEW_INFINITE}")
def _column_median_infinite(spark, sf_dir):
    flows = read_flows(spark, sf_dir).withColumn("Dur", F.expr(_INFINITE))
    return spark.range(1).select(F.lit(quantiles.column_median(flows, "Dur")).alias("dur"))


@_register("duration_histogram_infinite",
           _histogram_sql(f"(select * from {_FEW_INFINITE} where not isinf(Dur))", "Dur", 100))
def _duration_histogram_infinite(spark, sf_dir):
    flows = read_flows(spark, sf_dir).withColumn("Dur", F.expr(_INFINITE))
    return _rounded(histograms.duration_histogram(flows), "bin_start", "bin_end")


@_register("column_median_approx", "select true as within")
def _column_median_approx(spark, sf_dir):
    """Ranks of the value found reach within the relative error of the middle one."""
    flows = read_flows(spark, sf_dir)
    value = quantiles.column_median(flows, "sTos", rel_error=0.25)
    known = flows.where("sTos is not null and not isnan(sTos)")
    ranks = known.agg(F.count("*").alias("n"), F.count_if(F.col("sTos") < value).alias("below"), F.count_if(F.col("sTos") <= value).alias("upto"))
    return ranks.select(((F.col("below") <= 0.75 * F.col("n")) & (F.col("upto") >= 0.25 * F.col("n"))).alias("within"))


@_register("accuracy", f"""select count(c) as n, round(avg(c), 6) as accuracy from (
    select cast(prediction = try_cast({_LABEL} as int) as double) as c from flows)""")
def _accuracy(spark, sf_dir):
    labelled = encode.encode_label(read_flows(spark, sf_dir))
    return _rounded(aggregates.accuracy(labelled), "accuracy")


@_register("confusion_counts", f"""select try_cast({_LABEL} as int) as Label, prediction,
    count(*) as n from flows group by 1, 2""")
def _confusion_counts(spark, sf_dir):
    return aggregates.confusion_counts(encode.encode_label(read_flows(spark, sf_dir)))


# ---- Series ----------------------------------------------------------------------------------

@_register("network_activity", """select StartTime, 'TotPkts' as metric, TotPkts as value from latest100
    union all select StartTime, 'TotBytes', TotBytes from latest100""")
def _network_activity(spark, sf_dir):
    return reshape.network_activity(read_flows(spark, sf_dir))


@_register("packet_series", "select StartTime, TotPkts from latest300")
def _packet_series(spark, sf_dir):
    return reshape.packet_series(read_flows(spark, sf_dir))


@_register("byte_series", "select StartTime, TotBytes from latest300")
def _byte_series(spark, sf_dir):
    return reshape.byte_series(read_flows(spark, sf_dir))


@_register("duration_scatter", "select StartTime, Dur from flows")
def _duration_scatter(spark, sf_dir):
    return reshape.duration_scatter(read_flows(spark, sf_dir))


_PAIRED = ["Dur", "TotPkts", "TotBytes"]


@_register("pair_points", " union all ".join(
    f"""select flow_id, prediction, '{a}' as x_name, '{b}' as y_name, cast({a} as double) as x,
    cast({b} as double) as y from flows""" for a in _PAIRED for b in _PAIRED))
def _pair_points(spark, sf_dir):
    return reshape.pair_points(read_flows(spark, sf_dir), _PAIRED)


@_register("pair_points_latest_5000", " union all ".join(
    f"""select flow_id, prediction, '{a}' as x_name, '{b}' as y_name, cast({a} as double) as x,
    cast({b} as double) as y from latest5000""" for a in _PAIRED for b in _PAIRED))
def _pair_points_latest(spark, sf_dir):
    return reshape.pair_points(select.newest(read_flows(spark, sf_dir), 5000), _PAIRED)


# ---- Messages --------------------------------------------------------------------------------

def _raw(spark, sf_dir) -> DataFrame:
    return read_flows(spark, sf_dir).select(*RAW_COLUMNS)


def _packed(spark, sf_dir) -> DataFrame:
    return chunks.pack_chunks(chunks.assign_chunks(_raw(spark, sf_dir)))


# A port that reads NaN is a missing one and comes back from a file or message as null.
_SENT = "nullif(Sport, 'NaN')"
_RAW_BACK = ", ".join(f"{_SENT} as Sport" if c == "Sport" else c for c in RAW_COLUMNS)


@_register("assign_chunks", "select flow_id, chunk, idx from chunked")
def _assign_chunks(spark, sf_dir):
    flows = read_flows(spark, sf_dir).select("flow_id", "StartTime")
    return chunks.assign_chunks(flows).select("flow_id", "chunk", "idx")


_PACKED = """select cast(chunk as varchar) as key, count(*) as n_rows,
    cast(min(flow_id) filter (where idx = 0) as varchar) as first_id,
    max(Dport) filter (where idx = 3) as fourth_dport from chunked group by chunk"""


@_register("pack_chunks", _PACKED)
def _pack_chunks(spark, sf_dir):
    return _facts(_packed(spark, sf_dir))


@_register("pack_flows", _PACKED)
def _pack_flows(spark, sf_dir):
    return _facts(chunks.pack_flows(_raw(spark, sf_dir)))


def _facts(messages: DataFrame) -> DataFrame:
    part = lambda path: F.get_json_object("value", path)
    return messages.select(
        "key",
        F.size(F.map_keys(F.from_json(part("$.StartTime"), "map<string,string>"))).cast("long")
        .alias("n_rows"),
        part("$.flow_id.0").alias("first_id"),
        part("$.Dport.3").alias("fourth_dport"),
    )


@_register("unpack_chunks", f"select cast(chunk as varchar) as key, idx, {_RAW_BACK} from chunked")
def _unpack_chunks(spark, sf_dir):
    return chunks.unpack_chunks(_packed(spark, sf_dir), RAW_WITH_ID)


@_register("encode_row_json", f"select {_RAW_BACK} from flows")
def _encode_row_json(spark, sf_dir):
    messages = chunks.encode_row_json(_raw(spark, sf_dir), key="flow_id")
    return chunks.decode_row_json(messages, RAW_WITH_ID)


@_register("rejected_messages", """select cast(chunk as varchar) as key,
    cast(count(*) filter (where chunk % 7 <> 0) as bigint) as n_rows, chunk % 7 = 0 as rejected
    from chunked group by chunk""")
def _rejected_messages(spark, sf_dir):
    """Each seventh message is cut off; it ends in the reject stream, the others as rows."""
    cut = F.col("key").cast("long") % 7 == 0
    sent = _packed(spark, sf_dir).withColumn(
        "value", F.when(cut, F.substring("value", 1, 20)).otherwise(F.col("value"))
    )
    stream = _message_stream(spark, sent)
    out, encoded = scratch_path(spark, "rejects"), scratch_path(spark, "encoded")
    jobs.run_reject_stream(
        stream, "parquet", {"path": out}, scratch_path(spark, "checkpoint")
    ).awaitTermination()
    jobs.run_preprocess_stream(
        stream, 0.0, "parquet", {"path": encoded}, scratch_path(spark, "checkpoint"),
        layout=RAW_WITH_ID, encoded_as=jobs.CHUNKS,
    ).awaitTermination()
    rows = chunks.unpack_chunks(spark.read.parquet(encoded), ENCODED_FLOW)
    good = rows.groupBy("key").agg(F.count("*").alias("n_rows")).withColumn("rejected", F.lit(False))
    bad = spark.read.parquet(out).select(
        "key", F.lit(0).cast("long").alias("n_rows"), F.lit(True).alias("rejected")
    )
    return good.unionByName(bad)


@_register("first_per_chunk", f"select chunk, idx, {', '.join(RAW_COLUMNS)} from chunked where idx = 0")
def _first_per_chunk(spark, sf_dir):
    return chunks.first_per_chunk(chunks.assign_chunks(_raw(spark, sf_dir)))


# ---- Files -----------------------------------------------------------------------------------

@_register("read_raw_flows", f"select {_RAW_BACK} from flows")
def _read_raw_flows(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    files.write_flows(_raw(spark, sf_dir), path)
    return files.read_raw_flows(spark, path, RAW_WITH_ID)


# Cells that a log may hold by mistake: durations that are no numbers, counts with a unit, times that are none.
_SPOILT = {
    "Dur": "flow_id % 11 = 0 and Dur is not null", "TotPkts": "flow_id % 13 = 0 and TotPkts is not null",
    "StartTime": "flow_id % 17 = 0",
}
_IN_QUARANTINE = " union all ".join(f"select '{c}' as bad, flow_id from flows where {w}" for c, w in _SPOILT.items())


def _spoilt(spark, sf_dir) -> DataFrame:
    """Raw flows as text with those cells spoilt."""
    raw = _raw(spark, sf_dir)
    return raw.select(*[
        F.when(F.expr(_SPOILT[c]), F.lit("x!")).otherwise(F.col(c).cast("string")).alias(c) if c in _SPOILT else F.col(c)
        for c in raw.columns
    ])


@_register("quarantined_cells", f"""select bad as "column", 'x!' as cell, count(*) as n, sum(flow_id) as ids,
    true as adds_up from ({_IN_QUARANTINE}) group by 1""")
def _quarantined_cells(spark, sf_dir):
    """Spoilt cells of logs by column; accepted, missing and quarantined cells make up all that were written."""
    path = scratch_path(spark, "spoilt-csv")
    files.write_flows(_spoilt(spark, sf_dir), path)
    bad = files.read_quarantined(spark, path, RAW_WITH_ID)
    ids = F.from_csv("row_text", F.lit("flow_id long")).getField("flow_id")
    kinds = bad.groupBy("column", "cell").agg(F.count("*").alias("n"), F.sum(ids).alias("ids"))
    counts = lambda df: df.agg(*[F.count(c).alias(c) for c in _SPOILT])
    both = counts(_raw(spark, sf_dir).select(*_SPOILT)).unpivot([], list(_SPOILT), "of", "written").join(
        counts(files.read_raw_flows(spark, path, RAW_WITH_ID)).unpivot([], list(_SPOILT), "of", "accepted"), "of"
    )
    return kinds.join(both, F.col("column") == F.col("of")).select(
        "column", "cell", "n", "ids", (F.col("accepted") + F.col("n") == F.col("written")).alias("adds_up")
    )


@_register("quarantined_chunk_cells", f"""select cast(chunk as varchar) as key, idx, bad as "column", 'x!' as cell
    from ({_IN_QUARANTINE}) join chunked using (flow_id)""")
def _quarantined_chunk_cells(spark, sf_dir):
    """The same of chunk messages, by a stream that runs beside the stage."""
    raw = _raw(spark, sf_dir)
    spoilt = _spoilt(spark, sf_dir).select("flow_id", *[F.col(c).alias(f"{c}_") for c in _SPOILT])
    numbered = chunks.assign_chunks(raw).join(spoilt, "flow_id")
    sent = chunks.pack_chunks(numbered.select(*[F.col(f"{c}_").alias(c) if c in _SPOILT else c for c in [*raw.columns, chunks.CHUNK, chunks.IDX]]))
    out = scratch_path(spark, "quarantine")
    jobs.run_quarantine_stream(
        _message_stream(spark, sent), "parquet", {"path": out}, scratch_path(spark, "checkpoint"), layout=RAW_WITH_ID
    ).awaitTermination()
    cells = F.from_json("value", "key string, idx int, column string, cell string")
    return spark.read.parquet(out).select(cells.alias("c")).select("c.*")


@_register("read_training_flows",
           f"select flow_id, {_columns(TRAINING_COLUMNS, Sport=_SENT)} from flows")
def _read_training_flows(spark, sf_dir):
    path = scratch_path(spark, "training-csv")
    files.write_training_flows(_preprocess_flows_training(spark, sf_dir), path)
    return files.read_training_flows(spark, path, TRAINING_WITH_ID)


def _labelled(spark, sf_dir) -> DataFrame:
    flows = read_flows(spark, sf_dir)
    return encode.preprocess_flows(flows, encode.fit_stos_fill(flows), keep=["flow_id", "prediction"])


def _table(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "labelled")
    files.write_labelled(_labelled(spark, sf_dir), path)
    return files.read_labelled(spark, path)


@_register("read_labelled", f"select {_TABLE_ROW}, cast(StartTime as date) as dt from flows")
def _read_labelled(spark, sf_dir):
    return _table(spark, sf_dir)


@_register("latest_flows_of_table", f"""select {_TABLE_ROW} from flows
    order by StartTime desc limit 5000""")
def _latest_flows_of_table(spark, sf_dir):
    path = scratch_path(spark, "labelled")
    files.write_labelled(_labelled(spark, sf_dir), path)
    return files.newest_labelled(spark, path, 5000).drop("dt")


@_register("compact_labelled", f"select {_TABLE_ROW}, cast(StartTime as date) as dt from flows")
def _compact_labelled(spark, sf_dir):
    """Four loads, one of them at first with other rows, merged and tidied; the table holds each flow once."""
    labelled, path = _labelled(spark, sf_dir), scratch_path(spark, "loads")
    for i in range(4):
        files.write_labelled(labelled.where(F.col("flow_id") % 4 == i), path, load=f"l{i if i else 1}")
    files.compact_labelled(spark, path)
    files.write_labelled(labelled.where(F.col("flow_id") % 4 < 2), path, load="l1")
    files.compact_labelled(spark, path)
    files.tidy_labelled(spark, path, keep_hours=0)
    return files.read_labelled(spark, path)


@_register("table_between", f"""select {_TABLE_ROW} from flows where {_IN_RANGE}""")
def _table_between(spark, sf_dir):
    """A time range of the table: records choose the files, statistics the row groups."""
    path = scratch_path(spark, "labelled")
    files.write_labelled(_labelled(spark, sf_dir), path)
    found = files.read_labelled(spark, path, _START, _END)
    return found.where(F.col("StartTime").between(F.lit(str(_START)).cast("timestamp_ntz"), F.lit(str(_END)).cast("timestamp_ntz"))).drop("dt")


@_register("network_activity_of_table", """select StartTime, 'TotPkts' as metric, TotPkts as value
    from latest100 union all select StartTime, 'TotBytes', TotBytes from latest100""")
def _network_activity_of_table(spark, sf_dir):
    return reshape.network_activity(_table(spark, sf_dir))


@_register("packet_series_of_table", "select StartTime, TotPkts from latest300")
def _packet_series_of_table(spark, sf_dir):
    return reshape.packet_series(_table(spark, sf_dir))


def _with_bounds(spark, sf_dir, panel: str, *rounded: str) -> DataFrame:
    """A panel over the whole table, its range taken from the table's records."""
    path = scratch_path(spark, "labelled")
    files.write_labelled(_labelled(spark, sf_dir), path)
    bounds = files.labelled_bounds(spark, path)
    return _rounded(dashboard.panels(files.read_labelled(spark, path), bounds)[panel], *rounded)


@_register("duration_histogram_of_table", _histogram_sql("flows", "Dur", 100))
def _duration_histogram_of_table(spark, sf_dir):
    return _with_bounds(spark, sf_dir, "duration_histogram", "bin_start", "bin_end")


@_register("totpkts_histogram_of_table", _histogram_sql("flows", "TotPkts", 20))
def _totpkts_histogram_of_table(spark, sf_dir):
    return _with_bounds(spark, sf_dir, "totpkts_histogram", "bin_start", "bin_end")


@_register("protocol_over_time_of_table", _protocol_sql("flows"))
def _protocol_over_time_of_table(spark, sf_dir):
    return _with_bounds(spark, sf_dir, "protocol_over_time")


@_register("search_panel", f"""select StartTime, SrcAddr, DstAddr, Dport, prediction,
    'green' as severity, count(*) over () as shown from (select {_TABLE_ROW} from flows
    where {_IN_RANGE} and prediction = 2 order by StartTime desc limit 100)""")
def _search_panel(spark, sf_dir):
    panel = dashboard.search_panel(_table(spark, sf_dir), _START, _END, ["Dport"], 2)
    return panel["rows"].withColumn("shown", panel["shown"].scalar())


@_register("search_table", f"""select StartTime, SrcAddr, DstAddr, Dport, prediction from (
    select {_TABLE_ROW} from flows) where {_IN_RANGE} and prediction = 2
    order by StartTime desc limit 100""")
def _search_table(spark, sf_dir):
    return select.search_flows(_table(spark, sf_dir), _START, _END, ["Dport"], 2)


# ---- Learning --------------------------------------------------------------------------------

# Classes that follow from the protocol, so that a fitted model's rows are known.
_BY_PROTO = "case Proto when 'tcp' then {} when 'udp' then {} else {} end"


def _learnable(spark, sf_dir) -> DataFrame:
    label = F.expr(_BY_PROTO.format("'Botnet'", "'Normal'", "'Background'"))
    return read_flows(spark, sf_dir).drop("prediction").withColumn("Label", label)


@_register("train_flow_classifier", f"select count(*) as n, cast(1.0 as double) as accuracy from {_SPLITS} where split = 'test'")
def _train_flow_classifier(spark, sf_dir):
    """Labels follow from the protocol, so every flow of the test split is predicted right."""
    return training.train_from_flows(_learnable(spark, sf_dir)).evaluation


def _rule_model() -> SQLTransformer:
    """A model with a fixed rule, so that scored rows and streams can be checked exactly."""
    return SQLTransformer(statement=f"SELECT *, {RULE} AS prediction FROM __THIS__")


@_register("score_flows", f"select flow_id, {_columns(LABELLED_COLUMNS)} from flows")
def _score_flows(spark, sf_dir):
    return learning.score_flows(_preprocess_flows(spark, sf_dir), _rule_model())


@_register("evaluate_flows", f"""select count(c) as n, round(avg(c), 6) as accuracy from (
    select cast(prediction = try_cast({_LABEL} as int) as double) as c from flows)""")
def _evaluate_flows(spark, sf_dir):
    evaluation = learning.evaluate_flows(_preprocess_flows(spark, sf_dir), _rule_model())
    return _rounded(evaluation, "accuracy")


def _scored(spark, flows: DataFrame, **options) -> DataFrame:
    """Flows scored by a model that was fitted, saved and loaded; they carry other predictions before."""
    trained = training.train_from_flows(flows, **options)
    path = scratch_path(spark, "model")
    files.save_model(trained.model, path)
    encoded = encode.preprocess_flows(flows, trained.stos_fill, keep=["flow_id"])
    return learning.score_flows(encoded.withColumn("prediction", F.lit(7)), files.load_model(path))


_LEARNT = _BY_PROTO.format("'1'", "'2'", "'0'")
_SCORED = f"""select flow_id, {_columns(LABELLED_COLUMNS, Label=_LEARNT, prediction=_BY_PROTO.format(1, 2, 0))} from flows"""


@_register("score_flows_forest", _SCORED)
def _score_flows_forest(spark, sf_dir):
    return _scored(spark, _learnable(spark, sf_dir))


@_register("score_flows_boosted")
def _score_flows_boosted(spark, sf_dir):
    """On the tables' own labels: those by protocol keep the loss falling, so early stopping would have no part in it."""
    return _scored(spark, read_flows(spark, sf_dir), method="boosted")


# ---- Streams ---------------------------------------------------------------------------------

def _message_stream(spark, messages: DataFrame) -> DataFrame:
    path = scratch_path(spark, "messages")
    # Messages lie in several files, as those of a topic lie in several partitions.
    messages.repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    return topics.stream_flows(spark, "parquet", {}, path)


def _preprocessed(spark, sf_dir, stos_fill, **options) -> DataFrame:
    """Encoded messages that a stream made of chunk messages."""
    out = scratch_path(spark, "encoded")
    jobs.run_preprocess_stream(
        _message_stream(spark, _packed(spark, sf_dir)), stos_fill, "parquet", {"path": out},
        scratch_path(spark, "checkpoint"), layout=RAW_WITH_ID, keep=["flow_id"], **options,
    ).awaitTermination()
    return spark.read.parquet(out).select("key", "value")


@_register("run_preprocess_stream",
           f"select flow_id, {_columns(ENCODED_COLUMNS, Sport=_SENT)} from flows")
def _run_preprocess_stream(spark, sf_dir):
    fill = encode.fit_stos_fill(read_flows(spark, sf_dir))
    return chunks.decode_row_json(_preprocessed(spark, sf_dir, fill), ENCODED_WITH_ID)


@_register("run_preprocess_stream_chunks",
           f"select flow_id, {_columns(ENCODED_COLUMNS, Sport=_SENT)} from flows")
def _run_preprocess_stream_chunks(spark, sf_dir):
    fill = encode.fit_stos_fill(read_flows(spark, sf_dir))
    messages = _preprocessed(spark, sf_dir, fill, encoded_as=jobs.CHUNKS)
    return jobs.decode_encoded(messages, jobs.CHUNKS, ENCODED_WITH_ID)


@_register("batch_median_fill",
           f"select flow_id, {_columns(ENCODED_COLUMNS, Sport=_SENT)} from flows")
def _batch_median_fill(spark, sf_dir):
    messages = _preprocessed(spark, sf_dir, jobs.BATCH_MEDIAN)
    return chunks.decode_row_json(messages, ENCODED_WITH_ID)


@_register("batch_median_fill_chunks",
           f"select flow_id, {_columns(ENCODED_COLUMNS, Sport=_SENT)} from flows")
def _batch_median_fill_chunks(spark, sf_dir):
    messages = _preprocessed(spark, sf_dir, jobs.BATCH_MEDIAN, encoded_as=jobs.CHUNKS)
    return jobs.decode_encoded(messages, jobs.CHUNKS, ENCODED_WITH_ID)


@_register("message_median_fill", f"""select flow_id, sTos, cast(sTos = 1.0 as int) as sTosone
    from (select c.flow_id, coalesce(c.sTos, m.fill, 0.0) as sTos from chunked c join (
    select chunk, quantile_disc(sTos, 0.5) as fill from chunked group by chunk) m
    on c.chunk = m.chunk)""")
def _message_median_fill(spark, sf_dir):
    messages = _preprocessed(spark, sf_dir, jobs.MESSAGE_MEDIAN)
    rows = chunks.decode_row_json(messages, ENCODED_WITH_ID)
    return rows.select("flow_id", "sTos", "sTosone")


def _labelled_messages(spark, sf_dir) -> DataFrame:
    """Labelled row messages that a stream made of encoded row messages."""
    encoded = chunks.encode_row_json(_preprocess_flows(spark, sf_dir))
    out = scratch_path(spark, "scored")
    jobs.run_score_stream(
        _message_stream(spark, encoded), _rule_model(), "parquet", {"path": out},
        scratch_path(spark, "checkpoint"), layout=ENCODED_WITH_ID,
    ).awaitTermination()
    return spark.read.parquet(out)


@_register("run_score_stream",
           f"select flow_id, {_columns(LABELLED_COLUMNS, Sport=_SENT)} from flows")
def _run_score_stream(spark, sf_dir):
    return chunks.decode_row_json(_labelled_messages(spark, sf_dir), LABELLED_WITH_ID)


@_register("stream_sink_table", f"select {_TABLE_ROW}, cast(StartTime as date) as dt from flows")
def _stream_sink_table(spark, sf_dir):
    out = scratch_path(spark, "streamed-table")
    jobs.stream_sink_table(
        _message_stream(spark, _labelled_messages(spark, sf_dir)), out,
        scratch_path(spark, "checkpoint"),
    ).awaitTermination()
    return files.read_labelled(spark, out)


@_register("run_fused_stream",
           f"select {_TABLE_ROW}, cast(StartTime as date) as dt from flows")
def _run_fused_stream(spark, sf_dir):
    fill = encode.fit_stos_fill(read_flows(spark, sf_dir))
    out = scratch_path(spark, "fused-table")
    jobs.run_fused_stream(
        _message_stream(spark, _packed(spark, sf_dir)), fill, _rule_model(), out,
        scratch_path(spark, "checkpoint"),
    ).awaitTermination()
    return files.read_labelled(spark, out)


@_register("table_of_both_loads", f"select {_TABLE_ROW}, cast(StartTime as date) as dt from flows")
def _table_of_both_loads(spark, sf_dir):
    """Half of the flows come by a stream and half by a batch, into one table."""
    labelled = _labelled(spark, sf_dir)
    streamed = F.col("flow_id") % 2 == 0
    messages = chunks.encode_row_json(labelled.where(streamed).drop("flow_id"))
    out = scratch_path(spark, "both-loads")
    jobs.stream_sink_table(
        _message_stream(spark, messages), out, scratch_path(spark, "checkpoint")
    ).awaitTermination()
    files.write_labelled(labelled.where(~streamed), out)
    return files.read_labelled(spark, out)


@_register("run_fused_stream_fitted", f"""select {_TABLE_ROW}, cast(StartTime as date) as dt
    from (select * replace ({_BY_PROTO.format(1, 2, 0)} as prediction) from flows)""")
def _run_fused_stream_fitted(spark, sf_dir):
    """A model that was fitted, saved and loaded scores a stream of raw messages into the table."""
    trained = training.train_from_flows(_learnable(spark, sf_dir))
    path, out = scratch_path(spark, "model"), scratch_path(spark, "fitted-table")
    files.save_model(trained.model, path)
    jobs.run_fused_stream(
        _message_stream(spark, _packed(spark, sf_dir)), trained.stos_fill, files.load_model(path),
        out, scratch_path(spark, "checkpoint"),
    ).awaitTermination()
    return files.read_labelled(spark, out)


@_register("batch_accuracy", f"""select 0 as batch_id, count(c) as n, round(avg(c), 6) as accuracy
    from (select cast(prediction = try_cast({_LABEL} as int) as double) as c from flows)""")
def _batch_accuracy(spark, sf_dir):
    out = scratch_path(spark, "accuracy")
    stream = chunks.decode_row_json(
        _message_stream(spark, _labelled_messages(spark, sf_dir)), LABELLED_FLOW
    )
    jobs.batch_accuracy_stream(stream, out, scratch_path(spark, "checkpoint")).awaitTermination()
    return _rounded(spark.read.parquet(out), "accuracy")


@_register("observed_batches", f"""select 0 as batch_id, count(*) as messages, count(*) filter (flow_id % 7 = 0) as broken,
    count(*) filter (flow_id % 7 <> 0 and flow_id % 5 = 0) as unfit_cells,
    count(c) filter (flow_id % 7 <> 0) as n, round(avg(c) filter (flow_id % 7 <> 0), 6) as accuracy
    from (select *, cast(prediction = try_cast({_LABEL} as int) as double) as c from flows)""")
def _observed_batches(spark, sf_dir):
    """Some messages are cut off, some have a cell that is no number; the scoring pass itself reports all figures."""
    encoded = _preprocess_flows(spark, sf_dir).withColumn(
        "dTos", F.when(F.col("flow_id") % 5 == 0, F.lit("x!")).otherwise(F.col("dTos").cast("string"))
    )
    sent = chunks.encode_row_json(encoded, key="flow_id")
    cut = F.when(F.col("key").cast("long") % 7 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    out = scratch_path(spark, "labelled")
    query = jobs.run_score_stream(
        _message_stream(spark, sent.withColumn("value", cut)), _rule_model(), "parquet", {"path": out},
        scratch_path(spark, "checkpoint"), layout=ENCODED_WITH_ID, observe=True,
    )
    query.awaitTermination()
    found = spark.createDataFrame(
        [(m["batch_id"], m["messages"], m["broken"], m["unfit_cells"], m["n"], m["accuracy"]) for m in jobs.batch_metrics(query)],
        "batch_id int, messages long, broken long, unfit_cells long, n long, accuracy double",
    )
    return _rounded(found, "accuracy")


@_register("live_flow_counts", """select time_bucket(interval '6 hours', StartTime) as window_start, Proto,
    prediction, count(*) as n from flows group by 1, 2, 3""")
def _live_flow_counts(spark, sf_dir):
    out = scratch_path(spark, "live")
    live.run_live_counts(
        flows_of(stream_events(spark, sf_dir)), out, scratch_path(spark, "checkpoint"),
        width="6 hours",
    ).awaitTermination()
    return live.read_live_counts(spark, out)


# ---- The training-data operators, where their subpackage is installed -------------------------

try:
    from flowtide.llm import queries as llm_queries
except ImportError:
    pass
else:
    _QUERIES.update(llm_queries.QUERIES)
    _ORACLES.update(llm_queries.ORACLES)

try:
    import corpus_pipeline
except ImportError:
    pass
else:
    _QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        _ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


# ---- The three functions of the contract -----------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return aggregates.prediction_counts(_labelled(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """The same results in SQL, for every query but fitted models and approximate values."""
    return dict(_ORACLES)
