"""Flows derived from the ``events`` table.

The text is plain SQL that Spark and DuckDB both run, so a query and its check start from the same
rows. ``prediction`` follows a fixed rule and stands in for a model where results must be exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RULE = """
  case when Proto = 'arp' and TotBytes % 4 = 0 then 1
       when Proto = 'tcp' and TotPkts % 5 = 0 then 2
       else 0 end"""

FLOWS_SQL = """
select f.*, """ + RULE + """ as prediction
from (
  select event_id as flow_id, ts as StartTime, value as Dur,
    1 + k as TotPkts,
    cast(60 * (1 + k) + floor(value * 10) as bigint) as TotBytes,
    60 * (1 + (k * 7 + event_id) % (1 + k)) as SrcBytes,
    case event_type when 'click' then 'tcp' when 'view' then 'udp' when 'purchase' then 'tcp'
                    when 'signup' then 'icmp' else 'arp' end as Proto,
    concat('147.32.84.', cast(user_id % 251 as string)) as SrcAddr,
    case when event_type = 'signup' then concat('0x', lower(hex(1000 + k)))
         when event_type = 'error' and k % 2 = 0 then 'NaN'
         when event_type = 'error' then cast(null as string)
         else cast(1024 + event_id % 50000 as string) end as Sport,
    case event_id % 6 when 0 then '   ->' when 1 then '  <->' when 2 then '<->'
                      when 3 then '  <?>' when 4 then '  who' else cast(null as string) end as Dir,
    concat('10.0.', cast(k % 16 as string), '.', cast(event_id % 200 as string)) as DstAddr,
    case k % 6 when 0 then '80' when 1 then '443.0' when 2 then '53' when 3 then '22'
               when 4 then '0x0105' else cast(2000 + k as string) end as Dport,
    case k % 3 when 0 then 'CON' when 1 then 'FSPA_FSPA' else 'INT' end as State,
    case event_id % 9 when 0 then cast(null as double) when 1 then 1.0 when 2 then 2.0
                      when 3 then 3.0 when 4 then 192.0 else 0.0 end as sTos,
    case event_id % 11 when 0 then cast(null as double) else 0.0 end as dTos,
    case when event_type = 'error' and k % 4 = 0 then 'flow=From-Botnet-V42-TCP-Attempt'
         when event_type = 'purchase' and k % 3 = 0 then 'flow=From-Normal-V42-Stribrek'
         when k = 97 then cast(null as string) when k = 96 then 'flow=Unknown'
         else 'flow=Background-TCP-Established' end as Label
  from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from {events}) e
) f
"""


def read_flows(spark: SparkSession, data_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{data_dir}/events.parquet")
    return flows_of(events)


def stream_events(spark: SparkSession, data_dir: str) -> DataFrame:
    """The same table as a stream, whether it is one file or a folder of files."""
    schema = spark.read.parquet(f"{data_dir}/events.parquet").schema
    # A streaming path must be a folder or, as here, a pattern.
    return spark.readStream.schema(schema).parquet(f"{data_dir}/event[s].parquet")


def flows_of(events: DataFrame) -> DataFrame:
    """Works on a batch and on a stream of events alike."""
    return events.sparkSession.sql(FLOWS_SQL, events=events)
