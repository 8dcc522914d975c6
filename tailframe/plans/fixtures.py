"""The operators' input tables as views over the given tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CHUNKS = """
select concat('db-', cast(conv_id % 4 as string)) as instance_id,
       case conv_id % 3 when 0 then 'postgres' when 1 then 'mysql' else 'mariadb' end as engine,
       concat(case conv_id % 3 when 0 then 'error/postgresql.log.' when 1 then 'slowquery/mysql-slowquery.log.' else 'general/mariadb-general.log.' end, cast(conv_id as string)) as log_file,
       chunk_no,
       case when chunk_no = 1 then '0' else concat('m', cast(turn as string)) end as prev_marker,
       case when next_turn is null then 'tail' else concat('m', cast(next_turn as string)) end as next_marker,
       text as data,
       next_turn is not null as additional_pending,
       timestamp '2024-01-01 00:00:00' + interval '1' minute * chunk_no as fetched_at
from (select conv_id, turn, text, row_number() over (partition by conv_id order by turn) as chunk_no, lead(turn) over (partition by conv_id order by turn) as next_turn from {conversations}) c
"""

POLLS = """
select source as instance_id,
       case cast(regexp_extract(source, '([0-9]+)', 1) as int) % 4 when 0 then 'postgres' when 1 then 'mysql' when 2 then 'mariadb' else 'unknown' end as engine,
       case cast(floor(doc_id / 20) as bigint) % 10
         when 0 then 'error/postgresql.log' when 1 then 'error/POSTGRES.LOG.old' when 2 then 'error/mysql-error.log' when 3 then 'slowquery/mysql-slowquery.log'
         when 4 then 'general/x.log' when 5 then 'audit/server_audit.log' when 6 then 'mariadb-general.log' when 7 then 'a/b/postgresql.log.1'
         when 8 then 'other/something.txt' else 'error/postgresql.log.2' end as log_file,
       doc_id as poll_id,
       n_chars as size,
       case when doc_id % 11 = 0 then 0 else 1704067200000 + doc_id * 60000 end as last_written_ms
from {documents}
"""

_NTH = "select * from (select p.*, row_number() over (partition by instance_id, log_file order by poll_id desc) as nth from ({polls}) p) q where nth = {n} and log_file not like '%{without}'"
INVENTORY = "select instance_id, engine, log_file, poll_id, size, last_written_ms from (" + _NTH.replace("{polls}", POLLS).replace("{n}", "1").replace("{without}", ".2") + ") i"
CHECKPOINTS = "select instance_id, log_file, concat('m', cast(poll_id as string)) as marker, size as file_size from (" + _NTH.replace("{polls}", POLLS).replace("{n}", "2").replace("{without}", ".txt") + ") i"

CHECKPOINT_LOG = """
select concat('db-', cast(user_id as string)) as instance_id, concat(event_type, '.log') as log_file, cast(event_id as string) as marker,
       cast(round(value * 100) as bigint) as bytes_written, ts as updated_at, event_id as seq, cast(regexp_extract(props, '([0-9]+)', 1) as int) >= 95 as deleted
from {events}
"""

ATTEMPTS = """
select concat('db-', cast(user_id as string)) as instance_id,
       concat('b', cast(cast(floor((seq - 1) / 3) as bigint) as string)) as batch_id,
       case event_type when 'signup' then 's3-primary' when 'purchase' then 'kafka-hot' when 'view' then 'siem' when 'click' then 's3-cold' else 'siem-2' end as sink_name,
       case event_type when 'signup' then 's3' when 'purchase' then 'kafka' when 'view' then 'http' when 'click' then 's3' else 'http' end as sink_type,
       (seq - 1) % 3 + 1 as attempt,
       case when k < 60 then 200 when k < 80 then 503 else 400 end as status,
       k + 1 as n_records,
       cast(round(value * 100) as bigint) * 50 as batch_bytes,
       cast(round(value * 100) as bigint) as duration_ms,
       ts as attempted_at
from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k, row_number() over (partition by user_id, event_type order by ts, event_id) as seq from {events}) e
"""

TABLES = ("conversations", "documents", "events")
VIEWS = {"chunks": CHUNKS, "polls": POLLS, "inventory": INVENTORY, "checkpoints": CHECKPOINTS, "checkpoint_log": CHECKPOINT_LOG, "attempts": ATTEMPTS}

#: Sinks that every batch must reach.
SINKS = ("kafka-hot", "s3-cold", "s3-primary", "siem", "siem-2")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def duck(*names: str) -> str:
    """The same views as the head of a DuckDB query, ending with a comma."""
    return "with recursive " + ", ".join(f"{n} as ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in names) + ",\n"
