"""DuckDB SQL that gives the rows of the registered queries."""

from __future__ import annotations

from tailframe.operators.metrics import BYTES_BOUNDS, SECONDS_BOUNDS
from tailframe.plans.fixtures import SINKS, duck

_BATCH_ID = "substr(sha256(concat_ws('|', instance_id, log_file, prev_marker, next_marker)), 1, 16)"
_LINES = f"lines as (select instance_id, engine, log_file, chunk_no, next_marker as marker, {_BATCH_ID} as batch_id, fetched_at, i - 1 as line_no, parts[i] as message from (select *, string_split(data, chr(10)) as parts, unnest(range(1, len(string_split(data, chr(10))) + 1)) as i from chunks) where parts[i] <> '')"
_STOPS = f"refused as (select instance_id, log_file, chunk_no from (select *, {_BATCH_ID} as batch_id from chunks) where substr(batch_id, 1, 1) = '7' and length(replace(data, chr(10), '')) > 0), stops as (select instance_id, log_file, min(chunk_no) as stop from refused group by all)"
_COUNTS = "select instance_id, engine, log_file, count(*) as n_lines, sum(strlen(message)) as n_bytes from lines group by all"
_BASE = "regexp_extract(regexp_replace(log_file, '/+$', ''), '([^/]*)$', 1)"
_MYSQL = " or ".join(f"starts_with(lower({_BASE}), '{p}')" for p in ("mysql-error", "mysql-slowquery", "mysql-general", "mariadb-error", "mariadb-slowquery", "mariadb-general")) + " or " + " or ".join(f"starts_with(lower(log_file), '{p}')" for p in ("error/", "slowquery/", "general/"))
_ACCEPTS = f"case when engine = 'postgres' then starts_with(lower({_BASE}), 'postgresql.log') or starts_with(lower({_BASE}), 'postgres.log') when engine in ('mysql', 'mariadb') then {_MYSQL} else true end"
_LAG = "select instance_id, log_file, greatest(0, cast(epoch(timestamp '2024-01-02 00:00:00') as bigint) - last_written_ms // 1000) as lag_s from inventory where last_written_ms <> 0"
_START = "starts as (select instance_id, log_file, next_marker as from_marker, strlen(data) as first_bytes from chunks where chunk_no = 1)"
_WALK = "walk as (select c.*, 1 as hop from chunks c join starts s using (instance_id, log_file) where c.prev_marker = s.from_marker union all select c.*, w.hop + 1 from walk w join chunks c using (instance_id, log_file) where w.additional_pending and c.prev_marker = w.next_marker)"
_WALKED = "select instance_id, log_file, prev_marker, next_marker, hop, strlen(data) as n_bytes from walk"
_CURRENT = "current as (select * from (select *, row_number() over (partition by instance_id, log_file order by updated_at desc, seq desc) as n from checkpoint_log) where n = 1 and not deleted)"
_CHECKPOINT = "select instance_id, log_file, marker, bytes_written, updated_at, seq from current"
_JUDGED = "judged as (select *, case when status between 200 and 299 then 'ok' when status between 400 and 499 then 'permanent' else 'transient' end as outcome from attempts)"
_MADE = _JUDGED + ", made as (select * from (select *, coalesce(max(case when outcome <> 'transient' then 1 else 0 end) over (partition by instance_id, sink_name, batch_id order by attempt rows between unbounded preceding and 1 preceding), 0) as ended from judged where attempt <= 3) where ended = 0)"
_FINAL = _MADE + ", final as (select * from (select *, row_number() over (partition by instance_id, sink_name, batch_id order by attempt desc) as last from made) where last = 1)"
_DLQ = _FINAL + ", dlq as (select row_number() over (order by attempted_at, instance_id, sink_name, batch_id) as dlq_id, instance_id, sink_name, batch_id, case when outcome = 'permanent' then 'permanent' else 'error' end as reason, n_records, attempted_at from final where outcome <> 'ok' and n_records > 0)"
_SINK_LIST = ", ".join(f"'{s}'" for s in SINKS)
_RECORD = "{{'instance_id': instance_id, 'engine': engine, 'log_file': log_file, 'timestamp': strftime(fetched_at, '%Y-%m-%dT%H:%M:%S.000Z'), 'message': message, 'marker': marker, 'batch_id': batch_id}}".replace("{{", "{").replace("}}", "}")
_SOURCE = "source as (select doc_id, source as instance_id, lang as log_file, substr(sha256(concat_ws('|', source, lang, doc_id::varchar, (doc_id + 1)::varchar)), 1, 16) as batch_id, i - 1 as line_no, parts[i] as message from (select *, string_split(text, chr(10)) as parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents) where parts[i] <> '')"
_DELIVERED = "delivered as (select * from source where doc_id % 7 <> 0 union all select * from source where doc_id % 5 = 0)"


def _histogram(value: str, bounds: list[float], total: str, le: str) -> str:
    each = ", ".join(f"({b!r}::double)" for b in bounds) + ", (null)"
    return duck("attempts") + _MADE + f", bounds(le) as (values {each}), per as (select sink_type, le, sum(case when le is null or {value} <= le then 1 else 0 end) as n from made, bounds group by all), totals as (select sink_type, sum({value}) as total, count(*) as c from made group by all) select sink_type, total as {total}, c as count, le as {le}, n from per join totals using (sink_type)"


def oracle_sql() -> dict[str, str]:
    chunks, attempts = duck("chunks"), duck("attempts")
    polls = duck("polls")
    log = duck("checkpoint_log")
    both = duck("inventory", "checkpoints")
    plain = "with recursive "
    tailed = chunks + _LINES + " " + _COUNTS
    return {
        "lines_by_file": tailed,
        "batch_ids": chunks[:-2] + f" select instance_id, log_file, chunk_no, coalesce(nullif(prev_marker, ''), '0') as from_marker, next_marker as marker, {_BATCH_ID} as batch_id, strlen(data) as n_bytes from chunks",
        "eligible_files": polls[:-2] + f" select instance_id, engine, log_file, count(*) as n_polls, max(size) as size, max(nullif(last_written_ms, 0)) as last_ms from polls where {_ACCEPTS} group by all",
        "hinted_files": polls[:-2] + f" select instance_id, log_file, count(*) as n_polls from polls where engine = 'postgres' and contains(log_file, 'postgres') and {_ACCEPTS} group by all",
        "file_labels": polls[:-2] + f" select poll_id, {_BASE} as base, substr(regexp_extract(log_file, '([^/]*)$', 1), 1, 64) as file_label, {_ACCEPTS} as accepted, nullif(last_written_ms, 0) as written_ms from polls",
        "lag_by_file": duck("inventory")[:-2] + " " + _LAG,
        "stream_lag": duck("inventory")[:-2] + " " + _LAG,
        "start_positions": both[:-2] + " select instance_id, log_file, engine, size, case when file_size is null then 'skip_to_end' when size < file_size then 'reset' else 'resume' end as action, case when file_size is null then null when size < file_size then '0' else coalesce(nullif(marker, ''), '0') end as from_marker from inventory left join checkpoints using (instance_id, log_file)",
        "rotated_out": both[:-2] + " select instance_id, log_file, marker, file_size from checkpoints c where not exists (select 1 from inventory i where i.instance_id = c.instance_id and i.log_file = c.log_file)",
        "unchanged_skipped": duck("polls", "inventory") + "seen as (select instance_id, log_file, arg_max(size, poll_id) as file_size, arg_max(last_written_ms, poll_id) as ms from polls where poll_id % 3 = 0 group by all) select i.instance_id, i.log_file, size, last_written_ms from inventory i left join seen s using (instance_id, log_file) where not (size is not distinct from file_size and nullif(last_written_ms, 0) is not distinct from nullif(ms, 0))",
        "truncations": polls + "p as (select *, lag(size) over (partition by instance_id, log_file order by poll_id) as prev_size from polls), t as (select *, coalesce(size < prev_size, false) as truncated from p) select instance_id, log_file, poll_id, size, prev_size, truncated, sum(truncated::int) over (partition by instance_id, log_file order by poll_id) as generation from t",
        "drained_chunks": chunks + _START + ", " + _WALK + " " + _WALKED,
        "drained_by_marker": chunks + _START + ", " + _WALK + " " + _WALKED,
        "drained_recursive": chunks + _START + ", " + _WALK + " select instance_id, log_file, prev_marker, next_marker, hop from walk",
        "tail_markers": chunks + _START + ", " + _WALK + " select instance_id, log_file, arg_max(next_marker, hop) as tail_marker, max(hop) as hops from walk group by all",
        "checkpoint_trail": chunks + _START + ", " + _WALK + " select instance_id, log_file, hop, next_marker as marker, first_bytes + sum(strlen(data)) over (partition by instance_id, log_file order by hop) as bytes_written from walk join starts using (instance_id, log_file)",
        "current_checkpoints": log + _CURRENT + " " + _CHECKPOINT,
        "compacted": log + _CURRENT + " " + _CHECKPOINT,
        "set_checkpoints": log + _CURRENT + " " + _CHECKPOINT,
        "get_checkpoint": log + _CURRENT + " " + _CHECKPOINT + " where instance_id = 'db-7' and log_file = 'click.log'",
        "list_checkpoints": log + _CURRENT + " " + _CHECKPOINT + " where instance_id = 'db-7'",
        "deleted_checkpoints": log + _CURRENT + " " + _CHECKPOINT + " where log_file <> 'view.log'",
        "batch_sizes": chunks + _LINES + " select instance_id, engine, log_file, batch_id, count(*) as n_records, sum(strlen(message)) as batch_bytes from lines group by all",
        "coalesced_batches": chunks + "s as (select instance_id, log_file, strlen(data) as b, sum(strlen(data)) over (partition by instance_id, log_file order by chunk_no) - strlen(data) as before from chunks) select instance_id, log_file, before // 1000 as bucket, count(*) as n_chunks, sum(b) as batch_bytes from s group by all",
        "webhook_payloads": chunks + _LINES + f" select instance_id, log_file, batch_id, count(*) as n_records, to_json(list({_RECORD} order by line_no))::varchar as payload, 'Content-Type' as first_header, 'all' as own_header, 4 as n_headers from lines group by instance_id, log_file, batch_id, engine",
        "object_keys": chunks + _LINES + " select distinct batch_id, instance_id, log_file, engine, concat_ws('/', 'logs', instance_id, engine, regexp_extract(log_file, '([^/]*)$', 1), strftime(fetched_at, '%Y/%m/%d'), concat(epoch_us(fetched_at) // 1000, '-', batch_id, '.ndjson.gz')) as object_key, 'AES256' as sse from lines",
        "kafka_frame": chunks + _LINES + f" select concat_ws('|', instance_id, log_file) as key, to_json({_RECORD})::varchar as value, concat('logs-', engine) as topic, concat('batch-id=', batch_id, ';instance-id=', instance_id, ';log-file=', log_file, ';engine=', engine) as headers from lines",
        "ndjson_roundtrip": tailed,
        "stream_tail": tailed,
        "stream_dedupe": tailed,
        "dlq_replay": chunks + _LINES + " " + _COUNTS,
        "status_classes": attempts + "c as (select status + attempt * 50 as status from attempts) select status, case when status between 200 and 299 then 'ok' when status between 400 and 499 then 'permanent' else 'transient' end as class, count(*) as n from c group by all",
        "retry_outcome": attempts + _FINAL + " select instance_id, sink_name, batch_id, attempt as attempts, status, outcome from final",
        "retry_waits": attempts + _MADE + " select sink_name, sum(least(60000, 500 * pow(2, attempt - 1))::bigint) as wait_ms, max(least(60000, 500 * pow(2, attempt - 1))::bigint) as longest_ms from made where outcome = 'transient' group by all",
        "fanout_acks": attempts + _FINAL + f" select instance_id, batch_id, sum(case when outcome = 'ok' then 1 else 0 end) as n_acked, sum(case when outcome = 'ok' then 1 else 0 end) = {len(SINKS)} as acked from final where sink_name in ({_SINK_LIST}) group by all",
        "fanout_missing": attempts + _FINAL + f", m as (select distinct instance_id, batch_id, s.sink_name from final, (select unnest([{_SINK_LIST}]) as sink_name) s) select sink_name, count(*) as n_missing from m where not exists (select 1 from final f where f.instance_id = m.instance_id and f.batch_id = m.batch_id and f.sink_name = m.sink_name and outcome = 'ok') group by all",
        "dead_letters": attempts + _DLQ + " select * from dlq",
        "dlq_oldest": attempts + _DLQ + " select * from dlq order by dlq_id limit 100",
        "dlq_after_delete": attempts + _DLQ + " select * from dlq where dlq_id % 3 <> 0",
        "processed_total": attempts + _MADE + " select instance_id, 'postgres' as engine, concat(batch_id, '.log') as file_label, sink_type, sum(n_records) as n from made where outcome = 'ok' group by all",
        "failed_total": attempts + _MADE + " select instance_id, sink_type, case when outcome = 'permanent' then 'permanent' else 'error' end as reason, sum(n_records) as n from made where outcome <> 'ok' group by all",
        "failed_by_hour": attempts + _MADE + " select instance_id, sink_type, case when outcome = 'permanent' then 'permanent' else 'error' end as reason, date_trunc('hour', attempted_at) as hour, sum(n_records) as n from made where outcome <> 'ok' group by all",
        "batch_bytes_hist": _histogram("batch_bytes", BYTES_BOUNDS, "total", "le"),
        "write_seconds_hist": _histogram("duration_ms", [b * 1000 for b in SECONDS_BOUNDS], "total_ms", "le_ms"),
        "api_calls": attempts + _MADE + " select case when attempt = 1 then 'DescribeDBLogFiles' else 'DownloadDBLogFilePortion' end as operation, case when status between 200 and 299 then 'ok' else 'error' end as outcome, count(*) as n from made group by all",
        "store_ops": attempts + _MADE + " select case when attempt % 2 = 1 then 'get' else 'set' end as op, case when status between 200 and 299 then 'ok' else 'error' end as outcome, count(*) as n from made group by all",
        "delivery_totals": attempts + _JUDGED + ", per as (select sink_name, instance_id, batch_id, sum(case when outcome = 'ok' then 1 else 0 end) as k, sum(case when outcome = 'ok' then n_records else 0 end) as r, sum(case when outcome <> 'ok' then 1 else 0 end) as f from judged group by all) select sink_name, sum(r) as n_records, sum(case when k > 0 then 1 else 0 end) as n_batches, sum(greatest(k - 1, 0)) as n_duplicates, sum(f) as n_failures from per group by all",
        "missing_lines": plain + _SOURCE + " select doc_id, line_no, message from source where doc_id % 7 = 0 and doc_id % 5 <> 0",
        "dedupe_lines": plain + _SOURCE + ", " + _DELIVERED + " select instance_id, log_file, count(*) as n_lines, sum(strlen(message)) as n_bytes from (select distinct instance_id, log_file, batch_id, line_no, message from delivered) group by all",
        "line_generations": plain + _SOURCE + " select unnest([0, 1]) as generation, count(*) as n_lines from (select distinct instance_id, log_file, batch_id, line_no from source)",
        "ordered_lines": chunks + _LINES + " select instance_id, log_file, chunk_no, line_no, row_number() over (partition by instance_id, log_file order by chunk_no, line_no) as place from lines",
        "stream_state": chunks[:-2] + " select instance_id, log_file, arg_max(next_marker, chunk_no) as marker, sum(strlen(data)) as bytes_written, count(*) as n_chunks from chunks group by all",
        "stream_fanout": chunks + _LINES + ", b as (select batch_id, sum(strlen(message)) as n from lines group by all), s as (select 'siem' as sink_name, case when substr(batch_id, 1, 1) = '7' then 400 else 200 end as status, n from b union all select 'cold', 200, n from b) select sink_name, status, count(*) as n_batches, sum(n) as n_bytes from s group by all",
        "stream_positions": chunks + _STOPS + " select instance_id, log_file, arg_max(next_marker, chunk_no) as marker, sum(strlen(data)) as bytes_written from chunks left join stops using (instance_id, log_file) where stop is null or chunk_no < stop group by all",
        "stream_parked": chunks + _LINES + f" select c.*, 'tail' as marker from ({_COUNTS.replace('from lines', "from lines where substr(batch_id, 1, 1) = '7'")}) c",
        "poll_positions": chunks + _STOPS + """, files as (select instance_id, log_file, sum(strlen(data)) as file_size, cast(regexp_extract(log_file, '([0-9]+)$', 1) as bigint) as k from chunks group by all),
            due as (select c.*, file_size, k, stop, case when k % 6 = 0 then 1 else 2 end as start, case when k % 6 = 0 then 1 else 0 end as again from chunks c join files using (instance_id, log_file) left join stops using (instance_id, log_file)),
            sent as (select *, sum(strlen(data)) over (partition by instance_id, log_file order by chunk_no) + again * sum(case when chunk_no = 1 then strlen(data) else 0 end) over (partition by instance_id, log_file) as bytes_written from due where k % 2 = 0)
            select instance_id, log_file, next_marker as marker, bytes_written, file_size, chunk_no - start + 1 as seq from sent s
              where chunk_no >= start and not exists (select 1 from refused r where r.instance_id = s.instance_id and r.log_file = s.log_file and r.chunk_no between s.start and s.chunk_no)
            union all select instance_id, log_file, 'tail', 0, file_size, 0 from files where k % 2 = 1""",
        "stream_outbox": chunks + _LINES + ", b as (select distinct instance_id, batch_id from lines), n as (select count(*) as n, sum((substr(batch_id, 1, 1) = '7')::bigint) as refused from b), f as (select count(distinct (instance_id, log_file)) as n_files, sum(strlen(data)) as bytes_written from chunks) select unnest(['siem', 'cold']) as sink_name, n as n_ok, n as n_batches, unnest([2, 0]) * refused as n_refused, 0 as n_out_of_order, n_files, n_files as n_at_end, bytes_written from n, f",
        "stream_holes": chunks + _LINES + " select cast(regexp_extract(log_file, '([0-9]+)$', 1) as bigint) as file_no, count(*) as n_lines, sum(strlen(message)) as n_bytes, 1 as n_errors from lines group by all",
        "stream_generations": chunks + _LINES + ", g as (select 0 as generation, * from lines union all select 1, * from lines where chunk_no = 1) select cast(regexp_extract(log_file, '([0-9]+)$', 1) as bigint) as file_no, generation, count(*) as n_lines, sum(strlen(message)) as n_bytes from g group by all",
        "stream_calls": chunks + _LINES + ", f as (select distinct log_file from lines) select 'read_page' as operation, unnest(['ok', 'error']) as outcome, count(*) as n from f",
        "stream_store_ops": chunks[:-2] + " select unnest(['get', 'set']) as op, 'ok' as outcome, count(distinct (instance_id, log_file)) as n from chunks",
        "stream_objects": chunks + _LINES + " select instance_id, engine, log_file, count(*) as n_lines, sum(strlen(message)) as n_bytes, count(distinct batch_id) as n_objects, count(*) as n_listed from lines group by all",
        "dlq_roundtrip": attempts + _DLQ + ", again as (select *, cast(substr(batch_id, 2) as bigint) as k from dlq), ids as (select *, row_number() over (order by k % 2, dlq_id) as id from again) select id as dlq_id, instance_id, sink_name, batch_id, reason from ids where k % 5 = 0 and id > 10",
        "objects_roundtrip": tailed,
        "log_tail_chosen": chunks + _LINES + ", f as (select cast(regexp_extract(log_file, '([0-9]+)$', 1) as bigint) as file_no, message from lines) select file_no, count(*) as n_lines, sum(strlen(message)) as n_bytes from f where starts_with(file_no::varchar, '1') group by all",
        "log_tail_lines": chunks + _LINES + " select cast(regexp_extract(log_file, '([0-9]+)$', 1) as bigint) as file_no, count(*) as n_lines, sum(strlen(message)) as n_bytes from lines group by all",
    }
