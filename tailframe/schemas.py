"""Fixed schemas. Nothing here is ever inferred from data."""

from pyspark.sql import types as T


_KINDS = {"string": T.StringType, "bigint": T.LongType, "int": T.IntegerType, "boolean": T.BooleanType, "timestamp": T.TimestampType, "double": T.DoubleType}


def _schema(text: str) -> T.StructType:
    """From pairs of name and type, without needing a session."""
    return T.StructType([T.StructField(name, _KINDS[kind]()) for name, kind in (pair.split(" ") for pair in text.split(", "))])


#: One page of a log file: its raw payload between two opaque markers.
CHUNK = _schema("instance_id string, engine string, log_file string, prev_marker string, next_marker string, data string, additional_pending boolean, fetched_at timestamp")
#: The same as a live source reads it. A page that could not be read has no data, equal markers and an error. ``generation`` counts the file's truncations, and
#: with ``start_byte`` it numbers a file's pages.
LOG_PAGE = T.StructType([*CHUNK, T.StructField("error", T.StringType()), T.StructField("generation", T.IntegerType()), T.StructField("start_byte", T.LongType())])
#: One raw log line. ``line_no`` is its place in the payload, counting empty lines.
RECORD = _schema("instance_id string, engine string, log_file string, timestamp timestamp, message string, marker string, batch_id string, line_no int")
INVENTORY = _schema("instance_id string, engine string, log_file string, size bigint, last_written_ms bigint")
#: A version of a position. The newest version of a key counts; a deleted one removes it.
CHECKPOINT = _schema("instance_id string, log_file string, marker string, bytes_written bigint, file_size bigint, last_written timestamp, updated_at timestamp, seq bigint, deleted boolean")
DEAD_LETTER = _schema("dlq_id bigint, sink_name string, batch_id string, payload string, reason string, created_at timestamp")
SINK = _schema("sink_name string, sink_type string, max_attempts int, initial_wait_ms bigint, max_wait_ms bigint, multiplier double")
#: One delivery attempt of a batch at a sink.
ATTEMPT = _schema("instance_id string, batch_id string, sink_name string, sink_type string, attempt int, status int, n_records bigint, batch_bytes bigint, duration_ms bigint, attempted_at timestamp")
