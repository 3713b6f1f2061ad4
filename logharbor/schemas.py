"""Record layouts and fixed values of the landing zone.

Marker files carry the name of the program that wrote them
(``.<producer>-window.device.3.json``), which readers and writers take as an argument.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, patterns and limits that the on-disk format and the
# --- receiving service prescribe.
CHANNELS = ["device", "scope", "system", "sass"]
DEDUP_CHANNEL = "system"
METRIC_BATCH_TYPE = "device_metric_batch"
SIDECAR_TYPE = "transport_window"
SIDECAR_SCHEMA_VERSION = 1
LOSS_SCHEMA_VERSION = 1
UPLOADED_MARKER = ".uploaded"
FAILED_MARKER = ".failed"
TMP_DIR = ".tmp"

CHANNEL_FILE = r"^(device|scope|system|sass)(?:\.\d+)?\.log(?:\.gz)?$"
PAYLOAD_FILE = r"^([A-Za-z0-9_-]+)\.([1-9][0-9]*)\.log(\.gz)?$"
SIDECAR_FILE = r"^\.([A-Za-z0-9]+)-window\.([A-Za-z0-9_-]+)\.([1-9][0-9]*)\.json$"
SESSION_SIDECAR = r"^\.[A-Za-z0-9]+-window\.(device|scope|system|sass)\.[1-9][0-9]*\.json$"
ACK_FILE = r"^\.([A-Za-z0-9]+)-window-ack\.([A-Za-z0-9_-]+)\.([1-9][0-9]*)$"
LOSS_FILE = r"^\.([A-Za-z0-9]+)-transport-loss\.(.*)$"
AGENT_LOSS_FILE = r"^\.[A-Za-z0-9]+-transport-loss\.agent-([A-Za-z0-9_-]+)\.([0-9]+)\.json$"
FLAT_FILE = r"^(.+)\.(device|scope|system|sass)(?:\.\d+)?\.log(?:\.gz)?$"

FORCE_EMIT_MS = 60_000
POWER_THRESHOLD_PCT = 10
TEMP_THRESHOLD_C = 1
MAX_LINES = 5_000
MAX_BYTES = 1_000_000
HEAD_SIGNATURE_BYTES = 512
STALE_TMP_MS = 30_000
SESSION_END_GRACE_MS = 4_500
COMPLETE_MAX_TRIES = 3
COMPLETE_FIRST_DELAY_S = 2
DEFAULT_API_VERSION = "v1"
DEFAULT_TOPIC = "gpu-trace"
DEFAULT_ARCHIVE_PREFIX = "raw-events/"
KAFKA_COMPRESSION = "snappy"
KAFKA_LINGER_MS = 100
# --- End of fixed values.

STREAM = ["folder", "session_id", "channel"]
SESSION = ["folder", "session_id"]
WINDOW = [*STREAM, "window_sequence"]

# Integer metrics of a device sample, in the order in which the dedup state keeps them.
METRIC_COLUMNS = ["device_id", "gpu_util", "mem_util", "temp_c", "power_mw", "used_mib", "clock_sm"]

SIDECAR = T.StructType([
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("window_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("window_sequence", T.LongType()),
    T.StructField("opened_mono_ms", T.LongType()),
    T.StructField("closed_mono_ms", T.LongType()),
    T.StructField("created_wall_ms", T.LongType()),
    T.StructField("payload_file", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_crc32", T.LongType()),
])

CURSOR_POSITION = T.StructType([
    T.StructField("fileIndex", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("fileKey", T.StringType()),
    T.StructField("fileSize", T.LongType()),
    T.StructField("headSig", T.LongType()),
])

CURSOR_FILE = T.StructType([
    T.StructField("streams", T.MapType(T.StringType(), CURSOR_POSITION)),
])

LOSS = T.StructType([
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("source", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("window_sequence", T.LongType()),
    T.StructField("reason", T.StringType()),
])

METRIC_BATCH = T.StructType([
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
])
