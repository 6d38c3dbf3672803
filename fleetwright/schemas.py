"""Table schemas, status values and default bounds."""

from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------
# Update status of a device.
SUCCESS = "Success"
PARTIAL = "Partial"
RECOVERED = "Recovered"
SECURITY_HOLD = "SECURITY_HOLD"
STATUSES = [PARTIAL, RECOVERED, SECURITY_HOLD, SUCCESS]

# Status of one update attempt.
INSTALLED = "installed"
SECURITY_VIOLATION = "SECURITY_VIOLATION"
UPDATE_ERROR = "error"

# Event type, action and algorithm names.
TAMPER_EVENT = "FIRMWARE_TAMPER_DETECTED"
MANUAL_TRIAGE = "MANUAL_TRIAGE"
HASH_ALGORITHM = "SHA-256"

# Load batch, firmware chunk size, valid signal range.
LOAD_BATCH_ROWS = 500
CHUNK_SIZE = 500
SIGNAL_MIN, SIGNAL_MAX = 10, 100
# ---- end of fixed values ----------------------------------------------------

# Our own names: the remaining recovery actions and the defect kinds.
RECOVER = "RECOVER"
NO_ACTION = "NONE"
MISSING = "MISSING"
CORRUPT_TYPE = "CORRUPT_TYPE"
OUT_OF_RANGE = "OUT_OF_RANGE"
UNREADABLE_LINE = "UNREADABLE_LINE"

# Firmware verdicts, in the order the stages are checked.
CONFLICTING_MANIFESTS = "CONFLICTING_MANIFESTS"
SIGNATURE_FAILED = "SIGNATURE_FAILED"
STRUCTURE_ERROR = "STRUCTURE_ERROR"
COUNT_MISMATCH = "COUNT_MISMATCH"
MALFORMED_MANIFEST = "MALFORMED_MANIFEST"
CHUNK_ERROR = "CHUNK_ERROR"
SEQUENCE_ERROR = "SEQUENCE_ERROR"
OK = "OK"
VIOLATIONS = [CONFLICTING_MANIFESTS, SIGNATURE_FAILED, STRUCTURE_ERROR, COUNT_MISMATCH, CHUNK_ERROR, SEQUENCE_ERROR]

FLEET = T.StructType([
    T.StructField("device_id", T.StringType(), False),
    T.StructField("region", T.StringType()),
    T.StructField("battery_voltage", T.DoubleType()),
    T.StructField("signal_strength", T.IntegerType()),
    T.StructField("update_status", T.StringType()),
])

# As delivered: the voltage column may hold text.
RAW_FLEET = T.StructType([
    T.StructField("device_id", T.StringType(), False),
    T.StructField("region", T.StringType()),
    T.StructField("battery_voltage", T.StringType()),
    T.StructField("signal_strength", T.IntegerType()),
    T.StructField("update_status", T.StringType()),
])

RECOVERY_ACTIONS = T.StructType(
    RAW_FLEET.fields + [T.StructField("recovery_action", T.StringType())]
)

SECURITY_EVENTS = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("firmware_id", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

MANIFEST_ENTRY = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("index", T.IntegerType()),
    T.StructField("size", T.IntegerType()),
])

MANIFEST = T.StructType([
    T.StructField("firmware_id", T.LongType(), False),
    T.StructField("firmware_version", T.StringType()),
    T.StructField("device_model", T.StringType()),
    T.StructField("total_chunks", T.IntegerType()),
    T.StructField("total_size", T.LongType()),
    T.StructField("algorithm", T.StringType()),
    T.StructField("chunks", T.MapType(T.StringType(), MANIFEST_ENTRY)),
])

RECEIVED_CHUNKS = T.StructType([
    T.StructField("firmware_id", T.LongType(), False),
    T.StructField("chunk_index", T.IntegerType(), False),
    T.StructField("payload", T.BinaryType()),
])
