"""The registered queries: every operator over the whole given tables.

Each takes (spark, folder) and returns a DataFrame. Array results are joined to
text, so that any SQL engine can compare them.
"""

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetwright.operators import analytics, firmware, quality, signatures, state, updates
from fleetwright.plans import signing, views
from fleetwright.schemas import CHUNK_SIZE, FLEET, PARTIAL, RAW_FLEET, RECOVERY_ACTIONS
from fleetwright.session import scratch_path
from fleetwright.sources import loads, ranged, sinks, tables
from fleetwright.streaming import chunk_verify, image_verify

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries; the oracle SQL states the same values.
PAGE_ROWS, PAGE_START = 2_500, 2_500
SHARDS = 4
SAMPLE_ROWS, SAMPLE_SEED = 50, 7
MIN_ROWS = 10_000
IMAGES_PER_FOLDER = 100
ID_FOLDERS = 16
EVENT_TIME = "2024-01-01 00:00:00"
FAR_LATER = "2100-01-01 00:00:00"

def _text(array: str, separator: str = ",") -> Column:
    return F.array_join(array, separator)


# ---- fleet analytics --------------------------------------------------------

def _counted(report) -> Query:
    return lambda spark, folder: report(views.regional_status(spark, folder), weight="devices")


def _by_status(report) -> Query:
    """Reports without a region need no lookup."""
    return lambda spark, folder: report(views.devices(spark, folder))


# ---- fleet state ------------------------------------------------------------

def recovery_apply(spark, folder):
    return state.recover(views.fleet(spark, folder))


def recovery_page(spark, folder):
    return state.recovery_page(views.devices(spark, folder), PAGE_ROWS, PAGE_START)


def recovery_first_page(spark, folder):
    """The page at the start."""
    return state.recovery_page(views.devices(spark, folder), SAMPLE_ROWS, 0)


def recovery_shard_report(spark, folder):
    return state.recovery_shard_report(views.devices(spark, folder), SHARDS)


def recovery_tally(spark, folder):
    return state.recovery_tally(recovery_shard_report(spark, folder))


def status_update_by_key(spark, folder):
    changes = views.status_feed(spark, folder)
    return state.apply_status(views.fleet(spark, folder), changes, order="reported_at")


def security_hold(spark, folder):
    violations = views.status_feed(spark, folder).filter(F.col("status") == PARTIAL)
    return state.security_hold(views.fleet(spark, folder), violations)


def batch_ledger(spark, folder):
    return state.batch_ledger(views.devices(spark, folder), "device_id")


def load_resumed(spark, folder):
    """A load that stopped after its tenth batch, left half a part behind, and was started again."""
    path = scratch_path(spark, "load")
    rows = views.devices(spark, folder).select("device_id", "update_status")
    loads.load(rows, path, "device_id", until=9)
    rows.withColumn("batch_id", F.lit(10).cast("bigint")).write.parquet(f"{path}/rows/part=1")
    loads.load(rows, path, "device_id")
    return loads.read_load(spark, path, "batch_id bigint, device_id string, update_status string")


def batch_assignment(spark, folder):
    rows = views.devices(spark, folder).select("device_id", "update_status")
    return state.assign_batches(rows, "device_id").drop("row_index")


def key_violations(spark, folder):
    return state.key_violations(views.devices(spark, folder))


def key_violations_feed(spark, folder):
    return state.key_violations(views.status_feed(spark, folder))


def sample_exact_n(spark, folder):
    return state.sample_exact_n(
        views.fleet(spark, folder), SAMPLE_ROWS, SAMPLE_SEED, keys=views.devices(spark, folder))


def sample_update(spark, folder):
    return state.sample_update(
        views.fleet(spark, folder), SAMPLE_ROWS, "signal_strength", views.BAD_SIGNAL, SAMPLE_SEED,
        keys=views.devices(spark, folder))


def fleet_replaced(spark, folder):
    """The fleet as a named table whose second version, the recovered fleet, replaced the first."""
    name = f"ota_logs_{uuid.uuid4().hex}"
    sinks.replace_table(views.fleet(spark, folder), name, version=1)
    sinks.replace_table(state.recover(spark.table(name)), name, version=2)
    return spark.table(name)


def status_update_any(spark, folder):
    """`status_update_by_key` of a feed that also reports statuses the fleet does not have."""
    return state.apply_status(views.fleet(spark, folder), views.mixed_feed(spark, folder), order="reported_at")


def recovery_pages(spark, folder):
    """The pages of all shards from one index; each reads the folders it lies in."""
    path = scratch_path(spark, "partial_ids")
    partial = views.devices(spark, folder).filter(F.col("update_status") == PARTIAL).select("device_id")
    ranged.save_ranged(partial, path, "device_id", ID_FOLDERS)
    pages = [ranged.read_page(spark, path, "device_id", PAGE_ROWS, n * PAGE_ROWS).select(
        F.lit(n).cast("bigint").alias("page"), "device_id") for n in range(SHARDS)]
    return reduce(DataFrame.unionByName, pages)


def _merged(spark, folder):
    """A stored fleet after three change sets, one after the other, and the counts kept up by their logs."""
    path = scratch_path(spark, "ranged_fleet")
    ranged.save_ranged(views.fleet(spark, folder), path, "device_id", ID_FOLDERS)
    counts = analytics.region_status_counts(views.regional_status(spark, folder), weight="devices")
    feed = views.status_feed(spark, folder)
    line = F.shiftright(F.col("reported_at") % (1 << 20), 1)
    for n in range(3):
        log = ranged.merge_status(spark, path, feed.filter(line % 3 == n), n, order="reported_at")
        counts = analytics.updated_counts(counts, log)
    return path, counts


def fleet_merged(spark, folder):
    return ranged.read_ranged(spark, _merged(spark, folder)[0])


def region_status_counts_kept(spark, folder):
    return _merged(spark, folder)[1]


# ---- data quality -----------------------------------------------------------

def corruption_classify(spark, folder):
    rows = quality.classify(views.raw_devices(spark, folder))
    return rows.select("device_id", "battery_voltage", "signal_strength", _text("defects").alias("defects"))


def corruption_counts(spark, folder):
    return quality.corruption_counts(views.raw_devices(spark, folder))


def quarantine_clean(spark, folder):
    return quality.quarantine(views.raw_fleet(spark, folder))[0]


def quarantine_bad(spark, folder):
    bad = quality.quarantine(views.raw_fleet(spark, folder))[1]
    return bad.withColumn("defects", _text("defects"))


def quarantine_lines(spark, folder):
    """What is quarantined of devices that arrive as lines, some of them broken."""
    path = scratch_path(spark, "raw_lines")
    views.raw_lines(spark, folder).write.text(path)
    bad = quality.quarantine(tables.csv_lines(spark, path, RAW_FLEET, header=False))[1]
    return bad.select("device_id", _text("defects").alias("defects"), tables.UNREADABLE)


def recovery_actions(spark, folder):
    return quality.recovery_actions(views.raw_fleet(spark, folder))


def recovery_actions_csv(spark, folder):
    """The actions written as CSV and read back with their schema."""
    path = scratch_path(spark, "recovery_actions")
    sinks.write_csv(recovery_actions(spark, folder), path)
    return tables.csv_table(spark, path, RECOVERY_ACTIONS)


def _device_actions(spark, folder):
    return quality.recovery_actions(views.raw_devices(spark, folder))


def triage_count(spark, folder):
    return quality.triage_count(_device_actions(spark, folder))


def recovery_action_distribution(spark, folder):
    return quality.recovery_action_distribution(_device_actions(spark, folder))


def integrity_check(spark, folder):
    """The fleet's rows against the total its load batches arrived at."""
    loaded = batch_ledger(spark, folder).agg(F.max("running_total")).first()[0]
    return quality.integrity_check(views.devices(spark, folder), MIN_ROWS, loaded or 0)


# ---- firmware ---------------------------------------------------------------

def firmware_chunks(spark, folder):
    return firmware.chunk_hashes(views.received_chunks(spark, folder))


def firmware_manifest(spark, folder):
    return firmware.manifest_totals(firmware_chunks(spark, folder), views.images(spark, folder))


def chunk_renumber(spark, folder):
    """Chunks landed under numbers with gaps, some of them twice."""
    return firmware.renumber_chunks(views.landed_chunks(spark, folder))


def manifest_json(spark, folder):
    return firmware.manifest_documents(views.manifests(spark, folder))


def _delivery(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Published manifests and delivered chunks, both with faults."""
    records = views.faulty_manifests(spark, folder)
    return records, views.faulty_chunks(views.received_chunks(spark, folder))


def manifest_structure_check(spark, folder):
    return firmware.manifest_structure_check(views.faulty_manifests(spark, folder))


def chunk_count_check(spark, folder):
    return firmware.chunk_count_check(*_delivery(spark, folder))


def chunk_hash_check(spark, folder):
    return firmware.chunk_hash_check(*_delivery(spark, folder))


def chunk_sequence_check(spark, folder):
    checked = firmware.chunk_sequence_check(views.faulty_manifests(spark, folder))
    return checked.withColumn("found_keys", _text("found_keys"))


def chunk_errors(spark, folder):
    return firmware.chunk_errors(*_delivery(spark, folder))


def firmware_errors(spark, folder):
    return firmware.firmware_errors(*_delivery(spark, folder))


def firmware_errors_top3(spark, folder):
    first = firmware.first_errors(firmware.firmware_errors(*_delivery(spark, folder), first=3), 3)
    return first.withColumn("errors", _text("errors", " | "))


def _verdicts(spark, folder):
    return firmware.firmware_verdicts(*_delivery(spark, folder))


def firmware_verdict(spark, folder):
    return _verdicts(spark, folder).select("firmware_id", "verdict", "error_count")


def verdict_counts(spark, folder):
    return firmware.verdict_counts(_verdicts(spark, folder))


def firmware_verdict_landed(spark, folder):
    """Verdicts of chunks as they landed, verified by their position in the delivery."""
    received = firmware.renumber_chunks(views.landed_chunks(spark, folder))
    verdicts = firmware.firmware_verdicts(views.faulty_manifests(spark, folder), received)
    return verdicts.select("firmware_id", "verdict", "error_count")


def signature_audit(spark, folder):
    """Signed manifests, of which some were altered after signing: the signature
    (5), the manifest (7), the signature's length (9), or no signature at all (11)."""
    fault, signature = F.col("firmware_id") % 20, F.col("signature")
    last = F.substring(signature, 256, 1)
    other = F.when(last == F.unhex(F.lit("00")), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00")))
    shorter = F.substring(signature, 1, 255)
    records = views.manifests(spark, folder)
    altered = records.withColumn("total_size", F.col("total_size") + F.when(fault == 7, 1).otherwise(0))
    changed = signing.signatures_of(records).withColumn(
        "signature", F.when(fault == 5, F.concat(shorter, other)).when(fault == 9, shorter)
        .when(fault == 11, F.lit(None)).otherwise(signature))
    return signatures.audit_signatures(altered, changed, signing.sample_public_key())


def firmware_verdict_signed(spark, folder):
    """`firmware_verdict` with the signatures really made and verified: one image
    in twenty is signed before its manifest changes."""
    records, received = _delivery(spark, folder)
    records = records.drop("signature_valid")
    signed = signing.signatures_of(records)
    tampered = F.when(F.col("firmware_id") % 20 == 11, F.lit("tampered")).otherwise(F.col("device_model"))
    records = records.withColumn("device_model", tampered)
    valid = signatures.signature_verdicts(records, signed, signing.sample_public_key())
    return firmware.firmware_verdicts(records, received, valid).select("firmware_id", "verdict", "error_count")


def firmware_verdict_contested(spark, folder):
    """Verdicts where some images have two manifests, both said to be signed."""
    verdicts = firmware.firmware_verdicts(views.contested_manifests(spark, folder), views.contested_chunks(spark, folder))
    return verdicts.select("firmware_id", "verdict", "error_count")


def manifest_canonical(spark, folder):
    """Canonical text of manifests that came as documents with nested fields of their own."""
    documents = views.published_documents(views.manifests(spark, folder))
    return firmware.manifest_documents(firmware.records_of_documents(documents))


def _landed(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder, and read from there."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def firmware_verdict_documents(spark, folder):
    """`firmware_verdict_signed` of manifests that came as documents: one in twenty has a
    nested field changed after it was signed that the verification does not read.

    Documents are published once, and read once as they were found: signature and verdict read the same records.
    """
    records, received = _delivery(spark, folder)
    documents = _landed(views.published_documents(records), "published")
    signed = signing.signatures_of(firmware.records_of_documents(documents))
    changed = F.regexp_replace("document", '"signed":true', '"signed":false')
    tampered = documents.withColumn(
        "document", F.when(F.col("firmware_id") % 20 == 11, changed).otherwise(F.col("document")))
    found = _landed(firmware.records_of_documents(tampered), "found")
    valid = signatures.signature_verdicts(found, signed, signing.sample_public_key())
    return firmware.firmware_verdicts(found, received, valid).select("firmware_id", "verdict", "error_count")


def update_outcomes(spark, folder):
    return updates.update_outcomes(views.update_targets(spark, folder), _verdicts(spark, folder))


def _verdicts_and_errors(spark, folder):
    records, received = _delivery(spark, folder)
    verdicts = firmware.firmware_verdicts(records, received)
    return verdicts, firmware.firmware_errors(records, received, verdicts=verdicts)


def update_errors(spark, folder):
    return updates.update_errors(views.update_targets(spark, folder), *_verdicts_and_errors(spark, folder))


def event_details(spark, folder):
    return updates.event_details(firmware_errors(spark, folder))


def security_events(spark, folder):
    when = F.to_timestamp_ntz(F.lit(EVENT_TIME))
    return updates.security_events(views.update_targets(spark, folder), _verdicts(spark, folder), when)


def security_event_texts(spark, folder):
    """Every event with its whole text, part by part."""
    return updates.event_texts(security_events(spark, folder), event_details(spark, folder))


def security_events_stored(spark, folder):
    """The events appended to their table in two loads, and read back."""
    events, path = security_events(spark, folder), scratch_path(spark, "security_events")
    for half in (0, 1):
        sinks.append(events.filter(F.col("firmware_id") % 2 == half), path)
    return spark.read.schema(events.schema).parquet(path)


def fleet_after_update(spark, folder):
    rows = views.located_devices(spark, folder).select(*FLEET.names, F.col("home").alias("firmware_id"))
    return updates.fleet_after_update(rows, _verdicts(spark, folder))


# ---- streaming --------------------------------------------------------------

def _arriving_chunks(spark, folder):
    """The documents as a stream of arriving images, cut into chunks."""
    # A pattern, as a stream takes a plain path for a folder, and the table may be one file.
    path = f"{folder}/documents.{{parquet}}"
    arriving = chunk_verify.chunk_stream(spark, path, views.DOCUMENTS).select(
        F.col("doc_id").alias("firmware_id"), F.col("text").alias("payload"), "arrived_at")
    return views.faulty_chunks(firmware.chunk_images(arriving, CHUNK_SIZE, "arrived_at"))


def chunk_stream_verify(spark, folder):
    """Arriving chunks checked against stored entries, and the results read back."""
    entries, results, log = (scratch_path(spark, name) for name in ("entries", "verified", "verified_log"))
    manifests = views.faulty_manifests(spark, folder)
    chunk_verify.save_entries(firmware.manifest_entries(manifests), entries, IMAGES_PER_FOLDER)
    hashes = chunk_verify.new_hashes(_arriving_chunks(spark, folder))
    chunk_verify.verify_available(hashes, entries, results, log, IMAGES_PER_FOLDER)
    return spark.read.parquet(results).drop("batch")


def image_stream_verdict(spark, folder):
    """Verdicts given while the chunks arrive; what is still incomplete in the end is timed out."""
    entries, heads, results, log, verdicts, state = (scratch_path(spark, name) for name in (
        "entries", "heads", "verified", "verified_log", "image_verdicts", "image_state"))
    manifests = views.faulty_manifests(spark, folder)
    chunk_verify.save_entries(firmware.manifest_entries(manifests), entries, IMAGES_PER_FOLDER)
    chunk_verify.save_heads(firmware.manifest_heads(manifests), heads, IMAGES_PER_FOLDER)
    hashes = firmware.delivered_hashes(_arriving_chunks(spark, folder), "arrived_at")
    chunk_verify.verify_available(hashes, entries, results, log, IMAGES_PER_FOLDER, heads)
    image_verify.decide_available(spark, results, verdicts, state)
    image_verify.tick(spark, results, FAR_LATER)
    image_verify.decide_available(spark, results, verdicts, state)
    return image_verify.read_verdicts(spark, verdicts).select("firmware_id", "verdict", "error_count")


QUERIES: dict[str, Query] = {
    "fleet_projection": views.fleet,
    "failure_rank": _counted(analytics.failure_rank),
    "status_counts": _by_status(analytics.status_counts),
    "status_distribution": _by_status(analytics.status_distribution),
    "status_summary": _by_status(analytics.status_summary),
    "region_status_counts": _counted(analytics.region_status_counts),
    "regional_status_pct": _counted(analytics.regional_status_pct),
    "regional_status_matrix": _counted(analytics.regional_status_matrix),
    "regional_breakdown": _counted(analytics.regional_breakdown),
    "regional_failure_rate": _counted(analytics.regional_failure_rate),
    "recovery_apply": recovery_apply,
    "recovery_page": recovery_page,
    "recovery_first_page": recovery_first_page,
    "recovery_shard_report": recovery_shard_report,
    "recovery_tally": recovery_tally,
    "status_update_by_key": status_update_by_key,
    "status_update_any": status_update_any,
    "security_hold": security_hold,
    "recovery_pages": recovery_pages,
    "fleet_merged": fleet_merged,
    "region_status_counts_kept": region_status_counts_kept,
    "fleet_replaced": fleet_replaced,
    "batch_ledger": batch_ledger,
    "batch_assignment": batch_assignment,
    "load_resumed": load_resumed,
    "key_violations": key_violations,
    "key_violations_feed": key_violations_feed,
    "sample_exact_n": sample_exact_n,
    "sample_update": sample_update,
    "corruption_classify": corruption_classify,
    "corruption_counts": corruption_counts,
    "quarantine_clean": quarantine_clean,
    "quarantine_bad": quarantine_bad,
    "quarantine_lines": quarantine_lines,
    "recovery_actions": recovery_actions,
    "recovery_actions_csv": recovery_actions_csv,
    "triage_count": triage_count,
    "recovery_action_distribution": recovery_action_distribution,
    "integrity_check": integrity_check,
    "firmware_chunks": firmware_chunks,
    "firmware_manifest": firmware_manifest,
    "chunk_renumber": chunk_renumber,
    "manifest_json": manifest_json,
    "manifest_canonical": manifest_canonical,
    "manifest_structure_check": manifest_structure_check,
    "chunk_count_check": chunk_count_check,
    "chunk_hash_check": chunk_hash_check,
    "chunk_sequence_check": chunk_sequence_check,
    "chunk_errors": chunk_errors,
    "firmware_errors": firmware_errors,
    "firmware_errors_top3": firmware_errors_top3,
    "firmware_verdict": firmware_verdict,
    "firmware_verdict_landed": firmware_verdict_landed,
    "firmware_verdict_signed": firmware_verdict_signed,
    "firmware_verdict_contested": firmware_verdict_contested,
    "firmware_verdict_documents": firmware_verdict_documents,
    "verdict_counts": verdict_counts,
    "signature_audit": signature_audit,
    "update_outcomes": update_outcomes,
    "update_errors": update_errors,
    "event_details": event_details,
    "security_events": security_events,
    "security_event_texts": security_event_texts,
    "security_events_stored": security_events_stored,
    "fleet_after_update": fleet_after_update,
    "chunk_stream_verify": chunk_stream_verify,
    "image_stream_verdict": image_stream_verdict,
}
