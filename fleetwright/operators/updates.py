"""Outcome of firmware updates per device, security events, and the fleet after.

An image is verified once, however many devices install it; devices look the
verdict up. `targets` is (device_id, firmware_id). Where one image goes to much
of the fleet, the lookup join is split on the device side by the adaptive skew
join, the verdict side having one row per image.
"""

from pyspark.sql import Column, DataFrame, functions as F

from fleetwright.schemas import (
    INSTALLED, MALFORMED_MANIFEST, OK, SECURITY_HOLD, SECURITY_VIOLATION, SUCCESS, TAMPER_EVENT,
    UPDATE_ERROR, VIOLATIONS,
)

# Our own texts: an image that does not exist, and between messages.
NO_IMAGE = "Firmware image not found"
SEPARATOR = " | "

# Chunk positions whose messages make up one part of an image's event details.
PART_POSITIONS = 1_000


def _update_status() -> Column:
    """An image without a verdict cannot be fetched, which is an error, not a violation."""
    verdict = F.col("verdict")
    return (
        F.when(verdict == OK, INSTALLED)
        .when(verdict.isin(VIOLATIONS), SECURITY_VIOLATION)
        .otherwise(UPDATE_ERROR)
    )


def update_outcomes(targets: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(device_id, firmware_id, firmware_version, status, verification_passed, error_count).

    The errors themselves are the rows of `update_errors` with the device's
    firmware_id, `error_count` of them.
    """
    looked_up = targets.join(
        verdicts.select("firmware_id", "firmware_version", "verdict", "error_count"), "firmware_id", "left")
    return looked_up.select(
        "device_id", "firmware_id", "firmware_version",
        _update_status().alias("status"),
        F.coalesce(F.col("verdict") == OK, F.lit(False)).alias("verification_passed"),
        F.coalesce("error_count", F.lit(1).cast("bigint")).alias("error_count"),
    )


def update_errors(targets: DataFrame, verdicts: DataFrame, errors: DataFrame) -> DataFrame:
    """(firmware_id, position, message, device_count): every error of the updates, once per image.

    A device's own list is that of its image in `update_outcomes`. Repeating it
    for each device would multiply the devices of an image with its errors.
    """
    hit = targets.groupBy("firmware_id").agg(F.count("*").alias("device_count"))
    found = errors.join(hit, "firmware_id").select("firmware_id", "position", "message", "device_count")
    # The verdict itself is asked for, which comes from the plan that the errors come from.
    judged = hit.join(verdicts.select("firmware_id", "verdict"), "firmware_id", "left")
    missing = judged.filter(F.col("verdict").isNull()).select(
        "firmware_id", F.lit(0).cast("bigint").alias("position"), F.lit(NO_IMAGE).alias("message"),
        "device_count")
    return found.unionByName(missing)


def event_details(errors: DataFrame) -> DataFrame:
    """(firmware_id, part, details, error_count): messages of violations, joined in index order.

    One row per image and run of chunk positions: a longer error list goes on
    in further rows, so no row or task holds an unbounded one.
    """
    part = F.floor(F.col("position") / PART_POSITIONS)
    listed = F.array_sort(F.collect_list(F.struct("position", "message")))
    return (
        errors.filter(F.col("verdict") != MALFORMED_MANIFEST)
        .groupBy("firmware_id", part.alias("part"))
        .agg(
            F.array_join(F.transform(listed, lambda e: e["message"]), SEPARATOR).alias("details"),
            F.count("*").alias("error_count"),
        )
    )


def security_events(targets: DataFrame, verdicts: DataFrame, event_time: Column | None = None) -> DataFrame:
    """(device_id, event_type, firmware_id, timestamp): one tamper event per violating device.

    What was wrong is text of the image, kept whole and once in `event_details`;
    `event_texts` reads it for events. A copy for each device would multiply the
    devices of an image with its errors.
    """
    when = F.current_timestamp() if event_time is None else event_time
    violated = verdicts.filter(F.col("verdict").isin(VIOLATIONS)).select("firmware_id")
    return targets.join(violated, "firmware_id").select(
        "device_id", F.lit(TAMPER_EVENT).alias("event_type"), "firmware_id", when.alias("timestamp"))


def event_texts(events: DataFrame, details: DataFrame) -> DataFrame:
    """The events with their whole text: a row for each part of it."""
    return events.join(details.drop("error_count"), "firmware_id", "left").select(*events.columns, "part", "details")


def fleet_after_update(fleet: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The fleet, with `firmware_id` per device, after its updates ran.

    Installed devices succeed, violating ones go on hold, errors change
    nothing. One lookup on the image serves the whole fleet.
    """
    looked_up = fleet.join(verdicts.select("firmware_id", "verdict"), "firmware_id", "left")
    status = _update_status()
    new = (
        F.when(status == INSTALLED, SUCCESS)
        .when(status == SECURITY_VIOLATION, SECURITY_HOLD)
        .otherwise(F.col("update_status"))
    )
    return looked_up.withColumn("update_status", new).select(*fleet.columns).drop("firmware_id")
