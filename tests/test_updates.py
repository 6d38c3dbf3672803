import pytest

from fleetwright.operators import firmware, updates
from fleetwright.schemas import SECURITY_EVENTS
from tests.firmware_cases import CASES, tables
from tests.test_analytics import fleet_of
from tests.test_firmware import huge_image

NO_IMAGE = len(CASES)  # a firmware number without a manifest


@pytest.fixture(scope="module")
def case(spark):
    """Two devices per image, and two whose image does not exist."""
    records, received = tables(spark)
    verdicts = firmware.firmware_verdicts(records, received).cache()
    errors = firmware.firmware_errors(records, received).cache()
    targets = spark.createDataFrame(
        [(f"DEV-{n:08x}", n // 2) for n in range(2 * (NO_IMAGE + 1))], "device_id string, firmware_id long")
    return targets, verdicts, errors


def expected_status(number):
    if number == NO_IMAGE:
        return "error"
    verdict = list(CASES.values())[number][1]
    return {"OK": "installed", "MALFORMED_MANIFEST": "error"}.get(verdict, "SECURITY_VIOLATION")


def test_outcomes(case):
    targets, verdicts, _ = case
    rows = updates.update_outcomes(targets, verdicts).collect()
    assert len(rows) == targets.count()
    for row in rows:
        status = expected_status(row["firmware_id"])
        assert row["status"] == status
        assert row["verification_passed"] == (status == "installed")
        assert (row["error_count"] == 0) == (status == "installed")


def test_errors_are_whole_and_once_per_image(case):
    targets, verdicts, errors = case
    found = {}
    for row in updates.update_errors(targets, verdicts, errors).orderBy("firmware_id", "position").collect():
        found.setdefault(row["firmware_id"], []).append(row["message"])
        assert row["device_count"] == 2
    messages = [m for _, _, m in CASES.values()] + [[updates.NO_IMAGE]]
    assert found == {n: m for n, m in enumerate(messages) if m}


def test_every_failed_update_finds_its_errors(case):
    targets, verdicts, errors = case
    per_image = {}
    for row in updates.update_errors(targets, verdicts, errors).collect():
        per_image[row["firmware_id"]] = per_image.get(row["firmware_id"], 0) + 1
    for row in updates.update_outcomes(targets, verdicts).collect():
        assert per_image.get(row["firmware_id"], 0) == row["error_count"]


def test_one_event_per_violating_device(case):
    targets, verdicts, errors = case
    events = updates.security_events(targets, verdicts)
    assert events.columns == SECURITY_EVENTS.names
    assert dict(events.dtypes)["timestamp"] == "timestamp"
    rows = {r["device_id"]: r for r in events.collect()}
    violating = {f"DEV-{n:08x}" for n in range(2 * (NO_IMAGE + 1)) if expected_status(n // 2) == "SECURITY_VIOLATION"}
    assert set(rows) == violating and events.count() == len(violating)
    texts = {}
    for row in updates.event_texts(events, updates.event_details(errors)).orderBy("device_id", "part").collect():
        texts.setdefault(row["device_id"], []).append(row["details"])
    for device, row in rows.items():
        messages = list(CASES.values())[int(device[4:], 16) // 2][2]
        assert sorted(" | ".join(texts[device]).split(" | ")) == sorted(messages)
        assert row["event_type"] == "FIRMWARE_TAMPER_DETECTED"


def test_fleet_after_update(spark, case):
    targets, verdicts, _ = case
    fleet = fleet_of(spark, [("A", "Partial", targets.count())])
    after = updates.fleet_after_update(fleet.join(targets, "device_id"), verdicts)
    assert sorted(after.columns) == sorted(fleet.columns)
    status = {"installed": "Success", "SECURITY_VIOLATION": "SECURITY_HOLD", "error": "Partial"}
    for row in after.collect():
        assert row["update_status"] == status[expected_status(int(row["device_id"][4:], 16) // 2)]


def test_long_error_lists_go_on_in_the_details(spark):
    records, received = huge_image(spark, 2_500)
    targets = spark.createDataFrame([("DEV-1", 1000), ("DEV-2", 5)], "device_id string, firmware_id long")
    errors = firmware.firmware_errors(records, received)
    parts = updates.event_details(errors).orderBy("part").collect()
    assert [(p["firmware_id"], p["part"], p["error_count"]) for p in parts] == [
        (1000, 0, 1_000), (1000, 1, 1_000), (1000, 2, 500)]
    messages = [m for p in parts for m in p["details"].split(" | ")]
    assert [int(m.split()[1].rstrip(":")) for m in messages] == list(range(2_500))
    events = updates.security_events(targets, firmware.firmware_verdicts(records, received))
    assert [e["device_id"] for e in events.collect()] == ["DEV-1"]
    whole = updates.event_texts(events, updates.event_details(errors)).orderBy("part").collect()
    assert [w["details"] for w in whole] == [p["details"] for p in parts]
