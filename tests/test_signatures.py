import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetwright.functions import pss
from fleetwright.operators import firmware, signatures
from fleetwright.plans import catalog, signing
from tests import vectors

KEYS = Path(catalog.__file__).parent / "keys"


@pytest.fixture(scope="module")
def public():
    return signatures.load_public_key(KEYS / "sample_public_key.pem")


@pytest.fixture(scope="module")
def record(spark):
    images = spark.createDataFrame(
        [(1, vectors.FIRMWARE_VERSION, vectors.DEVICE_MODEL, vectors.PAYLOAD)],
        "firmware_id long, firmware_version string, device_model string, payload string")
    return firmware.manifest_records(images)


def audit(record, public, signature, **changes):
    value = F.lit(None).cast("binary") if signature is None else F.lit(bytearray(signature))
    signed = record.select("firmware_id", value.alias("signature"))
    return signatures.audit_signatures(record.withColumns(changes), signed, public).first()


def test_valid_signature(record, public):
    row = audit(record, public, vectors.VALID)
    assert row["signature_valid"] is True and row["signature_error"] is None


@pytest.mark.parametrize("signature", [
    vectors.SHORT_SALT, vectors.VALID[:255], vectors.VALID + b"\0", bytes(256), b"\xff" * 256, b"FAKE", b"", None,
])
def test_invalid_signatures(record, public, signature):
    row = audit(record, public, signature)
    assert row["signature_valid"] is False
    assert row["signature_error"] == "Signature verification failed: "


@pytest.mark.parametrize("changes", [
    {"total_size": "1201L"}, {"device_model": "'other'"}, {"chunks": "map_filter(chunks, (k, v) -> k != '2')"},
], ids=["size", "model", "chunks"])
def test_altered_manifest(record, public, changes):
    changes = {name: F.expr(text) for name, text in changes.items()}
    assert audit(record, public, vectors.VALID, **changes)["signature_valid"] is False


def test_no_key(record, tmp_path):
    key = signatures.load_public_key(tmp_path / "missing.pem")
    assert key is None and signatures.load_public_key(None) is None
    row = audit(record, key, vectors.VALID)
    assert row["signature_valid"] is False
    assert row["signature_error"] == "No public key configured for signature verification"


def test_signing_round_trip(spark, public):
    assert signing.sample_private_key().public == public
    images = spark.range(40).select(
        F.col("id").alias("firmware_id"), F.lit("v").alias("firmware_version"), F.lit("m").alias("device_model"),
        F.repeat(F.col("id").cast("string"), 600).alias("payload"))
    records = firmware.manifest_records(images)
    signed = signing.signatures_of(records)
    assert signatures.audit_signatures(records, signed, public).filter("signature_valid").count() == 40
    without = signed.withColumn("signature", F.when(F.col("firmware_id") != 7, F.col("signature"))).filter("firmware_id <> 9")
    bad = signatures.signature_verdicts(records, without, public).filter("NOT signature_valid")
    assert sorted(r["firmware_id"] for r in bad.collect()) == [7, 9]


def test_every_changed_byte_is_noticed(public):
    key = signing.sample_private_key()
    digest = hashlib.sha256(b"message").digest()
    good = signing.sign(key, digest)
    assert pss.verify(public, digest, good)
    for i in range(256):
        changed = bytearray(good)
        changed[i] ^= 0x10
        assert not pss.verify(public, digest, bytes(changed))


@pytest.mark.parametrize("found", [True, False], ids=["openssl", "pow"])
def test_powers(monkeypatch, found):
    if not found:
        monkeypatch.setattr(pss, "_big_numbers", lambda: None)
    key = signing.sample_private_key()
    for exponent, modulus in [(key.exponent, key.modulus), (key.secret, key.modulus), (5, 91), (0, 91), (3, 64), (3, 1)]:
        power = pss.power_of(exponent, modulus)
        for number in (0, 1, 2, modulus - 1, modulus, modulus + 1, 3 << 2050):
            assert power(number) == pow(number, exponent, modulus)


@pytest.mark.parametrize("found", ["two at a time", "one at a time", "pow"])
def test_two_powers(monkeypatch, found):
    if found == "pow":
        monkeypatch.setattr(pss, "_big_numbers", lambda: None)
    if found == "one at a time":
        monkeypatch.setattr(pss, "_TWO_POWERS", "not there")
    key = signing.sample_private_key()
    p, q = key.primes
    for pairs in [((key.secret % (p - 1), p), (key.secret % (q - 1), q)), ((3, 91), (key.secret, key.modulus)), ((5, 64), (2, 9)), ((0, 7), (1, 1))]:
        powers = pss.powers_of(*pairs)
        for number in (0, 1, 2, p - 1, p, q + 1, key.modulus - 1, 3 << 2050):
            assert powers(number) == tuple(pow(number, e, m) for e, m in pairs)


def test_signing_asks_for_both_powers_at_once(monkeypatch):
    asked = []
    monkeypatch.setattr(pss, "power_of", lambda *pair: pytest.fail("one at a time"))
    monkeypatch.setattr(pss, "powers_of", lambda *pairs: asked.append(pairs) or (lambda number: (number % pairs[0][1], number % pairs[1][1])))
    key = signing.sample_private_key()
    assert signing.private_power(key)(12345) == 12345 and [m for _, m in asked[0]] == list(key.primes)


def test_signatures_are_the_same_however_powers_are_made(monkeypatch):
    key = signing.sample_private_key()
    digests = [hashlib.sha256(bytes([n])).digest() for n in range(8)]
    power = signing.private_power(key)
    quick = [signing.sign(key, d, power) for d in digests]
    monkeypatch.setattr(pss, "_big_numbers", lambda: None)
    assert quick == [signing.sign(key, d) for d in digests]
    public_power = pss.power_of(key.exponent, key.modulus)
    assert all(pss.verify(key.public, d, s, public_power) for d, s in zip(digests, quick))


def test_signatures_are_verified_in_even_partitions(record, public):
    """The join's own partitions are merged by size, and a signature takes time whatever its size."""
    spark = record.sparkSession
    stated = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    signed = record.select("firmware_id", F.lit(bytearray(vectors.VALID)).alias("signature"))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        answers = signatures.audit_signatures(record, signed, public)
        assert answers.count() == 1
        text = answers._jdf.queryExecution().executedPlan().toString()
        assert f"{stated}), REPARTITION_BY_NUM" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
