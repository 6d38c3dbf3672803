import json

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from fleetwright.functions.canonical_json import _tokens, json_float, json_string, variant_json
from fleetwright.operators import firmware
from fleetwright.schemas import MANIFEST
from tests.firmware_cases import CASES, manifest, sha, tables

IMAGES = "firmware_id long, firmware_version string, device_model string, payload "


@pytest.fixture(scope="module")
def delivery(spark):
    records, received = tables(spark)
    return records.cache(), received.cache()


@pytest.fixture(scope="module")
def found(delivery):
    verdicts = {r["firmware_id"]: r for r in firmware.firmware_verdicts(*delivery).collect()}
    errors = {}
    for r in firmware.firmware_errors(*delivery).orderBy("firmware_id", "position").collect():
        errors.setdefault(r["firmware_id"], []).append(r["message"])
    return verdicts, errors


@pytest.mark.parametrize("number,name", list(enumerate(CASES)), ids=list(CASES))
def test_verdict_and_messages(found, number, name):
    _, verdict, messages = CASES[name]
    assert found[0][number]["verdict"] == verdict
    assert found[0][number]["error_count"] == len(messages)
    assert found[1].get(number, []) == messages


def test_verdict_counts(delivery):
    counts = {r[0]: r[1] for r in firmware.verdict_counts(firmware.firmware_verdicts(*delivery)).collect()}
    assert sum(counts.values()) == len(CASES)


def test_missing_public_key_message(delivery):
    errors = firmware.firmware_errors(*delivery, signature_error=firmware.NO_PUBLIC_KEY)
    text = {r["message"] for r in errors.filter("verdict = 'SIGNATURE_FAILED'").collect()}
    assert text == {"SIGNATURE VERIFICATION FAILED: No public key configured for signature verification"}


def test_hash_check_reports_both_sides(delivery):
    states = {(r["firmware_id"], r["chunk_key"]): r["result"] for r in firmware.chunk_hash_check(*delivery).collect()}
    name = list(CASES)
    assert states[name.index("extra entry"), "3"] == "NOT_DELIVERED"
    assert states[name.index("entry missing"), "1"] == "MISSING_IN_MANIFEST"
    assert states[name.index("entry without hash"), "1"] == "ENTRY_WITHOUT_HASH"
    assert states[name.index("two altered"), "2"] == "HASH_MISMATCH"
    assert states[name.index("intact"), "0"] == "OK"
    assert states[name.index("one chunk three times"), "0"] == "REPEATED"
    assert states[name.index("one chunk three times"), "1"] == "NOT_DELIVERED"
    assert states[name.index("no content"), "1"] == "NOT_HASHABLE"
    assert states[name.index("negative index"), "-1"] == "MISSING_IN_MANIFEST"


def test_only_plain_keys_name_a_chunk(delivery):
    name = list(CASES)
    index = {(r["firmware_id"], r["chunk_key"]): r["chunk_index"]
             for r in firmware.manifest_entries(delivery[0]).collect()}
    assert index[name.index("equal as number"), "00"] is None
    assert index[name.index("key no number"), "x1"] is None
    assert index[name.index("extra entry"), "3"] == 3


def test_one_flipped_byte_is_never_ok(spark):
    sent = [bytes([i]) * 40 for i in range(8)]
    records = spark.createDataFrame(
        [{"firmware_id": n, **manifest(sent)} for n in range(8 * 40)], MANIFEST,
    ).withColumn("signature_valid", F.lit(True))
    received = []
    for n in range(8 * 40):
        chunks = [bytearray(c) for c in sent]
        chunks[n // 40][n % 40] ^= 1 << (n % 8)
        received += [(n, i, c) for i, c in enumerate(chunks)]
    rows = spark.createDataFrame(received, "firmware_id long, chunk_index int, payload binary")
    assert [tuple(r) for r in firmware.verdict_counts(firmware.firmware_verdicts(records, rows)).collect()] == [
        ("CHUNK_ERROR", 8 * 40)]


DELIVERY = st.lists(
    st.tuples(st.sampled_from([-1, 0, 0, 1, 1, 2, 2, 3, 2147483647]), st.sampled_from([b"one", b"two", b"three", b"x", None])),
    max_size=5)


@hypothesis_settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(DELIVERY, min_size=60, max_size=60))
def test_only_the_true_delivery_is_ok(spark, deliveries):
    """Whatever rows arrive: OK for exactly the listed chunks, and as many messages as errors."""
    true = [(0, b"one"), (1, b"two"), (2, b"three")]
    deliveries = [*deliveries, true, true[::-1]]
    record = manifest([c for _, c in true])
    records = spark.createDataFrame(
        [{"firmware_id": n, **record} for n in range(len(deliveries))], MANIFEST).withColumn("signature_valid", F.lit(True))
    rows = [(n, i, c and bytearray(c)) for n, chunks in enumerate(deliveries) for i, c in chunks]
    received = spark.createDataFrame(rows, "firmware_id long, chunk_index int, payload binary")
    verdicts = {r["firmware_id"]: r for r in firmware.firmware_verdicts(records, received).collect()}
    messages = {r[0]: r[1] for r in firmware.firmware_errors(records, received).groupBy("firmware_id").count().collect()}
    for n, chunks in enumerate(deliveries):
        assert (verdicts[n]["verdict"] == "OK") == (sorted(chunks, key=str) == sorted(true, key=str))
        assert verdicts[n]["error_count"] == messages.get(n, 0)


def test_a_chunk_without_index_fails(spark):
    records = spark.createDataFrame([{"firmware_id": 1, **manifest([b"a"])}], MANIFEST).withColumn("signature_valid", F.lit(True))
    received = spark.createDataFrame([(1, None, bytearray(b"a"))], "firmware_id long, chunk_index int, payload binary")
    assert firmware.firmware_verdicts(records, received).first()["verdict"] == "CHUNK_ERROR"
    assert firmware.firmware_errors(records, received).count() == 1


def test_signature_answers_may_come_apart(delivery):
    records, received = delivery
    answers = records.select("firmware_id", "signature_valid")
    apart = firmware.firmware_verdicts(records.drop("signature_valid"), received, answers)
    together = firmware.firmware_verdicts(records, received)
    key = ["firmware_id", "verdict", "error_count"]
    assert sorted(map(tuple, apart.select(*key).collect())) == sorted(map(tuple, together.select(*key).collect()))
    unanswered = firmware.firmware_verdicts(records.drop("signature_valid"), received)
    assert {r["verdict"] for r in unanswered.collect()} == {"SIGNATURE_FAILED"}


def test_first_errors(delivery):
    errors = firmware.first_errors(firmware.firmware_errors(*delivery), 1)
    first = {r["firmware_id"]: r["errors"] for r in errors.collect()}
    for number, (_, _, messages) in enumerate(CASES.values()):
        assert first.get(number, []) == messages[:1]


def test_canonical_json_is_byte_exact(spark):
    chunks = [bytes([i]) * (i + 1) for i in range(12)]
    record = manifest(chunks) | {"device_model": 'a"b\\c\té\U0001f600\x7f/'}
    df = spark.createDataFrame([{"firmware_id": 1, **record}], MANIFEST)
    expected = json.dumps(record, sort_keys=True, separators=(",", ":"))
    assert expected.index('"10":') < expected.index('"2":')
    row = firmware.manifest_documents(df).first()
    assert row["manifest_json"] == expected
    assert row["manifest_digest"] == sha(expected.encode())


def test_canonical_json_leaves_out_absent_fields(spark):
    record = manifest([b"x"]) | {"total_chunks": None}
    df = spark.createDataFrame([{"firmware_id": 1, **record}], MANIFEST)
    del record["total_chunks"]
    expected = json.dumps(record, sort_keys=True, separators=(",", ":"))
    assert firmware.manifest_documents(df).first()["manifest_json"] == expected


@hypothesis_settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=40))
def test_json_strings(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", json_string(F.col("t")).alias("j"))
    for row in df.collect():
        assert row["j"] == json.dumps(row["t"])


TEXTS = ["", "a", "x" * 500, "y" * 501, "é\n😀" * 700, "line\r\n" * 333]


def test_text_is_cut_by_characters(spark):
    images = spark.createDataFrame([(i, "v", "m", t) for i, t in enumerate(TEXTS)], IMAGES + "string")
    got = {}
    for r in firmware.chunk_images(images).collect():
        got.setdefault(r["firmware_id"], {})[r["chunk_index"]] = bytes(r["payload"])
    for i, text in enumerate(TEXTS):
        pieces = [text[k:k + 500].encode() for k in range(0, len(text), 500)]
        assert [c for _, c in sorted(got.get(i, {}).items())] == pieces


@pytest.mark.parametrize("kind", ["string", "binary", "array<binary>"])
def test_records_and_totals_agree(spark, kind):
    payloads = {"string": TEXTS, "binary": [bytearray(t.encode()) for t in TEXTS],
                "array<binary>": [[bytearray(b"x" * 502), bytearray(b"")], [], [bytearray(b"z")]]}[kind]
    images = spark.createDataFrame([(i, "v", "m", p) for i, p in enumerate(payloads)], IMAGES + kind)
    totals = firmware.manifest_totals(firmware.chunk_hashes(firmware.chunk_images(images)), images)
    records = firmware.manifest_records(images)
    assert sorted(map(tuple, records.drop("chunks").collect())) == sorted(map(tuple, totals.collect()))
    assert dict(records.dtypes)["chunks"] == "map<string,struct<hash:string,index:int,size:int>>"
    from_records = firmware.manifest_entries(records).select("firmware_id", "chunk_index", "expected_hash")
    hashes = firmware.chunk_hashes(firmware.chunk_images(images)).select("firmware_id", "chunk_index", "hash")
    assert sorted(map(tuple, from_records.collect())) == sorted(map(tuple, hashes.collect()))


def test_binary_is_cut_by_bytes(spark):
    data = bytes(range(256)) * 5
    images = spark.createDataFrame([(1, "v", "m", bytearray(data))], IMAGES + "binary")
    chunks = sorted((r["chunk_index"], bytes(r["payload"])) for r in firmware.chunk_images(images, 500).collect())
    assert [c for _, c in chunks] == [data[:500], data[500:1000], data[1000:]]


def test_renumbering_closes_gaps(spark):
    landed = spark.createDataFrame(
        [(1, 10, bytearray(b"a")), (1, 40, bytearray(b"b")), (2, 7, bytearray(b"c")), (1, 41, bytearray(b"d")),
         (1, 40, bytearray(b"b"))],
        "firmware_id long, sequence long, payload binary")
    received = firmware.renumber_chunks(landed)
    rows = {(r["firmware_id"], r["chunk_index"]): r["actual_hash"] for r in received.collect()}
    assert rows == {(1, 0): sha(b"a"), (1, 1): sha(b"b"), (1, 2): sha(b"d"), (2, 0): sha(b"c")}
    records = spark.createDataFrame(
        [{"firmware_id": 1, **manifest([b"a", b"b", b"d"])}, {"firmware_id": 2, **manifest([b"c"])}], MANIFEST)
    verdicts = firmware.firmware_verdicts(records.withColumn("signature_valid", F.lit(True)), received)
    assert [r["verdict"] for r in verdicts.collect()] == ["OK", "OK"]


def test_renumbering_with_a_third_of_the_rows_copies_of_one(spark):
    rows = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 10).cast("bigint").alias("firmware_id"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("sequence"))
    landed = rows.withColumn("payload", F.col("sequence").cast("string").cast("binary"))
    received = firmware.renumber_chunks(landed)
    images = rows.distinct().groupBy("firmware_id").count()
    found = firmware.delivered_counts(received).collect()
    assert {(r["firmware_id"], r["delivered"]) for r in found} == {
        (r["firmware_id"], r["count"]) for r in images.collect()}
    assert received.agg(F.min("chunk_index")).first()[0] == 0
    assert received.select("firmware_id", "chunk_index").distinct().count() == received.count()


def huge_image(spark, chunks):
    """An image with `chunks` bad chunks beside 100 intact images of 20."""
    images = spark.range(100).select(
        F.col("id").alias("firmware_id"), F.explode(F.sequence(F.lit(0), F.lit(19))).alias("chunk_index"))
    huge = spark.range(chunks).select(F.lit(1000).cast("bigint"), F.col("id").cast("int"))
    received = images.union(huge).withColumn(
        "payload", F.concat_ws("-", "firmware_id", "chunk_index").cast("binary"))
    good = F.sha2(F.col("payload"), 256)
    entries = received.select(
        "firmware_id", F.col("chunk_index").cast("string").alias("k"),
        F.struct(F.when(F.col("firmware_id") < 1000, good).otherwise("0" * 64).alias("hash"),
                 F.col("chunk_index").alias("index"), F.lit(0).alias("size")).alias("v"))
    records = entries.groupBy("firmware_id").agg(
        F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("chunks"),
        F.count("*").cast("int").alias("total_chunks"),
    ).withColumns({"firmware_version": F.lit("v"), "signature_valid": F.lit(True)})
    return records, received


def test_all_errors_of_a_huge_image_are_kept(spark):
    records, received = huge_image(spark, 4_321)
    errors = firmware.chunk_errors(records, received)
    assert errors.count() == 4_321
    assert errors.select("position").distinct().count() == 4_321
    top = firmware.first_errors(errors).collect()
    assert [r["firmware_id"] for r in top] == [1000]
    assert [m.split(":")[0] for m in top[0]["errors"]] == ["Chunk 0", "Chunk 1", "Chunk 2"]


# ---- manifests that come twice ----------------------------------------------

def _forged(record, chunk, **changes):
    """The record with another hash for chunk 0."""
    entry = {**record["chunks"]["0"], "hash": sha(chunk)}
    return {**record, "chunks": {**record["chunks"], "0": entry}, **changes}


TRUE = manifest([b"one", b"two"])
PAIRS = {
    "a copy": ([TRUE, TRUE], [b"one", b"two"], "OK"),
    "a copy and a bad chunk": ([TRUE, TRUE], [b"ONE", b"two"], "CHUNK_ERROR"),
    "forged, the forged chunk delivered": ([TRUE, _forged(TRUE, b"ONE")], [b"ONE", b"two"], "CONFLICTING_MANIFESTS"),
    "forged, the true chunk delivered": ([TRUE, _forged(TRUE, b"ONE")], [b"one", b"two"], "CONFLICTING_MANIFESTS"),
    "another size only": ([TRUE, {**TRUE, "total_size": 7}], [b"one", b"two"], "CONFLICTING_MANIFESTS"),
    "another model only": ([TRUE, {**TRUE, "device_model": "x"}], [b"one", b"two"], "CONFLICTING_MANIFESTS"),
    "one without chunks": ([TRUE, {**TRUE, "chunks": None}], [b"one", b"two"], "CONFLICTING_MANIFESTS"),
    "three": ([TRUE, TRUE, _forged(TRUE, b"ONE")], [b"ONE", b"two"], "CONFLICTING_MANIFESTS"),
}


@pytest.mark.parametrize("answers", ["column", "by image", "by digest"])
def test_manifests_that_come_twice(spark, answers):
    records = spark.createDataFrame(
        [{"firmware_id": n, **record} for n, (records, _, _) in enumerate(PAIRS.values()) for record in records], MANIFEST)
    received = spark.createDataFrame(
        [(n, i, bytearray(c)) for n, (_, chunks, _) in enumerate(PAIRS.values()) for i, c in enumerate(chunks)],
        "firmware_id long, chunk_index int, payload binary")
    signatures = None
    if answers == "column":
        records = records.withColumn("signature_valid", F.lit(True))
    elif answers == "by image":
        signatures = records.select("firmware_id", F.lit(True).alias("signature_valid"))
    else:
        signatures = firmware.manifest_documents(records).select("firmware_id", "manifest_digest", F.lit(True).alias("signature_valid"))
    rows = firmware.firmware_verdicts(records, received, signatures).collect()
    assert [r["verdict"] for r in sorted(rows, key=lambda r: r["firmware_id"])] == [v for _, _, v in PAIRS.values()]
    messages = firmware.firmware_errors(records, received, signatures=signatures).groupBy("firmware_id").count().collect()
    assert {r[0]: r[1] for r in messages} == {r["firmware_id"]: r["error_count"] for r in rows if r["error_count"]}


def test_an_answer_is_for_the_manifest_that_was_signed(spark):
    """The true manifest is signed; what is verified is another one."""
    images = spark.createDataFrame([(1, "v", "m", "x" * 700), (2, "v", "m", "y" * 700)], IMAGES + "string")
    true = firmware.manifest_records(images)
    answers = firmware.manifest_documents(true).select("firmware_id", "manifest_digest", F.lit(True).alias("signature_valid"))
    other = true.withColumn("total_size", F.when(F.col("firmware_id") == 2, 1).otherwise(F.col("total_size")))
    rows = firmware.firmware_verdicts(other, firmware.chunk_images(images), answers).collect()
    assert {r["firmware_id"]: r["verdict"] for r in rows} == {1: "OK", 2: "SIGNATURE_FAILED"}
    no = answers.withColumn("signature_valid", F.col("firmware_id") == 2)
    both = firmware.firmware_verdicts(true, firmware.chunk_images(images), answers.union(no)).collect()
    assert {r["firmware_id"]: r["verdict"] for r in both} == {1: "SIGNATURE_FAILED", 2: "OK"}


RECORDS = st.lists(st.sampled_from([TRUE, _forged(TRUE, b"ONE"), {**TRUE, "total_size": 1}, {**TRUE, "total_chunks": 1}]),
                   min_size=1, max_size=3)
ARRIVING = st.lists(st.tuples(st.sampled_from([0, 0, 1, 2]), st.sampled_from([b"one", b"ONE", b"two"])), max_size=4)


@hypothesis_settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(RECORDS, ARRIVING), min_size=80, max_size=80))
def test_no_tampered_chunk_is_ever_ok(spark, cases):
    """Whatever manifests and chunks arrive: one row per image, OK only for one manifest and its chunks."""
    cases = [*cases, ([TRUE], [(0, b"one"), (1, b"two")])]
    records = spark.createDataFrame(
        [{"firmware_id": n, **record} for n, (records, _) in enumerate(cases) for record in records], MANIFEST)
    received = spark.createDataFrame([(n, i, bytearray(c)) for n, (_, chunks) in enumerate(cases) for i, c in chunks],
                                     "firmware_id long, chunk_index int, payload binary")
    rows = firmware.firmware_verdicts(records.withColumn("signature_valid", F.lit(True)), received).collect()
    assert sorted(r["firmware_id"] for r in rows) == list(range(len(cases)))
    for row in rows:
        manifests, chunks = cases[row["firmware_id"]]
        first = manifests[0]
        intact = all(m == first for m in manifests) and sorted(chunks) == sorted(
            (i, next(c for c in (b"one", b"ONE", b"two") if sha(c) == first["chunks"][str(i)]["hash"])) for i in (0, 1)
        ) and first["total_chunks"] == 2
        assert (row["verdict"] == "OK") == intact


# ---- documents ---------------------------------------------------------------

VALUES = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(-2**62, 2**62), st.integers(10**20, 10**30),
              st.integers(-10**12, 10**12).map(lambda n: n / 1000 + 0.0), st.text(st.characters(exclude_categories=["Cs"]), max_size=8)),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.text("ab\"é10😀", max_size=3), inner, max_size=3)),
    max_leaves=12)


@hypothesis_settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.text("abé😀\n", max_size=3), VALUES, max_size=4), min_size=40, max_size=40))
def test_documents_of_any_shape_are_byte_exact(spark, documents):
    rows = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=i % 2 == 0, indent=i % 3 or None)) for i, d in enumerate(documents)],
                                 "firmware_id long, document string")
    found = {r["firmware_id"]: r["manifest_json"] for r in firmware.records_of_documents(rows).collect()}
    for i, document in enumerate(documents):
        assert found[i] == json.dumps(document, sort_keys=True, separators=(",", ":"))


INNER = [
    {"b": 1.0}, [1, 1.0], ["x", 1.0], [True, 100.0, None], {"k": "\u00e9"}, {"k": 'a\\"'}, {"k": "\x7f"}, [[{"x": 1}, {"x": 2.0}]],
    {"x": 10**25}, [10**25, 1], {"\U0001f600": 1, "\uffff": 2}, {"DOUBLE": 1}, {"b": "{[", "a": "]}"}, [], {}, [[], {}], {"": ""},
    {"10": {"hash": "ab", "index": -1}, "9": {"hash": None, "index": 2}}, [1e300, 1], ["1.0", "1e5"]]


def test_inner_parts_are_written_alike_whole_or_not(spark):
    texts = [json.dumps({"z": inner, "a": inner}, ensure_ascii=i % 2 == 0) for i, inner in enumerate(INNER)]
    rows = spark.createDataFrame(list(enumerate(texts)), "n long, document string")
    found = dict(rows.select("n", variant_json(F.try_parse_json("document"), 5)).collect())
    for n, text in enumerate(texts):
        assert found[n] == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"))


def test_whole_parts_are_no_deeper_than_stated(spark):
    texts = ['{"a":[[1]]}', '{"a":[[]]}', '{"a":{"b":{"c":{}}}}', '{"a":["[[1]]",2]}']
    rows = spark.createDataFrame([(t,) for t in texts], "document string")
    value = F.try_parse_json("document")
    for levels, written in {3: [0, 1, 2, 3], 2: [1, 3], 1: []}.items():
        found = [r[0] for r in rows.coalesce(1).select(variant_json(value, levels)).collect()]
        assert found == [t if i in written else None for i, t in enumerate(texts)]


def test_plain_inner_parts_are_one_part(spark):
    """However many entries a manifest has, Spark writes them in one go."""
    chunks = {str(i): {"hash": "ab", "index": i, "size": 500} for i in range(1_000)}
    rows = spark.createDataFrame([(json.dumps({"chunks": chunks, "ratio": 0.5}),)], "document string")
    assert rows.select(F.size(_tokens(F.try_parse_json("document"), 3))).first()[0] < 10


def test_documents_as_records(spark):
    record = manifest([b"one", b"two"])
    extra = {"build": {"host": "h", "tags": ["a", None, 1.50]}, "é": True}
    broken = {
        1: record, 2: {**record, **extra}, 3: {k: v for k, v in record.items() if k != "chunks"}, 4: {**record, "chunks": [1]},
        5: {**record, "total_chunks": "2"}, 6: {**record, "chunks": {**record["chunks"], "1": {"index": 1}}},
        7: {**record, "chunks": {**record["chunks"], "x": {"hash": "h"}}}}
    texts = {n: json.dumps(d) for n, d in broken.items()} | {8: "{", 9: '{"a": 1, "a": 2}', 10: None, 11: '{"a":' * 30 + "1" + "}" * 30}
    rows = spark.createDataFrame(list(texts.items()), "firmware_id long, document string")
    records = firmware.records_of_documents(rows)
    canonical = {r["firmware_id"]: r["manifest_json"] for r in records.collect()}
    for n, document in broken.items():
        assert canonical[n] == json.dumps(document, sort_keys=True, separators=(",", ":"))
    assert all(canonical[n] is None for n in (8, 9, 10, 11))
    received = spark.createDataFrame([(n, i, bytearray(c)) for n in texts for i, c in enumerate([b"one", b"two"])],
                                     "firmware_id long, chunk_index int, payload binary")
    verdicts = firmware.firmware_verdicts(records.withColumn("signature_valid", F.lit(True)), received)
    assert {r["firmware_id"]: r["verdict"] for r in verdicts.collect()} == {
        1: "OK", 2: "OK", 3: "STRUCTURE_ERROR", 4: "STRUCTURE_ERROR", 5: "STRUCTURE_ERROR", 6: "MALFORMED_MANIFEST",
        7: "MALFORMED_MANIFEST", **{n: "STRUCTURE_ERROR" for n in (8, 9, 10, 11)}}


def test_records_with_more_fields_are_signed_with_them(spark):
    record = manifest([b"x"]) | {"device_model": "m"}
    df = spark.createDataFrame([{"firmware_id": 1, **record}], MANIFEST).withColumns({
        "zone": F.lit(3), "build": F.struct(F.lit("é").alias("host"), F.array(F.lit(0.5), F.lit(1e20)).alias("ratios"))})
    extra = record | {"zone": 3, "build": {"host": "é", "ratios": [0.5, 1e20]}}
    expected = json.dumps(extra, sort_keys=True, separators=(",", ":"))
    assert firmware.manifest_documents(df).first()["manifest_json"] == expected


def test_floats_are_written_as_the_shortest_text(spark):
    numbers = [0.0, 0.1, 1e16, 1e15, 123456789012345680.0, 1e-4, 1e-5, 1.7976931348623157e308, 2.0**-44, 1e23, -2.5, 1 / 3,
               5.521910708222611e18]
    rows = spark.createDataFrame([(n,) for n in numbers], "d double").select("d", json_float(F.col("d")).alias("j")).collect()
    assert [r["j"] for r in rows] == [json.dumps(r["d"]) for r in rows]
