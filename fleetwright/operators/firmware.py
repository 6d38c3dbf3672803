"""Firmware integrity: chunking, manifests, and the verification stages.

Tables:
  images    firmware_id, firmware_version, device_model, payload
            (text, bytes, or an array of byte chunks)
  records   one manifest per row, see `schemas.MANIFEST`; verification also
            reads `signature_valid`
  received  firmware_id, chunk_index, payload: chunks as delivered, or
            actual_hash in place of payload. chunk_index is the position in
            the delivery, so it identifies a chunk; see `renumber_chunks`

A manifest is one signed document, so work on a single manifest stays within
its row. Work on delivered chunks is spread by (firmware_id, chunk) and reaches
the image only as counts: no task holds all chunks, or all errors, of an image.
Manifests and deliveries are read once each. Payloads are hashed where they are
read; only hashes are shuffled, as part of a key, so that what was delivered as
listed is one group, rows combine by hash before the shuffle, and nothing is sorted
to be judged. What cannot be judged fails: a chunk that comes twice, has no payload, or
a number the manifest does not list, and an image with two manifests that differ.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from fleetwright.functions.chunking import binary_chunks, text_chunks
from fleetwright.functions.canonical_json import DOCUMENT_JSON, LEVELS, manifest_json, nesting, variant_json
from fleetwright.functions.ordering import with_row_index
from fleetwright.schemas import (
    CHUNK_ERROR, CHUNK_SIZE, CONFLICTING_MANIFESTS, COUNT_MISMATCH, HASH_ALGORITHM, MALFORMED_MANIFEST, OK, SEQUENCE_ERROR,
    SIGNATURE_FAILED, STRUCTURE_ERROR,
)

# Our own names for the state of one chunk.
CHUNK_OK = "OK"
MISSING_IN_MANIFEST = "MISSING_IN_MANIFEST"
REPEATED = "REPEATED"
NOT_HASHABLE = "NOT_HASHABLE"
HASH_MISMATCH = "HASH_MISMATCH"
ENTRY_WITHOUT_HASH = "ENTRY_WITHOUT_HASH"
NOT_DELIVERED = "NOT_DELIVERED"
BAD_CHUNK = [MISSING_IN_MANIFEST, REPEATED, NOT_HASHABLE, HASH_MISMATCH]

# Our own messages: an index that was delivered more than once, manifests that differ.
REPEATED_MESSAGE = "Chunk %d: Delivered %d times"
CONFLICT_MESSAGE = "Manifest conflict: the manifests of the image differ"

_HEX_HASH = r"\A[0-9a-f]{64}\z"

# Below every chunk index: what is said of an image itself, and a chunk without index.
_HEAD, _NO_INDEX = -(1 << 62), -(1 << 61)

# ---- fixed values: error messages -------------------------------------------
NO_CHUNKS_FIELD = "Manifest missing 'chunks' field"
NO_TOTAL_FIELD = "Manifest missing 'total_chunks' field"
COUNT_MESSAGE = "Chunk count mismatch: expected %d, got %d"
MISSING_MESSAGE = "Chunk %d: Missing in manifest"
MISMATCH_MESSAGE = "Chunk %d: Hash mismatch. Expected %s..., got %s..."
NO_PAYLOAD_MESSAGE = "Chunk %d verification error: object supporting the buffer API required"
SEQUENCE_MESSAGE = "Chunk sequence error: expected [%s], got [%s]"
SIGNATURE_MESSAGE = "SIGNATURE VERIFICATION FAILED: %s"
BAD_SIGNATURE = "Signature verification failed: "
NO_PUBLIC_KEY = "No public key configured for signature verification"
NO_HASH_MESSAGE = "'hash'"
BAD_KEY_MESSAGE = "invalid literal for int() with base 10: '%s'"
# ---- end of fixed values ----------------------------------------------------


# ---- building ---------------------------------------------------------------

def _pieces(images: DataFrame, size: int) -> Column:
    kind = images.schema["payload"].dataType
    if isinstance(kind, T.ArrayType):
        return F.col("payload")
    if isinstance(kind, T.BinaryType):
        return binary_chunks(F.col("payload"), size)
    return text_chunks(F.col("payload"), size)


def chunk_images(images: DataFrame, size: int = CHUNK_SIZE, *keep: str) -> DataFrame:
    """(firmware_id, chunk_index, payload): consecutive chunks, numbered from 0."""
    return images.select(
        "firmware_id", F.posexplode(_pieces(images, size)).alias("chunk_index", "payload"), *keep,
    ).withColumn("payload", F.col("payload").cast("binary"))


def chunk_hashes(chunks: DataFrame) -> DataFrame:
    """(firmware_id, chunk_index, hash, size)."""
    return chunks.select(
        "firmware_id", "chunk_index",
        F.sha2("payload", 256).alias("hash"), F.octet_length("payload").alias("size"),
    )


def manifest_totals(hashes: DataFrame, descriptions: DataFrame) -> DataFrame:
    """One row per image: version, model, number of chunks, total size, algorithm.

    `descriptions` (firmware_id, firmware_version, device_model) lists the
    images, those without a chunk included. Counts combine before the shuffle.
    """
    totals = hashes.groupBy("firmware_id").agg(
        F.count("*").cast("int").alias("total_chunks"), F.sum("size").alias("total_size"))
    return descriptions.join(totals, "firmware_id", "left").select(
        "firmware_id", "firmware_version", "device_model",
        F.coalesce("total_chunks", F.lit(0)).alias("total_chunks"),
        F.coalesce("total_size", F.lit(0).cast("bigint")).alias("total_size"),
        F.lit(HASH_ALGORITHM).alias("algorithm"),
    )


def manifest_records(images: DataFrame, size: int = CHUNK_SIZE) -> DataFrame:
    """One complete manifest per image, built within its row: no shuffle."""
    pieces = images.select(
        "firmware_id", "firmware_version", "device_model", _pieces(images, size).alias("_pieces"))

    def entry(piece: Column, i: Column) -> Column:
        return F.struct(i.cast("string"), F.struct(
            F.sha2(piece.cast("binary"), 256).alias("hash"),
            i.cast("int").alias("index"),
            F.octet_length(piece).cast("int").alias("size"),
        ))

    total = F.aggregate(
        "_pieces", F.lit(0).cast("bigint"), lambda sum_, piece: sum_ + F.octet_length(piece))
    return pieces.select(
        "firmware_id", "firmware_version", "device_model",
        F.size("_pieces").alias("total_chunks"),
        total.alias("total_size"),
        F.lit(HASH_ALGORITHM).alias("algorithm"),
        F.map_from_entries(F.transform("_pieces", entry)).alias("chunks"),
    )


def manifest_documents(records: DataFrame) -> DataFrame:
    """(firmware_id, manifest_json, manifest_digest) of every manifest."""
    return (
        records.select("firmware_id", manifest_json(records).alias("manifest_json"))
        .withColumn("manifest_digest", F.sha2("manifest_json", 256))
    )


def records_of_documents(documents: DataFrame, levels: int | None = None) -> DataFrame:
    """Manifest records, with `manifest_json`, of documents (firmware_id, document: JSON text).

    A document may have any fields: verification reads those it knows, and the canonical
    text, which is what was signed, holds them all. A document that is no JSON, has a key
    twice, or is nested deeper than `levels`, has no canonical text, so no signature
    is right for it. A known field of another type counts as missing. Where `levels`
    is not stated a job looks for the deepest document, up to `LEVELS`.
    """
    if levels is None:
        levels = min(documents.agg(F.max(nesting(F.col("document")))).first()[0] or 0, LEVELS)
    fields = F.col("_fields")
    parsed = documents.select("firmware_id", F.try_parse_json("document").alias("_document")).withColumn(
        "_fields", F.col("_document").try_cast("map<string,variant>"))

    def number(value: Column, kind: str) -> Column:
        return F.when(F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL)"), value.try_cast(kind))

    def text(value: Column) -> Column:
        return F.when(F.schema_of_variant(value) == "STRING", value.try_cast("string"))

    def entry(key: Column, value: Column) -> Column:
        members = value.try_cast("map<string,variant>")
        return F.struct(text(members["hash"]).alias("hash"), number(members["index"], "int").alias("index"),
                        number(members["size"], "int").alias("size"))

    return parsed.select(
        "firmware_id", text(fields["firmware_version"]).alias("firmware_version"),
        text(fields["device_model"]).alias("device_model"), number(fields["total_chunks"], "int").alias("total_chunks"),
        number(fields["total_size"], "bigint").alias("total_size"), text(fields["algorithm"]).alias("algorithm"),
        F.transform_values(fields["chunks"].try_cast("map<string,variant>"), entry).alias("chunks"),
        variant_json(F.col("_document"), levels).alias(DOCUMENT_JSON),
    )


def renumber_chunks(landed: DataFrame, sequence: str = "sequence") -> DataFrame:
    """(firmware_id, chunk_index, actual_hash) for landed rows (firmware_id, `sequence`, payload).

    A chunk's index is its position in the delivery, so gaps in the landing
    sequence close; a row landed again, with the same number and content,
    counts once. Positions come from global row numbers minus the first of the
    image, so one huge image is numbered in parallel; the payload is hashed
    first and not moved. Runs a job.
    """
    hashed = landed.select("firmware_id", sequence, F.sha2("payload", 256).alias("actual_hash")).distinct()
    numbered = with_row_index(hashed, "firmware_id", sequence, "actual_hash")
    first = numbered.groupBy("firmware_id").agg(F.min("row_index").alias("_first"))
    index = (F.col("row_index") - F.col("_first")).cast("int").alias("chunk_index")
    return numbered.join(first, "firmware_id").select("firmware_id", index, "actual_hash")


# ---- single stages ----------------------------------------------------------

def manifest_entries(records: DataFrame) -> DataFrame:
    """(firmware_id, chunk_key, chunk_index, expected_hash): one row per manifest entry.

    The index is NULL for a key that is not the plain decimal form of one: "00"
    or "x1" names no chunk. The plain explode would add a filter on the map,
    pushed to where the map is computed: a map built on the fly would be built
    twice.
    """
    number = F.col("chunk_key").try_cast("int")
    return (
        records.select("firmware_id", F.explode_outer("chunks").alias("chunk_key", "_entry"))
        .filter(F.col("chunk_key").isNotNull())
        .select(
            "firmware_id", "chunk_key",
            F.when(number.cast("string") == F.col("chunk_key"), number).alias("chunk_index"),
            F.col("_entry.hash").alias("expected_hash"),
        )
    )


def delivered_hashes(received: DataFrame, *keep: str) -> DataFrame:
    """(firmware_id, chunk_index, actual_hash) of delivered chunks, and columns to keep.

    A given hash that is no SHA-256 in lower-case hexadecimal is none.
    """
    given = F.when(F.col("actual_hash").rlike(_HEX_HASH), F.col("actual_hash"))
    digest = given if "actual_hash" in received.columns else F.sha2("payload", 256)
    return received.select("firmware_id", "chunk_index", digest.alias("actual_hash"), *keep)


def match_chunks(delivered: DataFrame, entries: DataFrame) -> DataFrame:
    """Delivered hashes, each row by itself, with the state it has by the manifest entries."""
    expected, actual = F.col("expected_hash"), F.col("actual_hash")
    result = (
        F.when(F.col("_listed").isNull(), MISSING_IN_MANIFEST)
        .when(expected.isNull(), ENTRY_WITHOUT_HASH)
        .when(actual.isNull(), NOT_HASHABLE)
        .when(expected != actual, HASH_MISMATCH)
        .otherwise(CHUNK_OK)
    )
    listed = entries.withColumn("_listed", F.lit(True))
    return delivered.join(listed, ["firmware_id", "chunk_index"], "left").withColumn("result", result).drop("_listed")




# What a row of `_chunk_groups` is about.
_HASHED, _WITHOUT_CONTENT, _WITHOUT_HASH, _NOTE = range(4)


def _manifest_rows(records: DataFrame, head: Column, expand: Column) -> DataFrame:
    """From one read of the manifests, rows (firmware_id, chunk_index, side, hash, head, chunk_key).

    One with `head` per manifest; of the manifests for which `expand` holds one for each
    entry, those that name no chunk with their `chunk_key`.
    """
    entries = F.transform(F.map_entries("chunks"), lambda e: F.struct(e["key"].alias("key"), e["value"]["hash"].alias("hash")))
    kind = "array<struct<key: string, hash: string>>"
    own = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("hash")))
    listed = F.concat(own, F.coalesce(F.when(F.col("_expand"), entries), F.array().cast(kind)))
    rows = records.select("firmware_id", "chunks", head.alias("_head"), expand.alias("_expand")).select(
        "firmware_id", "_head", F.explode(listed).alias("_entry"))
    key, hash_ = F.col("_entry.key"), F.col("_entry.hash")
    number = key.try_cast("int")
    named = F.coalesce(number.cast("string") == key, F.lit(False))
    index = F.when(key.isNull(), _HEAD).when(named, number.cast("bigint")).otherwise(_NO_INDEX)
    return rows.select(
        # Known not to be NULL: a join on it adds no filter then, and the shuffle stays one for all.
        "firmware_id", F.coalesce(index, F.lit(_NO_INDEX)).alias("chunk_index"),
        F.when(~named, _NOTE).when(hash_.isNull(), _WITHOUT_HASH).otherwise(_HASHED).alias("side"), hash_.alias("hash"),
        F.when(key.isNull(), F.col("_head")).alias("head"), F.when(~named, key).alias("chunk_key"))


def _chunk_groups(records: DataFrame, received: DataFrame, head: Column, expand: Column) -> DataFrame:
    """(firmware_id, chunk_index, side, hash, head, chunk_key, delivered, listed).

    One row per image, chunk index and hash, with how often it was delivered and is listed,
    and one per different note of a manifest (see `_manifest_rows`), with neither. Manifests
    and deliveries are each read once and meet in one shuffle; what one task has of a group is
    combined before it, by hash. A delivered chunk without index counts as one that no
    manifest lists; a row without image belongs to none. Readers that ask for both numbers
    share the shuffle.
    """
    known = F.col("firmware_id").isNotNull()
    manifest = _manifest_rows(records.filter(known), head, expand)
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    told = manifest.withColumns({"delivered": zero, "listed": F.when(F.col("side") != _NOTE, one).otherwise(zero)})
    sent = delivered_hashes(received.filter(known)).select(
        "firmware_id", F.coalesce(F.col("chunk_index").cast("bigint"), F.lit(_NO_INDEX)).alias("chunk_index"),
        F.when(F.col("actual_hash").isNull(), _WITHOUT_CONTENT).otherwise(_HASHED).alias("side"),
        F.col("actual_hash").alias("hash"), F.lit(None).cast(manifest.schema["head"].dataType).alias("head"),
        F.lit(None).cast("string").alias("chunk_key"), one.alias("delivered"), zero.alias("listed"))
    return sent.union(told).groupBy("firmware_id", "chunk_index", "side", "hash", "head", "chunk_key").agg(
        F.sum("delivered").alias("delivered"), F.sum("listed").alias("listed"))


def _of_chunks() -> Column:
    """Rows of chunks, not notes: told by the numbers, as a test of the key would go below the shuffle."""
    return F.col("delivered") + F.col("listed") > 0


def _chunk_states(groups: DataFrame) -> DataFrame:
    """(firmware_id, head, chunk_index, delivered, listed, result): one row per image and chunk index
    that was delivered or is listed, however often; the heads, with a NULL index, stay apart."""
    both = (F.col("delivered") > 0) & (F.col("listed") > 0)
    index = F.when(_of_chunks(), F.col("chunk_index")).alias("chunk_index")
    met = groups.groupBy("firmware_id", "head", index).agg(
        F.sum("delivered").alias("delivered"), F.sum("listed").alias("listed"), F.max(both).alias("as_listed"),
        F.max(F.col("side") == _WITHOUT_HASH).alias("bare"), F.max(F.col("side") == _WITHOUT_CONTENT).alias("empty"))
    result = (
        F.when(F.col("delivered") == 0, NOT_DELIVERED)
        .when(F.col("listed") == 0, MISSING_IN_MANIFEST)
        .when(F.col("bare"), ENTRY_WITHOUT_HASH)
        .when(F.col("delivered") > 1, REPEATED)
        .when(F.col("empty"), NOT_HASHABLE)
        .when(~F.col("as_listed"), HASH_MISMATCH)
        .otherwise(CHUNK_OK)
    )
    return met.select("firmware_id", "head", "chunk_index", "delivered", "listed", result.alias("result"))


def _with_hashes(states: DataFrame, groups: DataFrame) -> DataFrame:
    """Chunk rows of `_chunk_states` with `actual_hash`, if delivered once, and `expected_hash`.

    The hashes of an index that was delivered several times are not looked up, so few rows
    share an index. Where manifests list several hashes the greatest is shown.
    """
    sent, told = F.col("_sent") > 0, F.col("_told") > 0
    texts = groups.filter(_of_chunks()).select(
        "firmware_id", "chunk_index", "hash", F.col("delivered").alias("_sent"), F.col("listed").alias("_told"))
    looked_up = states.join(texts.alias("t"), (
        (states["firmware_id"] == F.col("t.firmware_id")) & (states["chunk_index"] == F.col("t.chunk_index"))
        & (told | (states["delivered"] == 1))), "left")
    place = Window.partitionBy(states["firmware_id"], states["chunk_index"])
    return looked_up.select(
        states["*"], F.max(F.when(sent & (states["delivered"] == 1), F.col("hash"))).over(place).alias("actual_hash"),
        F.max(F.when(told, F.col("hash"))).over(place).alias("expected_hash"),
        F.row_number().over(place.orderBy("hash")).alias("_n")).filter(F.col("_n") == 1).drop("_n")


def chunk_hash_check(records: DataFrame, received: DataFrame) -> DataFrame:
    """(firmware_id, chunk_key, actual_hash, expected_hash, result).

    One row per delivered chunk index and manifest entry, whichever side lacks
    it. An index delivered several times has no single hash.
    """
    groups = _chunk_groups(records, received, F.lit(True), F.lit(True))
    states = _chunk_states(groups).filter(F.col("delivered") + F.col("listed") > 0)
    found = _with_hashes(states, groups).select(
        "firmware_id", F.when(F.col("chunk_index") != _NO_INDEX, F.col("chunk_index").cast("string")).alias("chunk_key"),
        "actual_hash", "expected_hash", "result")
    # An explode keeps the test of the key above the shuffle.
    keys = F.filter(F.array(F.struct("chunk_key", "hash")), lambda n: n["chunk_key"].isNotNull())
    other = groups.filter((F.col("delivered") == 0) & (F.col("listed") == 0)).select(
        "firmware_id", F.explode(keys).alias("_entry")).select(
        "firmware_id", "_entry.chunk_key", F.lit(None).cast("string").alias("actual_hash"),
        F.col("_entry.hash").alias("expected_hash"), F.lit(NOT_DELIVERED).alias("result"))
    return found.union(other)


def manifest_structure_check(records: DataFrame) -> DataFrame:
    """(firmware_id, structure_error): the first missing field, NULL when complete."""
    return records.select("firmware_id", _structure_error().alias("structure_error"))


def _structure_error() -> Column:
    return (
        F.when(F.col("chunks").isNull(), NO_CHUNKS_FIELD)
        .when(F.col("total_chunks").isNull(), NO_TOTAL_FIELD)
    )


def delivered_counts(received: DataFrame) -> DataFrame:
    """(firmware_id, delivered) of the images with a chunk."""
    return received.groupBy("firmware_id").agg(F.count("*").alias("delivered"))


def chunk_count_check(records: DataFrame, received: DataFrame) -> DataFrame:
    """(firmware_id, total_chunks, delivered, count_error) of manifests that state a count."""
    return (
        records.filter(F.col("total_chunks").isNotNull())
        .select("firmware_id", "total_chunks")
        .join(delivered_counts(received), "firmware_id", "left")
        .withColumn("delivered", F.coalesce("delivered", F.lit(0).cast("bigint")))
        .withColumn("count_error", F.when(F.col("total_chunks") != F.col("delivered"), _count_error()))
    )


def _count_error() -> Column:
    return F.format_string(COUNT_MESSAGE, F.col("total_chunks"), F.col("delivered"))


def _key_numbers() -> Column:
    return F.transform(F.map_keys("chunks"), lambda k: k.try_cast("bigint"))


def _consecutive(count: Column) -> Column:
    """`[0, 1, .. count - 1]`; sequence(0, -1) would count downwards."""
    numbers = F.sequence(F.lit(0).cast("bigint"), F.greatest(count - 1, F.lit(0)).cast("bigint"))
    return F.when(count > 0, numbers).otherwise(F.array().cast("array<bigint>"))


def with_key_sequence(records: DataFrame) -> DataFrame:
    """Add `bad_key`, `in_sequence` and `found_keys`.

    `bad_key` is the first key that is no integer; `found_keys` holds the
    sorted keys where they are not exactly 0 .. total_chunks - 1. All within
    the manifest's row; lengths come from the keys, not from the stated total.
    """
    found, count = F.col("_found"), F.size("_found")
    bad_keys = F.filter(F.map_keys("chunks"), lambda k: k.try_cast("bigint").isNull())
    # NULLs sort first, so one look tells whether any key is no integer.
    any_bad = (count > 0) & F.get(found, F.lit(0)).isNull()
    complete = F.col("bad_key").isNull() & (count == F.col("total_chunks")) & (found == _consecutive(count))
    return (
        records.withColumn("_found", F.sort_array(_key_numbers()))
        .withColumn("bad_key", F.when(any_bad, F.get(bad_keys, F.lit(0))))
        .withColumn("in_sequence", F.coalesce(complete, F.lit(False)))
        .withColumn("found_keys", F.when(~F.col("in_sequence"), found))
        .drop("_found")
    )


def chunk_sequence_check(records: DataFrame) -> DataFrame:
    """(firmware_id, bad_key, in_sequence, found_keys) of manifests with chunks."""
    return (
        with_key_sequence(records.filter(F.col("chunks").isNotNull()))
        .select("firmware_id", "bad_key", "in_sequence", "found_keys")
    )


# ---- complete verification --------------------------------------------------

_HEAD_FIELDS = ["firmware_version", "total_chunks", "bad_key", "in_sequence", "found_keys", "signed", "structure_error", "digest"]


def _record_digest(records: DataFrame, canonical: bool) -> Column:
    """What tells manifests apart: the digest of the canonical text, or of all fields as they are."""
    if canonical or DOCUMENT_JSON in records.columns:
        return F.sha2(manifest_json(records), 256)
    fields = [F.sort_array(F.map_entries(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
              for f in records.schema.fields if f.name not in ("firmware_id", "signature_valid")]
    return F.sha2(F.to_json(F.struct(*fields)), 256)


def _verified_groups(records: DataFrame, received: DataFrame, canonical: bool) -> DataFrame:
    """`_chunk_groups` with what the verdict reads of a manifest as `head`.

    Entries of manifests that are known to have failed earlier are not expanded.
    """
    known = "signature_valid" in records.columns
    signed = F.coalesce("signature_valid", F.lit(False)) if known else F.lit(True)
    digested = records.withColumn("digest", _record_digest(records, canonical))
    heads = with_key_sequence(digested).withColumns({"signed": signed, "structure_error": _structure_error()})
    expand = F.col("signed") & F.col("total_chunks").isNotNull()
    return _chunk_groups(heads, received, F.struct(*_HEAD_FIELDS), expand)


# What is known of an image before its chunks: the columns of `manifest_heads`.
HEADS = "firmware_id bigint, firmware_version string, total_chunks int, bad_key string, in_sequence boolean, early string"


def manifest_heads(records: DataFrame) -> DataFrame:
    """One row per image with a manifest (with `signature_valid`): `HEADS`.

    `early` is the verdict that holds whatever is delivered: conflict, signature or structure.
    """
    signed = F.coalesce("signature_valid", F.lit(False)) if "signature_valid" in records.columns else F.lit(False)
    fields = ["firmware_version", "total_chunks", "bad_key", "in_sequence", "signed", "structure_error", "digest"]
    digested = records.filter(F.col("firmware_id").isNotNull()).withColumn("digest", _record_digest(records, False))
    heads = with_key_sequence(digested).withColumns({"signed": signed, "structure_error": _structure_error()})
    image = Window.partitionBy("firmware_id")
    met = heads.select("firmware_id", *fields).distinct().select(
        "*", F.count("*").over(image).alias("_n"), F.row_number().over(image.orderBy("digest", "signed")).alias("_place"))
    early = (
        F.when(F.col("_n") > 1, CONFLICTING_MANIFESTS).when(~F.col("signed"), SIGNATURE_FAILED)
        .when(F.col("structure_error").isNotNull(), STRUCTURE_ERROR)
    )
    return met.filter(F.col("_place") == 1).select(
        "firmware_id", "firmware_version", "total_chunks", "bad_key", "in_sequence", early.alias("early"))


def _by_digest(signatures: DataFrame | None) -> bool:
    return signatures is not None and "manifest_digest" in signatures.columns


def firmware_verdicts(records: DataFrame, received: DataFrame, signatures: DataFrame | None = None) -> DataFrame:
    """One row per image with a manifest: the verdict of the first stage that fails, or OK.

    Whether a manifest's signature is valid is told by a column `signature_valid`
    of the records or, so that manifests need not be joined, by `signatures`
    (firmware_id, manifest_digest, signature_valid), which speaks of the manifest with that
    digest only; without that column, of the image, whose answers must then all be
    yes. A manifest without an answer fails.

    Columns: firmware_id, firmware_version, verdict, error_count, total_chunks,
    delivered, without_hash, structure_error, bad_key, found_keys, manifests. Stages:
    manifests that differ, signature, structure, chunk count, chunk hashes, key sequence.
    Copies of one manifest are one manifest; what differs cannot be judged, and the columns
    that describe it are NULL. A manifest that cannot be evaluated (an entry without hash, a
    key that is no integer) is malformed rather than violated. Sizes and algorithm are not
    verified.

    The count is that of the delivered rows. As no index may come twice, and none
    that is not listed, a right count means that every listed chunk was delivered.
    """
    result, none = F.col("result"), F.lit(0).cast("bigint")
    states = _chunk_states(_verified_groups(records, received, _by_digest(signatures)))
    # A row of counts and a row for each different manifest: few enough to meet in order.
    rows = states.groupBy("firmware_id", "head").agg(
        F.sum("delivered").alias("delivered"), F.count_if(result.isin(BAD_CHUNK)).alias("bad_chunks"),
        F.count_if(result == ENTRY_WITHOUT_HASH).alias("without_hash"))
    image = Window.partitionBy("firmware_id")
    met = rows.select(
        "firmware_id", "head", *[F.sum(c).over(image).alias(c) for c in ("delivered", "bad_chunks", "without_hash")],
        F.count("head").over(image).alias("manifests"),
        F.row_number().over(image.orderBy(F.col("head").isNull(), F.col("head.digest"))).alias("_n"))
    # One row for an image, whatever is said of it; what manifests differ in is not said.
    alone = F.col("manifests") == 1
    known = met.filter((F.col("manifests") > 0) & (F.col("_n") == 1)).select(
        "firmware_id", "delivered", "bad_chunks", "without_hash", "manifests",
        *[F.when(alone, F.col(f"head.{f}")).alias(f) for f in _HEAD_FIELDS])
    if signatures is not None:
        keys = ["firmware_id", "manifest_digest"] if _by_digest(signatures) else ["firmware_id"]
        answer = F.coalesce("signature_valid", F.lit(False))
        answers = signatures.groupBy(*keys).agg(F.bool_and(answer).alias("signed"))
        known = known.drop("signed").withColumnRenamed("digest", "manifest_digest").join(answers, keys, "left")
    elif "signature_valid" not in records.columns:
        known = known.withColumn("signed", F.lit(False))
    verdict = (
        F.when(F.col("manifests") > 1, CONFLICTING_MANIFESTS)
        .when(~F.coalesce("signed", F.lit(False)), SIGNATURE_FAILED)
        .when(F.col("structure_error").isNotNull(), STRUCTURE_ERROR)
        .when(F.col("delivered") != F.col("total_chunks"), COUNT_MISMATCH)
        .when(F.col("without_hash") > 0, MALFORMED_MANIFEST)
        .when(F.col("bad_chunks") > 0, CHUNK_ERROR)
        .when(F.col("bad_key").isNotNull(), MALFORMED_MANIFEST)
        .when(~F.col("in_sequence"), SEQUENCE_ERROR)
        .otherwise(OK)
    )
    error_count = (
        F.when(F.col("verdict") == OK, none)
        .when(F.col("verdict") == CHUNK_ERROR, F.col("bad_chunks"))
        .otherwise(F.lit(1).cast("bigint"))
    )
    return known.withColumn("verdict", verdict).select(
        "firmware_id", "firmware_version", "verdict", error_count.alias("error_count"),
        "total_chunks", "delivered", "without_hash", "structure_error", "bad_key", "found_keys", "manifests",
    )


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    """(verdict, firmware_count)."""
    return verdicts.groupBy("verdict").agg(F.count("*").alias("firmware_count"))


def _listing(numbers: Column) -> Column:
    return F.array_join(F.transform(numbers, lambda n: n.cast("string")), ", ")


def _stage_message(signature_error: str) -> Column:
    """The single error of every verdict but OK and CHUNK_ERROR."""
    verdict = F.col("verdict")
    expected = _consecutive(F.col("delivered"))
    return (
        F.when(verdict == CONFLICTING_MANIFESTS, CONFLICT_MESSAGE)
        .when(verdict == SIGNATURE_FAILED, F.lit(SIGNATURE_MESSAGE % signature_error))
        .when(verdict == STRUCTURE_ERROR, F.col("structure_error"))
        .when(verdict == COUNT_MISMATCH, _count_error())
        .when(verdict == SEQUENCE_ERROR,
              F.format_string(SEQUENCE_MESSAGE, _listing(expected), _listing(F.col("found_keys"))))
        .when((verdict == MALFORMED_MANIFEST) & (F.col("without_hash") > 0), NO_HASH_MESSAGE)
        .when(verdict == MALFORMED_MANIFEST, F.format_string(BAD_KEY_MESSAGE, F.col("bad_key")))
    )


def _chunk_message() -> Column:
    index, result = F.col("chunk_index"), F.col("result")
    expected, actual = F.substring("expected_hash", 1, 16), F.substring("actual_hash", 1, 16)
    return (
        F.when(result == MISSING_IN_MANIFEST, F.format_string(MISSING_MESSAGE, index))
        .when(result == REPEATED, F.format_string(REPEATED_MESSAGE, index, F.col("delivered")))
        .when(result == NOT_HASHABLE, F.format_string(NO_PAYLOAD_MESSAGE, index))
        .otherwise(F.format_string(MISMATCH_MESSAGE, index, expected, actual))
    )


def firmware_errors(
    records: DataFrame, received: DataFrame, signature_error: str = BAD_SIGNATURE,
    verdicts: DataFrame | None = None, first: int | None = None, signatures: DataFrame | None = None,
) -> DataFrame:
    """(firmware_id, verdict, position, message): the error list of every image, as rows.

    With `first`, only so many of each image, in order; the limit acts in every task
    before rows of an image meet.

    A failed stage gives one message. Failed chunks give one each, in the order
    of `position`, the chunk index. Bad chunks find their image by its number; the
    image's side has one row, so the errors of one huge image are split over tasks
    by the adaptive skew join.
    """
    if verdicts is None:
        verdicts = firmware_verdicts(records, received, signatures)
    failed = verdicts.filter(F.col("verdict") != OK)
    staged = failed.filter(F.col("verdict") != CHUNK_ERROR).select(
        "firmware_id", "verdict", F.lit(0).cast("bigint").alias("position"),
        _stage_message(signature_error).alias("message"))
    # Read with the heads, as the verdicts are, the rows come from the verdicts' shuffle.
    groups = _verified_groups(records, received, _by_digest(signatures))
    bad = _chunk_states(groups).filter(F.col("result").isin(BAD_CHUNK))
    # Only a mismatch tells of hashes.
    unlike = _with_hashes(bad.filter(F.col("result") == HASH_MISMATCH), groups)
    others = bad.filter(F.col("result") != HASH_MISMATCH)
    for name in ("actual_hash", "expected_hash"):
        others = others.withColumn(name, F.lit(None).cast("string"))
    with_hash = unlike.unionByName(others)
    on_chunks = failed.filter(F.col("verdict") == CHUNK_ERROR).select("firmware_id", "verdict")
    found = with_hash.select("firmware_id", F.col("chunk_index").alias("position"), _chunk_message().alias("message"))
    if first is not None:
        in_order = Window.partitionBy("firmware_id").orderBy("position")
        found = found.withColumn("_n", F.row_number().over(in_order)).filter(F.col("_n") <= first).drop("_n")
    return found.join(on_chunks, "firmware_id").select("firmware_id", "verdict", "position", "message").union(staged)


def chunk_errors(
    records: DataFrame, received: DataFrame, verdicts: DataFrame | None = None,
) -> DataFrame:
    """(firmware_id, position, message): every bad chunk of images that fail on chunks."""
    errors = firmware_errors(records, received, verdicts=verdicts)
    return errors.filter(F.col("verdict") == CHUNK_ERROR).drop("verdict")


def first_errors(errors: DataFrame, count: int = 3) -> DataFrame:
    """(firmware_id, errors): the first `count` messages per image, in order.

    `firmware_errors(..., first=count)` gives the rows without the others being moved.
    """
    by_position = Window.partitionBy("firmware_id").orderBy("position")
    first = errors.withColumn("_n", F.row_number().over(by_position)).filter(F.col("_n") <= count)
    messages = F.transform(F.array_sort(F.collect_list(F.struct("_n", "message"))), lambda e: e["message"])
    return first.groupBy("firmware_id").agg(messages.alias("errors"))
