"""Fleet and firmware tables derived from the star-schema tables.

A device is an order, its region the region of the ordering customer, and a
firmware image a document. Lookups are left joins, so a device is kept, with
NULL, where a lookup has no row. No join carries a broadcast hint: `customer`
grows with the data, and Spark broadcasts a side only below its size limit.
Beyond it the join shuffles on the customer, where a customer with a large
share of all orders is split by the adaptive skew join.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetwright.functions.columns import device_id
from fleetwright.operators import firmware
from fleetwright.schemas import CHUNK_SIZE, FLEET, MANIFEST_ENTRY, PARTIAL, RAW_FLEET, SUCCESS
from fleetwright.sources.tables import parquet_table

# Columns used of the star-schema tables. Small integer keys are read as bigint,
# whichever integer width the files have.
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"
CUSTOMER = "c_custkey bigint, c_nationkey bigint"
NATION = "n_nationkey bigint, n_regionkey bigint"
REGION = "r_regionkey bigint, r_name string"
LINEITEM = "l_orderkey bigint, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# ---- fixed values -----------------------------------------------------------
# Injected corruption: out-of-bounds signal and garbage voltage.
BAD_SIGNAL = -999
BAD_VOLTAGE = "UNKNOWN"
# ---- end of fixed values ----------------------------------------------------

# What a forger delivers, and lists in a manifest of their own.
FORGED_CHUNK = "forged"


# ---- fleet ------------------------------------------------------------------

def orders(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "orders", ORDERS)


def as_devices(rows: DataFrame) -> DataFrame:
    """Order rows as devices; `region` is kept where the rows have it.

    `home` is the customer number, `number` the plain device number; operators
    that need neither have them pruned from the scan.
    """
    number = F.col("o_orderkey")
    return rows.select(
        device_id(number).alias("device_id"),
        F.round(F.lit(11.8) + (number % 241) * F.lit(0.01), 2).alias("battery_voltage"),
        (F.lit(10) + F.col("o_custkey") % 91).cast("int").alias("signal_strength"),
        F.when(F.col("o_orderstatus") == "P", PARTIAL).otherwise(SUCCESS).alias("update_status"),
        F.col("o_custkey").alias("home"),
        number.alias("number"),
        *[name for name in rows.columns if name == "region"],
    )


def with_region(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """Add `region` to rows that carry `o_custkey`.

    The lookups meet first, one row per customer, so the rows are joined and
    shuffled once, on the customer.
    """
    customer = parquet_table(spark, folder, "customer", CUSTOMER).select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    nation = parquet_table(spark, folder, "nation", NATION).select(
        "n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    region = parquet_table(spark, folder, "region", REGION).select(
        "r_regionkey", F.col("r_name").alias("region"))
    homes = customer.join(nation, "n_nationkey", "left").join(region, "r_regionkey", "left")
    return rows.join(homes.select("o_custkey", "region"), "o_custkey", "left")


def devices(spark: SparkSession, folder: str) -> DataFrame:
    """Devices without the region: one scan, no join."""
    return as_devices(orders(spark, folder))


def located_devices(spark: SparkSession, folder: str) -> DataFrame:
    """Devices with their region. The three plain order columns are joined, and
    the wider device columns made of them afterwards."""
    return as_devices(with_region(spark, folder, orders(spark, folder)))


def fleet(spark: SparkSession, folder: str) -> DataFrame:
    """device_id, region, battery_voltage, signal_strength, update_status."""
    return located_devices(spark, folder).select(*FLEET.names)


def regional_status(spark: SparkSession, folder: str) -> DataFrame:
    """(region, update_status, devices): the fleet as weighted rows for counting.

    Orders are first counted per customer: the count combines on the map side, so
    a customer holding much of the fleet becomes one row per task, and its hash
    partitioning serves the join as well.
    """
    per_customer = devices(spark, folder).groupBy(F.col("home").alias("o_custkey")).agg(
        *[F.count_if(F.col("update_status") == s).alias(s) for s in (PARTIAL, SUCCESS)])
    counted = with_region(spark, folder, per_customer)
    status_rows = F.array(*[
        F.struct(F.lit(s).alias("update_status"), F.col(s).alias("devices")) for s in (PARTIAL, SUCCESS)])
    return (
        counted.select("region", F.inline(status_rows))
        .filter(F.col("devices") > 0)
    )


def corrupted(rows: DataFrame) -> DataFrame:
    """Voltage as text, with one device number in 200 hit by each defect."""
    fault = F.col("number") % 200
    voltage = F.col("battery_voltage").cast("string")
    return rows.withColumns({
        "battery_voltage": F.when(fault == 1, F.lit(None)).when(fault == 3, F.lit(BAD_VOLTAGE)).otherwise(voltage),
        "signal_strength": F.when(fault == 2, F.lit(BAD_SIGNAL)).otherwise(F.col("signal_strength")),
    })


def raw_devices(spark: SparkSession, folder: str) -> DataFrame:
    """Devices as delivered, without the region."""
    return corrupted(devices(spark, folder)).drop("home", "number")


def raw_fleet(spark: SparkSession, folder: str) -> DataFrame:
    """The fleet as delivered, defects included."""
    return corrupted(located_devices(spark, folder)).select(*RAW_FLEET.names)


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(value): the devices as delivered, as lines without a region; by device number modulo 200 some are
    broken: 7 ends early, 9 goes on, 11 has a word for the signal."""
    fault = F.col("number") % 200
    rows = corrupted(devices(spark, folder))
    signal = F.when(fault == 11, F.lit("weak")).otherwise(F.col("signal_strength").cast("string"))
    voltage, status = F.coalesce("battery_voltage", F.lit("")), F.col("update_status")
    head = F.concat_ws(",", "device_id", F.lit(""), voltage)
    return rows.select(
        F.when(fault == 7, head).when(fault == 9, F.concat_ws(",", head, signal, status, F.lit("more")))
        .otherwise(F.concat_ws(",", head, signal, status)).alias("value"))


def status_feed(spark: SparkSession, folder: str) -> DataFrame:
    """(device_id, status, reported_at): one report per line item of an order.

    Several reports per device, and devices unknown to the fleet: line items
    of returned goods report under a number no order has. `reported_at` orders the
    reports by time, line number and line status, as one number.
    """
    line = parquet_table(spark, folder, "lineitem", LINEITEM)
    known = device_id(F.col("l_orderkey"))
    unknown = F.concat(known, F.lit("-X"))
    shipped = F.col("l_shipdate")
    day = F.unix_date(shipped.cast("date")).cast("bigint")
    second = day * 86_400 + F.hour(shipped) * 3_600 + F.minute(shipped) * 60 + F.second(shipped)
    line_order = F.col("l_linenumber") * 2 + F.when(F.col("l_linestatus") == "O", 1).otherwise(0)
    return line.select(
        F.when(F.col("l_returnflag") == "R", unknown).otherwise(known).alias("device_id"),
        F.when(F.col("l_linestatus") == "F", SUCCESS).otherwise(PARTIAL).alias("status"),
        (second * (1 << 20) + line_order).alias("reported_at"),
    )


def mixed_feed(spark: SparkSession, folder: str) -> DataFrame:
    """`status_feed` with statuses that the fleet does not have from every third line."""
    feed = status_feed(spark, folder)
    odd = F.shiftright(F.col("reported_at") % (1 << 20), 1) % 3 == 1
    return feed.withColumn("status", F.when(odd, F.concat(F.lit("Rolled back from "), "status")).otherwise(F.col("status")))


# ---- firmware ---------------------------------------------------------------

def images(spark: SparkSession, folder: str) -> DataFrame:
    """(firmware_id, firmware_version, device_model, payload): one document each."""
    return parquet_table(spark, folder, "documents", DOCUMENTS).select(
        F.col("doc_id").alias("firmware_id"),
        F.concat(F.lit("v1."), F.col("n_chars").cast("string")).alias("firmware_version"),
        F.concat_ws("-", "source", "lang").alias("device_model"),
        F.col("text").alias("payload"),
    )


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest records as published, without faults."""
    return firmware.manifest_records(images(spark, folder), CHUNK_SIZE)


def _extra_entry(key: str) -> Column:
    """The chunks map with one more entry."""
    empty = F.struct(F.sha2(F.lit(""), 256).alias("hash"), F.lit(0).alias("index"), F.lit(0).alias("size"))
    return F.map_concat("chunks", F.create_map(F.lit(key), empty.cast(MANIFEST_ENTRY)))


def _first_entry(change) -> Column:
    """The chunks map with the entry "0" changed."""
    return F.transform_values("chunks", lambda k, v: F.when(k == "0", change(v)).otherwise(v))


def faulty_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """Manifests plus `signature_valid`, with one image in twenty per fault.

    Faults of the manifest by firmware number modulo 20; 2 and 4 to 8 are faults
    of the delivery, see `faulty_chunks`.
    """
    fault = F.col("firmware_id") % 20
    chunks = (
        F.when(fault == 9, _extra_entry("-1"))
        .when(fault == 12, F.lit(None))
        .when(fault == 14, _first_entry(lambda v: v.withField("hash", F.lit(None).cast("string"))))
        .when(fault == 15, _extra_entry("x1"))
        .when(fault == 16, _extra_entry("00"))
        .when(fault == 17, F.map_filter("chunks", lambda k, v: k != "0"))
        .when(fault == 18, _first_entry(lambda v: v.withField("hash", F.upper(v["hash"]))))
        .when(fault == 19, _first_entry(lambda v: v.withField("size", F.lit(0))))
        .otherwise(F.col("chunks"))
    )
    return manifests(spark, folder).withColumns({
        "chunks": chunks,
        "total_chunks": F.when(fault == 13, F.lit(None)).otherwise(F.col("total_chunks")),
        "signature_valid": fault != 11,
    })


def contested_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """`faulty_manifests`, some of them published twice by firmware number modulo 20:
    3 as a copy, 10 with another first hash, that of the chunk delivered in its place."""
    records = faulty_manifests(spark, folder)
    fault = F.col("firmware_id") % 20
    altered = F.sha2(F.lit(FORGED_CHUNK), 256)
    forged = records.filter(fault.isin(3, 10)).withColumns({
        "chunks": F.when(fault == 10, _first_entry(lambda v: v.withField("hash", altered))).otherwise(F.col("chunks")),
        "total_size": F.col("total_size") + F.when(fault == 10, 1).otherwise(0),
    })
    return records.union(forged)


def contested_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """`faulty_chunks`, and chunk 0 of the forged manifests' images in the forger's version."""
    forged = (F.col("firmware_id") % 20 == 10) & (F.col("chunk_index") == 0)
    return faulty_chunks(received_chunks(spark, folder)).withColumn(
        "payload", F.when(forged, F.lit(FORGED_CHUNK).cast("binary")).otherwise(F.col("payload")))


def published_documents(records: DataFrame) -> DataFrame:
    """(firmware_id, document): the manifests as JSON documents, their fields in no order, with
    fields that the verification does not know."""
    model, version = F.col("device_model"), F.col("firmware_version")
    release = F.struct(
        F.concat(model, F.lit(" \u2013 \u00fcn\u00ef \"code\" \U0001f600\n"), version).alias("notes"),
        F.array(F.lit(None).cast("string"), version).alias("channels"),
        F.struct(F.lit(True).alias("signed"), (F.col("total_size") / 8).alias("ratio"),
                 F.col("total_size").alias("number")).alias("build"))
    fields = ["total_size", release.alias("release"), "firmware_version", "chunks", "device_model", "total_chunks", "algorithm"]
    return records.select("firmware_id", F.to_json(F.struct(*fields)).alias("document"))


def received_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """(firmware_id, chunk_index, payload) as sent."""
    return firmware.chunk_images(images(spark, folder), CHUNK_SIZE)


def faulty_chunks(chunks: DataFrame) -> DataFrame:
    """Delivery faults by firmware number modulo 20: 5 and 11 alter every second
    chunk, 7 loses chunk 0, 2 sends chunk 1 under number 0 as well, 4 sends chunk 0
    without content, 6 and 8 number it -1 and 2147483647."""
    fault, index = F.col("firmware_id") % 20, F.col("chunk_index")
    altered = F.concat(F.col("payload"), F.lit("!").cast("binary"))
    return (
        chunks.filter(~((fault == 7) & (index == 0)))
        .withColumns({
            "payload": F.when(fault.isin(5, 11) & (index % 2 == 0), altered)
            .when((fault == 4) & (index == 0), F.lit(None)).otherwise(F.col("payload")),
            "chunk_index": F.when((fault == 2) & (index == 1), 0).when((fault == 6) & (index == 0), -1)
            .when((fault == 8) & (index == 0), 2147483647).otherwise(index),
        })
    )


def landed_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """(firmware_id, sequence, payload): numbers with gaps, even chunks delivered twice."""
    chunks = received_chunks(spark, folder)
    copies = F.when(F.col("chunk_index") % 2 == 0, 2).otherwise(1)
    number = F.col("chunk_index") * 3 + F.col("chunk_index") % 2
    return (
        chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
        .select("firmware_id", number.cast("bigint").alias("sequence"), "payload")
    )


def update_targets(spark: SparkSession, folder: str) -> DataFrame:
    """(device_id, firmware_id): the image each device is to install.

    Devices of one customer share an image. A customer number without a
    document stands for an image that cannot be fetched.
    """
    return devices(spark, folder).select("device_id", F.col("home").alias("firmware_id"))
