"""Auditing the signatures of manifests.

Spark builds the canonical JSON and its digest; Python, by Arrow batches, gets
the 32-byte digest and the signature and does the modular arithmetic.
"""

import os
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType

from fleetwright.functions import pss
from fleetwright.functions.canonical_json import manifest_json
from fleetwright.operators.firmware import BAD_SIGNATURE, NO_PUBLIC_KEY
from fleetwright.session import cut_lineage

# Tasks get the arithmetic with the UDF, so executors need not have this package.
cloudpickle.register_pickle_by_value(pss)


def load_public_key(path: str | None) -> pss.PublicKey | None:
    """The key of a PEM file, None when no file is there."""
    if not path or not os.path.exists(path):
        return None
    with open(path, "rb") as file:
        return pss.read_public_key(file.read())


def manifest_digests(records: DataFrame) -> DataFrame:
    """(firmware_id, digest) of the canonical manifests, made within their rows."""
    return records.select("firmware_id", F.unhex(F.sha2(manifest_json(records), 256)).alias("digest"))


def spread(rows: DataFrame, *more: str) -> DataFrame:
    """Even partitions: the rows are small, but each costs a modular power.

    The number is stated, or the adaptive planner would merge them again by
    size. Cores alone would be too few while a cluster is still growing.
    """
    spark = rows.sparkSession
    stated = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(stated, spark.sparkContext.defaultParallelism), "firmware_id", *more)


def _answers(records: DataFrame, signed: DataFrame, key: pss.PublicKey | None) -> DataFrame:
    """(firmware_id, digest, signature_valid): one row per different manifest of an image.

    Copies of a manifest meet first, and copies of a signature. A manifest is signed if one
    of the signatures of its image is right for it. Of a record only its digest meets
    signatures; the manifest stays where it is read.
    """
    digests = manifest_digests(records).distinct()
    if key is None:
        return digests.withColumn("signature_valid", F.lit(False))

    @F.pandas_udf(BooleanType())
    def valid(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        power = pss.power_of(key.exponent, key.modulus)
        for digests, found in batches:
            yield pd.Series([d is not None and s is not None and pss.verify(key, d, s, power)
                             for d, s in zip(digests, found)], dtype=bool)

    # By the digest as well: a shuffle like the join's own would be left out, and its partitions merged by size.
    rows = spread(digests.join(signed.select("firmware_id", "signature").distinct(), "firmware_id", "left"), "digest")
    checked = rows.select("firmware_id", "digest", valid("digest", "signature").alias("signature_valid"))
    return checked.groupBy("firmware_id", "digest").agg(F.bool_or("signature_valid").alias("signature_valid"))


def audit_signatures(records: DataFrame, signed: DataFrame, key: pss.PublicKey | None) -> DataFrame:
    """(firmware_id, signature_valid, signature_error): one answer per image of the records,
    by the signatures in `signed` (firmware_id, signature).

    Without a key every signature is invalid, and so is a missing one. Of several
    manifests of an image all must be signed.
    """
    image = _answers(records, signed, key).groupBy("firmware_id").agg(F.bool_and("signature_valid").alias("signature_valid"))
    error = F.lit(NO_PUBLIC_KEY if key is None else BAD_SIGNATURE)
    return image.withColumn("signature_error", F.when(~F.col("signature_valid"), error))


def signature_verdicts(records: DataFrame, signed: DataFrame, key: pss.PublicKey | None) -> DataFrame:
    """(firmware_id, manifest_digest, signature_valid): the audit as `firmware_verdicts` takes it,
    an answer for what was signed.

    Runs a job: verdicts and errors both read it, so the audit, one boolean per
    manifest, is checkpointed rather than computed again each time.
    """
    digest = F.lower(F.hex("digest")).alias("manifest_digest")
    return cut_lineage(_answers(records, signed, key).select("firmware_id", digest, "signature_valid"))
