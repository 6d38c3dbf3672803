"""Signed manifests as test data: the signatures the registered queries audit.

Not a part of the engine, which only verifies. The key pair in `keys` was made for
these queries and protects nothing.
"""

import hashlib
import sys
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType

from fleetwright.functions import pss
from fleetwright.operators import signatures
from fleetwright.session import cut_lineage

# Tasks get the arithmetic with the UDF, as for the verification.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KEYS = Path(__file__).parent / "keys"
_HASH_BYTES = 32


class PrivateKey(NamedTuple):
    modulus: int
    exponent: int
    secret: int
    primes: tuple[int, int]

    @property
    def public(self) -> pss.PublicKey:
        return pss.PublicKey(self.modulus, self.exponent)



def read_private_key(pem: bytes) -> PrivateKey:
    """Key of an unencrypted PEM `PRIVATE KEY` block."""
    inner = pss.pem_body(pem)[2][1]
    modulus, exponent, secret, p, q = (int.from_bytes(v) for _, v in pss.der_items(pss.der_items(inner)[0][1])[1:6])
    return PrivateKey(modulus, exponent, secret, (p, q))


def sample_private_key() -> PrivateKey:
    return read_private_key((_KEYS / "sample_private_key.pem").read_bytes())


def sample_public_key() -> pss.PublicKey:
    return signatures.load_public_key(_KEYS / "sample_public_key.pem")


def _mask(seed: bytes, length: int) -> bytes:
    """`length` bytes drawn from hashes of the seed and a counter."""
    blocks = [hashlib.sha256(seed + n.to_bytes(4)).digest() for n in range(-(-length // _HASH_BYTES))]
    return b"".join(blocks)[:length]


def sign(key: PrivateKey, digest: bytes, power: Callable[[int], int] | None = None) -> bytes:
    """A signature of the digest, laid out byte by byte. The salt is derived from
    digest and secret, so a recomputed task repeats it.

    Who signs many hands over `private_power(key)`.
    """
    size = -(-key.modulus.bit_length() // 8)
    salt = _mask(key.secret.to_bytes(size) + digest, size - _HASH_BYTES - 2)
    salted = hashlib.sha256(bytes(8) + digest + salt).digest()
    plain = b"\x01" + salt
    block = int.from_bytes(plain) ^ int.from_bytes(_mask(salted, len(plain)))
    # The encoded message has one bit less than the modulus.
    block &= (1 << 8 * len(plain) - (8 * size - key.modulus.bit_length() + 1)) - 1
    power = private_power(key) if power is None else power
    return power(int.from_bytes(block.to_bytes(len(plain)) + salted + b"\xbc")).to_bytes(size)


def private_power(key: PrivateKey) -> Callable[[int], int]:
    """`number ** secret`, computed modulo each prime and put together, as a function."""
    p, q = key.primes
    at_both, inverse = pss.powers_of((key.secret % (p - 1), p), (key.secret % (q - 1), q)), pow(q, -1, p)

    def power(number: int) -> int:
        top, rest = at_both(number)
        return rest + (top - rest) * inverse % p * q

    return power


def signatures_of(records: DataFrame) -> DataFrame:
    """(firmware_id, signature) of every manifest by the sample key, made once."""
    key = sample_private_key()

    @F.pandas_udf(BinaryType())
    def signature(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        power = private_power(key)
        for digests in batches:
            yield digests.map(lambda d: sign(key, d, power))

    rows = signatures.spread(signatures.manifest_digests(records))
    return cut_lineage(rows.select("firmware_id", signature("digest").alias("signature")))
