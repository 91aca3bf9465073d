"""Key derivations for the envelope versions.

* ``1.1``: PKCS #12 derivation (RFC 7292, appendix B) with SHA-256: the AES-128
  key is id 1 and the CBC IV is id 2, from the pass phrase and a 16-byte salt.
* ``2.0``: PBKDF2-HMAC-SHA256 from the pass phrase and one salt per job, then
  HMAC-SHA256 of the bucket of values that the key is for.

These are per-salt helpers.  On Spark they run in an Arrow ``pandas_udf`` that
derives once per distinct salt; the cipher itself stays native.
"""

from __future__ import annotations

import base64
import hashlib
import hmac
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

# The UDFs below run in executor Python workers, which need not have this
# package installed: ship this module's code with them (pickled by value).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the 1.1 envelope (they must match existing readers/writers).
PKCS12_ROUNDS = 1000
PKCS12_BLOCK = 64          # SHA-256 input block, bytes
PKCS12_KEY_ID, PKCS12_IV_ID = 1, 2
AES128_BYTES = 16
# Our 2.0 envelope.
PBKDF2_ROUNDS = 100_000
AES256_BYTES = 32
KEYS_KEPT = 4096


def _stretch(data: bytes, block: int) -> bytes:
    """Repeat ``data`` to the next multiple of ``block`` bytes (empty stays empty)."""
    if not data:
        return b""
    size = block * ((len(data) + block - 1) // block)
    return (data * (size // len(data) + 1))[:size]


def pkcs12_derive(passphrase: str, salt: bytes, ident: int, *, rounds: int = PKCS12_ROUNDS,
                  size: int = AES128_BYTES) -> bytes:
    """One PKCS #12 derivation; ``size`` up to one hash (32 bytes)."""
    if size > 32:
        raise ValueError("only one SHA-256 block is derived")
    password = passphrase.encode("utf-16-be") + b"\x00\x00"
    data = bytes([ident]) * PKCS12_BLOCK + _stretch(salt, PKCS12_BLOCK) + _stretch(password, PKCS12_BLOCK)
    digest = hashlib.sha256(data).digest()
    for _ in range(rounds - 1):
        digest = hashlib.sha256(digest).digest()
    return digest[:size]


def pbkdf2_key(passphrase: str, salt: bytes, *, rounds: int = PBKDF2_ROUNDS) -> bytes:
    return hashlib.pbkdf2_hmac("sha256", passphrase.encode("utf-8"), salt, rounds, AES256_BYTES)


def pkcs12_key_iv_udf(passphrase: str):
    """``salt binary -> struct<key binary, iv binary>``; null salt gives null."""

    @F.pandas_udf("key binary, iv binary")
    def derive_key_iv(salts: pd.Series) -> pd.DataFrame:
        cache: dict[bytes, tuple[bytes, bytes]] = {}
        keys, ivs = [], []
        for salt in salts:
            if salt is None or (isinstance(salt, float) and pd.isna(salt)):
                keys.append(None)
                ivs.append(None)
                continue
            salt = bytes(salt)
            pair = cache.get(salt)
            if pair is None:
                pair = cache[salt] = (pkcs12_derive(passphrase, salt, PKCS12_KEY_ID),
                                      pkcs12_derive(passphrase, salt, PKCS12_IV_ID))
            keys.append(pair[0])
            ivs.append(pair[1])
        return pd.DataFrame({"key": keys, "iv": ivs})

    return derive_key_iv


def parse_salt(text: str) -> tuple[bytes, int | None]:
    """``<base64 job salt>`` or ``<base64 job salt>:<bucket>``; anything else is a ValueError."""
    salt, colon, bucket = text.partition(":")
    if colon and not bucket.isdecimal():
        raise ValueError("not a bucket")
    return base64.b64decode(salt, validate=True), int(bucket) if colon else None


def data_key(job_key: bytes, bucket: int | None) -> bytes:
    """The key of one bucket of a job's values; without a bucket, the job key itself."""
    if bucket is None:
        return job_key
    return hmac.new(job_key, b"bucket" + bucket.to_bytes(4, "big"), hashlib.sha256).digest()


def key_of_salt(passphrase: str, text: str | None, cache: dict[bytes, bytes]) -> bytes | None:
    """The key a ``2.0`` envelope's salt asks for, or None if the salt is not valid.  ``cache`` keeps at most
    KEYS_KEPT job keys."""
    if text is None:
        return None
    try:
        salt, bucket = parse_salt(text)
        if salt not in cache:
            if len(cache) >= KEYS_KEPT:
                cache.clear()
            cache[salt] = pbkdf2_key(passphrase, salt)
        return data_key(cache[salt], bucket)
    except (ValueError, OverflowError):
        return None


def pbkdf2_key_udf(passphrase: str):
    """``salt text -> key binary``: derived once per distinct job salt, kept across the batches of a task."""

    @F.pandas_udf("binary")
    def derive_key(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[bytes, bytes] = {}
        for salts in batches:
            yield pd.Series([key_of_salt(passphrase, s if isinstance(s, str) else None, cache) for s in salts], dtype=object)

    return derive_key
