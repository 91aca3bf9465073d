"""Protect whole columns.

An encrypted value is an envelope: base64 of the JSON ``{"ver": ..., "val": ...}``
(plus ``"salt"`` in ``2.0``), so one column may hold several versions and each
value says how to open it.

* ``1.1``: ``val`` is base64 of 16 salt bytes + AES-128-CBC ciphertext; key and
  IV come from the PKCS #12 derivation of the pass phrase and that salt.
* ``2.0`` (ours, the default for new writes): ``val`` is base64 of Spark's
  AES-256-GCM output; the job key is PBKDF2 of the pass phrase and the job's
  salt.  ``salt`` is ``<job salt>:<bucket>``: values are dealt at random over
  KEY_BUCKETS buckets, each with a key of its own, so that no key seals more
  than 2^32 values (the limit for random GCM nonces) before a column has 10^12.
  Envelopes with a plain job salt use the job key itself.
* ``1.0`` (DES) cannot be opened with Spark SQL's ciphers: it is refused by name.

The cipher runs natively (``aes_encrypt`` / ``aes_decrypt``).  Keys never appear
as literals in a plan: a job that seals has a key table of KEY_BUCKETS rows,
broadcast and joined by salt; a job that opens derives per distinct salt in the
tasks (one pass, one plan for any number of salts), or, for a caller who pins
``2.0`` and names the salts, joins a table of just these.
"""

from __future__ import annotations

import base64
import os
import stat
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.names import col, cols, fresh
from ..operators.spread import wide
from .kdf import data_key, key_of_salt, pbkdf2_key, pbkdf2_key_udf, pkcs12_key_iv_udf

# Fixed values of the envelope format.
VERSION_1_0, VERSION_1_1, VERSION_2_0 = "1.0", "1.1", "2.0"
SALT_BYTES = 16
# Keys of one sealing job; the key table has so many rows of about 60 bytes.
KEY_BUCKETS = 1024
# What a refused key file is told.
MSG_NO_FILE = "File does not exist at {path}"
MSG_NOT_A_FILE = "Passphrase path is not a file. {path}"
MSG_PERMISSION = "Passphrase file should only have read only permission on only user. {path}"


def mask(c: Column | str) -> Column:
    """As many ``*`` as the value has characters; null stays null."""
    c = col(c) if isinstance(c, str) else c
    return F.repeat(F.lit("*"), F.length(c))


def mask_columns(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({name: mask(name) for name in columns})


def _check_passphrase(passphrase: str | None) -> None:
    if passphrase is None or passphrase == "":
        raise ValueError("passphrase should not be empty")


def _check_key_file(path: str, exists: bool, is_file: bool, mode: int) -> None:
    for holds, message in ((exists, MSG_NO_FILE), (is_file, MSG_NOT_A_FILE), (mode == 0o400, MSG_PERMISSION)):
        if not holds:
            raise ValueError(message.format(path=path))


def read_passphrase(path: str, spark=None) -> str:
    """First line of a key file that exists, is a file and is readable by its
    owner only (0400).  Read on the driver; never put it in a plan or a log."""
    if spark is None or "://" not in path:
        there = os.stat(path) if os.path.exists(path) else None
        _check_key_file(path, there is not None, there is not None and stat.S_ISREG(there.st_mode),
                        stat.S_IMODE(there.st_mode) if there else 0)
        with open(path, encoding="utf-8") as fh:
            return fh.readline().rstrip("\r\n")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = fs.getFileStatus(p) if fs.exists(p) else None
    _check_key_file(path, there is not None, there is not None and there.isFile(),
                    there.getPermission().toShort() if there else 0)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def _b64(c: Column) -> Column:
    # Spark may break long base64 text into lines; envelopes are one line.
    return F.regexp_replace(F.base64(c), r"[\r\n]", "")


def _refuse_empty(c: Column, value: Column, empty: str) -> Column:
    text = c.cast("string")
    if empty == "raise":
        return (F.when(text.isNull(), F.lit(None).cast("string"))
                 .when(text == "", F.raise_error(F.lit("plaintext should not be empty")))
                 .otherwise(value))
    return F.when(text.isNull() | (text == ""), text).otherwise(value)


def encrypt_columns(df: DataFrame, columns, passphrase: str, *, version: str = VERSION_2_0,
                    empty: str = "raise") -> DataFrame:
    """Replace each value of ``columns`` by its envelope.

    ``empty="raise"`` fails the job on an empty string (as the single-value API
    refuses one); ``empty="keep"`` leaves it unencrypted.  Null stays null.
    Every evaluation draws fresh IVs (and, for ``1.1``, salts): write the
    result once rather than computing it twice.
    """
    _check_passphrase(passphrase)
    columns = list(columns)
    if version == VERSION_2_0:
        return _encrypt_v2(df, columns, passphrase, empty)
    if version == VERSION_1_1:
        # Two key derivations per value (about 1 ms) outweigh a shuffle that gives every core a share.
        return _encrypt_v11(df.repartition(wide(df.sparkSession)), columns, passphrase, empty)
    if version == VERSION_1_0:
        raise ValueError("Version 1.0 (DES) is not supported; use 2.0 or 1.1.")
    raise ValueError(f"Invalid version {version}")


def _encrypt_v2(df: DataFrame, columns, passphrase: str, empty: str) -> DataFrame:
    spark = df.sparkSession
    salt = os.urandom(SALT_BYTES)
    salt_text = base64.b64encode(salt).decode("ascii")
    job_key = pbkdf2_key(passphrase, salt)
    n_salt, n_key = fresh(df.columns, "_tm_salt", "_tm_key")
    # KEY_BUCKETS rows; joined by salt, the keys are in no plan text.
    keys = spark.createDataFrame([(f"{salt_text}:{b}", data_key(job_key, b)) for b in range(KEY_BUCKETS)],
                                 f"{n_salt} string, {n_key} binary")
    # Only values that get sealed ask for a key.
    needs_key = reduce(lambda a, b: a | b, [col(c).isNotNull() for c in columns])
    bucket = F.floor(F.rand() * KEY_BUCKETS).cast("string")
    work = (df.withColumn(n_salt, F.when(needs_key, F.concat(F.lit(f"{salt_text}:"), bucket)))
              .join(F.broadcast(keys), n_salt, "left"))
    out = {}
    for name in columns:
        plain = col(name).cast("string")
        sealed = F.aes_encrypt(plain.cast("binary"), F.col(n_key), F.lit("GCM"))
        envelope = F.to_json(F.struct(F.lit(VERSION_2_0).alias("ver"), F.col(n_salt).alias("salt"),
                                      _b64(sealed).alias("val")))
        out[name] = _refuse_empty(col(name), _b64(envelope.cast("binary")), empty)
    return work.withColumns(out).select(*cols(df.columns))


def _encrypt_v11(df: DataFrame, columns, passphrase: str, empty: str) -> DataFrame:
    """Per value: a random 16-byte salt, key and IV derived from it (Arrow UDF,
    once per salt), then native AES-CBC.  Spark puts the IV in front of the
    ciphertext; the envelope wants the salt there instead."""
    derive = pkcs12_key_iv_udf(passphrase)
    work = df
    salt_of = dict(zip(columns, fresh(df.columns, *[f"_tm_salt_{i}" for i in range(len(columns))])))
    kiv_of = dict(zip(columns, fresh(df.columns, *[f"_tm_kiv_{i}" for i in range(len(columns))])))
    # the salt is drawn once, in its own column, so every use sees the same bytes
    work = work.withColumns({salt_of[c]: F.unhex(F.regexp_replace(F.expr("uuid()"), "-", ""))
                             for c in columns})
    work = work.withColumns({kiv_of[c]: derive(F.when(col(c).isNotNull(), F.col(salt_of[c])))
                             for c in columns})
    final = {}
    for c in columns:
        kiv = F.col(kiv_of[c])
        sealed = F.aes_encrypt(col(c).cast("string").cast("binary"), kiv.getField("key"),
                               F.lit("CBC"), F.lit("PKCS"), kiv.getField("iv"))
        payload = F.concat(F.col(salt_of[c]), F.substr(sealed, F.lit(SALT_BYTES + 1)))
        envelope = F.to_json(F.struct(F.lit(VERSION_1_1).alias("ver"), _b64(payload).alias("val")))
        final[c] = _refuse_empty(col(c), _b64(envelope.cast("binary")), empty)
    return work.withColumns(final).select(*cols(df.columns))


def _parsed(c: Column) -> Column:
    """The envelope's fields, from one parse of the text; nulls where it is none."""
    raw = F.try_to_binary(F.regexp_replace(c, r"[\r\n]", ""), F.lit("base64"))
    return F.from_json(raw.cast("string"), "ver string, val string, salt string")


def decrypt_columns(df: DataFrame, columns, passphrase: str, *, on_error: str = "raise",
                    version: str | None = None, salts=None, tasks: int | None = None) -> DataFrame:
    """Open each envelope of ``columns`` by its own version, in one pass.

    ``on_error="raise"`` fails the job on a value that cannot be opened (bad
    text, unknown or unsupported version, missing or invalid salt, wrong key);
    ``"null"`` gives null.  ``version`` pins one version: an envelope of any
    other cannot be opened.  Keys are derived in the tasks, once per distinct
    salt.  A caller who pins ``2.0`` and knows the job's ``salts`` (the
    envelopes' ``salt`` texts, with or without a bucket) gets a plan without
    Python: a table of these salts' keys is broadcast.  ``tasks`` deals the rows
    to so many tasks first, for ``1.1`` values (about 1 ms each) in a small file.
    """
    _check_passphrase(passphrase)
    if on_error not in ("raise", "null"):
        raise ValueError("on_error is 'raise' or 'null'")
    if version not in (None, VERSION_1_0, VERSION_1_1, VERSION_2_0):
        raise ValueError(f"Invalid version {version}")
    if salts is not None and version != VERSION_2_0:
        raise ValueError("salts are given for a pinned version 2.0")
    columns = list(columns)
    work = df.repartition(tasks) if tasks else df
    n = len(columns)
    env, key, kiv = ([f"{p}{i}" for i in range(n)] for p in ("_tm_env_", "_tm_key_", "_tm_kiv_"))
    made = fresh(df.columns, *env, *key, *kiv)
    env, key, kiv = made[:n], made[n:2 * n], made[2 * n:]
    work = work.withColumns({env[i]: _parsed(col(c)) for i, c in enumerate(columns)})
    salt_of = [F.when(F.col(e)["ver"] == VERSION_2_0, F.col(e)["salt"]) for e in env]
    payload = [F.try_to_binary(F.col(e)["val"], F.lit("base64")) for e in env]

    if version not in (None, VERSION_2_0):
        work = work.withColumns({k: F.lit(None).cast("binary") for k in key})
    elif salts is None:
        derive = pbkdf2_key_udf(passphrase)
        work = work.withColumns({key[i]: derive(salt_of[i]) for i in range(n)})
    else:
        cache: dict[bytes, bytes] = {}
        named = {f"{s}:{b}" for s in salts if ":" not in s for b in range(KEY_BUCKETS)} | set(salts)
        rows = [(s, key_of_salt(passphrase, s, cache)) for s in sorted(named)]
        table = df.sparkSession.createDataFrame(rows, "s string, k binary")
        for i in range(n):
            k = F.broadcast(table.select(F.col("s").alias(f"{key[i]}s"), F.col("k").alias(key[i])))
            work = work.join(k, salt_of[i] == F.col(f"{key[i]}s"), "left").drop(f"{key[i]}s")

    if version in (None, VERSION_1_1):
        derive_11 = pkcs12_key_iv_udf(passphrase)
        work = work.withColumns({
            kiv[i]: derive_11(F.when(F.col(env[i])["ver"] == VERSION_1_1, F.substring(payload[i], 1, SALT_BYTES)))
            for i in range(n)})
    else:
        work = work.withColumns({k: F.lit(None).cast("struct<key:binary,iv:binary>") for k in kiv})

    decrypt = F.try_aes_decrypt if on_error == "null" else F.aes_decrypt
    out = {}
    for i, name in enumerate(columns):
        ver, val, pair = F.col(env[i])["ver"], payload[i], F.col(kiv[i])
        body = F.substr(val, F.lit(SALT_BYTES + 1))
        v11 = decrypt(F.concat(pair.getField("iv"), body), pair.getField("key"), F.lit("CBC"), F.lit("PKCS"))
        v20 = decrypt(val, F.col(key[i]), F.lit("GCM"))
        known = ver
        if version is not None:  # a pinned version sees other envelopes as foreign
            known = F.when(ver == version, ver).otherwise(F.concat(F.lit("foreign "), ver))
        if on_error == "raise":
            bad = lambda msg: F.raise_error(F.lit(msg))
            opened = (F.when(col(name).isNull(), F.lit(None).cast("binary"))
                       .when(ver.isNull() | val.isNull(), bad("not an envelope"))
                       .when(known == VERSION_1_1, v11)
                       .when((known == VERSION_2_0) & F.col(env[i])["salt"].isNull(), bad("version 2.0 without a salt"))
                       .when((known == VERSION_2_0) & F.col(key[i]).isNull(), bad("the salt is not valid or not among those given"))
                       .when(known == VERSION_2_0, v20)
                       .when(known == VERSION_1_0, bad("version 1.0 (DES) is not supported"))
                       .otherwise(F.raise_error(F.concat(F.lit("Invalid version "), known))))
        else:
            opened = F.when(known == VERSION_1_1, v11).when(known == VERSION_2_0, v20)
        out[name] = opened.cast("string")
    return work.withColumns(out).select(*cols(df.columns))
