"""Keyed Bloom filters (cryptographic long-term keys) of person records, by linkage schema.

The construction is that of public descriptions of the scheme (HKDF keys per feature, padded n-grams,
a fixed number of bits per feature, keyed BLAKE2b); no published vectors were at hand, so filters are
not claimed to be bit-compatible with other implementations. Keys travel in the UDF's closure only.
"""

from __future__ import annotations

import base64
import hashlib
import hmac
import json
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONTEXTS = ("individuals", "households")


def check_secret(text: str) -> str:
    """The trimmed secret; an error unless it is hex of 32 digits or more. The message never holds it."""
    secret = text.strip()
    if len(secret) < 32:
        raise ValueError("the secret is shorter than 32 characters")
    try:
        bytes.fromhex(secret)
    except ValueError:
        raise ValueError("the secret is not hexadecimal") from None
    return secret


def subkey(secret: str, context: str) -> str:
    """HMAC-SHA256 of the context under the secret's text, as hex."""
    if context not in CONTEXTS:
        raise ValueError(f"context {context} is none of {CONTEXTS}")
    return hmac.new(secret.encode(), context.encode(), hashlib.sha256).hexdigest()


def hkdf(key: bytes, length: int, salt: bytes = b"", info: bytes = b"") -> bytes:
    """RFC 5869 with SHA-256."""
    prk = hmac.new(salt or bytes(32), key, hashlib.sha256).digest()
    out, block, i = b"", b"", 1
    while len(out) < length:
        block = hmac.new(prk, block + info + bytes([i]), hashlib.sha256).digest()
        out, i = out + block, i + 1
    return out[:length]


@dataclass(frozen=True)
class Feature:
    name: str
    ignored: bool = True
    n: int = 2
    bits: int = 0
    sentinel: str | None = None
    allowed: tuple[str, ...] = ()


@dataclass(frozen=True)
class Schema:
    length: int
    key_size: int
    features: tuple[Feature, ...]

    @classmethod
    def of(cls, spec: dict) -> Schema:
        if "doubleHash" in json.dumps(spec):
            raise ValueError("doubleHash schemas are refused")
        conf, features = spec["clkConfig"], []
        for f in spec["features"]:
            if f.get("ignored"):
                features.append(Feature(f["identifier"]))
                continue
            h = f["hashing"]
            features.append(
                Feature(
                    f["identifier"],
                    False,
                    h["comparison"]["n"],
                    h["strategy"]["bitsPerFeature"],
                    h.get("missingValue", {}).get("sentinel"),
                    tuple(f["format"].get("values", ())),
                )
            )
        return cls(conf["l"], conf["kdf"].get("keySize", 64), tuple(features))


def example(*hashed: str, ignored: tuple[str, ...] = ("record_id",)) -> dict:
    """A schema document of 4096 bits: bigrams and 300 bits for each field, single letters and 200 for sex."""

    def one(name: str) -> dict:
        kind = {
            "type": "enum", "values": ["A", "F", "M", "NI", "UN", "OT"]
        } if name == "sex" else {"type": "string", "encoding": "utf-8"}
        hashing: dict = {
            "comparison": {"type": "ngram", "n": 1 if name == "sex" else 2, "positional": False},
            "strategy": {"bitsPerFeature": 200 if name == "sex" else 300},
            "hash": {"type": "blakeHash"},
        }
        if name in ("sex", "DOB"):
            hashing["missingValue"] = {"sentinel": ""}
        return {"identifier": name, "format": kind, "hashing": hashing}

    conf = {"l": 4096, "k": 30, "hash": {"type": "blakeHash"}, "kdf": {"type": "HKDF", "hash": "SHA256", "keySize": 64}}
    return {
        "version": 3,
        "clkConfig": conf,
        "features": [*({"identifier": n, "ignored": True} for n in ignored), *map(one, hashed)],
    }


#: The four linkage schemas by name (fixed values: names, fields, bits and lengths).
SCHEMAS = {
    "name-sex-dob-addr": example("given_name", "family_name", "DOB", "sex", "household_street_address", ignored=("record_id", "phone_number", "household_zip")),
    "name-sex-dob-phone": example("given_name", "family_name", "DOB", "sex", "phone_number", ignored=("record_id", "household_street_address", "household_zip")),
    "name-sex-dob-zip": example("given_name", "family_name", "DOB", "sex", "household_zip", ignored=("record_id", "phone_number", "household_street_address")),
    "fn-phone-addr-zip": example("family_name", "phone_number", "household_street_address", "household_zip", ignored=("record_ids",)),
}


def tokens(value: str, n: int) -> list[str]:
    """n-grams, with a blank on both sides for n above 1; none of an empty value."""
    if not value:
        return []
    padded = f" {value} " if n > 1 else value
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def shares(bits: int, count: int) -> list[int]:
    """bits split over count tokens as evenly as can be, the first ones get one more."""
    return [bits // count + (i < bits % count) for i in range(count)]


@lru_cache(1 << 16)
def _stream(key: bytes, token: str, blocks: int) -> np.ndarray:
    raw = b"".join(
        hashlib.blake2b(token.encode(), key=key, salt=i.to_bytes(16, "little")).digest() for i in range(blocks)
    )
    return np.frombuffer(raw, "<u2")


@lru_cache(1 << 16)
def _value(key: bytes, value: str, n: int, most: int, length: int) -> np.ndarray:
    """The filter of one value of one feature; names, dates and codes repeat."""
    bits, grams = np.zeros(length, bool), tokens(value, n)
    for gram, share in zip(grams, shares(most, len(grams)) if grams else (), strict=True):
        bits[_stream(key, gram, -(-share // 32))[:share] % length] = True
    return np.packbits(bits)


def encode(schema: Schema, keys: list[bytes], row: tuple[str | None, ...]) -> bytes:
    """The filter of one record (values of the hashed features, null as blank)."""
    out = np.zeros(-(-schema.length // 8), np.uint8)
    for f, key, value in zip((f for f in schema.features if not f.ignored), keys, row, strict=True):
        value = value or ""
        if f.allowed and value not in f.allowed and value != f.sentinel:
            raise ValueError(f"{f.name}: a value is none of {f.allowed}")
        out |= _value(key, value, f.n, f.bits, schema.length)
    return out.tobytes()


def feature_keys(schema: Schema, key: str) -> list[bytes]:
    """One key for each hashed feature."""
    used = [f for f in schema.features if not f.ignored]
    size = min(schema.key_size, 64)
    long = hkdf(key.encode(), size * len(used))
    return [long[i * size : (i + 1) * size] for i in range(len(used))]


def clks(df: DataFrame, schemas: dict[str, dict], secret: str, context: str = "individuals") -> DataFrame:
    """df with a binary column for each schema, all from one pass over the rows, which are dealt out first:
    a filter takes far longer to make than its row to move. Tasks are a few for each core, as each starts with a cold
    cache of filters."""
    spark = df.sparkSession
    df = df.repartition(min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))
    key = subkey(check_secret(secret), context)
    parsed = {name: Schema.of(s) for name, s in schemas.items()}
    work = [(s, feature_keys(s, key), [f.name for f in s.features if not f.ignored]) for s in parsed.values()]
    fields = list(dict.fromkeys(n for _, _, names in work for n in names))

    @F.pandas_udf(T.StructType([T.StructField(n, T.BinaryType()) for n in parsed]))
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.astype(object).where(rows.notna(), None)
        return pd.DataFrame(
            {
                name: [encode(s, keys, r) for r in rows[list(names)].itertuples(index=False, name=None)]
                for name, (s, keys, names) in zip(parsed, work, strict=True)
            }
        )

    return df.withColumn(
        "__clk", run(F.struct(*[F.col(f).cast("string").alias(f) for f in fields]))
    ).select(*df.columns, "__clk.*")


def text(clk: bytes) -> str:
    return base64.b64encode(clk).decode()
