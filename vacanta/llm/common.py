"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacanta.sources.workspace import new_folder

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def column(name: str) -> Column:
    """The column of that very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(docs: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns that are named like none of ``names``, in whatever case."""
    taken = {n.lower() for n in names}
    return [c for c in docs.columns if c.lower() not in taken]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def park(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    What follows starts from committed files: a lost executor costs the tasks
    it was running, not the work before.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id's text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


# --- Bloom filter of a fixed size -------------------------------------------------------

FILTER_BITS = 1 << 23
SHIFTS = (0, 19, 38)  # of a hash, for its places in the filter


def bloom_bits(rows: DataFrame, hash_column: str) -> bytes:
    """Filter over 64-bit hashes; whatever the rows, it has ``FILTER_BITS`` bits.

    At most one number per byte of it reaches the driver. Too many rows make
    the filter let everything pass, never leave something out.
    """
    # FILTER_BITS is a power of two: the remainder is the low bits.
    places = (F.shiftrightunsigned(hash_column, n).bitwiseAND(F.lit(FILTER_BITS - 1)) for n in SHIFTS)
    spot = rows.select(F.explode(F.array(*places)).alias("spot"))
    byte = spot.groupBy(F.shiftright("spot", 3).alias("byte")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(spot & 7 as int))")).alias("bits")
    )
    filled = bytearray(FILTER_BITS // 8)
    for r in byte.toLocalIterator():
        filled[r["byte"]] = r["bits"]
    return bytes(filled)


def in_bloom(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each of some unsigned hashes."""
    known = np.frombuffer(bits, np.uint8)
    found = np.ones(len(hashes), bool)
    for shift in SHIFTS:
        spot = (hashes >> np.uint64(shift)) % np.uint64(FILTER_BITS)
        found &= (known[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


# --- hashes of stretches of an array ----------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of an odd number and of its inverse, modulo 2^64.

    With the running sums of ``value * power``, the difference of two of them
    times the inverse power of the first place is a polynomial of the values
    between, the same wherever they stand.
    """
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            steps = np.full(max(n, 1 << 14), base)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mix_bits(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
