"""Operator 6: winnowing fingerprints of documents, and their likeness.

A text's k-grams of code points are hashed; of every ``window`` consecutive hashes the least
is selected, the rightmost of equals. Any passage of at least ``window + k - 1`` code points
that two texts share gives them a common selected hash, and the kept positions say where it
stands. A fingerprint is a string with six characters for each selected hash, in text order:
five for 30 bits of the hash, one for the distance from the selection before it (the first:
from the position before the text), at most ``window``. Likeness is the share of distinct
hashes in common, 2 |A and B| / (|A| + |B|).

``fingerprint_neighbours`` compares each text with its edited form and with the next document
in descending id order. Documents are dealt to ranges of ids; each range also gets the one
document that follows its last, so neighbours meet without a second shuffle of the texts.

Defined cases: NULL texts count as empty; an empty text has the empty fingerprint, which is
like another empty one (1.0) and unlike the rest (0.0); a text shorter than k is one gram;
NULL ids come last, repeated ids in the order of their texts; the only document of a table
is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardlake.llm.common import gram_hashes, id_and_text, mix

K = 8
WINDOW = 16
OUT_ROWS = 256
NULL_ID = -(1 << 63)
# The alphabet of base64.
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_PLACE_BITS = 20
_BLOCK = 1 << (_PLACE_BITS - 1)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the selected hashes: least of each window, rightmost of equals."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    width = min(window, n)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    chosen = []
    for begin in range(0, n - width + 1, _BLOCK):
        part = hashes[begin : begin + _BLOCK + width - 1]
        # The hash, and below it a number that falls with the position, so that < settles ties.
        least = (part & ~low) | (low - np.arange(len(part), dtype=np.uint64))
        covered = 1
        while covered < width:
            step = min(covered, width - covered)
            least = np.minimum(least[: len(least) - step], least[step:])
            covered += step
        chosen.append(begin + (low - (least & low)).astype(np.int64))
    places = np.concatenate(chosen)
    return places[np.concatenate(([True], places[1:] != places[:-1]))]


def selected(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Selected 30-bit hashes of a text, and their positions."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(points) == 0:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    hashes = gram_hashes(mix(points), min(k, len(points)))
    places = winnow(hashes, window)
    return hashes[places] >> np.uint64(34), places


def to_text(hashes: np.ndarray, places: np.ndarray) -> str:
    """The fingerprint as a string."""
    rows = np.empty((len(hashes), 6), dtype=np.uint8)
    for i in range(5):
        rows[:, i] = (hashes >> np.uint64(24 - 6 * i)) & np.uint64(63)
    rows[:, 5] = np.diff(places, prepend=-1)
    return ALPHABET[rows].tobytes().decode()


def from_text(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of a fingerprint string."""
    value = np.zeros(256, dtype=np.uint64)
    value[ALPHABET] = np.arange(64, dtype=np.uint64)
    rows = value[np.frombuffer(fingerprint.encode(), np.uint8).reshape(-1, 6)]
    hashes = np.zeros(len(rows), dtype=np.uint64)
    for i in range(5):
        hashes = hashes << np.uint64(6) | rows[:, i]
    return hashes, np.cumsum(rows[:, 5].astype(np.int64)) - 1


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """2 |A and B| / (|A| + |B|) of two arrays of distinct hashes."""
    if len(a) + len(b) == 0:
        return 1.0
    return 2.0 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are <= key: first among every step-th, then inside."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    every, coarse = F.lit(np.array(bounds)), F.lit(np.array(bounds[::step]))
    above = F.size(F.filter(coarse, lambda b: b <= key))
    inside = F.size(F.filter(F.slice(every, (above - 1) * step + 1, F.lit(step)), lambda b: b <= key))
    return F.when(above == 0, 0).otherwise((above - 1) * step + inside)


def in_order(docs: DataFrame, buckets: int) -> DataFrame:
    """Documents by id range, each range with its own rows first and then the one after them."""
    rows = docs.withColumn("key", F.coalesce("doc_id", F.lit(NULL_ID)))
    # One bound per bucket comes to the driver, and one greatest id.
    at = [i / buckets for i in range(1, buckets)]
    bounds = sorted({int(b) for b in rows.stat.approxQuantile("key", at, 0.25 / buckets)}) if at else []
    own = rows.withColumn("bucket", bucket_of(F.col("key"), bounds))
    greatest = sorted((r["bucket"], r["top"]) for r in own.groupBy("bucket").agg(F.max("key").alias("top")).collect())
    # Each bucket's first document also goes to the bucket above it; the very first to the lowest.
    goes = {greatest[i][1]: greatest[(i + 1) % len(greatest)][0] for i in range(len(greatest))}
    if not goes:
        return own.withColumn("after", F.lit(False))
    session = docs.sparkSession
    moved = session.createDataFrame(list(goes.items()), "key long, target int")
    again = own.join(F.broadcast(moved), "key").withColumn("bucket", F.col("target")).drop("target")  # one row per bucket
    both = own.withColumn("after", F.lit(False)).unionByName(again.withColumn("after", F.lit(True)))
    return both.repartition("bucket").sortWithinPartitions("bucket", "after", F.col("key").desc(), "text")


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def comparer(k: int, window: int):
    def row(doc: tuple, following: tuple) -> tuple:
        doc_id, text, (hashes, places, distinct) = doc
        half = len(text) // 2
        edited = text[: len(text) - half] + following[1][:half]
        changed, where = selected(edited, k, window)
        return (
            doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_text(hashes, places),
            to_text(changed, where), likeness(distinct, np.unique(changed)), likeness(distinct, following[2][2]),
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        bucket = before = None
        for batch in batches:
            columns = (batch.column(i) for i in range(4))
            for at, after, doc_id, text in zip(*columns):
                at, after, doc_id, text = at.as_py(), after.as_py(), doc_id.as_py(), text.as_py()
                if at != bucket:
                    bucket, before = at, None
                if after and before is None:
                    continue  # a repeated id: the first of the rows that follow is already in use
                hashes, places = selected(text, k, window)
                doc = (doc_id, text, (hashes, places, np.unique(hashes)))
                if before is not None:
                    out.append(row(before, doc))
                before = None if after else doc
                if len(out) >= OUT_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), SCHEMA)], schema=SCHEMA)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), SCHEMA)], schema=SCHEMA)

    return compare


def fingerprint_neighbours(
    docs: DataFrame, k: int = K, window: int = WINDOW, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its fingerprint, the edited text's, and the two likenesses."""
    if not 1 <= window <= 63:
        raise ValueError("a distance takes six bits: window must lie between 1 and 63")
    spark = docs.sparkSession
    # Several ranges per partition, so that a few uneven ones do not matter.
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = in_order(id_and_text(docs, id_col, text_col), buckets)
    return rows.select("bucket", "after", "doc_id", "text").mapInArrow(
        comparer(k, window),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, and its hashes and positions as arrays."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [selected(t, k, window) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([to_text(h, p) for h, p in found], pa.string()),
                    pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                    pa.array([p for _, p in found], pa.list_(pa.int64())),
                ],
                names=["doc_id", "fingerprint", "hashes", "positions"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        compute, "doc_id long, fingerprint string, hashes array<long>, positions array<long>"
    )
