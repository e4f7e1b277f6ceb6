"""What several operators of this package share: input columns, words, hashes, written tables.

Every operator takes a DataFrame and the names of its id and text column, reads only the
columns it names, and returns columns of its own, so extra columns of any name are ignored.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardlake.sources.shared import shared_folder

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it, if they see that path.

    On a cluster the library is installed or sent with --py-files; then this changes nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two input columns as ``doc_id`` BIGINT and ``text``, a NULL text as the empty one."""
    workers_import(docs.sparkSession)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only; texts without other characters take the fast path."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    only_ascii = F.octet_length(text) == F.length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def words(text: str) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` as UTF-8, which is what bytes.split() cuts at."""
    return text.encode("utf-8", "surrogatepass").split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    import pandas as pd  # takes memory of every worker that has it, so only of those that hash words

    column = np.empty(len(found), dtype=object)
    column[:] = found
    return pd.util.hash_array(column, categorize=False)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers after which close values are far apart."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """The hash of every run of k symbols."""
    n = len(symbols) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += symbols[j : j + n]
    return mix(total)


def give_back() -> None:
    """Return a worker's free memory to the system: it goes on to other tasks, also of other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # another C library, which has no such call


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches after which the worker keeps no free memory."""

    def tidied(batches: Iterator) -> Iterator:
        yield from work(batches)
        give_back()

    return tidied


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, without lineage behind it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def same_row(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on (doc_id, text_key), NULL ids equal."""
    other = right.withColumnsRenamed({"doc_id": "__id", "text_key": "__key"})
    on = (left["text_key"] == other["__key"]) & left["doc_id"].eqNullSafe(other["__id"])
    return left.join(other, on, how).drop("__id", "__key")
