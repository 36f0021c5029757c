"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.runtime import scratch_path

UID = "weft_uid"
# A Python task looks at about this many bytes of text at once; longer texts are handled alone.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of one file that a uid tells apart.
_ROW_BITS = 40


def reserve(docs: DataFrame, *names: str) -> None:
    """Refuse columns by names that an operator gives to its own."""
    if taken := sorted({c.lower() for c in docs.columns} & set(names)):
        raise ValueError(f"columns {taken} are reserved; rename them first")


def with_uid(docs: DataFrame) -> DataFrame:
    """``docs`` with weft_uid: the file of a row, by the order of paths, and its place there.

    So a row has the same uid whenever and by however many tasks its file is
    read again. A table that is not a scan of files that know their rows
    (Parquet) is written first. The numbers of the files are as many as the
    paths that the driver listed for the scan; they go to all tasks.
    """
    reserve(docs, UID, "weft_file", "weft_place")
    docs = as_scan(docs)
    here = docs.metadataColumn("_metadata")
    placed = docs.select("*", here["file_path"].alias("weft_file"), here["row_index"].alias("weft_place"))
    files = placed.select("weft_file").distinct()
    numbers = files.select("weft_file", F.row_number().over(Window.orderBy("weft_file")).cast("long").alias(UID))
    uid = F.shiftleft(UID, _ROW_BITS) + F.col("weft_place")
    named = placed.join(F.broadcast(numbers), "weft_file").withColumn(UID, uid)
    return named.drop("weft_file", "weft_place")


def as_scan(docs: DataFrame) -> DataFrame:
    """``docs`` itself if its rows have places in files, otherwise as written to a new table: for operators that read it twice."""
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return stored(docs, "rows")
    return docs


def keyed_texts(docs: DataFrame) -> DataFrame:
    """(weft_uid, doc_id, text) of ``docs``: each row is a document of its own, null text is empty.

    The uid (``with_uid``) lets rows that share a doc_id, or have none, stay apart.
    """
    return with_uid(docs.select("doc_id", "text")).select(
        UID, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` but for those whose weft_uid is in ``gone``, with the columns of ``docs``."""
    named = with_uid(docs)
    return named.join(gone.select(UID), UID, "left_anti").drop(UID)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back: lineage ends there, for any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> None:
    """Columns reach Python workers in batches of 4 MB in this session, as two workers a task may hold some."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def salt(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(column)), F.lit(n)).cast("int")


def sha256_text(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def utf8_batch(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without nulls, and the n + 1 offsets into them."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) whose texts have about ``most`` bytes together."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, b
        a = b


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers starts[i] .. starts[i] + lengths[i] - 1, for all i in turn."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


# Spans up to this length are hashed symbol by symbol, all at once; the few longer ones each by a digest.
_SHORT = 48


def span_hashes(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of an array of whole numbers: each step scrambles what it has, so that no family of spans agrees."""
    lengths = stops - starts
    out = mix64(lengths.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    order = np.argsort(-lengths, kind="stable")
    falling = lengths[order]
    long = int(np.searchsorted(-falling, -_SHORT, side="left"))
    for i in order[:long].tolist():
        span = np.ascontiguousarray(values[starts[i] : stops[i]])
        out[i] = int.from_bytes(hashlib.blake2b(span.tobytes(), digest_size=8).digest(), "little")
    order, falling = order[long:], falling[long:]
    at, state = starts[order], out[order]
    for step in range(int(falling[0]) if len(falling) else 0):
        n = int(np.searchsorted(-falling, -step, side="left"))  # those longer than the step
        state[:n] = mix64(state[:n] * np.uint64(0x9FB21C651E98DF25) + values[at[:n] + step].astype(np.uint64) + np.uint64(1))
    out[order] = state
    return out
