"""Session helpers: durable intermediates, shared scratch paths, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType
from pyspark.storagelevel import StorageLevel

# A side is broadcast only after its size was compared with this bound.
BROADCAST_BYTES = 64 << 20


def build_session(app: str = "weft", cores: str = "8", memory: str = "12g") -> SparkSession:
    """Local session used by the bench and the tests; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def _shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a fresh one only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before mining on a cluster")
    root = tempfile.mkdtemp(prefix="weft-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and cut its lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared_root(spark))
    return df.checkpoint()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that does not exist yet, under the shared folder."""
    return f"{_shared_root(spark).rstrip('/')}/weft-{label}-{uuid.uuid4().hex}"


def _varying(kind: DataType) -> bool:
    return kind.typeName() in ("string", "binary", "array", "map", "struct", "variant")


def _bytes_of(column: Column, kind: DataType) -> Column:
    """The length of a value: texts and arrays by what they hold, not by the width of their type."""
    name = kind.typeName()
    if name in ("string", "binary"):
        return F.octet_length(column).cast("long")
    if name == "array" and not _varying(kind.elementType):
        return F.size(column) * F.lit(16).cast("long")
    if name == "array":
        return F.aggregate(column, F.lit(0).cast("long"), lambda done, x: done + 16 + F.coalesce(_bytes_of(x, kind.elementType), F.lit(0)))
    return F.octet_length(F.to_json(F.struct(column))).cast("long")


def table_bytes(df: DataFrame, rows: int) -> int:
    """Size of ``rows`` counted rows: by the widths of their types, and for columns of varying length by what they hold."""
    width = rows * df._jdf.schema().defaultSize()
    varying = [f for f in df.schema if _varying(f.dataType)]
    if not varying or width > BROADCAST_BYTES:
        return width
    held = df.agg(*[F.sum(_bytes_of(F.col(f"`{f.name}`"), f.dataType)) for f in varying]).first()
    return width + sum(x or 0 for x in held)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast when the counted ``rows`` stay within the bound; otherwise leave the join to AQE."""
    return F.broadcast(df) if table_bytes(df, rows) <= BROADCAST_BYTES else df


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep an input that is read several times; a caller's own cache is left alone. Lost blocks are recomputed."""
    if df.storageLevel != StorageLevel.NONE:
        yield df
        return
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def with_rarest_item(sets: DataFrame, data_items: DataFrame) -> DataFrame:
    """Add ``item``: of each set's ``items`` the one with the fewest rows in ``data_items``.

    Looking sets up through their rarest item keeps a very common item from
    matching every row with every set. A set with an item that never occurs drops out.
    """
    slots = sets.select("items", F.explode("items").alias("item"))
    wanted = durable(slots.select("item").distinct())
    counts = (
        data_items.join(small_side(wanted, wanted.count()), "item", "left_semi")
        .groupBy("item")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    best = (
        slots.join(counts, "item", "left")
        .groupBy("items")
        .agg(F.min(F.struct(F.coalesce("_rows", F.lit(0)).alias("_rows"), "item")).alias("_best"))
    )
    return best.where("_best._rows > 0").select("items", F.col("_best.item").alias("item"))


def require_columns(df: DataFrame, *names: str) -> None:
    for name in names:
        if name not in df.columns:
            raise KeyError(f"column '{name}' not found; available: {df.columns}")
