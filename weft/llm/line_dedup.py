"""Line dedup with sharded cuckoo filters over exact reference counts; documents can be added and taken out again."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.runtime import scratch_path

from .common import UID, as_scan, keyed_texts, stored

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLOTS = 4
FULL = 0.85  # load at which a filter is rebuilt twice as large
KICKS = 500
SHARD_KEYS = 65_536  # of the keys in a filter, about; more shards are made before there are more than twice as many
GROUP_LINES = 65_536  # that meet a copy of their shard's filter, about


class CuckooFilter:
    """16-bit fingerprints in buckets of four; every key has two buckets, and may be removed again."""

    def __init__(self, buckets: int = 64, blob: bytes | None = None):
        if blob is None:
            self.table = np.zeros((buckets, SLOTS), np.uint16)
        else:
            self.table = np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy()
        self.mask = np.uint64(len(self.table) - 1)

    @staticmethod
    def sized(n_keys: int) -> CuckooFilter:
        return CuckooFilter(1 << max(6, math.ceil(math.log2(max(1, n_keys) / (SLOTS * FULL)))))

    def blob(self) -> bytes:
        return self.table.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = hashes & self.mask
        return prints, first, self._other(first, prints)

    def _other(self, place, prints):
        return (place ^ (prints.astype(np.uint64) * np.uint64(0x5BD1E995))) & self.mask

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, a, b = self._places(hashes)
        return ((self.table[a] == prints[:, None]) | (self.table[b] == prints[:, None])).any(1)

    def add(self, hashes: np.ndarray) -> bool:
        """False if a key found no place; the filter must then be rebuilt larger."""
        prints, first, second = self._places(hashes)
        for p, a, b in zip(prints, first, second):
            for place in (a, b):
                free = np.flatnonzero(self.table[place] == 0)
                if len(free):
                    self.table[place, free[0]] = p
                    break
            else:
                place = b
                for kick in range(KICKS):
                    slot = kick % SLOTS
                    p, self.table[place, slot] = self.table[place, slot], p
                    place = self._other(place, p)
                    free = np.flatnonzero(self.table[place] == 0)
                    if len(free):
                        self.table[place, free[0]] = p
                        break
                else:
                    return False
        return True

    def remove(self, hashes: np.ndarray) -> None:
        """Only of keys that were added."""
        prints, first, second = self._places(hashes)
        for p, a, b in zip(prints, first, second):
            for place in (a, b):
                held = np.flatnonzero(self.table[place] == p)
                if len(held):
                    self.table[place, held[0]] = 0
                    break


def line_keys(text: Column) -> Column:
    """The keys of all lines of a text, in order; an empty text has one empty line."""
    return F.transform(
        F.split(text, "\n", -1), lambda line: F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)
    )


def _hashes(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64)[::2]


class LineIndex:
    """How many documents hold each line key, and per shard a cuckoo filter of the keys that ``min_docs`` or more hold.

    The counts are exact: an append-only table (key, n, version) in ``path`` of
    what each insertion added and each deletion took away; a key is the MD5 of
    a line key. The filters follow: keys that cross ``min_docs`` are added to
    their shard's filter or removed from it, and a filter that runs full is
    rebuilt from the counts. There are ``shards`` of them, and twice as many
    again, rebuilt from the counts, whenever the keys call for it: a shard holds
    some 65,536 keys at any size of the corpus. Deleting what was inserted gives
    back the state before. Keys shorter than ``min_chars`` code points are never
    counted. An index that ``path`` already holds is opened at its last version.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, min_docs: int = 10, min_chars: int = 1, shards: int = 32):
        self.spark, self.path = spark, path or scratch_path(spark, "lines")
        self.min_docs, self.min_chars, self.shards = min_docs, min_chars, shards
        self.version = self._last_version() if path else 0
        self.filters: DataFrame | None = None
        if self.version and not self._grow(self._common().count()):
            self._rebuild()

    def _last_version(self) -> int:
        """0 if nothing was written to ``path``. Versions are numbered without a gap."""
        try:
            return self.spark.read.parquet(self.path).agg(F.max("version")).first()[0] or 0
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return 0
            raise

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int")

    def counts(self, upto: int | None = None) -> DataFrame:
        """(key, n) after the given version, the last by default; only keys that some document holds."""
        upto = self.version if upto is None else upto
        empty = self.spark.createDataFrame([], "key binary, n long")
        if not upto:
            return empty
        changes = self.spark.read.schema("key binary, n long").parquet(*[f"{self.path}/version={v}" for v in range(1, upto + 1)])
        return changes.groupBy("key").agg(F.sum("n").alias("n")).where("n > 0")

    def insert(self, docs: DataFrame) -> None:
        self._change(docs, 1)

    def delete(self, docs: DataFrame) -> None:
        """Take out documents that were inserted (the same texts)."""
        self._change(docs, -1)

    def _change(self, docs: DataFrame, sign: int) -> None:
        # keys are made distinct inside a row, so a document counts once and hot keys are summed before the shuffle
        keys = docs.select(F.explode(F.array_distinct(line_keys(F.coalesce("text", F.lit(""))))).alias("line"))
        keys = keys.where(F.length("line") >= max(1, self.min_chars)).select(F.unhex(F.md5("line")).alias("key"))
        delta = keys.groupBy("key").agg((F.lit(sign) * F.count(F.lit(1))).alias("n"))
        before = self.version
        delta.write.parquet(f"{self.path}/version={before + 1}")
        self.version = before + 1
        changed = self.spark.read.schema("key binary, n long").parquet(f"{self.path}/version={self.version}")
        if before:
            old = self.counts(before).withColumnRenamed("n", "old")
            changed = changed.join(old, "key", "left").fillna(0, ["old"])
        else:
            changed = changed.withColumn("old", F.lit(0))
        up = (F.col("old") < self.min_docs) & (F.col("old") + F.col("n") >= self.min_docs)
        down = (F.col("old") >= self.min_docs) & (F.col("old") + F.col("n") < self.min_docs)
        crossed = stored(changed.where(up | down).select("key", up.alias("added")), "crossed")
        held = self.filters.agg(F.sum("n_keys")).first()[0] or 0 if self.filters is not None else 0
        if not self._grow(held + (crossed.agg(F.sum(F.when(F.col("added"), 1).otherwise(-1))).first()[0] or 0)):
            self._update(crossed.withColumn("shard", self._shard()))

    def _common(self) -> DataFrame:
        return self.counts().where(F.col("n") >= self.min_docs).select("key")

    def _grow(self, n: int) -> bool:
        """True if ``n`` keys called for more shards, and all filters were made anew."""
        if n <= 2 * SHARD_KEYS * self.shards:
            return False
        while n > SHARD_KEYS * self.shards:
            self.shards *= 2
        self._rebuild()
        return True

    def _rebuild(self) -> None:
        every = self.spark.range(self.shards).select(F.col("id").cast("int").alias("shard"))
        self.filters = stored(self._rebuilt(every), "filters")

    def _update(self, crossed: DataFrame) -> None:
        filters = self.filters if self.filters is not None else self.spark.createDataFrame([], "shard int, n_keys long, blob binary, full boolean")

        def one(key, changes: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            hashes = _hashes(changes["key"])
            added = changes["added"].to_numpy(bool)
            kept = int(held["n_keys"].iloc[0]) if len(held) else 0
            n = kept + int(added.sum()) - int((~added).sum())
            cuckoo = CuckooFilter(blob=held["blob"].iloc[0]) if len(held) else CuckooFilter.sized(n)
            cuckoo.remove(hashes[~added])
            full = n > cuckoo.table.size * FULL or not cuckoo.add(hashes[added])
            return pd.DataFrame({"shard": [key[0]], "n_keys": [n], "blob": [cuckoo.blob()], "full": [full]})

        schema = "shard int, n_keys long, blob binary, full boolean"
        updated = stored(crossed.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(one, schema), "filters")
        if updated.where("full").limit(1).count():
            updated = stored(updated.where("not full").unionByName(self._rebuilt(updated.where("full"))), "filters")
        self.filters = updated

    def _rebuilt(self, full: DataFrame) -> DataFrame:
        common = self._common().withColumn("shard", self._shard())
        common = common.join(full.select("shard"), "shard", "left_semi")

        def one(key, keys: pd.DataFrame) -> pd.DataFrame:
            hashes, size = _hashes(keys["key"]), 2 * len(keys)
            while not (cuckoo := CuckooFilter.sized(size)).add(hashes):
                size *= 2
            return pd.DataFrame({"shard": [key[0]], "n_keys": [len(keys)], "blob": [cuckoo.blob()], "full": [False]})

        return common.groupBy("shard").applyInPandas(one, "shard int, n_keys long, blob binary, full boolean")

    def find(self, docs: DataFrame) -> DataFrame:
        """(weft_uid, place): the lines of ``docs`` whose key ``min_docs`` or more of the inserted documents hold.

        Lines meet the filter of their shard, of which every salt has a copy,
        so a line that is in a third of the documents is dealt over all salts.
        A shard's keys are bounded, so the copies grow with the lines alone.
        What passes (a little more than the answer) is confirmed by a join with
        the exact counts.
        """
        lines = keyed_texts(docs).select(UID, F.posexplode(line_keys(F.col("text"))).alias("place", "line"))
        lines = lines.where(F.length("line") >= max(1, self.min_chars)).select(
            UID, "place", F.unhex(F.md5("line")).alias("key")
        ).withColumn("shard", self._shard())
        n_lines = self.counts().agg(F.sum("n")).first()[0] or 0
        salts = max(32, math.ceil(n_lines / (self.shards * GROUP_LINES)))
        lines = lines.withColumn("salt", F.pmod(F.xxhash64(UID), F.lit(salts)).cast("int"))
        filters = self.filters.select("shard", "blob", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))

        def one(key, rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if not len(held) or not len(rows):
                return rows.iloc[:0][[UID, "place", "key"]]
            hit = CuckooFilter(blob=held["blob"].iloc[0]).contains(_hashes(rows["key"]))
            return rows.loc[hit, [UID, "place", "key"]]

        passed = lines.groupBy("shard", "salt").cogroup(filters.groupBy("shard", "salt")).applyInPandas(
            one, f"{UID} long, place int, key binary"
        )
        # written, so that both sides of the join are plain shuffles and Spark can split the rows of a hot key
        common = stored(self._common(), "common-keys")
        return passed.join(common, "key").select(UID, "place")

    def clean(self, docs: DataFrame) -> DataFrame:
        """Per row of ``docs``: weft_uid, doc_id, n_lines, n_dropped and kept_text, the lines that stay joined by newlines.

        All lines with a common key go, in every document. Null text is one
        empty line; empty keys are never dropped; repeated rows are documents
        of their own; an empty table gives no rows; other columns are ignored.
        """
        docs = as_scan(docs)
        dropped = self.find(docs).groupBy(UID).agg(F.collect_list("place").alias("dropped"))
        lines = F.split(F.col("text"), "\n", -1)
        gone = F.coalesce(F.col("dropped"), F.expr("cast(array() as array<int>)"))
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return keyed_texts(docs).join(dropped, UID, "left").select(
            UID, "doc_id", F.size(lines).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"),
            F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n").alias("kept_text"),
        )
