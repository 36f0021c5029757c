"""Sequence text export and pattern text import: items by id, ``-1`` ends an element, ``-2`` ends a sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sequence_lines(coded_elements: DataFrame) -> DataFrame:
    """``(sequence_id, value)`` with one text line per sequence of ids.

    A line holds a whole sequence, as the format demands; each element is rendered before the lines are put together.
    """
    parts = coded_elements.select(
        "sequence_id",
        "position",
        F.array_join(F.sort_array("items").cast("array<string>"), " ").alias("text"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("position", "text")))
    body = F.array_join(F.transform(ordered, lambda p: p["text"]), " -1 ")
    return parts.groupBy("sequence_id").agg(F.concat(body, F.lit(" -1 -2")).alias("value"))


def write_sequence_text(coded_elements: DataFrame, path: str) -> None:
    sequence_lines(coded_elements).select("value").write.text(path)


def parse_pattern_lines(lines: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """``value`` lines such as ``1 -1 3 -1 #SUP: 42`` to patterns.

    Lines without ``#SUP:`` are skipped and tokens after ``-2`` are ignored; a line that occurs twice gives two rows.
    With a dictionary ids become items; an unknown id stays as its number.
    """
    numbered = lines.withColumn("_line", F.monotonically_increasing_id())
    split = numbered.where(F.contains(F.col("value"), F.lit("#SUP:"))).select(
        "_line",
        F.trim(F.substring_index("value", "#SUP:", 1)).alias("pattern"),
        F.trim(F.get(F.split("value", "#SUP:"), F.lit(1))).cast("bigint").alias("support_count"),
    )
    body = F.concat(F.lit(" "), F.regexp_replace("pattern", r"\s+", " "), F.lit(" "))
    kept = F.substring_index(body, " -2 ", 1)
    tokens = F.transform(
        F.split(F.concat(kept, F.lit(" ")), r" -1(?= )"),
        lambda e: F.filter(F.split(F.trim(e), r"\s+"), lambda t: t != ""),
    )
    parsed = split.select(
        "_line", "support_count", F.filter(tokens, lambda e: F.size(e) > 0).alias("elements")
    )
    if dictionary is None:
        return parsed.select("elements", F.size("elements").alias("n_elements"), "support_count")
    names = dictionary.select(F.col("item_id").cast("string").alias("token"), "item")
    decoded = (
        parsed.select("_line", "support_count", F.posexplode("elements").alias("at", "e"))
        .select("_line", "support_count", "at", F.posexplode("e").alias("slot", "token"))
        .join(names, "token", "left")
        .withColumn("item", F.coalesce("item", "token"))
        .groupBy("_line", "support_count", "at")
        .agg(F.sort_array(F.collect_list(F.struct("slot", "item"))).alias("e"))
        .groupBy("_line", "support_count")
        .agg(F.sort_array(F.collect_list(F.struct("at", "e"))).alias("els"))
    )
    return decoded.select(
        F.transform("els", lambda s: F.transform(s["e"], lambda t: t["item"])).alias("elements"),
        F.size("els").alias("n_elements"),
        "support_count",
    )


def read_pattern_text(spark: SparkSession, path: str, dictionary: DataFrame | None = None) -> DataFrame:
    return parse_pattern_lines(spark.read.text(path), dictionary)
