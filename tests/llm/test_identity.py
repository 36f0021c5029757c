"""Rows keep their identity when a scan is cut differently, and contents are told apart exactly."""

from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from tiktoken.load import load_tiktoken_bpe

import public_tokenizers
from weft.llm import bpe, exact_dedup, line_dedup, mixing, near_dedup, substring_dedup, suffix_dedup
from weft.llm.common import span_hashes, stored, with_uid

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = [f"w{i}" for i in range(40)]


@pytest.fixture
def many_files(spark):
    """1,200 rows of 400 texts in 12 files, which a scan may deal in many ways."""
    text = F.concat_ws(" ", *[F.concat(F.lit(f"w{i}-"), F.pmod(F.xxhash64("t", F.lit(i)), F.lit(50))) for i in range(40)])
    rows = spark.range(1200).select(F.col("id").alias("doc_id"), (F.col("id") % 400).alias("t")).withColumn("text", text)
    return stored(rows.withColumn("text", F.concat(F.col("text"), F.lit("\n"), F.repeat(F.lit("Common line "), 1))).drop("t").repartition(12, "doc_id"), "many-files")


OPERATORS = {
    "keep_first": (lambda d: exact_dedup.keep_first(d), lambda d: d.select("doc_id", "text")),
    "keep_one": (lambda d: near_dedup.keep_one(d), lambda d: d.select("doc_id", "text")),
    "near": (lambda d: near_dedup.near_duplicates(d, 3, 85), lambda d: d.select("doc_id", "component_id", "kept")),
    "substring": (lambda d: substring_dedup.remove_repeated(d, 20), lambda d: d.select("doc_id", "n_words", "n_removed", "kept_text")),
    "suffix": (lambda d: suffix_dedup.remove_repeated(d, 60), lambda d: d.select("doc_id", "n_bytes", "n_removed", F.hex("kept"))),
}


@pytest.mark.parametrize("name", [*OPERATORS, "lines"])
def test_another_split_between_two_reads(spark, many_files, name):
    rows = lambda df: Counter(tuple(r) for r in df.collect())

    def build():
        if name != "lines":
            make, pick = OPERATORS[name]
            return pick(make(many_files))
        index = line_dedup.LineIndex(spark, min_docs=5)
        index.insert(many_files)
        return index.clean(many_files).select("doc_id", "n_lines", "n_dropped", "kept_text")

    key, split = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    try:
        want = rows(build())
        late = build()
        spark.conf.set(key, "1")
        spark.conf.set(split, "20000")
        assert rows(late) == want
    finally:
        spark.conf.unset(key)
        spark.conf.unset(split)
    if name in ("keep_first", "keep_one"):
        assert sorted(r[0] for r in want) == list(range(400))


def test_uids_of_a_table_that_is_no_scan(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") % 7).cast("string").alias("text")).groupBy("doc_id").agg(F.max("text").alias("text"))
    assert with_uid(docs).select("weft_uid").distinct().count() == 50
    assert exact_dedup.keep_first(docs).count() == 7


def thue_morse(n, a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_words_that_a_polynomial_hash_confuses(make_docs):
    x, y = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    values = np.frombuffer((x + y).encode(), np.uint8)
    assert len(set(span_hashes(values, np.array([0, 2048]), np.array([2048, 4096])).tolist())) == 2
    for n in (16, 32, 48):
        assert len(set(span_hashes(values, np.array([0, 2048]), np.array([n, 2048 + n])).tolist())) == 2
    same = "one two three four five"
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(make_docs([(1, f"{x} {y} {x} {y}"), (2, f"{same} {x}"), (3, f"{same} {y}")]), 1, 85).collect()}
    assert (got[1]["n_shingles"], got[2]["kept"], got[3]["kept"]) == (2, True, True)
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(RANKS), special_tokens={})
    rows = [(1, f"{x} {y}"), (2, y), (3, x)]
    assert {r["doc_id"]: r["ids"] for r in bpe.encode(make_docs(rows), RANKS).collect()} == {i: encoding.encode_ordinary(t) for i, t in rows}


def test_pieces_with_equal_hashes(monkeypatch):
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(RANKS), special_tokens={})
    monkeypatch.setattr(bpe, "span_hashes", lambda values, starts, stops: (stops - starts).astype(np.uint64) % np.uint64(3))
    texts = ["some words of the same length", "", "word cord lord", "words!!  and 1234 ünd"]
    with open(RANKS, "rb") as f:
        ids, _, counts = bpe.encode_texts(texts, f.read())
    want = [encoding.encode_ordinary(t) for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


def test_reserved_names(make_docs):
    docs = make_docs([(1, "a")])
    with pytest.raises(ValueError):
        exact_dedup.keep_first(docs.withColumn("weft_uid", F.lit(1)))
    with pytest.raises(ValueError):
        mixing.replicate(docs.withColumn("weft_rate", F.lit(1)))
    assert exact_dedup.keep_first(docs.withColumn("weft_gone", F.lit(1)).withColumn("a.b", F.lit(2))).count() == 1
