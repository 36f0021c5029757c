"""The registered rows of queries without SQL, against the tokenizer's library and recounts."""

import base64
import hashlib
import os
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import public_tokenizers
import pytest
import tiktoken

from weft.llm import queries, sharding

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def documents():
    return [(r["doc_id"], r["text"] or "") for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_byte_bpe_rows(spark):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for doc_id, text in documents():
        ids = library.encode_ordinary(text)
        want.append((doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha(text.encode())))
    got = queries.QUERIES["op7_byte_bpe"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)


def test_sharding_rows(spark):
    texts = documents()
    got = queries.QUERIES["op10_kd_sharding"](spark, SF).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    slots, sizes, held = defaultdict(list), Counter(), defaultdict(list)
    of = dict(texts)
    for r in got:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        held[of[r.doc_id]].append((r.shard, r.size))
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / 8
    # three cuts, each off by half of a row or of an undivided group at most
    largest = max(max(r.size for r in got), sharding.WHOLE_SHARE * mean)
    assert all(abs(n - mean) <= 1.5 * largest for n in sizes.values())
    small = [{shard for shard, _ in rows} for rows in held.values() if sum(n for _, n in rows) <= sharding.WHOLE_SHARE * mean]
    assert all(len(at) == 1 for at in small)
