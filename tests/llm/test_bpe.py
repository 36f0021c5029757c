"""Byte-level BPE against the tiktoken library."""

import base64
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from weft.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PARTS = ["'", "s", "t", "re", "ve", "ll", "d", "m", "'s", " ", "  ", "\n", "\t", "　", "\x1c", "\x85", "é", "7", "²", "!", "..", "ab", "Z", "日本", "🙂", "́", "\r\n"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def content():
    with open(PATH, "rb") as f:
        return f.read()


def test_random_texts(library, content):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(20_000)]
    texts += ["", "a" * 5000, "'" * 300, "aé" * 3000 + "'s", "", " ", "x" * 33, "<|endoftext|>"]
    ids, offsets, counts = bpe.encode_texts(texts, content)
    ends = np.append(0, np.cumsum(counts))
    for text, a, b in zip(texts, ends[:-1], ends[1:]):
        want = library.encode_ordinary(text)
        assert ids[a:b].tolist() == want, text
        starts = np.append(0, np.cumsum([len(library.decode_single_token_bytes(x)) for x in want]))[:-1] if want else []
        assert offsets[a:b].tolist() == list(starts)


def test_cache_is_bounded(content, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 100)
    ranks = bpe.Ranks(content)
    words = [f"word{i}" for i in range(1000)]
    for i in range(0, 1000, 50):
        assert ranks.pieces(words[i : i + 50]) == [bpe.merge_pairs(w.encode(), ranks.ranks) for w in words[i : i + 50]]
        assert len(ranks.cache) <= 100


def test_short_pieces_merge_alike(content):
    rng = random.Random(2)
    pieces = [bytes(rng.choices(range(256), k=rng.randint(1, bpe.SHORT))) for _ in range(3000)] + [b"aaaaaaaaaaaaaaaa", b"abababab"]
    ranks = bpe.load_ranks(content)
    for piece, ids in zip(pieces, bpe.merge_short(pieces, ranks)):
        if piece not in ranks.ranks:
            assert ids == bpe.merge_pairs(piece, ranks.ranks)


def test_round_trip(library, make_docs):
    rows = [(1, "It's a test,  isn't it?\n\n ok "), (2, None), (3, ""), (4, "é🙂" * 40_000), (5, "same"), (5, "same"), (None, "no id"), (6, " \n\t ")]
    encoded = bpe.encode(make_docs(rows), PATH)
    got = Counter((r["doc_id"], r["n_tokens"], tuple(r["ids"])) for r in encoded.collect())
    want = Counter()
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), tuple(ids)] += 1
    assert got == want
    decoded = bpe.decode(encoded, PATH).select("doc_id", "decoded").collect()
    assert Counter((r["doc_id"], bytes(r["decoded"]).decode()) for r in decoded) == Counter((i, t or "") for i, t in rows)
    assert bpe.encode(make_docs([]), PATH).count() == 0
