"""Substring and suffix dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from weft.llm import substring_dedup, suffix_dedup, windows


def brute(sequences, k):
    """Which windows of each sequence start anywhere else."""
    counts = Counter(tuple(s[i : i + k]) for s in sequences for i in range(len(s) - k + 1))
    return [[counts[tuple(s[i : i + k])] > 1 for i in range(len(s) - k + 1)] for s in sequences]


def removed(hits, length, k):
    gone = [False] * length
    for i, hit in enumerate(hits):
        if hit:
            gone[i : i + k] = [True] * k
    return gone


def flags(ranges, hits):
    out = [[False] * len(h) for h in hits]
    for row, found in zip(out, ranges):
        for a, b in found:
            row[a:b] = [True] * (b - a)
    return out


def random_texts(rng, alphabet):
    base = rng.choices(alphabet, k=rng.randint(0, 60))
    texts = [rng.choices(alphabet, k=rng.randint(0, 30)) + base[rng.randint(0, 5) :] + rng.choices(alphabet, k=rng.randint(0, 30)) for _ in range(rng.randint(1, 8))]
    return [t if rng.random() < 0.9 else alphabet[:1] * rng.randint(0, 80) for t in texts]


def test_kernels_on_random_texts():
    rng = random.Random(3)
    for _ in range(150):
        k = rng.choice([5, 9, 20, 40])
        m = rng.randint(1, k)
        texts = [bytes(t) for t in random_texts(rng, list(b"abc"))]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.append(0, np.cumsum([len(t) for t in texts]))
        seen = [[0] * max(0, len(t) - k + 1) for t in texts]
        minimiser = {}
        for text, first, n, key, inner in zip(*windows.super_kmers(suffix_dedup.BYTE_HASH[data], offsets, k, m)):
            content = [texts[text][i : i + k] for i in range(first, first + n)]
            assert inner or len(set(content)) == len(content)
            for i, c in zip(range(first, first + n), content):
                seen[text][i] += 1
                assert minimiser.setdefault(c, key) == key
        assert all(x == 1 for row in seen for x in row)
        long = [t for t in texts if len(t) >= k]
        if long:
            want = brute(long, k)
            assert flags(suffix_dedup._repeated(k, rng.choice([0, 8, 16, 32]))(long, np.zeros(len(long), int)), want) == want
        words = [[rng.choice(["a", "bb", "c"]) for _ in range(rng.randint(6, 25))] for _ in range(5)]
        want = brute(words, 6)
        assert flags(substring_dedup._repeated(6)([" ".join(w).encode() for w in words], np.zeros(5, int)), want) == want


def word_rows():
    rng = random.Random(5)
    word = lambda: rng.choice("alpha beta gamma delta épsilon zeta eta theta".split()) + str(rng.randint(0, 60))
    passage, line = [word() for _ in range(60)], [word() for _ in range(12)]
    rows = [(i, " ".join(line + [word() for _ in range(30)] + passage[rng.randint(0, 9) :] + [word() for _ in range(rng.randint(0, 40))])) for i in range(40)]
    rows += [(100, None), (101, ""), (102, " \n "), (103, "De " * 300), (104, "x\ty\n" * 40), (105, rows[0][1]), (105, rows[0][1]), (None, rows[1][1]), (106, " ".join(word() for _ in range(20_000)))]
    return rows


@pytest.mark.parametrize("hot", [512, 2])
def test_substring_dedup(make_docs, monkeypatch, hot):
    monkeypatch.setattr(windows, "HOT_STRINGS", hot)
    rows = word_rows()
    words = [(t or "").split() for _, t in rows]
    want = Counter()
    for (doc_id, _), w, hits in zip(rows, words, brute(words, 35)):
        gone = removed(hits, len(w), 35)
        want[doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)] += 1
    got = substring_dedup.remove_repeated(make_docs(rows)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == want
    assert sum(n for (_, _, n, _) in want) > 2000


@pytest.mark.parametrize("hot", [512, 2])
def test_suffix_dedup(make_docs, monkeypatch, hot):
    monkeypatch.setattr(windows, "HOT_STRINGS", hot)
    rows = word_rows()[:-1]
    texts = [(t or "").encode() for _, t in rows]
    want = Counter()
    for (doc_id, _), t, hits in zip(rows, texts, brute(texts, 400)):
        gone = removed(hits, len(t), 400)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        want[doc_id, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()] += 1
    got = suffix_dedup.remove_repeated(make_docs(rows)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got) == want
    assert sum(x[2] for x in want) > 1000
    assert all(r["n_removed"] == sum(s["end"] - s["begin"] for s in r["spans"]) for r in got)


def run_rows():
    """Runs of one word and of one byte of different lengths, each among words of its own, and one that is only repeated within."""
    own = lambda i, n: [f"w{i}x{j}" for j in range(n)]
    rows = [(i, " ".join(own(i, 6) + ["De"] * (36 + 3 * i) + own(i + 100, 6))) for i in range(6)]
    rows += [(i + 10, " ".join(own(i + 200, 4) + ["ABCDEF"[i] + "z" * (401 + 5 * i) + "GHIJKL"[i]] + own(i + 300, 4))) for i in range(6)]
    return rows + [(20, " ".join(["once"] * 35)), (21, " ".join(["twice"] * 36)), (22, "q" * 400), (23, "y" * 401)]


@pytest.mark.parametrize("hot, k", [(2, 35), (512, 6)])
def test_substring_dedup_runs_of_one_word(make_docs, monkeypatch, hot, k):
    monkeypatch.setattr(windows, "HOT_STRINGS", hot)
    rows = run_rows()
    words = [t.split() for _, t in rows]
    want = {i: sum(removed(hits, len(w), k)) for (i, _), w, hits in zip(rows, words, brute(words, k))}
    got = substring_dedup.remove_repeated(make_docs(rows), k).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == want
    assert want[0] == 36 and want[21] == 36


@pytest.mark.parametrize("hot, k", [(2, 400), (512, 100)])
def test_suffix_dedup_runs_of_one_byte(make_docs, monkeypatch, hot, k):
    monkeypatch.setattr(windows, "HOT_STRINGS", hot)
    rows = run_rows()
    texts = [t.encode() for _, t in rows]
    want = {i: sum(removed(hits, len(t), k)) for (i, _), t, hits in zip(rows, texts, brute(texts, k))}
    got = suffix_dedup.remove_repeated(make_docs(rows), k).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == want
    assert want[10] >= 401 and want[23] == 401


def test_empty_tables(make_docs):
    docs = make_docs([])
    assert substring_dedup.remove_repeated(docs).count() == 0
    assert suffix_dedup.remove_repeated(docs).count() == 0


def test_long_text_by_tiles(monkeypatch):
    monkeypatch.setattr(windows, "TILE", 64)
    symbols = suffix_dedup.BYTE_HASH[np.random.default_rng(1).integers(0, 256, 1000)]
    offsets = np.array([0, 1000])
    cover = np.zeros(961, int)
    for _, first, n, *_ in zip(*windows._tiled(symbols, offsets, 40, 8)):
        cover[first : first + n] += 1
    assert (cover == 1).all()


def test_groups_that_agree_are_not_sorted_again(monkeypatch):
    """Refining equals a sort of all by (group, value); members of groups that agree are left where they are."""
    import numpy as np

    from weft.llm import windows

    rng, inner, seen = np.random.default_rng(5), np.lexsort, []
    for trial in range(60):
        group = np.sort(rng.integers(0, 8, rng.integers(1, 40)))
        value = rng.integers(0, 1 + trial % 4, len(group)).astype(np.uint64) + (group % 3).astype(np.uint64) * np.uint64(1 << 63)
        alive = rng.permutation(len(group))
        order = inner((value, group))
        pairs = list(zip(group[order].tolist(), value[order].tolist()))
        several = [i for i, p in enumerate(pairs) if pairs.count(p) > 1]
        number = [sorted(set(pairs)).index(pairs[i]) for i in several]
        got, left = windows.refine(group, value, alive)
        assert left.tolist() == alive[order][several].tolist() and got.tolist() == number
    monkeypatch.setattr(np, "lexsort", lambda keys: seen.append(len(keys[0])) or inner(keys))
    group, value = np.repeat(np.arange(1000), 2), np.repeat(np.arange(1000), 2).astype(np.uint64)
    value[:4] = [3, 2, 1, 1]
    got, left = windows.refine(group, value, np.arange(2000))
    assert seen == [2] and left.tolist() == list(range(2, 2000))
