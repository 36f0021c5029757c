"""Scoring texts by a probabilistic suffix tree: contexts of varying length, kept where they tell something of the next word.

Texts are handled in batches of whole documents. A batch numbers its distinct
words; from then on only its distinct words, and its distinct pairs of a
context and the word after it, travel: to where they are counted over all
batches, and back with the count, where it is not the batch's own, to their
batch, which scores its documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, stored, utf8_batch
from .substring_dedup import SPACE, words_of

# Bytes of text in a batch, but for a longer document, which is one alone.
BATCH_BYTES = 16 << 20
# A word of a batch has one number: that of the batch, then CODE_BITS for its place among the batch's words.
CODE_BITS = 28
# The token after the last word; no word has white space.
END = "\n"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Contexts(NamedTuple):
    """The candidate contexts of one length: the context without its last word (0: none), that word, the id, the occurrences, and the context
    without its first word (0: none)."""

    before: list[int]
    words: list[str]
    ids: list[int]
    seen: list[int]
    shorter: list[int]


# -- batches ------------------------------------------------------------------------------------------


def _encode(ids: list, learns: list, data: np.ndarray, offsets: np.ndarray) -> tuple:
    """A batch's documents as numbers of its distinct words, and what of each word counts for learning."""
    lower = _LOWER[data]
    begin, end, at = words_of(lower, offsets)
    packed = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(0, np.cumsum(end - begin))), pa.py_buffer(lower[~SPACE[lower]])]
    ).dictionary_encode()
    words = packed.dictionary.cast(pa.large_string()).to_pylist() + [END]
    sizes = np.diff(at) + 1
    codes = np.full(int(sizes.sum()), len(words) - 1, np.int32)
    inside = np.ones(len(codes), bool)
    inside[np.cumsum(sizes) - 1] = False
    codes[inside] = packed.indices.to_numpy(zero_copy_only=False)
    counts = np.bincount(codes[np.repeat(np.array(learns, bool), sizes)], minlength=len(words))
    # common words get small numbers, the bytes of a rank lie together: so they pack well
    order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.int32)
    rank[order] = np.arange(len(words), dtype=np.int32)
    planes = rank[codes].view(np.uint8).reshape(-1, 4).T.tobytes()
    return ids, learns, sizes.tolist(), pa.compress(planes, "zstd", asbytes=True), [words[i] for i in order.tolist()], counts[order].tolist()


_BATCH = "batch long, doc_ids array<long>, learns array<boolean>, sizes array<int>, codes binary, words array<string>, counts array<long>"
_BATCH_TYPES = (
    pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())
)


def _batches(texts: DataFrame) -> DataFrame:
    """``texts`` (doc_id, learns, text) as rows of whole documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n, held, size = TaskContext.get().partitionId() << 15, 0, [], 0

        def row():
            nonlocal n
            n += 1
            ids, learns = [i for h in held for i in h[0]], [x for h in held for x in h[1]]
            lengths = np.concatenate([np.diff(h[3]) for h in held])
            values = (first + n, *_encode(ids, learns, np.concatenate([h[2] for h in held]), np.append(0, np.cumsum(lengths))))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _BATCH_TYPES)], [c.split()[0] for c in _BATCH.split(", ")])

        for batch in batches:
            data, offsets = utf8_batch(batch.column("text"))
            ids, learns = batch.column("doc_id").to_pylist(), batch.column("learns").to_pylist()
            for a, b in chunks(offsets, BATCH_BYTES):
                part = data[offsets[a] : offsets[b]]
                if held and size + len(part) > BATCH_BYTES:
                    yield row()
                    held, size = [], 0
                held.append((ids[a:b], learns[a:b], part.copy(), offsets[a : b + 1]))
                size += len(part)
        if held:
            yield row()

    return texts.mapInArrow(run, _BATCH)


def _lookup(level: Contexts, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The contexts of a length whose last word a batch has: sorted keys (context before, number of the word), and their ids."""
    at = pc.index_in(pa.array(level.words, words.type), value_set=words)
    known = np.asarray(at.is_valid())
    keys = (np.array(level.before, np.int64)[known] << 32) | np.asarray(at.drop_null(), np.int64)
    order = np.argsort(keys)
    return keys[order], np.array(level.ids, np.int64)[known][order]


def _follow(now: np.ndarray, codes: np.ndarray, first: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The context at each token one word longer than ``now``, the context at the token before it; -1 for none."""
    out = np.full(len(codes), -1, np.int64)
    at = np.flatnonzero((now[:-1] >= 0) & ~first[1:])
    if len(keys) and len(at):
        wanted = (now[at] << 32) | codes[at]
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[place] == wanted
        out[at[hit] + 1] = ids[place[hit]]
    return out


def _tokens(packed: bytes, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    n = sum(sizes)
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=4 * n, codec="zstd"), np.uint8)
    codes = np.ascontiguousarray(planes.reshape(4, n).T).view(np.int32).ravel().astype(np.int64)
    first = np.zeros(n, bool)
    first[np.append(0, np.cumsum(sizes)[:-1])] = True
    return codes, first


def _own_pairs(now: np.ndarray, codes: np.ndarray, learns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (context, next word) of tokens with a context, as sorted keys, and their occurrences to learn from."""
    at = np.flatnonzero(now >= 0)
    pairs, which = np.unique((now[at] << 32) | codes[at], return_inverse=True)
    return pairs, np.bincount(which, weights=learns[at], minlength=len(pairs)).astype(np.int64)


_PAIRS = "ctx long, word string, at long, n long, id long"


def _pairs(batches: DataFrame, levels: list[Contexts]) -> DataFrame:
    """Of each batch the distinct (context of the greatest length, next word) with their occurrences to learn from, and its contexts
    of that length as rows (context before, last word) with their id; ``id`` is 0 for the former."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _PAIRS.split(", ")]
        for row in rows:
            for i in range(row.num_rows):
                words = row.column("words")[i].values
                sizes, batch = row.column("sizes")[i].as_py(), row.column("batch")[i].as_py()
                codes, first = _tokens(row.column("codes")[i].as_py(), sizes)
                ctx = np.zeros(len(codes), np.int64)
                for level in levels:
                    keys, ids = _lookup(level, words)
                    ctx = _follow(ctx, codes, first, keys, ids)
                pairs, seen = _own_pairs(ctx, codes, np.repeat(np.array(row.column("learns")[i].as_py(), bool), sizes))
                for key, n, known in ((pairs, seen, np.zeros(len(pairs), np.int64)), (keys, np.zeros(len(keys), np.int64), ids)):
                    code = key & 0xFFFFFFFF
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key >> 32), words.take(pa.array(code)), pa.array((batch << CODE_BITS) | code), pa.array(n), pa.array(known)], names
                    )

    return batches.select("batch", "learns", "sizes", "codes", "words").mapInArrow(run, _PAIRS)


def _counted(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` with ``c``, the sum of n of all batches per key, and ``once``, true in one row per key. A key has a row per batch at most."""
    same = Window.partitionBy(*key)
    return rows.withColumn("c", F.sum("n").over(same)).withColumn("once", F.min("at").over(same) == F.col("at"))


# -- the tree -----------------------------------------------------------------------------------------


def _gains(counted: DataFrame, shared: DataFrame, smoothing: float) -> dict[int, float]:
    """Per context: by how many nats it tells its next words better than the context one word shorter does, each occurrence told from
    the others. ``counted`` has (ctx, word, c, seen), ``shared`` those with c > 1 and p_shorter; a word that came once is told by the
    smoothing alone, whatever its probability."""
    rest = F.col("seen") - 1 + smoothing
    singles = counted.where("c = 1").groupBy("ctx").agg(F.sum(F.log(smoothing / rest)).alias("gain"))
    left_out = (F.col("c") - 1 + smoothing * F.col("p_shorter")) / rest
    others = shared.groupBy("ctx").agg(F.sum(F.col("c") * F.log(left_out / F.col("p_shorter"))).alias("gain"))
    both = singles.unionByName(others).groupBy("ctx").agg(F.sum("gain").alias("gain"))
    return {r["ctx"]: r["gain"] for r in both.collect()}  # one row per context


class SuffixTree(NamedTuple):
    levels: list[Contexts]
    kept: set[int]
    tokens: int  # N
    types: int  # V
    smoothing: float


def _next_level(counted: DataFrame, least: int, base: int, shorter) -> Contexts:
    """The contexts made of a context and a next word that occur ``least`` times: at most tokens / least."""
    found = counted.where((F.col("c") >= least) & (F.col("word") != END)).select("ctx", "word", "c").orderBy("ctx", "word").collect()
    ids = list(range(base, base + len(found)))
    return Contexts([r["ctx"] for r in found], [r["word"] for r in found], ids, [r["c"] for r in found], [shorter(r["ctx"], r["word"]) for r in found])


def score(
    docs: DataFrame, learns: Column, least_share: float = 1e-4, longest: int = 3, least_gain: float = 20.0, smoothing: float = 50.0
) -> DataFrame:
    """Per row of ``docs``: doc_id, learned, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities of the text).

    Tokens are the words (runs of characters other than ASCII white space,
    A-Z in lower case) and one end of each text. The rows for which ``learns``
    holds are learnt from, all rows are scored. Null text is empty and has the
    end only; repeated rows count each; an empty table gives no rows; without
    rows to learn from every word is unknown; other columns are ignored. Texts
    of any length are read whole.

    The tree: candidates are contexts of up to ``longest`` words that are at
    least ``least_share`` of all tokens to learn from, so at most 1 /
    least_share of each length, which every task can hold. A candidate becomes
    a state if it tells the words after it by ``least_gain`` nats better than
    the context without its first word does (the divergence of the two
    distributions times the occurrences, each occurrence left out in turn);
    with a state all its suffixes are states. P(w | s) = (c(s, w) + smoothing *
    P(w | shorter s)) / (c(s) + smoothing), down to P(w) = (c(w) + 1) / (N + V +
    1); a text is scored by the longest state at each token. All next words of
    the contexts are counted, in a distributed table that grows with the text.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(learns, F.lit(False)).alias("learns"), F.coalesce("text", F.lit("")).alias("text"))
    batches = stored(_batches(texts), "batches")
    per_batch = batches.select("batch", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w")).select(
        F.col("w.words").alias("word"), (F.shiftleft("batch", CODE_BITS) + F.col("code")).alias("at"), F.col("w.counts").alias("n")
    )
    by_word = stored(_counted(per_batch, "word"), "words")
    words = by_word.where("once AND c > 0").select("word", "c")
    whole = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    tokens, types = whole["tokens"], whole["types"]
    least = max(2, math.ceil(least_share * tokens))
    unseen = (F.col("c_word") + 1) / F.lit(float(tokens + types + 1))

    levels, pairs, gains, told = [], [], {}, None
    level = _next_level(words.withColumn("ctx", F.lit(0).cast("long")), least, 1, lambda s, w: 0)
    while level.ids and len(levels) < longest:
        levels.append(level)
        pairs.append(stored(_counted(_pairs(batches, levels), "ctx", "word"), "pairs"))
        seen = docs.sparkSession.createDataFrame(list(zip(level.ids, level.seen, level.shorter)), "ctx long, seen long, shorter long")
        counted = pairs[-1].where("id = 0 AND once AND c > 0").select("ctx", "word", "c").join(F.broadcast(seen), "ctx")
        shared = counted.where("c > 1")
        if told is None:
            shared = shared.join(words.select("word", F.col("c").alias("c_word")), "word").withColumn("p_shorter", unseen)
        else:
            shared = shared.join(told.select(F.col("ctx").alias("shorter"), "word", F.col("p").alias("p_shorter")), ["shorter", "word"])
        p = (F.col("c") + smoothing * F.col("p_shorter")) / (F.col("seen") + smoothing)
        told = stored(shared.withColumn("p", p).select("ctx", "word", "c", "seen", "p", "p_shorter"), "pair-counts")
        gains |= _gains(counted, told, smoothing)
        known, up = dict(zip(zip(level.before, level.words), level.ids)), dict(zip(level.ids, level.shorter))
        level = _next_level(told, least, level.ids[-1] + 1, lambda s, w, known=known, up=up: known[up[s], w])
    tree = SuffixTree(levels, _kept(levels, gains, least_gain), tokens, types, smoothing)

    # back to the batches: counts that are more than the batch's own, and (negative) the ids of contexts
    batch, code = F.shiftright("at", CODE_BITS).alias("to"), F.col("at").bitwiseAND(F.lit((1 << CODE_BITS) - 1))
    answers = by_word.where("c > n").select(batch, code.alias("key"), F.col("c").alias("value"))
    for level, found in zip(levels, pairs):
        states = docs.sparkSession.createDataFrame([(i,) for i in level.ids if i in tree.kept], "ctx long")
        key = (F.shiftleft("ctx", 32) + code).alias("key")
        answers = answers.unionByName(found.where("id = 0 AND c > n").join(F.broadcast(states), "ctx", "left_semi").select(batch, key, F.col("c").alias("value")))
        answers = answers.unionByName(found.where("id > 0").select(batch, key, (-F.col("id")).alias("value")))
    return _scored(batches.select("batch", "doc_ids", "learns", "sizes", "codes"), answers, tree)


def _kept(levels: list[Contexts], gains: dict[int, float], least_gain: float) -> set[int]:
    """The contexts that pass the test, and all their suffixes."""
    kept = {i for i, g in gains.items() if g >= least_gain}
    for level in reversed(levels):
        kept |= {s for i, s in zip(level.ids, level.shorter) if i in kept and s}
    return kept


_SCORED = "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(batches: DataFrame, answers: DataFrame, tree: SuffixTree) -> DataFrame:
    most = tree.levels[-1].ids[-1] if tree.levels else 0
    level_of, seen, state = np.zeros(most + 1, np.int64), np.zeros(most + 1), np.zeros(most + 1, bool)
    for d, level in enumerate(tree.levels):
        level_of[level.ids], seen[level.ids] = d + 1, level.seen
    state[list(tree.kept)] = True
    depth, tokens, types, smoothing = len(tree.levels), tree.tokens, tree.types, tree.smoothing

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c)[0] for c in ("doc_ids", "learns", "sizes", "codes")}
        sizes = row["sizes"].as_py()
        codes, first = _tokens(row["codes"].as_py(), sizes)
        learns = np.repeat(np.array(row["learns"].as_py(), bool), sizes)
        key, value = (right.column(c).to_numpy().astype(np.int64) for c in ("key", "value"))
        ctx, told = key >> 32, value < 0
        count = np.bincount(codes, weights=learns).astype(np.int64)
        plain = ~told & (ctx == 0)
        count[key[plain]] = value[plain]
        known = count[codes]
        p = (known + 1) / (tokens + types + 1)
        base, now = np.log10(p), np.zeros(len(codes), np.int64)
        level = np.where(told, level_of[np.where(told, -value, 0)], level_of[ctx])
        for d in range(1, depth + 1):
            here = np.flatnonzero(told & (level == d))
            here = here[np.argsort(key[here])]
            now = _follow(now, codes, first, key[here], -value[here])
            pairs, own = _own_pairs(now, codes, learns)
            asked = ~told & (ctx > 0) & (level == d)
            own[np.searchsorted(pairs, key[asked])] = value[asked]
            at = np.flatnonzero(now >= 0)
            at = at[state[now[at]]]
            c = own[np.searchsorted(pairs, (now[at] << 32) | codes[at])]
            p[at] = (c + smoothing * p[at]) / (seen[now[at]] + smoothing)
        begins = np.append(0, np.cumsum(sizes)[:-1])
        total = lambda x: np.add.reduceat(x, begins)
        return pa.table([
            row["doc_ids"].values, row["learns"].values, pa.array(np.array(sizes, np.int64)), pa.array(total((known > 0).astype(np.int64))),
            pa.array(np.full(len(sizes), tokens)), pa.array(total(base)), pa.array(total(np.log10(p))),
        ], [c.split()[0] for c in _SCORED.split(", ")])

    return batches.groupBy("batch").cogroup(answers.groupBy("to")).applyInArrow(run, _SCORED)
