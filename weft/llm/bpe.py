"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation."""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, ragged, small_batches, span_hashes, utf8_batch

# The white space of the split pattern, and its contractions.
SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

# Pieces kept with their ids by a Python worker.
CACHED_PIECES = 150_000
# Bytes of the pieces that are merged many at once and cached; longer ones are merged with a heap.
SHORT = 32
NONE = np.int64(1 << 40)  # the rank of a pair that does not merge

# Classes of codepoints.
LETTER, NUMBER, OTHER, SPACE, BLANK, QUOTE = range(6)
# Symbols the automaton reads: a class, refined by what follows.
(S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_LAST_SPACE, S_LAST_BLANK, S_QUOTE1, S_QUOTE2, S_TAIL) = range(9)
FIRST = 9  # added for the first codepoint of a text
# States, by what has been read.
FRESH, LETTERS, NUMBERS, OTHERS, SPACES_RUN, ATTACHED, TWO_MORE, ONE_MORE = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece starts at this codepoint."""
    if symbol >= FIRST:
        return _step(FRESH, symbol - FIRST)[0], True
    if symbol in (S_LETTER, S_NUMBER, S_OTHER):
        run = {S_LETTER: LETTERS, S_NUMBER: NUMBERS, S_OTHER: OTHERS}[symbol]
        return run, state not in (run, ATTACHED)
    if symbol == S_SPACE:
        return SPACES_RUN, state != SPACES_RUN
    if symbol == S_LAST_BLANK:  # the blank before a piece belongs to it
        return ATTACHED, True
    if symbol == S_LAST_SPACE:
        return FRESH, True
    if symbol == S_TAIL:  # a letter of a possible contraction
        if state == TWO_MORE:
            return ONE_MORE, False
        if state == ONE_MORE:
            return FRESH, False
        return _step(state, S_LETTER)
    if state in (OTHERS, ATTACHED):
        return OTHERS, False
    return (ONE_MORE if symbol == S_QUOTE1 else TWO_MORE), True


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The transition functions that symbols generate under composition: one id per symbol, the table of
    compositions (later, earlier), which are constant, their value, and where pieces start by (state, symbol)."""
    symbols, states = range(2 * FIRST), range(8)
    functions = {}
    for s in symbols:
        functions.setdefault(tuple(_step(q, s)[0] for q in states), len(functions))
    grown = True
    while grown:
        made = {tuple(g[f[q]] for q in states) for g in functions for f in functions} - functions.keys()
        grown = bool(made)
        for f in sorted(made):
            functions[f] = len(functions)
    listed = list(functions)
    ids = np.array([functions[tuple(_step(q, s)[0] for q in states)] for s in symbols], np.uint8)
    compose = np.array([[functions[tuple(g[f[q]] for q in states)] for f in listed] for g in listed], np.uint8)
    constant = np.array([len(set(f)) == 1 for f in listed])
    starts = np.array([[_step(q, s)[1] for s in symbols] for q in states])
    return ids, compose, constant, np.array([f[0] for f in listed], np.uint8), starts


@lru_cache(1)
def _tables():
    classes = np.full(0x110000, OTHER, np.uint8)
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    kinds = np.frombuffer("".join(kinds).encode(), np.uint8)
    classes[kinds == ord("L")] = LETTER
    classes[kinds == ord("N")] = NUMBER
    classes[list(SPACES)] = SPACE
    classes[0x20], classes[ord("'")] = BLANK, QUOTE
    # by class, and class + 6 for white space before something else
    refine = np.array([S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_SPACE, S_OTHER, 0, 0, 0, S_LAST_SPACE, S_LAST_BLANK, 0], np.uint8)
    return classes, refine, *_monoid()


def piece_starts(codepoints: np.ndarray, text_ends: np.ndarray) -> np.ndarray:
    """Where the pieces of the split pattern start, in texts laid end to end (``text_ends``: where non-empty texts end).

    Each codepoint becomes a transition function of a small automaton. As
    composition is associative, functions of growing spans are composed by
    doubling until all are constant, which gives the state before each codepoint.
    """
    classes, refine, ids, compose, constant, value, starts_at = _tables()
    n = len(codepoints)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes[codepoints]
    white = (kind == SPACE) | (kind == BLANK)
    followed = np.empty(n, bool)
    followed[:-1] = ~white[1:]
    followed[text_ends - 1] = False
    symbols = refine[kind + np.uint8(6) * (white & followed)]
    quotes = np.flatnonzero(kind == QUOTE)
    if len(quotes):
        left = text_ends[np.searchsorted(text_ends, quotes, side="right")] - quotes
        padded = np.append(codepoints, [0, 0])
        one, two = np.where(left > 1, padded[quotes + 1], 0), np.where(left > 2, padded[quotes + 2], 0)
        single = np.isin(one, [ord(c) for c in CONTRACTIONS if len(c) == 1])
        double = np.zeros(len(quotes), bool)
        for c in (c for c in CONTRACTIONS if len(c) == 2):
            double |= (one == ord(c[0])) & (two == ord(c[1]))
        double &= ~single
        symbols[quotes[single]], symbols[quotes[double]] = S_QUOTE1, S_QUOTE2
        symbols[quotes[single | double] + 1] = S_TAIL
        symbols[quotes[double] + 2] = S_TAIL
    firsts = np.append(0, text_ends[:-1])
    symbols[firsts] += FIRST
    functions = ids[symbols]
    open_, span = np.flatnonzero(~constant[functions]), 1
    while len(open_):
        functions[open_] = compose[functions[open_], functions[open_ - span]]
        open_ = open_[~constant[functions[open_]]]
        span *= 2
    before = np.empty(n, np.uint8)
    before[0], before[1:] = FRESH, value[functions[:-1]]
    return np.flatnonzero(starts_at[before, symbols])


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one piece: the pair of lowest rank is merged first, of equal ones the leftmost."""
    if (whole := ranks.get(piece)) is not None:
        return (whole,)
    n = len(piece)
    after, before = list(range(1, n + 2)), list(range(-1, n))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    gone = bytearray(n + 1)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if gone[a] or b >= n or gone[b] or after[a] != b or after[b] != c:
            continue
        gone[b] = 1
        after[a] = c
        if c < n:
            before[c] = a
            d = after[c]
            if (r := ranks.get(piece[a:d])) is not None:
                heapq.heappush(heap, (r, a, c, d))
        if (p := before[a]) >= 0 and (r := ranks.get(piece[p:c])) is not None:
            heapq.heappush(heap, (r, p, a, c))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return tuple(ids)


class Ranks:
    """A rank file in the forms that encoding and decoding read."""

    def __init__(self, content: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the ranks lack the single bytes {missing[:5]}")
        self.ranks, self.cache = ranks, {}
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for b, r in ranks.items():
            self.lengths[r] = len(b)
        self.words = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self._pairs = None
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (left << 32 | right) and ranks of all pairs of ids that merge."""
        if self._pairs is None:
            keys, merged = [], []
            for b, r in self.ranks.items():
                for i in range(1, len(b)):
                    x, y = self.ranks.get(b[:i]), self.ranks.get(b[i:])
                    if x is not None and y is not None:
                        keys.append(x << 32 | y)
                        merged.append(r)
            order = np.argsort(keys)
            self._pairs = np.array(keys, np.int64)[order], np.array(merged, np.int64)[order]
        return self._pairs

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, NONE where they do not merge."""
        known, merged = self.pairs()
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where((known[at] == keys) & (left >= 0) & (right >= 0), merged[at], NONE)

    def pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Ids of pieces, from the cache where it has them."""
        found = list(map(self.cache.get, pieces))
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            raw = [pieces[i].encode() for i in new]
            whole = list(map(self.ranks.get, raw))
            short = [k for k, (b, r) in enumerate(zip(raw, whole)) if r is None and len(b) <= SHORT]
            merged = dict(zip(short, merge_short([raw[k] for k in short], self)))
            if len(self.cache) + len(new) > CACHED_PIECES:
                self.cache.clear()
            for k, i in enumerate(new):
                ids = (whole[k],) if whole[k] is not None else merged.get(k) or merge_pairs(raw[k], self.ranks)
                found[i] = ids
                if len(raw[k]) <= SHORT:
                    self.cache[pieces[i]] = ids
        return found


@lru_cache(4)
def load_ranks(content: bytes) -> Ranks:
    return Ranks(content)


def merge_short(pieces: list[bytes], ranks: Ranks) -> list[tuple[int, ...]]:
    """``merge_pairs`` of many short pieces at once: a row of ids each, and one merge per row and round."""
    n = len(pieces)
    if not n:
        return []
    out: list = [()] * n
    sizes = np.fromiter(map(len, pieces), np.int64, n)
    width = int(sizes.max()) + 1
    ids = np.full((n, width), -1, np.int64)
    ids[np.arange(width) < sizes[:, None]] = ranks.single[np.frombuffer(b"".join(pieces), np.uint8)]
    pair = np.full((n, width), NONE)
    pair[:, :-1] = ranks.pair(ids[:, :-1], ids[:, 1:])
    rows, columns = np.arange(n), np.arange(width - 1)
    while len(rows):
        at = pair.argmin(1)
        each = np.arange(len(rows))
        best = pair[each, at]
        done = best == NONE
        if done.any():
            for row, values in zip(rows[done].tolist(), ids[done].tolist()):
                out[row] = tuple(values[: values.index(-1)])
            rows, ids, pair, at, best = rows[~done], ids[~done], pair[~done], at[~done], best[~done]
            each = np.arange(len(rows))
        take = columns + (columns > at[:, None])
        ids[:, :-1] = np.take_along_axis(ids, take, 1)
        take = columns + (columns >= at[:, None])
        pair[:, :-1] = np.take_along_axis(pair, take, 1)
        ids[:, -1], pair[:, -1] = -1, NONE
        ids[each, at] = best
        pair[each, at] = ranks.pair(best, ids[each, at + 1])
        left = at > 0
        pair[each[left], at[left] - 1] = ranks.pair(ids[each[left], at[left] - 1], best[left])
    return out


def _told_apart(codepoints: np.ndarray, starts: np.ndarray, lengths: np.ndarray, example: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``example`` and ``which`` with each piece that differs from its example made an example of itself."""
    if not len(starts):
        return example, which
    as_long = lengths == lengths[example][which]
    same, size = np.flatnonzero(as_long), lengths[as_long]
    differ = codepoints[ragged(starts[same], size)] != codepoints[ragged(starts[example][which][same], size)]
    wrong = ~as_long
    if differ.any():
        ends = np.append(0, np.cumsum(differ))[np.append(0, np.cumsum(size))]
        wrong[same[np.diff(ends) > 0]] = True
    odd = np.flatnonzero(wrong)
    which = which.copy()
    which[odd] = len(example) + np.arange(len(odd))
    return np.append(example, odd), which


def encode_texts(texts: list[str], content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts in turn, the byte offset of each within its text, and the number of ids per text.

    Pieces are made distinct by a hash within the call, and then compared with
    the one that stands for them; only the distinct ones become strings and go
    through the cache.
    """
    ranks = load_ranks(content)
    joined = "".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    codepoints = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    starts = piece_starts(codepoints, ends[sizes > 0])
    stops = np.append(starts[1:], len(joined))[: len(starts)]
    _, example, which = np.unique(span_hashes(codepoints, starts, stops), return_index=True, return_inverse=True)
    example, which = _told_apart(codepoints, starts, stops - starts, example, which)
    found = ranks.pieces([joined[a:b] for a, b in zip(starts[example].tolist(), stops[example].tolist())])
    counts = np.fromiter(map(len, found), np.int64, len(found))
    distinct = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
    ids = distinct[ragged((np.cumsum(counts) - counts)[which], counts[which])]
    upto = np.append(0, np.cumsum(counts[which]))
    per_text = np.diff(upto[np.append(0, np.searchsorted(starts, ends))])
    spans = ranks.lengths[ids]
    offsets = np.cumsum(spans) - spans
    first = np.cumsum(per_text) - per_text
    base = np.zeros(len(texts), np.int64)
    some = per_text > 0
    base[some] = offsets[first[some]]
    return ids, (offsets - np.repeat(base, per_text)).astype(np.int32), per_text


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(values))


def encode(docs: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, offsets) of every row of ``docs``: the ids of its whole text by the ranks in the file, and the
    byte offset at which each token starts.

    Pieces of the split pattern are encoded one by one, without special
    tokens. Null and empty texts have no tokens; repeated rows are encoded one
    by one; other columns are ignored. The rank file (about 1 MB) is read by
    the driver and sent to the workers. A worker encodes about 0.5 MB of text at
    once, or one longer text.
    """
    with open(ranks_path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in chunks(utf8_batch(texts)[1], 1 << 19):
                tokens, offsets, counts = encode_texts(texts.slice(a, b - a).to_pylist(), content.value)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(counts), _lists(tokens, counts), _lists(offsets, counts)],
                    names=["doc_id", "n_tokens", "ids", "offsets"],
                )

    small_batches(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, offsets array<int>")


def decode(encoded: DataFrame, ranks_path: str, keep_ids: bool = False) -> DataFrame:
    """``encoded`` with ``decoded`` (binary), in place of ids and offsets or beside them: token bytes put down at their
    offsets. Null ids give none."""
    with open(ranks_path, "rb") as f:
        content = encoded.sparkSession.sparkContext.broadcast(f.read())
    small_batches(encoded)
    kept = [f for f in encoded.schema if keep_ids or f.name not in ("ids", "offsets")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(content.value)
        words, starts, lengths = ranks.words, ranks.starts, ranks.lengths
        for batch in batches:
            lists = batch.column("ids")
            counts = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            sizes = np.append(0, np.cumsum(counts))
            flat = np.asarray(lists.flatten())
            within = np.asarray(batch.column("offsets").flatten())
            for a, b in chunks(sizes, 1 << 17):
                ids, places = flat[sizes[a] : sizes[b]], within[sizes[a] : sizes[b]]
                last = np.cumsum(counts[a:b]) - 1  # of the ids of each row
                some = counts[a:b] > 0
                totals = np.zeros(b - a, np.int64)
                totals[some] = places[last[some]] + lengths[ids[last[some]]]
                ends = np.cumsum(totals)
                at = places + np.repeat(ends - totals, counts[a:b])
                data = np.empty(ends[-1] if b > a else 0, np.uint8)
                data[ragged(at, lengths[ids])] = words[ragged(starts[ids], lengths[ids])]
                raw, bounds = data.tobytes(), np.append(0, ends)
                out = pa.array([raw[i:j] for i, j in zip(bounds[:-1], bounds[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(f.name).slice(a, b - a) for f in kept] + [out], names=[f.name for f in kept] + ["decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    columns = [F.col(f"`{f.name}`") for f in kept if f.name not in ("ids", "offsets")]
    return encoded.select(*columns, "ids", "offsets").mapInArrow(run, f"{schema}, decoded binary")
