"""Quality classifier by co-training: a text view and a metadata view teach each other, then are calibrated and combined."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, ragged, small_batches, stored, utf8_batch

MOST_FEATURES = 4096
LEAST_DOCS = 5  # labelled texts that hold a token before it may become a feature
LEAST_Z = 4.0  # standard deviations by which rejected texts must have it more, or less, often
ROUNDS = 3
LEAST_ROWS = 100  # of an eighth of the labelled rows, for it to serve alone
CONFIDENT = 0.95
SEED = "weft-quality"
CACHED_WORDS = 100_000
# sources and languages also count by a hash, so that those without a label can be taught about
SOURCE_BINS, LANG_BINS = 1024, 64

_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_MARKS = "".join(c for c in map(chr, range(128)) if not c.isalpha())
_SPECIAL = "\u0130\u03a3"  # become two letters, or one by its place in the word
PREFIXES = (4, 5, 6, 7, 8)
# classes of bytes: 0 other, 1 upper case, 2 lower case, 3 digit, 4 symbol, 5 white space
_BYTES = np.zeros(256, np.uint8)
_BYTES[33:127] = 4
_BYTES[48:58], _BYTES[65:91], _BYTES[97:123] = 3, 1, 2
_BYTES[[32, *range(9, 14)]] = 5


SHAPE_NAMES = ("upper", "digit", "symbol", "different", "width", "words")
SHAPES = [f"={name}{i}" for name in SHAPE_NAMES for i in range(40)]


def word_tokens(raw: str) -> tuple[str, ...]:
    """The word in lower case without marks at its ends, and its first 4 to 8 letters."""
    word = _EDGES.sub("", raw.lower())
    return (word, *("^" + word[:k] for k in PREFIXES if len(word) > k)) if word else ()


def shape_bins(data: np.ndarray, offsets: np.ndarray, words: np.ndarray, different: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    """The make-up of each text, given its bytes and how many words, and different ones, it has: shares of kinds of bytes, of
    different words, length of words and text; each with the number of its token."""
    kinds = _BYTES[data]
    sizes = np.maximum(np.diff(offsets), 1)
    for name, kind in (("upper", 1), ("digit", 3), ("symbol", 4)):
        share = np.diff(np.append(0, np.cumsum(kinds == kind))[offsets]) / sizes
        yield name, np.minimum(share * 40, 20).astype(np.int64)
    n = np.maximum(words, 1)
    yield "different", (20 * different / n).astype(np.int64)
    yield "width", np.minimum(sizes / n, 20).astype(np.int64)
    yield "words", np.minimum(np.frexp(n.astype(float))[1], 39).astype(np.int64)


def metadata_tokens(source, lang, n_chars) -> list[str]:
    n = 0 if n_chars is None or n_chars != n_chars else int(n_chars)
    return [f"source={source}", f"lang={lang}", f"chars={max(n, 0).bit_length()}", _bin("source", source, SOURCE_BINS), _bin("lang", lang, LANG_BINS)]


def _bin(name: str, value, bins: int) -> str:
    return f"{name}~{zlib.crc32(str(value).encode()) % bins}"


class View(NamedTuple):
    """A linear model over the tokens of a view."""

    weights: dict[str, float]
    bias: float


class Model(NamedTuple):
    text: View
    meta: View
    mix: tuple[float, float, float]  # bias, and weights of the two views' log-odds

    def probability(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Of rejection, from the log-odds of both views."""
        return 1 / (1 + np.exp(-np.clip(self.mix[0] + self.mix[1] * text + self.mix[2] * meta, -50, 50)))


class _Words(dict):
    """The features of raw words, as their numbers in ``number``; those of a word that is looked at by itself are kept."""

    def __init__(self, number: dict[str, int]):
        super().__init__()
        self.number = number
        self.shapes = {name: np.array([number.get(f"={name}{i}", -1) for i in range(40)]) for name in SHAPE_NAMES}
        # without the mark of a beginning; by the number of letters, 0 for whole words
        held = {k: [t for t in number if t[:1] == "^" and len(t) == k + 1] for k in PREFIXES} | {0: [t for t in number if t[:1] not in ("^", "=")]}
        self.held = {k: (pa.array([t[k > 0 :] for t in ts], pa.string()), np.array([number[t] for t in ts], np.int64)) for k, ts in held.items()}
        starts = {t[1 : 1 + PREFIXES[0]] for k in PREFIXES for t in held[k]}
        self.starts = pa.array(sorted(starts), pa.string())

    def __missing__(self, raw: str) -> tuple[int, ...]:
        found = tuple(self.number[t] for t in word_tokens(raw) if t in self.number)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[raw] = found
        return found

    def _in(self, k: int, texts: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``texts`` that are features of ``k`` letters: where they are (``at``), and their numbers."""
        values, numbers = self.held[k]
        place = np.asarray(pc.index_in(texts, value_set=values).fill_null(-1))
        return at[place >= 0], numbers[place[place >= 0]]

    def features(self, raws: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``raws``, number) of the features that ``word_tokens`` gives, for many words at once; of few words one by one."""
        bare = pc.ascii_trim(raws, characters=_MARKS)
        plain = plain_words(bare)
        odd = np.flatnonzero(~plain)
        one_by_one = [self[raw] for raw in raws.take(pa.array(odd)).to_pylist()]
        at = [np.repeat(odd, [len(x) for x in one_by_one])]
        numbers = [np.fromiter(chain.from_iterable(one_by_one), np.int64, len(at[0]))]
        where = np.flatnonzero(plain)
        lower = pc.utf8_lower(bare.take(pa.array(where)))
        found = [self._in(0, lower, where)]
        # most words do not begin like a feature
        begun = pc.is_in(pc.utf8_slice_codeunits(lower, 0, PREFIXES[0]), value_set=self.starts)
        lower, where = lower.filter(begun), where[np.asarray(begun)]
        length = np.asarray(pc.utf8_length(lower))
        for k in PREFIXES:
            longer = length > k
            found.append(self._in(k, pc.utf8_slice_codeunits(lower.filter(pa.array(longer)), 0, k), where[longer]))
        return np.concatenate([*at, *[x for x, _ in found]]), np.concatenate([*numbers, *[x for _, x in found]])


def plain_words(bare: pa.Array) -> np.ndarray:
    """Whether each word, without ASCII marks at its ends, is what ``word_tokens`` makes of it but for lower case, and is lowered
    letter by letter: it begins and ends with letters, all are of at most two bytes, and none has a special lower case."""
    data, offsets = utf8_batch(bare)
    sizes = np.diff(offsets)
    some = sizes > 0
    plain = np.zeros(len(sizes), bool)
    if not some.any():
        return ~plain
    begin = offsets[:-1][some]
    special = data > 0xDF
    for first, second in (b.encode() for b in _SPECIAL):
        special[:-1] |= (data[:-1] == first) & (data[1:] == second)
    ascii_ends = (data[begin] < 0x80) & (data[offsets[1:][some] - 1] < 0x80)
    plain[some] = ~np.logical_or.reduceat(special, begin) & (ascii_ends | np.asarray(pc.utf8_is_alpha(bare))[some])
    plain[~some] = True
    return plain


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def distinct_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The words of each text of ``column`` (no nulls): how many it has, then (row, word) of its different ones, by row, as
    places in the array of all different words."""
    split = pc.utf8_split_whitespace(column)
    row = np.repeat(np.arange(len(column)), np.asarray(split.value_lengths()))
    coded = split.flatten().dictionary_encode()
    code, raws = np.asarray(coded.indices).astype(np.int64), coded.dictionary
    blank = pc.index(raws, "").as_py()
    if blank >= 0:  # at white space at the ends of a text
        row, code = row[code != blank], code[code != blank]
    pairs = _distinct(row * max(len(raws), 1) + code)
    return np.bincount(row, minlength=len(column)), *np.divmod(pairs, max(len(raws), 1)), raws


def text_features(column: pa.Array, words: _Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The features of the texts of ``column`` (no nulls), some texts at a time: how many each has, and their numbers, rising
    within a text."""
    data, offsets = utf8_batch(column)
    for a, b in chunks(offsets):
        n_words, row, code, raws = distinct_words(column.slice(a, b - a))
        place, number = words.features(raws)
        flat = number[np.argsort(place, kind="stable")]
        sizes = np.bincount(place, minlength=len(raws))
        bright = sizes[code] > 0
        at, of = row[bright], code[bright]
        rows, numbers = [np.repeat(at, sizes[of])], [flat[ragged((np.cumsum(sizes) - sizes)[of], sizes[of])]]
        part = data[offsets[a] : offsets[b]]
        for name, bins in shape_bins(part, offsets[a : b + 1] - offsets[a], n_words, np.bincount(row, minlength=b - a)):
            number = words.shapes[name][bins]
            rows.append(np.flatnonzero(number >= 0))
            numbers.append(number[number >= 0])
        most = max(len(words.number), 1)
        row, number = np.divmod(_distinct(np.concatenate(rows) * most + np.concatenate(numbers)), most)
        yield np.bincount(row, minlength=b - a), number


def _lists(column: pa.Array, words: _Words) -> pa.Array:
    """The numbers of the features of each text, as lists."""
    found = list(text_features(column, words))
    sizes = np.concatenate([np.zeros(1, np.int64), *[n for n, _ in found]])
    numbers = np.concatenate([np.zeros(0, np.int64), *[x for _, x in found]])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(numbers, pa.int32()))


def _place(kind: str) -> Column:
    return F.xxhash64(F.lit(SEED + kind), F.col("doc_id"))


def _marked(labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, reject) of at most ``most`` labelled doc_ids, those of the least hash."""
    foul = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    marked = (
        labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(foul.cast("int")).alias("reject"))
        .orderBy(_place("a"), "doc_id").limit(most)
    )
    return stored(marked, "labelled")


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "source", "lang",
        F.col("n_chars").cast("long").alias("n_chars"),
    )


def _sample(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(doc_id, text, source, lang, n_chars, reject, part) of the documents in ``marked``, one row of each doc_id.

    Three quarters are of the part 'train', an eighth each of 'scale' and 'mix'.
    """
    # of rows that share a doc_id the least one, so that the bound holds for rows too
    one = F.min(F.struct("text", "source", "lang", "n_chars", "reject")).alias("row")
    chosen = _read(docs).join(F.broadcast(marked), "doc_id").groupBy("doc_id").agg(one).select("doc_id", "row.*")
    eighth = F.pmod(_place("c"), F.lit(8))
    return stored(chosen.withColumn("part", F.when(eighth == 0, "scale").when(eighth == 4, "mix").otherwise("train")), "sample")


def _significant(sample: DataFrame) -> set[str]:
    """The at most MOST_FEATURES tokens whose frequency differs most between accepted and rejected texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for text, reject in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[reject].update({t for raw in set(text.split()) for t in word_tokens(raw)})
        both = counts[0] | counts[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(both), pa.string()), pa.array([counts[0][t] + counts[1][t] for t in both], pa.int64()), pa.array([counts[1][t] for t in both], pa.int64())],
            names=["token", "held", "rejected"],
        )

    train = sample.where("part = 'train'")
    n, n1 = train.agg(F.count(F.lit(1)), F.sum("reject")).first()
    if not n or not n1 or n1 == n:
        return set()
    share = n1 / n
    counted = train.select("text", "reject").mapInArrow(run, "token string, held long, rejected long").groupBy("token").agg(F.sum("held").alias("held"), F.sum("rejected").alias("rejected"))
    z = F.abs((F.col("rejected") - F.col("held") * share) / F.sqrt(F.col("held") * share * (1 - share)))
    best = counted.where(F.col("held") >= LEAST_DOCS).withColumn("z", z).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "token").limit(MOST_FEATURES)
    return {r["token"] for r in best.select("token").collect()}


def _features(sample: DataFrame, names: list[str]) -> pa.Table:
    """Of the sample, small by its bound, the numbers of its text tokens in ``names``, its metadata tokens and labels."""
    number = {t: i for i, t in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(number)
        for batch in batches:
            found = _lists(batch.column("text"), words)
            meta = [metadata_tokens(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("source", "lang", "n_chars")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), found, pa.array(meta, pa.list_(pa.string())), batch.column("reject"), batch.column("part")],
                names=["doc_id", "tokens", "meta", "reject", "part"],
            )

    return sample.mapInArrow(run, "doc_id long, tokens array<int>, meta array<string>, reject int, part string").toArrow()


def _unlabelled(docs: DataFrame, marked: DataFrame, names: list[str], metas: list[str]) -> DataFrame:
    """(tokens, meta): the numbers, in ``names`` and ``metas``, of the tokens of every row of ``docs`` that is not in ``marked``.

    Written once, a few dozen numbers a row, so that the rounds need not read the texts again.
    """
    number, place = ({t: i for i, t in enumerate(x)} for x in (names, metas))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(number)
        for batch in batches:
            found = _lists(batch.column("text"), words)
            meta = [[place[t] for t in metadata_tokens(*x) if t in place] for x in zip(*(batch.column(c).to_pylist() for c in ("source", "lang", "n_chars")))]
            yield pa.RecordBatch.from_arrays([found, pa.array(meta, pa.list_(pa.int32()))], names=["tokens", "meta"])

    others = _read(docs).join(F.broadcast(marked.select("doc_id")), "doc_id", "left_anti").select("text", "source", "lang", "n_chars")
    return stored(others.mapInArrow(run, "tokens array<int>, meta array<int>"), "unlabelled")


def _taught(unlabelled: DataFrame, fitted: list[tuple[np.ndarray, float]]) -> list[np.ndarray]:
    """What each view learns from the rows that the other is sure of: per token the log of how much more often rejected
    than accepted rows hold it than by chance.

    Rows are scored where they lie. Tasks send one count per token and label, as many as the model has weights.
    """
    shapes = [len(w) for w, _ in fitted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros((2, n + 1), np.int64) for n in shapes]  # the last column counts rows
        for batch in batches:
            if not batch.num_rows:
                continue
            held = []
            for column in (batch.column("tokens"), batch.column("meta")):
                sizes = np.asarray(column.value_lengths()).astype(np.int64)
                held.append((np.asarray(column.flatten()).astype(np.int64), sizes, np.cumsum(sizes) - sizes))
            chance = [1 / (1 + np.exp(-np.clip(b + np.add.reduceat(w[t], first), -50, 50))) for (w, b), (t, _, first) in zip(fitted, held)]
            for pupil, teacher in ((0, 1), (1, 0)):
                tokens, sizes, _ = held[pupil]
                for label, sure in enumerate((chance[teacher] <= 1 - CONFIDENT, chance[teacher] >= CONFIDENT)):
                    counts[pupil][label, :-1] += np.bincount(tokens[np.repeat(sure, sizes)], minlength=shapes[pupil])
                    counts[pupil][label, -1] += int(sure.sum())
        for view, table in enumerate(counts):
            label, token = np.nonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(token), view), pa.int32()), pa.array(label, pa.int32()), pa.array(token, pa.int32()), pa.array(table[label, token], pa.int64())],
                names=["view", "label", "token", "n"],
            )

    summed = unlabelled.mapInArrow(run, "view int, label int, token int, n long").groupBy("view", "label", "token").agg(F.sum("n").alias("n")).toArrow()
    counts = [np.zeros((2, n + 1)) for n in shapes]
    for view, table in enumerate(counts):
        of = np.asarray(summed["view"]) == view
        table[np.asarray(summed["label"])[of], np.asarray(summed["token"])[of]] = np.asarray(summed["n"])[of]
    out = []
    for table in counts:
        rows, held = table[:, -1:], table[:, :-1]
        expected = held.sum(0) * rows / max(rows.sum(), 1.0)
        ratio = np.log((held + 1) / (expected + 1))
        out.append(ratio[1] - ratio[0])
    return out


class _Matrix:
    """Rows of tokens as a sparse matrix of zeros and ones; column: the tokens of all rows in turn, as numbers in ``names``."""

    def __init__(self, names: list[str], column: np.ndarray, sizes: np.ndarray):
        self.names, self.column, self.n = names, column.astype(np.int64), len(sizes)
        self.row, self.first = np.repeat(np.arange(self.n), sizes), np.cumsum(sizes) - sizes  # every row has tokens

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.add.reduceat(weights[self.column], self.first)

    def fit(self, target: np.ndarray, weight: np.ndarray, taught: np.ndarray, penalty: float = 1e-3, steps: int = 400) -> tuple[np.ndarray, float]:
        """Logistic regression by accelerated gradient descent; rows of weight 0 take no part.

        ``taught`` gives weights from elsewhere: their sum over a row is a
        feature of its own, so the labelled rows decide how far they are
        followed. They are part of the weights returned.
        """
        given = self.scores(taught, 0.0)
        most = max(np.abs(given).max(initial=0.0), 1e-9)
        given = given / most
        total = max(weight.sum(), 1.0)
        rate = 4.0 / (2 + np.bincount(self.row, minlength=self.n).max(initial=1))
        # the weights, then the one of what was taught, then the bias, which is not held back
        w, v = np.zeros(len(self.names) + 2), np.zeros(len(self.names) + 2)
        held = np.append(np.full(len(w) - 1, penalty), 0.0)
        for step in range(steps):
            at = w + step / (step + 3) * v
            chance = 1 / (1 + np.exp(-np.clip(self.scores(at[:-2], at[-1]) + at[-2] * given, -50, 50)))
            error = weight * (chance - target) / total
            slope = np.concatenate([np.bincount(self.column, error[self.row], len(self.names)), [error @ given, error.sum()]])
            v = at - rate * (slope + held * at) - w
            w = w + v
        return w[:-2] + w[-2] / most * taught, float(w[-1])


def _calibrated(columns: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Bias and weights of a logistic regression on a few columns, by Newton's method with a small penalty.

    Each column is a score of the target, so a weight below 0 is chance: such columns get 0.
    """
    used = np.arange(columns.shape[1])
    while True:
        x = np.column_stack([np.ones(len(target)), columns[:, used]])
        w = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
            w -= np.linalg.solve(hessian, x.T @ (p - target) + 1e-2 * w)
        if (w[1:] >= 0).all():
            out = np.zeros(columns.shape[1] + 1)
            out[0], out[1 + used] = w[0], w[1:]
            return out
        used = used[w[1:] >= 0]


def co_train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, most_labelled: int = 20_000) -> Model:
    """Fit on ``docs`` and ``labels`` (doc_id, quality, toxic): low quality and toxic texts are to be rejected.

    Two views see different things of a row: its text (significant words and
    word beginnings, make-up of the text) and its metadata (source, lang,
    n_chars). Each round, both are fitted, and each labels every other row of
    ``docs`` that it is sure of: how often these rows hold each token of the
    other view is counted over all documents, and that view is taught by the
    counts in the next round. Only the labelled side is a sample, of at most
    ``most_labelled`` documents; those beyond teach like unlabelled ones.
    Of the labelled rows an eighth calibrates each view and another eighth
    combines the calibrated views; if one of the two lacks rows of a kind, or has
    fewer than ``LEAST_ROWS``, both serve for both. Without rows of both kinds the model accepts everything.
    Rows with a null doc_id, or with neither quality nor toxic, are no labels; a
    label rejects on whichever of the two says so, and several labels of a
    document reject it if one does. Of labelled documents with the same doc_id
    one is looked at. Null and empty texts are learnt from by their make-up;
    empty tables of documents or labels give the model that accepts everything.
    """
    small_batches(docs)
    marked = _marked(labels, most_labelled)
    sample = _sample(docs, marked)
    names = sorted(_significant(sample)) + SHAPES
    rows = _features(sample, names)
    # in the order of ids, so that sums are the same on every run
    rows = rows.take(pa.array(np.argsort(np.asarray(rows["doc_id"]), kind="stable")))
    target, part = np.asarray(rows["reject"]), np.asarray(rows["part"].to_pylist(), dtype=object)
    train, scale, mix = (part == name for name in ("train", "scale", "mix"))
    both_kinds = lambda x: len({*target[x].tolist()}) == 2
    if not both_kinds(train) or not both_kinds(scale | mix):
        return Model(View({}, 0.0), View({}, 0.0), (-50.0, 0.0, 0.0))
    if not both_kinds(scale) or not both_kinds(mix) or min(scale.sum(), mix.sum()) < LEAST_ROWS:
        scale = mix = scale | mix
    tokens, meta = rows["tokens"].combine_chunks(), rows["meta"].combine_chunks()
    metas = sorted({*meta.flatten().to_pylist()} | {f"source~{i}" for i in range(SOURCE_BINS)} | {f"lang~{i}" for i in range(LANG_BINS)})
    place = {t: i for i, t in enumerate(metas)}
    views = [
        _Matrix(names, np.asarray(tokens.flatten()), np.asarray(tokens.value_lengths())),
        _Matrix(metas, np.array([place[t] for t in meta.flatten().to_pylist()]), np.asarray(meta.value_lengths())),
    ]
    unlabelled = _unlabelled(docs, marked, names, metas)
    taught = [np.zeros(len(v.names)) for v in views]
    for turn in range(rounds):
        scores, fitted = [], []
        for view, given in zip(views, taught):
            w, bias = view.fit((target == 1).astype(float), train.astype(float), given)
            raw = view.scores(w, bias)
            to = _calibrated(raw[scale, None], target[scale])
            fitted.append((w * to[1], bias * to[1] + to[0]))
            scores.append(raw * to[1] + to[0])
        if turn + 1 < rounds:
            taught = _taught(unlabelled, fitted)
    weights = _calibrated(np.column_stack(scores)[mix], target[mix])
    text, meta = (View({t: float(x) for t, x in zip(v.names, w) if x}, float(b)) for v, (w, b) in zip(views, fitted))
    return Model(text, meta, tuple(float(x) for x in weights))


def scorer(model: Model):
    """A function of the columns (text, source, lang, n_chars) to a struct (text_score, meta_score, reject_probability)."""

    @F.pandas_udf("text_score double, meta_score double, reject_probability double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        # numbered in the order of tokens, which is fixed, so that sums are the same on every run
        names = sorted(model.text.weights)
        words, weight = _Words({t: i for i, t in enumerate(names)}), np.array([model.text.weights[t] for t in names], float)
        for texts, sources, langs, sizes in batches:
            content, meta = [], []
            for sizes_of, numbers in text_features(pa.array(texts, pa.string()), words):
                ends, held = np.cumsum(sizes_of).tolist(), weight[numbers].tolist()
                content += [model.text.bias + sum(held[i:j]) for i, j in zip([0, *ends], ends)]
            for row in zip(sources, langs, sizes):
                meta.append(model.meta.bias + sum(model.meta.weights.get(t, 0.0) for t in metadata_tokens(*row)))
            content, meta = np.array(content, float), np.array(meta, float)
            yield pd.DataFrame({"text_score": content, "meta_score": meta, "reject_probability": model.probability(content, meta)})

    return score


def scored(docs: DataFrame, model: Model) -> Column:
    """The score of each row of ``docs``; null and empty texts are scored by their make-up and metadata like others.

    Texts reach Python workers in batches of 4 MB in this session.
    """
    small_batches(docs)
    return scorer(model)(F.coalesce(docs["text"], F.lit("")), docs["source"], docs["lang"], docs["n_chars"].cast("long"))


def classify(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, text_score, meta_score (log-odds of rejection by each view), reject_probability and kept, one row per row of ``docs``; none for an empty table."""
    rated = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scored(docs, model).alias("s"))
    return rated.select("doc_id", "s.*", (F.col("s.reject_probability") < threshold).alias("kept"))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns, in place (nothing is shuffled); none of an empty table."""
    return docs.where(scored(docs, model)["reject_probability"] < threshold)
