"""Hidden Markov language model over whole texts, beside an add-one unigram base.

Tokens are the words of a text (A-Z lower-cased, white space apart) and one end. A word is emitted by
class: p(word | state) = p(class | state) * p(word | class). The ``own`` most frequent tokens are a
class each; all others share ``shapes`` classes by their last bytes, where
p(word | class) = (c + 1) / (n + v + 1) with the word's count c, the class's count n and number of
distinct words v in the training tokens, so that each class keeps one part for what was never seen.
The emission table is of a fixed size whatever the corpus; the word counts grow with it and are
never gathered in one place: they are joined to the words of the texts.

Training is Baum-Welch. A task runs the scaled forward and backward recursions over its texts and
gives its expected counts; Spark adds them up per class, and the sums, of the size of the model,
make the next one. All training texts take part in every iteration. The score of a text is the
logarithm of its exact likelihood by the scaled forward recursion plus that of the words in their classes.

Recursions run over many texts at once: texts are laid one after the other into lanes of about equal
length, and each step advances all lanes; a lane that begins a new text starts from the initial
distribution. Long texts have lanes of their own, so short ones don't wait for them.

Defined results: a null or empty text has the end alone. A text is held out if crc32 of its doc_id as
text (null: of the empty text) modulo 7 is 2. With no training text, all counts are zero and the base
is log10(1). Repeated rows each get a row and each count; extra columns are left out; empty tables work.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, lower_words, small_batches, stored, text_bytes

END = b""  # no word is empty
FOLDS, HELD = 7, 2


def held_out(col: str) -> Column:
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % FOLDS == HELD


def shape(word: bytes, shapes: int) -> int:
    """The class of a word without a class of its own: by its last bytes, punctuation and digits."""
    bare = word.rstrip(b".,;:!?")
    return zlib.crc32(bare[-3:] + b"\0" + word[len(bare) :][:1] + bytes([any(48 <= b <= 57 for b in bare)])) % shapes


class _Numbers(dict):
    """Numbers of the known words, -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


# ---------------------------------------------------------------- counts


def count_tokens(texts: DataFrame, limit: int = 200_000) -> DataFrame:
    """(word, c) over ``texts`` (one binary column). Tasks count first and give what they have at ``limit`` words."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def task(batches):
        counts: Counter = Counter()
        for b in small_batches(batches, 512):
            for t in b.column(0).to_pylist():
                counts.update(lower_words(t))
            counts[END] += b.num_rows
            if len(counts) > limit:
                yield batch(schema, [list(counts), list(counts.values())])
                counts = Counter()
        if counts:
            yield batch(schema, [list(counts), list(counts.values())])

    return texts.mapInArrow(task, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """The bounded part of the corpus counts: totals, the most frequent words, sums of each shape class."""

    def __init__(self, total: int, distinct: int, top: list[tuple[bytes, int]], shape_n: np.ndarray, shape_v: np.ndarray, own: int):
        self.total, self.distinct, self.own, self.shapes = total, distinct, own, len(shape_n)
        self.number = _Numbers((w, i) for i, (w, _) in enumerate(top))
        counts = np.array([c for _, c in top], float)
        self.base_den = math.log10(total + distinct + 1)
        self.shape_den = np.log10(shape_n + shape_v + 1.0)
        # the last entries are those of a word that is not known
        self.classes = np.array([i if i < own else own + shape(w, self.shapes) for i, (w, _) in enumerate(top)] + [0], np.int64)
        self.logs = np.concatenate((np.log10(counts + 1), [0.0]))
        self.emit = np.where(np.arange(len(top) + 1) < own, 0.0, self.logs - self.shape_den[np.maximum(self.classes - own, 0)])
        self.emit[-1] = 0.0
        # training tokens of each class
        self.class_n = np.concatenate((counts[:own], np.zeros(own - len(counts[:own])), shape_n))


def fit_vocabulary(counts: DataFrame, own: int, known: int, shapes: int) -> Vocabulary:
    """``counts`` is read whole by Spark; the driver gets less than ``known`` words and ``shapes`` sums.

    A word is known by itself if it is at least one of ``known`` training tokens, so there are no more of them.
    """
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = [(bytes(r["word"]), r["c"]) for r in counts.where(F.col("c") * known >= total).collect()]
    top.sort(key=lambda x: (-x[1], x[0]))
    mine = {w for w, _ in top[:own]}
    schema = pa.schema([("shape", pa.int32()), ("n", pa.int64()), ("v", pa.int64())])

    def task(batches):
        n, v = np.zeros(shapes, np.int64), np.zeros(shapes, np.int64)
        for b in small_batches(batches, 8192):
            rest = [(shape(w, shapes), c) for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if w not in mine]
            k = np.fromiter((s for s, _ in rest), np.int64, len(rest))
            np.add.at(n, k, np.fromiter((c for _, c in rest), np.int64, len(rest)))
            np.add.at(v, k, 1)
        at = np.flatnonzero(v)
        yield batch(schema, [at.astype(np.int32), n[at], v[at]])

    shape_n, shape_v = np.zeros(shapes), np.zeros(shapes)
    for r in counts.select("word", "c").mapInArrow(task, "shape int, n long, v long").groupBy("shape").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        shape_n[r["shape"]], shape_v[r["shape"]] = r["n"], r["v"]
    return Vocabulary(total, distinct, top, shape_n, shape_v, own)


CODED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, n_rare long, known_logs double, emit double, classes binary, rare array<struct<word:binary,n:int>>"
_RARE = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))
CODED_SCHEMA = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("n_rare", pa.int64()), ("known_logs", pa.float64()), ("emit", pa.float64()), ("classes", pa.binary()), ("rare", _RARE)])


def encode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Class sequences of the texts, what the known words add to the logarithms, and the other words."""
    held = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def task(batches):
        v = held.value
        number_of, own, shapes = v.number.__getitem__, v.own, v.shapes
        shape_of: dict[bytes, int] = {}
        for b in small_batches(batches):
            out, words_flat, times_flat, ends = [], [], [], [0]
            for text in b.column(3).to_pylist():
                words = lower_words(text)
                words.append(END)
                k = np.fromiter(map(number_of, words), np.int64, len(words))
                classes, emit = v.classes[k], float(v.emit[k].sum())
                at = np.flatnonzero(k < 0)
                if len(at):
                    other = [words[i] for i in at.tolist()]
                    counted = Counter(other)
                    for w in counted:
                        if w not in shape_of:
                            shape_of[w] = shape(w, shapes)
                    s = np.fromiter(map(shape_of.__getitem__, other), np.int64, len(other))
                    classes[at] = own + s
                    emit -= float(v.shape_den[s].sum())
                    if len(shape_of) > 100_000:
                        shape_of.clear()
                    words_flat.extend(counted)
                    times_flat.extend(counted.values())
                ends.append(len(words_flat))
                out.append((len(words), len(words) - len(at), len(at), float(v.logs[k].sum()), emit, classes.astype("<u2").tobytes()))
            if out:
                rare = pa.StructArray.from_arrays([pa.array(words_flat, pa.binary()), pa.array(times_flat, pa.int32())], fields=list(_RARE.value_type))
                yield batch(CODED_SCHEMA, [*b.columns[:3], *zip(*out, strict=True), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare, _RARE)])

    return rows.mapInArrow(task, CODED)


# ---------------------------------------------------------------- recursions


class Model:
    """Initial, transition (states x states) and emission (classes x states) probabilities."""

    def __init__(self, initial: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.initial, self.step, self.emit = initial, step, emit


def first_model(class_n: np.ndarray, states: int, seed: int = 11, stay: float = 0.98) -> Model:
    """Class shares of the corpus, varied at random per state; states mostly stay as they are."""
    rng = np.random.default_rng(seed)
    share = (class_n + 1) / (class_n + 1).sum()
    emit = share[:, None] * rng.uniform(0.5, 1.5, (len(share), states))
    step = np.full((states, states), (1 - stay) / max(1, states - 1))
    np.fill_diagonal(step, stay if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), step, emit / emit.sum(0))


class Lanes:
    """Texts laid into at most ``n`` lanes, the longest lane first.

    ``classes``, ``starts`` and ``ends`` are steps x lanes, ``active[t]`` lanes hold a token at step t,
    ``places`` has (lane, first step) of each text.
    """

    def __init__(self, texts: list[np.ndarray], n: int):
        heap = [(0, i) for i in range(min(n, len(texts)))]
        held: list[list[int]] = [[] for _ in heap]
        for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
            size, lane = heapq.heappop(heap)
            held[lane].append(i)
            heapq.heappush(heap, (size + len(texts[i]), lane))
        sizes = np.array([sum(len(texts[i]) for i in h) for h in held])
        order = np.argsort(-sizes, kind="stable")
        self.classes = np.zeros((int(sizes.max()), len(held)), np.int32)
        self.starts = np.zeros(self.classes.shape, bool)
        self.ends = np.zeros(self.classes.shape, bool)
        self.places: list[tuple[int, int]] = [(0, 0)] * len(texts)
        for j, lane in enumerate(order):
            at = 0
            for i in held[lane]:
                end = at + len(texts[i])
                self.classes[at:end, j] = texts[i]
                self.starts[at, j] = self.ends[end - 1, j] = True
                self.places[i] = (j, at)
                at = end
        self.active = np.searchsorted(-sizes[order], -np.arange(len(self.classes)), side="left").tolist()


#: Vectors are scaled at every ``SCALED``-th step; between, 64-bit numbers hold the products.
SCALED = 8
_STRETCH = 256


def forward(model: Model, laid: Lanes, alpha: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(scales, finals): the sums that vectors were divided by, and those at the ends of texts.

    ``alpha``, where given, is filled with the forward vectors.
    """
    steps, n = laid.classes.shape
    ones = np.ones(len(model.initial))
    scales, finals = np.ones(((steps + SCALED - 1) // SCALED, n)), np.ones((steps, n))
    last = np.zeros((n, len(ones)))
    starting, ending = laid.starts.any(1).tolist(), laid.ends.any(1).tolist()
    for low in range(0, steps, _STRETCH):
        high = min(low + _STRETCH, steps)
        emitted = model.emit[laid.classes[low:high, : laid.active[low]]]
        for t in range(low, high):
            m = laid.active[t]
            now = last[:m] @ model.step
            if starting[t]:
                now[laid.starts[t, :m]] = model.initial
            now *= emitted[t - low, :m]
            if t % SCALED == 0:
                s = now @ ones
                now /= s[:, None]
                scales[t // SCALED, :m] = s
            if ending[t]:
                finals[t, :m] = np.where(laid.ends[t, :m], now @ ones, 1)
            if alpha is not None:
                alpha[t, :m] = now
            last = now
    return scales, finals


class Expected:
    """Sums of expected counts: first states, transitions, classes by state, and the log-likelihood."""

    def __init__(self, states: int, classes: int):
        self.first, self.moves, self.emitted, self.log = np.zeros(states), np.zeros((states, states)), np.zeros((classes, states)), 0.0

    def add(self, model: Model, texts: list[np.ndarray], n_lanes: int) -> None:
        """One pass of the forward and backward recursions over ``texts``."""
        if not texts:
            return
        laid = Lanes(texts, n_lanes)
        steps, n = laid.classes.shape
        states = len(model.initial)
        alpha = np.zeros((steps, n, states))
        scales, finals = forward(model, laid, alpha)
        self.log += float(np.log(scales).sum() + np.log(finals).sum())
        back, beta = model.step.T.copy(), np.ones((n, states))
        starting = laid.starts.any(1).tolist()
        for low in range((steps - 1) // _STRETCH * _STRETCH, -1, -_STRETCH):
            high, width = min(low + _STRETCH, steps), laid.active[low]
            classes, starts = laid.classes[low:high, :width], laid.starts[low:high, :width]
            right = model.emit[classes]  # becomes emission times beta
            for t in range(high - 1, low - 1, -1):
                m = laid.active[t]
                x = right[t - low, :m]
                x *= beta[:m]
                before = x @ back
                if t % SCALED == 0:
                    before /= (before @ np.ones(states))[:, None]
                if starting[t]:
                    before[starts[t - low, :m]] = 1  # the end of the text before
                beta[:m] = before
            # posteriors are forward predictions times right, in shares
            prior = alpha[low - 1 : high - 1, :width] if low else np.concatenate((np.zeros((1, width, states)), alpha[: high - 1, :width]))
            if laid.active[high - 1] == width:  # no lane ends here
                prior, right, begins, flat = prior.reshape(-1, states), right.reshape(-1, states), starts.ravel(), classes.ravel()
            else:
                inside = np.arange(width)[None, :] < np.array(laid.active[low:high])[:, None]
                prior, right, begins, flat = prior[inside], right[inside], starts[inside], classes[inside]
            posterior = prior @ model.step
            posterior[begins] = model.initial
            posterior *= right
            total = (posterior @ np.ones(states))[:, None]
            posterior /= total
            right /= total
            right[begins] = 0
            self.moves += prior.T @ right * model.step
            self.first += posterior[begins].sum(0)
            for k in range(states):
                self.emitted[:, k] += np.bincount(flat, posterior[:, k], len(self.emitted))


def pools(batches, at: int, together: int, long: int) -> Iterator[tuple[list[int], list[np.ndarray], int]]:
    """Texts of Arrow batches in groups of about ``together`` tokens, long texts apart: (positions, classes, lanes).

    Positions count the rows of the whole task.
    """
    short: tuple[list[int], list[np.ndarray]] = ([], [])
    far: tuple[list[int], list[np.ndarray]] = ([], [])
    sizes, row = [0, 0], 0
    for b in small_batches(batches, 1024):
        for data in b.column(at).to_pylist():
            c = np.frombuffer(data, "<u2")
            k = int(len(c) > long)
            which = far if k else short
            which[0].append(row)
            which[1].append(c)
            sizes[k] += len(c)
            row += 1
            if sizes[k] >= together * (1 + k):
                yield which[0][:], which[1][:], 128 if not k else 64
                which[0].clear()
                which[1].clear()
                sizes[k] = 0
    for which, n in ((short, 128), (far, 64)):
        if which[0]:
            yield which[0][:], which[1][:], n


def expect(coded: DataFrame, model: Model, together: int = 250_000, long: int = 2000) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch counts over ``coded`` (one column: classes): tasks give theirs, Spark adds them per class."""
    states, n_classes = model.emit.shape[1], len(model.emit)
    held = coded.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("key", pa.int32()), *((f"s{k}", pa.float64()) for k in range(states))])

    def task(batches):
        sums = Expected(states, n_classes)
        for _, texts, n in pools(batches, 0, together, long):
            sums.add(held.value, texts, n)
        at = np.flatnonzero(sums.emitted.any(1))
        # classes by number; below zero: first states, transitions by row, log-likelihood
        keys = np.concatenate((at, [-1], -2 - np.arange(states), [-2 - states]))
        table = np.vstack((sums.emitted[at], sums.first, sums.moves, np.eye(1, states) * sums.log))
        yield batch(schema, [keys.astype(np.int32), *table.T])

    rows = coded.mapInArrow(task, "key int, " + ", ".join(f"s{k} double" for k in range(states))).groupBy("key").agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(states))).collect()
    found = {r["key"]: np.array(r[1:]) for r in rows}
    zero = np.zeros(states)
    emitted = np.array([found.get(i, zero) for i in range(n_classes)])
    held.destroy()
    return found.get(-1, zero), np.array([found.get(-2 - k, zero) for k in range(states)]), emitted, float(found.get(-2 - states, zero)[0])


def next_model(first: np.ndarray, moves: np.ndarray, emitted: np.ndarray, share: np.ndarray, smooth: float = 200.0) -> Model:
    """Shares of the expected counts; emissions lean on the corpus's class shares by ``smooth`` tokens."""
    initial = (first + 1) / (first + 1).sum()
    step = (moves + 1) / (moves + 1).sum(1, keepdims=True)
    emit = emitted + smooth * share[:, None]
    return Model(initial, step, emit / emit.sum(0))


def train(coded: DataFrame, vocabulary: Vocabulary, states: int, iterations: int) -> tuple[Model, list[float]]:
    """The model after ``iterations`` of Baum-Welch, and the natural log-likelihood before each of them."""
    share = (vocabulary.class_n + 1) / (vocabulary.class_n + 1).sum()
    model, logs = first_model(vocabulary.class_n, states), []
    for _ in range(iterations):
        first, moves, emitted, log = expect(coded, model)
        model = next_model(first, moves, emitted, share)
        logs.append(log)
    return model, logs


def likelihoods(model: Model, texts: list[np.ndarray], n_lanes: int) -> np.ndarray:
    """log10 of the exact likelihood of each class sequence."""
    laid = Lanes(texts, n_lanes)
    scales, finals = forward(model, laid)
    total = np.concatenate((np.zeros((1, scales.shape[1])), np.cumsum(np.log10(scales), 0)))
    out = []
    for t, (lane, at) in zip(texts, laid.places, strict=True):
        end = at + len(t)
        out.append(total[-(-end // SCALED), lane] - total[-(-at // SCALED), lane] + math.log10(finals[end - 1, lane]))
    return np.array(out)


def score_classes(coded: DataFrame, model: Model, together: int = 500_000, long: int = 2000) -> DataFrame:
    """(row, path): log10 likelihood of each class sequence."""
    held = coded.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("row", pa.int64()), ("path", pa.float64())])

    def task(batches):
        rows: list[int] = []

        def seen(bs):
            for b in bs:
                rows.extend(b.column(0).to_pylist())
                yield b

        for at, texts, n in pools(seen(batches), 1, together, long):
            yield batch(schema, [[rows[i] for i in at], likelihoods(held.value, texts, n)])

    return coded.select("row", "classes").mapInArrow(task, "row long, path double")


def score_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", states: int = 8, iterations: int = 5, own: int = 8192, known: int = 1_000_000, shapes: int = 2048) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), text_bytes(text_col).alias("text"))
    counts = stored(count_tokens(rows.where("not held_out").select("text")), "counts")
    vocabulary = fit_vocabulary(counts, own, known, shapes)
    # rows are numbered once, on disk
    coded = stored(encode(rows, vocabulary), "coded")
    model, _ = train(coded.where("not held_out").select("classes"), vocabulary, states, iterations)
    # words outside the broadcast table: their counts are joined, one row for each word of a text
    rare = coded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n").join(counts, "word")
    rest = rare.groupBy("row").agg(F.sum("n").alias("met"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("logs"))
    zero = F.lit(0.0)
    paths = stored(score_classes(coded, model), "paths")
    return (
        coded.drop("classes", "rare").join(paths, "row").join(rest, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens",
            (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
            F.lit(vocabulary.total).cast("long").alias("train_tokens"),
            (F.col("known_logs") + F.coalesce("logs", zero) - F.col("n_tokens") * F.lit(vocabulary.base_den)).alias("base_score"),
            (F.col("path") + F.col("emit") + F.coalesce("logs", zero)).alias("score"),
        )
    )
