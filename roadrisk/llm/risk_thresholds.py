"""Quality rules with risk-controlled cutoffs.

Each rule is a number in [0, 1] of a document (share of symbols, upper case, repeated lines ...). One half of
the labelled documents (by a hash of their id) tells how much evidence a rule's number is against a
document: the logarithm of how much likelier bad documents reach it than good ones, never falling and never
below 0. A document's score is the sum over the rules, scaled to bins 0 .. 100; it is rejected if its score lies above the
cutoff of its stratum (language).

Cutoffs come from the other half, the holdout: for a stratum with n good documents, k of which a cutoff
would reject, the false rejection rate is above ``alpha`` with p-value P(Bin(n, alpha) <= k), the
exact binomial bound. Cutoffs are tested from the mildest to the strictest (a fixed sequence, which
stops at the first that can't be certified), and the level ``delta`` is divided by the number of strata
(Bonferroni), so that with probability at least 1 - delta the rules together reject at most ``alpha`` of the good
documents in every stratum at once. One score for all rules needs one test in each stratum, with the whole ``alpha``: some
220 good holdout documents of a stratum are enough for a cutoff. A stratum with fewer gets none and loses nothing to the method.

Counts, bins and cutoffs cover all labelled rows: Spark counts documents by rule and bin, then good holdout documents
by stratum and score, and only these tables (7 x 101 x 2 rows, strata x 101 rows at most) reach the driver.

Defined results: a null or empty text has no words and so fails the base rule; a null language is a
stratum of its own; a document with several labels counts as good only if all say so; a label of
null is left out; repeated documents each get a row; extra columns are left out. Empty tables work.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, small_batches, stored

RULES = ("symbols", "exclaim", "upper", "dup_lines", "repeat_words", "digits", "long_words")
BINS = 100  #: a rule's number is cut into bins 0 .. BINS, bin = ceil(100 x)
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

_SYMBOLS = b"#*$%&|<>"
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_LETTER = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))
_NOT_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)
_NOT_SYMBOL = bytes(b for b in range(256) if b not in _SYMBOLS)
_SPACE = b" \t\n\r\x0b\x0c"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text, the first one included."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pairs = a[:-1] * len(ids) + a[1:]
    _, pairs = np.unique(pairs, return_inverse=True)
    _, inverse, counts = np.unique(pairs[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    mark = np.zeros(len(words), bool)
    for k in range(3):
        mark[k : k + n] |= twice
    return int(mark.sum())


def measure(text: bytes) -> tuple[int, int, int, int, int, list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the bin of each rule."""
    words = text.split()
    n = len(words)
    chars = sum(map(len, words)) if text.isascii() else len(text.translate(None, _SPACE).decode("utf-8"))
    symbols = len(text.translate(None, _NOT_SYMBOL))
    seen: set[bytes] = set()
    lines = dups = 0
    for line in text.split(b"\n"):
        if line.split(None, 1):
            lines += 1
            dups += line in seen
            seen.add(line)
    repeats = repeated_words(words)
    letters = len(text.translate(None, _NOT_LETTER))
    values = (
        symbols / max(chars, 1),
        text.count(b"!") / max(n, 1),
        len(text.translate(None, _NOT_UPPER)) / max(letters, 1),
        dups / max(lines, 1),
        repeats / max(n, 1),
        len(text.translate(None, _NOT_DIGIT)) / max(chars, 1),
        chars / max(n, 1) / 50,
    )
    return n, chars, symbols, dups, repeats, [min(BINS, math.ceil(BINS * v)) for v in values]


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = pa.schema([*((c, pa.int64()) for c in COUNTS), ("bins", pa.list_(pa.int32()))])
MEASURES = ", ".join(f"{c} long" for c in COUNTS) + ", bins array<int>"


def measures(col: Column) -> Column:
    """Counts and bins of a text column as one struct."""

    @F.arrow_udf(f"struct<{MEASURES.replace(' long', ':long').replace(' array', ':array')}>")
    def run(texts: pa.Array) -> pa.Array:
        out = [measure(t) for at in range(0, len(texts), 256) for t in texts.slice(at, 256).to_pylist()]
        return pa.StructArray.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(SCHEMA)], fields=list(SCHEMA))

    return run(F.coalesce(F.encode(col.cast("string"), "UTF-8"), F.lit(b"")))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PCT * n_words)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exact up to rounding: terms are summed from their logarithms."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1, dtype=float)
    steps = np.concatenate(([0.0], np.cumsum(np.log((n - i[:-1]) / (i[:-1] + 1))))) if k else np.zeros(1)
    return float(min(1.0, np.exp(steps + i * math.log(p) + (n - i) * math.log1p(-p)).sum()))


def certified_cutoff(above: list[int], n: int, alpha: float, level: float) -> int:
    """The strictest cutoff bin of the fixed sequence; BINS (rejects nothing) if none is certified.

    ``above[c]``: good documents in bins over c.
    """
    cut = BINS
    for c in range(BINS - 1, -1, -1):
        # more than n alpha + 1 rejections are over any level below a half, whatever the tail
        if above[c] > n * alpha + 1 or binomial_cdf(above[c], n, alpha) > level:
            break
        cut = c
    return cut


def cutoffs(good_bins: dict[tuple[str, int], dict[int, int]], strata: list[str], alpha: float, delta: float, rules: int = len(RULES)) -> dict[str, list[int]]:
    """The cutoff bin of every stratum and of each of ``rules`` numbers from counts of good documents by bin; both levels are shared out."""
    level = delta / max(1, len(strata) * rules)
    out = {}
    for s in strata:
        cuts = []
        for r in range(rules):
            counts = good_bins.get((s, r), {})
            above = [sum(v for b, v in counts.items() if b > c) for c in range(BINS)]
            cuts.append(certified_cutoff(above, sum(counts.values()), alpha / rules, level))
        out[s] = cuts
    return out


def rule_weights(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Evidence of each rule's bins (rules x bins) from counts of good and bad documents."""
    tail = lambda c: np.cumsum(c[:, ::-1], axis=1)[:, ::-1]
    reached, above = tail(bad) / np.maximum(bad.sum(axis=1, keepdims=True), 1), (tail(good) + 1) / (good.sum(axis=1, keepdims=True) + 1)
    with np.errstate(divide="ignore"):
        evidence = np.maximum(np.log(reached / above), 0)
    return np.maximum.accumulate(evidence, axis=1)


@dataclass(frozen=True)
class Verdicts:
    """Evidence by rule and bin, and the cutoff score of each stratum."""

    weights: np.ndarray
    cuts: dict[str, int]

    def score(self, bins: Column) -> Column:
        """The score bin of a document with these rule bins."""
        top = float(self.weights.max(axis=1, initial=0).sum())
        if not top:
            return F.lit(0)
        total = sum((F.get(F.lit(w.tolist()), bins[r]) for r, w in enumerate(self.weights)), start=F.lit(0.0))
        return F.least(F.ceil(total * (BINS / top)).cast("int"), F.lit(BINS))

    def rejected(self, in_stratum: Column, bins: Column) -> Column:
        """The method's verdict: a score over the stratum's cutoff."""
        cuts = {s: c for s, c in self.cuts.items() if c < BINS}
        if not cuts:
            return F.lit(False)
        named = F.create_map(*[F.lit(x) for kv in cuts.items() for x in kv])
        return self.score(bins) > F.coalesce(F.try_element_at(named, in_stratum), F.lit(BINS))


def fit(measured: DataFrame, labels: DataFrame, *, alpha: float = 0.02, delta: float = 0.05) -> Verdicts:
    """Weights and cutoffs from a frame (doc_id, stratum, bins, base_failed) and labels (doc_id, quality).

    Documents that the base rule rejects take no part: the method doesn't decide them.
    """
    told = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    half = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2
    known = measured.where(~F.col("base_failed")).select("doc_id", "stratum", "bins").join(told, "doc_id").withColumn("holdout", half == 1)
    known = stored(known, "labelled")
    counts = np.zeros((2, len(RULES), BINS + 1))
    for r in known.where(~F.col("holdout")).select("good", F.posexplode("bins").alias("rule", "bin")).groupBy("good", "rule", "bin").count().collect():
        counts[int(r["good"] == 1), r["rule"], r["bin"]] += r["count"]
    weights = rule_weights(counts[1], counts[0])
    by: dict[tuple[str, int], dict[int, int]] = {}
    scored = known.where("holdout and good = 1").select("stratum", Verdicts(weights, {}).score(F.col("bins")).alias("score"))
    for r in scored.groupBy("stratum", "score").count().collect():
        by.setdefault((r["stratum"], 0), {})[r["score"]] = r["count"]
    found = cutoffs(by, sorted({s for s, _ in by}), alpha, delta, rules=1)
    return Verdicts(weights, {s: c for s, (c,) in found.items()})


def stratum(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def quality_rules(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """doc_id, stratum, counts, bins, base_failed and kept of every document."""
    found = docs.select(F.col(id_col).alias("doc_id"), stratum(stratum_col).alias("stratum"), measures(F.col(text_col)).alias("m")).select("doc_id", "stratum", "m.*")
    found = stored(found.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))), "quality")
    verdicts = fit(found, labels, alpha=alpha, delta=delta)
    return found.withColumn("kept", ~F.col("base_failed") & ~verdicts.rejected(F.col("stratum"), F.col("bins")))


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``docs`` without the rejected rows, all columns as they were.

    One pass measures all documents for the cutoffs and writes a narrow table, which is joined to the labels;
    a second pass measures again and filters, so that no text is shuffled or written for it.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), stratum(stratum_col).alias("stratum"), measures(F.col(text_col)).alias("m"))
    found = found.select("doc_id", "stratum", "m.bins", base_failed(F.col("m.n_words"), F.col("m.n_repeat_words")).alias("base_failed"))
    verdicts = fit(stored(found, "quality"), labels, alpha=alpha, delta=delta)
    m = "_quality"
    while m in docs.columns:
        m = "_" + m
    whole = docs.withColumn(m, measures(F.col(text_col)))
    good = ~base_failed(F.col(m).n_words, F.col(m).n_repeat_words) & ~verdicts.rejected(stratum(stratum_col), F.col(m).bins)
    return whole.where(good).select(*docs.columns)
