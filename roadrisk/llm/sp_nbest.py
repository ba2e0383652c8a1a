"""SentencePiece encoding with the n best segmentations, and decoding.

A text is normalised by the model's own rules (blanks become U+2581, one is put in front). All pieces
that match are the edges of a lattice, with the model's scores; a character that no piece
has is an edge of its byte pieces, scored ``penalty`` below the lowest ordinary score. A forward
Viterbi pass gives the best score from the start to each place. The search goes backward from the end
and always extends the path whose score so far plus the Viterbi score of its place is largest; since
that is exact, complete paths come out best first.

No piece crosses a place whose two characters are next to each other in no piece, so the lattice
falls apart there. Parts are searched on their own and their lists are put together: a segmentation of
the whole among the n best departs from the best one only in the n - 1 parts whose second best costs
least, and sums of ranked lists are taken best first. The result is that of the whole lattice. Parts
repeat, so each task keeps a bounded table of words.

Decoding joins the pieces' bytes and drops the blank in front. It gives back every text as UTF-8,
but for U+2581 itself, which the model reads as a blank, and what its normalisation changes.

The scores are the model's own. In a merge model they are minus the rank of the merge, so the segmentation
of the best sum is *not* what the model's own encoder gives by merging; README has figures. Both decode to
the same text.

Equal scores are ordered by the search: longer last pieces first, then earlier parts. Defined
results: a null or empty text has no pieces, the score 0 and one segmentation, and decodes to the
empty text; repeated rows each get a row; extra columns are left out; empty tables work.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain
from operator import add

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, small_batches

BLANK = "▁"
#: A word ends before a blank, and between a Latin letter or digit and an ASCII mark.
_LATIN = "0-9A-Za-z\u00C0-\u024F"
_BESIDE = f"[^{_LATIN}{BLANK}]*[{_LATIN}]*"
_WORD = re.compile(f"(?=[\\s\\S]){BLANK}*{_BESIDE}(?:[^\\x00-\\x7F{_LATIN}{BLANK}]{_BESIDE})*")
_ACROSS = re.compile(f"[^{BLANK}]{BLANK}|[{_LATIN}](?![{_LATIN}])[\\x00-\\x7F]", re.S)
Path = tuple[float, tuple[int, ...]]
#: Score and ids of the best segmentation, and what the second best loses.
Known = tuple[float, tuple[int, ...], float]


class Numbers(dict):
    """Numbers pieces in order of first sight and remembers the new ones.

    The first ones, which are mostly the frequent ones, are in this small table itself, which stays in
    the processor's cache; ``every`` has all.
    """

    def __init__(self, first: int = 16_384) -> None:
        self.first = first
        self.every: dict[bytes, int] = {}
        self.new: list[bytes] = []

    def __missing__(self, piece: bytes) -> int:
        n = self.every.get(piece)
        if n is None:
            n = self.every[piece] = len(self.every)
            self.new.append(piece)
            if n < self.first:
                self[piece] = n
        return n


class Pieces:
    """The model's pieces with their scores, and where a text can be cut."""

    def __init__(self, model_path: str, penalty: float = 10.0):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = self.sp.vocab_size()
        self.automaton = ahocorasick.Automaton()
        self.pairs: set[str] = set()
        self.single: set[str] = set()
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_ids = [0] * 256
        self.lengths, self.scores = np.zeros(n, np.int64), np.zeros(n)
        low = 0.0
        for i in range(n):
            piece = self.sp.id_to_piece(i)
            if self.sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_unused(i)):
                score = self.scores[i] = self.sp.get_score(i)
                self.lengths[i] = len(piece)
                self.automaton.add_word(piece, i)
                if len(piece) == 1:
                    self.single.add(piece)
                self.pairs.update(map("".join, itertools.pairwise(piece)))
                self.bytes_of[i] = piece.replace(BLANK, " ").encode()
                if score > -1e8:
                    low = min(low, score)
        self.automaton.make_automaton()
        self.unknown = low - penalty
        used = self.single.union(*self.pairs)
        #: A character of no piece, between texts that are searched as one.
        self.apart = next(c for c in map(chr, range(0xE000, 0x110000)) if c not in used)
        self.longest = int(self.lengths.max())
        self._edge = [(int(k), float(s), (i,)) for i, (k, s) in enumerate(zip(self.lengths, self.scores, strict=True))]
        #: No piece crosses an end of a word.
        self.by_words = not any(map(_ACROSS.match, self.pairs))

    def words(self, text: str) -> list[str]:
        normal = self.sp.normalize(text) if text else ""
        return _WORD.findall(normal) if self.by_words else [normal] * bool(normal)

    def parts(self, word: str) -> list[str]:
        """``word`` cut where no piece crosses."""
        if self.pairs.issuperset(map(add, word, word[1:])):
            return [word]
        out, start = [], 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in self.pairs:
                out.append(word[start:i])
                start = i
        out.append(word[start:])
        return out

    def edges(self, text: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """By end place: (start, score, ids) of the edges that end there, the longest first."""
        into: list[list] = [[] for _ in range(len(text) + 1)]
        for last, piece in self.automaton.iter(text):
            length, score, ids = self._edge[piece]
            into[last + 1].append((last + 1 - length, score, ids))
        for j, found in enumerate(into):
            if j and (not found or found[-1][0] != j - 1):
                found.append((j - 1, self.unknown, tuple(self.byte_ids[b] for b in text[j - 1].encode("utf-8", "replace"))))
        return into

    def paths(self, text: str) -> Iterator[Path]:
        """(score, ids) of all segmentations, best first."""
        into = self.edges(text)
        best = [0.0]
        for found in into[1:]:
            best.append(max([best[i] + s for i, s, _ in found]))
        turn, heap = 0, [(-best[-1], 0, len(text), 0.0, None)]
        while heap:
            _, _, j, after, rest = heappop(heap)
            if j == 0:
                ids: list[int] = []
                while rest is not None:
                    ids.extend(rest[0])
                    rest = rest[1]
                yield after, tuple(ids)
                continue
            for i, s, ids in reversed(into[j]):
                s += after
                turn -= 1
                heappush(heap, (-best[i] - s, turn, i, s, (ids, rest)))

    def first_two(self, text: str) -> Known:
        """(score, ids) of the best segmentation and what the second best loses (infinite without one)."""
        two = list(itertools.islice(self.paths(text), 2))
        return (*two[0], two[0][0] - two[1][0] if len(two) > 1 else np.inf)

    def first_twos(self, texts: list[str]) -> list[Known]:
        """``first_two`` of many texts at once.

        The second best leaves the best path by some edge; the best path through an edge is the sum of the
        Viterbi scores before and after it and its own. Texts of one length share arrays by (end, length of
        the piece, text), and both passes go through them place by place, for all these texts together. Texts with
        bytes in them, and the few of a rare length, are searched on their own.
        """
        known: dict[str, Known] = {}
        for size, some in itertools.groupby(sorted(filter(self.single.issuperset, texts), key=len), len):
            alike = list(some)
            step = max(1, 150_000 // (size * min(size, self.longest) + 1))
            for at in range(0, len(alike) if size and len(alike) >= 8 else 0, step):
                known.update(zip(alike[at : at + step], self._lattices(alike[at : at + step], size), strict=True))
        return [known[t] if t in known else self.first_two(t) for t in texts]

    def _lattices(self, texts: list[str], n: int) -> list[Known]:
        """``first_two`` of texts of ``n`` characters that are all pieces."""
        width, many = min(n, self.longest), len(texts)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(self.apart.join(texts))), np.int64).reshape(-1, 2)
        text, end = np.divmod(found[:, 0], n + 1)
        piece = found[:, 1]
        score, ids = np.full((n, width, many), -np.inf), np.zeros((n, width, many), np.int32)
        place = (end * width + self.lengths[piece] - 1) * many + text  # an edge by its last character, its length and its text
        score.reshape(-1)[place], ids.reshape(-1)[place] = self.scores[piece], piece
        before, after = np.zeros((n + 1, many)), np.full((n + 1, many), -np.inf)
        after[n] = 0.0
        taken = np.empty((n + 1, many), np.int64)
        for j in range(1, n + 1):
            k = min(j, width)
            s = score[j - 1, k - 1 :: -1] + before[j - k : j]  # the longest first
            taken[j] = k - s.argmax(axis=0)
            before[j] = s.max(axis=0)
        for j in range(n, 0, -1):
            k = min(j, width)
            score[j - 1, :k] += after[j]
            np.maximum(after[j - k : j], score[j - 1, k - 1 :: -1], out=after[j - k : j])
            score[j - 1, k - 1 :: -1] += before[j - k : j]
        # score is now that of the best path through each edge
        every = np.arange(many)
        at, who, steps = np.full(many, n), every, []
        while len(who):
            size = taken[at, who]
            steps.append((who, ids[at - 1, size - 1, who]))
            score[at - 1, size - 1, who] = -np.inf
            at = at - size
            who, at = who[at > 0], at[at > 0]
        best = before[n]
        loss = best - score.max(axis=(0, 1))
        who, chosen = (np.concatenate(x[::-1]) for x in zip(*steps, strict=True))
        order = np.argsort(who, kind="stable")  # of each text, its pieces from first to last
        chosen, ends = chosen[order].tolist(), np.cumsum(np.bincount(who, minlength=many)).tolist()
        return [(b, tuple(chosen[i:j]), x) for b, x, i, j in zip(best.tolist(), loss.tolist(), [0, *ends], ends)]

    def word_paths(self, word: str, n: int) -> list[Path]:
        """The ``n`` best segmentations of a word."""
        lists = [list(itertools.islice(self.paths(p), n)) for p in self.parts(word)]
        return [(sum(x[k][0] for x, k in zip(lists, ranks, strict=True)), tuple(i for x, k in zip(lists, ranks, strict=True) for i in x[k][1])) for ranks in best_sums([[p[0] for p in x] for x in lists], n)]

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return data.removeprefix(b" ").decode("utf-8", "replace")


def best_sums(lists: list[list[float]], n: int) -> list[tuple[int, ...]]:
    """The ``n`` best choices of one number of each list (each falling), best sum first.

    Only the n - 1 lists that lose least by their second number can take part in a choice but the best.
    """
    losses = sorted((x[0] - x[1], k) for k, x in enumerate(lists) if len(x) > 1)[: n - 1]
    free = [k for _, k in losses]
    out, heap = [], [(0.0, (0,) * len(free), 0)]
    while heap and len(out) < n:
        loss, ranks, first = heappop(heap)
        choice = [0] * len(lists)
        for k, r in zip(free, ranks, strict=True):
            choice[k] = r
        out.append(tuple(choice))
        for at in range(first, len(free)):  # raise one rank at or after the last raised: each choice comes once
            x, r = lists[free[at]], ranks[at] + 1
            if r < len(x):
                heappush(heap, (loss + x[r - 1] - x[r], ranks[:at] + (r,) + ranks[at + 1 :], at))
    return out


class Encoder:
    """Segmentations of whole texts; keeps a bounded table of words with their best ids and first loss."""

    def __init__(self, model_path: str, limit: int = 400_000):
        self.pieces, self.limit = Pieces(model_path), limit
        self.parts: dict[str, Known] = {}
        self.older = self.parts
        self.ranked: dict[str, list[Path]] = {}
        self._clear()

    def _clear(self) -> None:
        self.number = Numbers()
        self.names: list[str] = []
        self.flat, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)
        self.scores, self.losses = np.empty(0), np.empty(0)

    def learn(self, words: list[str]) -> None:
        """Takes in words that have numbers already, in the order of these."""
        cut = [self.pieces.parts(w) for w in words]
        table, older = self.parts, self.older
        new = set(chain.from_iterable(cut)).difference(table)
        held = new.intersection(older)
        table.update((p, older[p]) for p in held)
        fresh = sorted(new.difference(held))
        table.update(zip(fresh, self.pieces.first_twos(fresh), strict=True))
        ids, lengths, scores, losses = [], [], [], []
        for parts in cut:
            if len(parts) == 1:
                score, found, loss = table[parts[0]]
                ids.extend(found)
                lengths.append(len(found))
            else:
                n, score, loss = 0, 0.0, np.inf
                for p in parts:
                    known = table[p]
                    score += known[0]
                    ids.extend(known[1])
                    n += len(known[1])
                    loss = min(loss, known[2])
                lengths.append(n)
            scores.append(score)
            losses.append(loss)
        self.names += words
        self.flat = np.concatenate((self.flat, np.array(ids, np.uint32)))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(lengths)))
        self.scores, self.losses = np.concatenate((self.scores, scores)), np.concatenate((self.losses, losses))

    def encode(self, texts: list[str], n: int) -> list[list[tuple[float, np.ndarray]]]:
        """For each text, the (score, ids) of its ``n`` best segmentations (fewer if there are no more)."""
        if len(self.names) > self.limit:
            self._clear()
        if len(self.parts) > self.limit // 2:  # of parts, the last two generations are kept
            self.older, self.parts = self.parts, {}
        if len(self.ranked) > self.limit // 10:
            self.ranked.clear()
        coded = []
        for t in texts:
            words = self.pieces.words(t)
            coded.append(np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)))
        if self.number.new:
            self.learn(self.number.new)
            self.number.new = []
        return [self._best(k, n) for k in coded]

    def _best(self, k: np.ndarray, n: int) -> list[tuple[float, np.ndarray]]:
        if not len(k):
            return [(0.0, np.empty(0, np.uint32))]
        lengths = self.starts[k + 1] - self.starts[k]
        ends = np.cumsum(lengths)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.starts[k] - (ends - lengths), lengths)]
        score = float(self.scores[k].sum())
        if n == 1:
            return [(score, ids)]
        losses = self.losses[k]
        least = np.argsort(losses, kind="stable")[: n - 1] if len(k) <= 64 else _smallest(losses, n - 1)
        at = [int(i) for i in least if losses[i] < np.inf]
        lists = []
        for i in at:
            word = self.names[k[i]]
            x = self.ranked.get(word)
            if x is None or len(x) < n:
                x = self.ranked[word] = self.pieces.word_paths(word, n)
            lists.append(x[:n])
        out = []
        for ranks in best_sums([[p[0] for p in x] for x in lists], n):
            cuts = sorted((at[j], x[r], x[0]) for j, (x, r) in enumerate(zip(lists, ranks, strict=True)))
            parts, last = [], 0
            for i, path, _ in cuts:
                parts += [ids[last : ends[i] - lengths[i]], np.array(path[1], np.uint32)]
                last = ends[i]
            out.append((score - sum(first[0] - path[0] for _, path, first in cuts), np.concatenate([*parts, ids[last:]]) if cuts else ids))
        return out


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` smallest values, equal ones in order of place."""
    bound = np.partition(values, n - 1)[n - 1]
    at = np.flatnonzero(values <= bound)
    return at[np.argsort(values[at], kind="stable")][:n]


_HELD: dict[str, Encoder] = {}


def encoder(model_path: str) -> Encoder:
    """One encoder for each Python worker and model."""
    if model_path not in _HELD:
        _HELD[model_path] = Encoder(model_path)
    return _HELD[model_path]


SCHEMA = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("scores", pa.list_(pa.float64())), ("ids_crc32", pa.list_(pa.int64())), ("decoded", pa.bool_())])


def segment(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", n: int = 4) -> DataFrame:
    """doc_id, ids (the best), scores and ids_crc32 of the n best, and whether the best decodes to the text."""

    def task(batches):
        e = encoder(model_path)
        for b in small_batches(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            found = e.encode(texts, n)
            decoded = [e.pieces.decode(f[0][1]) == t.replace(BLANK, " ") for t, f in zip(texts, found, strict=True)]
            crcs = [[zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in f] for f in found]
            yield batch(SCHEMA, [b.column(0), [f[0][1].astype(np.int32) for f in found], [[s for s, _ in f] for f in found], crcs, decoded])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, ids array<int>, scores array<double>, ids_crc32 array<long>, decoded boolean")


def digest(found: DataFrame) -> DataFrame:
    """The result columns of the query."""
    return found.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.col("scores")[0].alias("best_score"), "scores", "ids_crc32", "decoded")
