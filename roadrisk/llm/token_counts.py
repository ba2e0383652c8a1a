"""Token counts by the whole-token shortcut, for byte-level BPE vocabularies.

A byte-level BPE tokenizer cuts a text into pre-tokens and merges the bytes of each one alone. Most
pre-tokens of running text are vocabulary strings themselves; such a string counts as one token, if
its merges do end in that single token, which is proved for each vocabulary string before the job
starts (``whole_tokens``): not every entry can be reached by merges, so the entry alone is no proof.
A job then counts pre-tokens that are proved with one table look-up and merges only the rest, each
distinct one once for as long as the worker's bounded table holds it.

The proof is one bit for each vocabulary id; it is made on the driver and sent to the tasks, so its
size is bounded by the vocabulary. Texts are cut into stretches where a blank follows a character
that is not white space: a pre-token ends there in any case and nothing behind the cut looks back, so
memory for a very long text is that of one stretch (a text without such a blank is one stretch).
Character classes are those of the tokenizer: a worker asks the tokenizer once for the class of every
character that is not ASCII and that it has not met (one call for a batch); a text with a character
that its pattern would class otherwise goes to the tokenizer whole.

Strings of added special tokens inside a text are one token each, as the library takes them by default.
The vocabulary file must be a byte-level BPE without normaliser, prefix blank, dropout, or special
tokens that strip or match whole words; anything else raises an error before the job starts.

Defined results: null and empty texts have 0 bytes and 0 tokens; null and repeated doc_ids keep a row
each; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import batch, small_batches, text_bytes

#: The pre-token pattern of byte-level BPE vocabularies of this kind (fixed value of the format).
#: White space is Unicode's property: the ``\s`` of Python's modules also takes four control characters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
STRETCH = 1 << 16


def byte_letters() -> dict[int, str]:
    """The printable stand-in that byte-level vocabularies write for each byte value.

    Bytes that print as themselves in Latin-1 stay; the others take the code points from 256 on, in order.
    """
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    others = iter(range(256, 512))
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


_LETTERS = byte_letters()
_BYTES = {c: b for b, c in _LETTERS.items()}
_AS_LETTERS = str.maketrans({chr(b): c for b, c in _LETTERS.items()})


def checked(tokenizer_path: str) -> tuple[Tokenizer, list[str]]:
    """The tokenizer and the strings of its special tokens; an error for a file of another kind."""
    tok = Tokenizer.from_file(tokenizer_path)
    spec = json.loads(tok.to_str())
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or spec["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        raise ValueError(f"{tokenizer_path}: not a byte-level BPE without normaliser and prefix blank")
    added = spec["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError(f"{tokenizer_path}: special tokens that strip or match whole words")
    return tok, [t["content"] for t in added]


def letters_of(piece: str) -> str:
    """A pre-token as the vocabulary writes it."""
    return piece.encode("utf-8").decode("latin-1").translate(_AS_LETTERS)


def whole_tokens(tokenizer_path: str) -> np.ndarray:
    """For every id whether its string, merged alone, ends in the single token with that id (the proof)."""
    tok, _ = checked(tokenizer_path)
    merged = tok.model.tokenize
    vocabulary = tok.get_vocab(with_added_tokens=False)
    proved = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
    for string, i in vocabulary.items():
        found = merged(string)
        proved[i] = len(found) == 1 and found[0].id == i
    return proved


class _Counts(dict):
    """Tokens of a pre-token: proved strings from the start, others merged when first met; bounded."""

    def __init__(self, tok: Tokenizer, proved: np.ndarray, limit: int = 400_000) -> None:
        self.merged, self.limit = tok.model.tokenize, limit
        self.learnt: dict[str, int] = {}
        for string, i in tok.get_vocab(with_added_tokens=False).items():
            if proved[i]:
                try:
                    self[bytes(map(_BYTES.__getitem__, string)).decode("utf-8")] = 1
                except UnicodeDecodeError:
                    pass  # a part of a character is never a whole pre-token

    def __missing__(self, piece: str) -> int:
        n = self.learnt.get(piece)
        if n is None:
            n = len(self.merged(letters_of(piece)))
            if len(piece) <= 64:  # rare long pieces would fill the table's memory
                if len(self.learnt) >= self.limit:
                    self.learnt.clear()
                self.learnt[piece] = n
        return n


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """Consecutive parts of ``text`` that are cut before a blank behind a character that is not white space."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


class Counter:
    """Counts tokens of texts with one table for each Python worker."""

    def __init__(self, tokenizer_path: str, proved: np.ndarray) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok, specials = checked(tokenizer_path)
        self.table = _Counts(self.tok, proved)
        self.pieces = regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.met = set(map(chr, range(128)))
        self.other: set[str] = set()  # characters that the tokenizer classes otherwise than the pattern

    def look_at(self, chars: set[str]) -> None:
        """Asks the tokenizer for the classes of characters not met before.

        Between a letter, a digit, a mark and a blank a character joins exactly the neighbour of its own
        class, so cuts that agree around it in all of them show that it has the same class on both sides.
        """
        cut = self.tok.pre_tokenizer.pre_tokenize_str
        for c in chars - self.met:
            probe = f"a{c}a1{c}1#{c}# {c} a"
            ends = [end for _, (_, end) in cut(probe)]
            if ends != [m.end() for m in regex.finditer(PATTERN, probe)]:
                self.other.add(c)
        self.met |= chars

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        count, pieces = self.table.__getitem__, self.pieces
        return sum(sum(map(count, pieces(part))) for part in stretches(text))

    def __call__(self, texts: list[str]) -> list[int]:
        odd: list[set[str]] = [set() if t.isascii() else set(t) for t in texts]
        fresh = set().union(*odd) - self.met if odd else set()
        if fresh:
            self.look_at(fresh)
        out = []
        for text, chars in zip(texts, odd, strict=True):
            if self.other and not self.other.isdisjoint(chars):
                out.append(len(self.tok.encode(text, add_special_tokens=False).ids))
            elif self.special is not None and "<" in text:
                parts = self.special.split(text)
                out.append(len(parts) - 1 + sum(map(self.plain, parts)))
            else:
                out.append(self.plain(text))
        return out


_HELD: dict[str, Counter] = {}


def held_counter(tokenizer_path: str, proved: np.ndarray) -> Counter:
    """One counter for each Python worker, which keeps its table from task to task."""
    if tokenizer_path not in _HELD:
        _HELD[tokenizer_path] = Counter(tokenizer_path, proved)
    return _HELD[tokenizer_path]


OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def count_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row."""
    proof = docs.sparkSession.sparkContext.broadcast(np.packbits(whole_tokens(tokenizer_path)).tobytes())

    def task(batches):
        counter: Callable[[list[str]], list[int]] | None = None
        for b in small_batches(batches):
            counter = counter or held_counter(tokenizer_path, np.unpackbits(np.frombuffer(proof.value, np.uint8)).astype(bool))
            texts = b.column(1).to_pylist()
            n = np.asarray(counter([t.decode("utf-8") for t in texts]), np.int64)
            yield batch(OUT, [b.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.array(n), pa.array(n > limit)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return rows.mapInArrow(task, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
