"""Benchmark decontamination: one Aho-Corasick automaton over normalised items, one scan per text.

Normalising lower-cases A-Z and keeps words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by one
blank. A window is ``width`` consecutive words of an item (a shorter item is one window). Every
window is one pattern of the automaton, with a blank at both ends, so matches are whole words.
Word number k of the normalised text is match number k of the word pattern in the original, which
maps each hit back to code-point offsets.

The automaton goes to the tasks by broadcast. Its size is measured first: items are dealt into
blocks of at most ``block_chars`` normalised characters, each block is one automaton and one pass
over the documents, and the hits of all blocks are united. A benchmark below the bound is one pass.

Defined results: a null or empty text has no words, so no hits; a null item has no windows;
repeated item rows count once by their id; repeated documents each get a row; extra columns of the
input are left out. Empty tables give empty results, and an empty benchmark gives no hits.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, small_batches, stored, text_bytes

#: The same words in a text that is not yet lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Byte table: A-Z to a-z, other word bytes as they are, all else to a blank.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("hit_words", pa.list_(pa.int32())), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.string()))])
DDL = "doc_id long, n_words long, hit_words array<int>, items array<string>, spans array<string>"


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def windows(words: list[bytes], width: int) -> list[bytes]:
    n = min(width, len(words))
    return [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if n else []


def automaton(items: list[tuple[str, bytes]], width: int) -> ahocorasick.Automaton:
    """Patterns are byte-wise (latin-1) strings; a pattern's value is (word count, item ids)."""
    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for w in windows(normal_words(text), width):
            owners.setdefault(w, set()).add(item)
    a = ahocorasick.Automaton()
    for w, ids in owners.items():
        a.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, tuple(sorted(ids))))
    if owners:
        a.make_automaton()
    return a


def scan(text: bytes, a: ahocorasick.Automaton) -> tuple[int, np.ndarray, list[str]]:
    """Number of words, the indexes of hit words, the ids of the items found."""
    words = normal_words(text)
    if not words or a.kind != ahocorasick.AHOCORASICK:
        return len(words), np.empty(0, np.int32), []
    line = b" " + b" ".join(words) + b" "
    ends, items, hit = None, set(), None
    for end, (n, ids) in a.iter(line.decode("latin-1")):
        if ends is None:
            ends = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
            hit = np.zeros(len(words), bool)
        k = int(np.searchsorted(ends, end))
        hit[k - n : k] = True
        items.update(ids)
    return len(words), np.flatnonzero(hit).astype(np.int32) if items else np.empty(0, np.int32), sorted(items)


def original_spans(text: bytes, hit: np.ndarray) -> list[str]:
    """Runs of hit words as ``start:end`` code-point offsets of the original, end exclusive."""
    if not len(hit):
        return []
    at = [m.span() for m in WORD.finditer(text.decode("utf-8"))]
    cuts = np.flatnonzero(np.diff(hit) > 1) + 1
    return [f"{at[run[0]][0]}:{at[run[-1]][1]}" for run in np.split(hit, cuts)]


def item_blocks(items: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of at most ``block_chars`` characters (a longer item is a block of its own)."""
    block, size = [], 0
    rows = items.select(F.col(item_col).cast("string").alias("i"), text_bytes(text_col).alias("t")).distinct()
    for r in rows.toLocalIterator():
        text = bytes(r["t"])
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((r["i"] if r["i"] is not None else "", text))
        size += len(text)
    yield block


def find_items(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10, block_chars: int = 150_000) -> DataFrame:
    """doc_id, n_words, hit_words (indexes), items (ids), spans (original offsets) of every document.

    The blocks' passes are united; only a benchmark of several blocks needs the ``groupBy``.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    parts = []
    for block in item_blocks(items, item_col, item_text_col, block_chars):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def task(batches, held=held):
            a = automaton(held.value, width)
            for b in small_batches(batches, 512):
                texts = b.column(1).to_pylist()
                found = [scan(t, a) for t in texts]
                yield batch(SCHEMA, [b.column(0), [f[0] for f in found], [f[1] for f in found], [f[2] for f in found], [original_spans(t, f[1]) for t, f in zip(texts, found, strict=True)]])

        parts.append(task)
    if len(parts) == 1:
        return base.mapInArrow(parts[0], DDL)
    return _united(base, parts)


def _united(base: DataFrame, parts: list) -> DataFrame:
    """Several automata: each pass runs over a stored numbering of the rows, then hits are united."""
    keyed = stored(base.withColumn("row", F.monotonically_increasing_id()), "decontam")
    numbers = keyed.select(F.col("row").alias("doc_id"), "text")
    every = None
    for task in parts:
        part = numbers.mapInArrow(task, DDL)
        every = part if every is None else every.unionByName(part)
    best = every.groupBy(F.col("doc_id").alias("row")).agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def spans(batches):
        for b in small_batches(batches, 512):
            hits, texts = b.column(2).to_pylist(), b.column(4).to_pylist()
            yield batch(SCHEMA, [b.column(0), b.column(1), b.column(2), b.column(3), [original_spans(t, np.asarray(h, np.int32)) for t, h in zip(texts, hits, strict=True)]])

    joined = keyed.join(best, "row").select("doc_id", "n_words", "hit_words", "items", "text")
    return joined.mapInArrow(spans, DDL)


_AUTOMATA: dict[str, object] = {}


def _held_automaton(name: str, held, width: int):
    """The automaton of a broadcast, built once for each Python worker; the last few are kept."""
    if name not in _AUTOMATA:
        while len(_AUTOMATA) >= 4:
            del _AUTOMATA[next(iter(_AUTOMATA))]
        _AUTOMATA[name] = automaton(held.value, width)
    return _AUTOMATA[name]


def _has_window(held, width: int):
    """Whether texts have a window of the items in the broadcast ``held``."""
    name = uuid.uuid4().hex

    @F.arrow_udf("boolean")
    def run(texts: pa.Array) -> pa.Array:
        a = _held_automaton(name, held, width)
        return pa.array([bool(scan(t, a)[2]) for at in range(0, len(texts), 512) for t in texts.slice(at, 512).to_pylist()], pa.bool_())

    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10, block_chars: int = 150_000) -> DataFrame:
    """``docs`` without the rows that have a window of an item, all columns as they were."""
    for block in item_blocks(items, item_col, item_text_col, block_chars):
        docs = docs.where(~_has_window(docs.sparkSession.sparkContext.broadcast(block), width)(text_bytes(text_col)))
    return docs


def digest(found: DataFrame) -> DataFrame:
    """The result columns of the query: counts, a digest of the item ids, the verdict, the spans."""
    return found.select(
        "doc_id", "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
        F.array_join("spans", ",").alias("spans"),
    )


def items_sha256(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
