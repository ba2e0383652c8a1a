"""Token ids in Simple-8b words, written to shard files and read back.

A 64-bit word holds a selector in its upper 4 bits and, below, as many ids of one bit width as fit:

    selector   1  2  3  4  5  6  7  8  9 10 11 12 13 14
    ids       60 30 20 15 12 10  8  7  6  5  4  3  2  1
    bits       1  2  3  4  5  6  7  8 10 12 15 20 30 60

Selector 0 is an escape: the rest is an index into the block's exceptions, raw 64-bit values that
do not fit 60 bits. Ids are coded in blocks of at most ``BLOCK`` ids; the last word of a block may
hold fewer ids than its selector says, which the block's count tells.

A shard file (little-endian) is: magic, per block its words and its exceptions; then the footer with
per-block offset, id count, word count and per-document id and token count; then the footer's place.
Shards hold ascending ranges of doc_id. Every task writes a new file name and reports it, so a
repeated attempt leaves an unnamed file behind and nothing is read twice.

Encoding uses the tokenizers library. The tokenizer drops white space and neither merges nor
normalises across blanks and line ends, so texts are cut there and each distinct piece is encoded
once per task (a bounded table); the ids of a text are those of its pieces in order. ``spaced=False``
turns that off for tokenizers that keep white space.

Defined results: null and empty texts have the end id alone; a null doc_id sorts first; rows that
repeat a doc_id follow each other in text order and each count; extra columns are left out; an empty
table gives no file and no rows.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import batch, filesystem, small_batches, stored, text_bytes, work_path

MAGIC = b"IDS8B001"
BLOCK = 8192
#: ids per word and bits per id by selector (fixed values of the format); selector 0 is the escape
COUNTS = (1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
_SHIFT = np.uint64(60)


def _runs(good: np.ndarray, n: int) -> np.ndarray:
    """Where ``n`` values in a row are true, by doubling."""
    held = 1
    while held < n:
        more = min(held, n - held)
        good = good[: len(good) - more] & good[more:]
        held += more
    return good


def encode_block(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and exceptions of up to ``BLOCK`` unsigned 64-bit ids: each word takes as many as fit."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    raw = ids >> _SHIFT != 0
    exceptions = ids[raw]
    # width[i]: the first selector (of most ids) whose bits hold id i; a word takes the first selector
    # s for which the next COUNTS[s] ids all hold
    narrow = ids.astype(np.uint32) if n and ids.max() < 1 << 32 else ids
    width = np.ones(n + 60, np.uint8)
    width[n:] = 0
    for s in range(1, len(COUNTS) - 1):
        if s < 13 or narrow is ids:
            width[:n] += narrow >= narrow.dtype.type(1 << BITS[s])
    best = np.full(n, len(COUNTS) - 1, np.int8)
    for s in range(len(COUNTS) - 2, 0, -1):
        best[_runs(width <= s, COUNTS[s])[:n]] = s
    best[raw] = 0
    fits = np.concatenate((ids, np.zeros(60, np.uint64)))
    step = np.asarray(COUNTS, np.uint8)[best].tobytes()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    starts = np.asarray(starts, np.int64)
    chosen = best[starts]
    words = chosen.astype(np.uint64) << _SHIFT
    for s in np.unique(chosen):
        at = np.flatnonzero(chosen == s)
        if s == 0:
            words[at] |= (np.cumsum(raw) - 1)[starts[at]].astype(np.uint64)
        else:
            part = fits[starts[at, None] + np.arange(COUNTS[s])]
            words[at] |= np.bitwise_or.reduce(part << (np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(BITS[s])), axis=1)
    return words, exceptions


def decode_block(words: np.ndarray, exceptions: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block, all words of a selector at once."""
    selector = (words >> _SHIFT).astype(np.int64)
    counts = np.asarray(COUNTS)[selector]
    starts = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint64)
    for s in np.unique(selector):
        at = np.flatnonzero(selector == s)
        if s == 0:
            out[starts[at]] = exceptions[(words[at] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        else:
            shifts = np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(BITS[s])
            out[starts[at, None] + np.arange(COUNTS[s])] = (words[at, None] >> shifts) & np.uint64((1 << BITS[s]) - 1)
    return out[:n]


class ShardWriter:
    """Streams documents' ids to one shard file; memory holds a few blocks and the footer."""

    def __init__(self, path: str):
        fs, at = filesystem(path)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(at)
        self.out.write(MAGIC)
        self.place = len(MAGIC)
        self.blocks: list[tuple[int, int, int]] = []
        self.doc_ids: list[int] = []
        self.null_ids: list[bool] = []
        self.lengths: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id or 0)
        self.null_ids.append(doc_id is None)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= 16 * BLOCK:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        end = len(ids) if all_of_it else len(ids) // BLOCK * BLOCK
        for at in range(0, end, BLOCK):
            part = ids[at : min(at + BLOCK, end)]
            words, exceptions = encode_block(part)
            data = words.astype("<u8").tobytes() + exceptions.astype("<u8").tobytes()
            self.out.write(data)
            self.blocks.append((self.place, len(part), len(words)))
            self.place += len(data)
        self.waiting, self.n_waiting = [ids[end:]], len(ids) - end

    def close(self) -> tuple[int, int]:
        """Ends the file; number of documents and of ids."""
        self._flush(True)
        footer = struct.pack("<QQ", len(self.blocks), len(self.doc_ids))
        footer += np.asarray(self.blocks, "<u8").tobytes() + np.asarray(self.doc_ids, "<i8").tobytes()
        footer += np.asarray(self.null_ids, "u1").tobytes() + np.asarray(self.lengths, "<u8").tobytes()
        self.out.write(footer + struct.pack("<Q", self.place) + MAGIC)
        self.out.close()
        return len(self.doc_ids), sum(self.lengths)


class ShardReader:
    """Random access by block offsets; ``documents`` streams (doc_id, start in shard, ids)."""

    def __init__(self, path: str):
        fs, at = filesystem(path)
        self.file = fs.open_input_file(at)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path}: not a complete shard")
        (self.end,) = struct.unpack("<Q", tail[:8])
        footer = self.file.read_at(size - 16 - self.end, self.end)
        n_blocks, n_docs = struct.unpack_from("<QQ", footer)
        at = 16
        self.blocks = np.frombuffer(footer, "<u8", 3 * n_blocks, at).reshape(-1, 3).astype(np.int64)
        at += 24 * n_blocks
        self.doc_ids = np.frombuffer(footer, "<i8", n_docs, at)
        at += 8 * n_docs
        self.null_ids = np.frombuffer(footer, "u1", n_docs, at).astype(bool)
        self.lengths = np.frombuffer(footer, "<u8", n_docs, at + n_docs).astype(np.int64)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of the blocks ``first`` to ``last`` (exclusive) in one range read."""
        start = int(self.blocks[first, 0])
        stop = int(self.blocks[last, 0]) if last < len(self.blocks) else self.end
        data = np.frombuffer(self.file.read_at(stop - start, start), "<u8")
        out = []
        for k in range(first, last):
            at = (int(self.blocks[k, 0]) - start) // 8
            end = (int(self.blocks[k + 1, 0]) if k + 1 < len(self.blocks) else self.end) - start
            words = int(self.blocks[k, 2])
            out.append(decode_block(data[at : at + words], data[at + words : end // 8], int(self.blocks[k, 1])))
        return np.concatenate(out)

    def documents(self, at_once: int = 64) -> Iterator[tuple[int | None, int, np.ndarray]]:
        held, base, block, start = np.empty(0, np.uint64), 0, 0, 0
        for doc_id, null, n in zip(self.doc_ids.tolist(), self.null_ids.tolist(), self.lengths.tolist(), strict=True):
            while base + len(held) < start + n:
                last = min(block + at_once, len(self.blocks))
                held, base = np.concatenate((held[start - base :], self.ids(block, last))), start
                block = last
            yield None if null else doc_id, start, held[start - base : start - base + n]
            start += n


class _Table:
    """Ids of numbered pieces, one after the other in ``flat``."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.flat = np.empty(0, np.uint32)
        self.begin, self.length = np.empty(0, np.int64), np.empty(0, np.int64)

    def grow(self) -> None:
        more = np.zeros(len(self.number) - len(self.begin), np.int64)
        self.begin, self.length = np.concatenate((self.begin, more)), np.concatenate((self.length, more))

    def add(self, k: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
        """The ids of the pieces of numbers ``k``; those of its j-th end at ``ends[j]``."""
        self.length[k] = np.diff(ends, prepend=0)
        self.begin[k] = len(self.flat) + ends - self.length[k]
        self.flat = np.concatenate((self.flat, ids.astype(np.uint32)))

    def ids(self, k: np.ndarray) -> np.ndarray:
        n = self.length[k]
        ends = np.cumsum(n)
        kind = np.int32 if len(self.flat) < 1 << 30 and (not len(ends) or ends[-1] < 1 << 30) else np.int64
        place = np.repeat((self.begin[k] - (ends - n)).astype(kind), n)
        place += np.arange(len(place), dtype=kind)
        return self.flat[place]


def piece_encoder(tokenizer_path: str, spaced: bool, limit: int = 400_000) -> Callable[[list[bytes]], list[np.ndarray]]:
    """A function from texts to id arrays, with a table of pieces whose last two generations of ``limit`` are kept.

    With ``spaced``, the tokenizer must lower-case, drop white space, keep letters apart from other
    characters and end each word's last token with ``</w>``, as the vocabulary file says it does.
    Then cutting at blanks, line ends and between an ASCII letter and ``.`` or ``,`` and lower-casing
    A-Z changes no id (texts with ``<|`` are left as they are, for the tokens written so). Of the new
    pieces, words of a-z go to the tokenizer's model as they are, and other words of letters alone are
    encoded as one line, which is cut after each word end.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(tokenizer_path)
    plain = lambda texts: [e.ids for e in tok.encode_batch_fast([t.decode("utf-8") for t in texts], add_special_tokens=False)]
    if not spaced:
        return lambda texts: [np.asarray(ids, np.uint32) for ids in plain(texts)]
    word_ids = tok.model.tokenize  # what is left to do for a word of lower-case ASCII letters
    vocabulary = tok.get_vocab()
    word_end = np.zeros(max(vocabulary.values()) + 1, bool)
    word_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
    tables = [_Table(), _Table()]  # this generation and the last

    def learn(new: list[bytes], k: np.ndarray) -> None:
        """The ids of new pieces, whose numbers are ``k``."""
        now, past = tables
        now.grow()
        if past.number:
            old = np.fromiter(map(past.number.get, new, repeat(-1)), np.int64, len(new))
            known = old >= 0
            if known.any():
                now.add(k[known], past.ids(old[known]), np.cumsum(past.length[old[known]]))
                new, k = list(compress(new, ~known)), k[~known]
        bare = np.fromiter((p.isalpha() and p.islower() for p in new), bool, len(new))
        if bare.any():
            found = [[t.id for t in word_ids(p.decode())] for p in compress(new, bare)]
            add_lists(k[bare], found)
            new, k = list(compress(new, ~bare)), k[~bare]
        letters = np.fromiter(((p.isalpha() if p.isascii() else p.decode("utf-8").isalpha()) for p in new), bool, len(new))
        if letters.any():
            ids = np.asarray(plain([b" ".join(compress(new, letters))])[0])
            ends = np.flatnonzero(word_end[ids]) + 1
            if len(ends) == letters.sum():
                now.add(k[letters], ids, ends)
                new, k = list(compress(new, ~letters)), k[~letters]
        if new:
            add_lists(k, plain(new))

    def add_lists(k: np.ndarray, found: list[list[int]]) -> None:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        tables[0].add(k, np.fromiter(chain.from_iterable(found), np.uint32, ends[-1]), ends)

    def encode(texts: list[bytes]) -> list[np.ndarray]:
        if len(tables[0].number) > limit:
            tables[:] = _Table(), tables[0]
        numbers = tables[0].number
        pieces, place, ends = cut_pieces(texts)
        number = np.fromiter(map(numbers.get, pieces, repeat(-1)), np.int64, len(pieces))
        at = np.flatnonzero(number < 0)
        if len(at):
            new = [pieces[i] for i in at.tolist()]
            number[at] = np.arange(len(numbers), len(numbers) + len(new))
            numbers.update(zip(new, number[at].tolist(), strict=True))
            learn(new, number[at])
        k = number[place]
        until = np.concatenate(([0], np.cumsum(tables[0].length[k])))[ends]
        return np.split(tables[0].ids(k), until[:-1]) if len(texts) else []

    return encode


#: A-Z to a-z and a line end to a blank.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 10 else b for b in range(256))


def cut_pieces(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct pieces of texts, the place among them of each piece in order, and where each text's pieces end.

    Texts are lower-cased and cut at blanks, line ends and between a letter and ``.`` or ``,``; texts with ``<|``
    at blanks and line ends alone.
    """
    raw = np.asarray([b"<|" in t for t in texts], bool)
    held = [t.replace(b"\n", b" ") if as_is else t.translate(_LOWER) for t, as_is in zip(texts, raw.tolist(), strict=True)]
    ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)))
    codes = np.frombuffer(b"".join(held), np.uint8)
    at = np.flatnonzero((codes == 46) | (codes == 44))
    at = at[at > 0]
    at = at[(codes[at - 1] >= 97) & (codes[at - 1] <= 122)]
    text = np.searchsorted(ends, at, "right")
    at = at[~raw[text] & (text == np.searchsorted(ends, at - 1, "right"))]  # the letter is of the same text
    offsets = np.concatenate(([0], ends + np.searchsorted(at, ends)))
    cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(held), [None, pa.py_buffer(offsets), pa.py_buffer(np.insert(codes, at, 32))])
    split = pc.split_pattern(cut, " ")
    found = split.values.dictionary_encode()
    return found.dictionary.to_pylist(), found.indices.to_numpy(), split.offsets.to_numpy()[1:]

_HELD: dict[tuple[str, bool], Callable] = {}


def held_encoder(tokenizer_path: str, spaced: bool) -> Callable[[list[bytes]], list[np.ndarray]]:
    """One encoder for each Python worker, which keeps its table from task to task."""
    if (tokenizer_path, spaced) not in _HELD:
        _HELD[tokenizer_path, spaced] = piece_encoder(tokenizer_path, spaced)
    return _HELD[tokenizer_path, spaced]


MANIFEST = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, spaced: bool = True) -> DataFrame:
    """Writes shards in ascending doc_id order; returns the manifest: shard, path, n_docs, n_tokens."""

    def task(batches):
        writer = encode = None
        for b in small_batches(batches):
            if writer is None:
                shard = TaskContext.get().partitionId()
                path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.ids"
                writer, encode = ShardWriter(path), held_encoder(tokenizer_path, spaced)
            for doc_id, ids in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist()), strict=True):
                writer.add(doc_id, np.append(ids, np.uint32(end_id)))
        if writer is not None:
            yield batch(MANIFEST, [[shard], [path], *([n] for n in writer.close())])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    # the range is on doc_id alone: rows that repeat an id stay in one shard, in text order
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(task, "shard int, path string, n_docs long, n_tokens long")


def read_ids(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shard files.

    The manifest has one row for each shard, so its running sum is made on the driver.
    """
    shards = sorted(manifest.collect())
    rows, start = [], 0
    for s in shards:
        rows.append((s["path"], start))
        start += s["n_tokens"]
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def task(batches):
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held = []
                for doc_id, at, ids in ShardReader(path).documents():
                    held.append((doc_id, base + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(held) == 4096:
                        yield batch(out, zip(*held, strict=True))
                        held = []
                if held:
                    yield batch(out, zip(*held, strict=True))

    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], ddl)
    files = spark.createDataFrame(rows, "path string, base long").repartition(len(rows), "path")
    return files.mapInArrow(task, ddl)


def ids_round_trip(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Writes the documents' ids to a new shared folder and returns what its files hold."""
    spark = docs.sparkSession
    return read_ids(spark, stored(write_ids(docs, work_path(spark, "ids"), tokenizer_path, **options), "ids-manifest"))
