"""Conversation repair by weighted CYK parsing over intervals of rows.

A repaired conversation has role initials ``(s?(ua)+)?``. Each row is kept, gets another role or is
deleted, and empty rows may be inserted anywhere, at the costs ``KEEP``, ``REROLE``, ``DELETE``,
``INSERT`` and ``TRUNCATED``. The grammar is in Chomsky normal form: a nonterminal N[p, q] stands for
the rows that lead a reader of the initials from state p to state q (states: nothing read, system
read, user read, pair read), with the rules

    N[p, q] -> N[p, r] N[r, q]      N[p, q] -> one edited row      N[p, q] -> inserted rows only

A cell of a span of rows holds for each nonterminal the least (cost, audit), audit being the initials
of the edits; the cell of a single row is closed under insertion on both sides. Spans are combined
bottom-up by length. Up to ``CHART`` rows the chart has all spans and tries all splits. Longer spans are
combined from such blocks, twice as many with each step, at one split: N[p, q] of a span comes from *every*
split, because an edit sequence has a state at each row, so one split gives the same least cell.
That makes time and memory linear in the rows, and lets a conversation be parsed in pieces.

Two audits of one span and one cost differ before the shorter one ends (what one has more is inserted
rows, which cost), so the least concatenation is that of the least parts. State and audit fix each
row's new role, so the audit alone says what the repaired conversation is.

Plan. Damage, faults and digests are columns. First sights of (role, text) are a grouping that
adds up before its shuffle. Narrow rows (no text) and these sights are dealt by ranges of (conv_id, turn,
role, digest), so that a conversation of any length is split over tasks; each task returns one piece per
conversation, a cell of its rows and their counts. Last, pieces and texts are dealt by conversation
and sorted; a task joins a conversation's few pieces, then streams its texts through the edits into
the checksum. Texts are shuffled once. SHA-256 is sequential, so the texts of one conversation are read
by one task; it holds the audit (one letter for each row) and no texts.

Defined results: null conv_ids are one conversation; null values read as one space in the damage key,
as role and as text; null turns come first and count in no gap; rows that tie in turn come by role, then
by the SHA-256 of their text, in the bytes' order; repeated rows are duplicates; a role with another
initial is no reason to fail, it is given a new role or deleted; a very long text passes as one value,
a very long conversation in pieces; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, small_batches, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
#: Longest span with a full chart.
CHART = 16

# ---- grammar: states are 0 nothing, 1 system, 2 user, 3 pair; moves by role initial ----
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
NEW_ROLE = {"u": "user", "a": "assistant"}
_PAIRS = [(p, q) for p in range(4) for q in range(4) if p == q or (q >= 2 and p != q) or (p, q) == (0, 1)]
_AT = {pq: k for k, pq in enumerate(_PAIRS)}
#: For each nonterminal the rules N[p, q] -> N[p, r] N[r, q], as places in a cell.
RULES = [[(_AT[p, r], _AT[r, q]) for r in range(4) if (p, r) in _AT and (r, q) in _AT] for p, q in _PAIRS]

Cell = tuple[tuple[int, str] | None, ...]


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans at the split between them."""
    out = []
    for rules in RULES:
        best = None
        for a, b in rules:
            x, y = left[a], right[b]
            if x is not None and y is not None and (best is None or x[0] + y[0] <= best[0]):
                found = (x[0] + y[0], x[1] + y[1])
                if best is None or found < best:
                    best = found
        out.append(best)
    return tuple(out)


def least(cells: Iterable[Cell]) -> Cell:
    return tuple(min((c for c in column if c is not None), default=None) for column in zip(*cells, strict=True))


def _inserted() -> Cell:
    """The cell of the empty span: closure of single insertions."""
    cell = tuple((0, "") if p == q else (INSERT, "I") if any(MOVES.get((p, r)) == q for r in NEW_ROLE) else None for p, q in _PAIRS)
    while (more := least([cell, joined(cell, cell)])) != cell:
        cell = more
    return cell


EMPTY = _inserted()


def _edited(symbol: str) -> Cell:
    """The cell of one row, insertions before and after it included.

    Symbols: ``x`` must be deleted; a role initial in lower case (``o``: any other) is a whole row, in upper case a truncated one.
    """
    cell: list[tuple[int, str] | None] = [None] * len(_PAIRS)
    role, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    for k, (p, q) in enumerate(_PAIRS):
        edits = []
        if p == q:
            edits.append((DELETE, "D"))
        if symbol != "x":
            if MOVES.get((p, role)) == q:
                edits.append((KEEP + extra, "K"))
            if any(MOVES.get((p, r)) == q for r in NEW_ROLE):
                edits.append((REROLE + extra, "R"))
        cell[k] = min(edits, default=None)
    return joined(joined(EMPTY, tuple(cell)), EMPTY)


ROWS: dict[str, Cell] = {s: _edited(s) for s in "xsuaoSUAO"}


class Chart:
    """Cells of spans by their symbols; a bounded table keeps those of short spans, which recur."""

    def __init__(self, limit: int = 200_000) -> None:
        self.limit = limit
        self.known: dict[str, Cell] = dict(ROWS)

    def block(self, symbols: str) -> Cell:
        """The cell of up to ``CHART`` rows: all spans by length, all splits."""
        if symbols in self.known:
            return self.known[symbols]
        if len(self.known) > self.limit:
            self.known = dict(ROWS)
        known, n = self.known, len(symbols)
        for length in range(2, n + 1):
            for i in range(n - length + 1):
                span = symbols[i : i + length]
                if span not in known:
                    known[span] = least([joined(known[span[:k]], known[span[k:]]) for k in range(1, length)])
        return known[symbols]

    def span(self, symbols: str) -> Cell:
        """The cell of any number of rows."""
        if not symbols:
            return EMPTY
        return merged([self.block(symbols[i : i + CHART]) for i in range(0, len(symbols), CHART)])


def merged(cells: list[Cell]) -> Cell:
    """The cell of consecutive spans, neighbours joined pairwise until one is left."""
    while len(cells) > 1:
        cells = [joined(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else EMPTY


def accepted(cell: Cell) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation with that cell."""
    return min(c for c in (cell[_AT[0, q]] for q in ENDS) if c is not None)


class Editor:
    """Streams rows through an audit; the repaired rows come out as ``role:text``."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def _role(self) -> str:
        r = next(r for r in NEW_ROLE if (self.state, r) in MOVES)
        self.state = MOVES[self.state, r]
        return NEW_ROLE[r]

    def inserted(self) -> Iterator[str]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield f"{self._role()}:"

    def row(self, role: str, text: str) -> Iterator[str]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = MOVES[self.state, role[:1]]
            yield f"{role}:{text}"
        elif edit == "R":
            yield f"{self._role()}:{text}"


# ---- columns ----


def damaged(rows: DataFrame, modulus: int = 20) -> DataFrame:
    """conv_id, turn, role, text after the damage of the contract; ``copies`` is 0 for dropped and 2 for repeated rows."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(word("conv_id"), F.lit(":"), word("turn")), "UTF-8")) % modulus
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), word("role").alias("role"), word("text").alias("text"))
    return rows.withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def _last(text: Column) -> Column:
    """The last character that is not white space; empty if there is none."""
    return F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))


def with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))


def faulty(rows: DataFrame) -> DataFrame:
    """Narrow rows: what parsing needs of each row, the text replaced by its digest and last character."""
    return with_digest(rows).select("conv_id", "turn", "role", "digest", "copies", _last(F.col("text")).alias("last"))


def first_sights(narrow: DataFrame) -> DataFrame:
    """The first turn (null before all) at which each (role, text) of a conversation stands."""
    turns = narrow.filter("copies > 0").groupBy("conv_id", "role", "digest").agg(F.max(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("first"))
    return turns.select("conv_id", F.when(~F.col("unnumbered"), F.col("first")).alias("turn"), "role", "digest", F.lit(-1).alias("copies"), F.lit(None).cast("string").alias("last"))


_ORDER = ["conv_id", "turn", "role", "digest"]  # ascending: nulls come first
_CELLS = "array<struct<cost:long,audit:string>>"
PIECE = f"conv_id long, part long, blank long, duplicate long, truncated long, illegal long, rows long, head string, tail string, low long, high long, turns long, cells {_CELLS}"
PIECE_SCHEMA = pa.schema([(n, pa.int64()) for n in ("conv_id", "part", "blank", "duplicate", "truncated", "illegal", "rows")] + [("head", pa.string()), ("tail", pa.string())]
                         + [(n, pa.int64()) for n in ("low", "high", "turns")] + [("cells", pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())])))])
LEGAL = {"su", "ua", "au"}


class _Piece:
    """Counts and symbols of one conversation's rows in one task, in order."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = self.turns = 0
        self.head = self.tail = ""
        self.low: int | None = None
        self.high: int | None = None
        self.symbols: list[str] = []

    def add(self, turn: int | None, role: str, last: str, first: bool) -> None:
        initial = role[:1]
        if not self.rows:
            self.head = initial
        elif self.tail + initial not in LEGAL:
            self.illegal += 1
        self.tail = initial
        self.rows += 1
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if not last:
            self.blank += 1
            symbol = "x"
        elif not first:
            self.duplicate += 1
            symbol = "x"
        else:
            symbol = initial if initial in ("s", "u", "a") else "o"
            if last not in ".!?":
                self.truncated += 1
                symbol = symbol.upper()
        self.symbols.append(symbol)

    def values(self, part: int, chart: Chart) -> tuple:
        cells = [c and {"cost": c[0], "audit": c[1]} for c in chart.span("".join(self.symbols))]
        return (self.conv_id, part, self.blank, self.duplicate, self.truncated, self.illegal, self.rows, self.head, self.tail, self.low, self.high, self.turns, cells)


def pieces(narrow: DataFrame) -> DataFrame:
    """One row for each conversation and range partition: counts, ends and the cell of its rows there."""

    def task(batches):
        part, chart, now, seen, held = TaskContext.get().partitionId(), Chart(), None, None, []
        for b in batches:
            for conv_id, turn, role, digest, copies, last in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        held.append(now.values(part, chart))
                    now, seen = _Piece(conv_id), None
                if copies < 0:
                    seen = (turn, role, digest)  # the row that follows is the first with this role and text
                for _ in range(copies):
                    now.add(turn, role, last, seen == (turn, role, digest))
                    seen = None
            if len(held) >= 1024:
                yield batch(PIECE_SCHEMA, zip(*held, strict=True))
                held = []
        if now is not None:
            held.append(now.values(part, chart))
        if held:
            yield batch(PIECE_SCHEMA, zip(*held, strict=True))

    rows = narrow.unionByName(first_sights(narrow)).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER, "copies")
    return rows.select("conv_id", "turn", "role", "digest", "copies", "last").mapInArrow(task, PIECE)


OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
OUT_SCHEMA = pa.schema([(n, pa.int64()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())])


class _Whole:
    """Joins a conversation's pieces in order, then streams its rows through the edits into the checksum."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.cells = conv_id, []
        self.counts, self.rows, self.tail = [0, 0, 0, 0], 0, ""
        self.low: int | None = None
        self.high: int | None = None
        self.turns = 0
        self.editor: Editor | None = None
        self.sha, self.empty = hashlib.sha256(), True

    def piece(self, p: dict) -> None:
        self.counts = [a + p[n] for a, n in zip(self.counts, ("blank", "duplicate", "truncated", "illegal"), strict=True)]
        if not p["rows"]:
            return
        if self.rows and self.tail + p["head"] not in LEGAL:
            self.counts[3] += 1
        self.rows, self.tail = self.rows + p["rows"], p["tail"]
        if p["turns"]:
            self.turns += p["turns"] - (p["low"] == self.high)  # a turn that both pieces have counts once
            self.low = p["low"] if self.low is None else self.low
            self.high = p["high"]
        self.cells.append(tuple(c and (c["cost"], c["audit"]) for c in p["cells"]))

    def parse(self) -> None:
        self.cost, self.audit = accepted(merged(self.cells))
        self.editor = Editor(self.audit)

    def write(self, lines: Iterable[str]) -> None:
        for line in lines:
            self.sha.update((line if self.empty else "\n" + line).encode("utf-8"))
            self.empty = False

    def row(self, role: str, text: str, copies: int) -> None:
        if self.editor is None:
            self.parse()
        for _ in range(copies):
            self.write(self.editor.row(role, text))

    def values(self) -> tuple:
        if self.editor is None:
            self.parse()
        self.write(self.editor.inserted())
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.counts, self.cost, self.audit, self.sha.hexdigest())


def repaired(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Texts and pieces dealt by conversation and sorted: one output row for each conversation."""

    def task(batches):
        now, held = None, []
        for b in small_batches(batches):
            for conv_id, role, text, copies, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        held.append(now.values())
                    now = _Whole(conv_id)
                if piece is not None:
                    now.piece(piece)
                else:
                    now.row(role, text, copies)
            if len(held) >= 1024:
                yield batch(OUT_SCHEMA, zip(*held, strict=True))
                held = []
        if now is not None:
            held.append(now.values())
        if held:
            yield batch(OUT_SCHEMA, zip(*held, strict=True))

    piece = F.struct(*[c for c in parts.columns if c not in ("conv_id", "part")])
    texts = with_digest(rows).filter("copies > 0").select("conv_id", F.lit(None).cast("long").alias("part"), "turn", "role", "digest", "text", "copies")
    both = texts.unionByName(parts.select("conv_id", "part", piece.alias("piece")), allowMissingColumns=True)
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("part").asc_nulls_last(), *_ORDER[1:])
    return dealt.select("conv_id", "role", "text", "copies", "piece").mapInArrow(task, OUT)


def repair(conversations: DataFrame) -> DataFrame:
    """One row for each conversation: gaps, fault counts, cost and audit of the cheapest repair, and its checksum."""
    rows = damaged(conversations)
    return repaired(rows, stored(pieces(faulty(rows)), "pieces"))
