"""Conversation repair, Orchard clustering and token counts against plain brute force."""
import functools
import hashlib
import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadrisk.llm import orchard_kmeans as ok
from roadrisk.llm import token_counts as tc
from roadrisk.llm import turn_repair as tr
from roadrisk.llm.queries import BYTE_BPE

BLANK = " \t\n\x0b\x0c\r"


# ---- op 11 ----


def cheapest(rows):
    """Least (cost, audit, output) by a search over (rows read, state); rows: (role, text, must go, truncated)."""
    moves = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, q, out = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(rows) and q in (0, 3):
            return cost, audit, out
        for r, name in (("u", "user"), ("a", "assistant")):
            if r in moves[q]:
                heapq.heappush(heap, (cost + 2, audit + "I", i, moves[q][r], (*out, f"{name}:")))
                if i < len(rows) and not rows[i][2]:
                    heapq.heappush(heap, (cost + 2 + rows[i][3], audit + "R", i + 1, moves[q][r], (*out, f"{name}:{rows[i][1]}")))
        if i < len(rows):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q, out))
            if not rows[i][2] and rows[i][0][:1] in moves[q]:
                heapq.heappush(heap, (cost + rows[i][3], audit + "K", i + 1, moves[q][rows[i][0][:1]], (*out, f"{rows[i][0]}:{rows[i][1]}")))
    raise AssertionError


def expected(table):
    """What the contract says of (conv_id, turn, role, text) rows, by conversation."""
    found = {}
    for conv_id, turn, role, text in table:
        word = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{word(conv_id)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        role = "user" if kind == 4 else role
        found.setdefault(conv_id, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    out = {}
    for conv_id, rows in found.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, told, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            last = text.rstrip(BLANK)[-1:]
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            told.append((role, text, fault < 2, int(fault == 2)))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, text = cheapest(told)
        out[conv_id] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def told(symbols):
    return [(s.lower(), "t", s == "x", int(s.isupper())) for s in symbols]


@settings(max_examples=150, deadline=None)
@given(st.text("xsuaoSUAO", max_size=40))
def test_repair_is_the_cheapest(symbols):
    cost, audit, out = cheapest(told(symbols))
    assert tr.accepted(tr.Chart().span(symbols)) == (cost, audit)
    editor, made = tr.Editor(audit), []
    for s in symbols:
        made += editor.row(s.lower(), "t")
    assert [*made, *editor.inserted()] == list(out)


@settings(max_examples=60, deadline=None)
@given(st.text("xsuaoSUAO", min_size=2, max_size=14))
def test_every_split_gives_the_same_cell(symbols):
    chart = tr.Chart()
    whole = chart.span(symbols)
    assert all(tr.joined(chart.span(symbols[:k]), chart.span(symbols[k:])) == whole for k in range(len(symbols) + 1))


def conversations():
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["system", "user", "assistant", "tool", "", None]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rng.choice(["One.", "Two!", "Three", "", " \n\t", None, "É ü?  \n"])
            rows.append((conv, rng.choice([None, turn, turn, turn + 1]), role, text))
    rows += rows[:9]  # repeated rows
    rows += [(1000, t, ("user", "assistant")[t % 2] if t % 7 else "tool", f"Line {t % 400}" + "." * (t % 5 > 0)) for t in range(3000)]  # one long conversation
    rows += [(1001, 0, "user", "long text " * 200_000 + "."), (1001, 1, "assistant", "Yes.")]
    dropped = next(i for i in range(2000, 3000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return [*rows, (dropped, 0, "user", "Gone.")], dropped


def test_repair_rows(session):
    rows, dropped = conversations()
    df = session.createDataFrame([(*r, 1, "piece") for r in rows], "conv_id long, turn long, role string, text string, copies int, part string")
    got = {r["conv_id"]: tuple(r)[1:] for r in tr.repair(df.repartition(7)).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    assert {k: v for k, v in got.items() if v != want[k]} == {}
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[1000][2] > 0  # duplicates far apart in the long conversation


def test_long_conversation_is_split(session):
    rows = [(1, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(4000)]
    df = session.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert tr.pieces(tr.faulty(tr.damaged(df))).count() > 1
        (got,) = tr.repair(df).collect()
    finally:
        session.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tuple(got)[1:] == expected(rows)[1]


def test_repair_of_nothing(session):
    assert tr.repair(session.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


# ---- op 12 ----


def brute(vectors, centroids):
    d = ((vectors[:, None, :] - centroids[None]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 30), st.integers(1, 4), st.integers(1, 5))
def test_orchard_finds_the_nearest(seed, k, dim, spread):
    rng = np.random.default_rng(seed)
    centroids = rng.integers(-spread, spread + 1, (k, dim))  # many ties and equal centroids
    vectors = rng.integers(-spread - 1, spread + 2, (50, dim))
    chosen, d = ok.Orchard(centroids).nearest(vectors, start=int(rng.integers(k)))
    want, least = brute(vectors, centroids)
    assert (chosen == want).all() and (d == least).all()


def test_orchard_measures_less():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-1000, 1000, (40, 8)) * 50
    vectors = centroids[rng.integers(0, 40, 2000)] + rng.integers(-500, 500, (2000, 8))
    search = ok.Orchard(centroids)
    assert (search.nearest(vectors)[0] == brute(vectors, centroids)[0]).all()
    assert search.measured < 0.6 * vectors.shape[0] * len(centroids)


def test_orchard_is_exact_at_the_bound():
    far = np.full((1, 64), ok.BOUND)
    assert ok.Orchard(-far).nearest(far)[1].tolist() == [64 * (2 * ok.BOUND) ** 2]
    search = ok.Orchard(np.concatenate((-far, far, 0 * far)))
    assert search.nearest(np.concatenate((far, -far)))[0].tolist() == [1, 0]


def clusters(rows, k, rounds, dim, scale=256):
    """Plain Lloyd rounds over the kept rows."""
    kept = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    vectors = np.asarray([v for _, v in kept], np.int64)
    centroids = vectors[:k].copy()
    for _ in range(rounds):
        chosen, _ = brute(vectors, centroids)
        for c in range(len(centroids)):
            if (chosen == c).any():
                centroids[c] = vectors[chosen == c].sum(0) // (chosen == c).sum()
    chosen, d = brute(vectors, centroids)
    return sorted(
        (str(i), int(c), int(x), int(d[chosen == c].sum()), int(d.sum()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for (i, _), c, x in zip(kept, chosen, d))


def test_cluster_rows(session):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).astype(np.float32).astype(float).tolist()) for i in range(300)]
    rows += rows[:40] + [(7, rows[9][1]), (None, rows[3][1]), (None, rows[4][1])]
    odd = [(500, None), (501, []), (502, [1.0] * 4), (503, [1.0] * 6), (504, [1.0, None, 1.0, 1.0, 1.0]), (505, [float("nan")] * 5), (506, [float("inf")] * 5), (507, [float("-inf")] * 5)]
    df = session.createDataFrame([(i, v, 0, 1) for i, v in rows + odd], "vec_id long, embedding array<float>, cluster int, v int").repartition(6)
    got = ok.cluster(df, k=12, rounds=4, dim=5)
    assert got.columns == ok.COLUMNS
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == clusters(rows, 12, 4, 5)


def test_cluster_few_and_none(session):
    ddl = "vec_id long, embedding array<float>"
    same = [(i, [0.5, -0.5]) for i in range(5)]
    got = ok.cluster(session.createDataFrame(same, ddl), k=40, dim=2).collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in got} == {(0, 0, 0)} and len(got) == 5  # ties: the smaller number
    assert ok.cluster(session.createDataFrame([(1, [0.5])], ddl), k=40, dim=2).collect() == []
    assert ok.cluster(session.createDataFrame([(1, [3e38, 0.0])], ddl), k=40, dim=2).collect() == []  # beyond the bound: left out


# ---- op 13 ----


@functools.cache
def _library():
    return Tokenizer.from_file(BYTE_BPE)


@functools.cache
def _counter():
    return tc.Counter(BYTE_BPE, tc.whole_tokens(BYTE_BPE))


@pytest.fixture(scope="module")
def library():
    return _library()


@pytest.fixture(scope="module")
def counter():
    return _counter()


def tokens(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_proof_is_checked(library):
    proved = tc.whole_tokens(BYTE_BPE)
    vocabulary = library.get_vocab(with_added_tokens=False)
    assert proved.sum() > 0.9 * len(vocabulary)
    for string, i in list(vocabulary.items())[::97]:
        assert proved[i] == ([t.id for t in library.model.tokenize(string)] == [i])


PARTS = ["the", " The", "'s", "'LL", " I've", "  ", "\n", "\t", "\r\n", " \n ", "é", "한국", "日本 ", "123", " 4²", "#!", " ...", "<|endoftext|>", "<|", "endoftext", "😀", "á", "\x00", "\x1c", "\x85", "᠎", "​", "﻿", "፨", "　", "ſ"]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PARTS), max_size=30).map("".join)))
def test_counts_are_the_librarys(text):
    assert _counter()([text]) == [tokens(_library(), text)]


def test_stretches_keep_counts(library, counter):
    rng = random.Random(2)
    text = "".join(rng.choice(PARTS) for _ in range(3000))
    for size in (1, 3, 10, 100):
        assert "".join(tc.stretches(text, size)) == text
        plain = text.replace("<|endoftext|>", "")
        assert sum(counter.plain(p) for p in tc.stretches(plain, size)) == tokens(library, plain)
    assert list(tc.stretches("x" * 500, 100)) == ["x" * 500]  # nowhere to cut


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tc.checked(public_tokenizers.path("word_bpe_49k.json"))


def test_count_rows(session, odd_docs, no_docs, library):
    got = tc.count_tokens(odd_docs, BYTE_BPE)
    want = [(i, len((t or "").encode()), tokens(library, t or "")) for i, t in odd_docs.select("doc_id", "text").collect()]
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in session.createDataFrame([(*w, w[2] > 512) for w in want], got.schema).collect())
    assert tc.count_tokens(no_docs, BYTE_BPE).collect() == []
