"""Operators on whole tables against brute force: language model, similarity join, toxicity, archives, pipeline."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from roadrisk.llm import decontam, hmm_lm, link_counts, ngram_join, ordinal_toxicity, pii_anchor, risk_thresholds, warc_index
from roadrisk.operators.components import connected_components

from .conftest import WORDS, prose
from .test_texts import bench_case, plain_hits, plain_measures

# ---------------------------------------------------------------- language model


def test_words_with_and_without_digits_have_classes_of_their_own():
    n = 1 << 30
    assert hmm_lm.shape(b"b7ation", n) != hmm_lm.shape(b"ration", n) == hmm_lm.shape(b"nation", n)


def plain_recursions(m, texts):
    k, c = m.emit.shape[1], len(m.emit)
    first, moves, emitted, logs = np.zeros(k), np.zeros((k, k)), np.zeros((c, k)), []
    for t in texts:
        a = [m.initial * m.emit[t[0]]]
        for x in t[1:]:
            a.append((a[-1] @ m.step) * m.emit[x])
        b = [np.ones(k)]
        for x in t[:0:-1]:
            b.insert(0, m.step @ (m.emit[x] * b[0]))
        z = a[-1].sum()
        logs.append(math.log10(z))
        first += a[0] * b[0] / z
        for i, x in enumerate(t):
            emitted[x] += a[i] * b[i] / z
        for i in range(1, len(t)):
            moves += np.outer(a[i - 1], m.emit[t[i]] * b[i]) * m.step / z
    return first, moves, emitted, logs


@pytest.mark.parametrize("n_lanes", [1, 2, 5, 64])
def test_recursions_are_exact(n_lanes):
    rng = np.random.default_rng(n_lanes)
    m = hmm_lm.first_model(rng.integers(0, 50, 30).astype(float), 3)
    texts = [rng.integers(0, 30, n) for n in (1, 1, 2, 7, 8, 9, 40, 3, 16)]
    first, moves, emitted, logs = plain_recursions(m, texts)
    assert np.allclose(hmm_lm.likelihoods(m, texts, n_lanes), logs, atol=1e-10)
    e = hmm_lm.Expected(3, 30)
    e.add(m, texts, n_lanes)
    assert np.allclose(e.first, first) and np.allclose(e.moves, moves) and np.allclose(e.emitted, emitted)
    assert e.log == pytest.approx(sum(logs) * math.log(10))


def test_long_texts_neither_under_nor_overflow():
    rng = np.random.default_rng(0)
    m = hmm_lm.first_model(rng.integers(0, 5, 9000).astype(float), 4)
    e = hmm_lm.Expected(4, 9000)
    texts = [rng.integers(0, 9000, 30_000), rng.integers(0, 9000, 5)]
    e.add(m, texts, 8)
    assert np.isfinite(e.emitted).all() and e.emitted.sum() == pytest.approx(30_005)


def test_scores(session, odd_docs, no_docs):
    rng = random.Random(3)
    sides = [WORDS[:40], WORDS[40:]]
    rows = [(i, " ".join(rng.choice(sides[i % 2]) for _ in range(60))) for i in range(1500)] + [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    docs = session.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, c long, score long")
    found = hmm_lm.score_texts(docs, states=4, iterations=8, own=40, known=30, shapes=16).collect()
    assert len(found) == len(rows) and hmm_lm.score_texts(no_docs).count() == 0
    words = lambda t: (t or "").encode().lower().split() + [b""]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    expected = Counter()
    for i, t in rows:
        w = words(t)
        expected[i, held(i), len(w), sum(x in c for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == expected
    fresh = [r for r in found if r["held_out"] and r["n_tokens"] == 61]
    assert all(r["score"] < 0 for r in found) and sum(r["score"] for r in fresh) > sum(r["base_score"] for r in fresh)


def test_training_raises_the_likelihood(session):
    rng = random.Random(4)
    docs = session.createDataFrame([(i, " ".join(rng.choice((WORDS[:30], WORDS[30:])[i % 2]) for _ in range(40))) for i in range(200)], "doc_id long, text string")
    rows = docs.selectExpr("doc_id as row", "doc_id", "false as held_out", "encode(text, 'UTF-8') as text")
    counts = hmm_lm.count_tokens(rows.select("text"), limit=10)
    vocabulary = hmm_lm.fit_vocabulary(counts, 50, 1000, 8)
    coded = hmm_lm.encode(rows, vocabulary)
    model, logs = hmm_lm.train(coded.select("classes"), vocabulary, 2, 6)
    assert all(b > a - 1e-6 * abs(a) for a, b in zip(logs, logs[1:], strict=False)) and logs[-1] > logs[0]
    # class probabilities sum to one in each state, and words of a class with its unseen part as well
    assert np.allclose(model.emit.sum(0), 1) and np.allclose(model.step.sum(1), 1) and model.initial.sum() == pytest.approx(1)


# ---------------------------------------------------------------- similarity join


def plain_links(texts, threshold=0.8):
    sets = [ngram_join.shingle_set(ngram_join.lower_words((t or "").encode()), 5) for t in texts]
    return [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and ngram_join.jaccard(sets[i], sets[j]) >= threshold]


def plain_classes(texts):
    label = list(range(len(texts)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in plain_links(texts):
        a, b = sorted((top(i), top(j)))
        label[b] = a
    for i, t in enumerate(texts):  # copies of a text without words are a class
        if t in texts[:i]:
            a, b = sorted((top(i), top(texts.index(t))))
            label[b] = a
    return [top(i) for i in range(len(texts))]


def changed(text, rng, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(WORDS) + "x"
    return " ".join(w)


def near_copies():
    rng = random.Random(9)
    texts = [prose(i, 150) for i in range(60)]
    base = prose(1000, 160)
    texts += [changed(base, rng, rng.randrange(1, 8)) for _ in range(70)]  # some just below the threshold
    texts += [base] * 15 + [base.upper()] * 3
    chain = prose(2000, 150)
    for _ in range(8):
        chain = changed(chain, rng, 2)
        texts.append(chain)
    return texts + ["", None, "", None, "one two", "one two", "ONE  two", " "]


def test_bands_reach_the_recall():
    for t, recall in ((0.8, 0.9999), (0.5, 0.99), (0.9, 0.999)):
        bands, rows = ngram_join.choose_bands(t, recall, 192)
        assert 1 - (1 - t**rows) ** bands >= recall and (bands * rows <= 192 or rows == 1)


def test_classes_and_links(session, no_docs):
    texts = near_copies()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    docs = session.createDataFrame([(i, t, 1, 2) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, node long, bucket long")
    found = {r["doc_id"]: r for r in ngram_join.ngram_join(docs).collect()}
    classes = plain_classes(texts)
    expected = {c: min(i for i, x in zip(ids, classes, strict=True) if x == c) for c in set(classes)}
    assert {i: expected[c] for i, c in zip(ids, classes, strict=True)} == {i: r["class_id"] for i, r in found.items()}
    sizes = Counter(r["class_id"] for r in found.values())
    partners = {}  # different texts that each text is linked with
    for a, b in plain_links(texts):
        if texts[a] != texts[b]:
            partners.setdefault(texts[a], set()).add(texts[b])
            partners.setdefault(texts[b], set()).add(texts[a])
    for k, (i, t) in enumerate(zip(ids, texts, strict=True)):
        assert found[i]["class_size"] == sizes[found[i]["class_id"]]
        assert found[i]["n_links"] == len(partners.get(t, ()))
    assert ngram_join.ngram_join(no_docs).count() == 0
    kept = ngram_join.keep_one(docs.withColumn("_kept_node", docs["node"]))
    assert kept.columns == ["doc_id", "text", "node", "bucket", "_kept_node"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected.values())


@pytest.mark.parametrize("most", [512, 7])
def test_links_of_blocks(session, monkeypatch, most):
    """The same counts in one block and in many."""
    monkeypatch.setattr(link_counts, "MOST_TEXTS", most)
    texts = sorted({t for t in near_copies() if t and len(t) > 100})
    links = Counter(i for a, b in plain_links(texts) for i in (a, b))
    rows = session.createDataFrame([(f"{k}".encode(), t.encode()) for k, t in enumerate(texts)], "node binary, text binary")
    labels = rows.selectExpr("node", "cast('all' as binary) label")
    code = lambda ts: ngram_join.shingle_codes(ts, 5, np.random.default_rng(1))
    got = {int(r["node"]): r["n_links"] for r in link_counts.component_links(rows, labels, code, 0.8).collect()}
    assert got == {k: links[k] for k in range(len(texts))}


@pytest.mark.parametrize("columns", [3, 4096])
def test_overlaps_of_sets(monkeypatch, columns):
    monkeypatch.setattr(link_counts, "COLUMNS", columns)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(23)]
    want = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    assert link_counts.overlaps(sets, None).tolist() == want
    assert link_counts.overlaps(sets[:9], sets[9:]).tolist() == [r[9:] for r in want[:9]]
    assert link_counts.overlaps([sets[0]], [np.asarray([99], np.uint64)]).tolist() == [[0]]


def test_join_of_odd_rows(odd_docs):
    rows = ngram_join.ngram_join(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert by[1] == by[2] == by[11] == {1} and by[None] == {None} and by[3] == {3} and by[4] == {4} and by[5] == {5}
    kept = ngram_join.keep_one(odd_docs).collect()
    assert len(kept) == len({(r["class_id"], r["class_size"]) for r in rows} | {("7", x) for x in range(1)}) or len(kept) >= 10
    assert Counter(r["doc_id"] for r in kept)[1] == 1 and Counter(r["doc_id"] for r in kept)[None] == 1


@pytest.mark.parametrize("order", ["up", "down", "random"])
def test_components_of_long_chains(session, order):
    n = 400
    ids = list(range(n))
    if order == "down":
        ids.reverse()
    elif order == "random":
        random.Random(7).shuffle(ids)
    edges = [(ids[i], ids[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1002, 1002)]
    rows = connected_components(session.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    label = {r["node"]: r["label"] for r in rows}
    assert len(rows) == n + 3 and {label[i] for i in range(n)} == {0} and label[1001] == label[1000] == 1000 and label[1002] == 1002


# ---------------------------------------------------------------- toxicity


def toxic_case(session):
    rng = random.Random(2)
    bad = ["scumbagger", "idiotic", "vileness", "vilestuff"]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(WORDS) for _ in range(50)]
        n = 0 if i % 4 else rng.choice((2, 5, 14))
        for _ in range(n):
            words.insert(rng.randrange(50), rng.choice(bad).upper() + ",")
        rows.append((i, " ".join(words), n))
        labels.append((i, 1, int(n > 0)))
    docs = session.createDataFrame(rows, "doc_id long, text string, grade long")
    return rows, docs, session.createDataFrame(labels + [(0, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(session, odd_docs, no_docs):
    rows, docs, labels = toxic_case(session)
    fold = "doc_id % 5 = 0"
    model = ordinal_toxicity.fit(docs, labels.where(f"not ({fold})"))
    found = {r["doc_id"]: r for r in ordinal_toxicity.score(docs.where(fold), model).collect()}
    truth = {i: n for i, _, n in rows if i % 5 == 0}
    right = sum((found[i]["toxic"]) == (n > 0) for i, n in truth.items())
    assert right >= 0.98 * len(truth)
    severity = {n: np.mean([found[i]["severity"] for i, m in truth.items() if m == n]) for n in (0, 2, 5, 14)}
    assert severity[0] < severity[2] < severity[5] < severity[14]
    # an unseen word of a known beginning counts by its prefix
    other = session.createDataFrame([(1, "vilest vilestone vilestwo scumbagging " + prose(3, 20)), (2, prose(4, 20)), (3, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["toxic"] for r in ordinal_toxicity.score(other, model).collect()} == {1: True, 2: False, 3: False}
    scored = ordinal_toxicity.toxicity(odd_docs, labels.limit(0)).collect()
    assert len(scored) == odd_docs.count() and not any(r["toxic"] for r in scored)
    assert ordinal_toxicity.toxicity(no_docs, labels).count() == 0


def test_ordinal_fit_finds_order_and_weights():
    rng = np.random.default_rng(1)
    n = 4000
    x = rng.integers(0, 2, (n, 3)).astype(float)
    score = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=n)
    grades = (score[:, None] >= np.array([0.5, 2.0])).sum(1)
    starts, features = np.arange(0, 3 * n + 1, 3), np.tile(np.arange(3), n)
    w, theta = ordinal_toxicity.fit_ordinal(starts, features, x.ravel(), grades, np.ones(n), 3, 2)
    assert np.allclose(w, [2, -1, 0], atol=0.25) and np.allclose(theta, [0.5, 2.0], atol=0.25) and theta[0] < theta[1]
    m = 300  # a weight of two is the row twice
    twice = ordinal_toxicity.fit_ordinal(starts[: m + 1], features[: 3 * m], x.ravel()[: 3 * m], grades[:m], np.full(m, 2.0), 3, 2)
    rows = np.tile(np.arange(m), 2)
    again = ordinal_toxicity.fit_ordinal(starts[: 2 * m + 1], features[: 6 * m], x[rows].ravel(), grades[rows], np.ones(2 * m), 3, 2)
    assert np.allclose(twice[0], again[0]) and np.allclose(twice[1], again[1])


def test_features_of_both_sides_and_few_toxic_labels(session):
    # 300 toxic of 10,000 texts: a word of 40 toxic and 60 clean texts marks toxic ones, one of 5,000 clean and 20 toxic speaks for clean ones
    rows = [(1, 60, 40), (2, 5000, 20), (3, 970, 30)] + [(f, 0, 9) for f in range(2000, 1000, -1)]
    counts = session.createDataFrame(rows, "feature long, clean long, toxic long")
    features, marks = ordinal_toxicity.pick_features(counts, 9700, 300, 15.0, 50_000)
    assert features.tolist() == [1, 2, *range(1001, 2001)] and marks.tolist() == [True, False] + [True] * 1000
    features, _ = ordinal_toxicity.pick_features(counts, 9700, 300, 15.0, 500)  # equal ratios: the smallest numbers
    assert features.tolist() == [1, 2, *range(1001, 1499)]


def test_features_are_counted_on_all_labels(session):
    _, docs, labels = toxic_case(session)
    every, sample = (ordinal_toxicity.fit(docs, labels, max_rows=n) for n in (10_000, 100))
    assert len(every.features) and every.features.tolist() == sample.features.tolist()


def test_probabilities_are_ordered():
    m = ordinal_toxicity.Ordinal(np.empty(0), np.empty(0), np.array([0.0, 1.0, 5.0]))
    p = m.at_least(np.linspace(-9, 9, 50))
    assert (np.diff(p, axis=1) <= 0).all() and (np.diff(p, axis=0) > 0).all()


# ---------------------------------------------------------------- archives


def pages_case(session):
    rows = [(i, f"http://www.site{i % 7}.example.org:80/p/{i % 11}?x={i % 3}#f", f"<p>page {i % 17} é</p>" * (1 + i % 5)) for i in range(200)]
    rows += [(5, "http://www.site5.example.org/p/5?x=2", rows[5][2]), (5, None, rows[5][2]), (None, "not a url", None), (900, "", ""), (901, "http://[bad", "x" * 100_000), (902, "mailto:a", None)]
    return rows, session.createDataFrame([(*r, "row", "key") for r in rows], "page_id long, url string, html string, row string, key string")


@pytest.mark.parametrize("min_bytes", [0, 30])
def test_archive_round_trip(session, min_bytes):
    rows, df = pages_case(session)
    found = warc_index.round_trip(df, min_bytes=min_bytes, block_lines=7).collect()
    groups = {}
    for i, _, h in rows:
        groups.setdefault((h or "").encode(), []).append(-1 if i is None else i)
    expected = Counter()
    for data, ids in groups.items():
        top = max(ids)
        once = len(data) >= min_bytes
        for k, i in enumerate(sorted(ids, reverse=True)):
            d = base64.b32encode(hashlib.sha1(data).digest()).decode()
            expected[None if i < 0 else i, len(data), d, "revisit" if k and once else "response", top if k and once else None] += 1
    assert Counter(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in found) == expected
    assert warc_index.round_trip(df.limit(0)).count() == 0


def test_index_finds_every_capture_of_a_url(session):
    rows, df = pages_case(session)
    captures, shards = warc_index.archive(session, df, block_lines=3)
    lines = captures.collect()
    by = Counter(r["key"] for r in lines)
    readers = [warc_index.IndexReader(s[0]) for s in sorted(shards, key=lambda s: warc_index._line_key(*s[1:]))]
    for key, n in by.items():
        assert sum(len(list(r.captures(key))) for r in readers) == n
    assert not any(list(r.captures("org,nowhere)/")) for r in readers)
    missing = session.createDataFrame([("org,nowhere)/", 1, 1), ("", None, -5)], "key string, page_id long, row long")
    assert all(r["archive"] is None for r in warc_index.look_up(missing, shards).collect())


def test_surt():
    assert warc_index.surt("http://www.A.example.org:80/x/?q=1#f") == "org,example,a)/x/?q=1"
    assert warc_index.surt("https://b.org:8443") == "org,b:8443)/" and warc_index.surt(None) == "" and warc_index.surt("x y") == "x y"


# ---------------------------------------------------------------- pipeline


def test_pipeline_against_brute_force(session, tmp_path):
    items, extra, it, _ = bench_case(session)
    texts = [t for t in near_copies() if t is not None]
    texts += [prose(300 + i, 60) + " " + (t or "") for i, (_, t) in enumerate(extra)]
    texts += [prose(400, 70) + " mail a.b@c.org and 10.0.0.1", "short", "same words again " * 40, prose(401, 90)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(999, None, None, None, None), (0, texts[0], "en", "s", 5)]
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    session.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/documents.parquet")
    it.write.parquet(f"{tmp_path}/benchmark.parquet")
    session.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    docs, kept = session.read.parquet(f"{tmp_path}/documents.parquet"), [r for r in rows if r[1]]
    counts = {t: plain_measures(t) for _, t, *_ in kept}
    kept = [r for r in kept if counts[r[1]][0] >= risk_thresholds.MIN_WORDS and 2 * counts[r[1]][4] <= counts[r[1]][0]]
    classes = plain_classes([r[1] for r in kept])
    first = {}
    for c, r in zip(classes, kept, strict=True):
        first[c] = min(first.get(c, r), r, key=lambda x: x[0])
    kept = [r for r in first.values() if not plain_hits(r[1], items)[1]]

    a = pii_anchor.anchors()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(session, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{tmp_path}/stage{k}")
        docs = session.read.parquet(f"{tmp_path}/stage{k}")
    assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == sorted((r[0], pii_anchor.redact(r[1], a)) for r in kept)
    last = corpus_pipeline.run(session, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in last) == sorted(r[0] for r in kept) and all(r["decoded"] for r in last)


def test_pipeline_of_nothing(session, tmp_path):
    for name, ddl in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        session.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(session, str(tmp_path)).count() == 0
    assert decontam.normal_words(b"") == [] and re.compile("x")
