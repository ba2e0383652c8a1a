"""N-gram Jaccard self-join by MinHash banding.

Texts are sets of shingles: ``n`` consecutive words, white space apart, A-Z lower-cased; a shorter
text with a word is one shingle. Two texts are linked if their sets have a Jaccard similarity of
``threshold`` or more.

1. Exact copies are one node: texts are grouped by their md5, which carries a group of any size as
   one row per task after the map-side combine. The different texts are written bucketed by node.
2. Every node gets ``bands`` x ``rows`` minimum hashes. Rows and bands are chosen for the target
   recall: a pair at the threshold shares no band with probability (1 - t^rows)^bands; among the
   choices within ``max_hashes`` the one of most rows is taken, as more rows mean fewer pairs in vain.
3. Bands are shuffled by their hash. In each bucket, the node that meets most others in its buckets is
   the hub (the text that a group of near copies was made from meets more than its copies do), and
   every other node is paired with it: as many pairs as nodes, whatever the bucket's size.
4. Pairs are verified on their full shingle sets, and linked nodes form components.
5. Nodes of one bucket that are still in different components are paired with each other, verified
   and linked as well, but for those that can't be similar: two texts share at most the smaller of
   their known overlaps with the hub, and beyond the hub's shingles the smaller of the counts that are
   not theirs alone. That leaves out the copies in a group that were changed too much. So each candidate pair is
   verified, ruled out or within one component, and the classes are those of all candidate pairs,
   without a pair for each two members of a group.

6. Within each component, every text's links are counted exactly, block by block (``link_counts``).

The result has one row per document: ``class_id`` (the smallest doc_id of its component), the number
of documents of the class, and ``n_links``: how many other different texts are linked with the document's.
Links join texts of one component, so none is missing but those of pairs that no band brought together.

Defined results: null, empty and blank texts have no shingles: copies of such a text are one class
(null apart from empty) without links; a null doc_id gets a class id like any other (null only if
the whole class has no id); repeated rows are copies; extra columns are left out; empty tables work.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import batch, bucketed, lower_words, small_batches, stored, text_bytes
from .link_counts import component_links

SIGNATURES = pa.schema([("node", pa.binary()), ("bands", pa.list_(pa.int64()))])
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands for the recall need at most ``max_hashes`` hashes."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, 64):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def shingle_set(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(n)), strict=False))


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 0.0


def shingle_codes(texts: list[bytes], n: int, rng: np.random.Generator) -> list[np.ndarray]:
    """64-bit codes of the shingles of each text, in their order; none for a text without words."""
    number: dict[bytes, int] = {}
    coded = [np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int64, len(ws)) for ws in map(lower_words, texts)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
    place = rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = []
    for c in coded:
        if not len(c):
            out.append(np.empty(0, np.uint64))
            continue
        k = min(n, len(c))
        h = hashes[c]
        s = sum(h[i : len(h) - k + 1 + i] * place[i] for i in range(k))
        s ^= s >> np.uint64(31)
        s *= _SPREAD
        s ^= s >> np.uint64(29)
        out.append(s)
    return out


def signatures(texts: list[bytes], n: int, bands: int, rows: int, seed: int = 7) -> list[np.ndarray]:
    """The band hashes of each text; none for a text without words."""
    rng = np.random.default_rng(seed)
    each = shingle_codes(texts, n, rng)
    shingles = [s for s in each if len(s)]
    out: list[np.ndarray] = []
    full: list[np.ndarray] = []
    if shingles:
        starts = np.cumsum([0, *map(len, shingles[:-1])])
        every = np.concatenate(shingles)
        mul = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        add = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        band = np.repeat((np.arange(bands, dtype=np.uint64) * _SPREAD)[:, None], len(starts), axis=1)
        for i in range(bands * rows):
            low = np.minimum.reduceat((every * mul[i] + add[i]) >> np.uint64(32), starts)
            b = i // rows
            band[b] = (band[b] ^ low) * _SPREAD
            band[b] ^= band[b] >> np.uint64(32)
        full = list(band.T.astype(np.int64))
    at = iter(full)
    for s in each:
        out.append(next(at) if len(s) else np.empty(0, np.int64))
    return out


def node(col: str) -> Column:
    """The node of a text: its md5; null and empty texts are apart."""
    return F.coalesce(F.unhex(F.md5(F.encode(F.col(col).cast("string"), "UTF-8"))), F.lit(b"null"))


def overlaps(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """a, b, size_a, size_b, both: the sizes of each pair's full shingle sets and of their intersection."""
    far = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = far.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("size_a", pa.int64()), ("size_b", pa.int64()), ("both", pa.int64())])

    def task(batches):
        last, held = None, set()
        for bt in small_batches(batches):
            found = []
            for a, b, ta, tb in zip(*(c.to_pylist() for c in bt.columns), strict=True):
                if a != last:
                    last, held = a, shingle_set(lower_words(ta), n)
                other = shingle_set(lower_words(tb), n)
                found.append((a, b, len(held), len(other), len(held & other)))
            if found:
                yield batch(schema, zip(*found, strict=True))

    return both.mapInArrow(task, "a binary, b binary, size_a long, size_b long, both long")


def linked(measured: DataFrame, threshold: float) -> DataFrame:
    return measured.where(F.col("both") >= threshold * (F.col("size_a") + F.col("size_b") - F.col("both"))).select("a", "b")


def shared_shingles(texts: DataFrame, n: int) -> DataFrame:
    """node, shared: how many shingles a text has that another of ``texts`` has too."""
    schema = pa.schema([("node", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def task(batches):
        for b in small_batches(batches):
            sets = [shingle_set(lower_words(t), n) for t in b.column(1).to_pylist()]
            yield batch(schema, [b.column(0), [np.fromiter((xxhash.xxh64_intdigest(b" ".join(g)) for g in s), np.uint64, len(s)).astype(np.int64) for s in sets]])

    each = texts.select("node", "text").mapInArrow(task, "node binary, shingles array<long>").select("node", F.explode("shingles").alias("shingle"))
    held = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    alone = held.where("n = 1").groupBy("node").agg(F.count("*").alias("alone"))
    sizes = each.groupBy("node").agg(F.count("*").alias("size"))
    return sizes.join(alone, "node", "left").select("node", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("shared"))


def link_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.9999, max_hashes: int = 192) -> tuple[DataFrame, DataFrame]:
    """(unique, labels): node, first_id, copies, text; node, label of linked nodes."""
    bands, rows = choose_bands(threshold, recall, max_hashes)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), node(text_col).alias("node"), text_bytes(text_col).alias("text"))

    def sign(batches):
        for b in small_batches(batches):
            yield batch(SIGNATURES, [b.column(0), signatures(b.column(1).to_pylist(), n, bands, rows)])

    # one row for each text; as the table is bucketed by node, texts are looked up without a second shuffle
    unique = bucketed(base.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("text").alias("text")), "node")
    signed = unique.select("node", "text").mapInArrow(sign, "node binary, bands array<long>")
    signed = stored(signed.select("node", F.explode("bands").alias("bucket")), "bands")

    sizes = signed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    inside = signed.join(sizes, "bucket")  # rows of buckets of two nodes and more
    weights = inside.groupBy("node").agg(F.sum("size").alias("weight"))
    inside = stored(inside.join(weights, "node").select("bucket", "node", "weight"), "buckets")
    hubs = stored(inside.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("top")).select("bucket", F.col("top.node").alias("hub")), "hubs")
    first = stored(inside.join(hubs, "bucket").where("node != hub").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct(), "pairs")

    wanted = first.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = stored(unique.select("node", "text").join(wanted, "node", "left_semi"), "texts")
    measured = stored(overlaps(first, texts, n), "overlaps")
    links = linked(measured, threshold)
    labels = stored(connected_components(links, "a", "b"), "labels")

    # nodes without a link are their own label
    told = inside.join(labels.withColumnRenamed("label", "_l"), "node", "left").select("bucket", "node", F.coalesce("_l", "node").alias("label"))
    mixed = told.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("bucket")
    apart = told.join(mixed, "bucket").join(hubs, "bucket")
    to_hub = measured.select(F.col("a").alias("hub"), F.col("b").alias("node"), F.col("size_b").alias("size"), "both").unionAll(
        measured.select(F.col("b").alias("hub"), F.col("a").alias("node"), F.col("size_a").alias("size"), "both"))
    sizes = measured.select(F.col("a").alias("node"), F.col("size_a").alias("size")).unionAll(measured.select("b", "size_b")).distinct()
    itself = apart.where("node = hub").join(sizes, "node").withColumn("both", F.col("size"))
    apart = stored(apart.where("node != hub").join(to_hub, ["hub", "node"]).unionByName(itself), "mixed")
    shared = shared_shingles(texts.join(apart.select("node").distinct(), "node", "left_semi"), n)
    # beyond the hub's shingles, a text can share with others of the bucket only what is not its alone
    apart = stored(apart.join(shared, "node").select("bucket", "node", "label", "size", "both", (F.col("shared") - F.col("both")).alias("rest")), "mixed")
    x, y = (apart.select("bucket", *(F.col(c).alias(f"{c}_{k}") for c in ("node", "label", "size", "both", "rest"))) for k in "xy")
    most = F.least("both_x", "both_y") + F.least("rest_x", "rest_y")
    enough = most >= threshold / (1 + threshold) * (F.col("size_x") + F.col("size_y")) - 1e-6
    met = (x["bucket"] == y["bucket"]) & (F.col("label_x") < F.col("label_y")) & enough
    second = x.join(y, met).select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()
    second = stored(second.join(first, ["a", "b"], "left_anti"), "pairs")
    more = stored(linked(overlaps(second, texts, n), threshold), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = stored(connected_components(links, "a", "b"), "labels")
    return unique, labels


def similar_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, count_links: bool = True, **options) -> DataFrame:
    """node, class_id, class_size, n_links (null unless asked for) of every different text."""
    unique, labels = link_texts(docs, id_col=id_col, text_col=text_col, n=n, threshold=threshold, **options)
    told = unique.select("node", "first_id", "copies").join(labels, "node", "left").select("node", "first_id", "copies", F.coalesce("label", "node").alias("label"))
    if count_links:
        code = lambda texts: shingle_codes(texts, n, np.random.default_rng(11))
        told = told.join(component_links(unique, labels, code, threshold), "node", "left").fillna(0, subset=["n_links"])
    else:
        told = told.withColumn("n_links", F.lit(None).cast("long"))
    told = stored(told, "nodes")
    classes = told.groupBy("label").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"), F.min(F.struct(F.col("first_id").isNull(), "first_id", "node")).alias("kept"))
    return told.join(classes, "label").select("node", "class_id", "class_size", "n_links", (F.col("kept.node") == F.col("node")).alias("holds_kept"), "first_id")


def ngram_join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, class_id, class_size, n_links of every document."""
    classes = stored(similar_classes(docs, id_col=id_col, text_col=text_col, **options), "classes")
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), node(text_col).alias("node"))
    return keyed.join(classes, "node").select("doc_id", "class_id", "class_size", "n_links")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class, with all its columns: that of the smallest doc_id (ties: the smallest md5)."""
    kept_node, kept_id = "_kept_node", "_kept_id"
    while kept_node in docs.columns or kept_id in docs.columns:
        kept_node, kept_id = "_" + kept_node, "_" + kept_id
    classes = similar_classes(docs, id_col=id_col, text_col=text_col, count_links=False, **options)
    kept = stored(classes.where("holds_kept").select(F.col("node").alias(kept_node), F.col("first_id").alias(kept_id)), "kept")
    one = docs.join(kept, (node(text_col) == F.col(kept_node)) & F.col(id_col).cast("long").eqNullSafe(F.col(kept_id)))
    # rows that repeat both id and text are left only
    return one.dropDuplicates([kept_node]).select(*docs.columns)
