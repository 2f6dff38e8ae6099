"""Near-duplicate documents: BagMinHash signatures of word 5-gram multisets, banded, verified and grouped."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.chunks import Memo, slices
from threadlens.llm.common import texts
from threadlens.session import written

WORDS, SIMILARITY = 5, 0.8
_SLOTS, _ROWS = 128, 4
#: Cells of distance to a head while distance and head's size together grow by a factor e.
CELLS = 6
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(z: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public constants of splitmix64)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def shingles(words: list[list[str]], known: Memo) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, digest and multiplicity of every distinct word 5-gram; a text of one to four words is one shingle."""
    sizes = np.array([len(w) for w in words])
    hashes = np.fromiter((known[x] for w in words for x in w), np.uint64, int(sizes.sum()))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    count = np.where(sizes >= WORDS, sizes - WORDS + 1, np.minimum(sizes, 1))
    doc = np.repeat(np.arange(len(words)), count)
    at = starts[doc] + np.arange(len(doc)) - np.repeat(np.concatenate([[0], np.cumsum(count)])[:-1], count)
    digest = np.full(len(doc), 7, np.uint64)
    for k in range(WORDS):
        inside = at + k < starts[doc + 1]
        digest = np.where(inside, _mix(digest * _GOLDEN + hashes[np.minimum(at + k, max(len(hashes) - 1, 0))]) if len(hashes) else digest, digest)
    order = np.lexsort((digest, doc))
    doc, digest = doc[order], digest[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1])
    first = np.flatnonzero(new)
    return doc[first], digest[first], np.diff(np.append(first, len(doc)))


def signatures(n: int, doc: np.ndarray, digest: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """BagMinHash: n rows of 128 tags; two rows agree in a slot with the weighted Jaccard similarity as chance.

    Weights are discretised in units. An element owns one Poisson process for each octave of units, (0, 1], (1, 2], (2, 4]
    and so on up to its weight, with the octave's width as rate; an event's digest walks down the octave's halves to the
    unit it belongs to, and counts if that unit is within the weight. So a heavier copy of an element has the events of the
    lighter one and more. Each event falls into one slot, whose earliest event gives the tag. Events are made in rounds,
    all documents at once, up to a horizon by which nearly all slots are full, and twice as far for those that are not.
    """
    best = np.full(n * _SLOTS, np.iinfo(np.uint64).max, np.uint64)
    total = np.bincount(doc, weights=weight, minlength=n)
    horizon = np.divide(_SLOTS * (np.log(_SLOTS) + 3.0), total, out=np.zeros(n), where=total > 0)
    octaves = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0) + 1
    owner = np.repeat(np.arange(len(doc)), octaves)
    octave = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(octaves)])[:-1], octaves)
    below = np.where(octave > 0, 1 << np.maximum(octave - 1, 0), 0)
    rate = np.maximum(below, 1)
    seed = _mix(digest[owner] + (octave.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
    where, limit = doc[owner], weight[owner]
    todo = np.arange(len(owner))
    while len(todo):
        live, at, turn = todo, np.zeros(len(todo)), 0
        while len(live):
            turn += 1
            draw = _mix(seed[live] + np.array([turn], np.uint64) * _GOLDEN)
            at = at - np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53) / rate[live]
            on = at <= horizon[where[live]]
            live, at, draw = live[on], at[on], draw[on]
            event = _mix(draw ^ np.uint64(0xD1B54A32D192ED03))
            unit = below[live] + 1 + ((event >> np.uint64(40)).astype(np.int64) & (rate[live] - 1))
            slot = where[live] * _SLOTS + (event & np.uint64(_SLOTS - 1)).astype(np.int64)
            value = at.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | (event >> np.uint64(7)) & np.uint64(0xFFFFFFFF)
            counts = unit <= limit[live]
            np.minimum.at(best, slot[counts], value[counts])
        short = (best.reshape(n, _SLOTS) == np.iinfo(np.uint64).max).any(axis=1) & (total > 0)
        horizon = np.where(short, 2 * horizon, horizon)
        todo = todo[short[where[todo]]]
    return (best & np.uint64(0xFFFFFFFF)).astype("<u4").reshape(n, _SLOTS)


def banded(docs: DataFrame) -> DataFrame:
    """doc_id, node (digest of the text) and bands, 32 digests of four slots each; an empty text has no bands."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Memo(_word_hash, 400_000)
        for rows, strings in slices(batches, most_chars=2_000_000):
            doc, digest, weight = shingles([t.split() for t in strings], known)
            tags = signatures(len(strings), doc, digest, weight).astype(np.uint64).reshape(len(strings), -1, _ROWS)
            bands = np.tile(np.arange(_SLOTS // _ROWS, dtype=np.uint64), (len(strings), 1))
            for k in range(_ROWS):
                bands = _mix(bands * _GOLDEN + tags[:, :, k])
            filled = np.bincount(doc, minlength=len(strings)) > 0
            yield pa.RecordBatch.from_arrays([
                rows.column(0), pa.array([hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in strings], pa.binary()),
                pa.array([list(b) if f else [] for b, f in zip(bands.view(np.int64), filled, strict=True)], pa.list_(pa.int64())),
            ], ["doc_id", "node", "bands"])

    return texts(docs).mapInArrow(work, "doc_id bigint, node binary, bands array<bigint>")


def bags(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, bag and size for the texts named in `nodes`: the multiset of shingles, copies of a shingle numbered apart."""
    wanted = texts(docs).select(F.unhex(F.md5("text")).alias("node"), "text").join(nodes, "node", "left_semi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Memo(_word_hash, 400_000)
        for rows, strings in slices(batches, most_chars=2_000_000):
            doc, digest, weight = shingles([t.split() for t in strings], known)
            owner = np.repeat(np.arange(len(doc)), weight)
            copy = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(weight)])[:-1], weight)
            items = _mix(digest[owner] + copy.astype(np.uint64) * _GOLDEN).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=weight, minlength=len(strings)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(items))], ["node", "bag"])

    return wanted.mapInArrow(work, "node binary, bag array<bigint>").dropDuplicates(["node"]).withColumn("size", F.size("bag"))


def _differences(pairs: DataFrame, bag: DataFrame) -> DataFrame:
    """`pairs` (head, node) with both sizes, what the two multisets do not share, and their weighted Jaccard similarity."""
    sides = (bag.select(F.col("node").alias(c), F.col("size").alias(s), F.col("bag").alias(f"bag_{c}")) for c, s in (("head", "head_size"), ("node", "size")))
    both = pairs.join(next(sides), "head").join(next(sides), "node")
    diff = both.withColumn("diff", F.concat(F.array_except("bag_node", "bag_head"), F.array_except("bag_head", "bag_node"))).drop("bag_node", "bag_head")
    return diff.withColumn("apart", F.size("diff")).withColumn("similarity", _jaccard(F.col("size") + F.col("head_size"), F.col("apart")))


def _jaccard(sizes: Column, apart: Column) -> Column:
    """Weighted Jaccard similarity from the sum of two sizes and the number of items that are not shared."""
    common = (sizes - apart) / 2
    return common / (sizes - common)


def components(links: DataFrame) -> DataFrame:
    """node and root (smallest node) of everything linked: smallest labels spread along links, then labels jump to their labels' label."""
    edges = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        spread = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        moved = labels.join(spread, F.col("node") == F.col("a"), "left").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        labels_new = written(moved.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("beyond", "root")).alias("root")), "labels")
        if labels_new.where("old <> root").isEmpty():
            return labels_new.select("node", "root")
        labels = labels_new.select("node", "root")


def near_links(docs: DataFrame, signed: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b, similarity) that join all different texts of `similarity` or more that share a band.

    Each band's head is the text whose bands hold the most texts, so the centre of a group of edited copies. It is compared
    with the band's other texts; texts linked to one head are in one class and need no comparison. Texts of different
    classes under one head are compared by what tells them from it (`_across`), which loses no link, in bands of any size.
    Pairs of one class are left out, so not all links inside a class are listed.
    """
    nodes = signed.where(F.size("bands") > 0).groupBy("node").agg(F.first("bands").alias("bands"))
    keyed = nodes.select("node", F.explode("bands").alias("band"))
    sizes = keyed.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(keyed.join(sizes, "band").select("band", "n", "node"), "bands")
    central = shared.groupBy("node").agg(F.sum("n").alias("central"))
    heads = shared.join(central, "node").groupBy("band").agg(F.max(F.struct("central", "node")).alias("h")).select("band", F.col("h.node").alias("head"))
    pairs = written(shared.join(heads, "band").where("node <> head").select("head", "node").distinct(), "pairs")
    bag = written(bags(docs, shared.select("node").distinct()), "bags")
    first = written(_differences(pairs, bag), "differences")
    links = first.where(F.col("similarity") >= similarity).select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b"), "similarity")
    roots = written(components(links), "roots")
    return written(links.unionByName(_across(first, roots, similarity)).distinct(), "links")


def _across(first: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b, similarity) between texts of different classes under one head; has all of `similarity` or more.

    Texts x and y are alike enough if at most r = (1 - s) / (1 + s) of their items together are not shared. What is not
    shared is what only one of their differences from the head has, so the differences have at least
    o = (apart_x + apart_y - r * (size_x + size_y)) / 2 items in common. If one of the two is not linked to the head, o is
    positive (two texts linked to it are of one class). So with differences ordered from rare items to common ones, the
    first common item is among the first apart - o + 1 of each: a text needs few items to meet one about as far from the
    head as itself, and differences of a head meet by cells of distance (`_partners`), each on as many items as its cell needs.
    """
    r = (1 - similarity) / (1 + similarity)
    members = _partners(first, roots, similarity)
    items = members.select("head", "node", "linked", F.explode("diff").alias("item"))
    counts = items.groupBy("head", "item").agg(F.count("*").alias("n"), F.min("linked").alias("all_linked")).where("n > 1 and not all_linked").drop("all_linked")
    kept = items.join(counts, ["head", "item"]).groupBy("head", "node").agg(F.sort_array(F.collect_list(F.struct("n", "item"))).alias("kept"))
    alone = F.col("apart") - F.size("kept")  # items that no pair of different classes shares come first and meet nothing
    taken = F.slice("kept", F.lit(1), F.greatest(F.col("p.places") - alone, F.lit(0)).cast("int"))
    begun = members.drop("diff").join(kept, ["head", "node"]).withColumn("alone", alone).withColumn("p", F.explode("partners")).withColumn("taken", taken)
    keys = written(begun.select("head", "node", "root", "size", "apart", "linked", "cell", "alone", "p", F.posexplode("taken").alias("at", "k")).select(
        "head", F.col("k.item").alias("item"), "linked", "cell", F.col("p.linked").alias("to_linked"), F.col("p.cell").alias("to_cell"),
        F.struct("node", "root", "size", "apart", (F.col("at") + F.col("alone")).alias("place")).alias("x"),
    ), "beginnings")
    far = keys.where("not linked and (to_linked or to_cell <= cell)").select("head", "item", "cell", "to_cell", "to_linked", "x")
    near = keys.where("linked or (not to_linked and to_cell >= cell)").select("head", "item", F.col("to_cell").alias("cell"), F.col("cell").alias("to_cell"), F.col("linked").alias("to_linked"), F.col("x").alias("y"))
    x, y = F.col("x"), F.col("y")
    unlike = r * (x["size"] + y["size"]) + 1e-6
    meets = (
        (x["root"] != y["root"]) & (F.col("to_linked") | (F.col("cell") != F.col("to_cell")) | (x["node"] < y["node"]))
        & (2 * x["place"] + y["apart"] - x["apart"] <= unlike) & (2 * y["place"] + x["apart"] - y["apart"] <= unlike)
        & (F.least(x["size"], y["size"]) >= similarity * F.greatest(x["size"], y["size"]))
    )
    met = far.join(near, ["head", "item", "cell", "to_cell", "to_linked"]).where(meets)
    pairs = written(met.groupBy(F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b")).agg(F.min("head").alias("head")), "pairs")
    left, right = (members.select("head", F.col("node").alias(c), *[F.col(v).alias(f"{v}_{c}") for v in ("size", "apart", "diff")]) for c in "ab")
    apart = F.col("apart_a") + F.col("apart_b") - 2 * F.size(F.array_intersect("diff_a", "diff_b"))
    found = pairs.join(left, ["head", "a"]).join(right, ["head", "b"]).select("a", "b", _jaccard(F.col("size_a") + F.col("size_b"), apart).alias("similarity"))
    return found.where(F.col("similarity") >= similarity)


def _partners(first: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """The rows of `first` that may be linked to another text of their head's and of another class, with class, cell and partners.

    A cell holds the texts of a head that are about as far from it, those linked to it apart from the others. `partners` are
    the cells whose distances and sizes allow `similarity`, with the number of first items to meet them on.
    """
    r = (1 - similarity) / (1 + similarity)
    rooted = (
        first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).withColumn("linked", F.col("similarity") >= similarity)
        .withColumn("cell", F.floor(CELLS * F.log1p(F.col("apart") / F.col("head_size"))).cast("int")).drop("similarity", "head_size")
    )
    cells = rooted.groupBy("head", "linked", "cell").agg(
        F.count("*").alias("n"), F.min("apart").alias("nearest"), F.max("apart").alias("farthest"), F.min("size").alias("least"), F.max("size").alias("most"),
        F.min("root").alias("low"), F.max("root").alias("high"),
    )
    mixed = cells.groupBy("head").agg(F.collect_list(F.struct("linked", "cell", "n", "nearest", "farthest", "least", "most")).alias("cells"), F.min("low").alias("low"), F.max("high").alias("high"))
    size, apart = F.col("size"), F.col("apart")

    def reach(c: Column) -> Column:
        return r * (size + F.least(size / similarity, c["most"])) + 1e-6

    def allows(c: Column) -> Column:
        other = ~(F.col("linked") & c["linked"]) & ((c["linked"] != F.col("linked")) | (c["cell"] != F.col("cell")) | (c["n"] > 1))
        return other & (c["nearest"] - apart <= reach(c)) & (apart - c["farthest"] <= reach(c)) & (c["most"] >= similarity * size) & (size >= similarity * c["least"])

    def partner(c: Column) -> Column:
        places = F.floor((apart - F.greatest(c["nearest"], apart - reach(c)) + reach(c)) / 2) + 1
        return F.struct(c["linked"].alias("linked"), c["cell"].alias("cell"), places.alias("places"))

    known = rooted.join(written(mixed.where("low <> high").drop("low", "high"), "cells"), "head")
    return written(known.withColumn("partners", F.transform(F.filter("cells", allows), partner)).drop("cells").where(F.size("partners") > 0), "partners")


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class) and n_links of every document.

    Documents are one class if a chain of links joins them: equal texts, or multisets of word 5-grams (words between white
    space) with a weighted Jaccard similarity of `similarity` or more. n_links counts the links found to other texts.
    Null counts as the empty text, and empty texts are one class. Texts are compared once however many copies they have.
    """
    signed = written(banded(docs), "signed")
    links = near_links(docs, signed, similarity)
    roots = written(components(links), "roots")
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("low")).join(roots, "node", "left").join(degree, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = written(nodes.select("node", "root", "low", F.coalesce("n_links", F.lit(0)).alias("n_links")), "nodes")
    classes = named.groupBy("root").agg(F.min("low").alias("class_id"))
    return signed.select("doc_id", "node").join(named.join(classes, "root").select("node", "class_id", "n_links"), "node").select("doc_id", "class_id", "n_links")


def _node(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class (smallest doc_id, then text digest), with its own columns."""
    signed = written(banded(docs), "signed")
    roots = components(near_links(docs, signed, similarity))
    keys = signed.groupBy("node").agg(F.min("doc_id").alias("low")).join(roots, "node", "left")
    kept = written(keys.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(F.struct(F.col("low").isNull(), "low", "node")).alias("k")).select(F.col("k.node").alias("_node"), F.col("k.low").alias("_low")), "kept")
    rows = docs.withColumn("_node", _node("text")).join(kept, "_node").where(F.col("doc_id").eqNullSafe(F.col("_low")))
    return rows.dropDuplicates(["_node"]).select(docs.columns)
