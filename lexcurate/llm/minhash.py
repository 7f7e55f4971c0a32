"""Near-duplicate documents by BagMinHash over the multiset of five-word shingles.

Signature. Every shingle drives Poisson processes over its discretised weight
axis, one for each dyadic interval [0,1), [1,2), [2,4), [4,8) ... that its
count reaches: points come in order of time, each with a register and a weight
level; a level above the count belongs to heavier multisets only and is passed
over. A register keeps its earliest point, and a shingle stops as soon as its
time is later than every register's. Two documents share a register's point
with a probability equal to their weighted Jaccard similarity, without bias,
and far fewer points than registers x shingles are drawn.

Search. Documents with the same words are one class from the start. Bands of
five registers put class representatives into buckets. No bucket emits its
pairs: in rounds, each bucket names a hub and every member outside the hub's
class proposes that one pair; each member's most frequent hub is verified on the
exact multiset overlap of whole texts, and found links join classes. When rounds
no longer find many links, the members of buckets that still hold several classes
are compared exactly. Of n shingles (copies counted apart) a document's rarest
n - ceil(0.8 n) + 1 must hold one of any partner's; shingles that no other such
document has rule most documents of half-similar families out. The rest of a family
is compared in blocks, by products of incidence matrices inside the tasks, which return
only links that join classes: there is no row for each pair, and no link between
bucket members is lost.

Defined cases: words are separated by white space; a text of one to four words
has one shingle, the text; texts without a word (null too) equal each other and
resemble nothing else; repeated rows and null ids are documents of their own;
an empty table gives no rows; other columns are ignored. class_id is the
smallest id (key, where ids repeat) of the class.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.llm import common, words

WORDS, SIMILARITY = 5, 0.8
#: 24 bands of 5 registers miss a pair of similarity 0.8 once in 14,000.
BANDS, ROWS = 24, 5
#: Members of a family that are compared with each other, or with as many others, at once.
BLOCK = 1024
#: Shingles that are signed, and pairs that are compared, at once.
SHINGLES_AT_ONCE = 200_000
#: Words whose hashes a worker keeps, twice over; four times as many don't save time.
CACHE_WORDS = 25_000
_U = np.uint64
_STEP, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers."""
    h = (h ^ (h >> _U(30))) * _M1
    h = (h ^ (h >> _U(27))) * _M2
    return h ^ (h >> _U(31))


@words.worker_cache("shingles")
def _word_hashes() -> words.Bounded:
    return words.Bounded(xxhash.xxh3_64_intdigest, CACHE_WORDS)


def shingles(tokens: list[str]) -> np.ndarray:
    """Hashes of all five-word runs, repeats included; of the whole text where it is shorter."""
    n = len(tokens)
    a = np.fromiter(map(_word_hashes().__getitem__, tokens), np.uint64, n)
    if n < WORDS:
        a = np.concatenate([a, np.full(WORDS - n, n, np.uint64)]) if n else a
    out = np.zeros(max(0, len(a) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        out = out * _STEP + a[k:k + len(out)]
    return mixed(out)


def signatures(bags: list[np.ndarray], registers: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash of each multiset of 64-bit hashes: float64 [len(bags), registers], inf for an empty one."""
    kept = np.full((len(bags), registers), np.inf)
    sizes = np.array([len(b) for b in bags])
    if not sizes.sum():
        return kept
    doc = np.repeat(np.arange(len(bags)), sizes)
    h = np.concatenate([np.sort(b) for b in bags])
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
    count = np.diff(np.r_[first, len(h)]).astype(np.float64)
    doc, h = doc[first], h[first]
    # one process for each dyadic interval of the weight axis that the count reaches
    parts = [(doc, h, np.zeros(len(h)), np.ones(len(h)), count)]
    level, low = 1, 1.0
    while len(more := np.flatnonzero(count > low)):
        parts.append((doc[more], mixed(h[more] + _U(level * int(_STEP) % (1 << 64))), np.full(len(more), low), np.full(len(more), low), count[more]))
        level, low = level + 1, low * 2
    doc, seed, low, width, count = (np.concatenate(x) for x in zip(*parts))
    time, step, steps = np.zeros(len(doc)), _U(0), 1
    flat = kept.reshape(-1)
    while len(doc):
        k = (np.arange(steps, dtype=np.uint64) + step) * _U(3)
        draw = lambda i: mixed(mixed(seed[:, None] + (k + _U(i))[None, :] * _STEP))  # noqa: B023,E731
        gaps = -np.log((draw(0) >> _U(11)).astype(np.float64) * 2.0 ** -53 + 2.0 ** -54) / width[:, None]
        times = time[:, None] + np.cumsum(gaps, axis=1) if steps > 1 else time[:, None] + gaps
        at = doc[:, None] * registers + (draw(1) % _U(registers)).astype(np.int64)
        level = low[:, None] + width[:, None] * ((draw(2) >> _U(11)).astype(np.float64) * 2.0 ** -53)
        inside = level < count[:, None]
        np.minimum.at(flat, at[inside], times[inside])
        time = times[:, -1]
        alive = time < kept.max(axis=1)[doc]
        doc, seed, low, width, count, time = (x[alive] for x in (doc, seed, low, width, count, time))
        step, steps = step + _U(steps), min(16, steps * 2)
    return kept


def bands(kept: np.ndarray, n_bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    bits = kept.view(np.uint64).reshape(len(kept), n_bands, rows)
    out = np.broadcast_to(np.arange(n_bands, dtype=np.uint64), bits.shape[:2]).copy()
    for k in range(rows):
        out = mixed(out * _STEP + bits[:, :, k])
    return out.view(np.int64)


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    (ka, ca), (kb, cb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[ia], cb[ib]).sum())
    return both / (len(a) + len(b) - both)


def signed(texts: DataFrame) -> DataFrame:
    """row_key, doc_id, same (a hash of the words), n (shingles), bands."""

    def rows(batches):
        for batch in batches:
            keys, ids, texts_here = (batch.column(i).to_pylist() for i in range(3))
            at = 0
            while at < len(keys):  # texts whose shingles are held at once
                bags, same, size = [], [], 0
                while at + len(bags) < len(keys) and size < SHINGLES_AT_ONCE:
                    split = texts_here[at + len(bags)].split()
                    same.append(hashlib.blake2b(" ".join(split).encode(), digest_size=16).digest())
                    bags.append(shingles(split))
                    size += len(bags[-1])
                got, n = bands(signatures(bags)), np.array([len(b) for b in bags], np.int64)
                lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum(np.where(n > 0, BANDS, 0))].astype(np.int32), got[n > 0].reshape(-1))
                part = slice(at, at + len(bags))
                yield pa.RecordBatch.from_arrays([pa.array(keys[part], pa.int64()), pa.array(ids[part], pa.int64()), pa.array(same, pa.binary()),
                                                  pa.array(n), lists], names=["row_key", "doc_id", "same", "n", "bands"])
                at += len(bags)

    return texts.mapInArrow(words.giving_back(rows), "row_key long, doc_id long, same binary, n long, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole texts have a similarity of ``least`` or more."""

    def rows(batches):
        bag = lru_cache(maxsize=16)(lambda text: np.sort(shingles(text.split())))
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            near = pa.array([overlap(bag(x), bag(y)) >= least for x, y in zip(a, b)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), near], names=["a", "b", "near"])

    side = lambda k: texts.select(F.col("row_key").alias(k), F.col("text").alias(f"text_{k}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(words.giving_back(rows), "a long, b long, near boolean")


def elements(texts: DataFrame) -> DataFrame:
    """(row_key, elements): the shingles of each text; equal ones of a text are numbered apart."""

    def rows(batches):
        for batch in batches:
            got = []
            for text in batch.column(1).to_pylist():
                h = np.sort(shingles(text.split()))
                nth = (np.arange(len(h)) - np.searchsorted(h, h, "left")).astype(np.uint64)
                got.append(np.where(nth > 0, mixed(h + nth * _STEP), h).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.int64()))], names=["row_key", "elements"])

    return texts.select("row_key", "text").mapInArrow(words.giving_back(rows), "row_key long, elements array<long>")


def families(arrays: DataFrame, least: float) -> DataFrame:
    """(row_key, family) of those that may have a partner: two texts can only reach ``least`` if the rarest
    n - ceil(least n) + 1 elements of each have one in common; a family is what such elements connect."""
    single = arrays.select("row_key", F.size("elements").alias("n"), F.explode("elements").alias("element"))
    spread = common.table(single.groupBy("element").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "spread")
    shared = single.join(spread, "element").groupBy("row_key", "n").agg(F.array_sort(F.collect_list(F.struct("df", "element"))).alias("e"))
    # elements that nobody else has come first in the prefix; the rarest others fill it up
    room = F.size("e") - F.ceil(F.col("n") * least - 1e-9) + 1
    heads = common.table(shared.where(room > 0).select("row_key", F.explode(F.slice("e", F.lit(1), room.cast("int"))).alias("e"))
                         .select("row_key", "e.element"), "prefixes")
    first = common.table(heads.groupBy("element").agg(F.min("row_key").alias("a"), F.count(F.lit(1)).alias("c")).where("c > 1"), "first")
    return common.components(heads.join(first, "element").select("a", F.col("row_key").alias("b"))).select(
        F.col("node").alias("row_key"), F.col("root").alias("family"))


def spanning_links(keys: np.ndarray, roots: np.ndarray, bags: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links of similarity ``least`` that join different roots, enough to connect all that such links connect."""
    n = np.array([len(b) for b in bags])
    _, label = np.unique(roots, return_inverse=True)
    if not len(n) or label.max() == 0:
        return []
    _, column, count = np.unique(np.concatenate(bags), return_inverse=True, return_counts=True)
    row, common_ones = np.repeat(np.arange(len(n)), n), count[column] > 1
    row, column = row[common_ones], column[common_ones]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(n), len(n)), np.float32)  # counts up to 2**24 are exact
    for at in range(0, int(column.max(initial=-1)) + 1, 4096):
        part = slice(*np.searchsorted(column, (at, at + 4096)))
        has = np.zeros((len(n), min(4096, int(column[-1]) + 1 - at)), np.float32)
        has[row[part], column[part] - at] = 1
        both += has @ has.T
    out = []
    for i in range(len(n)):
        overlaps = both[i, i + 1:].astype(np.float64)
        near = i + 1 + np.flatnonzero(overlaps / np.maximum(n[i] + n[i + 1:] - overlaps, 1) >= least)
        for j in near[np.unique(label[near], return_index=True)[1]]:
            if label[j] != label[i]:
                out.append((int(keys[i]), int(keys[j])))
                label[label == label[j]] = label[i]
    return out


def rest_links(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between ``members`` (row_key, root), enough to connect all that links connect.

    Families are compared in blocks of BLOCK members, two blocks a task, without a row for
    each pair; small families share a task.
    """
    some = common.sized(members.select("row_key"))
    arrays = common.table(elements(texts.join(some, "row_key", "left_semi")), "elements")
    family = common.table(families(arrays, least), "families")
    sizes = common.table(family.groupBy("family").agg(F.count(F.lit(1)).alias("k")), "family-sizes")
    bins = max(1, family.count() // BLOCK)
    blocks = F.ceil(F.col("k") / BLOCK)
    placed = family.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("row_key"), blocks)).select(
        "family", "row_key", "k", "block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
    small = F.col("k") <= BLOCK
    dealt = placed.select(
        "family", "row_key", F.when(small, F.lit(-1)).otherwise(F.col("family")).alias("of"),
        F.when(small, F.pmod(F.xxhash64("family"), F.lit(bins))).otherwise(F.least("block", "other")).alias("i"),
        F.when(small, F.lit(0)).otherwise(F.greatest("block", "other")).alias("j"))

    def compare(rows: pa.Table) -> pa.Table:
        links, rows = [], rows.combine_chunks()
        family, keys, roots = (rows.column(c).to_numpy() for c in ("family", "row_key", "root"))
        bags = [x.values.to_numpy() for x in rows.column("elements")]
        order = np.argsort(family, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(family[order])) + 1):
            links += spanning_links(keys[at], roots[at], [bags[i] for i in at], least)
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table({"a": a, "b": b})

    full = dealt.join(members, "row_key").join(arrays, "row_key")
    return full.groupBy("of", "i", "j").applyInArrow(compare, "a long, b long")


def _hubs(buckets: DataFrame, roots: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Bucket rows with their class; and of each bucket with several classes, its hub of this turn."""
    at = common.table(buckets.join(roots, "row_key", "left").select(
        "band", "row_key", "n", F.coalesce("root", "row_key").alias("root")), "placed")
    hub = F.struct(F.xxhash64("row_key", F.lit(turn)).alias("o"), F.col("row_key").alias("k"), "n", "root")
    hubs = at.groupBy("band").agg(F.min(hub).alias("hub"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return at, common.table(hubs, "hubs")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The classes (row_key, root) with more links."""
    if links.isEmpty():
        return roots
    known = links.union(roots.select(F.col("row_key").alias("a"), F.col("root").alias("b")))
    return common.components(known).select(F.col("node").alias("row_key"), "root")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, kept (the class's representative), row_key."""
    spark = docs.sparkSession
    texts = common.texts(docs)
    signs = common.table(signed(texts), "signatures")
    # sums are written before they are joined: then Spark can split a hot key's partition of the join
    same = common.table(signs.groupBy("same").agg(F.min("row_key").alias("rep")), "same")
    copies = common.table(signs.select("row_key", "doc_id", "same").join(same, "same").drop("same"), "copies")

    reps = signs.join(copies.where("row_key = rep").select("row_key"), "row_key", "left_semi")
    placed = reps.select("row_key", "n", F.explode("bands").alias("band"))
    full = common.table(placed.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("band"), "full")
    buckets = common.table(placed.join(full, "band"), "buckets")
    some = common.sized(common.table(buckets.select("row_key").distinct(), "candidates"))
    whole = common.table(texts.join(some, "row_key", "left_semi").select("row_key", "text"), "candidate-texts")

    # of a range, not of Python rows: those would keep a second pool of Python workers on every executor
    nothing = spark.range(0)
    roots = nothing.select(F.col("id").alias("row_key"), F.col("id").alias("root"))
    tested = nothing.select(F.col("id").alias("a"), F.col("id").alias("b"))
    turn, fruitful = 0, True
    while fruitful:
        turn += 1
        at, hubs = _hubs(buckets, roots, turn)
        hub = hubs.select("band", F.col("hub.k").alias("hub"), F.col("hub.n").alias("m"), F.col("hub.root").alias("hub_root"))
        met = at.join(hub, "band").where("root <> hub_root").where(F.least("n", "m") >= F.greatest("n", "m") * least)
        named = met.groupBy(F.least("row_key", "hub").alias("a"), F.greatest("row_key", "hub").alias("b")) \
            .agg(F.count(F.lit(1)).alias("bands"), F.max("row_key").alias("member"))
        named = named.join(tested, ["a", "b"], "left_anti").groupBy("member").agg(F.max(F.struct("bands", "a", "b")).alias("p"))
        pairs = common.table(named.select("p.a", "p.b"), "pairs")
        result = common.table(verified(pairs, whole, least), "verified")
        roots = _joined(roots, result.where("near").select("a", "b"))
        tested = tested.union(result.select("a", "b"))
        n, near = result.agg(F.count(F.lit(1)), F.count_if("near")).first()
        fruitful = near * 8 > n
    at, hubs = _hubs(buckets, roots, turn)
    members = common.table(at.join(hubs.select("band"), "band").select("row_key", "root").distinct(), "members")
    roots = _joined(roots, common.table(rest_links(members, whole, least), "rest-links"))
    known = roots.select(F.col("row_key").alias("rep"), "root")
    out = copies.join(known, "rep", "left").select("row_key", "doc_id", F.coalesce("root", "rep").alias("root"))
    ids = copies.select(F.col("row_key").alias("root"), F.col("doc_id").alias("class_id"))
    return out.join(ids, "root").select("doc_id", "class_id", (F.col("row_key") == F.col("root")).alias("kept"), "row_key")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class."""
    docs = common.keyed(docs)
    return common.without(docs, near_duplicates(docs).where("NOT kept"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir)).select("doc_id", "class_id", "kept")
