"""Removal of repeated 400-byte strings with suffix arrays by linear grouping.

1. Each block of documents picks anchors by winnowing: every 400-byte window
   names the 128-byte gram of smallest hash inside it, so equal windows name the
   same place. The text between anchors, each with the gram that ends it, is one
   symbol, and the suffix array of a block's symbols (``gsaca``) with its common
   prefixes tells which stretches repeat inside the block. These are proven; a
   later member of a repeat leaves only its interval, so the suffix array also
   combines repeats before the shuffle.
2. What remains are runs: neighbouring windows with one anchor. Runs meet across
   blocks by key. ``settle`` proves runs whose whole extent occurs twice, and
   passes on those whose core alone is shared: the ends of repeats. These
   are settled again in steps of 16 windows and at last window by window, so that
   every byte is decided exactly. A run that is proven goes on as one
   representative of its extent only.
3. Intervals are gathered per document and cut out.

All keys are counted with map-side combination and joined; no group of equal
keys is gathered, however large. Texts without a shared gram cross no shuffle.

A suffix array over single bytes would cost some 5 microseconds of Python a
byte, about ten times what a whole run may; over symbols of 137 bytes on
average it costs a twentieth of that. Strings are compared by 64-bit hashes.

Defined cases: null text is empty; texts shorter than 400 bytes keep all; a
text may repeat itself; repeated rows and null ids are documents of their own;
an empty table gives no rows; other columns are ignored. Kept bytes may begin or
end inside a character; as text, such a character's rest is dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcurate.llm import common, gsaca, words

WINDOW, GRAM, STEP = 400, 128, 16
GRAMS = WINDOW - GRAM + 1
#: Bytes that are analysed, and put into one suffix array, at once: alone, and beside other operators, as in a pipeline.
#: Longer texts are analysed in overlapping parts.
BLOCK_BYTES, BLOCK_BYTES_BESIDE = 1 << 20, 1 << 19
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SYMBOL = np.random.default_rng(10).integers(1, 1 << 63, 256, dtype=np.uint64)
ITEMS = "row_key long, at long, core long, whole long, proven boolean"


@words.worker_cache("substrings")
def _powers() -> list:
    return [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash's base, and of its inverse, modulo 2**64."""
    held = _powers()
    if len(held[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            out, width = np.ones(n, np.uint64), 1
            while width < n:
                out[width:2 * width] = out[:min(width, n - width)] * _U(pow(base, width, 1 << 64))
                width *= 2
            held[k] = out
    return held[0][:n], held[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(29))


class Hashed:
    """Hashes of any substrings of some bytes."""

    def __init__(self, data: bytes):
        self.n = len(data)
        power, self.inverse = powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_SYMBOL[np.frombuffer(data, np.uint8)] * power[:self.n], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.inverse[start])

    def all(self, length: int) -> np.ndarray:
        return mixed((self.sums[length:] - self.sums[:self.n + 1 - length]) * self.inverse[:self.n + 1 - length])


def least_of_each(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    out, have = x, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def pack(low, width, anchor=0):
    """A run in one integer: first window, windows after it, distance to the anchor."""
    return (low << 24) | (width << 12) | anchor


def analyse(parts: list[tuple[int, int, bytes]]) -> dict[str, np.ndarray]:
    """``parts``: (row_key, where the part begins in its text, bytes). Items of runs (core: gram, whole: extent),
    and intervals proven inside the block (core -1, whole: the interval's end)."""
    data = b"".join(p[2] for p in parts)
    sizes = np.array([len(p[2]) for p in parts])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    none = {k: np.zeros(0, np.int64) for k in ("row_key", "at", "core", "whole", "proven")}
    if len(data) < WINDOW:
        return none
    text = Hashed(data)
    gram = text.all(GRAM)
    first = least_of_each((gram & ~_U((1 << 24) - 1)) | np.arange(len(gram), dtype=np.uint64), GRAMS)
    anchor = (first & _U((1 << 24) - 1)).astype(np.int64)  # of the window that begins here
    part = np.repeat(np.arange(len(parts)), np.maximum(0, sizes - WINDOW + 1))
    if not len(part):
        return none
    windows = np.concatenate([np.arange(b, e - WINDOW + 1) for b, e in zip(begins, ends)])
    chosen = anchor[windows]
    new = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (chosen[1:] != chosen[:-1])])
    low, high = windows[new], windows[np.r_[new[1:] - 1, len(windows) - 1]]
    chosen, part = chosen[new], part[new]
    runs = len(low)

    # symbols: from an anchor to the end of the next one's gram; each part ends with a symbol of its own
    last = np.r_[part[1:] != part[:-1], True]
    reach = np.where(last, 0, np.r_[chosen[1:], 0] + GRAM - chosen)
    symbol = text.of(chosen, reach)
    _, number = np.unique(symbol, return_inverse=True)
    number = np.where(last, 1 + part, len(parts) + 1 + number)
    order = gsaca.suffix_array(number.tolist())
    shared = np.array(gsaca.common_prefixes(number.tolist(), order))
    order = np.array(order)
    bytes_of = np.where(shared > 0, chosen[np.minimum(order + shared, runs - 1)] + GRAM - chosen[order], 0)
    before, any_side = np.zeros(runs, np.int64), np.zeros(runs, np.int64)
    follows = np.r_[shared[1:], 0]
    after = np.where(follows > 0, chosen[np.minimum(order + follows, runs - 1)] + GRAM - chosen[order], 0)
    before[order] = bytes_of  # shared with the suffix before it in order, and with the better of both neighbours
    any_side[order] = np.maximum(bytes_of, after)

    # a run is proven if the anchor at or before its first window begins a repeat that covers its extent
    left = np.searchsorted(chosen, low, "right") - 1
    covered = (left >= 0) & (part[np.maximum(left, 0)] == part)
    left = np.maximum(left, 0)
    extent = high + WINDOW
    proven = covered & (chosen[left] + any_side[left] >= extent)
    off = chosen - low
    whole = mixed(text.of(low, extent - low) + _U(_BASE) * (off * 4096 + high - low).astype(np.uint64))
    # a run with the same extent stands before it in the suffix array, and is sent in its place
    rank = np.empty(runs, np.int64)
    rank[order] = np.arange(runs)
    twin = order[np.maximum(rank[left] - 1, 0)] + np.arange(runs) - left
    repeat = covered & (chosen[left] + before[left] >= extent) & (whole[np.minimum(twin, runs - 1)] == whole)
    send = ~repeat
    key = np.array([p[0] for p in parts], np.int64)[part]
    shift = np.array([p[1] for p in parts], np.int64)[part] - begins[part]
    items = {"row_key": key[send], "at": pack(low + shift, high - low, off)[send], "core": (gram[chosen] >> _U(1)).astype(np.int64)[send],
             "whole": whole.view(np.int64)[send], "proven": proven[send].astype(np.int64)}
    # neighbouring proven runs make one interval
    where = np.flatnonzero(proven)
    if not len(where):
        return items
    start = np.r_[True, (np.diff(where) != 1) | (part[where][1:] != part[where][:-1])]
    stop = np.r_[start[1:], True]
    a, b = where[start], where[stop]
    inner = {"row_key": key[a], "at": low[a] + shift[a], "core": np.full(len(a), -1), "whole": extent[b] + shift[b], "proven": np.ones(len(a), np.int64)}
    return {k: np.concatenate([items[k], inner[k]]) for k in items}


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        k: pa.array(np.asarray(v, bool) if k in ("proven", "repeated") else np.asarray(v, np.int64)) for k, v in columns.items()})


def runs_of(texts: DataFrame, block_bytes: int | None = None) -> DataFrame:
    """Step one, in blocks of documents."""
    block_bytes = block_bytes or BLOCK_BYTES

    def rows(batches):
        held, size = [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = text.encode()
                for at in range(0, len(data) - WINDOW + 1, block_bytes):
                    held.append((key, at, data[at:at + block_bytes + WINDOW - 1]))
                    size += len(held[-1][2])
                    if size >= block_bytes:
                        yield _batch(analyse(held))
                        held, size = [], 0
        if held:
            yield _batch(analyse(held))

    return texts.select("row_key", "text").mapInArrow(words.giving_back(rows), ITEMS)


def settle(items: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """What is proven among ``items``, (row_key, at), and what goes to the next step, (row_key, at, proven)."""
    weight = F.when(F.col("proven"), 2).otherwise(1)
    # sums are written before they are joined: then Spark can split a hot key's partition of the join
    cores = common.table(items.groupBy("core").agg(F.sum(weight).alias("n"), F.min("proven").alias("closed"))
                         .where("n > 1 AND NOT closed").select("core"), f"{name}-cores")
    shared = common.table(items.join(cores, "core"), f"{name}-shared")
    wholes = common.table(shared.groupBy("whole").agg(
        F.sum(weight).alias("n"), F.min("core").alias("core"), F.min(F.struct("row_key", "at")).alias("one")), f"{name}-wholes")
    found = shared.where("NOT proven").join(wholes.where("n > 1").select("whole"), "whole").select("row_key", "at")
    still = common.table(wholes.where("n = 1").select("core").distinct(), f"{name}-still")
    onward = wholes.join(still, "core", "left_semi").select("one.row_key", "one.at", (F.col("n") > 1).alias("proven"))
    return common.table(found, f"{name}-found"), onward


def _steps(data: Hashed, at: np.ndarray, key: int, proven: np.ndarray) -> dict:
    """Items of STEP windows at a time. Steps are counted from the anchor, so they are the same in every copy."""
    low, width, off = at >> 24, (at >> 12) & 0xFFF, at & 0xFFF
    least, most = off - width, off  # distances of the run's windows to its anchor
    n = most // STEP - least // STEP + 1
    run = np.repeat(np.arange(len(at)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(least // STEP, n)
    anchor, a = (low + off)[run], np.maximum(step * STEP, least[run])
    b = np.minimum(step * STEP + STEP - 1, most[run])
    core = mixed(data.of(anchor - step * STEP, WINDOW - STEP + 1) + _U(_BASE) * step.astype(np.uint64))
    whole = mixed(data.of(anchor - b, b - a + WINDOW) + _U(_BASE) * (step * 4096 + (a - step * STEP) * 64 + b - step * STEP).astype(np.uint64))
    return {"row_key": np.full(len(run), key), "at": pack(anchor - b, b - a), "core": core.view(np.int64), "whole": whole.view(np.int64), "proven": proven[run]}


def _singles(data: Hashed, at: np.ndarray, key: int, proven: np.ndarray) -> dict:
    """Items of single windows."""
    n = ((at >> 12) & 0xFFF) + 1
    run = np.repeat(np.arange(len(at)), n)
    start = (at >> 24)[run] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    h = data.of(start, WINDOW).view(np.int64)
    return {"row_key": np.full(len(run), key), "at": pack(start, 0), "core": h, "whole": h, "proven": proven[run]}


def finer(onward: DataFrame, texts: DataFrame, cut) -> DataFrame:
    """The items of the next step, cut from the texts by ``cut``."""

    def rows(batches):
        for batch in batches:
            for key, text, at, proven in zip(*(batch.column(i).to_pylist() for i in range(4))):
                data, at, proven = text.encode(), np.array(at, np.int64), np.array(proven, bool)
                for some in np.array_split(np.argsort(at), max(1, len(at) // 4096)):
                    a, p = at[some], proven[some]
                    begin = int((a >> 24).min())  # only the part that the runs need is hashed
                    end = int(((a >> 24) + ((a >> 12) & 0xFFF)).max()) + WINDOW
                    out = cut(Hashed(data[begin:end]), a - (begin << 24), key, p)
                    out["at"] = out["at"] + (begin << 24)
                    yield _batch(out)

    # the runs of a document: no more than it has windows
    lists = onward.groupBy("row_key").agg(F.collect_list(F.struct("at", "proven")).alias("r"))
    both = texts.select("row_key", "text").join(lists, "row_key")
    return both.select("row_key", "text", "r.at", "r.proven").mapInArrow(words.giving_back(rows), ITEMS)


def merged(lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, as maximal ones."""
    order = np.argsort(lows, kind="stable")
    lows, highs = lows[order], np.maximum.accumulate(highs[order])
    new = np.flatnonzero(np.r_[True, lows[1:] > highs[:-1]])
    return lows[new], highs[np.r_[new[1:] - 1, len(highs) - 1]]


def removed(docs: DataFrame, outputs: bool = False, block_bytes: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, row_key (``outputs``:
    and the kept text, null where nothing goes). ``block_bytes``: a task's memory follows it, the result doesn't."""
    texts = common.texts(docs)
    runs = common.table(runs_of(texts, block_bytes), "runs")
    items = runs.where("core >= 0")
    found, onward = settle(items, "extents")
    onward = common.table(onward, "extents-onward")
    inner = runs.where("core = -1").select("row_key", F.col("at").alias("low"), F.col("whole").alias("high"))
    marked = common.table(inner.select("row_key").union(found.select("row_key")).union(onward.select("row_key")).distinct(), "marked")
    some = common.sized(marked)
    whole = common.table(texts.join(some, "row_key", "left_semi"), "marked-texts")

    steps = common.table(finer(onward, whole, _steps), "steps")
    found_steps, onward = settle(steps, "steps")
    singles = common.table(finer(common.table(onward, "steps-onward"), whole, _singles), "singles")
    twice = common.table(singles.groupBy("whole").agg(F.sum(F.when(F.col("proven"), 2).otherwise(1)).alias("n")).where("n > 1"), "twice")
    found_singles = singles.where("NOT proven").join(twice, "whole").select("row_key", "at")

    low = F.shiftright("at", 24)
    spans = found.union(found_steps).union(found_singles).select(
        "row_key", low.alias("low"), (low + F.shiftright("at", 12).bitwiseAND(0xFFF) + WINDOW).alias("high")).union(inner)
    lists = spans.groupBy("row_key").agg(F.collect_list(F.struct("low", "high")).alias("s"))

    def rows(batches):
        for batch in batches:
            key, doc_id, text, low, high = (batch.column(i).to_pylist() for i in range(5))
            out = []
            for k, d, t, a, b in zip(key, doc_id, text, low, high):
                data, at, kept, gone = t.encode(), 0, [], 0
                a, b = merged(np.array(a, np.int64), np.array(b, np.int64))
                for x, y in zip(a.tolist(), b.tolist()):
                    kept.append(data[at:x])
                    gone += y - x
                    at = y
                kept = b"".join([*kept, data[at:]])
                out.append((d, len(data), gone, len(a), hashlib.sha256(kept).hexdigest(), k, kept.decode("utf-8", "ignore")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "row_key", "kept"]
            n = 7 if outputs else 6
            yield pa.RecordBatch.from_arrays(arrays[:n], names=names[:n])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, row_key long" + ", kept string" * outputs
    cut = common.table(whole.join(lists, "row_key").select("row_key", "doc_id", "text", "s.low", "s.high").mapInArrow(words.giving_back(rows), schema), "cut")
    intact = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                          F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), "row_key",
                          *[F.lit(None).cast("string").alias("kept")] * outputs)
    return intact.join(common.sized(cut.select("row_key")), "row_key", "left_anti").select(cut.columns).union(cut)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated strings cut from their texts; n_chars, where there is one, follows."""
    docs = common.keyed(docs)
    cut = common.table(removed(docs, outputs=True, block_bytes=BLOCK_BYTES_BESIDE).where("n_removed > 0").select(F.col("row_key").alias(common.KEY), "kept"), "new-texts")
    intact = common.without(docs, cut.select(F.col(common.KEY).alias("row_key")))
    changed = docs.drop("text").join(cut.withColumnRenamed("kept", "text"), common.KEY).drop(common.KEY)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return intact.select(intact.columns).union(changed.select(intact.columns))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(common.documents(spark, sf_dir)).drop("row_key")
