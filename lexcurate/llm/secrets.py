"""Secret scans by grammar inference.

Credentials that three fixed rules find (a key name with its value, an access key id, a long hex run)
are the labelled samples of three kinds. For each kind a prefix tree of the distinct
samples, with the number of samples through every state, is merged into a probabilistic
automaton: in breadth-first order a state joins the most alike of the states kept
so far with which it is statistically compatible (Hoeffding bounds on the shares of every next
character, recursively), or else is kept itself. The automaton's probabilities are then counted
over all samples. Every candidate run of a text is scored by the best kind's log-likelihood
against that of ordinary text (character pairs of all candidates), and is a span of kind ``format``
where it is about as probable, symbol by symbol, as the kind's own samples (the least 1 % aside, less SLACK for
other lengths), and the odds outweigh the prior odds of a secret.

The prefix tree keeps states that at least 1 / SUPPORT of a kind's distinct samples (and LEAST_SAMPLES: fewer
say nothing of what follows) reach, and LEVELS levels, so at most SUPPORT * LEVELS states a kind reach the driver, whatever the
corpus; states beyond follow their parent's heaviest edge. All counts are taken over all documents; a
sample counts once, so copies don't weigh.

Defined cases: null text is empty and has no span; every row, repeated or with a null id, gives its
row; key names are matched in ASCII letters of either case; candidates that overlap
a rule's span are left out; a kind with fewer than LEAST_SAMPLES distinct samples has no automaton and scores nothing; an empty table
gives no rows; other columns are ignored. Positions are code points.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexcurate.llm import common
from lexcurate.llm.words import Bounded

#: The rules (fixed values), in the order in which kinds are listed, and the least length of a find.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
#: What the automata score: runs of credential letters, with the equals signs that pad them.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.-]{8,}(?:={1,2}(?![A-Za-z0-9+/_.=-]))?")
FORMAT = "format"
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
END = ""
#: Bounds of the prefix tree, significance of the compatibility test.
SUPPORT, LEVELS, LEAST_SAMPLES, ALPHA = 256, 64, 8, 0.05
#: Least log odds against ordinary text (the prior odds of a secret, one candidate in ten thousand), the share of a kind's samples under its
#: threshold, and what a run's mean log-probability may fall below that.
LEAST_ODDS, LEAST_SHARE, SLACK = math.log(1e4), 0.01, 0.25
PAIR, BORDER = "pair", "\n"
#: Runs whose verdict a task remembers.
CACHE_RUNS = 100_000


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's place, end, value) of the rules' finds, in order."""
    spans = [(m.start(), 0, m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str, spans: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, run) of the candidate runs that overlap none of ``spans`` (sorted by start); full stops and dashes around a run aren't part of it."""
    at, covered = 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(spans) and spans[at][0] < end:
            covered = max(covered, spans[at][2])
            at += 1
        if start < covered:
            continue
        run = m[0].lstrip(".-")
        start += end - start - len(run)
        run = run.rstrip(".-")
        if len(run) >= LEAST_ASSIGN:
            yield start, start + len(run), run


@dataclass
class Automaton:
    """A probabilistic automaton: state 0 is the start; ``edges[state]``: symbol to state; ``logs[state]``: symbol to log-probability."""

    edges: list[dict[str, int]]
    beyond: list[int]  # where a symbol without an edge leads
    counts: list[Counter] | None = None
    logs: list[dict[str, float]] | None = None
    unseen: list[float] | None = None
    least: float = -math.inf  # mean log-probability a symbol, below which a run isn't of this kind

    def walk(self, run: str) -> Iterator[tuple[int, str]]:
        state = 0
        for c in run:
            yield state, c
            state = self.edges[state].get(c, self.beyond[state])
        yield state, END

    def counted(self, counts: list[Counter]) -> Automaton:
        """With probabilities: every symbol counts half a sample more than was seen."""
        self.counts = counts
        totals = [sum(c.values()) + 0.5 * (len(SYMBOLS) + 1) for c in counts]
        self.logs = [{s: math.log((n + 0.5) / total) for s, n in sorted(c.items())} for c, total in zip(counts, totals)]
        self.unseen = [math.log(0.5 / total) for total in totals]
        return self

    def score(self, run: str) -> float:
        """Log-likelihood of the whole run, its end included."""
        state, total = 0, 0.0
        for c in run:
            total += self.logs[state].get(c, self.unseen[state])
            state = self.edges[state].get(c, self.beyond[state])
        return total + self.logs[state].get(END, self.unseen[state])


class Merger:
    """State merging over a prefix tree given as (prefix, next symbol, count) rows."""

    def __init__(self, rows: list[tuple[str, str, int]], alpha: float = ALPHA):
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        prefixes = sorted({p for p, _, _ in rows}, key=lambda p: (len(p), p))
        number = {p: i for i, p in enumerate(prefixes)}
        self.counts = [Counter() for _ in prefixes]
        self.next: list[dict[str, int]] = [{} for _ in prefixes]
        for p, c, n in sorted(rows):
            self.counts[number[p]][c] = n
            if c != END and p + c in number:
                self.next[number[p]][c] = number[p + c]

    def apart(self, a: int, b: int) -> float:
        """Loss of log-likelihood by giving both states one distribution of the next symbol; infinite if they, or states
        that the same symbols lead to, are incompatible."""
        one, two = self.counts[a], self.counts[b]
        n, m = sum(one.values()), sum(two.values())
        loss = sum(one[c] * math.log(one[c] / n) for c in sorted(one)) + sum(two[c] * math.log(two[c] / m) for c in sorted(two))
        loss -= sum((one[c] + two[c]) * math.log((one[c] + two[c]) / (n + m)) for c in sorted(one.keys() | two.keys()))
        todo = deque([(a, b)])
        while todo:
            a, b = todo.popleft()
            one, two = self.counts[a], self.counts[b]
            n, m = sum(one.values()), sum(two.values())
            most = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if any(abs(one[c] / n - two[c] / m) > most for c in one.keys() | two.keys()):
                return math.inf
            todo.extend((self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys())
        return loss

    def fold(self, kept: int, gone: int) -> None:
        """Adds the counts of ``gone`` and its subtree to ``kept``; what ``kept`` lacks is hung below it."""
        todo = deque([(kept, gone)])
        while todo:
            a, b = todo.popleft()
            self.counts[a] += self.counts[b]
            for c, down in sorted(self.next[b].items()):
                if c in self.next[a]:
                    if self.next[a][c] != down:
                        todo.append((self.next[a][c], down))
                else:
                    self.next[a][c] = down

    def automaton(self) -> Automaton:
        """Breadth-first: a state is merged into the most alike compatible kept state, or kept."""
        kept, place = [0], {0: 0}
        todo = deque((0, c) for c in sorted(self.next[0]))
        while todo:
            above, c = todo.popleft()
            state = self.next[above].get(c)
            if state is None or state in place:
                continue
            loss, best = min((self.apart(k, state), i) for i, k in enumerate(kept))
            if loss < math.inf:
                keeper = kept[best]
                self.next[above][c] = keeper
                before = set(self.next[keeper])
                self.fold(keeper, state)
                todo.extend((keeper, s) for s in sorted(set(self.next[keeper]) - before))
            else:
                place[state] = len(kept)
                kept.append(state)
                todo.extend((state, s) for s in sorted(self.next[state]))
            # a fold may have hung new states below any kept state
            if not todo:
                todo.extend((k, s) for k in kept for s in sorted(self.next[k]) if self.next[k][s] not in place)
        edges = [{c: place[s] for c, s in sorted(self.next[k].items())} for k in kept]
        beyond = []
        for i, k in enumerate(kept):
            heavy = max(((self.counts[k][c], -place[s], s) for c, s in self.next[k].items()), default=None)
            beyond.append(place[heavy[2]] if heavy else i)
        return Automaton(edges, beyond)


class Pairs:
    """Ordinary runs: log-probabilities of a character after the one before."""

    def __init__(self, counts: dict[str, int]):
        after = Counter()
        for pair, n in counts.items():
            after[pair[0]] += n
        size = len(SYMBOLS) + 1
        self.logs = {pair: math.log((n + 0.5) / (after[pair[0]] + 0.5 * size)) for pair, n in sorted(counts.items())}
        self.unseen = {c: math.log(0.5 / (after[c] + 0.5 * size)) for c in SYMBOLS + BORDER}

    def score(self, run: str) -> float:
        whole = BORDER + run + BORDER
        get, unseen = self.logs.get, self.unseen
        return sum(get(whole[i:i + 2]) or unseen[whole[i]] for i in range(len(whole) - 1))


@dataclass
class Model:
    automata: dict[str, Automaton]
    ordinary: Pairs

    def is_secret(self, run: str) -> bool:
        plain = self.ordinary.score(run)
        for automaton in self.automata.values():
            score = automaton.score(run)
            if score - plain >= LEAST_ODDS and score / (len(run) + 1) >= automaton.least - SLACK:
                return True
        return False


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def samples(docs: DataFrame) -> DataFrame:
    """(kind, value, n): the rules' values by kind, and the character pairs of all other candidates as kind ``pair``.
    Pairs are summed in the tasks."""
    def find(batches):
        pairs: Counter = Counter()
        for batch in batches:
            kinds, values = [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                kinds += [KINDS[k] for _, k, _, _ in spans]
                values += [v for _, _, _, v in spans]
                for _, _, run in candidates(text, spans):
                    whole = BORDER + run + BORDER
                    pairs.update(map("".join, zip(whole, whole[1:])))
            yield pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.string()), "value": pa.array(values, pa.string()),
                                              "n": pa.array([1] * len(values), pa.int64())})
        yield pa.RecordBatch.from_pydict({"kind": pa.array([PAIR] * len(pairs), pa.string()), "value": pa.array(list(pairs), pa.string()),
                                          "n": pa.array(list(pairs.values()), pa.int64())})

    found = _rows(docs).select("text").mapInArrow(find, "kind string, value string, n long")
    return found.groupBy("kind", "value").agg(F.sum("n").alias("n"))


def prefix_tree(values: DataFrame, support: int = SUPPORT, levels: int = LEVELS, least: int = LEAST_SAMPLES) -> DataFrame:
    """(kind, prefix, next, n) of the states that ``least`` and 1 / support of a kind's samples reach. ``values``: distinct (kind, value)."""
    sizes = F.broadcast(values.groupBy("kind").agg(F.count(F.lit(1)).alias("samples")))  # one row a kind
    steps = values.select("kind", "value", F.explode(F.sequence(F.lit(0), F.least(F.length("value"), F.lit(levels)))).alias("i")).select(
        "kind", F.col("value").substr(F.lit(1), F.col("i")).alias("prefix"), F.col("value").substr(F.col("i") + 1, F.lit(1)).alias("next"))
    counted = steps.groupBy("kind", "prefix", "next").agg(F.count(F.lit(1)).alias("n"))
    # a state has a row for each next symbol, so the window's groups are small whatever the samples
    reached = counted.withColumn("reached", F.sum("n").over(Window.partitionBy("kind", "prefix"))).join(sizes, "kind")
    return reached.where((F.col("reached") * support >= F.col("samples")) & (F.col("reached") >= least)).select("kind", "prefix", "next", "n")


def train(docs: DataFrame) -> Model:
    """Automata of the kinds and the pairs of ordinary runs, from all documents."""
    found = common.table(samples(docs), "samples")
    ordinary = Pairs({r.value: r.n for r in found.where(F.col("kind") == PAIR).collect()})  # at most 68 x 68 rows
    values = found.where(F.col("kind") != PAIR).select("kind", "value")
    tree: dict[str, list] = {}
    for r in prefix_tree(values).collect():
        tree.setdefault(r.kind, []).append((r.prefix, r.next, r.n))
    automata = {k: Merger(tree[k]).automaton() for k in KINDS if k in tree}

    def steps(batches):
        counts: Counter = Counter()
        for batch in batches:
            for kind, value in zip(batch.column("kind").to_pylist(), batch.column("value").to_pylist()):
                counts.update((kind, state, c) for state, c in automata[kind].walk(value))
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array([k for k, _, _ in counts], pa.string()), "state": pa.array([s for _, s, _ in counts], pa.int32()),
            "next": pa.array([c for _, _, c in counts], pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    seen = {k: [Counter() for _ in a.edges] for k, a in automata.items()}
    values = values.where(F.col("kind").isin(list(automata)))
    for r in values.mapInArrow(steps, "kind string, state int, next string, n long").groupBy("kind", "state", "next").agg(F.sum("n").alias("n")).collect():
        seen[r.kind][r.state][r.next] = r.n
    for k, a in automata.items():
        a.counted(seen[k])

    def means(batches):
        for batch in batches:
            kinds, runs = batch.column("kind").to_pylist(), batch.column("value").to_pylist()
            yield pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.string()),
                                              "mean": pa.array([automata[k].score(v) / (len(v) + 1) for k, v in zip(kinds, runs)], pa.float64())})

    # approximate quantiles have a bounded state, and a hot kind is combined in the tasks
    for r in values.mapInArrow(means, "kind string, mean double").groupBy("kind").agg(
            F.percentile_approx("mean", LEAST_SHARE, 10_000).alias("least")).collect():
        automata[r.kind].least = r.least
    return Model(automata, ordinary)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row a document: counts and digest of the rules' spans, all spans, and how many the automata added."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long"

    def find(batches):
        secret = Bounded(model.is_secret, CACHE_RUNS)
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                more = [(s, len(KINDS), e, "") for s, e, run in candidates(text, spans) if secret[run]]
                names = [*KINDS, FORMAT]
                joined = lambda some: ",".join(f"{names[k]}:{s}:{e}" for s, k, e, _ in some)
                of = Counter(k for _, k, _, _ in spans)
                out.append((of[0], of[1], of[2], hashlib.sha256(joined(spans).encode()).hexdigest(),
                            joined(sorted(spans + more)) if more else joined(spans), len(more)))
            columns = list(zip(*out)) if out else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                                             names=[c.split()[0] for c in schema.split(", ")])

    return _rows(docs).mapInArrow(find, schema)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    return scan(docs, train(docs))
