"""Toxicity from a learned lexicon, matched by Levenshtein automata and weighed in context windows.

*Lexicon.* Terms are whole words or beginnings of words (stems) that mark the toxic rows of a labelled sample. Terms in at
least ``MIN_SUPPORT`` toxic rows that are ``MIN_RATIO`` times as frequent in toxic words as in clean ones are candidates. A
term's *usual rate* is its share of the words of the toxic rows that have it; a row holds a term that it has at half that rate
or more, so that a chance hit in a long text is none. A greedy cover picks at most ``LEXICON`` terms, so that each toxic row is
explained several times over and clean ones cost. A stem that says no more than a longer one gives way to it.

*Matching.* The terms form a trie. Its intersection with the Levenshtein automata of the terms (no edit below five
characters, one below eight, else two) is a deterministic automaton over words, built as far as the texts need it; all different
words of a batch take each step together. So misspelled terms are found at the price of a table look-up per letter, most words
leaving the automaton after two or three letters. A stem leaves the rest of the word free.

*Context.* A hit is looked at in a window of ``WINDOW`` words on both sides. Enclosed in quotation marks there, or in
a line that starts with ``>``, it counts as *marked*; with a reporting word in the window as *reported*; else as
*plain*. The evidence of a document is, for each kind, the sum over its terms of weight times rate, up to the usual rate; hits
close to each other add to a fourth sum.

*Weights.* Of exact terms: ridge-regularised logistic regression over the sample. Of a term at one or two edits: the share
of toxic and clean sample rows that hold such a hit, drawn towards a part of the exact weight where they are few; so a
neighbour that is common in clean text weighs nothing. Of the four sums: logistic regression drawn towards ``PRIOR``, in which a
marked hit says little. The intercept is shifted from the sample's share of toxic rows to that of all labelled rows.

Training uses text and label of the rows the caller marks: at most about ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` clean ones,
by a hash of their id, one text for each id. Only lexicon candidates and numbers of sample rows reach the driver. Scoring
reads whole texts in one pass without a shuffle.

Cases: a null text counts as empty and scores as a text without a hit; an id labelled more than once is toxic if any label
says so; null labels and ids don't train; without toxic or without clean rows there is no lexicon and the score is the share
of toxic rows; repeated rows get equal scores; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import sample_by_hash, ship, written

TOXIC_ROWS, CLEAN_ROWS = 2000, 4000
MIN_SUPPORT, MIN_RATIO = 3, 8.0
CANDIDATES, LEXICON = 4000, 200
STEM_CHARS = range(3, 13)
# Value of covering a toxic row for the first, second ... time; price of a clean row, in toxic ones.
COVER, CLEAN_PRICE = (1.0, 0.5, 0.25, 0.12, 0.06, 0.03), 3.0
# A row holds a term from this part of its usual rate on; texts count as at least so many words.
HOLDS, LEAST_WORDS = 0.5, 25
WINDOW = 6
PLAIN, REPORTED, MARKED = 0, 1, 2
# What the sums of plain, reported, marked and close hits weigh before the sample is seen, and how firmly.
PRIOR, FIRMNESS = np.array([1.0, 0.6, 0.15, 0.2]), np.array([1.0, 4.0, 25.0, 4.0])
# The part of a term's weight that one and two edits keep where the sample doesn't know them.
KEPT = (1.0, 0.8, 0.55)
LEAST_WEIGHT = 0.3
# Automaton states kept in a worker before it starts anew.
STATES = 20_000

# Words that report speech.
REPORTING = frozenset("""
said says say wrote writes called calls quote quoted quoting quotes reported told
sagte sagt schrieb schreibt nannte zitat zitiert zitierte
dit disait écrit écrivait cite cité citation
dijo dice escribió escribe cita citó llamó
""".split())
# Opening marks with their closing ones.
MARKS = {'"': '"', "“": "”", "„": "“", "«": "»", "»": "«", "‹": "›", "‘": "’"}

_WORD = re.compile(r"[^\W_]+(?:[@$*][^\W_]+)*")
_END = 0
_OTHER = 1


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Matcher:
    """The trie of (term, is it a stem) intersected with the Levenshtein automata of the terms."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.limit = [edits_allowed(t) for t, _ in terms]
        self.child: list[dict[str, int]] = [{}]
        self.whole: dict[int, int] = {}
        self.stem: dict[int, int] = {}
        self.reach = [0]  # the most edits that a term below the node allows
        for i, (term, is_stem) in enumerate(terms):
            node = 0
            self.reach[0] = max(self.reach[0], self.limit[i])
            for c in term:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.reach.append(0)
                node = self.child[node][c]
                self.reach[node] = max(self.reach[node], self.limit[i])
            (self.stem if is_stem else self.whole)[node] = i
        letters = sorted({c for t, _ in terms for c in t})
        self.letters = ["", ""] + letters
        self.classes = np.full(max(map(ord, letters), default=0) + 2, _OTHER, np.uint8 if len(letters) < 250 else np.int32)
        for i, c in enumerate(letters):
            self.classes[ord(c)] = i + 2
        self.forget()

    def forget(self) -> None:
        self.states: list[tuple[frozenset, tuple]] = []
        self.number: dict[tuple[frozenset, tuple], int] = {}
        self.table = np.full((64, len(self.letters)), -1, np.int32)
        self.open = np.zeros(64, bool)
        self.found: list[tuple[tuple[int, int], ...]] = []
        self._state({}, {})  # number 0: nothing matched, nothing left
        self.start = self._state({0: 0}, {})

    def _state(self, nodes: dict[int, int], done: dict[int, int]) -> int:
        todo = list(nodes.items())  # letters of the term that the word leaves out
        while todo:
            node, e = todo.pop()
            for to in self.child[node].values():
                if e < self.reach[to] and e + 1 < nodes.get(to, 99):
                    nodes[to] = e + 1
                    todo.append((to, e + 1))
        done = dict(done)
        for node, e in nodes.items():
            t = self.stem.get(node)
            if t is not None and e <= self.limit[t]:
                done[t] = min(e, done.get(t, e))
        key = frozenset(nodes.items()), tuple(sorted(done.items()))
        at = self.number.get(key)
        if at is None:
            at = self.number[key] = len(self.states)
            self.states.append(key)
            if at >= len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.open = np.concatenate([self.open, np.zeros_like(self.open)])
            self.open[at] = bool(nodes)
            ends = dict(done)
            for node, e in nodes.items():
                t = self.whole.get(node)
                if t is not None and e <= self.limit[t]:
                    ends[t] = min(e, ends.get(t, e))
            self.found.append(tuple(ends.items()))
        return at

    def _step(self, state: int, symbol: int) -> int:
        nodes, done = self.states[state]
        c, nxt = self.letters[symbol], {}
        for node, e in nodes:
            if e < self.reach[node]:
                nxt[node] = min(e + 1, nxt.get(node, 99))
            for letter, to in self.child[node].items():
                cost = e + (letter != c)
                if cost <= self.reach[to] and cost < nxt.get(to, 99):
                    nxt[to] = cost
        return self._state(nxt, dict(done))

    def match(self, words: list[str]) -> dict[str, tuple[tuple[int, int], ...]]:
        """(term, edits) of the words that match any."""
        if not words or len(self.child) == 1:
            return {}
        if len(self.states) > STATES:
            self.forget()
        code = np.frombuffer(("\n".join(words) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.flatnonzero(code == 10)
        symbol = self.classes[np.minimum(code, len(self.classes) - 1)].astype(np.int32)
        symbol[ends] = _END
        at = np.concatenate([[0], ends[:-1] + 1])
        last = np.zeros(len(words), np.int64)
        active = np.arange(len(words))
        state = np.full(len(words), self.start, np.int64)
        while len(active):
            s = symbol[at[active]]
            going = s != _END
            last[active[~going]] = state[~going]
            active, state, s = active[going], state[going], s[going]
            to = self.table[state, s]
            if (to < 0).any():
                for pair in np.unique(state[to < 0] * len(self.letters) + s[to < 0]).tolist():
                    a, b = divmod(pair, len(self.letters))
                    reached = self._step(a, b)  # may enlarge the table
                    self.table[a, b] = reached
                to = self.table[state, s]
            state = to.astype(np.int64)
            on = self.open[state]
            last[active[~on]] = state[~on]
            active, state = active[on], state[on]
            at[active] += 1
        some = np.array([bool(f) for f in self.found])[last]
        return {words[i]: self.found[last[i]] for i in np.flatnonzero(some).tolist()}


@dataclass
class Model:
    terms: list[tuple[str, bool]] = field(default_factory=list)
    rates: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 3)))  # (term, edits)
    sums: np.ndarray = field(default_factory=lambda: PRIOR.copy())
    intercept: float = 0.0

    def matcher(self) -> Matcher:
        return Matcher(self.terms)


def _enclosed(text: str, lo: int, start: int, end: int, hi: int) -> bool:
    """Is text[start:end] between a pair of marks that both lie in text[lo:hi], or in a line that starts with '>'?"""
    line = text.rfind("\n", 0, start) + 1
    if text[line:start].lstrip().startswith(">"):
        return True
    line_end = text.find("\n", end)
    left, right = text[max(lo, line):start], text[end:hi if line_end < 0 else min(hi, line_end)]
    for a, b in MARKS.items():
        at = left.rfind(a)
        if at < 0 or b not in right:
            continue
        if a == b:  # straight marks open at every other place of the line
            if text[line:start].count(a) % 2:
                return True
        elif b not in left[at + 1:]:
            return True
    return False


def evidence(text: str, hits: dict[str, tuple[tuple[int, int], ...]]) -> list[tuple[int, int, int, bool]]:
    """(term, edits, kind, is another hit in the window) of each hit, from the words that match."""
    low = text.lower()
    spans = [m.span() for m in _WORD.finditer(low)]
    names = [low[a:b] for a, b in spans]
    at = [i for i, w in enumerate(names) if w in hits]
    out = []
    for n, i in enumerate(at):
        a, b = max(0, i - WINDOW), min(len(spans) - 1, i + WINDOW)
        if _enclosed(low, max(spans[a][0] - 1, 0), *spans[i], spans[b][1] + 1):
            kind = MARKED
        elif any(w in REPORTING for w in names[a:b + 1]):
            kind = REPORTED
        else:
            kind = PLAIN
        close = (n > 0 and at[n - 1] >= a) or (n + 1 < len(at) and at[n + 1] <= b)
        out += [(t, e, kind, close) for t, e in hits[names[i]]]
    return out


def strength(count: int, n_words: int, rate: float) -> float:
    """How much of a term's usual rate a document has, 1 at most."""
    return min(1.0, count / max(n_words, LEAST_WORDS) / rate)


def sums(found: Counter, n_words: int, weights: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """The four sums of a document's hits, counted by (term, edits, kind, close)."""
    out, by_kind, close_ones = np.zeros(4), Counter(), Counter()
    for (t, e, kind, close), k in found.items():
        by_kind[t, e, kind] += k
        if close and kind != MARKED:
            close_ones[t, e] += k
    for (t, e, kind), k in by_kind.items():
        out[kind] += weights[t, e] * strength(k, n_words, rates[t])
    for (t, e), k in close_ones.items():
        out[3] += weights[t, e] * strength(k, n_words, rates[t])
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: np.ndarray, prior: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Coefficients drawn towards ``prior`` by ``ridge``, and intercept: Newton steps."""
    full = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    pull, centre = np.append(ridge, 1e-3), np.append(prior, 0.0)
    beta = centre.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ beta, -30, 30)))
        grad = full.T @ (y - p) - pull * (beta - centre)
        hess = (full * (p * (1 - p))[:, None]).T @ full + np.diag(pull)
        move = np.linalg.solve(hess, grad)
        beta += np.clip(move, -4, 4)
        if np.abs(move).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


def pick_terms(names: list[str], held: list[dict[int, int]], n_words: np.ndarray, toxic: np.ndarray) \
        -> tuple[list[tuple[str, bool]], np.ndarray]:
    """Terms by a greedy cover of the toxic rows, and their usual rates. ``names`` are '=word' or '^stem'; ``held``: counts of the
    candidates in each sample row."""
    count = np.zeros((len(held), len(names)), np.float32)
    for i, cs in enumerate(held):
        count[i, list(cs)] = list(cs.values())
    words = np.maximum(n_words, LEAST_WORDS)
    rates = count[toxic].sum(axis=0) / np.maximum((count[toxic] > 0).T @ words[toxic], 1)
    has = count >= np.maximum(HOLDS * words[:, None] * rates, 1e-9)
    pos, neg = has[toxic].astype(np.float32), has[~toxic].sum(axis=0)
    price = CLEAN_PRICE * neg * (toxic.sum() / max((~toxic).sum(), 1))
    cover = np.zeros(len(pos), np.int64)
    value = np.array([*COVER, 0.0], np.float32)
    free = np.ones(len(names), bool)
    out, at = [], []
    while len(out) < LEXICON and free.any():
        gain = np.where(free, value[np.minimum(cover, len(COVER))] @ pos - price, -np.inf)
        top = int(gain.argmax())
        if gain[top] < 2 * COVER[1]:
            break
        near = [i for i in np.flatnonzero(gain >= 0.95 * gain[top]).tolist() if names[i][1:].startswith(names[top][1:])]
        top = max(near, key=lambda i: (len(names[i]), names[i][0] == "="))
        word = names[top][1:]
        out.append((word, names[top][0] == "^"))
        at.append(top)
        cover += pos[:, top].astype(np.int64)
        for i, x in enumerate(names):
            if x[1:].startswith(word) or word.startswith(x[1:]):
                free[i] = False
    return out, rates[at]


def _candidates_of(words: list[str]) -> Counter:
    """Occurrences of each whole word and stem."""
    out: Counter = Counter()
    for w, k in Counter(words).items():
        if len(w) >= STEM_CHARS[0]:
            out["=" + w] = k
            for j in STEM_CHARS:
                if j > len(w):
                    break
                out["^" + w[:j]] += k
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame | None, float]:
    """(text, toxic) of the sample rows, and the share of toxic ones among all labelled rows."""
    spark = docs.sparkSession
    ids = docs.where(F.col("text").isNotNull()).select("doc_id").distinct()
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")) \
        .join(ids, "doc_id", "left_semi").withColumn("key", F.xxhash64("doc_id", F.lit(11)))
    known = written(known, "toxicity-labels")
    n = {bool(t): c for t, c in known.groupBy((F.col("toxic") > 0).alias("t")).count().collect()}
    share = n.get(True, 0) / max(sum(n.values()), 1)
    if len(n) < 2:
        return None, share
    rows = [(r.doc_id, True) for r in sample_by_hash(known.where(F.col("toxic") > 0), "key", TOXIC_ROWS)]
    rows += [(r.doc_id, False) for r in sample_by_hash(known.where(F.col("toxic") <= 0), "key", CLEAN_ROWS)]
    picked = spark.createDataFrame(rows, "doc_id long, toxic boolean")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    parts = max(spark.sparkContext.defaultParallelism, 8)
    return written(texts.repartition(parts, "doc_id").select("text", "toxic"), "toxicity-sample"), share


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the documents (doc_id, text) that have a label (doc_id, toxic)."""
    spark = docs.sparkSession
    ship(spark)
    sample, share = labelled_sample(docs, labels)
    base = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    if sample is None:
        return Model(intercept=base)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, count = Counter(), {True: Counter(), False: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                c = _candidates_of(words)
                count[toxic].update(c)
                count[toxic][""] += len(words)
                if toxic:
                    rows.update(c.keys())
        names = list(count[True].keys() | count[False].keys())
        for a in range(0, len(names), 100_000):
            part = names[a:a + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), *(pa.array([c[x] for x in part], pa.int64()) for c in (rows, count[True], count[False]))],
                names=["term", "rows", "pos", "neg"])

    counted = written(sample.mapInArrow(tally, "term string, rows long, pos long, neg long").groupBy("term").agg(
        *[F.sum(c).alias(c) for c in ("rows", "pos", "neg")]).where((F.col("rows") >= MIN_SUPPORT) | (F.col("term") == "")),
        "toxicity-terms")
    n_pos, n_neg = counted.where("term = ''").select("pos", "neg").first()
    ratio = ((F.col("pos") + 0.5) / n_pos) / ((F.col("neg") + 0.5) / n_neg)
    best = counted.where("term <> ''").withColumn("ratio", ratio).where(F.col("ratio") >= MIN_RATIO) \
        .orderBy(F.desc(F.col("rows") * F.log("ratio")), "term").limit(CANDIDATES)
    names = [r.term for r in best.select("term").collect()]
    place = {x: i for i, x in enumerate(names)}

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t) for t in batch.column(0).to_pylist()]
            held = [[(place[c], k) for c, k in _candidates_of(ws).items() if c in place] for ws in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(map(len, words), pa.int64()), pa.array([[c for c, _ in h] for h in held], pa.list_(pa.int32())),
                 pa.array([[k for _, k in h] for h in held], pa.list_(pa.int32()))], names=["toxic", "n", "held", "times"])

    rows = sample.mapInArrow(hold, "toxic boolean, n long, held array<int>, times array<int>").collect()
    terms, rates = pick_terms(names, [dict(zip(r.held, r.times)) for r in rows], np.array([r.n for r in rows]),
                              np.array([r.toxic for r in rows]))
    if not terms:
        return Model(intercept=base)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        for batch in batches:
            found, n = _document_hits(batch.column(0).to_pylist(), matcher)
            codes = [{24 * t + 8 * e + 2 * kind + close: k for (t, e, kind, close), k in c.items()} for c in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(n, pa.int64()), pa.array([list(c) for c in codes], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in codes], pa.list_(pa.int32()))], names=["toxic", "n", "codes", "times"])

    rows = sample.mapInArrow(look, "toxic boolean, n long, codes array<int>, times array<int>").collect()
    hits = [Counter({(c // 24, c // 8 % 3, c % 8 // 2, bool(c % 2)): k for c, k in zip(r.codes, r.times)}) for r in rows]
    return fit(terms, rates, hits, np.array([r.n for r in rows]), np.array([r.toxic for r in rows]), base)


def fit(terms: list[tuple[str, bool]], rates: np.ndarray, hits: list[Counter], n_words: np.ndarray, toxic: np.ndarray,
        base: float) -> Model:
    """Weights from the hits of the sample rows; ``base`` is the log-odds of a toxic row among all labelled ones."""
    n, y = len(terms), toxic.astype(float)
    exact = np.zeros((len(hits), n))
    seen = np.zeros((2, n, 3))
    for i, found in enumerate(hits):
        times: Counter = Counter()
        for (t, e, _, _), k in found.items():
            times[t, e] += k
        for (t, e), k in times.items():
            x = strength(k, int(n_words[i]), rates[t])
            seen[int(toxic[i]), t, e] += x >= HOLDS
            if e == 0:
                exact[i, t] = x
    first, _ = logistic(exact, y, np.full(n, 0.2), np.zeros(n))
    weights = np.zeros((n, 3))
    weights[:, 0] = np.maximum(first, 0)
    share = seen / np.array([max((~toxic).sum(), 1), max(toxic.sum(), 1)])[:, None, None] * len(hits)
    for e in (1, 2):
        odds = np.exp(KEPT[e] * weights[:, 0] / 2)
        weights[:, e] = np.clip(np.log((share[1, :, e] + odds) / (share[0, :, e] + 1 / odds)), 0, weights[:, 0])
    weights[weights < LEAST_WEIGHT] = 0
    x = np.array([sums(h, k, weights, rates) for h, k in zip(hits, n_words.tolist())])
    coefs, intercept = logistic(x, y, FIRMNESS, PRIOR)
    shift = base - float(np.log(max(toxic.sum(), 1) / max((~toxic).sum(), 1)))
    used = np.flatnonzero(weights[:, 0] > 0)
    return Model([terms[i] for i in used], rates[used], weights[used], np.maximum(coefs, 0), intercept + shift)


def _document_hits(texts: list[str | None], matcher: Matcher, weights: np.ndarray | None = None) -> tuple[list[Counter], list[int]]:
    """Hits of each text, counted by (term, edits, kind, close), those without weight left out; and its number of words."""
    split = [words_of(t) for t in texts]
    hits = matcher.match(list(set().union(*split)))
    if weights is not None:
        kept = {w: tuple((t, e) for t, e in f if weights[t, e] > 0) for w, f in hits.items()}
        hits = {w: f for w, f in kept.items() if f}
    found = [Counter(evidence(t, hits)) if hits and not hits.keys().isdisjoint(ws) else Counter() for t, ws in zip(texts, split)]
    return found, [len(ws) for ws in split]


STEP_CHARS = 4 << 20


def score(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, score (0 to 1), n_hits (different terms found), terms (their list)."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        matcher = m.matcher()
        for batch in batches:
            ids, texts, lo, size = batch.column(0), [], 0, 0
            for i in range(batch.num_rows):
                texts.append(batch.column(1)[i].as_py())
                size += len(texts[-1] or "")
                if size >= STEP_CHARS or i + 1 == batch.num_rows:
                    found, n = _document_hits(texts, matcher, m.weights)
                    x = np.array([sums(h, k, m.weights, m.rates) for h, k in zip(found, n)])
                    p = 1 / (1 + np.exp(-np.clip(x @ m.sums + m.intercept, -30, 30)))
                    named = [sorted({m.terms[t][0] for t, _, _, _ in h}) for h in found]
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(lo, len(texts)), pa.array(p), pa.array(map(len, named), pa.int64()),
                         pa.array(named, pa.list_(pa.string()))], names=["doc_id", "score", "n_hits", "terms"])
                    texts, lo, size = [], i + 1, 0

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double, n_hits long, terms array<string>")


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, n_hits; learned from the rows outside the fold."""
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 0
    model = train(docs.where(~fold).select("doc_id", "text"), labels.where(~fold & F.col("doc_id").isNotNull()))
    return score(docs, model).select("doc_id", fold.alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits")
