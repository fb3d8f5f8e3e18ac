"""Ranked lexical search over document FP-trees.

Terms are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII. The queries are a stated set (the
items) that is run against all documents in blocks of at most ``block_terms`` distinct terms.

For a block each document becomes a *restricted vector*: its counts of the block's terms. In the tasks that search, up
to ``TREE_DOCS`` vectors at a time form an FP-tree: every vector is ordered by falling document frequency, vectors that
begin alike share a path, and chains without a fork are one node. Subtrees of at most ``LEAF_DOCS`` documents are kept
as one leaf. Each node knows, for each term, the largest count in its subtree and the least length factor m. A term's
part of the score grows with the count and falls with m, so these give an upper bound for every document below.

An item is answered depth first, the child of the largest bound first; a subtree whose bound is below the score of
the item's k-th best document so far is left out (one that equals it is not: ties go to the smaller doc_id). The best k of
each task meet in a ranking per item, reduced per task before the shuffle.

Scores: with N documents that have a term, L all their terms, n those of one document and df the documents that hold a term,
w = floor(1000 ln((2N+2)/(2df+1))), m = 25 + (75 n N) div L, score = sum of w ((10^9 tf) div (1000 tf + 8 m)) over the item's
terms, repeats included; integers but for the logarithm.

Cases: a null or blank text has no terms and is never found; an item without terms, or whose terms occur nowhere, has no
rows; repeated items (same id and text) are one; an id with several texts is ranked for each text; a null doc_id ranks
after the others of its score; repeated documents rank each on its own; empty tables give no rows; further columns are
ignored. Memory of a task: one tree, (documents + nodes) x terms of a block.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm.common import binary_column, ship, steps, written
from furrow.llm.decontam import words_of

TOP = 10
BLOCK_TERMS = 8192
TREE_DOCS = 8192
LEAF_DOCS = 32

# Fixed constants of the scoring rule.
GAIN, TF_SCALE, M_SCALE, LENGTH_PART, WEIGHT_SCALE = 10**9, 1000, 8, 75, 1000

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: str) -> list[bytes]:
    """The terms of a text, in order."""
    return _TERM.findall(text.encode("utf-8", "surrogatepass").lower())


@dataclass
class Block:
    """Items that are searched together: (key, term -> repeats) each, and their distinct terms in order of hash."""

    items: list[tuple[int, dict[int, int]]]
    words: list[bytes]
    hashes: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[int, Counter]]) -> Block:
        words = sorted({w for _, c in items for w in c})
        raw = np.frombuffer(b" ".join(words), np.uint8)
        h = words_of(raw, np.array([0, len(raw)]))[3] if words else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        at = {words[j]: i for i, j in enumerate(order.tolist())}
        return cls([(k, {at[w]: n for w, n in c.items()}) for k, c in items], [words[j] for j in order], h[order])


def blocks(items: list[tuple[int, str]], limit: int) -> Iterator[Block]:
    """Items in blocks of at most ``limit`` distinct terms; a larger item is a block of its own."""
    held, words = [], set()
    for key, text in items:
        c = Counter(terms_of(text))
        if held and len(words | c.keys()) > limit:
            yield Block.of(held)
            held, words = [], set()
        if c:
            held.append((key, c))
            words |= c.keys()
    if held:
        yield Block.of(held)


def vectors(docs: DataFrame, block: Block, text: str, id_col: str) -> DataFrame:
    """doc_id, n (terms), terms and tfs (numbers and counts of the block's terms) of each document that has a term."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((block.words, block.hashes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hashes = held.value
        flat = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.array([len(w) for w in words], np.int64)
        begins = np.cumsum(lengths) - lengths
        for batch in batches:
            raw, offsets = binary_column(batch.column(1))
            for lo, hi in steps(offsets):
                low, s, e, h, first = words_of(raw, offsets[lo:hi + 1])
                at = np.searchsorted(hashes, h) if len(hashes) else np.zeros(len(h), np.int64)
                at[at == len(hashes)] = 0
                here = np.flatnonzero((hashes[at] == h) & (lengths[at] == e - s)) if len(hashes) else np.zeros(0, np.int64)
                same, left = np.ones(len(here), bool), np.arange(len(here))
                j = 0
                while len(left):  # byte by byte, so that equal hashes of different words don't count
                    same[left] &= low[s[here[left]] + j] == flat[begins[at[here[left]]] + j]
                    j += 1
                    left = left[lengths[at[here[left]]] > j]
                here = here[same]
                doc = np.searchsorted(first, here, side="right") - 1
                key, count = np.unique(doc * len(words) + at[here], return_counts=True)
                n = np.diff(first)
                bounds = np.searchsorted(key, np.arange(hi - lo + 1) * len(words)).astype(np.int32)
                term = (key % len(words) if len(words) else key).astype(np.int32)
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(term)),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(count.astype(np.int32)))],
                    names=["doc_id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class Tree:
    """FP-tree of restricted vectors. Documents stand in the order of their paths, so that a subtree is a range."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, width: int):
        """Entries (doc, term, tf) grouped by document, the terms of each in path order; ``m`` of each document."""
        n = len(m)
        bounds = np.searchsorted(doc, np.arange(n + 1))
        big = term.astype(">u4").tobytes()
        path = [big[4 * a:4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        order = sorted(range(n), key=path.__getitem__)
        self.row = np.array(order, np.int64)
        size = np.diff(bounds)[self.row]
        self.entry = np.concatenate([[0], np.cumsum(size)])
        pick = np.repeat(bounds[self.row] - self.entry[:-1], size) + np.arange(self.entry[-1])
        self.term, self.tf = term[pick], tf[pick].astype(np.int64)
        self.m = m[self.row]
        self.children: list[list[int]] = []
        self.ranges: list[tuple[int, int]] = []
        self._grow([path[i] for i in order])
        self.most = np.zeros((len(self.ranges), width), np.int32)
        self.least = np.zeros(len(self.ranges), np.int64)
        for node in range(len(self.ranges) - 1, -1, -1):  # children have larger numbers
            a, b = self.ranges[node]
            if below := self.children[node]:
                np.max(self.most[below], axis=0, out=self.most[node])
            else:
                e = slice(self.entry[a], self.entry[b])
                np.maximum.at(self.most[node], self.term[e], self.tf[e].astype(np.int32))
            self.least[node] = self.m[a:b].min()

    def _grow(self, path: list[bytes]) -> None:
        """Nodes from the paths in order: forks are where neighbours stop sharing."""
        self.ranges.append((0, len(path)))
        self.children.append([])
        todo = [(0, 0)]
        while todo:
            node, depth = todo.pop()
            a, b = self.ranges[node]
            if b - a <= LEAF_DOCS:
                continue
            # the range shares what its first and last path share
            x, y = path[a], path[b - 1]
            while depth < min(len(x), len(y)) and x[depth:depth + 4] == y[depth:depth + 4]:
                depth += 4
            parts, at = [], a
            while at < b:
                head = path[at][depth:depth + 4]
                lo, hi = at + 1, b  # first path with another term here
                while lo < hi:
                    mid = (lo + hi) // 2
                    if path[mid][depth:depth + 4] == head:
                        lo = mid + 1
                    else:
                        hi = mid
                parts.append((at, lo))
                at = lo
            if len(parts) == 1:  # equal paths: halves
                parts = [(a, (a + b) // 2), ((a + b) // 2, b)]
            merged: list[tuple[int, int]] = []  # small neighbours share a leaf
            for p in parts:
                if merged and p[1] - merged[-1][0] <= LEAF_DOCS:
                    merged[-1] = (merged[-1][0], p[1])
                else:
                    merged.append(p)
            for p in merged:
                self.children[node].append(len(self.ranges))
                todo.append((len(self.ranges), depth))
                self.ranges.append(p)
                self.children.append([])

    def search(self, terms: np.ndarray, weight: np.ndarray, best: list[tuple], ids: list, k: int) -> None:
        """Offer the documents to ``best``, a heap of the k best (score, -doc_id or none, doc_id)."""
        place = np.full(self.most.shape[1], -1, np.int64)
        place[terms] = np.arange(len(terms))

        def bound(nodes: list[int]) -> list[int]:
            t = self.most[np.ix_(nodes, terms)].astype(np.int64)
            gain = GAIN * t // np.maximum(TF_SCALE * t + M_SCALE * self.least[nodes][:, None], 1)
            return (gain * weight).sum(axis=1).tolist()

        todo = list(zip(bound([0]), [0]))
        while todo:
            b, node = todo.pop()
            if b <= 0 or (len(best) == k and b < best[0][0]):
                continue
            if below := self.children[node]:
                todo += sorted(zip(bound(below), below))
                continue
            lo, hi = self.ranges[node]
            e0, e1 = self.entry[lo], self.entry[hi]
            at = place[self.term[e0:e1]]
            some = np.flatnonzero(at >= 0)
            doc = np.searchsorted(self.entry, e0 + some, side="right") - 1
            t = self.tf[e0 + some]
            part = weight[at[some]] * (GAIN * t // (TF_SCALE * t + M_SCALE * self.m[doc]))
            score = np.zeros(hi - lo, np.int64)
            np.add.at(score, doc - lo, part)
            least = best[0][0] if len(best) == k else 1
            for i in np.flatnonzero(score >= max(least, 1)).tolist():
                offer(best, int(score[i]), ids[self.row[lo + i]], k)


def offer(best: list[tuple], score: int, doc_id: int | None, k: int) -> None:
    """A document to the heap of the k best: higher score, then smaller doc_id, null last."""
    entry = (score, doc_id is not None, -(doc_id or 0))
    if len(best) < k:
        heapq.heappush(best, entry)
    elif entry > best[0]:
        heapq.heapreplace(best, entry)


def _search_block(docs: DataFrame, block: Block, k: int, text: str, id_col: str) -> DataFrame:
    """key, doc_id, score: at least the k best of every item of the block."""
    spark = docs.sparkSession
    found = written(vectors(docs, block, text, id_col), "search-vectors")
    total = found.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    n_docs, n_terms = total.n, total.l or 0
    df = dict(found.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # as many as the block's terms
    by_df = sorted(df, key=lambda t: (-df[t], t))
    rank = np.zeros(max(len(block.words), 1), np.int64)
    rank[np.array(by_df, np.int64)] = np.arange(len(by_df))
    w = {t: math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
    items = [(key, [(int(rank[t]), w[t] * c) for t, c in terms.items() if t in df]) for key, terms in block.items]
    held = spark.sparkContext.broadcast((rank, [x for x in items if x[1]], max(len(by_df), 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, items, width = held.value
        plans = [(key, np.array([t for t, _ in ts]), np.array([x for _, x in ts], np.int64), []) for key, ts in items]

        def answer(part: pa.Table) -> None:
            ids = part.column("doc_id").to_pylist()
            n = part.column("n").to_numpy()
            m = 100 - LENGTH_PART + LENGTH_PART * n * n_docs // n_terms
            terms = part.column("terms").combine_chunks()
            offs = terms.offsets.to_numpy()
            doc = np.repeat(np.arange(len(ids)), np.diff(offs))
            term = rank[terms.values.to_numpy()[offs[0]:offs[-1]]]
            tfs = part.column("tfs").combine_chunks()
            tf = tfs.values.to_numpy()[tfs.offsets[0].as_py():tfs.offsets[len(tfs)].as_py()]
            order = np.lexsort((term, doc))
            tree = Tree(doc[order], term[order], tf[order], m, width)
            for _, at, weight, best in plans:
                tree.search(at, weight, best, ids, k)

        waiting, rows = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, TREE_DOCS):
                part = batch.slice(a, TREE_DOCS)
                if rows + part.num_rows > TREE_DOCS:
                    answer(pa.Table.from_batches(waiting).combine_chunks())
                    waiting, rows = [], 0
                waiting.append(part)
                rows += part.num_rows
        if rows:
            answer(pa.Table.from_batches(waiting).combine_chunks())
        out = [(key, -neg if known else None, score) for key, _, _, best in plans for score, known, neg in best]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)],
                                         names=["key", "doc_id", "score"])

    return found.where(F.size("terms") > 0).mapInArrow(run, "key long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, text: str = "text", id_col: str = "doc_id",
           item_text: str = "text", item_id: str = "item_id", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Per item the k best documents: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    ship(spark)
    asked = queries.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")) \
        .where(F.col("text").isNotNull()).distinct()
    # numbered by a written id, so that every later read gives an item the same key
    asked = written(asked.withColumn("key", F.monotonically_increasing_id()), "search-items")
    listed = ((r.key, r.text) for r in asked.select("key", "text").orderBy("key").toLocalIterator())
    found = None
    for block in blocks(listed, block_terms):
        part = _search_block(docs, block, k, text, id_col)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = spark.createDataFrame([], "key long, doc_id long, score long")
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH d0 AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
d AS (SELECT doc_id, rid, ws, len(ws)::HUGEINT AS n FROM d0 WHERE len(ws) > 0),
s AS (SELECT count(*)::HUGEINT AS nd, sum(n)::HUGEINT AS l FROM d),
b0 AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
b1 AS (SELECT row_number() OVER () AS key, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM b0),
q AS (SELECT key, item_id, t, count(*) AS c FROM (SELECT key, item_id, unnest(ws) AS t FROM b1) GROUP BY ALL),
tf AS (SELECT rid, t, count(*)::HUGEINT AS tf FROM (SELECT rid, unnest(ws) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::HUGEINT AS w FROM tf, s GROUP BY t),
m AS (SELECT rid, doc_id, 25 + (75 * n * nd) // l AS m FROM d, s),
sc AS (SELECT key, item_id, rid, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS score
  FROM q JOIN w USING (t) JOIN tf USING (t) JOIN m USING (rid) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM sc WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM r WHERE rank <= 10
"""
