"""Benchmark decontamination by winnowing.

Texts become words: ASCII letters lower-cased, digits and every character
beyond ASCII; anything else separates. A test *window* is ``window``
consecutive words of a benchmark item, or the whole item if it has fewer.

For windows of n words, grams of k words are hashed and of every w
consecutive grams the least is kept (the last one among equals), with
k + w - 1 = n: a shared span of n words holds the same w grams on both
sides, so both keep the same gram of it - no shared window escapes. Items
shorter than the window get a class of their own length by the same rule.

The fingerprints of the benchmark are joined with those of a document where
the document is read, in the scan task, so no text is
shuffled and a document with many hits, or a passage in a third of all
documents, stays a local matter. The benchmark is a query set that is run
against all rows in blocks of at most ``block_bytes`` of item text. One block is
broadcast. More are files in the shared folder: a task reads some
``HELD_BYTES`` of its documents, runs them against one block after the other and
holds the index of one block at a time. Each meeting
gram is extended to the left and the right along its diagonal, by at most a
window, and the words of the extended hit are compared byte by byte.

Cases: null or empty text has no words and no hit; an item without words or
with a null id is ignored; repeated items count once (items are told apart by
their id); an empty benchmark leaves every document clean; repeated documents
give equal rows; further columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.llm.common import as_row, binary_column, read_shared, shared_folder, ship, steps

WINDOW = 10
# Item text of one broadcast block.
BLOCK_BYTES = 32 << 20
# Documents that a task runs against all blocks at a time.
HELD_BYTES = 64 << 20

_MULT = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2^64


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def _word_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[48:58] = True
    t[97:123] = True
    t[128:] = True
    return t


_LOWER, _IS_WORD = _lower_table(), _word_table()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the multiplier and of its inverse, grown on demand."""

    up = np.zeros(0, np.uint64)
    down = np.zeros(0, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_MULT, n), _powers(pow(_MULT, -1, 2**64), n)
        return cls.up, cls.down


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(lowered bytes, word starts, word ends, word hashes, first word of each text) of adjoining UTF-8 texts."""
    base = int(offsets[0])
    low = _LOWER[raw[base:int(offsets[-1])]]
    bounds = offsets - base
    is_word = _IS_WORD[low]
    before = np.zeros(len(low), bool)
    before[1:] = is_word[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(low))]
    before[inner] = False
    after = np.zeros(len(low), bool)
    after[:-1] = is_word[1:]
    after[inner - 1] = False
    starts = np.flatnonzero(is_word & ~before)
    ends = np.flatnonzero(is_word & ~after) + 1
    up, down = _Powers.get(len(low) + 1)
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:len(low)], out=sums[1:])
    h = _mix((sums[ends] - sums[starts]) * down[starts])
    return low, starts, ends, h, np.searchsorted(starts, bounds)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shape(n: int) -> tuple[int, int]:
    """(k, w) of a window of n words: k + w - 1 = n."""
    w = max(1, n // 2)
    return n - w + 1, w


def winnow(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes) kept of adjoining texts whose words have hashes ``h``; ``first``: the word at which
    each text starts, and the end."""
    k, w = shape(n)
    total = len(h) - n + 1
    if total <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    m = len(h) - k + 1
    gram = np.zeros(m, np.uint64)
    for j in range(k):
        gram = gram * np.uint64(_MULT) + h[j:j + m]
    gram = _mix(gram)
    least, at = gram[:total].copy(), np.arange(total)
    for j in range(1, w):
        c = gram[j:j + total]
        better = c <= least
        least[better] = c[better]
        at[better] = np.flatnonzero(better) + j
    inside = np.ones(total, bool)  # windows that don't cross into the next text
    for b in first[1:-1] if len(first) < 4096 else ():
        inside[max(0, b - n + 1):b] = False
    if len(first) >= 4096:
        text = np.searchsorted(first, np.arange(len(h)), side="right")
        inside = text[:total] == text[n - 1:]
    keep = np.zeros(m, bool)
    keep[at[inside]] = True
    pos = np.flatnonzero(keep)
    return pos, gram[pos]


class Index:
    """Fingerprints of a block of items: per window length the sorted grams with (item, word) of each."""

    def __init__(self, items: list[tuple[int, bytes]], window: int):
        self.ids, self.words, hashes = [], [], []
        for item_id, text in items:
            raw = np.frombuffer(text, np.uint8)
            low, s, e, h, _ = words_of(raw, np.array([0, len(raw)]))
            if len(h):
                self.ids.append(item_id)
                self.words.append([bytes(low[a:b]) for a, b in zip(s, e)])
                hashes.append(h)
        self.first = np.cumsum([0] + [len(h) for h in hashes])
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        by_length = defaultdict(list)
        for i, h in enumerate(hashes):
            n = min(window, len(h))
            pos, gram = winnow(h, np.array([0, len(h)]), n)
            by_length[n].append((gram, np.full(len(pos), i), self.first[i] + pos))
        self.grams = {}
        for n, parts in by_length.items():
            gram, item, word = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(gram, kind="stable")
            self.grams[n] = gram[order], item[order], word[order]

    def hits(self, low, starts, ends, h, first) -> set[tuple[int, int, int]]:
        """(first word, end word, item) of every maximal shared span found, word numbers over all given texts."""
        found: set[tuple[int, int, int]] = set()
        checked: dict[tuple[int, int], bool] = {}
        for n, (grams, item, word) in self.grams.items():
            pos, gram = winnow(h, first, n)
            lo, hi = np.searchsorted(grams, gram, side="left"), np.searchsorted(grams, gram, side="right")
            some = np.flatnonzero(hi > lo)
            if not len(some):
                continue
            k, _ = shape(n)
            for a in range(0, len(some), 4096):
                part = some[a:a + 4096]
                reps = hi[part] - lo[part]
                p = np.repeat(pos[part], reps)
                at = np.repeat(lo[part], reps) + np.arange(len(p)) - np.repeat(np.cumsum(reps) - reps, reps)
                q, it = word[at], item[at]
                text = np.searchsorted(first, p, side="right") - 1
                left, right = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
                going = np.ones(len(p), bool)
                for j in range(1, n - k + 1):
                    going = going & (p - j >= first[text]) & (q - j >= self.first[it])
                    going[going] = h[p[going] - j] == self.hash[q[going] - j]
                    left += going
                going = np.ones(len(p), bool)
                for j in range(k):
                    going[going] = h[p[going] + j] == self.hash[q[going] + j]
                same = going.copy()
                for j in range(k, n):
                    going = going & (p + j < first[text + 1]) & (q + j < self.first[it + 1])
                    going[going] = h[p[going] + j] == self.hash[q[going] + j]
                    right += going
                for i in np.flatnonzero(same & (left + k + right >= n)):
                    s, e, j = int(p[i] - left[i]), int(p[i] + k + right[i]), int(it[i])
                    off = int(q[i] - left[i] - self.first[j]) - s
                    if all(self._equal(checked, low, starts, ends, x, j, x + off) for x in range(s, e)):
                        found.add((s, e, j))
        return found

    def _equal(self, checked, low, starts, ends, x: int, item: int, w: int) -> bool:
        word = self.words[item][w]
        known = checked.get((x, word))
        if known is None:
            known = checked[x, word] = bytes(low[starts[x]:ends[x]]) == word
        return known


def _blocks(benchmark: DataFrame, text: str, id_col: str, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    items = benchmark.where(F.col(text).isNotNull() & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).cast("long").alias("i"), F.col(text).cast("string").alias("t")).distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes)
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b) if n > 1 else items
        yield sorted((r.i, r.t.encode()) for r in part.toLocalIterator())


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
         item_text: str = "text", item_id: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), n_words, spans (first and end word of each shared span, one after
    the other), items (ids of the items with a shared window, ascending)."""
    spark = docs.sparkSession
    ship(spark)
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("n_words", T.LongType()), T.StructField("spans", longs),
                           T.StructField("items", longs)])
    src = docs.select(as_row(docs), F.lit(0).cast("long").alias("n_words"), F.array().cast("array<long>").alias("spans"),
                      F.array().cast("array<long>").alias("items"))
    at = docs.columns.index(text)
    folder, n = shared_folder(spark, "benchmark-blocks"), 0
    blocks = _blocks(benchmark, item_text, item_id, block_bytes)
    block = next(blocks, None)
    while block is not None:
        spark.createDataFrame(block, _ITEMS).coalesce(1).write.parquet(f"{folder}/{n}")
        del block  # the driver holds one block at a time
        n += 1
        block = next(blocks, None)
    if n <= 1:
        only = [tuple(r) for r in spark.read.schema(_ITEMS).parquet(f"{folder}/0").collect()] if n else []
        held = spark.sparkContext.broadcast(only)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(held.value, window)
            for batch in batches:
                yield from _scan_batch(batch, index, at)
    else:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _parts(batches):
                for b in range(n):
                    items = read_shared(f"{folder}/{b}").to_pylist()
                    index = Index([(r["i"], r["t"]) for r in items], window)
                    part = [x for batch in part for x in _scan_batch(batch, index, at)]
                yield from part

    return src.mapInArrow(run, schema)


_ITEMS = "i long, t binary"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The batches in groups of about ``HELD_BYTES``."""
    part, size = [], 0
    for batch in batches:
        part.append(batch)
        size += batch.nbytes
        if size >= HELD_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _scan_batch(batch: pa.RecordBatch, index: Index, at: int) -> Iterator[pa.RecordBatch]:
    raw, offsets = binary_column(batch.column(0).field(at))
    spans_before, items_before = batch.column(2).to_pylist(), batch.column(3).to_pylist()
    for lo, hi in steps(offsets):
        low, starts, ends, h, first = words_of(raw, offsets[lo:hi + 1])
        spans, items = defaultdict(set), defaultdict(set)
        for s, e, j in index.hits(low, starts, ends, h, first):
            d = int(np.searchsorted(first, s, side="right")) - 1
            spans[d].add((s - int(first[d]), e - int(first[d])))
            items[d].add(index.ids[j])
        yield pa.RecordBatch.from_arrays([
            batch.column(0).slice(lo, hi - lo),
            pa.array(np.diff(first)),
            pa.array([spans_before[lo + d] + [x for se in sorted(spans[d]) for x in se] if d in spans
                      else spans_before[lo + d] for d in range(hi - lo)], pa.list_(pa.int64())),
            pa.array([sorted({*items_before[lo + d], *items[d]}) if d in items
                      else items_before[lo + d] for d in range(hi - lo)], pa.list_(pa.int64())),
        ], names=["row", "n_words", "spans", "items"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark."""
    found = scan(docs, benchmark, window).where(F.size("items") == 0)
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside a shared window), n_items, items_sha256, contaminated."""
    found = scan(docs.select("doc_id", "text"), benchmark, window).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "spans", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, n_items, digest = [], [], []
            for spans, items in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                n_hit.append(covered(spans))
                n_items.append(len(items))
                digest.append(hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()),
                 pa.array(digest, pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_())],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return found.mapInArrow(
        run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def covered(spans: list[int]) -> int:
    """Words under the union of the spans."""
    total, end = 0, 0
    for s, e in sorted(zip(spans[::2], spans[1::2])):
        total += max(0, e - max(s, end))
        end = max(end, e)
    return total


# Windows as lists of words, joined by equality; the pattern is that of the words after lower-casing A-Z.
ORACLE = r"""
WITH d0 AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT rid, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d0),
b0 AS (SELECT DISTINCT item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark
  WHERE text IS NOT NULL AND item_id IS NOT NULL),
b1 AS (SELECT item_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM b0),
b2 AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM b1 WHERE len(ws) > 0),
b AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) AS w FROM b2),
lens AS (SELECT DISTINCT n FROM b),
g AS (SELECT rid, n, unnest(range(1, len(ws) - n + 2)) AS pos,
    unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) AS w
  FROM d JOIN lens ON len(ws) >= n),
hit AS (SELECT rid, item_id, pos, g.n FROM g JOIN b ON b.w = g.w AND b.n = g.n),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + n)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""
