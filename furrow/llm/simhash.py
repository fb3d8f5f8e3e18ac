"""SimHash near-duplicates by anchor-point covering.

Every document gets a 64-bit SimHash of its word shingles. Anchors are the
codewords of a product of perfect covering codes (binary Golay [23,12],
radius 3, on the first blocks; Hamming [15,11], radius 1, on a third block
for very large corpora); bits outside the blocks are left to the comparison.
A fingerprint's *home* is the anchor within the covering radius of each
block. It is replicated to every anchor that a change of at most
``max_distance`` bits could make its home, that is all anchors within radius
plus threshold, so each pair within the threshold meets at the home of
either. At an anchor, homes are compared with replicas by the population
count of the XOR.

Dense places: an anchor with more than ``HOT_HOMES`` homes is not compared
pair by pair. Its members go to the finest covering code, all 2^64 words with
radius zero, each to the words within half the threshold. Members of one
word are then within the threshold of each other, at most 65 of them, and
linked in a star. No link is lost: two fingerprints within two bits share
such a word. The pair comparison is therefore linear in the replicas
(``HOT_HOMES`` times at most), the star linear in the fingerprints.

Links are merged into components by alternating large-star and small-star
rounds on written tables; nothing is collected to the driver.

Cases: null or wordless text has fingerprint 0 and is linked like any other;
fewer words than a shingle: the whole sequence is the only shingle; a
repeated row gets the same result as its twin; a null doc_id keeps its row
and is ignored by the smallest-id rule (null only if no id is reachable); an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import as_row, quoted, ship, written

SHINGLE = 3
MAX_DISTANCE = 2
HASH_SEED = 42
# Homes an anchor may have before its members are split over single words.
HOT_HOMES = 64
# Shingles whose bits are counted at a time.
BITS_STEP = 1 << 14


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    from xxhash import xxh64_intdigest as digest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    if len(words) <= shingle:
        return digest(joined, HASH_SEED)
    starts = [0, *ends]
    hashes = np.fromiter(
        (digest(joined[a:b - 1], HASH_SEED) for a, b in zip(starts, ends[shingle - 1:])),
        dtype=np.uint64, count=len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), BITS_STEP):
        part = hashes[lo:lo + BITS_STEP].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, fp): the signed 64-bit pattern of every document's SimHash."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(v.as_buffer().to_pybytes() if v.is_valid else b"", shingle)
                            for v in batch.column(1).cast(pa.large_binary())], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, fp long")


@lru_cache(maxsize=8)
def _block(length: int, poly: int, parity: int, radius: int, threshold: int):
    """Tables of one cyclic perfect code: the syndrome of each single bit, and for each syndrome the error
    patterns of weight up to radius + threshold, ordered by what they cost beyond the radius."""
    def remainder(word: int) -> int:
        for i in range(length - 1, parity - 1, -1):
            if word >> i & 1:
                word ^= poly << (i - parity)
        return word

    unit = np.array([remainder(1 << i) for i in range(length)], np.int64)
    patterns = [((), 0, 0)] + [
        (c, sum(1 << i for i in c), max(0, w - radius))
        for w in range(1, radius + threshold + 1) for c in combinations(range(length), w)]
    syn = np.array([int(np.bitwise_xor.reduce(unit[list(c)])) if c else 0 for c, _, _ in patterns], np.int64)
    err = np.array([e for _, e, _ in patterns], np.int64)
    cost = np.array([k for _, _, k in patterns], np.int64)
    order = np.lexsort((cost, syn))
    syn, err, cost = syn[order], err[order], cost[order]
    first = np.searchsorted(syn, np.arange(1 << parity))
    upto = np.stack([np.bincount(syn[cost <= t], minlength=1 << parity) for t in range(threshold + 1)])
    return unit, err, cost, first, upto


GOLAY = (23, 0b101011100011, 11, 3)
HAMMING = (15, 0b10011, 4, 1)


def choose_code(n: int) -> tuple:
    """Blocks of the anchor code for ``n`` different fingerprints: enough anchors that a home is rarely shared
    by unrelated texts. Any choice gives the same links."""
    if n <= 1 << 14:
        return (GOLAY,)
    return (GOLAY, GOLAY) if n <= 1 << 30 else (GOLAY, GOLAY, HAMMING)


def anchors_of(fps: np.ndarray, code: tuple, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of every replica: the anchors that at most ``threshold`` changed bits make a home."""
    row = np.arange(len(fps))
    anchor = np.zeros(len(fps), np.int64)
    spent = np.zeros(len(fps), np.int64)
    shift = 0
    for length, poly, parity, radius in code:
        unit, err, cost, first, upto = _block(length, poly, parity, radius, threshold)
        word = ((fps >> np.uint64(shift)) & np.uint64((1 << length) - 1)).astype(np.int64)
        syn = np.zeros(len(fps), np.int64)
        for i in range(length):
            syn ^= np.where(word >> i & 1, unit[i], 0)
        n = upto[threshold - spent, syn[row]]
        at = np.repeat(np.arange(len(row)), n)
        k = first[syn[row]][at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        row, spent = row[at], spent[at] + cost[k]
        anchor = anchor[at] << (length - parity) | (word[row] ^ err[k]) >> parity
        shift += length
    return row, anchor


def replicas(fps: DataFrame, code: tuple, threshold: int) -> DataFrame:
    """(fp, anchor) for every anchor within radius plus threshold of each fingerprint; threshold 0: the home."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(values), 8192):
                part = values[lo:lo + 8192]
                row, anchor = anchors_of(part.view(np.uint64), code, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(part[row]), pa.array(anchor)], names=["fp", "anchor"])

    return fps.select("fp").mapInArrow(run, "fp long, anchor long")


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, hot_homes: int = HOT_HOMES) -> DataFrame:
    """(a, b), a > b: links between different fingerprints that join the same sets as all pairs within
    ``max_distance`` bits. ``fps`` has a column fp of distinct values."""
    if max_distance not in (1, 2):
        raise ValueError("the star at single words holds for 1 or 2 bits")
    code = choose_code(fps.count())
    homes = replicas(fps, code, 0).select("anchor", F.col("fp").alias("h"))
    hot = homes.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot_homes).select("anchor")
    # what waits at an anchor: its homes, or the mark (null) that its members are to be split
    waiting = homes.join(hot, "anchor", "left_anti").union(hot.select("anchor", F.lit(None).cast("long")))
    near = F.col("h").isNull() | (
        (F.col("fp") != F.col("h")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("h"))) <= max_distance))
    met = written(
        waiting.alias("x").hint("shuffle_hash")
        .join(replicas(fps, code, max_distance).alias("y"), (F.col("x.anchor") == F.col("y.anchor")) & near)
        .select("fp", "h"), "met")
    pairs = met.where("h IS NOT NULL").select(F.greatest("fp", "h").alias("a"), F.least("fp", "h").alias("b"))
    crowded = met.where("h IS NULL").select("fp").distinct()
    return pairs.union(_stars(crowded, max_distance)).distinct()


def _stars(fps: DataFrame, max_distance: int) -> DataFrame:
    """Links through the words of the space: to each word go the fingerprints equal to it or one bit away."""
    bits = F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)])
    at = fps.select("fp", F.explode(F.concat(F.array(F.lit(0).cast("long")), bits)).alias("flip"))
    at = at.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"), (F.col("flip") == 0).alias("exact"))
    if max_distance == 2:
        least = at.groupBy("word").agg(F.collect_set("fp").alias("s"))  # at most 65 by construction
        star = least.where(F.size("s") > 1).select(F.explode("s").alias("a"), F.array_min("s").alias("b"))
    else:
        least = at.groupBy("word").agg(F.collect_set("fp").alias("s"), F.max(F.when(F.col("exact"), F.col("fp"))).alias("c"))
        star = least.where(F.size("s") > 1).where("c IS NOT NULL").select(F.explode("s").alias("p"), "c") \
            .select(F.greatest("p", "c").alias("a"), F.least("p", "c").alias("b"))
    return star.where(F.col("a") > F.col("b"))


def components(edges: DataFrame) -> DataFrame:
    """(v, root): each linked value and the smallest value of its component, by large-star / small-star rounds."""
    edges = written(edges.select("a", "b"), "edges")
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = _mark(edges)
        if now == mark:
            return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
        mark = now


def _mark(edges: DataFrame):
    """Count and two order-free checksums of the edge set. The sum is a decimal: a LONG would overflow from some millions of
    edges on."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first())


def classes(by_doc: DataFrame, max_distance: int = MAX_DISTANCE, hot_homes: int = HOT_HOMES) -> DataFrame:
    """(fp, root, component_id) of the different fingerprints of ``by_doc`` (doc_id, fp)."""
    fps = written(by_doc.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(fps, max_distance, hot_homes))
    member = written(fps.join(roots, fps.fp == roots.v, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "members")
    # written, so that the members of a large component can be split over tasks in the join
    ids = written(member.groupBy("root").agg(F.min("first_id").alias("component_id")), "component-ids")
    return member.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                    hot_homes: int = HOT_HOMES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, fp (signed pattern), root, component_id (smallest doc_id reachable)."""
    by_doc = written(fingerprints(docs, shingle, text, id_col), "simhash")
    return by_doc.join(classes(by_doc, max_distance, hot_homes), "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest doc_id, one only even if that
    row is repeated; of a component without any doc_id, one row."""
    ship(docs.sparkSession)
    groups = written(near_duplicates(docs, shingle, max_distance), "groups")
    stay = groups.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("_furrow_rows"))
    kept = docs.join(stay.withColumnRenamed("doc_id", "_furrow_stay"), F.col("doc_id") == F.col("_furrow_stay"))
    columns = [quoted(c) for c in docs.columns]
    row, back = as_row(docs, "_furrow_row"), [F.col("_furrow_row")[c].alias(c) for c in docs.columns]
    whole = kept.where("_furrow_rows = 1").select(*columns)
    repeated = kept.where("_furrow_rows > 1").groupBy("doc_id").agg(F.min_by(row, F.xxhash64(*columns)).alias("_furrow_row"))

    @F.pandas_udf("long")
    def pattern(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash((t or "").encode(), shingle) for t in texts], np.uint64).view(np.int64))

    nameless = docs.where("doc_id IS NULL").withColumn("_furrow_fp", pattern("text"))
    alone = groups.where("component_id IS NULL").select(F.col("fp").alias("_furrow_fp"), F.col("root").alias("_furrow_root")).distinct()
    one = nameless.join(alone, "_furrow_fp").groupBy("_furrow_root").agg(F.min_by(row, F.xxhash64(*columns)).alias("_furrow_row"))
    return whole.union(repeated.select(*back)).union(one.select(*back))
