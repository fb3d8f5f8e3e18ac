"""Exact duplicates by a Golomb-coded fingerprint exchange.

1. Each partition fingerprints its normalised texts (64 bits), sorts the different fingerprints and sends each *owner* (an
   equal share of the hash range) its part as Rice-coded gaps, the Golomb code for a power of two, with a bit for each that
   tells whether the sender has it more than once.
2. An owner merges what the senders sent it, finds the fingerprints that occur more than once over all senders, and
   returns to each sender a bitmap over the order in which it sent them.
3. A sender's suspects are the documents whose bit is set. The sender reads its partition again, lets only suspects
   through, and only their texts are compared byte by byte: the least and the greatest text of each fingerprint, found
   per task before the shuffle. If they are equal, all of its texts are, and they form the group; should two texts share a
   fingerprint, the members of that fingerprint are grouped by their whole text. If the partitions of the second reading are not those of the first (a changed
   layout), fewer suspects come through than were flagged; then a semi join on the fingerprint finds them.

A group of copies is never gathered: a sender sends a fingerprint once however many copies it has, texts and smallest ids
are compared by partial aggregates, and a group's rows meet its one summary row in a join whose sides are written, so
that it is broadcast or its large keys are split. Owners get a bounded number of fingerprints: there are as many
owners as ``OWNER_FINGERPRINTS`` asks for, and a task ranks the rows of one sender or a few.

Cases: null counts as empty; empty texts equal each other; of equal texts the row with the smallest doc_id stays
(a null id only if there is no other); repeated rows with the same id: one of them is kept (``kept``), the other shares
its keep_id; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyarrow import parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm.common import collapsed, shared_folder, ship, written
from furrow.session import ensure_checkpoint_dir

# Fingerprints that one owner is to hold at a time, on average.
OWNER_FINGERPRINTS = 1 << 20


def rice_encode(sorted_values: np.ndarray) -> tuple[int, bytes]:
    """(parameter, code) of ascending uint64 values: gaps as unary quotient and binary remainder."""
    if not len(sorted_values):
        return 0, b""
    gaps = np.diff(sorted_values, prepend=np.uint64(0)).astype(np.uint64)
    mean = max(1, int(sorted_values[-1]) // len(sorted_values))
    k = max(0, min(62, mean.bit_length() - 1))
    q = (gaps >> np.uint64(k)).astype(np.int64)
    stop = np.cumsum(q + 1) - 1  # where the unary part of each gap ends
    unary = np.zeros(int(stop[-1]) + 1, np.uint8)
    unary[stop] = 1
    rest = (gaps & np.uint64((1 << k) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)
    binary = np.unpackbits(rest, axis=1, bitorder="little", count=None)[:, :k]
    head = np.packbits(unary, bitorder="little").tobytes()
    return k, head + np.packbits(binary.ravel(), bitorder="little").tobytes()


def rice_decode(code: bytes, k: int, n: int) -> np.ndarray:
    """The ``n`` values of a code."""
    if not n:
        return np.zeros(0, np.uint64)
    bits = np.unpackbits(np.frombuffer(code, np.uint8), bitorder="little")
    binary_bytes = -(-n * k // 8)
    head = bits[:8 * (len(code) - binary_bytes)]
    stop = np.flatnonzero(head)[:n]
    q = np.diff(stop, prepend=-1) - 1
    wide = np.zeros((n, 64), np.uint8)
    wide[:, :k] = bits[8 * (len(code) - binary_bytes):][:n * k].reshape(n, k)
    rest = np.packbits(wide, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)
    return np.cumsum((q.astype(np.uint64) << np.uint64(k)) + rest, dtype=np.uint64)


def _sort_and_rank(owners: int):
    """Rows in order of sender and fingerprint, with owner, rank among the sender's rows for that owner, and place of the
    fingerprint among the different ones that it sends there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        fp = t.column("fp").to_numpy().view(np.uint64)
        sender = t.column("sender").to_numpy()
        order = np.lexsort((fp, sender))
        owner = ((fp[order] >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)
        place = np.arange(len(fp))
        new = np.r_[True, (np.diff(owner) != 0) | (np.diff(sender[order]) != 0)]
        rank = place - np.maximum.accumulate(np.where(new, place, 0))
        other = np.cumsum(new | np.r_[True, fp[order][1:] != fp[order][:-1]])
        at = other - np.maximum.accumulate(np.where(new, other, 0))
        t = t.take(pa.array(order))
        for name, col in (("owner", owner), ("rank", rank), ("place", at)):
            t = t.append_column(name, pa.array(col, pa.int64()))
        yield from t.to_batches(max_chunksize=20_000)

    return run


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One coded list of different fingerprints per (sender, owner) from the ranked rows, with the bits of those that occur
    more than once there."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held).combine_chunks()
    sender, owner = t.column("sender").to_numpy(), t.column("owner").to_numpy()
    fp = t.column("fp").to_numpy().view(np.uint64)
    cuts = np.flatnonzero((np.diff(owner) != 0) | (np.diff(sender) != 0)) + 1
    rows = []
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(fp)]):
        different, times = np.unique(fp[lo:hi], return_counts=True)
        k, code = rice_encode(different)
        rows.append((int(sender[lo]), int(owner[lo]), len(different), k, code, np.packbits(times > 1, bitorder="little").tobytes()))
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, ty) for c, ty in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
        names=["sender", "owner", "n", "k", "code", "multiple"])


def _find(sent: pd.DataFrame) -> pd.DataFrame:
    """An owner's answer: for each sender the bitmap of the fingerprints that occur more than once."""
    lists = [rice_decode(c, k, n) for c, k, n in zip(sent["code"], sent["k"], sent["n"])]
    every = np.sort(np.concatenate(lists))
    several = [v[np.unpackbits(np.frombuffer(m, np.uint8), count=len(v), bitorder="little").astype(bool)] for v, m in zip(lists, sent["multiple"])]
    twice = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *several]))
    maps = []
    for values in lists:
        at = np.searchsorted(twice, values)
        hit = np.zeros(len(values), bool)
        if len(twice):
            hit = twice[np.minimum(at, len(twice) - 1)] == values
        maps.append(np.packbits(hit, bitorder="little").tobytes() if hit.any() else None)
    return pd.DataFrame({"sender": sent["sender"], "owner": sent["owner"], "bitmap": maps})


def fingerprint_rows(src: DataFrame) -> DataFrame:
    """Every row of ``src`` (doc_id, norm, fp, sha) without its text, with its sender and ``suspect``: the
    fingerprint occurs more than once."""
    spark = src.sparkSession
    rows = src.select("doc_id", "fp", "sha", F.spark_partition_id().cast("long").alias("sender"))
    first = written(rows, "fingerprints")
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-first.count() // OWNER_FINGERPRINTS))
    ensure_checkpoint_dir(spark)
    senders = (first.agg(F.max("sender")).first()[0] or 0) + 1
    ranked = first.repartition(senders, "sender").mapInArrow(
        _sort_and_rank(owners), "doc_id long, fp long, sha binary, sender long, owner long, rank long, place long").checkpoint()
    sent = ranked.select("sender", "owner", "fp").mapInArrow(_send, "sender long, owner long, n long, k int, code binary, multiple binary")
    maps = sent.groupBy("owner").applyInPandas(_find, "sender long, owner long, bitmap binary").where("bitmap IS NOT NULL")
    byte = F.conv(F.hex(F.substring("bitmap", F.shiftright("place", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, F.pmod("place", F.lit(8)).cast("int"))
    return ranked.join(maps, ["sender", "owner"], "left").select(
        "doc_id", "fp", "sha", "sender", "rank", F.coalesce(bit == 1, F.lit(False)).alias("suspect"))


def suspect_texts(src: DataFrame, flagged: DataFrame) -> DataFrame:
    """(doc_id, norm, fp, sha) of the flagged rows. Each partition of ``src`` keeps the fingerprints that were returned
    to it as a sender; nothing else of the texts moves."""
    folder = shared_folder(src.sparkSession, "suspects")
    flagged.select("sender", "fp").repartition("sender").write.partitionBy("sender").parquet(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = arrow_fs.FileSystem.from_uri(folder) if "://" in folder else (arrow_fs.LocalFileSystem(), folder)
        mine = f"{root}/sender={TaskContext.get().partitionId()}"
        files = [f.path for f in system.get_file_info(arrow_fs.FileSelector(mine, allow_not_found=True))
                 if f.path.endswith(".parquet")]
        if not files:
            return
        wanted = np.unique(np.concatenate([parquet.read_table(f, filesystem=system, columns=["fp"]).column(0).to_numpy()
                                           for f in files]))
        for batch in batches:
            hit = np.isin(batch.column("fp").to_numpy(zero_copy_only=False), wanted)
            if hit.any():
                yield batch.filter(pa.array(hit))

    found = written(src.mapInArrow(run, src.schema), "texts")
    if found.count() == flagged.count():
        return found
    return src.join(flagged.select("fp").distinct(), "fp", "left_semi").select(*src.columns)


def exact_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", fingerprint=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).
    ``fingerprint``: a 64-bit hash of the normalised text."""
    ship(docs.sparkSession)
    norm = docs.select(F.col(id_col).cast("long").alias("doc_id"), collapsed(F.col(text).cast("string")).alias("norm"))
    src = norm.select("doc_id", "norm", fingerprint("norm").cast("long").alias("fp"), F.unhex(F.sha2("norm", 256)).alias("sha"))
    rows = written(fingerprint_rows(src), "rows")
    flagged = rows.where("suspect")
    texts = suspect_texts(src, flagged)

    # byte verification: all texts of a fingerprint are equal if the least and the greatest are
    split = written(texts.groupBy("fp").agg(F.min("norm").alias("least"), F.max("norm").alias("greatest"))
                    .where(F.col("least") != F.col("greatest")).select("fp"), "split")

    groups = written(flagged.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sender", "rank")).alias("k"),
        F.count("*").alias("group_size")), "groups")
    is_first = (F.col("sender") == F.col("k.sender")) & (F.col("rank") == F.col("k.rank"))
    same = flagged.join(split, "fp", "left_anti").join(groups, "fp").select(
        "doc_id", F.col("k.doc_id").alias("keep_id"), "group_size", is_first.alias("kept"), "sha")
    w = Window.partitionBy("fp", "norm")
    other = texts.join(split, "fp", "left_semi").select(
        "doc_id", F.first("doc_id").over(w.orderBy(F.col("doc_id").asc_nulls_last())).alias("keep_id"),
        F.count("*").over(w).alias("group_size"),
        (F.row_number().over(w.orderBy(F.col("doc_id").asc_nulls_last())) == 1).alias("kept"), "sha")
    alone = rows.where(~F.col("suspect")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    return alone.union(same).union(other).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256 FROM n
"""
