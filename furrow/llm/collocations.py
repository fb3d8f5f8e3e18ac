"""Phrase collocation mining with a bidirectional FM-index per shard.

Texts (ASCII letters lower-cased) are cut at ``. , ; : ! ?`` and line breaks into pieces, and those at spaces and tabs into
words. Everything is counted per language; null text counts as empty, null language as ``und``. Phrases are 2 to
``MAX_WORDS`` words within a piece.

A task cuts its documents at piece ends into *shards* of about ``shard_words`` words: word numbers in order, and the shard's
words with their counts. A phrase that occurs ``min_count`` times in all shards consists of words, and of pairs of words,
that do so too; so counts are summed over the shards level by level, and a shard goes on with what is frequent everywhere:

1. words: all others become separators;
2. pairs: the shard's index extends every word to the left by one symbol of its BWT interval;
3. longer phrases, in what is left of the sequence where two frequent pairs or more follow each other: pairs are extended in
   turn to the left and to the right. A phrase is a pair of intervals, one in the index of the sequence and one in that of the
   reversed sequence; extending on one side is a step of LF mapping there and a shift by the smaller symbols on the other,
   so counts come from interval widths alone.

The indexes sort suffixes by their first ``MAX_WORDS`` symbols, which is as deep as phrases go.

Sums: each shard sends every *owner* (a hash of word or phrase) one block of its sorted codes and counts; the owner adds them
up, lists what is frequent with a number, and answers each shard with its own frequent ones. Owners are as many as the
words of all shards need at ``OWNER_KEYS`` each, so a block, an owner and a shard are of bounded size whatever the corpus,
and a very common phrase is one entry of each shard. Counts over all shards are exact. No text, index or list of phrases
passes through the driver, which knows only how many words and pairs each owner found.

Scoring and selection are joins on the counted phrases: the lowest ``floor(SCALE * a / (l + r))`` over the cuts, the drop of
phrases inside a longer one that has ``DOMINATED`` percent of their occurrences, and the first ``top`` of each language.

Cases: empty or null texts have no words; repeated rows count each; a language without a candidate has no rows; an empty
table gives no rows; further columns are ignored. A single piece longer than a shard makes a longer shard. More than
3 * 10^9 different frequent words or pairs don't fit the codes and raise an error.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm.common import read_shared, shared_folder, ship, written

MAX_WORDS = 4
MIN_COUNT = 30
TOP = 2000
SCALE = 2_000_000
DOMINATED = 80
SHARD_WORDS = 1 << 20
# Codes that an owner adds up at a time; of words, which are larger, half as many.
OWNER_KEYS = 1 << 21

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_SPLIT = bytes.maketrans(_PIECE_ENDS, b"\n" * len(_PIECE_ENDS))

_SHARD = "shard long, seq binary, words binary, counts binary, n_words long, n_seq long, langs array<string>, totals array<long>"


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).view(kind).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.int64))


class _Ids(dict):
    """Numbers words in order of their first use, from a counter shared by the languages of a shard."""

    def __init__(self, names: list[bytes], tails: list[bytes], lang: str):
        super().__init__()
        self.names, self.tails, self.tail = names, tails, _named(lang)

    def __missing__(self, word: bytes) -> int:
        self.names.append(word)
        self.tails.append(self.tail)
        self[word] = n = len(self.names)
        return n


def _named(lang: str) -> bytes:
    """A language as the tail of a line."""
    return b"\t" + lang.replace("\\", "\\\\").replace("\n", "\\n").encode("utf-8", "surrogatepass")


def _language(tail: str) -> str:
    return tail if "\\" not in tail else "\\".join(x.replace("\\n", "\n") for x in tail.split("\\\\"))


def shards(docs: DataFrame, text: str, lang: str, shard_words: int) -> DataFrame:
    """A row for each shard: its sequence of word numbers from 1 (0 ends a piece); its words, each with its language, and their
    counts; and the words of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        names: list[bytes] = []
        tails: list[bytes] = []
        ids: dict[str, _Ids] = {}
        seq = [0]

        def row() -> pa.RecordBatch:
            s = np.array(seq, np.int32)
            counts = np.bincount(s, minlength=len(names) + 1)[1:]
            totals = {g: int(counts[np.fromiter(own.values(), np.int64, len(own)) - 1].sum()) for g, own in ids.items() if own}
            lines = zstandard.ZstdCompressor(level=1).compress(b"\n".join(map(bytes.__add__, names, tails)))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([pack(s)], pa.binary()), pa.array([lines], pa.binary()),
                 pa.array([pack(counts.astype(np.int32))], pa.binary()), pa.array([len(names)], pa.int64()),
                 pa.array([len(s)], pa.int64()), pa.array([list(totals)], pa.list_(pa.string())),
                 pa.array([list(totals.values())], pa.list_(pa.int64()))],
                names=["shard", "seq", "words", "counts", "n_words", "n_seq", "langs", "totals"])

        for batch in batches:
            for t, g in zip(batch.column(0), batch.column(1)):
                raw = t.as_py()
                if not raw:
                    continue
                g = g.as_py()
                to = ids.get(g)
                if to is None:
                    to = ids[g] = _Ids(names, tails, g)
                for piece in raw.encode("utf-8", "surrogatepass").lower().translate(_SPLIT).split(b"\n"):
                    if ws := piece.split():  # spaces and tabs: the other ASCII white space ends a piece
                        seq.extend(map(to.__getitem__, ws))
                        seq.append(0)
                    if len(seq) > shard_words:
                        yield row()
                        number += 1
                        names, tails, ids, seq = [], [], {}, [0]
                        to = ids[g] = _Ids(names, tails, g)
        if names:
            yield row()

    src = docs.select(F.col(text).cast("string").alias("text"),
                      F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    return src.mapInArrow(run, _SHARD)


class Index:
    """Bidirectional FM-index of a sequence over 1..width with separators 0, exact for phrases of up to ``depth`` words."""

    def __init__(self, seq: np.ndarray, width: int, depth: int = MAX_WORDS):
        self.width, self.depth = width, depth
        self.seq = seq.astype(np.int64)
        self.n = len(seq)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(self.seq, minlength=width + 1))])  # C

    @cached_property
    def left(self) -> np.ndarray:
        """BWT: the symbol before each suffix, in the order of the suffixes."""
        return self._bwt(self.seq)

    @cached_property
    def right(self) -> np.ndarray:
        """The same of the reversed sequence."""
        return self._bwt(self.seq[::-1])

    @cached_property
    def occurrences(self) -> tuple[np.ndarray, np.ndarray]:
        """symbol * n + row of both BWTs, ascending: ranks by binary search."""
        return tuple(np.sort(b * self.n + np.arange(self.n)) for b in (self.left, self.right))

    def _bwt(self, s: np.ndarray) -> np.ndarray:
        rank, k = s, 1
        while True:
            then = np.zeros_like(rank)
            then[:-k] = rank[k:]
            code = rank * (int(rank.max(initial=0)) + 1) + then
            k *= 2
            if k >= self.depth:
                return s[np.argsort(code) - 1]
            rank = np.unique(code, return_inverse=True)[1]

    def symbols(self) -> tuple[np.ndarray, np.ndarray]:
        """(first row, occurrences) of each symbol from 1; the same in both orders."""
        return self.before[1:-1], np.diff(self.before)[1:]

    def spread(self, lo: np.ndarray, size: np.ndarray, leftwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """(phrase * (width + 1) + symbol, times) of the symbols in the phrases' BWT intervals, ascending."""
        owner = np.repeat(np.arange(len(lo)), size)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        bwt = self.left if leftwards else self.right
        return np.unique(owner * (self.width + 1) + bwt[np.repeat(lo, size) + inside], return_counts=True)

    def extend(self, lo: np.ndarray, other: np.ndarray, size: np.ndarray, leftwards: bool) -> tuple[np.ndarray, ...]:
        """All extensions by one symbol of phrases whose intervals start at ``lo`` in the index of that side and at ``other``
        in the opposite one: (phrase, symbol, lo, other, size) of each."""
        code, count = self.spread(lo, size, leftwards)
        of, symbol = code // (self.width + 1), code % (self.width + 1)
        # rows of smaller symbols, separators among them, come first in the opposite order
        passed = np.cumsum(count) - count
        begin = np.searchsorted(of, np.arange(len(lo)))
        shift = passed - passed[np.minimum(begin, max(len(code) - 1, 0))][of] if len(code) else passed
        real = symbol > 0
        of, symbol, count, shift = of[real], symbol[real], count[real], shift[real]
        # LF: as far into the symbol's rows as it occurs in the BWT before the interval
        occ = self.occurrences[0 if leftwards else 1]
        seen = np.searchsorted(occ, symbol * self.n + lo[of]) - np.searchsorted(occ, symbol * self.n)
        return of, symbol, self.before[symbol] + seen, other[of] + shift, count


def pairs_of(index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left word, right word, times) of every pair of words."""
    code, count = index.spread(*index.symbols(), True)
    symbol = code % (index.width + 1)
    real = symbol > 0
    return symbol[real], code[real] // (index.width + 1) + 1, count[real]


def longer_phrases(index: Index, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases, times) of all phrases of 3 words, then 4, up to ``longest``."""
    first, size = index.symbols()
    of, symbol, lo, other, size = index.extend(first, first, size, True)
    words = np.stack([symbol, of + 1], axis=1)
    for length in range(3, longest + 1):
        if length % 2:
            of, c, lo, other, size = index.extend(lo, other, size, True)
            words = np.concatenate([c[:, None], words[of]], axis=1)
        else:
            of, c, other, lo, size = index.extend(other, lo, size, False)
            words = np.concatenate([words[of], c[:, None]], axis=1)
        yield words, size


def only(seq: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The sequence with its symbols renamed by ``to`` (0: becomes a separator), runs of separators as one, and one at each end."""
    s = to[seq]
    keep = s > 0
    keep[1:] |= s[:-1] > 0
    s = s[keep]
    return np.concatenate([[0], s, [0]])


def chains(seq: np.ndarray, frequent: np.ndarray, width: int) -> np.ndarray:
    """What is left of the sequence where at least two frequent pairs (left * (width + 1) + right, ascending) follow each
    other, cut at all other pairs."""
    code = seq[:-1] * (width + 1) + seq[1:]
    good = frequent[np.minimum(np.searchsorted(frequent, code), len(frequent) - 1)] == code
    three = good[:-1] & good[1:]
    covered = np.zeros(len(seq), bool)
    for j in range(3):
        covered[j:len(seq) - 2 + j] |= three
    at = np.flatnonzero(covered)
    cut = np.flatnonzero((np.diff(at) > 1) | ~good[at[:-1]]) + 1 if len(at) else at
    return np.concatenate([[0], np.insert(seq[at], cut, 0), [0]])


def _owners(codes: np.ndarray, n: int) -> np.ndarray:
    h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def _blocks(codes: np.ndarray, counts: np.ndarray, owners: int, first: int = 0) -> Iterator[tuple[int, bytes, bytes]]:
    """(owner, codes, counts) for each owner, codes ascending."""
    owner = _owners(codes, owners)
    order = np.lexsort((codes, owner))
    codes, counts, owner = codes[order], counts[order].astype(np.int32), owner[order]
    bounds = np.searchsorted(owner, np.arange(owners + 1))
    for o in np.flatnonzero(np.diff(bounds)).tolist():
        part = slice(bounds[o], bounds[o + 1])
        yield first + o, pack_sorted(codes[part]), pack(counts[part])


def _send_words(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.column(0)[i].as_py()
                lines = zstandard.ZstdDecompressor().decompress(batch.column(1)[i].as_py()).split(b"\n")
                counts = unpack(batch.column(2)[i].as_py(), np.int32)
                owner = np.fromiter((zlib.crc32(x) for x in lines), np.int64, len(lines)) % owners
                order = np.argsort(owner, kind="stable")
                bounds = np.searchsorted(owner[order], np.arange(owners + 1))
                for o in np.flatnonzero(np.diff(bounds)).tolist():
                    at = order[bounds[o]:bounds[o + 1]]
                    own = zstandard.ZstdCompressor(level=1).compress(b"\n".join([lines[j] for j in at.tolist()]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o], pa.int32()), pa.array([shard], pa.int64()), pa.array([own], pa.binary()),
                         pa.array([pack_sorted(at + 1)], pa.binary()), pa.array([pack(counts[at])], pa.binary())],
                        names=["owner", "shard", "words", "local", "counts"])
    return run


_WORDS = "owner int, shard long, local binary, no binary, number long, lang string, text string, f long"


def _sum_words(min_count: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one owner: a row for each frequent word, and for each shard the place of its frequent words in that list."""
        total: Counter = Counter()
        rows = [(r["shard"], zstandard.ZstdDecompressor().decompress(r["words"]).split(b"\n"), unpack(r["counts"], np.int32), r["local"])
                for r in table.to_pylist()]
        for _, lines, counts, _ in rows:
            for x, c in zip(lines, counts.tolist()):
                total[x] += c
        number = {x: i for i, x in enumerate(x for x, c in total.items() if c >= min_count)}
        names = [x.decode("utf-8", "surrogatepass").split("\t", 1) for x in number]
        replies = []
        for shard, lines, _, local in rows:
            no = np.fromiter((number.get(x, -1) for x in lines), np.int64, len(lines))
            if (no >= 0).any():
                replies.append((shard, pack_sorted(unpack_sorted(local)[no >= 0]), pack(no[no >= 0])))
        a, b = len(replies), len(names)
        none = [None] * a
        return pa.table({
            "owner": pa.repeat(table.column("owner")[0], a + b), "shard": pa.array([r[0] for r in replies] + [None] * b, pa.int64()),
            "local": pa.array([r[1] for r in replies] + [None] * b, pa.binary()),
            "no": pa.array([r[2] for r in replies] + [None] * b, pa.binary()),
            "number": pa.array(none + list(range(b)), pa.int64()),
            "lang": pa.array(none + [_language(g) for _, g in names], pa.string()),
            "text": pa.array(none + [w for w, _ in names], pa.string()),
            "f": pa.array(none + [total[x] for x in number], pa.int64())})
    return run


_CODES = "owner int, shard long, codes binary, no binary, number long, code long, f long"


def _sum_codes(min_count: int, answer: bool):
    def run(table: pa.Table) -> pa.Table:
        """Of one owner: a row for each frequent code and, if asked for, for each shard its frequent codes and their place."""
        shard = table.column("shard").to_pylist()
        codes = [unpack_sorted(x.as_py()) for x in table.column("codes")]
        counts = np.concatenate([unpack(x.as_py(), np.int32) for x in table.column("counts")])
        every, at = np.unique(np.concatenate(codes), return_inverse=True)
        f = np.bincount(at, weights=counts, minlength=len(every)).astype(np.int64)  # exact below 2^53
        common = np.flatnonzero(f >= min_count)
        number = np.full(len(every), -1, np.int64)
        number[common] = np.arange(len(common))
        replies, begin = [], 0
        for s, c in zip(shard, codes if answer else []):
            no = number[at[begin:begin + len(c)]]
            begin += len(c)
            if (no >= 0).any():
                replies.append((s, pack_sorted(c[no >= 0]), pack(no[no >= 0])))
        a, b = len(replies), len(common)
        none = [None] * a

        def column(values: np.ndarray) -> pa.Array:
            return pa.concat_arrays([pa.nulls(a, pa.int64()), pa.array(values)])

        return pa.table({
            "owner": pa.repeat(table.column("owner")[0], a + b), "shard": pa.array([r[0] for r in replies] + [None] * b, pa.int64()),
            "codes": pa.array([r[1] for r in replies] + [None] * b, pa.binary()),
            "no": pa.array([r[2] for r in replies] + [None] * b, pa.binary()),
            "number": column(np.arange(b)), "code": column(every[common]), "f": column(f[common])})
    return run


class _Answers:
    """Inside a task: what the owners answered to the shards, read for one origin at a time."""

    def __init__(self, folder: str, offsets: dict[int, int]):
        self.folder, self.offsets, self.origin, self.rows = folder, offsets, None, {}

    def of(self, shard: int) -> tuple[np.ndarray, np.ndarray] | None:
        """(keys of the shard, their numbers in the corpus); None without any."""
        if shard >> 32 != self.origin:
            self.origin, self.rows = shard >> 32, {}
            table = read_shared(f"{self.folder}/origin={self.origin}")
            for r in table.to_pylist() if table is not None else ():
                self.rows.setdefault(r["shard"], []).append(r)
        mine = self.rows.get(shard)
        if not mine:
            return None
        return (np.concatenate([unpack_sorted(r["key"]) for r in mine]),
                np.concatenate([unpack(r["no"], np.int64) + self.offsets[r["owner"]] for r in mine]))


def _frequent(data: bytes, known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A shard's sequence over its frequent words, numbered 1.. in order of their ids in the corpus, and those ids."""
    local, ids = known
    order = np.argsort(ids)
    local, ids = local[order], ids[order]
    seq = unpack(data, np.int32)
    to = np.zeros(int(max(seq.max(), local.max())) + 1, np.int64)
    to[local] = np.arange(1, len(local) + 1)
    return only(seq, to), ids


def _send_pairs(folder: str, offsets: dict[int, int], n_words: int, owners: int):
    """The pairs of each shard for each owner."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Answers(folder, offsets)
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.column(0)[i].as_py()
                known = words.of(shard)
                if known is None:
                    continue
                seq, ids = _frequent(batch.column(1)[i].as_py(), known)
                a, b, count = pairs_of(Index(seq, len(ids), 2))
                rows = list(_blocks(ids[a - 1] * n_words + ids[b - 1], count, owners))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([shard] * len(rows), pa.int64()),
                     *(pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2))], names=["owner", "shard", "codes", "counts"])
    return run


def _send_longer(of_words: tuple[str, dict[int, int]], of_pairs: tuple[str, dict[int, int]], n_words: int, n_pairs: int, owners: int, longest: int):
    """The phrases of 3 words for the first ``owners``, those of 4 for the second."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_known, pairs_known = _Answers(*of_words), _Answers(*of_pairs)
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.column(0)[i].as_py()
                known = pairs_known.of(shard)
                if known is None:
                    continue
                codes, numbers = known
                seq, ids = _frequent(batch.column(1)[i].as_py(), words_known.of(shard))
                pair = (np.searchsorted(ids, codes // n_words) + 1) * (len(ids) + 1) + np.searchsorted(ids, codes % n_words) + 1
                order = np.argsort(pair)
                pair, numbers = pair[order], numbers[order]

                def number(a, b, pair=pair, numbers=numbers, step=len(ids) + 1):
                    return numbers[np.searchsorted(pair, a * step + b)]

                left = chains(seq, pair, len(ids))
                if len(left) < 3:
                    continue
                for words, count in longer_phrases(Index(left, len(ids), longest), longest):
                    head = number(words[:, 0], words[:, 1])
                    three = words.shape[1] == 3
                    code = head * n_words + ids[words[:, 2] - 1] if three else head * n_pairs + number(words[:, 2], words[:, 3])
                    rows = list(_blocks(code, count, owners, 0 if three else owners))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int32()), pa.array([shard] * len(rows), pa.int64()),
                         *(pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2))], names=["owner", "shard", "codes", "counts"])
    return run


def _numbered(found: DataFrame) -> tuple[DataFrame, dict[int, int], int]:
    """The frequent words or codes with a number in the corpus (id), where each owner's numbers start, and how many there are."""
    spark = found.sparkSession
    sizes = sorted(found.groupBy("owner").count().collect())  # a number for each owner
    offsets, n = {}, 0
    for owner, size in sizes:
        offsets[owner] = n
        n += size
    if n >= 3 * 10**9:
        raise ValueError("more than 3 * 10^9 frequent words or pairs")
    starts = spark.createDataFrame(list(offsets.items()), "owner int, start long")
    return found.join(starts, "owner").withColumn("id", F.col("start") + F.col("number")).drop("start", "number"), offsets, n


def _answers(found: DataFrame, key: str) -> str:
    """Folder of what the owners answer to the shards, by the task that the shards are of: so the sequences stay where they are,
    and a task reads the answers to the shards that it comes by. They are bounded by the shards' words or pairs."""
    folder = shared_folder(found.sparkSession, "phrase-answers")
    rows = found.where(F.col("shard").isNotNull()).select("shard", "owner", F.col(key).alias("key"), "no", F.shiftright("shard", 32).alias("origin"))
    rows.repartition("origin").write.partitionBy("origin").parquet(folder)
    return folder


def _big(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def counts(docs: DataFrame, min_count: int, max_words: int, text: str, lang: str, shard_words: int, owner_keys: int) \
        -> tuple[DataFrame, DataFrame, DataFrame]:
    """(n of each language, frequent words with id, frequent phrases of 2 and more word ids with their count)."""
    if not 2 <= max_words <= MAX_WORDS:
        raise ValueError(f"phrases have 2 to {MAX_WORDS} words")
    ship(docs.sparkSession)
    parts = written(shards(docs, text, lang, shard_words), "phrase-shards")
    n = parts.select(F.explode(F.arrays_zip("langs", "totals")).alias("x")).groupBy(F.col("x.langs").alias("lang")) \
        .agg(F.sum("x.totals").alias("n"))
    size = parts.agg(F.sum("n_words").alias("words"), F.sum("n_seq").alias("seq")).first()
    owners = [max(1, -(-(x or 0) // per)) for x, per in zip(size, (max(1, owner_keys // 2), owner_keys))]
    sent = parts.select("shard", "words", "counts").mapInArrow(
        _send_words(owners[0]), "owner int, shard long, words binary, local binary, counts binary")
    summed = written(sent.repartition(owners[0], "owner").groupBy("owner").applyInArrow(_sum_words(min_count), _WORDS), "phrase-words")
    words, word_starts, n_words = _numbered(summed.where(F.col("f").isNotNull()).select("owner", "number", "lang", "text", "f"))
    block = "owner int, shard long, codes binary, counts binary"
    of_words = _answers(summed, "local"), word_starts
    sent = parts.select("shard", "seq").mapInArrow(_send_pairs(*of_words, n_words, owners[1]), block)
    summed = written(sent.repartition(owners[1], "owner").groupBy("owner").applyInArrow(_sum_codes(min_count, True), _CODES), "phrase-two")
    two, starts, n_pairs = _numbered(summed.where(F.col("f").isNotNull()).select("owner", "number", "code", "f"))
    two = two.select("id", F.expr(f"code div {max(n_words, 1)}").alias("a"), F.expr(f"code % {max(n_words, 1)}").alias("b"), "f")
    phrases = two.select(F.array("a", "b").alias("words"), "f")
    if max_words > 2:
        of_pairs = _answers(summed, "codes"), starts
        sent = parts.select("shard", "seq").mapInArrow(_send_longer(of_words, of_pairs, n_words, n_pairs, owners[1], max_words), block)
        more = written(sent.repartition(2 * owners[1], "owner").groupBy("owner").applyInArrow(_sum_codes(min_count, False), _CODES)
                       .select("owner", "code", "f"), "phrase-more")
        head = two.select(F.col("id").alias("p"), "a", "b")
        tail = two.select(F.col("id").alias("q"), F.col("a").alias("c"), F.col("b").alias("d"))
        three = more.where(F.col("owner") < owners[1]).select(
            F.expr(f"code div {max(n_words, 1)}").alias("p"), F.expr(f"code % {max(n_words, 1)}").alias("c"), "f").join(head, "p")
        four = more.where(F.col("owner") >= owners[1]).select(
            F.expr(f"code div {max(n_pairs, 1)}").alias("p"), F.expr(f"code % {max(n_pairs, 1)}").alias("q"), "f") \
            .join(head, "p").join(tail, "q")
        phrases = phrases.unionAll(three.select(F.array("a", "b", "c"), "f")).unionAll(four.select(F.array("a", "b", "c", "d"), "f"))
    return n, words.select("id", "lang", "text", "f"), written(phrases, "phrase-counts")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, text: str = "text",
         lang: str = "lang", shard_words: int = SHARD_WORDS, owner_keys: int = OWNER_KEYS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` collocations of each language."""
    n, words, phrases = counts(docs, min_count, max_words, text, lang, shard_words, owner_keys)
    every = phrases.unionAll(words.select(F.array("id").alias("words"), "f"))

    def part(side: str) -> DataFrame:
        return every.select(F.col("words").alias(side), F.col("f").alias(f"f_{side}"))

    # each cut of each candidate, with the counts of both sides
    cut = phrases.select("words", "f", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cut = cut.withColumn("head", F.expr("slice(words, 1, k)")).withColumn("tail", F.expr("slice(words, k + 1, size(words) - k)"))
    cut = cut.join(part("head"), "head").join(part("tail"), "tail")
    score = F.expr(f"cast({SCALE} as decimal(8,0)) * cast(f as decimal(20,0)) "
                   "div (cast(f_head as decimal(20,0)) + cast(f_tail as decimal(20,0)))")
    scored = cut.withColumn("score", score).groupBy("words").agg(
        F.first("f").alias("a"), F.min(F.struct("score", "k", F.col("f_head").alias("l"), F.col("f_tail").alias("r"))).alias("cut"))
    # parts of longer candidates, with the count of the most frequent one
    inner = phrases.where(F.size("words") > 2).select("words", "f", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("len")) \
        .select("words", "f", "len", F.explode(F.expr("sequence(1, size(words) - len + 1)")).alias("at")) \
        .select(F.expr("slice(words, at, len)").alias("words"), "f").groupBy("words").agg(F.max("f").alias("longer"))
    kept = scored.join(inner, "words", "left") \
        .where(F.col("longer").isNull() | (F.lit(100) * _big("longer") < F.lit(DOMINATED) * _big("a")))
    # the language is that of the first word
    spelled = words.select("id", "lang", "text")
    kept = kept.select("words", "a", "cut.*").withColumn("id", F.col("words")[0]).join(spelled, "id")
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = kept.withColumn("place", F.rank().over(first)).where(F.col("place") <= top)  # ties at the end stay for now
    for i in range(1, max_words):
        right = spelled.select(F.col("id").alias(f"id{i}"), F.col("text").alias(f"text{i}"))
        near = near.withColumn(f"id{i}", F.get(F.col("words"), F.lit(i))).join(right, f"id{i}", "left")
    named = near.withColumn("phrase", F.concat_ws(" ", "text", *[f"text{i}" for i in range(1, max_words)]))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS ph
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, ph, count(*)::HUGEINT AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, ph, f AS a FROM f WHERE k > 1),
cuts AS (SELECT c.lang, c.k, c.ph, c.a, j, x.f AS l, y.f AS r, (2000000 * c.a) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f x ON x.lang = c.lang AND x.ph = c.ph[1:j] JOIN f y ON y.lang = c.lang AND y.ph = c.ph[j + 1:]),
s AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, j) = 1),
subs AS (SELECT lang, a, ph[i:i + z - 1] AS sub FROM (SELECT *, unnest(range(1, k - z + 2)) AS i FROM
  (SELECT *, unnest(range(2, k)) AS z FROM c WHERE k > 2))),
dom AS (SELECT lang, sub, max(a) AS longer FROM subs GROUP BY ALL),
kept AS (SELECT s.lang, array_to_string(s.ph, ' ') AS phrase, s.a, s.l, s.r, s.score FROM s LEFT JOIN dom ON dom.lang = s.lang AND dom.sub = s.ph
  WHERE longer IS NULL OR 100 * longer < 80 * s.a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM r JOIN n USING (lang) WHERE rank <= 2000
"""
