"""Token ids as binary files, each document compressed by itself with one shared zstandard dictionary.

Layout under the store's folder:

* ``dictionary.zdict``: the dictionary, trained on the id arrays of a bounded sample of documents
  (``SAMPLE_DOCS`` documents, the first ``SAMPLE_BYTES`` of each array).
* ``data/<part>-<attempt>.tok``: a 48-byte header (8 bytes magic, 4 bytes id width, 4 bytes reserved, 32 bytes
  SHA-256 of the dictionary), then one zstandard frame per document. A frame holds the document's ids as
  little-endian unsigned integers of the id width, the end id included.
* ``index`` (Parquet): doc_id, seq, file, offset, n_bytes, n_tokens, part_start for every document: the frame of one
  short document is read without touching its neighbours. ``seq`` numbers the documents of a file;
  ``part_start`` counts the ids before it in its file.
* ``parts`` (Parquet): file, part, start: ids of all documents in earlier files.

Documents go in ascending doc_id order: Spark ranges them over partitions by doc_id, sorts each, and each task
writes one file. A task that is run again writes a file with another name; only files that the committed index names
count. Writing and reading the data files goes through Arrow's file systems, so the folder may be local (shared),
HDFS or an object store.

Tokens: each text is cut at ASCII white space and, after a letter or digit, before a comma or full stop that ends a
piece; each distinct piece is encoded once by the tokenizers library and its id bytes are then reused. A new piece of
Latin letters, digits and ASCII signs is cut further into runs of letters, digits and signs, which the library's model encodes
by themselves. The tokenizer splits at the same places, so the ids are those of the whole text (tested, and tried on
probe texts when a vocabulary is loaded: if they differ, every text is encoded whole); a text that could spell a
special token is encoded whole.

Cases: null text counts as empty and has the end id only; rows without doc_id come first; repeated rows and equal
ids stay, ordered by text; an empty table gives an empty store that reads as no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import sample_by_hash, ship

MAGIC = b"FRWTOK01"
HEADER = "<8sII32s"
HEADER_BYTES = struct.calcsize(HEADER)
END_ID = 1
DICT_BYTES = 64 << 10
SAMPLE_DOCS = 400
SAMPLE_BYTES = 16 << 10
LEVEL = 3
# Distinct pieces whose ids a task remembers, in two generations of half each: pieces that were not met for a generation
# are forgotten, all are at the end of a task. Results don't change.
PIECES_KEPT = 800_000
READ_STEP = 8 << 20

# ASCII letters small, white space as a space.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if b in b"\t\n\x0b\x0c\r" else b for b in range(256))
# Comma and full stop as a comma, other ASCII signs as an exclamation mark, the rest as a letter.
_SIGNS = bytes(44 if b in b",." else 33 if 33 <= b < 127 and not chr(b).isalnum() else 32 if b in b" \t\n\x0b\x0c\r" else 97 for b in range(256))
# Bytes of ASCII and of the letters up to U+00FF (two signs among them are looked for by themselves).
_LATIN = bytes([*range(9, 14), *range(32, 127), *range(0x80, 0xC0), 0xC3])
# A small piece that is cut into runs, without the apostrophe; the runs: letters, a digit, signs.
_SIMPLE = re.compile("[!-&(-@\\[-~\u00df-\u00f6\u00f8-\u00ff]+")
_RUNS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
# Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_PROBES = ("It's a text, with 1234 words... and d'll; (A-B) re:we've #5!", "Élève naïve, ça où \u00ff\u00d6\u00c4\u00dc\u00df. \u00bfqu\u00e9?", "x&&& a,, b!, c. d\te\nf")


def pieces_of(text: bytes) -> list[bytes]:
    """The parts of a text at whose ends the tokenizer splits anyway."""
    plain = text.translate(_PLAIN)
    signs = text.translate(_SIGNS)
    if b",," in signs or b"!," in signs or text.translate(None, _LATIN) or b"\xc3\x97" in text or b"\xc3\xb7" in text:
        return plain.split()
    return (plain + b" ").replace(b", ", b" , ").replace(b". ", b" . ").split()


class Encoder(dict):
    """Whole texts to little-endian id bytes. The dict holds the ids of the pieces met, the newer of two generations; a
    piece of the older one moves over when it is met again."""

    def __init__(self, path: str, width: int | None = None):
        import os

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = width or (2 if max(self.tokenizer.get_vocab().values()) < 1 << 16 else 4)
        self.older: dict[bytes, bytes] = {}
        self.by_piece = all(self._by_piece(t.encode()) == self.whole(t) for t in _PROBES)
        self.clear()

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def pack(self, ids) -> bytes:
        out = array("H" if self.width == 2 else "I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: bytes) -> bytes:
        if b"<|" in text or not self.by_piece:
            return self.whole(text.decode())
        return self._by_piece(text)

    def _by_piece(self, text: bytes) -> bytes:
        if len(self) > PIECES_KEPT // 2:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, pieces_of(text)))

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None and piece.isalpha():  # ASCII letters, small already
            ids = self.pack([t.id for t in self.model.tokenize(piece.decode())])
        elif ids is None:
            text = piece.decode().lower()
            if _SIMPLE.fullmatch(text):
                runs = _RUNS.findall(text)
                if len(runs) == 1:
                    shown = text if text.isascii() else text.encode().decode("latin-1").translate(_BYTE_CHARS)
                    ids = self.pack([t.id for t in self.model.tokenize(shown)])
                else:
                    ids = b"".join([self[r.encode()] for r in runs])
            else:
                ids = self.whole(piece.decode())
        self[piece] = ids
        return ids


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _open(folder: str):
    return arrow_fs.FileSystem.from_uri(folder) if "://" in folder else (arrow_fs.LocalFileSystem(), folder)


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """A zstandard dictionary from the id arrays of at most ``sample_docs`` documents, chosen by a hash; empty if the
    sample is too small to train on."""
    import zstandard

    ship(docs.sparkSession)
    picked = sample_by_hash(docs.select(F.substring(F.col("text").cast("string"), 1, SAMPLE_BYTES).alias("t"),
                                        F.xxhash64("doc_id", "text").alias("h")), "h", sample_docs)
    code = encoder(tokenizer_path)
    arrays = [code.encode((r.t or "").encode())[:SAMPLE_BYTES] + code.pack([end_id]) for r in picked]
    total = sum(map(len, arrays))
    try:
        return zstandard.train_dictionary(max(256, min(DICT_BYTES, total // 8)), arrays).as_bytes() if total else b""
    except zstandard.ZstdError:
        return b""


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, parts: int | None = None) -> None:
    """Write the store of ``docs`` (doc_id, text) into a new folder."""
    spark = docs.sparkSession
    ship(spark)
    trained = train_dictionary(docs, tokenizer_path, end_id)
    system, root = _open(folder)
    system.create_dir(f"{root}/data", recursive=True)
    with system.open_output_stream(f"{root}/dictionary.zdict") as out:
        out.write(trained)
    digest = hashlib.sha256(trained).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        code = encoder(tokenizer_path)
        end = code.pack([end_id])
        compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        system, root = _open(folder)
        part = TaskContext.get().partitionId()
        file = f"{part:06d}-{uuid.uuid4().hex}.tok"
        sink, at, seq, start = None, HEADER_BYTES, 0, 0
        try:
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                    if sink is None:
                        sink = system.open_output_stream(f"{root}/data/{file}")
                        sink.write(struct.pack(HEADER, MAGIC, code.width, 0, digest))
                    ids = (code.encode(text.as_buffer().to_pybytes()) if text.is_valid else b"") + end
                    frame = compressor.compress(ids)
                    sink.write(frame)
                    n = len(ids) // code.width
                    rows.append((doc_id, seq, file, part, at, len(frame), n, start))
                    at, seq, start = at + len(frame), seq + 1, start + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _INDEX.types)] if rows
                    else [pa.array([], t) for t in _INDEX.types], schema=_INDEX)
        finally:
            code.forget()
            if sink is not None:
                sink.close()

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = src.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    ranged.mapInArrow(run, _INDEX_DDL).write.parquet(f"{folder}/index")
    index = spark.read.schema(_INDEX_DDL).parquet(f"{folder}/index")
    sizes = sorted((r.part, r.file, r.n) for r in index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n")).collect())
    before, rows = 0, []
    for part, file, n_tokens in sizes:  # a row per file
        rows.append((file, part, before))
        before += n_tokens
    spark.createDataFrame(rows, "file string, part int, start long").coalesce(1).write.parquet(f"{folder}/parts")


_INDEX = pa.schema([("doc_id", pa.int64()), ("seq", pa.int64()), ("file", pa.string()), ("part", pa.int32()),
                    ("offset", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("part_start", pa.int64())])
_INDEX_DDL = "doc_id long, seq long, file string, part int, offset long, n_bytes long, n_tokens long, part_start long"


class Reader:
    """Opens the data files of a store; checks that a file was written with the store's dictionary."""

    def __init__(self, folder: str):
        import zstandard

        self.system, self.root = _open(folder)
        with self.system.open_input_stream(f"{self.root}/dictionary.zdict") as f:
            trained = f.read()
        self.digest = hashlib.sha256(trained).digest()
        self.zstd = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        self.file, self.source, self.width, self.held, self.held_at = None, None, 0, b"", 0

    def open(self, file: str) -> None:
        if file == self.file:
            return
        self.close()
        self.source = self.system.open_input_file(f"{self.root}/data/{file}")
        magic, self.width, _, digest = struct.unpack(HEADER, self.source.read_at(HEADER_BYTES, 0))
        if magic != MAGIC or digest != self.digest:
            raise ValueError(f"{file} is not of this store: other magic or dictionary hash")
        self.file, self.held, self.held_at = file, b"", 0

    def frame(self, file: str, offset: int, n_bytes: int, ahead: int = 0) -> bytes:
        """Id bytes of one document; ``ahead``: bytes to read at once when walking through a file."""
        self.open(file)
        at = offset - self.held_at
        if at < 0 or at + n_bytes > len(self.held):
            self.held, self.held_at, at = self.source.read_at(max(n_bytes, ahead), offset), offset, 0
        return self.zstd.decompress(self.held[at:at + n_bytes])

    def ids(self, raw: bytes) -> tuple[int, ...]:
        return struct.unpack(f"<{len(raw) // self.width}{'H' if self.width == 2 else 'I'}", raw)

    def close(self) -> None:
        if self.source is not None:
            self.source.close()
            self.source = None


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[tuple[int, ...]]:
    """The ids of the documents with this id, through the offset index: only their frames are read."""
    reader = Reader(folder)
    found = spark.read.parquet(f"{folder}/index").where(F.col("doc_id") == doc_id).orderBy("file", "seq").collect()
    try:
        return [reader.ids(reader.frame(r.file, r.offset, r.n_bytes)) for r in found]
    finally:
        reader.close()


def read_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document read back from the files: doc_id, start, n_tokens, ids_crc32 (of little-endian 32-bit ids)."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(folder)
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(6)]
            n_tokens, crc = [], []
            for file, offset, n_bytes in zip(*cols[3:6]):
                raw = reader.frame(file, offset, n_bytes, READ_STEP)
                ids = np.frombuffer(raw, "<u2" if reader.width == 2 else "<u4").astype("<u4")
                n_tokens.append(len(ids))
                crc.append(zlib.crc32(ids.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_tokens, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])
        reader.close()

    index = spark.read.schema(_INDEX_DDL).parquet(f"{folder}/index")
    parts = spark.read.schema("file string, part int, start long").parquet(f"{folder}/parts")
    # a row per file of the store: as many as there were write tasks
    at = index.join(F.broadcast(parts.select("file", "start")), "file") \
        .select("doc_id", (F.col("start") + F.col("part_start")).alias("start"), "seq", "file", "offset", "n_bytes")
    return at.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_and_read(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the store, then the digest of what is in the files."""
    write(docs, folder, tokenizer_path, end_id)
    return read_digest(docs.sparkSession, folder)
