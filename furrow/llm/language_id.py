"""Language identification by cross-parsing.

For each language a suffix automaton holds a bounded sample of labelled text. A text is parsed with each automaton into
longest phrases that occur in that sample: the automaton is followed as far as it goes, then a new phrase starts. The
language whose sample needs the fewest phrases, normalised as phrases x log2(sample length) / text length (the
cross-entropy estimate), wins; equal rates go to the alphabetically first.

Texts are lower-cased; each run of characters that aren't letters counts as one space. Every letter of the samples is told
apart; the tables of a language know its own sample's letters, so their size doesn't depend on the other languages. A parse restarts every
``SEGMENT`` characters, the same for all languages, so that the segments of a batch are parsed side by side and a very
long text is no slower per character than a short one. Every character of a text is parsed.

Training uses text and non-null lang of the rows that the caller marks: at most about ``4 x DOCS_PER_LANG`` rows of each
language, chosen by a hash of their id, reach the driver (``CHARS_PER_DOC`` characters each).

Cases: null text or one without a letter: ``und`` with score 0; no labelled row at all: ``und`` for every text; a
single learned language: score 1; letters that no sample has: a phrase each; repeated rows get equal results; an empty
table gives no rows; further columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.llm.common import as_row, ship

DOCS_PER_LANG = 64
CHARS_PER_DOC = 480
SEGMENT = 256
STEP_CHARS = 1 << 20
# Bytes of all parse tables up to which they are dense; beyond it they are hashed.
DENSE_BYTES = 1 << 28
UNDETERMINED = "und"
# A text of at least so many letters is foreign if its best parse needs a phrase for nearly every character.
FOREIGN_LETTERS, FOREIGN_RATE = 20, 0.9

_SPACE, _UNKNOWN, _END, _FIRST_LETTER = 0, 1, 2, 3


def normalised(text: str) -> str:
    """Lower case, each run of other than letters as one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(classes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of a sequence: class -> state for each state. State 0 is the start."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in classes:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


class Parser:
    """Greedy parse with the automaton of a sample, many texts at a time. The classes are those of the letters of this sample;
    every other letter is a phrase of its own. A failing step ends the phrase and goes on from the start.

    ``dense``: a table of state * 4 + phrases ended for each (state, class). Otherwise only the transitions there are, in a hash
    table with linear probing, and the start's row for the steps that fail."""

    def __init__(self, sample: str, dense: bool):
        letters = sorted(set(sample) - {" "})
        self.letters = {c: _FIRST_LETTER + i for i, c in enumerate(letters)}
        self.width = _FIRST_LETTER + len(letters)
        steps = suffix_automaton([self.letters[c] if c != " " else _SPACE for c in sample])
        self.states = len(steps)
        sizes = np.array([len(s) for s in steps])
        at = np.repeat(np.arange(len(steps)), sizes)
        c = np.fromiter((x for s in steps for x in s), np.int64, int(sizes.sum()))
        to = np.fromiter((x for s in steps for x in s.values()), np.int64, int(sizes.sum()))
        first = np.full(self.width, -1, np.int64)
        first[c[at == 0]] = to[at == 0]
        # a failing step from the start and from elsewhere, for each class
        fail = np.where(first >= 0, first, 0) * 4 + (first < 0)
        self.fail = np.stack([fail, fail + 1]).astype(np.int32)
        self.fail[:, _END] = [0, 1]
        if dense:
            table = np.repeat(self.fail[1:], len(steps), axis=0)
            table[0] = self.fail[0]
            table[at, c] = to * 4
            self.table = table.ravel()
        else:
            self.table = None
            bits = max(2, int(len(at) * 2 - 1).bit_length())
            self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
            self.keys, self.to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
            key = at * self.width + c
            place = self._place(key)
            left = np.arange(len(key))
            while len(left):  # the first of those that meet at a free place takes it
                free = self.keys[place[left]] < 0
                self.keys[place[left[free]]] = key[left[free]]
                self.to[place[left[free]]] = to[left[free]] * 4
                left = left[self.keys[place[left]] != key[left]]
                place[left] = (place[left] + 1) & self.mask

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """state * 4 + phrases ended after a class each."""
        if self.table is not None:
            return self.table[state * self.width + c]
        out = np.where(state > 0, self.fail[1, c], self.fail[0, c])
        key = state.astype(np.int64) * self.width + c
        place = self._place(key)
        left = np.arange(len(key))
        while len(left):
            there = self.keys[place[left]]
            hit = there == key[left]
            out[left[hit]] = self.to[place[left[hit]]]
            left = left[~hit & (there >= 0)]
            place[left] = (place[left] + 1) & self.mask
        return out


class Model:
    """Classes of all letters of the samples, and a parser per language."""

    def __init__(self, samples: dict[str, str], dense_bytes: int = DENSE_BYTES):
        letters = sorted({c for t in samples.values() for c in t} - {" "})
        self.letters = {c: _FIRST_LETTER + i for i, c in enumerate(letters)}
        self.langs = sorted(samples)
        self.bits = [float(np.log2(max(2, len(samples[lang])))) for lang in self.langs]
        size = sum(8 * len(t) * (len(set(t)) + _FIRST_LETTER) for t in samples.values())  # two states a character at most
        self.parsers = [Parser(samples[lang], size <= dense_bytes) for lang in self.langs]
        # the class that a letter has in each language
        self.own = []
        for parser in self.parsers:
            own = np.full(_FIRST_LETTER + len(letters), _UNKNOWN, np.int32)
            own[[_SPACE, _END]] = _SPACE, _END
            for c, k in parser.letters.items():
                own[self.letters[c]] = k
            self.own.append(own)

    def class_of_char(self) -> np.ndarray:
        out = np.array([_UNKNOWN if chr(i).isalpha() else _SPACE for i in range(0x110000)], np.int32)
        for c, k in self.letters.items():
            out[ord(c)] = k
        return out


def train(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG, chars: int = CHARS_PER_DOC) -> Model:
    """A model from rows (doc_id, text, lang)."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model({})
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, 4 * docs_per_lang / n)))])
    u = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    picked = rows.where(u < share[F.col("lang")]).groupBy("lang", "doc_id") \
        .agg(F.min(F.substring("text", 1, 4 * chars)).alias("text")).collect()
    samples = {}
    for lang in sizes:
        mine = sorted((r for r in picked if r.lang == lang), key=lambda r: (str(r.doc_id)[::-1], r.text))
        texts = [t for t in (normalised(r.text)[:chars] for r in mine[:docs_per_lang]) if t]
        if texts:
            samples[lang] = " ".join(texts)
    return Model(samples)


def phrases(model: Model, rows: list[np.ndarray]) -> np.ndarray:
    """(text, language): phrases that each text, given as classes, needs."""
    counts = np.zeros((len(rows), len(model.langs)), np.int64)
    lens = np.array([len(r) for r in rows])
    per = -(-lens // SEGMENT)
    if not per.sum():
        return counts
    owner = np.repeat(np.arange(len(rows)), per)
    lanes = np.full((len(owner), SEGMENT), _END, np.int32)
    flat = lanes.reshape(-1)
    at = np.r_[0, np.cumsum(per)] * SEGMENT
    for i, r in enumerate(rows):
        flat[at[i]:at[i] + len(r)] = r
    columns = np.ascontiguousarray(lanes.T)
    for k, (parser, own) in enumerate(zip(model.parsers, model.own)):
        state = np.zeros(len(owner), np.int32)
        ended = np.zeros(len(owner), np.int32)
        for c in own[columns]:
            v = parser.step(state, c)
            state = v >> 2
            ended += v & 3
        counts[:, k] = np.bincount(owner, weights=ended + (state > 0), minlength=len(rows))
    return counts


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), lang_pred, score (0 to 1: how far the best rate is below
    the second), foreign (in no learned language do its letters follow each other)."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast((model, model.class_of_char()))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, class_of = held.value
        for batch in batches:
            rows: list[np.ndarray] = []
            begin, size = 0, 0
            column = batch.column(0)
            for i, t in enumerate(column.field(at).to_pylist()):
                rows.append(_classes(t or "", class_of))
                size += len(rows[-1])
                if size >= STEP_CHARS or i + 1 == batch.num_rows:
                    yield _result(column.slice(begin, len(rows)), model, rows)
                    begin, size, rows = i + 1, 0, []

    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("foreign", T.BooleanType())])
    return docs.select(as_row(docs)).mapInArrow(run, schema)


def _classes(text: str, class_of: np.ndarray) -> np.ndarray:
    c = class_of[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
    c = c[(c != _SPACE) | np.r_[False, c[:-1] != _SPACE]] if len(c) else c
    return c[:-1] if len(c) and c[-1] == _SPACE else c


def _result(column: pa.Array, model: Model, rows: list[np.ndarray]) -> pa.RecordBatch:
    letters = np.array([int((r != _SPACE).sum()) for r in rows])
    if model.langs:
        per_char = phrases(model, rows) / np.maximum(1, [len(r) for r in rows])[:, None]
        foreign = (per_char.min(axis=1) >= FOREIGN_RATE) & (letters >= FOREIGN_LETTERS)
        rates = per_char * np.array(model.bits)
        best = rates.argmin(axis=1)
        two = np.sort(rates, axis=1)[:, :2]
        score = np.ones(len(rows)) if two.shape[1] < 2 else 1 - two[:, 0] / np.maximum(two[:, 1], 1e-300)
        lang = [model.langs[b] if n else UNDETERMINED for b, n in zip(best, letters)]
        score = np.where(letters > 0, score, 0.0)
    else:
        lang, score, foreign = [UNDETERMINED] * len(rows), np.zeros(len(rows)), np.zeros(len(rows), bool)
    return pa.RecordBatch.from_arrays([column, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                       pa.array(foreign)], names=["row", "lang_pred", "score", "foreign"])


def held_out(doc_id: Column) -> Column:
    """The fold that no training row is from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 0


def identify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, foreign; learned from the rows outside the fold."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    found = classify(docs.select("doc_id", "text"), model)
    return found.select(F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"),
                        "lang_pred", "score", "foreign")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in a learned language; a null lang is filled with the prediction. Texts without a
    letter, and longer ones that no learned language explains, go."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    found = classify(docs, model).where((F.col("lang_pred") != UNDETERMINED) & ~F.col("foreign"))
    return found.select(*[
        F.coalesce(F.col("row.lang"), F.col("lang_pred")).alias("lang") if c == "lang" else F.col("row")[c].alias(c)
        for c in docs.columns])
