"""Token counts of a unigram vocabulary by dynamic programming shared along a trie.

A text's pre-tokens are its runs of other than ASCII white space, each with the word mark in front. A pre-token is
segmented into the pieces of a given vocabulary with the largest sum of scores (of equal sums the one with fewer
tokens). The forward score of a prefix depends on the prefix alone, so the distinct pre-tokens of a batch go into
a trie and each node's forward score is computed once, from its ancestors; a pre-token's count is stored at its terminal
node. The trie is walked in sorted order, so only the path of the present word is held: a word keeps what it
shares with the one before.

A character that no piece covers costs ``UNKNOWN_PENALTY`` below the least score and counts as its UTF-8 bytes (byte
fallback). The counts of a text are the sums over its pre-tokens. Each Arrow batch is a trie of its own (cut at
``STEP_CHARS`` characters of text): no text is shuffled and a very common word is computed once per batch.

Cases: null or blank text: no pre-tokens, no tokens; a very long pre-token takes time and memory in proportion to its
length; repeated rows get equal counts; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import ship

MARK = "▁"
UNKNOWN_PENALTY = 10.0
STEP_CHARS = 8 << 20


class Vocabulary:
    """Scores of the pieces; control and byte pieces don't match text."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=0)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        # proper beginnings of pieces: a walk from the left stops where no piece goes on
        self.begins = {p[:i] for p in scores for i in range(1, len(p))}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        return cls({sp.IdToPiece(i): sp.GetScore(i) for i in range(sp.GetPieceSize())
                    if not (sp.IsControl(i) or sp.IsUnknown(i) or sp.IsByte(i) or sp.IsUnused(i))})


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary.load(path)
    return _loaded[path]


def trie_counts(words: list[str], vocab: Vocabulary) -> dict[str, int]:
    """Tokens of each distinct word. At depth d of the present path: score[d] and tokens[d] of the best segmentation of
    its first d characters, and starts[d], the places from which a piece may still run on past d."""
    scores, begins, unknown = vocab.scores, vocab.begins, vocab.unknown
    score, tokens, starts = [0.0], [0], [[0]]
    out = {}
    before = ""
    for word in sorted(words):
        shared = 0
        for a, b in zip(before, word):
            if a != b:
                break
            shared += 1
        del score[shared + 1:], tokens[shared + 1:], starts[shared + 1:]
        for d in range(shared, len(word)):
            c = word[d]
            best = score[d] + unknown
            least = tokens[d] + len(c.encode("utf-8", "surrogatepass"))
            running = []
            for j in starts[d]:
                piece = word[j:d + 1]
                s = scores.get(piece)
                if s is not None:
                    s += score[j]
                    if s > best or (s == best and tokens[j] + 1 < least):
                        best, least = s, tokens[j] + 1
                if piece in begins:
                    running.append(j)
            running.append(d + 1)
            score.append(best)
            tokens.append(least)
            starts.append(running)
        out[word] = tokens[len(word)]
        before = word
    return out


def count_tokens(docs: DataFrame, vocabulary_path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_words (pre-tokens), n_tokens."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocabulary_path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            lo, size, split = 0, 0, []
            for i in range(batch.num_rows):
                t = texts[i].as_py() or ""
                size += len(t)
                split.append(t.encode("utf-8", "surrogatepass").split())
                if size >= STEP_CHARS or i + 1 == batch.num_rows:
                    distinct = set().union(*split)
                    named = {w: MARK + w.decode("utf-8", "surrogatepass") for w in distinct}
                    counts = trie_counts(list(named.values()), vocab)
                    each = {w: counts[n] for w, n in named.items()}
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(lo, len(split)), pa.array(map(len, split), pa.int64()),
                         pa.array([sum(map(each.__getitem__, ws)) for ws in split], pa.int64())],
                        names=["doc_id", "n_words", "n_tokens"])
                    lo, size, split = i + 1, 0, []

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
