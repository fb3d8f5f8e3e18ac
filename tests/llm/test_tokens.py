import random
import zlib

import pytest

from furrow.llm import token_counts, token_store
from furrow.llm.common import table
from furrow.llm.queries import TOKEN_FILE, UNIGRAM_FILE, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
TEXTS = ["", " ", "Hello, world.", "a,b .. c., d'll he's 'x", "<|endoftext|> and <|ENDOFTEXT|>", "<|startoftext|>x", "É́cole ét É",
         "naïve — “quoted”… ¿qué?", "x y z\u0085w", "tab\tnl\r\n\x0b\x0cend", "ΑΣ Σίσυφος ΟΔΟΣ", "123 4,567.89", "end.", "end,\nnext.",
         "İstanbul K", "日本語 テキスト", "ªº µ×÷ ß ẞ ﬁ Ǆ ÀÉ,Ö. ÿ", "a\u0301,b e\u0308. \u00a0x", "l\u0027été d\u2019or", "ı İ Å Å", "a\x1cb", "!!###,,,. .,", "it's,we're.", "x" * 3000]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(TOKEN_FILE))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_pieces_give_the_ids_of_the_whole_text(spark, whole):
    code = token_store.Encoder(tokenizer_path(TOKEN_FILE))
    assert code.by_piece
    rng = random.Random(1)
    mixed = [rng.choice(["", " ", "\n", ", "]).join(rng.choices(TEXTS[:-1], k=4)) for _ in range(200)]
    given = [r.text for r in table(spark, SF, "documents").select("text").collect() if r.text]
    for t in TEXTS + mixed + given:
        assert code.encode(t.encode()) == code.pack(whole(t)), t[:80]


def test_forgetting_pieces_changes_nothing(monkeypatch):
    code = token_store.Encoder(tokenizer_path(TOKEN_FILE))
    first = [code.encode(t.encode()) for t in TEXTS]
    monkeypatch.setattr(token_store, "PIECES_KEPT", 1)
    assert [code.encode(t.encode()) for t in TEXTS + TEXTS][len(TEXTS):] == first


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


@pytest.mark.parametrize("parts", [1, 5])
def test_round_trip(spark, whole, tmp_path, parts):
    rows = [(3 * i - 7, t) for i, t in enumerate(TEXTS)] + [(500, None), (21, "again"), (21, "again"), (None, "no id")]
    rows += [(1000 + i, f"some words {i} and more of the same words") for i in range(80)]
    folder = str(tmp_path / "store")
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    token_store.write(docs, folder, tokenizer_path(TOKEN_FILE), parts=parts)
    got = sorted(token_store.read_digest(spark, folder).collect(), key=lambda r: r.start)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = whole(t or "") + [1]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    assert token_store.read_document(spark, folder, 1005) == [(*whole("some words 5 and more of the same words"), 1)]
    assert len(token_store.read_document(spark, folder, 21)) == 2
    assert token_store.read_document(spark, folder, 999_999) == []


def test_given_documents(spark, whole, tmp_path):
    docs = table(spark, SF, "documents")
    out = token_store.store_and_read(docs, str(tmp_path / "s"), tokenizer_path(TOKEN_FILE))
    assert (tmp_path / "s" / "dictionary.zdict").stat().st_size > 256
    want, start = {}, 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = whole(r.text or "") + [1]
        want[r.doc_id] = (start, len(ids), crc(ids))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in out.collect()} == want


def test_other_dictionary_is_refused(spark, tmp_path):
    folder = str(tmp_path / "s")
    token_store.write(spark.createDataFrame([(1, "a")], DOCS), folder, tokenizer_path(TOKEN_FILE))
    (tmp_path / "s" / "dictionary.zdict").write_bytes(b"other")
    with pytest.raises(Exception, match="dictionary hash"):
        token_store.read_document(spark, folder, 1)


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], DOCS)
    assert token_store.store_and_read(none, str(tmp_path / "s"), tokenizer_path(TOKEN_FILE)).count() == 0
    assert token_counts.count_tokens(none, tokenizer_path(UNIGRAM_FILE)).count() == 0


def plain_viterbi(word, vocab):
    best = [(0.0, 0)]
    for d in range(1, len(word) + 1):
        s, k = best[d - 1]
        options = [(s + vocab.unknown, k + len(word[d - 1].encode()))]
        for j in range(max(0, d - vocab.longest), d):
            if word[j:d] in vocab.scores:
                options.append((best[j][0] + vocab.scores[word[j:d]], best[j][1] + 1))
        best.append(max(options, key=lambda o: (o[0], -o[1])))
    return best[-1][1]


def test_counts_are_those_of_each_word_alone(spark):
    vocab = token_counts.Vocabulary.load(tokenizer_path(UNIGRAM_FILE))
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs[:80]] + [(10_000 + i, t) for i, t in enumerate(TEXTS)] + [(20_000, None), (20_001, TEXTS[3]), (20_001, TEXTS[3])]
    got = token_counts.count_tokens(spark.createDataFrame(rows, DOCS), tokenizer_path(UNIGRAM_FILE)).collect()
    want = []
    for i, t in rows:
        ws = [w.decode() for w in (t or "").encode().split()]
        want.append((i, len(ws), sum(plain_viterbi(token_counts.MARK + w, vocab) for w in ws)))
    assert sorted(map(tuple, got)) == sorted(want)


def test_small_vocabularies_with_ties():
    rng = random.Random(4)
    for _ in range(200):
        scores = {"".join(rng.choices("ab", k=rng.randrange(1, 4))): float(rng.randrange(-3, 0)) for _ in range(5)}
        vocab = token_counts.Vocabulary(scores)
        words = ["".join(rng.choices("abc", k=rng.randrange(0, 9))) for _ in range(20)]
        assert token_counts.trie_counts(words, vocab) == {w: plain_viterbi(w, vocab) for w in words}
