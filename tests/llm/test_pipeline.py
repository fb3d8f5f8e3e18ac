import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from furrow.llm import decontam, language_id, mixing, simhash
from furrow.llm.common import table
from furrow.llm.queries import TOKEN_FILE, tokenizer_path
from tests.llm.test_decontam import plain
from tests.llm.test_near_and_exact import plain_components, plain_simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of every stage, written and read again, after the documents."""
    folder = tmp_path_factory.mktemp("stages")
    out = [table(spark, SF, "documents")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def test_stages_return_the_columns_of_documents(stages):
    for df in stages[:-1]:
        assert [c for c, _ in df.dtypes] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert "pipeline" in entry.queries() and len(corpus_pipeline.STAGES) == 5


def test_language_stage_drops_only_what_has_no_language(stages):
    before, after = stages[0].collect(), {r.doc_id: r for r in stages[1].collect()}
    for r in before:
        letters = sum(c.isalpha() for c in r.text or "")
        if letters >= 1 and r.lang is not None:
            assert after[r.doc_id].text == r.text and after[r.doc_id].lang == r.lang
        if letters == 0:
            assert r.doc_id not in after


def test_one_of_each_near_duplicate_group(stages):
    before = stages[1].collect()
    want = plain_components([r.doc_id for r in before], [plain_simhash(r.text) for r in before], 2)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(set(want))


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = [w[0] for w in plain([(r.doc_id, r.text) for r in stages[2].collect()], items) if not w[5]]
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(clean)
    assert len(clean) < stages[2].count()


def test_the_sample_is_the_report(stages):
    kept = mixing.mix(stages[3]).where("kept").collect()
    assert sorted(r.doc_id for r in stages[4].collect()) == sorted(r.doc_id for r in kept)
    assert 0 < len(kept) < stages[3].count()


def test_tokens_of_the_sample(stages):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(TOKEN_FILE))
    want, start = [], 0
    for r in sorted(stages[4].collect(), key=lambda r: r.doc_id):
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    assert sorted(map(tuple, stages[5].collect())) == sorted(want)


def test_run_is_the_chain(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[5].collect()))


def test_odd_rows_through_all_stages(spark):
    en, fr = "the cat and the other thing that was there on the mat ", "le chat et les autres choses que nous avons vues ici "
    rows = [(i, (en if i % 2 else fr) * (1 + i % 5) + f"w{i} x{i * 7} y{i * 3} " * 4, "en" if i % 2 else "fr", None if i % 9 == 0 else f"s{i % 3}", None)
            for i in range(1, 60)]
    rows += [(100, None, "en", "s1", 0), (101, "", None, None, 0), (102, "12 34", "en", "s1", 5), (103, rows[3][1], "en", "s1", 1), rows[4], rows[4],
             (None, "a text that has no id but says that the cat was there", None, "s1", 1), (104, en * 3000, "en", "s2", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("kept", F.lit("extra"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
    ids = [r.doc_id for r in docs.collect()]
    assert len(ids) == len(set(ids)) and not {100, 101, 102, 103} & set(ids)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(map(str, (r.doc_id for r in out))) == sorted(map(str, ids))


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_language_labels_never_enter_a_prediction(spark):
    docs = table(spark, SF, "documents")
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    a = {r.row.doc_id: (r.lang_pred, r.score) for r in language_id.classify(docs, model).collect()}
    b = {r.row.doc_id: (r.lang_pred, r.score) for r in language_id.classify(other, model).collect()}
    assert a == b


@pytest.mark.parametrize("name", ["my col", "a-b", "a.b", "ä", "`x`", "row", "items", "é `.` -"])
def test_odd_column_names_pass_every_stage(spark, name):
    texts = ["the cat and the dog were there with all of the others " * 2, "le chat et le chien avec tous les autres dans la maison " * 2]
    rows = [(i, texts[i % 2] + f"number {'abcdefghij'[i % 10]}", ["en", "fr"][i % 2], "web", 3, i) for i in range(30)]
    rows += [(None, "another text here", "en", "web", 3, 99), (3, texts[1], "fr", "web", 3, 98)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", name])
    bench = spark.createDataFrame([(1, "nothing like that")], "item_id long, text string")
    for out in (language_id.keep_identified(docs), simhash.keep_one(docs), decontam.decontaminate(docs, bench), mixing.sample(docs)):
        kept = out.collect()
        assert out.columns == docs.columns and kept and {r[5] for r in kept} <= {r[5] for r in rows}
