import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.llm import language_id, mixing
from furrow.llm.common import table

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_phrases(text, sample):
    n, i = 0, 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i:i + k + 1] in sample and text[i:i + 1] in sample:
            k += 1
        i += k
        n += 1
    return n


def test_phrases_are_the_longest_matches():
    rng = random.Random(2)
    for _ in range(40):
        samples = {lang: "".join(rng.choices(abc, k=rng.randrange(1, 120))) for lang, abc in (("x", "ab c"), ("y", "bcdé "))}
        samples = {k: language_id.normalised(v) or "a" for k, v in samples.items()}
        model = language_id.Model(samples)
        class_of = model.class_of_char()
        texts = [language_id.normalised("".join(rng.choices("abcdéz  ", k=rng.randrange(0, 200)))) for _ in range(10)]
        got = language_id.phrases(model, [language_id._classes(t, class_of) for t in texts])
        assert got.tolist() == [[plain_phrases(t, samples[lang]) for lang in model.langs] for t in texts]


def test_long_texts_restart_at_segments():
    model = language_id.Model({"x": "ab ba abba baba"})
    class_of = model.class_of_char()
    text = language_id.normalised("abba ab baz " * 2000)
    seg = language_id.SEGMENT
    want = sum(plain_phrases(text[i:i + seg], "ab ba abba baba") for i in range(0, len(text), seg))
    assert language_id.phrases(model, [language_id._classes(text, class_of)]).tolist() == [[want]]


def test_classes_equal_the_normalised_text():
    model = language_id.Model({"x": "aé b"})
    class_of = model.class_of_char()
    for t in ("", "  ", "a", "!a--É b?", "1 2", "A\n\nb\t"):
        back = {v: k for k, v in model.letters.items()} | {0: " "}
        assert "".join(back[c] for c in language_id._classes(t, class_of)) == language_id.normalised(t)


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(out) > 100
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.98


def rows():
    en, fr = "the cat and the other thing that was there ", "le chat et les autres choses que nous avons "
    out = [(i, (en if i % 2 else fr) * (1 + i % 3), "en" if i % 2 else "fr", "s", 1) for i in range(60)]
    return out + [(100, None, "en", None, None), (101, "", None, "s", 0), (102, "12 !!", "fr", "s", 5), (103, "Ж" * 40, None, "s", 40),
                  (104, "the other thing", None, "s", 9), (104, "the other thing", None, "s", 9), (None, en, None, None, None),
                  (105, en * 20_000, None, "s", 1), (106, "x", "en", "s", 1)]


def test_cases(spark):
    docs = spark.createDataFrame(rows(), DOCS).withColumn("score", F.lit("clash")).withColumn("row", F.lit(3))
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    for i in (100, 101, 102):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[103].foreign and not got[105].foreign
    assert got[104].lang_pred == got[105].lang_pred == got[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert sum(r.held_out for r in got.values()) == sum(__import__("zlib").crc32(str("" if i is None else i).encode()) % 5 == 0 for i in got)
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns
    back = kept.collect()
    assert {r.doc_id for r in back} == set(got) - {100, 101, 102, 103}
    assert all(r.lang is not None for r in back) and len([r for r in back if r.doc_id == 104]) == 2


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame(rows(), DOCS).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(docs).collect()} == {"und"}
    assert language_id.identify(docs.limit(0)).count() == 0


def test_raking_meets_the_targets(spark):
    rng = np.random.default_rng(4)
    cells = [(f"s{i}", f"l{j}", f"t{k}", int(rng.integers(1, 900))) for i in range(5) for j in range(3) for k in range(4)]
    values = [np.array([c[d] for c in cells], object) for d in range(3)]
    base = np.array([c[3] for c in cells], float)
    targets = [{v: w for v, w in zip(sorted(set(col)), rng.dirichlet(np.ones(len(set(col))) * 5).tolist())} for col in values]
    w = mixing.rake_local(values, base, targets, 200)
    for col, t in zip(values, targets):
        for v, share in t.items():
            assert abs(w[col == v].sum() - share) < 1e-6
    df = spark.createDataFrame(cells, "source string, lang string, topic string, base long")
    goals = {d: spark.createDataFrame(list(t.items()), "value string, target double") for d, t in zip(mixing.DIMS, targets)}
    got = {(r.source, r.lang, r.topic): r.w for r in mixing.rake_spark(df, goals, 3).collect()}
    for c, x in zip(cells, mixing.rake_local(values, base, targets, 3)):
        assert abs(got[c[:3]] - x) < 1e-12


def test_expected_mix_is_the_target(spark):
    docs = table(spark, SF, "documents")
    out = mixing.mix(docs)
    rows = out.collect()
    total = sum(r.n_tokens * r.prob for r in rows)
    for d in mixing.DIMS:
        sums = {}
        for r in rows:
            sums.setdefault(r[d], [0, 0.0])
            sums[r[d]][0] += r.n_tokens
            sums[r[d]][1] += r.n_tokens * r.prob
        raw = {v: s[0] ** mixing.ALPHA for v, s in sums.items()}
        for v, s in sums.items():
            assert abs(s[1] / total - raw[v] / sum(raw.values())) < 1e-3
    kept = {r.doc_id for r in rows if r.kept}
    assert {r.doc_id for r in mixing.sample(docs).collect()} == kept
    assert {r.doc_id for r in mixing.mix(docs, local_cells=0, rounds=25).where("kept").collect()} == kept


def test_mixing_cases(spark):
    docs = spark.createDataFrame(rows(), DOCS).withColumn("prob", F.lit("clash")).withColumn("topic", F.lit(1))
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows()) and all(0 < r.prob <= 1 for r in out)
    assert [r.n_tokens for r in out if r.doc_id in (100, 101)] == [0, 0]
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in out if r.kept)
    assert mixing.mix(docs.limit(0)).count() == 0
    silent = docs.withColumn("text", F.lit(None).cast("string"))
    assert mixing.sample(silent).count() == len(rows())


def test_given_targets(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "en" if i % 4 else "fr", "s", 1) for i in range(400)], DOCS)
    one = lambda d: spark.createDataFrame(list(d.items()), "value string, target double")
    goals = {"source": one({"s": 1.0}), "lang": one({"en": 0.5, "fr": 0.5}), "topic": one({"prose": 1.0})}
    prob = {r.lang: r.prob for r in mixing.mix(docs, targets=goals).collect()}
    assert prob["fr"] == pytest.approx(1.0) and prob["en"] == pytest.approx(1 / 3, abs=1e-6)


def many_letters(rng, n):
    return " ".join("".join(chr(0x4E00 + rng.randrange(900)) for _ in range(rng.randrange(1, 6))) for _ in range(n))


def test_every_letter_of_the_samples_counts():
    """More letters than a byte tells apart; dense and hashed tables give the plain parses."""
    rng = random.Random(6)
    samples = {"zh": language_id.normalised(many_letters(rng, 300)), "ko": "".join(rng.choices([chr(0xAC00 + i) for i in range(400)] + [" "], k=900)).strip(), "en": "the cat and the hat"}
    samples["ko"] = language_id.normalised(samples["ko"])
    assert len({c for t in samples.values() for c in t}) > 600
    texts = [language_id.normalised(many_letters(rng, 12) + samples["ko"][50:80] + " the cat") for _ in range(6)] + [samples["zh"][:200], "z"]
    want = [[plain_phrases(t, samples[lang]) for lang in sorted(samples)] for t in texts]
    for dense in (0, 1 << 30):
        model = language_id.Model(samples, dense)
        assert all((p.table is not None) == bool(dense) for p in model.parsers)
        rows = [language_id._classes(t, model.class_of_char()) for t in texts]
        assert max(map(len, rows)) <= language_id.SEGMENT and language_id.phrases(model, rows).tolist() == want


def test_a_script_that_no_sample_has_is_foreign(spark):
    rng = random.Random(1)
    korean = ["".join(rng.choices([chr(0xAC00 + i) for i in range(600)], k=3)) for _ in range(80)]
    text = lambda words, k: " ".join(rng.choices(words, k=k))
    rows = [(i, text(korean, 60), "ko", "s", 1) for i in range(20)] + [(i + 100, text("the of and a to in is was".split(), 60), "en", "s", 1) for i in range(20)]
    thai = "".join(chr(0x0E01 + i) for i in range(40))
    rows += [(500, " ".join(thai[i:i + 5] for i in range(0, 35, 5)) * 3, None, "s", 1), (501, text(korean, 30), None, "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert got[500].foreign and not got[501].foreign and got[501].lang_pred == "ko"
    kept = {r.doc_id for r in language_id.keep_identified(docs).collect()}
    assert 500 not in kept and 501 in kept
