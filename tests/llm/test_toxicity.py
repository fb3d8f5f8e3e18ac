import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.llm import toxicity
from furrow.llm.common import table
from furrow.llm.queries import op11_toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def plain_match(word, terms):
    out = {}
    for i, (term, stem) in enumerate(terms):
        d = min(distance(word[:k], term) for k in range(len(word) + 1)) if stem else distance(word, term)
        if d <= toxicity.edits_allowed(term):
            out[i] = d
    return out


@pytest.mark.parametrize("seed", range(4))
def test_automaton_is_the_edit_distance(seed, monkeypatch):
    if seed == 3:
        monkeypatch.setattr(toxicity, "STATES", 5)
    rng = random.Random(seed)
    letters = "abé" if seed % 2 else "abcdé𝔘"
    say = lambda n: "".join(rng.choices(letters, k=n))
    terms = list({say(rng.choice([3, 4, 5, 7, 8, 11])): rng.random() < 0.4 for _ in range(12)}.items())
    matcher = toxicity.Matcher(terms)
    words = [say(rng.randrange(1, 14)) for _ in range(300)] + [t for t, _ in terms] + ["z", "zz" * 9]
    for t, _ in terms:
        for _ in range(6):
            w = list(t)
            for _ in range(rng.randrange(4)):
                i = rng.randrange(len(w) + 1)
                w[i:i + rng.randrange(2)] = rng.choice([[], [rng.choice(letters + "z")]])
            words.append("".join(w) or "a")
    for part in (words[:100], words):
        got = matcher.match(list(dict.fromkeys(part)))
        assert {w: dict(f) for w, f in got.items()} == {w: m for w in part if (m := plain_match(w, terms))}
    assert toxicity.Matcher([]).match(["a"]) == {} and matcher.match([]) == {}


def kinds(text, words=("idiot",)):
    hits = {w: ((0, 0),) for w in words}
    return [(k, close) for _, _, k, close in toxicity.evidence(text, hits)]


def test_windows_tell_quotation_from_abuse():
    P, R, M = toxicity.PLAIN, toxicity.REPORTED, toxicity.MARKED
    assert kinds("You are an idiot, go away.") == [(P, False)]
    assert kinds('She called him "an idiot" twice.') == [(M, False)]
    assert kinds("Elle cite « quel IDIOT » ici") == [(M, False)] == kinds("„idiot“ ist ein Wort") == kinds("the word ‘idiot’ here")
    assert kinds("> what an idiot\nPlease don't.") == [(M, False)]
    assert kinds("He said you are an idiot.") == [(R, False)]
    assert kinds('"No." idiot "Yes."') == [(P, False)]
    assert kinds('"' + "a " * 30 + "idiot " + "b " * 30 + '"') == [(P, False)]
    assert kinds("idiot idiot") == [(P, True)] * 2
    assert kinds("idiot " + "far away words " * 5 + "idiot") == [(P, False)] * 2
    assert kinds("") == kinds("nothing") == []


VOCAB = [a + b + c for a in ("ba", "de", "fi", "lo", "mu", "ra", "so") for b in ("n", "st", "r") for c in ("a", "elo", "im", "ung")]
BAD = ["grobwort", "schimpf", "pfuibah"]


def corpus(n=700, seed=5):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(VOCAB, k=rng.choice([20, 60, 200]))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(max(2, len(words) // 25)):
                bad = rng.choice([*BAD, "quak" + rng.choice(VOCAB)])
                words.insert(rng.randrange(len(words)), bad)
        docs.append((i, " ".join(words).capitalize() + "."))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus()
    return toxicity.train(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(labels, "doc_id long, toxic int"))


def scores(spark, model, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit("x"))
    return [r.score for r in toxicity.score(d.repartition(2), model).orderBy("doc_id").collect()]


def test_learned_terms_and_misspellings(spark, model):
    assert {*BAD} <= {t for t, stem in model.terms if not stem} and ("quak", True) in model.terms
    rng = random.Random(9)
    say = lambda *bad: " ".join([*rng.choices(VOCAB, k=20), *bad, *rng.choices(VOCAB, k=20)])
    exact, near, marked, clean, long = scores(spark, model, [
        say("grobwort", "schimpf"), say("gropwort", "grobwrt"), say('"grobwort', 'schimpf"'), say(),
        " ".join(rng.choices(VOCAB, k=5000)) + " schimpf"])
    assert exact > 0.9 and near > 0.5 and clean < 0.1 and marked < 0.5 < near and long < 0.5
    assert 0 <= clean <= marked < near <= exact <= 1


def test_held_out_accuracy(spark, model):
    docs, labels = corpus(300, seed=77)
    got = scores(spark, model, [t for _, t in docs])
    assert sum((s >= 0.5) == bool(y) for s, (_, y) in zip(got, labels)) >= 0.98 * len(docs)


def test_cases(spark, model):
    blank = scores(spark, model, [None, "", " \n", "!!!"])
    assert len(set(blank)) == 1 and 0 <= blank[0] < 0.5
    assert scores(spark, model, ["schimpf " * 200_000])[0] > 0.9
    d = spark.createDataFrame([], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.assess(d, none).collect() == []
    some = spark.createDataFrame([(1, "schimpf"), (1, "schimpf"), (None, "b"), (2, None)], "doc_id long, text string")
    got = toxicity.assess(some, none).collect()
    assert len(got) == 4 and all(r.predicted == 0 and r.score == pytest.approx(1e-6) for r in got)
    odd = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    assert len(toxicity.assess(some, odd).collect()) == 4


def test_labels_of_the_fold_change_nothing(spark):
    docs, labels = corpus(300)
    fold = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    d = spark.createDataFrame(docs, "doc_id long, text string")
    runs = []
    for flip in (False, True):
        given = spark.createDataFrame([(i, 1 - y if flip and i in fold else y) for i, y in labels], "doc_id long, toxic int")
        rows = toxicity.assess(d, given).orderBy("doc_id").collect()
        assert {r.doc_id for r in rows if r.held_out} == fold
        runs.append([(r.doc_id, r.score, r.predicted) for r in rows])
    assert runs[0] == runs[1]


def test_given_documents(spark):
    """Held-out rows; near copies whose marked words are gone keep their label in the given table."""
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op11_toxicity(spark, sf).collect()}
    known = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    assert len(got) == table(spark, sf, "documents").count()
    held = [(got[i].predicted, y) for i, y in known.items() if i in got and got[i].held_out]
    assert sum(p == y for p, y in held) >= 0.95 * len(held) and sum(p == 1 for p, y in held if y == 0) <= 2


def test_rates_and_strength():
    assert toxicity.strength(1, 10, 0.04) == 1 and toxicity.strength(1, 100, 0.04) == pytest.approx(0.25)
    hits = Counter({(0, 0, toxicity.PLAIN, True): 1, (0, 0, toxicity.PLAIN, False): 1, (0, 1, toxicity.MARKED, True): 4})
    s = toxicity.sums(hits, 100, np.array([[2.0, 1.0, 0.0]]), np.array([0.04]))
    assert s.tolist() == pytest.approx([1.0, 0, 1.0, 0.5])
