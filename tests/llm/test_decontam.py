import hashlib
import random
import re
import weakref

import pytest
from pyspark.sql import functions as F

from furrow.llm import decontam

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    out = []
    for i, t in docs:
        ws, hit, ids = split(t), set(), set()
        for j, it in items:
            iw = split(it)
            n = min(window, len(iw))
            if not n or j is None:
                continue
            grams = {tuple(iw[k:k + n]) for k in range(len(iw) - n + 1)}
            for k in range(len(ws) - n + 1):
                if tuple(ws[k:k + n]) in grams:
                    hit |= set(range(k, k + n))
                    ids.add(j)
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        out.append((i, len(ws), len(hit), len(ids), digest, bool(hit)))
    return out


def cases(seed):
    rng = random.Random(seed)
    vocab = ["a", "b", "Éa", "c9", "übe"] if seed % 2 else [f"w{i}" for i in range(400)]
    say = lambda k: rng.choice([" ", ", ", "\n"]).join(rng.choices(vocab, k=k))
    items = [(j, say(rng.choice([0, 1, 2, 5, 9, 10, 11, 30, 60]))) for j in range(25)]
    items += [(3, say(14)), (100, None), (None, say(12)), (101, "!!"), (102, items[5][1])]
    docs = []
    for i in range(60):
        t = say(rng.randrange(0, 90))
        if rng.random() < 0.6:
            iw = (rng.choice(items)[1] or "").split()
            if iw:
                a = rng.randrange(len(iw))
                t += " " + " ".join(iw[a:a + rng.choice([5, 9, 10, 11, 40])]).upper() + " " + say(3)
        docs.append((i, t))
    docs += [(60, None), (61, ""), (62, "a " * 4000), (63, docs[1][1]), (1, docs[1][1]), (None, docs[2][1])]
    return docs, items


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("block_bytes", [1 << 25, 300])
def test_report_is_the_brute_force(spark, seed, block_bytes):
    docs, items = cases(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.scan(d, b, block_bytes=block_bytes).collect()
    want = plain(docs, items)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([(r.row.doc_id, r.n_words, decontam.covered(r.spans), len(r["items"])) for r in found], key=key) == \
        sorted([w[:4] for w in want], key=key)
    if block_bytes > 300:
        assert sorted([tuple(r) for r in decontam.report(d, b).collect()], key=key) == sorted(want, key=key)


def test_clean_rows_stay_with_their_columns(spark):
    docs, items = cases(2)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words", F.lit("x")).withColumn("items", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string")
    kept = decontam.decontaminate(d, b)
    assert kept.columns == d.columns and kept.dtypes == d.dtypes
    clean = [w[0] for w in plain(docs, items) if not w[5]]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, clean))


def test_empty_tables(spark):
    docs, items = cases(2)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.report(d.limit(0), b).count() == 0
    assert decontam.report(d, b.limit(0)).where("contaminated").count() == 0
    assert decontam.decontaminate(d, b.limit(0)).count() == d.count()


def test_small_steps_give_the_same(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    docs, items = cases(4)
    index = decontam.Index([(j, t.encode()) for j, t in items if t and j is not None], 10)
    batch = pa.RecordBatch.from_arrays(
        [pa.StructArray.from_arrays([pa.array([t for _, t in docs])], names=["text"]), pa.array([0] * len(docs)),
         pa.array([[]] * len(docs), pa.list_(pa.int64())), pa.array([[]] * len(docs), pa.list_(pa.int64()))],
        names=["row", "n_words", "spans", "items"])
    whole = pa.Table.from_batches(decontam._scan_batch(batch, index, 0))
    real = decontam.steps
    monkeypatch.setattr(decontam, "steps", lambda o: real(o, 50))
    assert pa.Table.from_batches(decontam._scan_batch(batch, index, 0)).to_pylist() == whole.to_pylist()
    assert np.sum(whole.column("n_words").to_numpy()) > 0


class Block(list):
    pass


def test_the_driver_holds_one_block_at_a_time(spark, monkeypatch):
    seen = []

    def blocks(*_):
        for i in range(3):
            assert all(r() is None for r in seen)
            block = Block([(i, b"some words")])
            seen.append(weakref.ref(block))
            given = [block]
            del block
            yield given.pop()

    monkeypatch.setattr(decontam, "_blocks", blocks)
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    decontam.scan(docs, docs)
    assert len(seen) == 3


def test_a_task_holds_one_index_at_a_time(spark, monkeypatch):
    """Blocks are run one after the other over groups of batches; the result is that of a single block."""
    import pyarrow as pa

    docs, items = cases(2)
    items = [(j, t) for j, t in items if j is not None]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    b = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.scan(d, b, block_bytes=200)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    key = lambda r: (r.row.doc_id is None, r.row.doc_id or 0, str(r.row.text))
    one = sorted(decontam.scan(d, b).collect(), key=key)
    assert [(r.n_words, sorted(r["items"]), decontam.covered(r.spans)) for r in sorted(out.collect(), key=key)] == \
        [(r.n_words, sorted(r["items"]), decontam.covered(r.spans)) for r in one]
    batches = [pa.RecordBatch.from_pydict({"x": ["a" * 100]}) for _ in range(7)]
    monkeypatch.setattr(decontam, "HELD_BYTES", 250)
    assert [len(p) for p in decontam._parts(iter(batches))] == [3, 3, 1]
