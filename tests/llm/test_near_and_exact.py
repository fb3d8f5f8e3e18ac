import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.llm import exact_dedup, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def plain_simhash(text):
    import xxhash

    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    runs = [words] if len(words) < 3 else [words[i:i + 3] for i in range(len(words) - 2)]
    hs = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(ids, fps, d):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= d:
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)].append(x)
    return [min(least[find(i)], default=None) for i in range(len(fps))]


def near_texts():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choices(vocab, k=60)) for _ in range(12)]
    rows = []
    for i in range(90):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((1000 - i, " ".join(words)))
    return rows + [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "one two"), (7, "ÉÀ é one two"),
                   (1000, rows[0][1]), (8, "x" * 200_000), (None, "only without id"), (None, base[0])]


def test_simhash_is_the_plain_definition(spark):
    rows = near_texts()
    for _, t in rows:
        assert simhash.simhash((t or "").encode()) == plain_simhash(t)
    one = frame(spark, [(1, "a b c")]).select(F.xxhash64(F.lit("a b c")).alias("h")).first().h
    assert simhash.simhash(b"A b\nC") == one % 2**64


@pytest.mark.parametrize("hot", [0, 3, 64])
def test_components_match_all_pairs(spark, hot):
    rows = near_texts()
    fps = [plain_simhash(t) for _, t in rows]
    want = plain_components([i for i, _ in rows], fps, 2)
    got = simhash.near_duplicates(frame(spark, rows), hot_homes=hot).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    assert sorted([(r.doc_id, r.fp % 2**64, r.component_id) for r in got], key=key) == \
        sorted([(i, f, c) for (i, _), f, c in zip(rows, fps, want)], key=key)


@pytest.mark.parametrize("code", [(simhash.GOLAY,), (simhash.GOLAY, simhash.GOLAY), (simhash.GOLAY, simhash.GOLAY, simhash.HAMMING)])
@pytest.mark.parametrize("distance", [1, 2])
def test_every_near_fingerprint_reaches_the_home(code, distance):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**64, 200, dtype=np.uint64)
    row, home = simhash.anchors_of(x, code, 0)
    assert list(row) == list(range(200))  # a perfect code: one anchor within the radius
    y = x.copy()
    for _ in range(distance):
        y ^= np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)
    at = defaultdict(set)
    for r, a in zip(*simhash.anchors_of(y, code, distance)):
        at[r].add(int(a))
    assert all(int(home[i]) in at[i] for i in range(200))


@pytest.mark.parametrize("hot", [0, 10])
def test_dense_cluster_of_fingerprints(spark, hot):
    rng = random.Random(1)
    center = rng.getrandbits(64)
    fps = sorted({center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(300)})
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    by_doc = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.classes(by_doc, 2, hot).collect()}
    assert [got[f] for f in signed] == plain_components(range(len(fps)), fps, 2)


def test_one_of_each_component_stays(spark):
    rows = near_texts()
    docs = frame(spark, rows).withColumn("root", F.lit("clash")).withColumn("fp", F.lit(1))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = plain_components([i for i, _ in rows], [plain_simhash(t) for _, t in rows], 2)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({w for w in want if w is not None})
    assert ids.count(None) == 1  # the text whose component has no id at all


def test_empty_tables(spark):
    none = frame(spark, []).limit(0)
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0
    assert exact_dedup.exact_duplicates(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_rice_code_round_trip(n):
    rng = np.random.default_rng(n)
    for top in (2**64, 2**20, 3):
        v = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        k, code = exact_dedup.rice_encode(v)
        assert (exact_dedup.rice_decode(code, k, n) == v).all()
    many = np.sort(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    assert len(exact_dedup.rice_encode(many)[1]) < 0.95 * many.nbytes


def exact_rows():
    return [(9, "a  b"), (3, "a\tb"), (5, "a b "), (7, None), (6, ""), (8, " "), (2, "A b"), (11, "a b"), (11, "a b"),
            (12, "é x"), (13, "é x"), (14, "z" * 300_000), (15, "z" * 300_000), (None, "a b"), (None, "q"), (4, "q")] \
        + [(100 + i, "copy copy") for i in range(40)] + [(200 + i, f"text {i}") for i in range(40)]


def plain_exact(rows):
    import hashlib
    import re

    norm = [re.sub("[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm):
        group = [r[0] for r, m in zip(rows, norm) if m == n]
        keep = min((g for g in group if g is not None), default=None)
        out.append((i, keep, len(group), hashlib.sha256(n.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("fingerprint", [F.xxhash64, F.length, lambda c: F.lit(-1)])
def test_exact_groups_also_when_fingerprints_collide(spark, fingerprint):
    rows = exact_rows()
    docs = frame(spark, rows).repartition(3).withColumn("norm", F.lit(1)).withColumn("sender", F.lit(2))
    got = exact_dedup.exact_duplicates(docs, fingerprint=fingerprint).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r[:3]) + (r[-1],)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=key) == sorted(plain_exact(rows), key=key)
    kept = [r for r in got if r.kept]
    assert len({r.text_sha256 for r in kept}) == len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_suspects_are_found_if_partitions_changed(spark):
    rows = [(i, f"t {i % 5}") for i in range(20)]
    src = frame(spark, rows).select("doc_id", F.col("text").alias("norm"), F.xxhash64("text").alias("fp"), F.lit(b"").alias("sha"))
    elsewhere = src.select("doc_id", "fp", "sha", F.lit(99).cast("long").alias("sender"))
    assert exact_dedup.suspect_texts(src, elsewhere).count() == 20


def test_components_of_more_than_a_million_links(spark):
    edges = spark.range(1_200_000).select((F.col("id") * 2 + 1).alias("a"), (F.col("id") * 2).alias("b"))
    got = simhash.components(edges)
    assert got.agg(F.count("*"), F.count_if(F.col("root") == F.col("v") - 1)).first() == (1_200_000, 1_200_000)
