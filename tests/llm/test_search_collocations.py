import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.llm import collocations, ranked_search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_search(docs, items, k=10):
    bags = [(i, Counter(ws), len(ws)) for i, t in docs if (ws := TERM.findall(lowered(t)))]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in {x for x in items if x[1] is not None}:
        found = []
        for i, c, n in bags:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in TERM.findall(lowered(text)) if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


def search_cases(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "Éa", "c9", "übe"] if seed % 2 else [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(400)]
    say = lambda n: rng.choice([" ", ", ", "\n_"]).join(rng.choices(vocab, k=n))
    docs = [(i, say(rng.choice([1, 3, 8, 40, 200]))) for i in range(300)]
    docs += [(i + 1000, docs[7][1]) for i in range(40)]  # ties
    docs += [(7, docs[7][1]), (None, docs[7][1]), (None, "b"), (900, None), (901, ""), (902, " -- "), (903, "a " * 5000)]
    items = [(j, say(rng.choice([1, 2, 10, 30]))) for j in range(20)]
    items += [(50, None), (51, "!!"), (52, "nowhere"), (3, items[3][1]), (3, "a b"), (None, items[4][1]), (60, docs[7][1])]
    return docs, items


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("block_terms", [8192, 7])
def test_search_is_the_brute_force(spark, seed, block_terms):
    docs, items = search_cases(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("key", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    got = ranked_search.search(d.repartition(3), b, block_terms=block_terms if seed < 2 else 8192).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain_search(docs, items), key=key)


@pytest.mark.parametrize("leaf", [1, 3, 32])
def test_tree_bounds_hold_and_prune(monkeypatch, leaf):
    monkeypatch.setattr(ranked_search, "LEAF_DOCS", leaf)
    rng = np.random.default_rng(leaf)
    n, width = 200, 30
    counts = np.where(rng.random((n, width)) < np.linspace(0.8, 0.02, width), rng.integers(1, 9, (n, width)), 0)
    counts[50:90] = counts[49]
    doc, term = np.nonzero(counts)
    m = rng.integers(25, 400, n)
    tree = ranked_search.Tree(doc, term, counts[doc, term], m, width)
    for node, (a, b) in enumerate(tree.ranges):
        rows = tree.row[a:b]
        assert (tree.most[node] == counts[rows].max(axis=0)).all() and tree.least[node] == m[rows].min()
        assert not tree.children[node] or [tree.ranges[c] for c in tree.children[node]][0][0] == a
    weight = rng.integers(0, 5000, width)
    for terms in ([29, 3], list(range(width)), [0]):
        best = []
        tree.search(np.array(terms), weight[terms].astype(np.int64), best, list(range(n)), 5)
        t = counts[:, terms].astype(object)
        score = [int(sum(w * (10**9 * x // (1000 * x + 8 * int(mm))) for w, x in zip(weight[terms].tolist(), row))) for row, mm in zip(t, m)]
        want = sorted(((s, -i) for i, s in enumerate(score) if s > 0), reverse=True)[:5]
        assert sorted([(s, neg) for s, _, neg in best], reverse=True) == want


def test_search_of_nothing(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert ranked_search.search(d, b).collect() == []
    assert ranked_search.search(one, b.limit(0)).collect() == []
    assert [r.asDict() for r in ranked_search.search(one, b).select("item_id", "rank", "doc_id").collect()] == \
        [{"item_id": 1, "rank": 1, "doc_id": 1}]


def grams(rows, longest):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0A-\x0D]", lowered(text)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(ws)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    return f, n


def plain_mine(rows, least, longest=4, top=2000):
    f, n = grams(rows, longest)
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inner = Counter()
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inner[p[i:i + k]] = max(inner[p[i:i + k]], a)
        rows = []
        for p, a in cands.items():
            if 100 * inner[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, lf, rf, n[lang], -s) for i, (s, a, p, lf, rf) in enumerate(sorted(rows)[:top], 1)]
    return out


def phrase_cases(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "é", "x-y", " z", "\x1fq"] if seed % 2 else [f"w{int(rng.paretovariate(0.9)) % 60}" for _ in range(80)]
    rows = []
    for _ in range(120):
        sep = rng.choice([" ", "\t", "  "])
        rows.append((rng.choice(["en", "de", None, "und"]), sep.join(
            w + rng.choice(["", "", "", ",", ".", "\n", "!?"]) for w in rng.choices(vocab, k=rng.choice([0, 1, 5, 40, 150])))))
    return rows + [("en", None), ("en", ""), ("fr", " .. "), ("de", "la la " * 300), ("en", rows[0][1])] * 2


@pytest.mark.parametrize("seed,least,shard_words", [(0, 3, 1 << 20), (1, 5, 50), (2, 2, 7), (3, 30, 400)])
def test_mining_is_the_brute_force(spark, seed, least, shard_words):
    rows = phrase_cases(seed)
    d = spark.createDataFrame(rows, "lang string, text string").withColumn("words", F.lit(1)).withColumn("shard", F.lit("x"))
    got = collocations.mine(d.repartition(3), min_count=least, shard_words=shard_words, owner_keys=shard_words).collect()
    assert sorted(map(tuple, got)) == sorted(plain_mine(rows, least))


def test_first_rows_and_lengths(spark):
    rows = phrase_cases(4)
    d = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, collocations.mine(d, 3, max_words=3, top=5).collect())) == sorted(plain_mine(rows, 3, 3, 5))
    assert sorted(map(tuple, collocations.mine(d, 3, max_words=2).collect())) == sorted(plain_mine(rows, 3, 2))


def test_mining_nothing(spark):
    assert collocations.mine(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert collocations.mine(spark.createDataFrame([(None, None), ("en", "a b")], "lang string, text string")).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_index_extends_on_both_sides(seed):
    rng = np.random.default_rng(seed)
    seq = np.concatenate([[0], rng.integers(0, 5, 300), [0]])
    index = collocations.Index(seq, 4)
    want = Counter(tuple(seq[i:i + k].tolist()) for k in (2, 3, 4) for i in range(len(seq) - k + 1) if seq[i:i + k].all())
    a, b, size = collocations.pairs_of(index)
    got = Counter(dict(zip(zip(a.tolist(), b.tolist()), size.tolist())))
    for words, size in collocations.longer_phrases(index, 4):
        got.update(dict(zip(map(tuple, words.tolist()), size.tolist())))
    assert got == want


@pytest.mark.parametrize("seed", range(4))
def test_chains_keep_all_longer_phrases_of_frequent_pairs(seed):
    rng = np.random.default_rng(seed)
    seq = np.concatenate([[0], rng.integers(0, 6, 200), [0]])
    frequent = np.unique(rng.integers(1, 6, 12) * 6 + rng.integers(1, 6, 12))
    left = collocations.chains(seq, frequent, 5)
    good = {divmod(c, 6) for c in frequent.tolist()}

    def phrases(s):
        runs = [tuple(s[i:i + k].tolist()) for k in (3, 4) for i in range(len(s) - k + 1)]
        return Counter(w for w in runs if all(x in good for x in zip(w, w[1:])))

    assert phrases(left) == phrases(seq) and left[0] == left[-1] == 0
    assert all(x == 0 or y == 0 or (x, y) in good for x, y in zip(left.tolist(), left[1:].tolist()))
    assert collocations.chains(seq, np.array([999]), 5).tolist() == [0, 0]


def test_blocks_come_back():
    codes = np.array([5, 1 << 60, 7, 0])
    got = [(collocations.unpack_sorted(c).tolist(), collocations.unpack(n, np.int32).tolist())
           for _, c, n in collocations._blocks(codes, np.array([1, 2, 3, 4]), 3)]
    assert sorted(x for cs, ns in got for x in zip(cs, ns)) == [(0, 4), (5, 1), (7, 3), (1 << 60, 2)]
    for g in ("en", "a\\nb", "a\nb\tc", "\\", ""):
        assert collocations._language(collocations._named(g).decode()[1:]) == g
