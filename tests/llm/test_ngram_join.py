"""The n-gram join against brute force: components, the trie alone, and its bounds."""
import random
import re

import numpy as np
import pytest

from staffhouse.llm import ngram_join as N

SCHEMA = "doc_id long, text string, rep string, key long, n string, c int, body string, bits string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2, "z", "w") for i, t in rows], SCHEMA)


def word_sets(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i:i + 3]) for i in range(max(len(w) - 2, 1))} if w else set()


def brute(rows):
    sets = [(i, word_sets(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for x in range(len(sets)):
        for y in range(x):
            (i, a), (j, b) = sets[x], sets[y]
            if a and 100 * len(a & b) >= 90 * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted((i, len(s), find(i)) for i, s in sets)


def near_copies(rng, words, n):
    """A text and copies of it with a few words changed, so that some are just above and some just below the bound."""
    base = [rng.choice(words) for _ in range(n)]
    out = []
    for _ in range(rng.randrange(2, 9)):
        copy = list(base)
        for _ in range(rng.randrange(0, max(2, n // 25))):
            copy[rng.randrange(n)] = rng.choice(words) + rng.choice("xyz")
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    out = [None, "", " \n", "one", "ONE", "one two", "One  Two", "one two three", "İ K k é É", "a b c d e f g h i j k", "a b c d e f g h i j k l"]
    for _ in range(40):
        out += near_copies(rng, words, rng.choice([11, 12, 30, 60, 150]))
    passage = " ".join(rng.choice(words) for _ in range(40))
    out += [passage + " " + " ".join(rng.choice(words) for _ in range(20)) for _ in range(60)]
    out += [" ".join(f"v{i % 977}" for i in range(30_000)), " ".join(f"v{i % 977}" for i in range(30_001))]
    found = list(enumerate(out))
    # repeated rows; ids shared by three different texts; no id
    return found + [found[20], found[20], (21, out[200]), (21, out[100]), (21, out[90]), (None, "one two"), (None, None)]


@pytest.mark.parametrize(("weight", "rounds"), [(N.WEIGHT, 2), (300, 1), (300, 0)])
def test_components_match_brute_force(spark, rows, weight, rounds, monkeypatch):
    if rounds == 0:
        monkeypatch.setattr(N, "MEMBERS", 5)
    got = sorted(tuple(r) for r in N.jaccard_components(documents(spark, rows), weight, rounds).collect())
    by_id = {}
    for i, _, c in got:
        by_id.setdefault(i, set()).add(c)
    assert all(len(c) == 1 for c in by_id.values())
    linked = [(i, t) for i, t in rows if i is not None]
    assert sorted((i, n) for i, n, _ in got) == sorted((i, len(word_sets(t))) for i, t in linked)
    full = brute(linked)
    # rows of id 21 join the components of all its texts
    root = {}
    for i, _, c in full:
        root.setdefault(i, set()).add(c)
    joined = set().union(*(root[i] for i in root if i == 21))
    joined |= {c for i, t in linked if i == 21 for j, s in linked if word_sets(s) and len(word_sets(t) & word_sets(s)) * 100 >= 90 * len(word_sets(t) | word_sets(s)) for c in root[j]}
    least = min(joined)
    assert got == sorted((i, n, least if c in joined else c) for i, n, c in full)


def test_components_of_nothing(spark):
    assert N.jaccard_components(documents(spark, [])).count() == 0
    assert [tuple(r) for r in N.jaccard_components(documents(spark, [(3, None)])).collect()] == [(3, 0, 3)]


def test_trie_finds_what_all_pairs_find():
    rng = np.random.default_rng(5)
    for trial in range(60):
        base = rng.choice(400, rng.integers(9, 80), replace=False)
        sets = []
        for _ in range(rng.integers(2, 25)):
            s = np.setdiff1d(base, rng.choice(base, rng.integers(0, max(1, len(base) // 12) + 1)))
            s = np.union1d(s, rng.choice(400, rng.integers(0, max(1, len(base) // 15) + 1)))
            sets.append(s.astype(np.uint64))
        m = len(sets)
        side = rng.integers(0, 2, m) if trial % 3 == 0 else None
        comp = np.arange(m) if trial % 2 else rng.integers(0, max(1, m // 2), m)
        group = {i: int(comp[i]) for i in range(m)}

        def merge(pairs):
            g = dict(group)
            for x, y in pairs:
                old, new = g[x], g[y]
                g = {k: new if v == old else v for k, v in g.items()}
            return {frozenset(k for k in g if g[k] == v) for v in g.values()}
        every = [(x, y) for x in range(m) for y in range(x) if (side is None or side[x] != side[y])
                 and N.similar(len(np.intersect1d(sets[x], sets[y])), len(sets[x]), len(sets[y]))]
        found = N.trie_links(sets, comp, side)
        assert set(map(frozenset, found)) <= set(map(frozenset, every))
        assert merge(found) == merge(every)
        assert len(found) < m


def test_similar_sets_share_an_indexed_and_a_probed_shingle():
    rng = np.random.default_rng(6)
    for _ in range(3000):
        a = np.unique(rng.integers(0, 1000, rng.integers(9, 120)))
        b = np.union1d(np.setdiff1d(a, rng.choice(a, rng.integers(0, 4))), rng.integers(0, 1000, rng.integers(0, 4)))
        if not N.similar(len(np.intersect1d(a, b)), len(a), len(b)):
            continue
        small, large = (a, b) if len(a) <= len(b) else (b, a)
        assert set(small[:N.index_length(len(small))]) & set(large[:N.probe_length(len(large))])
        ka, kb = (x.astype(np.uint64) for x in (a, b))
        fa, fb = (np.frombuffer(N.bitmap(x), np.uint64)[None] for x in (ka, kb))
        while fa.shape != fb.shape:
            fa, fb = (N.folded(fa), fb) if fa.shape[1] > fb.shape[1] else (fa, N.folded(fb))
        assert np.bitwise_count(fa ^ fb).sum() <= len(np.setxor1d(a, b))
    assert all(not N.similar(n, n, n + 1) for n in range(1, N.LEAST - 1))
