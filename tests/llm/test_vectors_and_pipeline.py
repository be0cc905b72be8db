"""The permutation index against brute force, and the pipeline against its stages one by one."""
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from staffhouse.llm import components, permutation_index
from staffhouse.llm.queries import LLM_ORACLE, LLM_QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec string, is_q string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x", "y", "z") for i, v in rows], SCHEMA)


def brute(rows, queries, k=5):
    ok = {}
    for i, v in rows:
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in ok:
        if q % queries == 0:
            s = [(-float(ok[q] @ v / np.sqrt((ok[q] @ ok[q]) * (v @ v))), i) for i, v in ok.items() if i != q]
            out[q] = sorted(s)[:k]
    return out


def test_search_of_few_vectors_is_exact(spark):
    rows = [(0, [1, 0, 0]), (1, [1, 0, 0]), (2, [2, 0, 0]), (3, [0, 1, 0]), (4, [0, 0, 0]), (6, None), (7, []), (8, [1, None, 2]), (9, [float("nan"), 1, 1]),
            (10, [1, float("inf"), 0]), (12, [1, 1, 0]), (13, [1, 1, 0]), (14, [-1, 0, 0]), (0, [1, 0, 0])]
    got = permutation_index.search(vectors(spark, rows), F.col("vec_id") % 2 == 0).orderBy("query_id", "rank").collect()
    want = brute(dict(rows).items(), 2)
    assert {r.query_id for r in got} == set(want)
    for q, best in want.items():
        own = [r for r in got if r.query_id == q]
        assert [r["rank"] for r in own] == list(range(1, len(best) + 1))
        assert np.allclose([r.score for r in own], [-s for s, _ in best], atol=1e-12)
        assert q not in {r.vec_id for r in own}
    assert [r.vec_id for r in got if r.query_id == 0] == [1, 2, 12, 13, 3]


def test_search_of_nothing(spark):
    assert permutation_index.search(vectors(spark, []), F.col("vec_id") % 2 == 0).count() == 0
    assert permutation_index.search(vectors(spark, [(2, [1.0, 2.0])]), F.col("vec_id") % 2 == 0).count() == 0


def test_recall_over_many_vectors_and_copies(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 32)).astype(np.float32)
    x[3000:5000] = x[17]                                    # a third of all rows is one vector
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    got = permutation_index.search(vectors(spark, rows), F.col("vec_id") % 50 == 0, block_rows=700, query_rows=40).collect()
    want = brute(rows, 50)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    hits = [len({r.vec_id for r in by[q]} & {i for _, i in best}) / 5 for q, best in want.items() if not 3000 <= q < 5000]
    assert np.mean(hits) >= 0.9
    assert sorted(r.vec_id for r in by[3050]) == [17, 3000, 3001, 3002, 3003]
    assert all(len(v) == 5 for v in by.values()) and set(by) == set(want)


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 400)] + [(500, 500), (None, 3), (7, None)]
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {i: find(i) for i in parent} and len(got) == len(parent)


def test_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    assert sorted(int(k[2:].split("_")[0]) for k in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_ORACLE) <= set(LLM_QUERIES)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A few hundred documents whose fate is known, as the tables of a folder."""
    rng = random.Random(7)
    words = [a + b + c for a in ("ba", "co", "du", "fi") for b in ("ra", "ne", "lo") for c in ("m", "st", "nd", "ly")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs, labels, fate = [], [], {}
    for i in range(300):
        toxic = rng.random() < 0.3
        docs.append((i, prose(40) + (" vilename" if toxic else "") + "\n" + prose(20)))
        labels.append((i, 1, int(toxic)))
        fate[i] = "toxic" if toxic else "kept"
    item, passage = prose(30), prose(70)
    for i in range(300, 310):
        docs.append((i, f"{prose(30)}\n{passage}\n{prose(30)}"))
        fate[i] = "kept"
    base = [prose(12) for _ in range(8)]
    for i in range(310, 314):       # near copies: short lines, changed here and there, no run of 50 words in common
        docs.append((i, "\n".join(x + f" {prose(1)}" if k % 4 == 3 and i > 310 else x for k, x in enumerate(base))))
        fate[i] = "kept" if i == 310 else "near"
    docs.append((320, docs[0 if fate[0] == "kept" else next(i for i in fate if fate[i] == "kept")][1]))
    fate[320] = "emptied"
    docs.append((321, f"{prose(10)} {' '.join(item.split()[3:18])} {prose(10)}"))
    fate[321] = "benchmark"
    docs += [(322, None), (323, "")]
    fate |= {322: "kept", 323: "kept"}
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, fate, passage


def test_pipeline(spark, small):
    folder, fate, passage = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left, names = docs, {}
    for (name, step), gone in zip(corpus_pipeline.STAGES[:-1], ("toxic", "emptied", "near", "benchmark")):
        after = step(spark, left, folder)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        names[name] = {r.doc_id for r in left.collect()} - {r.doc_id for r in after.collect()}
        wrong = names[name] ^ {i for i, f in fate.items() if f == gone}
        assert len(wrong) <= (6 if gone == "toxic" else 0), (name, sorted(wrong))
        fate = {i: f for i, f in fate.items() if i not in names[name]} if gone != "toxic" else {i: ("kept" if f == "toxic" else f) for i, f in fate.items() if i not in names[name]}
        left = spark.createDataFrame(after.collect(), docs.schema)
    assert sum(passage in (r.text or "") for r in left.collect()) == 1
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in left.collect()}
    text = {r.doc_id: r.text or "" for r in left.collect()}
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids) for r in got)
