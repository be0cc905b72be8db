"""Operators on texts against brute-force versions, with the awkward rows every operator must survive."""
import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staffhouse.llm import byte_bpe, chat_repair, line_dedup, near_dedup, packed_ids, quality_gam, secret_scan, toxicity_cnn, winnowing
from staffhouse.llm.pieces import units
from staffhouse.llm.queries import op2_secret_scan, op8_packed_ids

SCHEMA = "doc_id long, text string, lang string, th long, found string, score double, n_chars long, _y int"
ODD = [None, "", " ", "\n\n", "a", "one two three four", "İstanbul ÀÉ Kelvin K ſecret=abcdefgh", "x" * 3000, "tab\tand\x0bfeed\x1cnot a space",
       "=" * 700 + " " * 40 + "end", "don't we'll 123abc  two  spaces \n new\n\n\n", "😀".encode("utf-16", "surrogatepass").decode("utf-16") * 9]
LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def documents(spark, rows):
    """Rows of (doc_id, text) with extra columns whose names clash with those the operators add."""
    return spark.createDataFrame([(i, t, "en", 7, "x", 0.5, len(t or ""), 1) for i, t in rows], SCHEMA)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


WORDS = [f"{a}{b}" for a in ("ba", "co", "du", "fi", "gel", "han", "it", "jor") for b in ("ra", "ne", "lt", "s", "mmer", "ody", "x")]


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    rows = list(enumerate(ODD)) + [(100 + i, prose(rng, rng.randrange(1, 90))) for i in range(40)]
    rows += [(200, LONG), (201, LONG), (101, rows[13][1]), (300, "same words here for all of us"), (301, "same words here for all of us")]
    return rows


# --- near duplicates -------------------------------------------------------------------------

def brute_components(rows):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {(i, len(s), find(i), find(i) == i) for i, t in rows for s in [shingles(t)]}


def test_near_duplicates_match_brute_force(spark, odd_rows):
    rng = random.Random(11)
    rows = list(odd_rows)
    for g in range(25):         # groups of copies with more and more changes, chains included
        words = prose(rng, rng.randrange(12, 200)).split()
        for k in range(rng.randrange(2, 8)):
            rows.append((1000 + 10 * g + k, " ".join(words)))
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
    got = {tuple(r) for r in near_dedup.near_duplicates(documents(spark, rows), block=3).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(documents(spark, []).limit(0)).count() == 0
    kept = near_dedup.drop_near_duplicates(documents(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (None, "a b c d e f")]))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4]


def test_bitmaps_never_rule_a_link_out():
    rng = np.random.default_rng(8)
    kept = 0
    for _ in range(2000):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300), dtype=np.uint64))
        b = np.union1d(rng.permutation(a)[:int(len(a) * rng.uniform(0.5, 1))], rng.integers(0, 1 << 63, rng.integers(0, 40), dtype=np.uint64))
        common = len(np.intersect1d(a, b))
        linked = common * 100 >= 75 * (len(a) + len(b) - common)
        may = near_dedup.may_link(np.array([len(a)]), np.array([len(b)]), [near_dedup.bitmap(a)], [near_dedup.bitmap(b)])[0]
        assert may or not linked
        kept += may and not linked
    assert kept < 300


def test_every_pair_within_the_limit_shares_a_key():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, near_dedup.SYMBOLS).astype(np.uint16)
        b = a.copy()
        b[rng.choice(near_dedup.SYMBOLS, near_dedup.LIMIT, replace=False)] += 1
        assert (near_dedup.chunk_keys(np.stack([a, b])) == near_dedup.chunk_keys(np.stack([a, a]))).all(axis=0).any()


def alike(rng, n):
    """``n`` texts of one origin, most of them alike but not similar enough for a link, and near copies of the first."""
    base = prose(rng, 200).split()
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(len(words)), 6):
            words[at] = f"own{i}x{at}"
        rows.append((10 * i, " ".join(words)))
    return rows + [(10 * i + 1, rows[i][1] + " more") for i in range(0, n, 7)]


def block_of(rows):
    ids, texts = zip(*rows)
    sets = pa.Table.from_batches(near_dedup._sets([pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts)], names=["doc_id", "text"])])).to_pydict()
    # one bucket: every pair in it is to be given back under this key, so all symbols of chunk 0 but the first are made equal
    sig = [np.concatenate([[k, 7, 7, 7], np.frombuffer(s, np.uint16)[4:]]).astype(np.uint16).tobytes() for k, s in enumerate(sets["sig"])]
    n, none = len(ids), [0] * len(ids)
    return pa.record_batch({"key": pa.array(none, pa.int64()), "i": pa.array(none, pa.int32()), "j": pa.array(none, pa.int32()), "own": pa.array(none, pa.int32()), "rep": pa.array(ids, pa.int64()),
                            "c": pa.array(ids, pa.int64()), "n": pa.array(sets["n_shingles"], pa.int64()), "sig": pa.array(sig, pa.binary()), "bits": pa.array(sets["bits"], pa.binary())})


def test_pairs_that_cannot_be_links_stay_in_their_block():
    rows = alike(random.Random(5), 80)
    linked = {(a, b) for a, b in ((max(x, y), min(x, y)) for x in dict(rows) for y in dict(rows)) if a == b + 1 and a % 10 == 1}
    got = [tuple(r.values()) for b in near_dedup._across(iter([block_of(rows)])) for r in b.to_pylist()]
    assert len(got) == len(set(got)) and linked <= set(got)
    assert len(got) < len(rows) * 4     # of 92 * 91 / 2 pairs


def test_alike_texts_in_small_blocks_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "ROOM", 60)         # blocks are cut by the texts' lengths as well
    rows = alike(random.Random(6), 30)
    got = {tuple(r) for r in near_dedup.near_duplicates(documents(spark, rows), block=8).collect()}
    assert got == brute_components(rows)


# --- repeated lines --------------------------------------------------------------------------

def brute_line_dedup(rows, least):
    """Every run of lines with its first place: copies that do not overlap it go."""
    docs = sorted({(i, t) for i, t in rows if i is not None}, key=lambda x: (x[0],))
    seqs = []
    for i, t in docs:
        lines = (t or "").split("\n")
        at = [k for k, x in enumerate(lines) if x.strip()]
        seqs.append((i, t, lines, at, [lines[k].strip() for k in at]))
    out, first, runs = {}, {}, []
    for d, s in enumerate(seqs):
        a = s[4]
        for p in range(len(a)):
            words = 0
            for n in range(1, len(a) - p + 1):
                words += len(a[p + n - 1].split())
                if words >= least:
                    run = tuple(a[p:p + n])
                    first.setdefault(run, (d, p))
                    runs.append((d, p, run))
    for d, p, run in runs:
        e, q = first[run]
        # a later copy, whole and apart from the first one
        if (e, q) < (d, p) and (e != d or p >= q + len(run)):
            out.setdefault(d, set()).update(range(p, p + len(run)))
    res = {}
    for d, (i, t, lines, at, _) in enumerate(seqs):
        gone = {at[p] for p in out.get(d, ())}
        res[i, t] = "\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else t
    return res


def test_line_dedup_matches_brute_force(spark, odd_rows):
    rng = random.Random(5)
    rows = [(i, t) for i, t in odd_rows if i != 101]
    blocks = [[prose(rng, rng.randrange(1, 9)) for _ in range(rng.randrange(2, 12))] for _ in range(6)]
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(1, 4)):
            lines += [prose(rng, 3)] + rng.choice(blocks)[rng.randrange(0, 2):] + [""]
        rows.append((1000 + i, "\n".join(lines)))
    rows.append((2000, "again and again\n" * 30))
    rows.append(rows[-2])       # a repeated row
    want = brute_line_dedup(rows, 12)
    got = line_dedup.dedup_lines(documents(spark, rows), min_words=12)
    assert got.columns == documents(spark, []).columns
    seen = [(r.doc_id, r.text, r.n_chars) for r in got.collect()]
    assert len(seen) == len(rows)
    assert sorted((i, t or "") for i, t, _ in seen) == sorted((i, want[i, t] or "") for i, t in rows)
    assert all(n == len(t or "") for _, t, n in seen)


def test_line_dedup_keeps_the_first_copy_whole(spark):
    rows = [(1, "ten words are in this line all of them here\n" * 20), (2, "ten words are in this line all of them here\n" * 4)]
    got = {r.doc_id: r.text.count("ten") for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert got == {1: 5, 2: 4}


def test_columns_with_any_names_stay_in_every_stage(spark):
    rng = random.Random(31)
    names = ["_new", "_cut_id", "_cut_at", "_cut_th", "_gone", "_many", "_key", "_bad_id", "_bad_th", "a.b", "row", "count", "score"]
    texts = [prose(rng, 70) for _ in range(6)]
    rows = [(i, t, *names) for i, t in enumerate([*texts, texts[0], None, "", "kill " + texts[1]])]
    rows += [(3, texts[3], *names), (3, texts[4] + " x", *names), (None, texts[5], *names), (None, texts[5], *names), (-1 << 63, texts[2], *names)]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, 0, int(i == 9)) for i in range(10)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([("q", texts[1])], "item_id string, text string")
    out = toxicity_cnn.drop_toxic(docs, labels)
    assert out.dtypes == docs.dtypes and out.count() == 13
    for step in (lambda d: line_dedup.dedup_lines(d, drop_emptied=True), near_dedup.drop_near_duplicates, lambda d: winnowing.decontaminate(d, bench)):
        got = step(docs)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes
        assert all([r[n] for n in names] == names for r in got.collect())
    ids = sorted((r.doc_id if r.doc_id is not None else "none", (r.text or "")[:20]) for r in near_dedup.drop_near_duplicates(docs).collect() if r.doc_id is not None)
    assert len([i for i, _ in ids]) == len({i for i, _ in ids}), "one row a kept id"
    assert near_dedup.drop_near_duplicates(docs).filter("doc_id is null").count() == 1
    found = {r.doc_id for r in winnowing.contamination(docs, bench).filter("contaminated").collect()}
    assert found == {1, 9}
    assert -1 << 63 in {r.doc_id for r in winnowing.contamination(docs, bench).collect()}


def test_pairs_are_counted_the_same_in_any_batches():
    import pyarrow as pa
    rng = random.Random(2)
    texts = [prose(rng, rng.randrange(0, 60)) + "".join(rng.choice("abcXYZ019") for _ in range(rng.randrange(0, 40))) for _ in range(300)] + ["ab" * 700_000, "", "é" * 5]

    def counts(sizes):
        at, batches = 0, []
        while at < len(texts):
            n = next(sizes)
            batches.append(pa.record_batch([pa.array(texts[at:at + n])], names=["text"]))
            at += n
        return [(x["code"], x["n"]) for b in secret_scan._count(iter(batches)) for x in b.to_pylist()]
    one = counts(iter([len(texts)]))
    assert one and counts(iter(lambda: 1, 0)) == one and counts(iter(lambda: rng.randrange(1, 40), 0)) == one


def test_line_dedup_drops_only_emptied_documents(spark):
    p = " ".join(["word"] * 55)
    rows = [(3, f"{p}\n"), (1, p), (2, f"own start\n{p}\nown end"), (4, ""), (5, None), (None, p)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, rows), drop_emptied=True).collect()}
    assert got == {1: p, 2: "own start\nown end", 4: "", 5: None, None: p}
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


def test_line_dedup_of_a_row_repeated_ten_times_beside_its_copy(spark):
    rng = random.Random(23)
    text = "\n".join(prose(rng, 2) + f" {i}" for i in range(40))
    rows = [(2, text)] * 10 + [(1, text + "\nown end"), (3, "own start\n" + text)]
    assert line_dedup.line_table(documents(spark, rows), line_dedup.MIN_WORDS).count() == 40 + 41 + 41
    got = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(documents(spark, rows)).collect())
    assert got == [(1, text + "\nown end")] + [(2, "")] * 10 + [(3, "own start")]


# --- benchmark decontamination ---------------------------------------------------------------

def brute_contamination(rows, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(len(w), 10)
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[x]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_contamination_matches_brute_force(spark, odd_rows):
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate([40, 25, 10, 11, 9, 5, 1, 3, 30, 0])] + [(20, None), (21, "ÀÉ Kelvin K"), (0, prose(rng, 14)), (22, prose(rng, 40))]
    items.append((23, items[0][1]))
    rows = list(odd_rows)
    for k in range(60):
        w = (items[rng.randrange(len(items))][1] or "").split()
        a = rng.randrange(0, max(1, len(w) - 8))
        rows.append((1000 + k, prose(rng, rng.randrange(0, 20)) + ". " + ", ".join(w[a:a + rng.randrange(8, 25)]).upper() + " - " + prose(rng, 4)))
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = winnowing.contamination(documents(spark, rows), bench).drop("th")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_contamination(rows, items)
    clean = winnowing.decontaminate(documents(spark, rows), bench)
    assert clean.columns == documents(spark, []).columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r[0] for r in brute_contamination(rows, items) if not r[5])


def test_contamination_of_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = winnowing.contamination(documents(spark, [(1, "a b c"), (None, None)]), bench).collect()
    assert {(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in rows} == {(1, 3, 0, False), (None, 0, 0, False)}
    assert winnowing.contamination(documents(spark, []), bench).count() == 0


def test_contamination_has_no_python_on_its_plan(spark, tmp_path):
    docs = documents(spark, [(1, prose(random.Random(1), 40))])
    bench = spark.createDataFrame([(1, prose(random.Random(1), 40))], "item_id long, text string")
    plan = winnowing.contamination(docs, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


# --- tokens ----------------------------------------------------------------------------------

def test_units_join_to_the_text_and_split_like_it():
    import regex
    pattern = regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(2)
    for t in [x for x in ODD if x] + ["".join(rng.choice(" \n\t a1é'! 　s") for _ in range(30)) for _ in range(500)]:
        assert "".join(units(t)) == t
        assert [p for u in units(t) for p in pattern.findall(u)] == pattern.findall(t)


def test_bpe_equals_the_library(spark, odd_rows):
    import tiktoken
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [r for r in odd_rows if r[0] != 201] + [(900, "ab" * 400 + "==" * 300 + "Donaudampfschifffahrt<|endoftext|>")]
    got = byte_bpe.encode(documents(spark, rows), path, public_tokenizers.PATTERN).collect()
    want = sorted((i, own.encode_ordinary(t or "")) for i, t in rows)
    assert sorted((r.doc_id, r.ids) for r in got) == want
    for r in got:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert bytes(r.decoded) == own.decode_bytes(r.ids) and r.decoded_sha256 == hashlib.sha256(r.decoded).hexdigest()
    assert byte_bpe.encode(documents(spark, []), path, public_tokenizers.PATTERN).count() == 0


def test_long_words_are_contracted_like_short_ones():
    c = byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(4)
    words = ["".join(rng.choice("abeinrst-= ") for _ in range(rng.randrange(2, 200))).encode() for _ in range(100)]
    words = [w for w in words if w not in c.ranks]
    assert [[int(i) for i in x.split(",")] for x, _, _ in c.encode_words(words)] == [c._long(w) for w in words]
    assert [raw for _, _, raw in c.encode_words(words)] == words


def test_packing_round_trip():
    rng = np.random.default_rng(6)
    for ids in ([], [0], [1 << 59], [0] * 10_000, rng.integers(0, 50_257, 20_000), rng.integers(0, 4, 9_000), [(1 << 60) - 1, 0, 3] * 4_000,
                2 ** rng.integers(0, 60, 12_345)):
        ids = np.array(ids, np.int64)
        raw = packed_ids.pack(ids)
        assert np.array_equal(packed_ids.unpack(raw), ids)
        if len(ids) > 100:
            assert np.array_equal(packed_ids.unpack(raw, 50, len(ids) - 20), ids[50:-20])
            assert np.array_equal(packed_ids.unpack(raw, 4096, 4097), ids[4096:4097])
    with pytest.raises(ValueError):
        packed_ids.unpack(b"\0" * 24)


def test_packed_files_hold_what_the_library_encodes(spark, odd_rows, tmp_path):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    rows = odd_rows + [(-5, "first <|endoftext|> of all")]
    packed_ids.write(documents(spark, rows + [(None, "left out")]), path, str(tmp_path / "ids"), partitions=5)
    got = packed_ids.read(spark, str(tmp_path / "ids")).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(i for i, _ in rows)
    start = 0
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(own.encode(t or "", add_special_tokens=False).ids + [packed_ids.END])
    for r in got:
        assert r.start == start and r.ids in texts[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    packed_ids.write(documents(spark, []), path, str(tmp_path / "none"))
    assert packed_ids.read(spark, str(tmp_path / "none")).count() == 0


def test_query_of_packed_ids_equals_the_unmodified_library(spark, odd_rows, tmp_path):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    rows = [(i, t) for i, t in odd_rows if i != 101] + [(5000 + k, t) for k, t in enumerate([
        f"a {end} b", end, f"{end}{end}", f"x  {end}  \n{end}\n y.{end}!", f" {end}", f"{end} ", "<|endoftext |>", f"<|endoftext{end}|>", f"don't{end}'t 12{end}3 \n\n {end}\t\t"])]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op8_packed_ids(spark, str(tmp_path)).collect()}
    start = 0
    for i, t in sorted(rows):
        ids = own.encode(t or "", add_special_tokens=False).ids + [packed_ids.END]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
        start += len(ids)
    assert len(got) == len(rows) and own.encode(f"a {end} b", add_special_tokens=False).ids == [64, 220, 50256, 275]


# --- secrets ---------------------------------------------------------------------------------

def brute_base(t):
    t, out = t or "", []
    for k, (pattern, fits) in enumerate(((r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
                                         (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (r"[0-9a-f]+", lambda m: len(m[0]) >= 24))):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, t) if fits(m)]
    return sorted(out)


def test_secrets_match_brute_force_and_keep_prose_clean(spark, odd_rows):
    rng = random.Random(9)
    rows = list(odd_rows)
    alpha = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    for i in range(40):
        rows.append((1000 + i, rng.choice(["é ", ""]) + rng.choice(["PassWord = '", "secret:token:", "api_key\":\"", "AKIA", "token="]) + "".join(rng.choice("ABC019") for _ in range(rng.randrange(3, 30)))
                     + " " + "".join(rng.choice("0123456789abcdef") for _ in range(rng.randrange(10, 70)))))
    planted = {2000 + i: "".join(rng.choice(alpha) for _ in range(64)) for i in range(30)}
    rows += [(i, f"see {s} here") for i, s in planted.items()]
    got = secret_scan.find_secrets(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = {i: [] for i, _ in rows}
    for i, t in rows:
        want[i].append(brute_base(t))
    for r in got:
        base = [(x.s, x.k, x.e) for x in r.found if x.k < 3]
        assert base in want[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
    found = {r.doc_id for r in got if any(x.k == 3 for x in r.found)}
    assert len(found & set(planted)) >= 25
    assert not any(100 <= i < 140 for i in found)
    assert secret_scan.find_secrets(documents(spark, [])).count() == 0


def test_few_random_strings_of_every_alphabet_are_found_among_many_ordinary_runs(spark):
    rng = random.Random(21)
    ordinary = [rng.choice("-_/").join(rng.choice([w, w, w.title(), w.upper(), str(rng.randrange(3000))]) for w in prose(rng, rng.randrange(5, 9)).split()) for _ in range(4000)]
    ordinary += ["".join(w.title() for w in prose(rng, rng.randrange(5, 9)).split()) for _ in range(1000)]
    rows = [(i, f"{prose(rng, 60)} {x} {prose(rng, 20)}") for i, x in enumerate(ordinary)]
    planted = {}
    for name, alphabet in secret_scan.ENCODINGS[1:]:
        for n in (20, 24, 32, 40, 64):
            for _ in range(6):
                planted[10_000 + len(planted)] = (name, n, "".join(rng.choice(alphabet) for _ in range(n)))
    rows += [(i, f"see {s} here") for i, (_, _, s) in planted.items()]
    got = {r.doc_id: {(x.s, x.e) for x in r.found} for r in secret_scan.find_secrets(documents(spark, rows)).collect()}
    for name, _ in secret_scan.ENCODINGS[1:]:
        mine = [i for i, x in planted.items() if x[0] == name]
        assert sum((4, 4 + planted[i][1]) in got[i] for i in mine) >= 0.9 * len(mine), name
    assert sum(bool(got[i]) for i in range(5000)) <= 5


def test_random_values_glued_to_names_and_paths_are_found(spark):
    rng = random.Random(22)
    draw = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    low, b64 = "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    glued = {}
    for k in range(10):
        v = draw(b64, 18) + "/" + draw(b64, 20) + "+"
        for before, value, after in (("AWS_SECRET_ACCESS_KEY=", v, ""), ("sessionid=", draw(low, 32), ""), ("sig=", draw(b64, 43) + "=", ""), ("a=b=", draw(b64, 30), "&x=1"),
                                     ("aws_secret_key_", v, ""), ("/home/user/files/", draw(low, 32), "/index"), ("user_session_", draw(low, 32), "")):
            glued[5000 + len(glued)] = (before, value, after)
    rows = [(i, prose(rng, 60) + " " + "_".join(prose(rng, 6).split()) + "=" + "/".join(prose(rng, 7).split())) for i in range(300)]
    rows += [(i, "see " + "".join(x) + " here") for i, x in glued.items()]
    got = {r.doc_id: [(x.s, x.e) for x in r.found if x.k == 3] for r in secret_scan.find_secrets(documents(spark, rows)).collect()}
    for name in {x[0] for x in glued.values()}:
        mine = [(i, 4 + len(a), 4 + len(a) + len(v)) for i, (a, v, _) in glued.items() if a == name]
        # the value is covered by one span, which takes in little of what it is glued to
        assert sum(any(s <= low and e >= high and e - s <= high - low + 12 for s, e in got[i]) for i, low, high in mine) >= 9, (name, [got[i] for i, _, _ in mine], mine)
    assert not any(got[i] for i in range(300))
    a, b = "a" * 16, "b" * 17
    assert [secret_scan.CANDIDATE.findall(x) for x in (f"{a}={b}==", f"{a}===={b}", f"{a}==.")] == [[a, f"{b}=="], [a, b], [f"{a}=="]]


def test_random_runs_that_base_spans_cover_in_part_are_kept(spark):
    rng = random.Random(24)
    draw = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    rows = [(i, prose(rng, 60)) for i in range(100)]
    hexed = draw("0123456789abcdef", 24)
    long = draw("GHIJKLMNOPQRSTUVWXYZ", 1) + draw("ABCDEFGHJKMNPQRSTVWXYZghjkmnpqrstvwxyz23456789", 39) + "Q" + hexed + "Z"
    value = draw("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 40)
    rows += [(1000, f"see {long} here"), (1001, f"token={value} here")]
    got = {r.doc_id: [(secret_scan.KINDS[x.k], x.s, x.e) for x in r.found] for r in secret_scan.find_secrets(documents(spark, rows)).collect()}
    at = 4 + long.index(hexed)
    assert got[1000] == [("random", 4, 4 + len(long)), ("hex", at, at + 24)]
    assert got[1001] == [("assign", 0, 46)]
    assert [secret_scan.covered(2, 9, x) for x in ([], [(0, 0, 5), (5, 1, 9)], [(0, 0, 5), (6, 1, 9)], [(3, 0, 9)], [(0, 0, 8)])] == [False, True, False, False, False]


# --- models ----------------------------------------------------------------------------------

def labelled(spark, n, target, good, bad):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(n):
        y = rng.random() < 0.5
        rows.append((i, (good if y else bad)(rng)))
        labels.append((i, int(y), int(y), "x") if i % 3 else (i, None, None, "x"))
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score string"), {i: x for i, *x in labels}


def held_out_accuracy(scored, labels, column):
    pairs = [(r.predicted, labels[r.doc_id][column]) for r in scored if r.held_out and r.doc_id in labels and labels[r.doc_id][column] is not None]
    return sum(a == b for a, b in pairs) / len(pairs)


def test_quality_model(spark):
    docs, labels, truth = labelled(spark, 600, "quality", lambda r: prose(r, 60) + ".", lambda r: "!! ".join(prose(r, 40).upper().split()))
    got = quality_gam.score_quality(docs, labels).collect()
    assert len(got) == 600 + len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert held_out_accuracy(got, truth, 0) > 0.97
    none = quality_gam.score_quality(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_gam.score_quality(documents(spark, []), labels).count() == 0


def test_quality_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, len(quality_gam.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 7] > 0.5)).astype(float)
    model = quality_gam.Gam(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_toxicity_fit_holds_the_tables_of_one_width_and_gives_memory_back(spark, monkeypatch):
    docs, labels, _ = labelled(spark, 300, "toxic", lambda r: prose(r, 30) + " grimble " + prose(r, 20), lambda r: prose(r, 50))
    held, tables, trimmed, rng = [], toxicity_cnn.Cnn.tables, [], np.random.default_rng(2)

    def recorded(self, *rows, **widths):
        tables(self, *rows, **widths)
        held.append(sum(t.nbytes for k in self.t.values() for t in k))
    monkeypatch.setattr(toxicity_cnn.Cnn, "tables", recorded)
    monkeypatch.setattr(toxicity_cnn, "give_back", lambda: trimmed.append(1))
    model = toxicity_cnn.fit(docs, labels, F.lit(True))
    assert trimmed and not model.t
    assert max(held) <= 3 * toxicity_cnn.BUCKETS * toxicity_cnn.FILTERS * 4     # all six are twice as much
    texts = [rng.integers(0, toxicity_cnn.BUCKETS, (n, 2)).astype(np.int32) for n in (0, 1, 2, 3, 40, 9000)]
    z = model.logits(texts)
    model.tables()
    assert z.tolist() == [model.logit(t) for t in texts]


def test_toxicity_model(spark):
    docs, labels, truth = labelled(spark, 500, "toxic", lambda r: prose(r, 30) + " grimble " + prose(r, 20), lambda r: prose(r, 50))
    got = toxicity_cnn.score_toxicity(docs, labels).collect()
    assert len(got) == 500 + len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert held_out_accuracy(got, truth, 1) > 0.95
    kept = toxicity_cnn.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}
    assert {r.predicted for r in toxicity_cnn.score_toxicity(docs, labels.limit(0)).collect()} == {0}
    assert toxicity_cnn.score_toxicity(documents(spark, []), labels).count() == 0


def test_toxicity_is_learnt_from_all_labelled_rows(spark):
    """One of 800 rare words tells whether a text is toxic: a sample of ``bound`` rows lacks most of them."""
    rng = random.Random(5)
    rare = ["".join(rng.choice("bcdfghjkmpqvwxz") for _ in range(7)) for _ in range(800)]
    rows, toxic = [], {}
    for i in range(6000):
        toxic[i] = int(rng.random() < 0.5)
        word = rare[2 * rng.randrange(400) + toxic[i]]
        rows.append((i, prose(rng, 4) + " " + word + " " + prose(rng, 4)))
    labels = [(i, 0, y) for i, y in toxic.items()] + [(i, 0, 1 - toxic[i]) for i in range(0, 40, 4) for _ in range(2) if toxic[i]] + [(30_000, 0, 1), (None, 0, 1), (7, 0, None)]
    docs, labels = documents(spark, [*rows, rows[3], (None, "kill"), (20_000, None)]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity_cnn.score_toxicity(docs, labels, bound=600).collect()}
    held = [r for i, r in got.items() if i in toxic and r.held_out]
    assert len(got) == 6002 and sum(r.predicted == toxic[r.doc_id] for r in held) > 0.9 * len(held)
    again = {r.doc_id: r for r in toxicity_cnn.score_toxicity(docs.repartition(5), labels.repartition(3), bound=600).collect()}
    assert {i: r.score for i, r in got.items()} == {i: r.score for i, r in again.items()}
    one = toxicity_cnn.score_toxicity(docs, labels.filter("toxic = 0"), bound=200)
    assert {r.predicted for r in one.collect()} == {0}


def test_language_is_told_from_the_text():
    buckets = toxicity_cnn.Buckets()
    for name, text in (("en", "The cat and the dog"), ("de", "Der Hund und die Katze"), ("fr", "Le chat et les chiens"), ("es", "El gato y los perros"), ("other", "")):
        assert toxicity_cnn.NAMES[toxicity_cnn.tokens(text, buckets)[1]] == name


def test_secret_query_columns(spark):
    df = op2_secret_scan(spark, "/root/testdata/sf0.001")
    assert df.columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert df.filter(F.size(F.split("spans", ",")) < F.col("n_assign")).count() == 0


# --- conversations ---------------------------------------------------------------------------

def brute_cost(roles):
    best = {chat_repair.START: 0}
    for r in roles:
        new = {}
        for state, cost, to, _, _ in chat_repair.MOVES[r]:
            if state in best:
                new[to] = min(new.get(to, 1 << 50), best[state] + cost)
        best = new
    return min(c + int(chat_repair.END[s]) for s, c in best.items())


def test_conversations_are_legal_cheapest_and_the_same_in_any_blocks(spark):
    rng = random.Random(1)
    convs = {i: [rng.choice(["user", "assistant", "system", "Human", "tool", None]) for _ in range(rng.randrange(1, 14))] for i in range(40)}
    convs[99] = [rng.choice(["user", "assistant"]) for _ in range(700)]
    rows = [(i, k, r, None if k % 7 == 3 else f"t{k}", "z") for i, x in convs.items() for k, r in enumerate(x)]
    rng.shuffle(rows)
    schema = "conv_id long, turn long, role string, text string, part string"
    results = []
    for parts in (1, 9):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            out = chat_repair.repair(spark.createDataFrame(rows, schema)).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
        by = {}
        for r in sorted(out, key=lambda r: (r.conv_id, r.at, r.sub)):
            by.setdefault(r.conv_id, []).append(r)
        results.append({i: [(r.out_turn, r.action, r.out_role, r.piece) for r in x] for i, x in by.items()})
        for i, x in by.items():
            assert {r.cost for r in x} == {brute_cost([chat_repair.role_number(r) for r in convs[i]])}
            turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", "".join(r.piece for r in x), re.S)
            roles = [r for r, _ in turns]
            rest = roles[1:] if roles[0] == "system" else roles
            assert rest == ["user", "assistant"] * (len(rest) // 2) and rest or roles == []
            assert len(roles) == x[-1].out_turn
            assert " ".join(t for _, t in turns).split() == [f"t{k}" for k in range(len(convs[i])) if k % 7 != 3]
    assert results[0] == results[1]


def test_conversations_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat_repair.repair(spark.createDataFrame([], schema)).count() == 0
    odd = [(None, None, None, None), (1, 1, "user", "same"), (1, 1, "user", "same"), (2, None, "assistant", "x" * 100_000)]
    out = chat_repair.repair(spark.createDataFrame(odd, schema))
    assert {r.conv_id for r in out.select("conv_id").distinct().collect()} == {None, 1, 2}
    assert [r.action for r in out.filter("conv_id = 1").orderBy("at", "sub").collect()] == ["keep", "merge", "insert", "end"]
