"""Operators 11 to 13 against brute-force versions: awkward rows, small chunks and tiles, empty tables."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from formsieve.llm import prefix_trie, topk, whitening

TURNS = "conv_id long, turn long, role string, text string, n string, pos int, sym string, end string"
VECTORS = "vec_id long, embedding array<double>, id int, dims string, score string, block int"


# ------------------------------------------------------------------ prefix trie

def make_turns(seed, n, longest, words):
    rng, rows = random.Random(seed), []
    for c in range(n):
        size = rng.choice([0, 1, 2, 3, 5, longest])
        turns = [(c, t, rng.choice(["user", "bot"]), rng.choice(words)) for t in range(size)]
        rng.shuffle(turns)
        rows += turns
    return rows


def brute_trie(rows):
    key = lambda r: hashlib.md5(f"{len(r[0])}:{r[0]}{r[1]}".encode()).hexdigest() + f"{len(r[1]):08X}"
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v, key=lambda r: (r[0], key(r[1])))] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((m[0], len(p), members[p[:-1]][0] if p else -1, len(m), children.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()) for p, m in members.items())


def trie_rows(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == cols
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


WORDS = ["hi", "", "tell me more", "é日本", "no " * 2000]
AWKWARD = [(7, None, "user", "first by null"), (7, 0, None, None), (7, 1, "user", "x"), (7, 1, "user", "x"), (7, 1, "bot", "tie"),
           (None, 0, "user", "no id"), (None, None, None, None), (300, 0, "", ""), (301, 0, None, ""), (399, 5, "user", "alone in its group")]


@pytest.mark.parametrize("chunk,longest", [(1024, 7), (2, 23), (4, 70)])
def test_prefix_trie(spark, chunk, longest):
    """Also with chunks of few turns, so that chunks of chunks are named and summed."""
    rows = make_turns(chunk, 260, longest, WORDS[:3] if longest > 20 else WORDS) + (AWKWARD if chunk == 1024 else [])
    if longest > 20:  # long shared prefixes that part late
        rows += [(1000 + c, t, "user", "same" if t < longest - c % 3 else str(c % 2)) for c in range(9) for t in range(longest)]
    df = spark.createDataFrame([(*r, "clash", 1, "clash", "clash") for r in rows], TURNS).repartition(5, "text")
    assert trie_rows(prefix_trie.build(df, chunk=chunk)) == brute_trie(rows)


def test_prefix_trie_of_turnless_and_empty(spark):
    assert prefix_trie.build(spark.createDataFrame([], TURNS)).count() == 0
    c = next(i for i in range(101, 200) if zlib.crc32(str(i).encode()) % 6 >= 3)
    rows = [(c, 0, "user", "a"), (c, 1, "bot", "b")]  # its first turns go and no base conversation gives others
    got = trie_rows(prefix_trie.build(spark.createDataFrame([(*r, "", 1, "", "") for r in rows], TURNS)))
    assert got == brute_trie(rows) and len(got) == 1 and got[0][:7] == (c, 0, -1, 1, 0, 1, 0)


def test_path_names_of_a_whole_are_those_of_its_parts():
    seq = "".join(hashlib.md5(bytes([i])).hexdigest() for i in range(16))
    names = prefix_trie.path_names("r", seq, 32)
    for half in (8, 4, 2, 1):
        assert prefix_trie.path_names("r", seq[:half * 32], 32) == names[:half]
        assert prefix_trie.path_names(names[half - 1], seq[half * 32:2 * half * 32], 32)[:half - 1] == names[half:2 * half - 1]


def test_id_digests_over_several_pieces(spark):
    ids = list(range(5, 60_000, 2))
    df = spark.createDataFrame([("a" if i % 3 else "b", i) for i in ids], "whole string, conv long").repartition(7)
    got = {r["whole"]: r["ends_sha256"] for r in prefix_trie.id_digests(df).collect()}
    for k in "ab":
        assert got[k] == hashlib.sha256(",".join(str(i) for i in ids if ("a" if i % 3 else "b") == k).encode()).hexdigest()


# ------------------------------------------------------------------ whitening

def some_vectors(n, dims, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * np.linspace(0.2, 1.5, dims) + rng.normal(size=dims)
    return [(i, v.tolist(), 1, "clash", "clash", 1) for i, v in enumerate(x)]


BAD = [(900, None, 1, "", "", 1), (901, [], 1, "", "", 1), (902, [1.0, None, 2.0, 3.0] + [0.0] * 6, 1, "", "", 1),
       (903, [1.0, math.nan, 2.0, 3.0] + [0.0] * 6, 1, "", "", 1), (904, [math.inf] * 10, 1, "", "", 1), (905, [1.0, 2.0], 1, "", "", 1)]


def check_white(rows, kept, k=8):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    z = (n * x - s).astype(float) / n
    v = z.T @ z / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    dev = ((n * x - s) ** 2).sum(axis=1)
    got = defaultdict(dict)
    for r in rows:
        assert r["n"] == n
        got[r["component"]].setdefault(r["vec_id"], []).append(r)
    assert sorted(got) == list(range(1, len(e) + 1))
    for c, by_id in got.items():
        assert sum(map(len, by_id.values())) == n
        white = z @ u[:, c - 1] / math.sqrt(e[c - 1])
        first = max(range(n), key=lambda i: abs(white[i]))
        sign = np.sign(by_id[kept[first][0]][0]["whitened"] * white[first])
        for i, (vec, _) in enumerate(kept):
            r = by_id[vec][0]
            assert r["deviation"] == dev[i]
            assert r["whitened"] == pytest.approx(sign * white[i], rel=1e-7, abs=1e-7)
            assert r["explained"] == pytest.approx(e[c - 1] / np.trace(v), rel=1e-9)
            assert r["identity_error"] < 1e-9


@pytest.mark.parametrize("n,dims", [(400, 10), (60, 3), (5, 4)])
def test_whitening(spark, n, dims):
    rows = some_vectors(n, dims)
    df = spark.createDataFrame(rows + [r for r in BAD if dims == 10], VECTORS).repartition(4)
    got = whitening.whiten(df, whitening.fit(df))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_white(got.collect(), [(r[0], r[1]) for r in rows])


def test_whitening_of_repeated_rows_and_null_ids(spark):
    rows = some_vectors(50, 4)
    rows += [rows[3], (None, rows[4][1], 1, "", "", 1)]
    df = spark.createDataFrame(rows, VECTORS)
    got = whitening.whiten(df, whitening.fit(df)).collect()
    assert len(got) == 52 * 4 and sum(r["vec_id"] == 3 for r in got) == 8 and sum(r["vec_id"] is None for r in got) == 4
    assert all(r["identity_error"] < 1e-9 for r in got)


def test_whitening_without_variance_and_without_rows(spark):
    df = spark.createDataFrame(BAD, VECTORS).filter("vec_id < 905")
    assert whitening.fit(df) is None and whitening.whiten(df, None).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], 1, "", "", 1) for i in range(3)], VECTORS)
    got = whitening.whiten(same, whitening.fit(same)).collect()
    assert len(got) == 6 and all(r["whitened"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in got)
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 1, "", "", 1) for i in range(9)], VECTORS)
    got = whitening.whiten(line, whitening.fit(line)).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in got) and got[0]["identity_error"] < 1e-9
    far = spark.createDataFrame([(1, [1e300], 1, "", "", 1), (2, [-5e12], 1, "", "", 1), (3, [0.0], 1, "", "", 1)], VECTORS)
    assert all(r["deviation"] is None for r in whitening.whiten(far, whitening.fit(far)).collect() if r["vec_id"] == 1)


@pytest.mark.parametrize("kind", ["spread", "sphere", "equal", "blocks", "rank", "one", "graded"])
def test_components_equal_a_dense_solver(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 48))
    v = {"spread": np.cov((x * np.linspace(1, 9, 48)).T), "sphere": np.cov(x.T), "equal": np.eye(20), "blocks": np.diag([5.0] * 10 + [1.0] * 3),
         "rank": np.cov(x[:5].T), "one": np.array([[3.0]]), "graded": np.diag(10.0 ** -np.arange(20))}[kind]
    e, u = whitening.components(v)
    assert e == pytest.approx(np.linalg.eigvalsh(v)[::-1][:len(e)], abs=1e-13 * np.abs(v).max())
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13
    assert np.abs(v @ u - u * e).max() < 1e-12 * np.abs(v).max()


def test_inertia_counts_eigenvalues():
    v = np.cov(np.random.default_rng(5).normal(size=(200, 30)).T)
    form = whitening.tridiagonal(v)
    for s in (-1.0, 0.3, 0.9, 1.0, 1.4, 9.0):
        assert whitening.count_above(form, s) == (np.linalg.eigvalsh(v) > s).sum()


# ------------------------------------------------------------------ top-k

def brute_topk(rows, every, k):
    best = {}
    for i, v, *_ in rows:
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v):
            best.setdefault(i, v)
    x = {i: [math.floor(256 * c) for c in v] for i, v in best.items()}
    out = []
    for q in sorted(i for i in x if i % every == 0):
        long = lambda s: max(-(2 ** 63 - 1), min(2 ** 63 - 1, s))
        hits = sorted((-long(sum(a * b for a, b in zip(x[q], x[c]))), c) for c in x if c != q and len(x[c]) == len(x[q]))[:k]
        out += [(q, r, c, -s) for r, (s, c) in enumerate(hits, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,shard,tasks", [(None, 262_144, 100_000), (3, 17, 100_000), (3, 17, 4)])
def test_topk(spark, monkeypatch, block, shard, tasks):
    """Also with many small tiles, and several of them in a task."""
    monkeypatch.setattr(topk, "MOST_TASKS", tasks)
    rows = some_vectors(310, 10) + BAD + [(906, [3.0, 4.0], 1, "", "", 1), (907, [0.0] * 10, 1, "", "", 1), (1000, [0.0] * 10, 1, "", "", 1)]
    rows += [(2000 + i, rows[5][1], 1, "", "", 1) for i in range(40)] + [rows[9]] * 30 + [(None, rows[7][1], 1, "", "", 1), (910, [1.0, 0.5], 1, "", "", 1)]
    df = spark.createDataFrame(rows, VECTORS).repartition(6)
    got = topk.search(df, F.col("vec_id") % 10 == 0, query_block=block, shard=shard)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 10, 5)


def test_topk_few_candidates_empty_and_without_queries(spark):
    rows = some_vectors(4, 3)
    df = spark.createDataFrame(rows, VECTORS)
    assert sorted(map(tuple, topk.search(df, F.col("vec_id") == 0).collect())) == brute_topk(rows, 10, 5)
    assert topk.search(df, F.col("vec_id") > 99).count() == 0
    assert topk.search(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert topk.search(df.limit(1), F.col("vec_id") >= 0).count() == 0


def test_topk_products_beyond_doubles(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([3, 6, 7, 9]) for _ in range(5)], 1, "", "", 1) for i in range(40)]
    rows += [(90, [1e30] * 5, 1, "", "", 1), (91, [-1e200] * 5, 1, "", "", 1)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert sorted(map(tuple, topk.search(df, F.col("vec_id") % 10 == 0).collect())) == brute_topk(rows, 10, 5)


def test_select_prefers_earlier_columns():
    scores = np.array([[5, 7, 7, 1, 7], [0, 0, 0, 0, 0]])
    ids = np.broadcast_to(np.arange(5) * 10, scores.shape)
    top, own = topk.select(scores, ids, 3)
    assert top.tolist() == [[7, 7, 7], [0, 0, 0]] and own.tolist() == [[10, 20, 40], [0, 10, 20]]


def test_merge_tree_of_many_parts(spark):
    rng = random.Random(4)
    rows = [(q, p, rng.randint(0, 9), rng.randint(0, 10 ** 6)) for q in range(3) for p in range(700) for _ in range(3)]
    got = topk.merged(spark.createDataFrame(rows, topk.LISTS), 700, 4).collect()
    for r in got:
        want = sorted((-s, v) for q, _, s, v in rows if q == r["query_id"])[:4]
        assert [(h["neg"], h["vec_id"]) for h in r["top"]] == want
    assert len(got) == 3


def test_saved_tables_can_be_removed(spark, monkeypatch, tmp_path):
    import os

    from formsieve.llm import common
    monkeypatch.setattr(common, "WRITTEN", [])
    monkeypatch.setattr(common, "checkpoint_dir", lambda _: f"file://{tmp_path}")
    out = [common.saved(spark.range(5), f"t{i}") for i in range(3)]
    assert sum(x.count() for x in out) == 15 and len(os.listdir(tmp_path)) == 3
    assert common.remove_saved(spark) == 3 and os.listdir(tmp_path) == [] and common.remove_saved(spark) == 0
