"""Prefix trie, whitening and b-bit MinHash against brute force and their SQL."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import bbit_minhash, contour_whitening, prefix_trie, queries
from tests.conftest import SF_SMALL
from tests.oracle_util import rows_equal


# -- prefix trie

def trie_by_hand(convs, every=5, longest=9):
    """Rows of op11 from {conv_id: [(role, text), ...]}."""
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % longest
        built[c] = convs.get(c - c % every, [])[:h] + own[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        childless = [q for q in below if not any(len(r) == len(q) + 1 and r[:-1] == q for r in below)]
        ends = sorted(c for c in m if len(built[c]) == len(p))
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), sum(1 for q in below if len(q) == len(p) + 1), len(childless),
                     sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=repr)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie_rows(turns, **how):
    got = prefix_trie.trie(prefix_trie.shared_starts(prefix_trie.numbered(turns)), **how)
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr)


@pytest.mark.parametrize("limit", [2, 100_000])
def test_trie_against_brute_force(spark, limit):
    rng = random.Random(limit)
    convs = {c: [(rng.choice(["user", "assistant", ""]), rng.choice(["", "a", "bé", "a b"])) for _ in range(rng.choice([1, 2, 3, 12, 30]))]
             for c in rng.sample(range(400), 150)}
    convs |= {c: convs[next(iter(convs))] for c in range(1000, 1040)}  # a group of copies
    rows = [(c, t, r or None, x or None, "clash") for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, key string")
    assert trie_rows(turns, limit=limit) == trie_by_hand(convs)


def test_trie_edges(spark):
    schema = "conv_id long, turn int, role string, text string, n string, depth int, a int"
    assert trie_rows(spark.createDataFrame([], schema)) == []
    assert trie_rows(spark.createDataFrame([(None, 1, "user", "x", "", 1, 1)], schema)) == []
    # nulls first among turns, repeated rows kept, a turn without role and text
    rows = [(5, None, "system", "s", "", 1, 1), (5, 0, "user", "x" * 200_000, "", 1, 1), (5, 0, "user", "x" * 200_000, "", 1, 1), (5, 7, None, None, "", 1, 1)]
    convs = {5: [("system", "s"), ("user", "x" * 200_000), ("user", "x" * 200_000), ("", "")]}
    assert trie_rows(spark.createDataFrame(rows, schema)) == trie_by_hand(convs)
    # a conversation that loses all its turns stays a member of the root: its other one isn't there
    gone = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    assert trie_rows(spark.createDataFrame([(gone, 0, "user", "x", "", 1, 1)], schema)) == trie_by_hand({gone: [("user", "x")]})


def test_queue_spills_in_order():
    rng = random.Random(3)
    queue, held = prefix_trie.SpillingQueue(limit=7), []
    for i in range(500):
        item = ((rng.randrange(60), b"k"), i)
        queue.push(item)
        held.append(item)
    assert queue.spilled > 100
    for rank in range(30):
        assert sorted(queue.take((rank, b"k"))) == sorted(x for x in held if x[0][0] == rank)
    for i in range(500, 700):  # more between takes, after the ranks that are done
        item = ((rng.randrange(30, 60), b"k"), i)
        queue.push(item)
        held.append(item)
    for rank in range(30, 60):
        assert sorted(queue.take((rank, b"k"))) == sorted(x for x in held if x[0][0] == rank)
    assert not queue.heap and not queue.runs


# -- whitening

def test_inertia_and_slices():
    rng = np.random.default_rng(0)
    for d in (1, 2, 7, 40):
        a = rng.standard_normal((d, d))
        v = a @ a.T
        v[:, 0] *= 1.0
        w = np.linalg.eigvalsh(v)[::-1]
        for s in [*rng.uniform(-1, w[0] * 1.1, 10), (w[0] + w[-1]) / 2]:
            assert contour_whitening.count_above(v, s) == (w > s).sum()
        for low, high, n in (cuts := contour_whitening.slices(v, 10, 3)):
            assert ((w > low) & (w <= high)).sum() == n
        assert sum(c[2] for c in cuts) >= min(10, d)


@pytest.mark.parametrize("kind", ["plain", "repeated", "split", "rank", "zero", "tiny"])
def test_feast_against_eigh(kind):
    rng = np.random.default_rng(5)
    d = 24
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    e = {"plain": np.linspace(1, 100, d), "repeated": np.repeat([3.0, 7.0, 50.0], d // 3), "split": np.concatenate([[1e6, 1e3], 1 + np.arange(d - 2) * 1e-5]),
         "rank": np.concatenate([[4.0, 2.0, 1.0], np.zeros(d - 3)]), "zero": np.zeros(d), "tiny": np.linspace(1, 9, d) * 1e-9}[kind]
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    values, u = contour_whitening.principal(v, 16)
    right = np.sort(e)[::-1][:16]
    right = right[right > 0]
    assert len(values) == len(right)
    if len(right):
        assert np.abs(values / right - 1).max() < 1e-9
        assert np.abs(u.T @ u - np.eye(len(right))).max() < 1e-12
        assert np.linalg.norm(v @ u - u * values, axis=0).max() < 1e-12 * right[0]


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(2)
    a = rng.standard_normal((300, 40)).astype(np.float32) * np.linspace(0.2, 1, 40, dtype=np.float32)
    rows = [(i, a[i].tolist(), "clash") for i in range(300)] + [(None, a[0].tolist(), ""), (7, a[7].tolist(), "")]
    bad = [(900, None, ""), (901, [1.0] * 39 + [None], ""), (902, [1.0] * 39 + [float("nan")], ""), (903, [1.0] * 39 + [float("inf")], ""), (904, [], ""), (905, [1.0], "")]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, n string").repartition(5)
    got = contour_whitening.whiten(table, 32).collect()
    x = np.floor(np.array([r[1] for r in rows], np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    y = x - s / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    assert len(got) == n * 32 and {r.n for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, []).append(r)
    signs = np.zeros(32)
    for i, (vec_id, _, _) in enumerate(rows):
        dev = sum((n * int(p) - int(q)) ** 2 for p, q in zip(x[i], s, strict=True))
        mine = by[(vec_id, dev)]
        for c in range(32):
            want = y[i] @ u[:, c] / e[c] ** 0.5
            signs[c] = signs[c] or np.sign(want * mine[c + 1][0].whitened)
            assert abs(mine[c + 1][0].whitened - signs[c] * want) < 1e-8
    assert np.allclose([next(r.explained for r in got if r.component == c) for c in range(1, 33)], e / np.trace(v), rtol=1e-10)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>, component int"
    assert contour_whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert contour_whitening.whiten(spark.createDataFrame([(1, None, 1), (2, [], 1)], schema)).count() == 0
    assert contour_whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 1) for i in range(4)], schema)).count() == 0  # no variance
    two = contour_whitening.whiten(spark.createDataFrame([(1, [0.0, 0.0], 1), (2, [1.0, 0.0], 1)], schema)).collect()
    assert [(r.component, r.explained, abs(r.whitened)) for r in two] == [(1, 1.0, 1.0)] * 2
    huge = contour_whitening.whiten(spark.createDataFrame([(1, [3e38, 0.0], 1), (2, [-3e38, 1.0], 1), (3, [0.0, 0.5], 1)], schema))
    assert {r.vec_id for r in huge.collect()} == {1, 2, 3}


# -- b-bit MinHash

def set_by_hand(text, k=5):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def groups_by_hand(rows, percent=85):
    sets = [set_by_hand(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def edited(rng, words, share):
    return [f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("chunk", [500, bbit_minhash.CHUNK])
def test_near_duplicates_against_brute_force(spark, chunk):
    rng, texts = random.Random(11), []
    for _ in range(12):  # groups about the threshold, so that many pairs of a bucket aren't links
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([30, 120, 300]))]
        texts += [" ".join(edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.04]))) for _ in range(12)]
    texts += ["", None, " \n", "one two", "One  TWO", "one two three four five", "one two three four five six", "x " * 20_000, "x " * 7, "a b c d e f " * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[3]), (500, "ONE two"), (None, "only here and nowhere else at all")]
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], "doc_id long, text string, uid string, keys string").repartition(6)
    got = bbit_minhash.near_duplicates(docs, chunk=chunk).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == groups_by_hand(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_members_with_a_likely_partner(spark):
    """Alike in all bands, of different components: the pair is looked at in its first bucket; a partner of the same component or of another size is none."""
    import pandas as pd

    scheme = bbit_minhash.Scheme()
    minima = scheme.minima(np.arange(5, dtype=np.uint64))
    row = {"i": 0, "j": 0, "signature": scheme.signature(minima), "keys": scheme.keys(minima)}
    far = scheme.signature(scheme.minima(np.arange(100, 105, dtype=np.uint64)))
    members = [(0, b"a", b"a", 100, row["signature"]), (1, b"b", b"b", 100, row["signature"]), (1, b"c", b"a", 100, row["signature"]), (1, b"d", b"d", 300, row["signature"]),
               (1, b"e", b"e", 100, far)]
    pdf = pd.DataFrame([{**row, "band": band, "key": band, "side": s, "uid": u, "root": r, "n": n, "signature": g} for band in (0, 3) for s, u, r, n, g in members])
    got = bbit_minhash._likely_members(scheme, 85)(pdf)
    assert sorted(zip(got["key"], got["side"], got["uid"], strict=True)) == [(0, 0, b"a"), (0, 1, b"b")]


def test_forest_of_a_part():
    import pandas as pd

    base = [f"w{i}" for i in range(200)]
    texts = {b"a": base, b"b": [*base[:-4], "x"], b"c": [*base[:-9], "y"], b"d": base[:100], b"e": [*base, "z"]}
    pdf = pd.DataFrame([{"side": s, "uid": u, "root": r, "text": " ".join(texts[u]).encode()} for s, u, r in
                        ((0, b"a", b"a"), (0, b"d", b"d"), (1, b"b", b"b"), (1, b"c", b"c"), (1, b"e", b"b"), (1, b"d", b"d"))])
    got = bbit_minhash._forest(85, 5)(pdf)
    assert sorted(zip(got["u"], got["v"], strict=True)) == [(b"a", b"b"), (b"a", b"c")]  # e is in b's component already, d is too short


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_estimate_is_free_of_collisions(bits):
    scheme, rng = bbit_minhash.Scheme(bands=60, rows=5, bits=bits), np.random.default_rng(bits)
    for true in (0.0, 0.3, 0.6, 0.85, 1.0):
        k = int(2000 * true / (1 + true))  # common to two sets of 1,000
        a, b = (rng.integers(0, 1 << 63, 1000, dtype=np.uint64) for _ in "ab")
        b[:k] = a[:k]
        sign = scheme.words([scheme.signature(scheme.minima(s)) for s in (a, b)])
        estimate = float(scheme.similarity(scheme.agreeing(sign[0], sign[1])))
        assert abs(estimate - true) < 6 * 0.5 / (1 - 2.0 ** -bits) / 300 ** 0.5
        if true >= 0.85:
            assert scheme.agreeing(sign[0], sign[1]) >= scheme.least(0.85)
    assert bbit_minhash.near_duplicates  # the default scheme finds pairs at the bound
    assert (1 - 0.85 ** 5) ** 25 < 1e-6


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bbit_minhash.near_duplicates(docs).count() == 0
    assert [tuple(r) for r in bbit_minhash.near_duplicates(spark.createDataFrame([(4, None)], "doc_id long, text string")).collect()] == [(4, 0, 4, True)]


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_bbit_minhash"])
def test_oracle(spark, duck, name):
    assert rows_equal(queries.QUERIES[name](spark, SF_SMALL), duck, queries.ORACLE[name])


def test_whitening_query(spark):
    white = queries.op12_contour_whitening(spark, SF_SMALL)
    r = white.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("component").alias("c"), F.max("identity_error").alias("e")).first()
    assert r.n == 500 * 32 and r.c == 32 and r.e < 1e-9
