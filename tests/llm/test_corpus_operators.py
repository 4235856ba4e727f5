"""Corpus operators that relate documents or vectors, against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import chained_passages, graph_search, pareto_mix, simhash
from kestrel.llm.components import components
from tests.conftest import SF_SMALL


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


# -- components

def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(25)] + [(5, 5), (7, None), (200, 199), (199, 200)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# -- SimHash

def fingerprint_by_hand(text):
    import xxhash

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_anchors_meet_within_reach():
    code = simhash.Anchors(16, 1)
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, 500, dtype=np.uint32)
    home = code.home(a)
    assert np.bitwise_count(a ^ home).max() <= 1 and (code.syndrome[home] == 0).all()
    for bit in [None, *range(16)]:
        b = a if bit is None else a ^ np.uint32(1 << bit)
        row, anchor = code.near(b)
        assert all(home[i] in anchor[row == i] for i in range(len(a)))


@pytest.mark.parametrize("part_pairs", [simhash.PART_PAIRS, 10])
def test_links_join_every_pair(spark, part_pairs):
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    fps = set(seeds)
    for s in seeds:
        for _ in range(12):
            for b in rng.sample(range(64), rng.randrange(1, 8)):
                s ^= 1 << b
            fps.add(s)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = [(int(np.int64(r.u).view(np.uint64)), int(np.int64(r.v).view(np.uint64))) for r in simhash.links(df, 4, 4, part_pairs).collect()]
    assert all((a ^ b).bit_count() <= 4 and a != b for a, b in got)
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in got:
        parent[root(a)] = root(b)
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 4:
            assert root(a) == root(b)


def test_near_duplicates_against_brute_force(spark, duck):
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    rows += [(900, None), (901, " \n"), (None, "a b"), (None, "a b"), (902, "A b"), (903, "x " * 5000), (903, "x " * 5000)]
    df = spark.createDataFrame([(*r, "q", 1) for r in rows], "doc_id long, text string, fp string, root long")
    got = simhash.near_duplicates(df).collect()
    fps = {t: fingerprint_by_hand(t) for _, t in rows}
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(i), f"{fps[t]:016x}") for i, t in rows)
    label = {f: f for f in fps.values()}
    for _ in range(len(label)):
        before = dict(label)
        for a, b in itertools.combinations(label, 2):
            if (a ^ b).bit_count() <= 4:
                label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    least = {}
    for i, t in rows:
        if i is not None:
            c = label[fps[t]]
            least[c] = min(least.get(c, i), i)
    assert sorted((str(r.doc_id), r.component_id) for r in got) == sorted((str(i), least.get(label[fps[t]])) for i, t in rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and kept.count() == len(set(label.values()))
    assert simhash.near_duplicates(df.limit(0)).count() == 0


# -- passages

def test_chains_are_best_by_brute_force():
    rng = np.random.default_rng(6)

    def value(x, y, max_gap):
        order = sorted(range(len(x)), key=lambda i: x[i])
        best = {}
        for i in order:
            best[i] = 1 + max([0.0, *(best[j] - (x[i] - x[j] + y[i] - y[j]) / (2 * max_gap) for j in order if x[j] < x[i] and y[j] < y[i])])
        return max(best.values())

    for _ in range(80):
        x, y = rng.integers(0, 40, (2, 12))
        got = chained_passages.chains(x, y, 10**6)  # no cut: the first chain is the best one
        assert sorted(np.concatenate(got).tolist()) == list(range(12))
        best = max(sum(1 for _ in c) - (x[c[-1]] - x[c[0]] + y[c[-1]] - y[c[0]]) / (2 * 10**6) for c in got)
        assert abs(best - value(x.tolist(), y.tolist(), 10**6)) < 1e-9
        assert all((np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all() for c in got)


def test_seeds_of_one_document_stay_where_they_are(spark):
    """op10: only seeds seen twice become rows, whichever slices the documents are in; those of two documents are all there."""
    rng = random.Random(18)
    passage = words(rng, 60)
    rows = [(i, " ".join(words(rng, 150) + (passage if i in (3, 57) else []) + words(rng, 150))) for i in range(80)]
    rows += [(90, "z " * 300), (91, "z " * 200), (92, ""), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).select(F.xxhash64("doc_id", "text").alias("uid"), "doc_id", F.col("text").cast("binary").alias("text"))
    found = chained_passages.seeds(df.dropDuplicates(["uid"]).join(chained_passages.seen_twice(df, 5, 3), "uid"), 5, 3).collect()
    holders, every = {}, 0
    for uid, text in {(r.uid, bytes(r.text)) for r in df.collect()}:
        t, h, p, b = chained_passages.minimisers([text], 5, 3)
        _, seed, at = chained_passages.numbered(t, h, p << 32 | b)
        every += len(seed)
        for x, a in zip(seed.view("int64").tolist(), at.tolist(), strict=True):
            holders.setdefault(x, []).append((x, uid, a))
    shared = [r for v in holders.values() if len({u for _, u, a in v if a >= 0}) > 1 for r in v]
    got = [tuple(r) for r in found]
    assert set(got) >= set(shared) and len(got) == len(set(got)) and len(shared) > 500
    assert len([r for r in got if r not in set(shared)]) < every / 5  # only what the repeated row has


def test_planted_passages(spark):
    rng = random.Random(8)
    passage, other = words(rng, 55), words(rng, 80)
    fuzzy = [w if i % 18 else f"new{i}" for i, w in enumerate(other)]  # runs of k + window - 1 words
    texts = [words(rng, 100) + passage + words(rng, 30), words(rng, 7) + [w.upper() for w in passage], passage + words(rng, 300), words(rng, 40) + other, fuzzy + words(rng, 5),
             words(rng, 200), passage[:30] + words(rng, 100), words(rng, 60)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(20, None), (21, ""), (22, "a b c"), (None, rows[3][1]), (0, rows[0][1]), (23, "z " * 400), (24, "z " * 400)]
    df = spark.createDataFrame([(*r, 1.5, "s") for r in rows], "doc_id long, text string, uid double, seed string")
    got = chained_passages.passages(df).collect()
    text = dict(rows)
    linked = {frozenset((r.doc_id, r.other_doc_id)) for r in got}
    assert {i for p in linked for i in p} == {0, 1, 2, 3, 4, 23, 24, None}
    for r in got:
        assert r.n_words >= 50 and r.identity >= 0.8
        if {r.doc_id, r.other_doc_id} <= {0, 1, 2}:
            w = text[r.doc_id].split()[r.start_word:r.start_word + r.n_words]
            assert [x.lower() for x in w] == passage and r.identity == 1.0
            assert text[r.doc_id].encode()[r.start_byte:r.end_byte].decode().split() == w
    cut = chained_passages.cut_passages(df)
    assert cut.columns == df.columns
    left = [r.text for r in cut.collect() if r.text and " ".join(passage) in r.text.lower()]
    assert len(set(left)) == 1  # one document keeps it
    assert {r.doc_id for r in cut.collect()} >= {5, 6, 7, 20, 21, 22}
    assert chained_passages.passages(df.limit(0)).count() == 0


def recall(spark, n_words, identity, n=60):
    """Share of planted passages of which at least half is found, with edits at random places (as many substitutions, insertions and deletions)."""
    rng = random.Random(n_words * 1000 + round(identity * 100))
    rows = []
    for p in range(n):
        passage, copy = words(rng, n_words), []
        for w in passage:
            kind = rng.choice("sid") if rng.random() >= identity else ""
            copy += {"": [w], "s": [f"new{rng.random()}"], "i": [f"new{rng.random()}", w], "d": []}[kind]
        rows += [(2 * p, " ".join(words(rng, 40) + passage + words(rng, 40))), (2 * p + 1, " ".join(words(rng, 30) + copy + words(rng, 30)))]
    got = chained_passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return len({r.doc_id // 2 for r in got if r.doc_id // 2 == r.other_doc_id // 2 and r.n_words >= n_words // 2}) / n


@pytest.mark.parametrize(("n_words", "identity", "least"), [(60, 0.95, 0.95), (60, 0.9, 0.9), (150, 0.9, 0.95), (150, 0.85, 0.9)])
def test_passages_with_edits_at_random_places(spark, n_words, identity, least):
    assert recall(spark, n_words, identity) >= least


def test_every_copy_of_a_passage_within_a_document(spark):
    rng = random.Random(11)
    passage, notice = words(rng, 55), words(rng, 60)
    page = [w for _ in range(5) for w in words(rng, 100) + notice]
    texts = [passage + passage, passage, page, words(rng, 20) + notice]
    for order in (texts, texts[::-1], [t + [f"x{i}"] for i, t in enumerate(texts)], [[f"y{i}"] + t for i, t in enumerate(texts)]):  # other keys, other representatives
        df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(order)], "doc_id long, text string")
        left = [r.text for r in chained_passages.cut_passages(df).collect()]
        for p in (passage, notice):
            holds = [t.count(" ".join(p)) for t in left]
            assert sum(h > 0 for h in holds) == 1 and sum(holds) in (1, " ".join(" ".join(t) for t in texts).count(" ".join(p)) - 1)


def test_exact_passage_next_to_a_loosely_shared_region(spark):
    rng = random.Random(12)
    rows, exact = [], {}
    for p in range(20):
        exact[p] = words(rng, 60)
        here, there = [], []
        for _ in range(8):
            shared = words(rng, 12)
            here, there = here + words(rng, 10) + shared, there + words(rng, 10) + shared
        for i, t in enumerate((here, there)):
            rows.append((2 * p + i, " ".join(exact[p] + t if p % 2 else t + exact[p])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = chained_passages.passages(df).collect()
    assert {r.doc_id // 2 for r in got} == set(range(20)) and all(r.identity >= 0.8 and r.n_words >= 50 for r in got)
    left = [r.text for r in chained_passages.cut_passages(df).collect()]
    assert all(sum(" ".join(p) in t for t in left) == 1 for p in exact.values())


def test_passage_of_long_words(spark):
    rng = random.Random(13)
    passage = ["字" * 60 + w + "文" * 40 for w in words(rng, 52)]  # over 300 bytes a word
    rows = [(i, " ".join(words(rng, 60) + passage + words(rng, 60))) for i in range(2)]
    got = chained_passages.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.start_word, r.n_words, r.n_matched) for r in got] == [(60, 52, 52)]
    text = dict(rows)
    assert all(text[r.doc_id].encode()[r.start_byte:r.end_byte].decode().split() == passage for r in got)


def test_passage_whose_parts_are_frequent_alone(spark):
    rng = random.Random(14)
    both = words(rng, 50)
    parts = both[:32], both[18:]  # no seed is in the whole alone
    texts = [words(rng, 30) + parts[i % 2] + words(rng, 30) for i in range(60)] + [words(rng, 30) + both + words(rng, 30) for _ in range(3)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    left = [r.text for r in chained_passages.cut_passages(df).collect()]
    assert sum(" ".join(both) in t for t in left) == 1  # one document keeps it
    assert sum(" ".join(parts[0]) in t for t in left) == 31  # a part alone is too short


def test_exact_passages_by_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    covered = {}
    for r in chained_passages.passages(df).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))
    holders = {}
    for i, t in df.where("text IS NOT NULL").collect():
        w = [x.lower() for x in chained_passages.WORD.findall(t.encode())]
        for s in range(len(w) - 49):
            holders.setdefault(tuple(w[s:s + 50]), []).append((i, s))
    shared = [h for h in holders.values() if len({i for i, _ in h}) > 1]
    assert shared
    for h in shared:  # all but one document have every word of it in a row
        assert len({i for i, s in h if not covered.get(i, set()).issuperset(range(s, s + 50))}) <= 1


def test_align_gives_all_parts_that_hold_the_bound():
    shared, loose = [b"s%d" % i for i in range(120)], [[c + b"%d" % i for i in range(20)] for c in (b"x", b"y")]
    a, b = (shared[:60] + z + shared[60:] for z in loose)
    anchors = [(i, i) for i in (*range(0, 56, 5), *range(80, 136, 5))]
    assert chained_passages.align(a, b, anchors, 5, 50, 0.9) == [(0, 60, 0, 60, 60), (80, 140, 80, 140, 60)]


def test_edit_matches():
    assert chained_passages.edit_matches(list("abcde"), list("axcde")) == 4
    assert chained_passages.edit_matches([], list("ab")) == 0
    assert chained_passages.edit_matches(list("ab"), list("xaby")) == 2


# -- mixing

def targets_by_hand(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = dict(zip(names, itertools.cycle(weights), strict=False))
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), {s for s in names if sizes[s]}
    while left > 1e-9 and open_:
        total, pot = sum(w[s] for s in open_), left
        left = 0.0
        for s in sorted(open_, key=str):
            target[s] += pot * w[s] / total
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def test_mix(spark, duck):
    rows = duck.execute("SELECT doc_id, text, source FROM documents").fetchall()
    rows += [(None, "a b c", None), (None, "a b c", None), (1000, None, "void"), (1001, " ", "void"), (1002, "x " * 9000, "src0"), (7, "same", "src1"), (7, "same", "src1")]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, source string, copies long")
    got = pareto_mix.mix(df).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets_by_hand(sizes, (5, 2, 1), 1.5, 2)
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    largest = {s: max(r.size for r in got if r.source == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    again = pareto_mix.mix(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    repeated = pareto_mix.repeat_rows(df)
    assert repeated.columns == df.columns and repeated.count() == sum(r.copies for r in got)
    assert pareto_mix.mix(df.limit(0)).count() == 0


def test_pareto_inclusion_follows_its_odds(spark):
    rows = [(i, "w " * (1 + i % 5), "a") for i in range(400)] + [(1000 + i, "v " * 40, "b") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [{r.doc_id: r.copies for r in pareto_mix.mix(df, weights=(1, 30), share=0.5, max_copies=1, seed=s).collect()} for s in range(6)]
    mean = [np.mean([r[i] for r in runs for i in range(400) if i % 5 == k]) for k in range(5)]
    assert mean[0] < mean[4] and 0 < mean[0] and mean[4] < 1  # longer texts lean higher, none is certain


def test_mix_of_a_source_in_one_bin(spark):
    rows = [(i, "w " * 10, None) for i in range(4000)]  # near a whole copy, of one size: all in the first bin
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = pareto_mix.mix(df, weights=(1,), share=1 - 1e-9, max_copies=1).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 4000 and sum(r.taken for r in got) in (39990, 40000)
    tasks = [r.task for r in got]
    assert max(tasks.count(t) for t in set(tasks)) < 2000


# -- graph search

def test_nearest_recall_and_ties(spark, duck):
    rows = [(i, v) for i, v in duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall()]
    d = len(rows[0][1])
    rows += [(10_000 + i, rows[0][1]) for i in range(300)]  # a vector repeated very often
    rows += [(20_000, None), (20_001, [0.0] * d), (20_100, [float("nan")] * d), (20_200, [None] * d), (None, rows[1][1]), (20_300, [1.0, 2.0]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, ids string, shard int")
    got = graph_search.nearest(df, lambda i: i % 100 == 0, shard_rows=200).collect()
    use = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == d}
    ids = np.array(sorted(use))
    data = np.stack([use[i] for i in ids.tolist()])
    hit = n = 0
    for q in [i for i in ids.tolist() if i % 100 == 0]:
        far = np.sqrt(((data - use[q]) ** 2).sum(1))
        best = sorted((f, i) for f, i in zip(far.tolist(), ids.tolist(), strict=True) if i != q)[:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(s - np.sqrt(((use[i] - use[q]) ** 2).sum())) < 1e-12 for _, i, s in mine)
        assert [(s, i) for _, i, s in mine] == sorted((s, i) for _, i, s in mine)
        if best[9][0] == 0:
            assert [i for _, i, _ in mine] == [i for _, i in best]
        hit += len({i for _, i, _ in mine} & {i for _, i in best})
        n += 10
    assert hit / n >= 0.9
    assert {r.query_id for r in got} == {i for i in ids.tolist() if i % 100 == 0}  # 20300 is alone in its dimension
    assert graph_search.nearest(df.limit(0), lambda i: i % 100 == 0).count() == 0


# -- pipeline

def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names, before = docs.columns, docs
    for name, stage in P.STAGES[:-1]:
        stage(spark, before, SF_SMALL).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        assert after.columns == names and 0 < after.count()
        if name in ("quality", "near_duplicates"):
            assert after.exceptAll(before).count() == 0
        before = after
    packed = P.STAGES[-1][1](spark, before, SF_SMALL).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 4096
    assert (packed.piece == 0).sum() == before.count()
    assert P.run(spark, SF_SMALL).count() == len(packed)
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0
