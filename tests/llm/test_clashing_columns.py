"""Columns of a caller's that are named like helpers, dots in names, and rows that agree in id and text only."""

import pytest
from pyspark.sql import functions as F

from kestrel.llm import chained_passages, chat_format, licence_spans, packing, pareto_mix, simhash, token_counts
from kestrel.llm.queries import tokenizer

HELPERS = ["_uid", "_cut_uid", "_cuts", "_text", "_key", "_copies", "_nth", "_n", "_copy", "_k", "_kept", "uid", "fp", "root", "least", "size", "q", "bin", "edge", "x"]
PASSAGE = " ".join(f"w{i}" for i in range(70))


@pytest.fixture(scope="module")
def docs(spark):
    """Two documents that share a passage, one near copy, and rows of equal id and text from two sources."""
    rows = [(1, f"{PASSAGE} one end", "a"), (2, f"{PASSAGE} another end here", "a"), (3, " ".join(f"v{i}" for i in range(40)), "a"), (3, " ".join(f"v{i}" for i in range(40)), "b"),
            (4, "short text of its own", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("names", [HELPERS, [h.upper() for h in HELPERS]])
def test_helpers_names_are_the_callers(docs, names):
    wide = docs.select("*", *[F.lit(77 + k).alias(n) for k, n in enumerate(names)])
    for operator in (simhash.keep_one, chained_passages.cut_passages, pareto_mix.repeat_rows):
        got, plain = operator(wide), operator(docs)
        assert got.columns == wide.columns
        rows = got.collect()
        # of rows that tie in id and text, all columns decide which one is kept
        seen = (lambda r: (r.doc_id, r.text)) if operator is simhash.keep_one else (lambda r: (r.doc_id, r.text, r.source))
        assert sorted(map(seen, rows)) == sorted(map(seen, plain.collect()))
        assert all([r[n] for n in names] == list(range(77, 77 + len(names))) for r in rows)


def test_rows_that_differ_elsewhere_stay_apart(docs):
    """Equal id and text in two sources: each source's words are its own, whatever the order of rows."""
    want = {(r.doc_id, r.source): r.copies for r in pareto_mix.mix(docs).collect()}
    for parts in (1, 5):
        got = {}
        for r in pareto_mix.repeat_rows(docs.repartition(parts)).collect():
            got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + 1
        assert got == {k: v for k, v in want.items() if v}
    kept = [tuple(r) for r in simhash.keep_one(docs).collect()]
    assert len([r for r in kept if r[0] == 3]) == 1
    assert all([tuple(r) for r in simhash.keep_one(docs.repartition(p)).orderBy("doc_id").collect()] == sorted(kept) for p in (1, 4))


@pytest.mark.parametrize("names", [["sequence_id", "offset", "bins", "bound"], ["_row", "_part", "_bin", "bin", "_ROW"], ["a.b", "length of it"]])
def test_packing_beside_any_columns(spark, names):
    names = [n for n in names if n != "_ROW"]
    pieces = spark.createDataFrame([(k, 5 + k % 3) for k in range(30)], "piece long, length long").select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    got = packing.pack(pieces, 16)
    assert {"sequence_id", "offset", "bins", "bound", *[n for n in names if n not in ("sequence_id", "offset", "bins", "bound")]} <= set(got.columns)
    fill = {}
    for r in sorted(got.collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 16 and sum(fill.values()) == sum(5 + k % 3 for k in range(30))


def test_dots_in_names(spark):
    docs = spark.createDataFrame([(1, "some words here"), (2, None)], "`a.id` long, `a.text` string")
    counts = token_counts.token_counts(docs, tokenizer("piece_bpe_32k.model"), 4096, id_col="a.id", text_col="a.text").collect()
    pieces = packing.token_pieces(docs, tokenizer("word_bpe_49k.json"), id_col="a.id", text_col="a.text").collect()
    assert {r.doc_id for r in counts} == {r.doc_id for r in pieces} == {1, 2}


def test_loss_follows_the_spans(spark):
    """What is read back under the loss is what the spans mark: moved spans give other text."""
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "é <s> yes"), (1, 2, "user", "so"), (1, 3, "assistant", "no")],
                                  "conv_id long, turn int, role string, text string")
    formatted = chat_format.render(chat_format.segments(turns))
    assert chat_format.read_back(formatted).first().trained == ["é <s> yes", "no"]
    moved = formatted.withColumn("loss_spans", F.transform("loss_spans", lambda s: F.struct((s["start"] + 1).alias("start"), (s["size"] - 1).alias("size"))))
    assert chat_format.read_back(moved).first().trained == [" <s> yes", "o"]


def test_many_notices_stay_linear():
    import time

    scanner = licence_spans.Scanner(licence_spans.TEMPLATES, licence_spans.PHRASES, 3, 6, 0.7)
    notice = next(iter(licence_spans.TEMPLATES.values()))[0].encode()
    took = []
    for n in (500, 4000):
        began = time.process_time()
        found = scanner.scan((notice + b" and so on with other words that nobody knows ") * n)[2]
        took.append(time.process_time() - began)
        assert len({f[0] for f in found}) >= n
    assert took[1] < 24 * took[0]


def test_three_blocks_meet_and_compare_little():
    import numpy as np

    assert simhash.block_widths(3) == [21, 21, 22] and simhash.block_widths(4) == [16] * 4
    rng, n = np.random.default_rng(4), 20_000
    compared = {}
    for blocks in (3, 4):
        compared[blocks] = 0
        for w in simhash.block_widths(blocks):
            code = simhash.anchors(w, 1)
            a = rng.integers(0, 1 << w, n, dtype=np.uint32)
            home = code.home(a)
            row, anchor = code.near(a)
            for bit in [None, *range(w)]:  # a value one bit away is a copy at the home anchor
                b = a[:200] if bit is None else a[:200] ^ np.uint32(1 << bit)
                r, at = code.near(b)
                assert all(((r == k) & (at == home[k])).any() for k in range(200))
            here, there = np.bincount(home, minlength=1 << w), np.bincount(anchor, minlength=1 << w)
            compared[blocks] += int((here.astype(np.int64) * there).sum()) - n
    assert compared[3] * 15 < compared[4]
