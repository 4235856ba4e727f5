"""Mixing sources to target weights by whole copies and Pareto order sampling.

``source_targets`` shares a budget of words among the sources by weight, with a
ceiling of ``max_copies`` times a source's size; what a ceiling leaves over is
shared again by weight (the level at which all of it is placed is found from
running sums over the sources ordered by ceiling / weight, not by iterating).

``mix`` gives each document of a source an expected number of copies

    e = rho + lean * min(rho, max_copies - rho) * (x - x_mean)

with rho = target / source size and x in [0, 1] a preference (by default the
longer, the more), so that the copies' words add up to the target and e stays in
[0, max_copies].  Whole copies are certain.  The rest, the inclusion probability
pi = e - floor(e), is drawn by Pareto order sampling: documents rank by
(u / (1 - u)) / (pi / (1 - pi)), u a uniform of seed and doc_id, and the first
ones are taken until the words still missing are filled, a sample of fixed size
in words.  No source is sorted whole: ranks are binned, the bin in which the
sample ends comes from sums per (source, bin), and only its documents are ranked,
in range chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import cut_lineage, free_name, n_words, row_key
from kestrel.plans.ordered import running

BINS = 4096
#: Steps of the preference: sums stay whole numbers, which come out the same in any order.
STEPS = 1024


def source_targets(sizes: DataFrame, weights: list[int], share: float = 1.5, max_copies: int = 2) -> DataFrame:
    """(source, source_size, target, weight) from (source, source_size), one row per source.

    Sources are weighted in code-point order, null last, by ``weights`` repeating;
    together they get ``share`` times all words, each at most ``max_copies`` times
    its own.  A source without words gets 0.
    """
    order = [F.col("source").isNull(), F.col("source").cast("binary")]
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("rn") - 1) % len(weights) + 1).cast("int")).cast("long")
    one = sizes.select("source", "source_size", F.lit(0).alias("_all"))
    ranked = running(one, ["_all"], order, rank_col="rn").withColumn("weight", w).where("source_size > 0")
    # in order of ceiling / weight, compared as whole numbers would be: size * (lcm / weight)
    ratio = F.col("source_size") / F.col("weight")
    level = running(ranked.select("_all", "source", "source_size", "weight"), ["_all"], [ratio, *order],
                    {"size_to": F.col("source_size"), "weight_to": F.col("weight")}, rank_col=None)
    total = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights"))
    # with every source up to here full, the level that places the rest; the least one that fits is right
    at = level.join(F.broadcast(total))  # one row
    rest = F.col("words") * share - max_copies * (F.col("size_to") - F.col("source_size"))
    tried = at.withColumn("level", rest / (F.col("weights") - F.col("weight_to") + F.col("weight")))
    found = tried.agg(F.min(F.when(F.col("level") * F.col("weight") <= F.col("source_size") * max_copies, F.struct("weight_to", "level"))).alias("f"))
    full = F.col("source_size") * F.lit(float(max_copies))
    target = F.when(F.col("f").isNull(), full).otherwise(F.least(full, F.col("f.level") * F.col("weight")))
    return (sizes.join(ranked.select("source", "weight").withColumn("_has", F.lit(1)), sizes["source"].eqNullSafe(ranked["source"]), "left")
            .select(sizes["source"], "source_size", "weight").join(F.broadcast(found))
            .select("source", "source_size", F.when(F.col("weight").isNull(), F.lit(0.0)).otherwise(target).alias("target"), "weight"))


def uniform(seed: int, *keys: Column) -> Column:
    """A number in (0, 1) that depends on seed and keys alone."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11).cast("double") + 0.5) / float(1 << 53)


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_copies: int = 2, lean: float = 0.5, seed: int = 42,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", key_cols: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *key_cols, size, source, source_size, target, copies, taken), one row per input row.

    A null text has size 0; a row of size 0 is never taken.  A null source is a
    source of its own, a null id draws like any other; equal rows draw alike, and
    the tie between them is settled by rank alone, so the outcome is the same for
    every run.  A source's taken words miss its target by at most about half a
    document.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), *[F.col(f"`{c}`") for c in key_cols if c != id_col],
                       F.col(f"`{source_col}`").cast("string").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size"))
    rows = cut_lineage(rows)
    keep = [c for c in rows.columns if c not in ("source", "size")]
    mean = rows.agg(F.avg("size").alias("m")).first()["m"] or 1.0  # of whole numbers: the same for every run
    rows = rows.withColumn("x", F.round(F.col("size") / (F.col("size") + F.lit(float(mean))) * STEPS).cast("long"))
    sums = cut_lineage(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("x")).alias("xs")))
    targets = source_targets(sums.select("source", "source_size"), list(weights), share, max_copies)
    per_source = cut_lineage(targets.join(sums.select(F.col("source").alias("_s"), "xs"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))

    rho = F.col("target") / F.col("source_size")
    tilt = (F.col("x") - F.col("xs") / F.col("source_size")) / STEPS
    expected = F.least(F.lit(float(max_copies)), F.greatest(F.lit(0.0), rho + lean * F.least(rho, max_copies - rho) * tilt))
    named = rows.join(per_source.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    drawn = (named.withColumn("e", F.when(F.col("size") > 0, expected).otherwise(0.0)).withColumn("whole", F.floor("e"))
             .withColumn("pi", F.col("e") - F.col("whole")).withColumn("u", uniform(seed, F.col("doc_id"))))
    q = (F.col("u") / (1 - F.col("u"))) / (F.col("pi") / (1 - F.col("pi")))
    drawn = drawn.withColumn("q", F.when(F.col("pi") > 0, q)).withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * BINS).cast("int"))

    # words in the bins before each, and what is left to fill by the sample
    per_bin = drawn.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.sum(F.col("size") * F.col("whole")).alias("certain"), F.max("target").alias("target"))
    by_source = Window.partitionBy("source")
    upto = by_source.orderBy(F.col("bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    binned = (per_bin.withColumn("need", F.col("target") - F.sum("certain").over(by_source))  # at most BINS + 1 rows a source
              .withColumn("words", F.when(F.col("bin").isNotNull(), F.col("words")).otherwise(0))
              .withColumn("before", F.sum("words").over(upto) - F.col("words")))
    edge = (binned.where("bin IS NOT NULL AND before < need").groupBy("source")
            .agg(F.max(F.struct("bin", "before", "need")).alias("edge")).select(F.col("source").alias("_s"), "edge"))
    placed = drawn.join(edge, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    inside = placed.where("bin IS NOT NULL AND edge.bin = bin")
    # the bin may hold most of a source: summed in range chunks, by a key that isn't null
    named_bin = inside.withColumn("_by", F.concat(F.col("source").isNull().cast("string"), F.coalesce(F.col("source").cast("string"), F.lit(""))))
    summed = running(named_bin, ["_by"], [F.col("q"), F.col("doc_id"), F.col("size")], {"_to": F.col("size")}, rank_col=None).drop("_by")
    ranked = summed.withColumn("extra", (F.col("edge.before") + F.col("_to") - F.col("size") / 2 <= F.col("edge.need")).cast("long")).drop("_to")
    sure = placed.where("bin IS NULL OR edge IS NULL OR edge.bin != bin").withColumn("extra", F.coalesce(F.col("bin") < F.col("edge.bin"), F.lit(False)).cast("long"))
    both = sure.unionByName(ranked)
    copies = (F.col("whole") + F.col("extra")).cast("long")
    return both.select(*keep, "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with each row as often as ``mix`` takes it, all columns kept; rows that are equal in all of them share their copies."""
    key, n, nth = (free_name(docs, c) for c in ("_key", "_copies", "_nth"))
    keyed = docs.withColumn(key, row_key(docs))
    copies = (mix(keyed, id_col=id_col, source_col=source_col, text_col=text_col, key_cols=(key,), **how)
              .groupBy(key).agg(F.sum("copies").alias(n)).where(F.col(n) > 0))
    once = keyed.dropDuplicates([key]).join(copies, key)
    return once.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))).alias(nth)).drop(nth)
