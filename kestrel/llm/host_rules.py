"""Host-level quality rules with empirical-Bayes shrinkage, in DataFrame functions alone.

Rules run per document.  Their failures are summed by host; a host's failure
rate is shrunk towards the rate of all hosts by a beta prior whose mean and
strength are estimated from the hosts themselves (moments of their rates).  A
host whose shrunk rate is over ``max_rate`` is rejected with all its documents,
however small or large; the verdict is joined back to the documents.

The rules read each text once: their numbers go to a reliable checkpoint (a few
longs a document), and host sums, prior and join work on that.  Sums combine on
the map side, so a host with a third of all rows is one row per task; the join
back is an equi-join that adaptive execution broadcasts or splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut_lineage

#: Fixed values of the rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = r"[#*$%&|<>]"


def document_rules(docs: DataFrame, id_col: str = "doc_id", host: Column | str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed), one row per input row.

    A null or empty text has no words and fails.  A null host is a host of its own.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    host = F.col(f"`{host}`") if isinstance(host, str) else host
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), host.cast("string").alias("host"), text.alias("t"))
    rows = rows.select("doc_id", "host", "t", F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"))
    n = F.size("words")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(
        F.element_at("words", i), F.element_at("words", i + 1), F.element_at("words", i + 2))))
    rows = rows.select("doc_id", "host", n.cast("long").alias("n_words"),
                       F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                       F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                       lines.alias("lines"), windows.alias("windows"))
    rows = rows.select("doc_id", "host", "n_words", "word_chars", "n_symbols",
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       F.when(F.size(F.array_distinct("windows")) < F.size("windows"),
                              F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("w"))
    # windows sorted by (hash, place): equal neighbours are repeats; a column of its own, as every element looks at its neighbours
    repeated = F.filter("w", lambda x, k: (F.get("w", k + 1)["h"] == x["h"]) | (F.get("w", k - 1)["h"] == x["h"]))
    rows = rows.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       F.sort_array(F.transform(repeated, lambda x: x["i"])).alias("at"))
    # a repeated window covers three words, less what the one before covers too
    covered = F.aggregate("at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")), lambda a, i: F.struct(
        (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    rows = rows.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def beta_prior(hosts: DataFrame) -> DataFrame:
    """One row (prior_mean, prior_strength) from per-host (n_docs, n_failed).

    The mean is the failure rate of all documents.  The strength (pseudo-documents)
    follows from how much host rates vary beyond what chance gives a host of its
    size; hosts that vary no more than that get the greatest strength, all documents.
    """
    s = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"), F.count(F.lit(1)).alias("k"),
                  F.sum(F.col("n_docs") * F.col("n_docs")).alias("n2"), F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("ff"))
    mean = (F.col("f") + 0.5) / (F.col("n") + 1)
    # weighted sum of squares of rates about the mean, and its value under beta-binomial hosts
    between = F.round(F.col("ff") - F.col("f") * F.col("f") / F.col("n"), 6)
    spare = F.col("n") - F.col("n2") / F.col("n")
    rho = (between / (mean * (1 - mean)) - (F.col("k") - 1)) / F.greatest(spare - (F.col("k") - 1), F.lit(1.0))
    strength = F.when(rho > 0, F.least(F.col("n").cast("double"), 1 / F.least(rho, F.lit(1.0)) - 1)).otherwise(F.col("n").cast("double"))
    return s.select(mean.alias("prior_mean"), F.greatest(strength, F.lit(1.0)).alias("prior_strength"))


def host_verdicts(rules: DataFrame, max_rate: float = 0.3) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, host_kept) from the rows of ``document_rules``."""
    hosts = rules.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    prior = beta_prior(hosts)  # one row
    rate = (F.col("n_failed") + F.col("prior_strength") * F.col("prior_mean")) / (F.col("n_docs") + F.col("prior_strength"))
    return (hosts.join(F.broadcast(prior)).select("host", "n_docs", "n_failed", F.round(rate, 9).alias("shrunk_rate"))
            .withColumn("host_kept", F.col("shrunk_rate") <= max_rate))


def judge(docs: DataFrame, max_rate: float = 0.3, id_col: str = "doc_id", host: Column | str = "source", text_col: str = "text") -> DataFrame:
    """``document_rules`` plus shrunk_rate, host_kept and kept: passed the rules and so did the host.

    One row per input row; repeated rows count as often as they come.
    """
    rules = cut_lineage(document_rules(docs, id_col, host, text_col))
    hosts = host_verdicts(rules, max_rate).select(F.col("host").alias("_h"), "shrunk_rate", "host_kept")
    return (rules.join(hosts, F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_kept")))
