"""MinHash near-duplicates with b-bit signatures.

A text is the set of its distinct word shingles, as 64-bit hashes.  Texts of one
set are one *class* from the first step on, so copies are never paired.  A class
has ``bands * rows`` minima.  Bands of ``rows`` whole minima give bucket keys; of
every minimum ``bits`` low bits are kept and packed into a signature.  Two
signatures that agree in m of k places estimate the similarity free of chance
agreements c = 2 ** -bits as (m / k - c) / (1 - c).

Links are found in two steps, and only confirmed on full sets.

1. Stars: every class of a bucket is paired with the bucket's representative.
   Pairs that sizes or the estimate (``deviations`` standard errors below the
   threshold) rule out are dropped, the others confirmed, and components formed.
   A bucket that is one component is done.
2. The rest: in buckets of several components, the classes outside the largest
   one are compared by signature with all that are in another component.  A pair
   that shares several buckets is looked at in the first.  A bucket is cut into
   chunks of a bounded number of shingles and a task takes one chunk of either
   side at a time, so none grows with its bucket.  Only classes with a likely
   partner go on, with their texts; a task then counts the common shingles of all
   its classes and returns a spanning forest of the links instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut_lineage, text_slices
from kestrel.llm.components import components

#: Shingles in a chunk of a bucket, and rows that a task takes of step 2's first half at once.
CHUNK, TASK_ROWS = 400_000, 50_000


def shingle_set(text: bytes, shingle: int = 5) -> np.ndarray:
    """Sorted distinct XXH64 hashes of the shingles of a UTF-8 text; empty for a text without words."""
    import xxhash

    words = text.lower().split()  # bytes: lower() maps A-Z alone, split() cuts at x20 and x09-x0D
    if not words:
        return np.zeros(0, np.uint64)
    norm, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(norm)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts, stops = (ends - size)[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    return np.unique(np.array([digest(norm[a:b]) for a, b in zip(starts, stops, strict=True)], np.uint64))


class Scheme:
    """Hash functions, band keys and packed signatures for ``bands * rows`` minima of which ``bits`` bits are kept."""

    def __init__(self, bands: int = 25, rows: int = 5, bits: int = 2, seed: int = 42):
        if bits not in (1, 2, 4, 8):
            raise ValueError("bits must be 1, 2, 4 or 8")
        self.bands, self.rows, self.bits = bands, rows, bits
        rng = np.random.default_rng(seed)
        self.odd = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.mix = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        self.width = -(-bands * rows * bits // 64)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(self.odd), np.iinfo(np.uint64).max, np.uint64)
        for lo in range(0, len(hashes), 4096):
            part = hashes[lo:lo + 4096]
            part = part ^ (part >> np.uint64(31))
            out = np.minimum(out, ((part[None, :] ^ self.mix[:, None]) * self.odd[:, None]).min(1))
        return out

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """A 64-bit key per band, that holds the band's number."""
        import xxhash

        return np.array([xxhash.xxh64_intdigest(minima[b * self.rows:(b + 1) * self.rows].tobytes(), b) for b in range(self.bands)], np.uint64).view(np.int64)

    def signature(self, minima: np.ndarray) -> bytes:
        low = (minima & np.uint64((1 << self.bits) - 1)).astype(np.uint8)
        planes = ((low[:, None] >> np.arange(self.bits, dtype=np.uint8)) & 1).ravel()
        padded = np.zeros(self.width * 64, np.uint8)
        padded[:len(planes)] = planes
        return np.packbits(padded, bitorder="little").tobytes()

    def agreeing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places in which the signatures (words in the last axis) agree, by counts of bits."""
        differ = a ^ b
        step = 1
        while step < self.bits:  # a place differs if any of its bits does
            differ = differ | differ >> np.uint64(step)
            step *= 2
        ones = sum(1 << i for i in range(0, 64, self.bits))
        return len(self.odd) - np.bitwise_count(differ & np.uint64(ones)).sum(-1, dtype=np.int64)

    def similarity(self, agreeing: np.ndarray) -> np.ndarray:
        chance = 2.0 ** -self.bits
        return (agreeing / len(self.odd) - chance) / (1 - chance)

    def least(self, threshold: float, deviations: float = 6.0) -> int:
        """Fewest agreeing places of a pair at ``threshold`` within so many standard errors."""
        k, chance = len(self.odd), 2.0 ** -self.bits
        p = chance + (1 - chance) * threshold
        return int(np.floor(k * p - deviations * (k * p * (1 - p)) ** 0.5))

    def words(self, signatures: list) -> np.ndarray:
        return np.frombuffer(b"".join(signatures), np.uint64).reshape(len(signatures), self.width)


def signatures(docs: DataFrame, scheme: Scheme, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """(doc_id, text_key, n, uid, keys, signature) per row.

    ``text_key`` names the text, ``uid`` the set (128 bits each).  A null text has
    no words; sets without members have null uid, keys and signature.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for (ids, keys), texts in text_slices(batches):
            n, uid, bands, sign = [], [], [], []
            for text in texts:
                hashes = shingle_set(text, shingle)
                n.append(len(hashes))
                if not len(hashes):
                    uid.append(None), bands.append(None), sign.append(None)
                    continue
                minima = scheme.minima(hashes)
                uid.append(xxhash.xxh3_128_digest(hashes.tobytes())), bands.append(scheme.keys(minima)), sign.append(scheme.signature(minima))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(n, pa.int64()), pa.array(uid, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sign, pa.binary())], names=["doc_id", "text_key", "n", "uid", "keys", "signature"])

    return _keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_key binary, n long, uid binary, keys array<long>, signature binary")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("text_key"), text.alias("text"))


def _likely(pairs: DataFrame, classes: DataFrame, scheme: Scheme, percent: int) -> DataFrame:
    """The (u, v) that sizes and signatures don't rule out."""
    sides = [classes.select(F.col("uid").alias(c), F.col("n").alias(f"{c}_n"), F.col("signature").alias(f"{c}_s")) for c in "uv"]
    sized = pairs.join(sides[0], "u").join(sides[1], "v").where(100 * F.least("u_n", "v_n") >= percent * F.greatest("u_n", "v_n"))
    least = scheme.least(percent / 100)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                a, c = (scheme.words(b.column(i).to_pylist()) for i in (2, 3))
                yield pa.RecordBatch.from_arrays([b.column(i).filter(pa.array(scheme.agreeing(a, c) >= least)) for i in (0, 1)], names=["u", "v"])

    return sized.select("u", "v", "u_s", "v_s").mapInArrow(run, "u binary, v binary")


def _texts(uids: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(uid, text): a text of each class of ``uids``."""
    wanted = uids.join(classes.select("uid", "text_key"), "uid")
    rows = _keyed(docs, id_col, text_col).select("text_key", "text").join(wanted, "text_key")
    return cut_lineage(rows.groupBy("uid").agg(F.first("text").alias("text")))


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough; v is the side that many pairs share: its pairs follow one another and its set is built once."""
    both = (pairs.join(texts.select(F.col("uid").alias("u"), F.col("text").alias("u_text")), "u")
            .join(texts.select(F.col("uid").alias("v"), F.col("text").alias("v_text")), "v"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, theirs = None, None
        for b in batches:
            sure = []
            for i in range(b.num_rows):
                if (v := b.column(1)[i].as_py()) != held:
                    held, theirs = v, shingle_set(b.column(3)[i].as_py(), shingle)
                mine = shingle_set(b.column(2)[i].as_py(), shingle)
                common = len(np.intersect1d(mine, theirs, assume_unique=True))
                sure.append(100 * common >= percent * (len(mine) + len(theirs) - common))
            yield pa.RecordBatch.from_arrays([b.column(i).filter(pa.array(sure, pa.bool_())) for i in (0, 1)], names=["u", "v"])

    return both.select("u", "v", "u_text", "v_text").mapInArrow(run, "u binary, v binary")


def _likely_members(scheme: Scheme, percent: int):
    """Of buckets' parts (x side, y side): the members that have a likely partner of another component, in no bucket before this one."""
    least = scheme.least(percent / 100)

    def run(pdf):
        import pandas as pd

        out = [pdf.iloc[:0][["key", "i", "j", "side", "uid", "root"]]]
        for _, part in pdf.groupby(["key", "i", "j"], sort=False):
            sides = [part[part["side"] == s] for s in (0, 1)]
            if not len(sides[0]) or not len(sides[1]):
                continue
            band = int(part["band"].iloc[0])
            n = [s["n"].to_numpy() for s in sides]
            roots = np.split(pd.factorize(pd.concat([s["root"] for s in sides]))[0], [len(sides[0])])
            sign = [scheme.words(s["signature"].tolist()) for s in sides]
            keys = [np.stack(s["keys"].to_list())[:, :band] for s in sides]
            wanted = [np.zeros(len(s), bool) for s in sides]
            for lo in range(0, len(sides[0]), 128):
                for to in range(0, len(sides[1]), 4096):
                    x, y = slice(lo, lo + 128), slice(to, to + 4096)
                    smaller, larger = np.minimum(n[0][x, None], n[1][None, y]), np.maximum(n[0][x, None], n[1][None, y])
                    a, b = np.nonzero((100 * smaller >= percent * larger) & (roots[0][x, None] != roots[1][None, y]))
                    a, b = a + lo, b + to
                    for k in range(0, len(a), 100_000):
                        p, q = a[k:k + 100_000], b[k:k + 100_000]
                        on = scheme.agreeing(sign[0][p], sign[1][q]) >= least
                        p, q = p[on], q[on]
                        on = ~(keys[0][p] == keys[1][q]).any(1)
                        wanted[0][p[on]], wanted[1][q[on]] = True, True
            out += [s.loc[w, ["key", "i", "j", "side", "uid", "root"]] for s, w in zip(sides, wanted, strict=True)]
        return pd.concat(out)
    return run


def _forest(percent: int, shingle: int):
    """Links (u, v) of a part's texts that join components, as a spanning forest: common shingles are counted for one x and all y at a time."""
    def run(pdf):
        import pandas as pd

        xs, ys = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        sets = [shingle_set(t, shingle) for t in ys["text"]]
        sizes = np.array([len(s) for s in sets], np.int64)
        hashes = np.concatenate([*sets, np.zeros(0, np.uint64)])
        order = np.argsort(hashes, kind="stable")
        hashes, of = hashes[order], np.repeat(np.arange(len(sets)), sizes)[order]
        label = {r: r for r in pdf["root"]}

        def root(r: bytes) -> bytes:
            while label[r] != r:
                label[r] = r = label[label[r]]
            return r

        y_uid, y_root, out = ys["uid"].tolist(), ys["root"].tolist(), []
        for u, r, text in zip(xs["uid"], xs["root"], xs["text"], strict=True):
            mine = shingle_set(text, shingle)
            lo, hi = np.searchsorted(hashes, mine, "left"), np.searchsorted(hashes, mine, "right")
            many = hi - lo
            at = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
            common = np.bincount(of[at], minlength=len(sets))
            for k in np.flatnonzero(100 * common >= percent * (len(mine) + sizes - common)).tolist():
                a, b = root(r), root(y_root[k])
                if a != b:
                    label[max(a, b)] = min(a, b)
                    out.append((u, y_uid[k]))
        return pd.DataFrame(out, columns=["u", "v"])
    return run


def _across(shared: DataFrame, roots: DataFrame, classes: DataFrame, docs: DataFrame, scheme: Scheme, percent: int, shingle: int, id_col: str, text_col: str,
            chunk: int) -> DataFrame:
    """Step 2: links between components that a bucket of ``shared`` (key, band, uid, n) holds."""
    placed = (shared.join(roots, F.col("uid") == F.col("node"), "left").select("key", "band", "uid", "n", F.coalesce("root", "uid").alias("root")))
    placed = cut_lineage(placed)
    sizes = placed.groupBy("key", "root").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("held"))
    torn = sizes.groupBy("key").agg(F.max_by("root", F.struct("held", "root")).alias("main"), F.sum("n").alias("all_n"), F.max(F.struct("held", "root", "n")).alias("m"), F.count(F.lit(1)).alias("roots"))
    torn = torn.where("roots > 1").select("key", "main", F.ceil((F.col("all_n") - F.col("m.n")) / chunk).cast("int").alias("gx"), F.ceil(F.col("all_n") / chunk).cast("int").alias("gy"))
    rows = placed.join(torn, "key").join(classes.select("uid", "signature", "keys"), "uid")
    chunk_of = lambda g: F.pmod(F.xxhash64(F.lit(7), "uid"), F.col(g)).cast("int")
    cols = ["key", "band", "i", "j", "side", "uid", "root", "n", "signature", "keys"]
    one = (rows.where("root != main").withColumn("i", chunk_of("gx")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("gy") - 1))).withColumn("side", F.lit(0)))
    two = rows.withColumn("j", chunk_of("gy")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("gx") - 1))).withColumn("side", F.lit(1))
    parts = cut_lineage(one.select(cols).unionByName(two.select(cols)))
    tasks = max(1, parts.count() // TASK_ROWS)
    schema = "key long, i int, j int, side int, uid binary, root binary"
    found = parts.withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(tasks))).groupBy("task").applyInPandas(_likely_members(scheme, percent), schema)
    members = cut_lineage(found)
    texts = _texts(members.select("uid").distinct(), classes, docs, id_col, text_col)
    return members.join(texts, "uid").groupBy("key", "i", "j").applyInPandas(_forest(percent, shingle), "u binary, v binary")


def links(classes: DataFrame, docs: DataFrame, scheme: Scheme, percent: int = 85, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text",
          chunk: int = CHUNK) -> DataFrame:
    """(uid, root): components of the classes (uid, n, keys, signature, text_key) under links of at least ``percent`` % similarity.

    ``chunk`` never changes the result.
    """
    entries = classes.select("uid", "n", F.posexplode("keys").alias("band", "key"))
    stars = entries.groupBy("key").agg(F.min(F.struct(F.xxhash64("uid").alias("h"), "uid")).alias("least"), F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = cut_lineage(entries.join(stars.select("key", F.col("least.uid").alias("v")), "key"))
    pairs = shared.where("uid != v").select(F.col("uid").alias("u"), "v").distinct()
    likely = cut_lineage(_likely(pairs, classes, scheme, percent))
    texts = _texts(likely.select(F.explode(F.array("u", "v")).alias("uid")).distinct(), classes, docs, id_col, text_col)
    sure = cut_lineage(_confirmed(likely, texts, percent, shingle))
    roots = cut_lineage(components(sure))
    more = cut_lineage(_across(shared.select("key", "band", "uid", "n"), roots, classes, docs, scheme, percent, shingle, id_col, text_col, chunk))
    if not more.isEmpty():
        roots = cut_lineage(components(sure.unionByName(more)))
    return classes.join(roots, F.col("uid") == F.col("node"), "left").select("uid", F.coalesce("root", "uid").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 85, scheme: Scheme | None = None,
                    chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Texts of fewer than ``shingle`` words have their whole word sequence as one
    member; null texts and texts without words are linked with nothing and have
    their own id as component.  ``component_id`` is the smallest doc_id that links
    reach, the row's own included; rows of a null doc_id take part, a component of
    such rows alone has a null id.  ``kept`` is whether doc_id is component_id.
    Repeated rows come back as often as they came.
    """
    scheme = scheme or Scheme()
    rows = cut_lineage(signatures(docs, scheme, id_col, text_col, shingle))
    classes = rows.where("uid IS NOT NULL").groupBy("uid").agg(
        F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("signature").alias("signature"))
    classes = cut_lineage(classes)
    rooted = cut_lineage(links(classes, docs, scheme, percent, shingle, id_col, text_col, chunk))
    ids = rooted.join(classes.select("uid", "least"), "uid").groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("uid", "component_id")
    component = F.when(F.col("uid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (rows.select("doc_id", "n", "uid").join(named, "uid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")))
