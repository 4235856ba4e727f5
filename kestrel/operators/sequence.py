"""Frame sequences: padded windows, sliding and strided sequences, supporting
frames, detection reuse and running means (W1-W4, W7, T6, A41).

Frames are ``(video_id, frame_idx)`` rows.  Each frame first gets its
position inside its video (skew-safe ranking from ``plans.ordered``) and
the video length (one aggregation).  Every windowing rule is then a closed
form on positions: explode the k offsets of the window, clamp, and
equi-join (video, position) back to the frame table.  No video is ever
collected into one task, whatever its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.plans.ordered import running


def positions(frames: DataFrame, video: str = "video_id", frame: str = "frame_idx") -> DataFrame:
    """Adds ``pos`` (0-based order of the frame in its video) and ``n`` (video length)."""
    r = running(frames, [video], [F.col(frame)], rank_col="pos").withColumn("pos", F.col("pos") - 1)
    n = frames.groupBy(video).agg(F.count(F.lit(1)).alias("n"))
    return r.join(n, video)


def _lookup(pos: DataFrame, video: str, frame: str, src_col: str, out: str) -> DataFrame:
    return pos.select(F.col(video), F.col("pos").alias(src_col), F.col(frame).alias(out))


def padded_windows(frames: DataFrame, seq_len: int, causal: bool = False, step: int = 1,
                   video: str = "video_id", frame: str = "frame_idx") -> DataFrame:
    """For every target frame, ``seq_len`` source frames at positions
    target + (k - left) * step, padded with the first/last frame of the video
    (left = seq_len-1 if causal else (seq_len-1)//2).
    Output: video, target_frame, k, src_frame."""
    left = seq_len - 1 if causal else (seq_len - 1) // 2
    p = positions(frames, video, frame)
    w = p.select(video, F.col(frame).alias("target_frame"), "pos", "n",
                 F.explode(F.sequence(F.lit(0), F.lit(seq_len - 1))).alias("k"))
    w = w.withColumn("_src", F.least(F.greatest(F.col("pos") + (F.col("k") - left) * step, F.lit(0)), F.col("n") - 1))
    return w.join(_lookup(p, video, frame, "_src", "src_frame"), [video, "_src"]) \
            .select(video, "target_frame", "k", "src_frame")


def sliding_sequences(frames: DataFrame, seq_len: int, step: int = 1, video: str = "video_id",
                      frame: str = "frame_idx") -> DataFrame:
    """Every start position with a full sequence of ``seq_len`` frames
    ``step`` apart (span (seq_len-1)*step+1).  Output: video, seq_start, k, src_frame."""
    span = (seq_len - 1) * step + 1
    p = positions(frames, video, frame)
    starts = p.where(F.col("pos") + span <= F.col("n"))
    w = starts.select(video, F.col(frame).alias("seq_start"), "pos",
                      F.explode(F.sequence(F.lit(0), F.lit(seq_len - 1))).alias("k"))
    w = w.withColumn("_src", F.col("pos") + F.col("k") * step)
    return w.join(_lookup(p, video, frame, "_src", "src_frame"), [video, "_src"]) \
            .select(video, "seq_start", "k", "src_frame")


def multi_target_chunks(frames: DataFrame, size: int, stride: int, step: int = 1,
                        video: str = "video_id", frame: str = "frame_idx") -> DataFrame:
    """Chunks of ``size`` positions starting every ``stride``; only the first
    (n + stride - size) // stride chunks (the incomplete tail is dropped); inside
    a chunk every ``step``-th frame.  Output: video, chunk, k, src_frame."""
    p = positions(frames, video, frame)
    heads = p.where((F.col("pos") % stride == 0)
                    & (F.col("pos") / stride < F.floor((F.col("n") + stride - size) / stride)))
    w = heads.select(video, (F.col("pos") / stride).cast("long").alias("chunk"), "pos",
                     F.explode(F.sequence(F.lit(0), F.lit((size - 1) // step))).alias("k"))
    w = w.withColumn("_src", F.col("pos") + F.col("k") * step)
    return w.join(_lookup(p, video, frame, "_src", "src_frame"), [video, "_src"]) \
            .select(video, "chunk", "k", "src_frame")


def subset_fraction(seqs: DataFrame, key: str, frac: float, seed: int = 0) -> DataFrame:
    """A contiguous slice of ``int(count * frac)`` sequences (ordered by
    ``key``) starting at a seeded position.  The start is drawn on the driver
    from the count; the slice is a range filter on the global rank."""
    import random
    n = seqs.count()
    size = int(n * frac)
    start = random.Random(seed).randint(0, n - size)
    r = running(seqs.withColumn("_one", F.lit(1)), ["_one"], [F.col(key)], rank_col="_r")
    return r.where((F.col("_r") > start) & (F.col("_r") <= start + size)).drop("_one", "_r")


def supporting_frames(frames: DataFrame, offsets: list[int], online: bool = False,
                      video: str = "video_id", frame: str = "frame_idx") -> DataFrame:
    """The current frame first, then frame + offset for each non-zero offset,
    clipped to [0, n-1] (online: to [0, current]).  Output: video, frame, slot, support_frame."""
    offs = [0] + [o for o in offsets if o != 0]
    p = positions(frames, video, frame)
    arr = F.array(*[F.lit(o) for o in offs])
    w = p.select(video, F.col(frame).alias("frame"), "pos", "n", F.posexplode(arr).alias("slot", "off"))
    hi = F.col("pos") if online else F.col("n") - 1
    w = w.withColumn("_src", F.least(F.greatest(F.col("pos") + F.col("off"), F.lit(0)), hi))
    return w.join(_lookup(p, video, frame, "_src", "support_frame"), [video, "_src"]) \
            .select(video, "frame", "slot", "support_frame")


def detection_frames(frames: DataFrame, det_every: int, video: str = "video_id",
                     frame: str = "frame_idx") -> DataFrame:
    """Frames at positions divisible by ``det_every`` run detection; the
    frames between reuse the boxes of the last such frame.  Output: video,
    frame, det_frame."""
    p = positions(frames, video, frame)
    w = p.select(video, F.col(frame).alias("frame"), (F.col("pos") - F.col("pos") % det_every).alias("_src"))
    return w.join(_lookup(p, video, frame, "_src", "det_frame"), [video, "_src"]).select(video, "frame", "det_frame")


def last_n_mean(df: DataFrame, key: str, order: str, value: str, n: int) -> DataFrame:
    """Mean of the last ``n`` values (fewer at the start) per key.

    Each row is copied to the n positions whose window contains it and the
    windows are summed by an equi-keyed aggregation, so a long series is
    spread over tasks instead of one window partition."""
    r = running(df, [key], [F.col(order)], rank_col="_pos")
    copies = r.select(key, "_pos", value, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_d")) \
              .select(key, (F.col("_pos") + F.col("_d")).alias("_pos"), value)
    agg = copies.groupBy(key, "_pos").agg(F.avg(value).alias("running_mean"))
    return r.join(agg, [key, "_pos"]).drop("_pos")


def track_sequences(poses: DataFrame, target: int = -1, video: str = "video_id", frame: str = "frame_idx", track: str = "track_id") -> DataFrame:
    """Video, track, pos, src_frame: the frame that stands at each place of the sequence of every track of the target frame.

    Places are the video's frames in order, ``target`` one of them (from the end,
    if negative; taken modulo their number).  From the target outwards a track
    stands for itself as long as no frame is without it; beyond, its last frame
    before the gap is repeated to the end.  (The reference leaves zeros on the
    right-hand side.)  Rows without a track (null or negative) only make frames.
    """
    frames = positions(poses.select(video, frame).distinct(), video, frame)
    at = F.pmod(F.col("n") + target, F.col("n"))
    held = (poses.where(F.col(track) >= 0).select(video, frame, track).distinct().join(frames, [video, frame])
            .select(video, track, "pos", "n", at.alias("_at")))
    # runs without a gap: place minus rank is the same in one
    ranked = running(held, [video, track], [F.col("pos")], rank_col="_r")
    runs = ranked.groupBy(video, track, (F.col("pos") - F.col("_r")).alias("_run")).agg(
        F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.first("n").alias("n"), F.first("_at").alias("_at"))
    runs = runs.where(F.col("_at").between(F.col("lo"), F.col("hi")))
    each = runs.select(video, track, "lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)).alias("pos"))
    src = each.select(video, track, F.col("pos").alias("_pos"), F.least(F.greatest("pos", "lo"), "hi").alias("pos"))
    return src.join(frames.select(video, "pos", F.col(frame).alias("src_frame")), [video, "pos"]).select(video, track, F.col("_pos").alias("pos"), "src_frame")
