"""Tracking (T3-T5) and causal frame windows (T7) on streams, by the machines of the batch operators in event-time order."""

from __future__ import annotations

from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.tracking import Frames, Similarity, box_similarity
from kestrel.streaming.ordered import ordered_fold

TRACK_SCHEMA = "video_id long, frame_idx long, det_id long, track_id long"
WINDOW_SCHEMA = "video_id long, target_frame long, k int, src_frame long"


def _track_fold(similarity: Similarity, threshold: float, restart: bool):
    def fold(key, rows, state):
        next_id, last, free = state or (0, None, [])
        out = []
        for frame, dets in groupby(rows, lambda r: r[1]):
            dets = list(dets)
            if last is None or frame != last + 1:
                free = []
            if restart and not free:
                next_id = 0
            machine = Frames(similarity, threshold, next_id, free)
            tracks = machine.feed([np.array(d[4], float) for d in dets], [bool(d[5]) for d in dets])
            out += [(d[0], d[1], d[2], -1 if t is None else t) for d, t in zip(dets, tracks, strict=True)]
            next_id, last, free = machine.next_id, frame, [(t, n.tolist()) for t, n in zip(machine.tracks, machine.numbers, strict=True)]
        return out, (next_id, last, free)
    return fold


def track_stream(stream: DataFrame, threshold: float = 0.3, similarity: Similarity = box_similarity, restart: bool = True, delay: str = "1 minute") -> DataFrame:
    """``tracking.track`` over a stream of (video_id, frame_idx, det_id, ts_ms, numbers, eligible); a frame's rows share their time."""
    rows = stream.select("video_id", "frame_idx", "det_id", "ts_ms", "numbers", "eligible")
    return ordered_fold(rows, ["video_id"], "ts_ms", ["frame_idx", "det_id"], _track_fold(similarity, threshold, restart), TRACK_SCHEMA, delay)


def _window_fold(length: int, step: int):
    reach = (length - 1) * step + 1

    def fold(key, rows, state):
        ring, out = state or [], []
        for video, frame, _ in rows:
            ring = [*ring, frame][-reach:]
            out += [(video, frame, k, ring[max(0, len(ring) - 1 - (length - 1 - k) * step)]) for k in range(length)]
        return out, ring
    return fold


def causal_windows_stream(stream: DataFrame, length: int, step: int = 1, delay: str = "1 minute") -> DataFrame:
    """For every frame of a stream (video_id, frame_idx, ts_ms) the ``length`` last frames, ``step`` apart, the first one repeated at the start.

    State is the ring of the last frames of each video.
    """
    rows = stream.select("video_id", "frame_idx", F.col("ts_ms"))
    return ordered_fold(rows, ["video_id"], "ts_ms", ["frame_idx"], _window_fold(length, step), WINDOW_SCHEMA, delay)
