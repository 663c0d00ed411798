"""PCM files as frames: stdlib WAV decoding, frame levels, silence runs, pauses and tails. numpy inside, one file per call."""

from __future__ import annotations

import io
import wave

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAMES = "path string, frame long, rms double, peak double"
QUIET = 1e-12


def decode(content: bytes, gain_db: float = 0.0) -> tuple[np.ndarray, int]:
    """(mono samples in -1..1, rate) of a 16-bit PCM WAV; channels are averaged; a gain that would clip fails."""
    with wave.open(io.BytesIO(content)) as w:
        if w.getsampwidth() != 2:
            raise ValueError("only 16-bit PCM")
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels()).mean(axis=1) / 32768.0
        rate = w.getframerate()
    x = x * 10 ** (gain_db / 20)
    if len(x) and np.abs(x).max() > 1:
        raise ValueError("the gain clips")
    return x, rate


def encode(x: np.ndarray, rate: int) -> bytes:
    """A 16-bit mono WAV; samples beyond full scale are clipped."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32767).round().astype("<i2").tobytes())
    return out.getvalue()


def db(x) -> np.ndarray:
    return 20 * np.log10(np.asarray(x) + QUIET)


def levels(x: np.ndarray, size: int) -> np.ndarray:
    """RMS of whole frames of ``size`` samples; a tail shorter than a frame is dropped."""
    n = len(x) // size
    return np.sqrt((x[: n * size].reshape(n, size) ** 2).mean(axis=1)) if n else np.zeros(0)


def read_frames(spark: SparkSession, path: str, ms: float = 20.0, gain_db: float = 0.0) -> DataFrame:
    """Path, frame, rms, peak of each frame of each file."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):
                x, rate = decode(bytes(content), gain_db)
                size = max(1, int(rate * ms / 1000))
                rms = levels(x, size)
                peak = np.abs(x[: len(rms) * size].reshape(len(rms), size)).max(axis=1) if len(rms) else rms
                yield pd.DataFrame({"path": p, "frame": np.arange(len(rms)), "rms": rms, "peak": peak})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, FRAMES)


def runs(mask: np.ndarray, at_least: int = 1) -> list[tuple[int, int]]:
    """Half-open runs of true values of at least ``at_least``."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2]) if b - a >= at_least]


def speech_intervals(x: np.ndarray, top_db: float = 60.0, frame: int = 2048, hop: int = 512) -> list[tuple[int, int]]:
    """Samples of the parts within ``top_db`` of the loudest frame (centred frames, zero-padded), as half-open intervals."""
    if not len(x):
        return []
    padded = np.pad(x, frame // 2)
    power = np.concatenate(([0.0], np.cumsum(padded**2)))
    starts = np.arange(0, len(padded) - frame + 1, hop)
    rms = np.sqrt(np.maximum(power[starts + frame] - power[starts], 0) / frame)
    loud = 20 * np.log10(np.maximum(rms, 1e-10) / max(rms.max(), 1e-10)) > -top_db
    return [(a * hop, min(len(x), b * hop)) for a, b in runs(loud)]


def pauses(x: np.ndarray, rate: int, below_db: float = -45.0, at_least: float = 0.1, ms: float = 10.0) -> tuple[float, list[tuple[float, float]], float]:
    """(leading silence, inner silences as (start, end), trailing silence) in seconds."""
    size = max(1, int(rate * ms / 1000))
    quiet = db(levels(x, size)) < below_db
    n, step = len(quiet), size / rate
    lead = tail = 0.0
    inner = []
    for a, b in runs(quiet):
        if a == 0:
            lead = (b - a) * step
        if b == n:
            tail = (b - a) * step
        if a > 0 and b < n and (b - a) * step >= at_least:
            inner.append((a * step, b * step))
    return lead, inner, tail


def quietest(x: np.ndarray, a: int, b: int, rate: int, reach: float = 0.01, pad: float = 0.06) -> int:
    """The sample in (a, b), ``pad`` from both ends where there is room, around which +-``reach`` seconds are quietest."""
    k, p = max(1, int(reach * rate)), int(pad * rate)
    lo, hi = (a + p, b - p) if b - a > 2 * p else (a, b)
    power = np.concatenate(([0.0], np.cumsum(x**2)))
    at = np.arange(lo, max(lo + 1, hi))
    left, right = np.maximum(0, at - k), np.minimum(len(x), at + k)
    return int(at[np.argmin((power[right] - power[left]) / np.maximum(1, right - left))])


def edges_quiet(x: np.ndarray, rate: int, ms: float = 15.0, most: float = 0.02) -> tuple[bool, bool]:
    """V3: are the first and the last ``ms`` milliseconds at most ``most`` RMS."""
    k = max(1, int(rate * ms / 1000))
    level = lambda y: float(np.sqrt((y**2).mean())) if len(y) else 0.0
    return level(x[:k]) <= most, level(x[-k:]) <= most


def fade(x: np.ndarray, rate: int, ms: float = 5.0) -> np.ndarray:
    """Linear fades at both ends."""
    k = min(len(x) // 2, int(rate * ms / 1000))
    y = x.copy()
    if k:
        ramp = np.linspace(0, 1, k)
        y[:k] *= ramp
        y[-k:] *= ramp[::-1]
    return y


def cap_pauses(x: np.ndarray, rate: int, silences: list[tuple[float, float]], keep: list[float]) -> np.ndarray:
    """I16: each silence shortened to ``keep`` seconds by cutting out its middle."""
    out, at = [], 0
    for (a, b), k in zip(silences, keep):
        cut = (b - a) - k
        if cut > 0:
            mid = (a + b) / 2
            i, j = int((mid - cut / 2) * rate), int((mid + cut / 2) * rate)
            out.append(x[at:i])
            at = j
    return np.concatenate([*out, x[at:]])


def trim_tail(x: np.ndarray, rate: int, goal: float, below_db: float = -55.0, ms: float = 10.0) -> np.ndarray:
    """Cut at the first truly silent frame at or after ``goal`` seconds of tail; untouched if there is none."""
    size = max(1, int(rate * ms / 1000))
    quiet = db(levels(x, size)) < below_db
    tail = runs(quiet)
    if not tail or tail[-1][1] != len(quiet):
        return x
    first = tail[-1][0] + int(-(-goal * rate // size))
    return x[: first * size] if first < len(quiet) else x


def tail_goals(df: DataFrame, tail: str, target: float) -> DataFrame:
    """Goal per clip when tails are scaled so that their median becomes ``target`` (a one-row aggregate is broadcast)."""
    from corpusloom.operators.select import with_percentiles

    scale = F.coalesce(F.try_divide(F.lit(target), F.col("_m")), F.lit(1.0))
    return with_percentiles(df, {"_m": (tail, 0.5)}).withColumn("goal", F.least(F.col(tail), F.col(tail) * scale)).drop("_m")
