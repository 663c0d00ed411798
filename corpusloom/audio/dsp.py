"""Spectral measures and repairs of one clip, in numpy: brightness, cleanliness, tilt, tones, breath, equaliser."""

from __future__ import annotations

import numpy as np

from corpusloom.audio.frames import QUIET, db, levels, runs


def spectrum(x: np.ndarray, rate: int, size: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """(frequencies, mean power) over half-overlapping Hann windows; a short clip is zero-padded to one window."""
    if len(x) < size:
        x = np.pad(x, (0, size - len(x)))
    starts = np.arange(0, len(x) - size + 1, size // 2)
    frames = np.stack([x[s : s + size] for s in starts]) * np.hanning(size)
    return np.fft.rfftfreq(size, 1 / rate), (np.abs(np.fft.rfft(frames, axis=1)) ** 2).mean(axis=0)


def band_db(freq: np.ndarray, power: np.ndarray, lo: float, hi: float) -> float:
    """Mean level of a band in dB."""
    m = (freq >= lo) & (freq < hi)
    return float((10 * np.log10(power[m] + QUIET)).mean()) if m.any() else float("nan")


def brightness(x: np.ndarray, rate: int) -> tuple[float, float]:
    """(3.5-8 kHz level minus 0.3-2 kHz level, spread of frame levels p95 - p10 over 50 ms frames) in dB."""
    f, p = spectrum(x, rate)
    lv = db(levels(x, max(1, rate // 20)))
    lv = lv[lv > -60]
    dyn = float(np.percentile(lv, 95) - np.percentile(lv, 10)) if len(lv) else 0.0
    return band_db(f, p, 3500, 8000) - band_db(f, p, 300, 2000), dyn


# Bounds of the cleanliness measures.
MAINS_HZ, QUIET_SHARE, LOUD_SHARE, LINE_FFT = 120.0, 20, 80, 1 << 14


def running_median(v: np.ndarray, size: int) -> np.ndarray:
    """The median of ``size`` (odd) values around each one, the ends mirrored."""
    return np.median(np.lib.stride_tricks.sliding_window_view(np.pad(v, size // 2, mode="symmetric"), size), axis=1)


def cleanliness(x: np.ndarray, rate: int, zeros_ms: float = 100.0, mains: float = MAINS_HZ) -> dict[str, float] | None:
    """D2 in dB, over 20 ms frames: floor and speech (RMS of all samples of the quietest and of the loudest fifth of the
    frames), hum (the most that ``mains`` or its next two harmonics stand out of a running median of the quiet
    spectrum), hiss (quiet level above 6 kHz less that of 0.3-6 kHz); clipped share; dropout (share of the clip in runs
    of digital zeros of ``zeros_ms`` or more). None for a clip under a quarter second or without enough quiet."""
    if len(x) < rate // 4:
        return None
    size = max(1, int(rate * 0.02))
    frames = x[: len(x) // size * size].reshape(-1, size)
    lv = levels(x, size)
    quiet, loud = frames[lv <= np.percentile(lv, QUIET_SHARE)].ravel(), frames[lv >= np.percentile(lv, LOUD_SHARE)].ravel()
    if len(quiet) < LINE_FFT // 4 or not len(loud):
        return None
    still = np.pad(quiet[:LINE_FFT], (0, max(0, LINE_FFT - len(quiet))))
    spec, f = db(np.abs(np.fft.rfft(still * np.hanning(LINE_FFT)))), np.fft.rfftfreq(LINE_FFT, 1 / rate)
    high, mid = f >= 6000, (f >= 300) & (f < 6000)
    if not high.any():
        raise ValueError(f"a rate of {rate} is too low to measure hiss")
    stands_out = spec - running_median(spec, 201)
    lines = [stands_out[np.abs(f - mains * k) <= 8.0] for k in (1, 2, 3) if mains * k < f[-1]]
    zeros = sum(b - a for a, b in runs(x == 0, max(1, int(rate * zeros_ms / 1000))))
    rms = lambda y: float(db(np.sqrt((y**2).mean())))
    return {
        "floor": rms(quiet), "speech": rms(loud), "hum": max([0.0, *(float(v.max()) for v in lines if len(v))]), "hiss": float(spec[high].mean() - spec[mid].mean()),
        "clipped": float((np.abs(x) >= 0.999).mean()), "dropout": zeros / len(x),
    }


def tilt(x: np.ndarray, rate: int) -> float:
    """D3: level of 2-8 kHz minus level of 100-1000 Hz in dB."""
    f, p = spectrum(x, rate)
    return band_db(f, p, 2000, 8000) - band_db(f, p, 100, 1000)


def bands(count: int = 27, lo: float = 50.0, hi: float = 10_000.0) -> np.ndarray:
    return np.geomspace(lo, hi, count)


def ltas(x: np.ndarray, rate: int, centres: np.ndarray) -> np.ndarray:
    """D3: long-term level per band, a third of an octave wide."""
    f, p = spectrum(x, rate, 8192)
    return np.array([band_db(f, p, c / 2 ** (1 / 6), c * 2 ** (1 / 6)) for c in centres])


def smooth(v: np.ndarray, k: int) -> np.ndarray:
    """Moving average over 2k + 1 values, edges repeated."""
    return np.convolve(np.pad(v, k, mode="edge"), np.ones(2 * k + 1) / (2 * k + 1), "valid")


def eq_plan(source: np.ndarray, target: np.ndarray, most: float = 6.0, k: int = 1) -> np.ndarray:
    """D3: gains per band that bring ``source`` to ``target``: level aside, smoothed, at most ``most`` dB each way."""
    d = target - source
    return np.clip(smooth(d - np.nanmean(d), k), -most, most)


def refine_plan(plan: np.ndarray, residual: np.ndarray, step: float = 0.7, most: float = 6.0) -> np.ndarray:
    return np.clip(plan + step * (residual - np.nanmean(residual)), -most, most)


def apply_eq(x: np.ndarray, rate: int, centres: np.ndarray, gains: np.ndarray, invert: bool = False) -> np.ndarray:
    """A gain curve over the whole clip's spectrum; ``invert`` takes it off again."""
    f = np.fft.rfftfreq(len(x), 1 / rate)
    g = np.interp(np.log(np.maximum(f, 1.0)), np.log(centres), gains)
    return np.fft.irfft(np.fft.rfft(x) * 10 ** ((-g if invert else g) / 20), len(x))


def resample(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """Band-limited resampling by cutting or padding the spectrum."""
    n = int(round(len(x) * b / a))
    s = np.fft.rfft(x)
    out = np.zeros(n // 2 + 1, complex)
    k = min(len(s), len(out))
    out[:k] = s[:k]
    return np.fft.irfft(out, n) * n / max(1, len(x))


def local_median(level: np.ndarray, reach: int = 12, gap: int = 2) -> np.ndarray:
    """Along the last axis, the median of ``reach`` values on each side without the ``gap`` nearest ones and the centre,
    ends repeated."""
    pad = [(0, 0)] * (level.ndim - 1) + [(reach, reach)]
    around = np.lib.stride_tricks.sliding_window_view(np.pad(level, pad, mode="edge"), 2 * reach + 1, axis=-1)
    outside = np.flatnonzero(np.abs(np.arange(-reach, reach + 1)) > gap)
    return np.median(around[..., outside], axis=-1)


def tones(x: np.ndarray, rate: int, over_db: float = 8.0, persist: float = 0.3, lo: float = 200.0, size: int = 2048, hop: int = 512) -> list[tuple[float, float, float]]:
    """(Hz, share of active frames, dB) of the bins from ``lo`` on that stand ``over_db`` out of their local median in more
    than ``persist`` of the active frames (those above the 40th percentile of energy); bins at most two apart are one
    tone, that of the most frames. dB is the median where it stands out. Too short a clip has none."""
    if len(x) < 4 * size:
        return []
    starts = np.arange(0, len(x) - size, hop)
    spec = np.abs(np.fft.rfft(np.lib.stride_tricks.sliding_window_view(x, size)[starts] * np.hanning(size), axis=1))
    energy = spec.sum(axis=1)
    active = energy > np.percentile(energy, 40)
    if active.sum() < 10:
        return []
    level = db(spec[active])
    over = level - local_median(level)
    hit = over > over_db
    share, f = hit.mean(axis=0), np.fft.rfftfreq(size, 1 / rate)
    bins = np.flatnonzero((share > persist) & (f >= lo))
    out, last = [], 0  # the distance is taken from the bin that stands for the tone, as long as no other bin takes its place
    for i in bins.tolist():
        if out and i - last <= 2:
            if share[i] > share[out[-1]]:
                out[-1] = last = i
        else:
            out.append(i)
            last = i
    return [(float(f[i]), float(share[i]), float(np.median(over[hit[:, i], i]))) for i in out]


def comb_strength(x: np.ndarray, rate: int, base: float, teeth: int = 6) -> float:
    """Mean level of the harmonics of ``base`` over the levels half-way between them."""
    f, p = spectrum(x, rate, 8192)
    on = [band_db(f, p, base * k - 8, base * k + 8) for k in range(1, teeth + 1) if base * k < rate / 2]
    off = [band_db(f, p, base * (k + 0.5) - 8, base * (k + 0.5) + 8) for k in range(1, teeth + 1) if base * (k + 0.5) < rate / 2]
    return float(np.nanmean(on) - np.nanmean(off))


def edge_kind(x: np.ndarray, rate: int, ms: float = 60.0) -> str:
    """How a clip begins: dead (below -55 dB), breathy (below -30 dB) or hot."""
    lv = float(db(np.sqrt((x[: max(1, int(rate * ms / 1000))] ** 2).mean()))) if len(x) else -240.0
    return "dead" if lv < -55 else "breathy" if lv < -30 else "hot"


def breath_lead(x: np.ndarray, rate: int, speech_db: float = -32.0, floor_db: float = -50.0, at_least: float = 0.06) -> bool:
    """Is there a lead of 60 ms or more before the speech with a peak of -50 to -32 dB."""
    lv = db(levels(x, max(1, rate // 100)))
    loud = np.flatnonzero(lv > speech_db)
    lead = lv[: loud[0]] if len(loud) else lv
    return len(lead) * 0.01 >= at_least and bool(len(lead)) and floor_db <= float(lead.max()) <= speech_db


def notch(x: np.ndarray, rate: int, hz: float, width: float = 20.0, depth_db: float = 24.0) -> np.ndarray:
    """A spectral notch with soft sides."""
    f = np.fft.rfftfreq(len(x), 1 / rate)
    g = -depth_db * np.exp(-0.5 * ((f - hz) / (width / 2)) ** 2)
    return np.fft.irfft(np.fft.rfft(x) * 10 ** (g / 20), len(x))


def crossfade(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """``b`` after ``a`` with ``n`` samples of equal-power overlap."""
    n = min(n, len(a), len(b))
    if not n:
        return np.concatenate([a, b])
    t = np.linspace(0, np.pi / 2, n)
    return np.concatenate([a[:-n], a[-n:] * np.cos(t) + b[:n] * np.sin(t), b[n:]])


def bed(x: np.ndarray, rate: int, seconds: float, below_db: float = -50.0) -> np.ndarray | None:
    """Room tone of a given length harvested from quiet stretches and crossfaded; None if there is none."""
    size = max(1, rate // 100)
    quiet = [x[a * size : b * size] for a, b in runs(db(levels(x, size)) < below_db, 5)]
    if not quiet:
        return None
    out = quiet[0]
    i = 0
    while len(out) < seconds * rate:
        i += 1
        out = crossfade(out, quiet[i % len(quiet)], size)
    return out[: int(seconds * rate)]


def mix_bed(x: np.ndarray, tone: np.ndarray, db_down: float = 0.0) -> np.ndarray:
    """Room tone under a clip, repeated to its length."""
    return x + np.resize(tone, len(x)) * 10 ** (-db_down / 20)


def onset(x: np.ndarray, rate: int, start: float, end: float, rise_db: float = 12.0) -> float | None:
    """Seconds at which the level first rises ``rise_db`` over the quietest frame of [start, end]."""
    size = max(1, rate // 100)
    lv = db(levels(x[int(start * rate) : int(end * rate)], size))
    up = np.flatnonzero(lv > lv.min() + rise_db) if len(lv) else []
    return start + float(up[0]) * size / rate if len(up) else None


def summary(x: np.ndarray, rate: int) -> dict[str, float]:
    """Tail, median and longest inner silence, tilt, speech share of a clip."""
    from corpusloom.audio.frames import pauses

    lead, inner, tail = pauses(x, rate)
    lengths = [b - a for a, b in inner]
    total = len(x) / rate if len(x) else 0.0
    return {"tail": tail, "internal": float(np.median(lengths)) if lengths else 0.0, "max_sil": max([tail, lead, *lengths]), "tilt": tilt(x, rate), "speech": 1 - (lead + tail + sum(lengths)) / total if total else 0.0}
