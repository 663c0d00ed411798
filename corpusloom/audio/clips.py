"""Measures and repairs of audio files as DataFrame operators: a row per file (or per tone), files read once, in parallel."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.audio import dsp, frames

MEASURES = (
    "path string, rate int, seconds double, bright double, dyn double, floor double, speech_db double, hum double, hiss double, clipped double, dropout double, "
    "lead double, tail double, internal double, max_sil double, tilt double, speech double, head_quiet boolean, tail_quiet boolean, edge string, breath boolean"
)
TONES = "path string, hz double, share double, over_db double"


def read_audio(spark: SparkSession, path: str) -> DataFrame:
    """path, content of 16-bit PCM WAV files; column pruning leaves only these to be read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", True).load(path).select("path", "content")


def _each(files: DataFrame, rows, schema: str) -> DataFrame:
    """``rows`` (a function of path, samples, rate) over each file; a file comes out of memory before the next is decoded."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):
                if out := rows(p, *frames.decode(bytes(content))):
                    yield pd.DataFrame(out, columns=names)

    return files.select("path", "content").mapInPandas(run, schema)


def measures(files: DataFrame) -> DataFrame:
    """A row per file of (path, content): length, brightness and dynamics, cleanliness (nulls where the
    clip is too short for it), lead, tail and inner pauses, tilt, share of speech, quiet edges, how it begins."""

    def rows(path: str, x: np.ndarray, rate: int) -> list[tuple]:
        clean = dsp.cleanliness(x, rate) or dict.fromkeys(("floor", "speech", "hum", "hiss", "clipped", "dropout"))
        own = dsp.summary(x, rate)
        bright, dyn = dsp.brightness(x, rate)
        head, tail = frames.edges_quiet(x, rate)
        values = (bright, dyn, clean["floor"], clean["speech"], clean["hum"], clean["hiss"], clean["clipped"], clean["dropout"])
        return [(path, rate, len(x) / rate, *values, frames.pauses(x, rate)[0], own["tail"], own["internal"], own["max_sil"], own["tilt"], own["speech"], head, tail, dsp.edge_kind(x, rate), dsp.breath_lead(x, rate))]

    return _each(files, rows, MEASURES)


def tones(files: DataFrame, over_db: float = 8.0, persist: float = 0.3) -> DataFrame:
    """A row per tone of each file: path, hz, share of active frames, dB over the local median. Files without one have none."""
    return _each(files, lambda path, x, rate: [(path, *t) for t in dsp.tones(x, rate, over_db, persist)], TONES)


def clean_gates(measured: DataFrame) -> dict[str, Column]:
    """The masks of clips that are not clean, over columns of ``measures``; thresholds are those of the corpus at hand."""
    c = F.col
    return {"dead": c("floor") < -100.0, "no_floor": c("floor").isNull(), "clips": c("clipped") > 0.0, "dropout": c("dropout") > 0.001}


def quiet_points(files: DataFrame, gaps: DataFrame) -> DataFrame:
    """For each gap (path, g0, g1 in seconds) the quietest point in it: path, g0, g1, quiet. A file meets its gaps once."""
    per = gaps.where("g0 < g1").groupBy("path").agg(F.sort_array(F.collect_list(F.struct("g0", "g1"))).alias("gaps"))  # of one file

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for p, content, own in zip(pdf["path"], pdf["content"], pdf["gaps"]):
                x, rate = frames.decode(bytes(content))
                yield pd.DataFrame([(p, g["g0"], g["g1"], frames.quietest(x, int(g["g0"] * rate), int(g["g1"] * rate), rate) / rate) for g in own], columns=["path", "g0", "g1", "quiet"])

    return files.join(per, "path").select("path", "content", "gaps").mapInPandas(run, "path string, g0 double, g1 double, quiet double")


def trimmed(files: DataFrame, goals: DataFrame, fade_ms: float = 5.0) -> DataFrame:
    """Path, content, cut (seconds) of each file of ``goals`` (path, goal): its tail cut at the first truly silent
    frame at or after the goal, with faded edges; a file without such a frame, or without a goal, stays as it is."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for p, content, goal in zip(pdf["path"], pdf["content"], pdf["goal"]):
                x, rate = frames.decode(bytes(content))
                y = x if pd.isna(goal) else frames.trim_tail(x, rate, goal)
                kept = content if len(y) == len(x) else frames.encode(frames.fade(y, rate, fade_ms), rate)
                yield pd.DataFrame({"path": [p], "content": [bytes(kept)], "cut": [(len(x) - len(y)) / rate]})

    return files.join(goals.select("path", "goal"), "path").select("path", "content", "goal").mapInPandas(run, "path string, content binary, cut double")


def changed(files: DataFrame, change) -> DataFrame:
    """path, content of each file after ``change``, a function of (samples, rate) to (samples, rate)."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):
                yield pd.DataFrame({"path": [p], "content": [frames.encode(*change(*frames.decode(bytes(content))))]})

    return files.select("path", "content").mapInPandas(run, "path string, content binary")


def resampled(files: DataFrame, rate: int) -> DataFrame:
    """Files at another rate."""
    return changed(files, lambda x, own: (dsp.resample(x, own, rate), rate))


def band_levels(files: DataFrame) -> DataFrame:
    """D3: long-term levels, a row per file and band: path, band, hz, level."""
    centres = dsp.bands()
    return _each(files, lambda path, x, rate: [(path, i, float(c), float(v)) for i, (c, v) in enumerate(zip(centres, dsp.ltas(x, rate, centres)))], "path string, band int, hz double, level double")


def eq_gains(source: DataFrame, target: DataFrame, most: float = 6.0) -> list[float]:
    """D3: the gain of each band that brings the mean levels of one corpus to those of another (both from ``band_levels``;
    27 numbers come to the driver)."""
    mean = lambda df: [r["v"] for r in df.where(~F.isnan("level")).groupBy("band").agg(F.avg("level").alias("v")).orderBy("band").collect()]
    a, b = mean(source), mean(target)
    if len(a) != len(b):
        raise ValueError("the corpora do not fill the same bands")
    return [float(g) for g in dsp.eq_plan(np.array(a), np.array(b), most)]


def equalised(files: DataFrame, gains: list[float], invert: bool = False) -> DataFrame:
    """Files with the gains of each band put on, or taken off again."""
    centres, g = dsp.bands(), np.array(gains)
    return changed(files, lambda x, rate: (dsp.apply_eq(x, rate, centres, g, invert), rate))


def notched(files: DataFrame, hz: list[float]) -> DataFrame:
    """Files without the given tones."""

    def change(x: np.ndarray, rate: int) -> tuple[np.ndarray, int]:
        for f in hz:
            x = dsp.notch(x, rate, f)
        return x, rate

    return changed(files, change)


def beds(files: DataFrame, seconds: float) -> DataFrame:
    """Path, content of a bed of room tone harvested from each file; a file without quiet stretches has no row."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):
                x, rate = frames.decode(bytes(content))
                if (tone := dsp.bed(x, rate, seconds)) is not None:
                    yield pd.DataFrame({"path": [p], "content": [frames.encode(tone, rate)]})

    return files.select("path", "content").mapInPandas(run, "path string, content binary")
