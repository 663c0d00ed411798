"""Stage state: what has been done for which inputs, what is stale, and checks of configurations and profiles."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGES = ("merge", "align", "verify", "cut", "stage", "train")
#: Durations may differ by this many seconds.
DURATION_SLACK = 0.01
LONGEST_CLIP = 20.0


def stage_states(inputs: DataFrame, records: DataFrame) -> DataFrame:
    """For each part set and stage its state: missing, failed, stale or done.

    inputs: part_set, stage, size, mtime_ns, n (what the inputs are now). records: the same columns and passed (what
    they were when the stage ran). A record for other inputs is stale."""
    r = records.select("part_set", "stage", *(F.col(c).alias(f"_{c}") for c in ("size", "mtime_ns", "n", "passed")))
    same = F.col("size").eqNullSafe(F.col("_size")) & F.col("mtime_ns").eqNullSafe(F.col("_mtime_ns")) & F.col("n").eqNullSafe(F.col("_n"))
    state = F.when(F.col("_passed").isNull(), "missing").when(~F.col("_passed"), "failed").when(~same, "stale").otherwise("done")
    return inputs.join(r, ["part_set", "stage"], "left").select("part_set", "stage", state.alias("state"))


def next_stages(states: DataFrame) -> DataFrame:
    """For each part set the first stage that is not done (null if all are)."""
    order = F.array_position(F.array(*map(F.lit, STAGES)), F.col("stage"))
    first = F.min_by("stage", F.when(F.col("state") != "done", order))
    return states.groupBy("part_set").agg(F.when(F.count_if(F.col("state") != "done") > 0, first).alias("next_stage"))


def duration_ok(parts: float, whole: float) -> bool:
    return abs(parts - whole) <= DURATION_SLACK


def timeline_ok(a: float, b: float, rate_a: int, rate_b: int) -> bool:
    """V5: two renderings of one timeline: under 50 ms apart, an integer ratio of rates."""
    return abs(a - b) < 0.05 and max(rate_a, rate_b) % min(rate_a, rate_b) == 0


def preflight(verified: bool, staged: bool, card_free: bool, profile_ok: bool) -> list[str]:
    """What stops a training run."""
    return [what for what, ok in (("not verified", verified), ("not staged", staged), ("no room on the card", card_free), ("profile is invalid", profile_ok)) if not ok]


@dataclass(frozen=True)
class Profile:
    """V4: a training profile. Unknown, missing or wrongly typed fields fail; nothing has a fallback."""

    name: str
    kind: str
    max_seq_length: int
    max_clip_seconds: float
    epochs: int
    batch: int
    learning_rate: float
    assistant_only: bool

    @classmethod
    def load(cls, raw: dict) -> Profile:
        known = {f.name: f.type for f in fields(cls)}
        if wrong := sorted(set(raw) ^ set(known)):
            raise ValueError(f"unknown or missing fields: {', '.join(wrong)}")
        kinds = {"str": str, "int": int, "float": (int, float), "bool": bool}
        for name, kind in known.items():
            if not isinstance(raw[name], kinds[kind]) or (kind in ("int", "float") and isinstance(raw[name], bool)):
                raise ValueError(f"{name} must be {kind}")
            if kind in ("int", "float") and raw[name] <= 0:
                raise ValueError(f"{name} must be above 0")
        if raw["max_clip_seconds"] > LONGEST_CLIP and raw["kind"] == "voice":
            raise ValueError(f"clips over {LONGEST_CLIP:g} s are not stable")
        return cls(**raw)


def part_sets(raw: list[dict]) -> list[dict]:
    """V4: part sets with unique names and the fields they need."""
    names = [p.get("name") for p in raw]
    if None in names or "" in names or len(set(names)) != len(names):
        raise ValueError("part sets need unique names")
    return raw


def required_env(*names: str) -> dict[str, str]:
    """Settings from the environment, without defaults."""
    if missing := [n for n in names if not os.environ.get(n)]:
        raise KeyError(f"not set: {', '.join(missing)}")
    return {n: os.environ[n] for n in names}


def parse_ranges(text: str) -> list[tuple[float, float]]:
    """P13: '12.5-30,41-55' as intervals; malformed, empty or reversed ones fail."""
    out = []
    for part in text.split(","):
        a, sep, b = part.strip().partition("-")
        try:
            pair = (float(a), float(b))
        except ValueError:
            raise ValueError(f"not a range: {part!r}") from None
        if not sep or pair[1] <= pair[0]:
            raise ValueError(f"empty range: {part!r}")
        out.append(pair)
    return out


def excluded_something(before: int, after: int) -> None:
    """Ranges that match no cue are a mistake."""
    if before == after:
        raise ValueError("the excluded ranges match no cue")
