"""Resumable fetching: what is left to do is an anti join, each batch is retried with a pause, state is a table."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.joins import todo

FETCHED = "id string, body string, ok boolean, tries int"


def with_retries(call: Callable[[list[str]], dict[str, str]], ids: list[str], tries: int = 4, pause: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> tuple[dict[str, str], int]:
    """(answers by id, tries used); the pause doubles after each failure, the last failure gives no answers."""
    for n in range(1, tries + 1):
        try:
            return call(ids), n
        except Exception:
            if n < tries:
                sleep(pause * 2 ** (n - 1))
    return {}, tries


def fetch_batches(wanted: DataFrame, done: DataFrame, call: Callable[[list[str]], dict[str, str]], batch: int = 50, tries: int = 4, pause: float = 1.0) -> DataFrame:
    """Id, body, ok, tries for each id of ``wanted`` not in ``done`` (both with a column id), ``batch`` ids a call."""

    def run(frames):
        import pandas as pd

        for pdf in frames:
            ids = list(pdf["id"])
            for i in range(0, len(ids), batch):
                part = ids[i : i + batch]
                got, n = with_retries(call, part, tries, pause)
                yield pd.DataFrame({"id": part, "body": [got.get(x) for x in part], "ok": [x in got for x in part], "tries": n})

    return todo(wanted.select("id").where(F.col("id").isNotNull()).distinct(), done, "id").mapInPandas(run, FETCHED)


def fetch_resumable(wanted: DataFrame, folder: str, call: Callable[[list[str]], dict[str, str]], batch: int = 1, tries: int = 4, pause: float = 1.0) -> DataFrame:
    """Like ``fetch_batches``, with the state on disk after each ``batch`` (one item unless told otherwise): a table of
    JSON lines in ``folder``, a path all executors share, each file moved into place as a whole. A task that is killed
    loses the call it was in; a later run asks for what has no answer yet. Returns all that is known, the answered once."""
    spark = wanted.sparkSession
    os.makedirs(folder, exist_ok=True)
    known = lambda: spark.read.schema(FETCHED).json(folder)

    def run(frames):
        for pdf in frames:
            ids = list(pdf["id"])
            for i in range(0, len(ids), batch):
                part = ids[i : i + batch]
                got, n = with_retries(call, part, tries, pause)
                name = f"{folder}/{uuid.uuid4().hex}"
                with open(f"{folder}/_{os.path.basename(name)}", "w", encoding="utf-8") as f:  # a leading underscore is not read
                    f.writelines(json.dumps({"id": x, "body": got.get(x), "ok": x in got, "tries": n}, ensure_ascii=False) + "\n" for x in part)
                os.replace(f.name, name + ".json")
                yield pdf.iloc[i : i + batch][["id"]]

    todo(wanted.select("id").where(F.col("id").isNotNull()).distinct(), known().where("ok"), "id").mapInPandas(run, "id string").write.format("noop").mode("overwrite").save()
    best = F.max_by(F.struct("body", "ok", "tries"), F.struct("ok", "tries"))
    return known().groupBy("id").agg(best.alias("b")).select("id", "b.*")


def pace(failures_in_a_row: int) -> tuple[float, bool]:
    """(seconds to wait, give up): a minute after every fifth failure in a row, the end at the 25th."""
    return (60.0 if failures_in_a_row and failures_in_a_row % 5 == 0 else 0.0), failures_in_a_row >= 25
