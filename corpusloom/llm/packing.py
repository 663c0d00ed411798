"""Filling fixed-capacity containers: bounded-space online best-fit, with rounds over what stayed open."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import TOKENIZERS, token_counter
from corpusloom.session import checked_broadcast, materialize

#: Open windows kept per profile and partition.
OPEN = 64
#: Groups of open windows that are packed together in each later round.
FAN_IN = 32
#: Profiles are few (each one packs all items); more than this are an error, none is left out.
MOST_PROFILES = 10_000


class BoundedPacker:
    """Keeps at most ``open_windows`` windows; an item goes to the one it fills best, else the fullest is emitted."""

    def __init__(self, capacity: int, open_windows: int = OPEN):
        self.capacity, self.most, self.windows, self.next = capacity, open_windows, [], 0  # windows: sorted (room, id)

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, size: int) -> int:
        """The window of an item of at most the capacity; an item of size 0 goes wherever one is open."""
        i = bisect_left(self.windows, (size, -1))
        if i < len(self.windows):
            room, at = self.windows.pop(i)
        else:
            if len(self.windows) >= self.most:
                self.windows.pop(0)  # the fullest
            room, at = self.capacity, self._new()
        if room - size > 0:
            insort(self.windows, (room - size, at))
        return at

    def alone(self) -> int:
        return self._new()


def pieces(size: int, capacity: int) -> list[tuple[int, int]]:
    """(start, size) of the parts of an item: one, unless it exceeds the capacity."""
    if size <= capacity:
        return [(0, size)]
    return [(a, min(capacity, size - a)) for a in range(0, size, capacity)]


ITEMS = "profile string, capacity int, part int, window long, doc_id long, piece int, start_token int, tokens int"
#: The piece number of the rows that say which windows were open at the end of a partition.
STILL_OPEN = -1


def pack(items: DataFrame, capacities: list[tuple[str, int]], open_windows: int = OPEN, fan_in: int = FAN_IN) -> DataFrame:
    """Containers of the rows (doc_id, tokens) of ``items``, one set for each (profile, capacity).

    Returns profile, container (string, unique in its profile), doc_id, piece, start_token, tokens. Each row of
    ``items`` is packed once per profile, repeated rows too. An item over the capacity is cut at multiples of the
    capacity (pieces 0, 1, ...); any other stays whole as piece 0. Null and zero sizes take no room but are placed.
    A profile with a null capacity or one below 1 gets no containers. An empty table gives no rows.

    Method: bounded-space online packing in each partition without a shuffle; what is still open at the end of the
    partitions (at most ``open_windows`` windows for each) is packed again as whole windows, ``fan_in`` partitions at a
    time; of each such group the emptiest ``open_windows`` go on to the next round, until one group is left. No group
    holds more than ``fan_in * open_windows`` windows, however large the input.
    """
    todo = [(p, int(c)) for p, c in capacities if c is not None and c >= 1]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        packers = [BoundedPacker(c, open_windows) for _, c in todo]
        def batch_of(profile: str, capacity: int, rows: list[tuple]) -> pa.RecordBatch:
            window, doc, piece, start, tokens = zip(*rows)
            m = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([profile] * m), pa.array([capacity] * m, pa.int32()), pa.array([part] * m, pa.int32()), pa.array(window, pa.int64()), pa.array(doc, pa.int64())]
                + [pa.array(x, pa.int32()) for x in (piece, start, tokens)],
                names=["profile", "capacity", "part", "window", "doc_id", "piece", "start_token", "tokens"],
            )

        for batch in batches:
            docs, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for (profile, capacity), packer in zip(todo, packers):
                rows = []
                for doc, size in zip(docs, sizes):
                    for k, (start, n) in enumerate(pieces(size or 0, capacity)):
                        rows.append((packer.alone() if n == capacity else packer.place(n), doc, k, start, n))
                if rows:
                    yield batch_of(profile, capacity, rows)
        for (profile, capacity), packer in zip(todo, packers):
            if packer.windows:
                yield batch_of(profile, capacity, [(at, None, STILL_OPEN, 0, capacity - room) for room, at in packer.windows])

    placed = materialize(items.select(F.col("doc_id").cast("long"), F.col("tokens").cast("int")).mapInArrow(first, ITEMS))
    moved = _merge_rounds(placed, open_windows, fan_in)
    return placed.where(F.col("piece") != STILL_OPEN).join(checked_broadcast(moved), ["profile", "part", "window"], "left").select(
        "profile", F.coalesce("container", F.concat_ws("-", F.lit("p"), "part", "window")).alias("container"), "doc_id", "piece", "start_token", "tokens"
    )


def _merge_rounds(placed: DataFrame, open_windows: int, fan_in: int) -> DataFrame:
    """profile, part, window, container of the windows that were open at the end of a partition. The packer says what they hold."""
    loose = placed.where(F.col("piece") == STILL_OPEN)
    units = loose.select("profile", "capacity", F.col("part").alias("group"), F.concat_ws("-", "part", "window").alias("unit"), F.col("tokens").alias("fill"))
    moved = loose.select("profile", "part", "window", F.concat_ws("-", "part", "window").alias("container"))
    groups, turn = (loose.agg(F.max("part")).first()[0] or 0) + 1, 0

    def again(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values(["fill", "unit"], ascending=[False, True])
        capacity = int(pdf["capacity"].iloc[0])
        packer = BoundedPacker(capacity, max(1, len(pdf)))
        to = [packer.place(int(n)) for n in pdf["fill"]]
        room = {at: r for r, at in packer.windows[-open_windows:]}  # the emptiest go on
        names = [f"m{turn}-{int(key[1])}-{t}" for t in to]
        return pd.DataFrame({"profile": pdf["profile"], "capacity": capacity, "group": int(key[1]), "unit": pdf["unit"], "container": names, "fill": [capacity - room.get(t, 0) for t in to], "goes_on": [t in room for t in to]})

    while True:
        turn += 1
        packed = materialize(
            units.withColumn("group", F.floor(F.col("group") / fan_in)).groupBy("profile", "group")
            .applyInPandas(again, "profile string, capacity int, group long, unit string, container string, fill int, goes_on boolean")
        )
        names = packed.select("profile", F.col("unit").alias("_unit"), F.col("container").alias("_to"))
        same = (F.col("m.profile") == F.col("n.profile")) & (F.col("m.container") == F.col("n._unit"))
        moved = moved.alias("m").join(names.alias("n"), same, "left").select("m.profile", "part", "window", F.coalesce("_to", "m.container").alias("container"))
        groups = -(-groups // fan_in)
        if groups <= 1:
            return materialize(moved)
        units = packed.where("goes_on").select("profile", "capacity", "group", F.col("container").alias("unit"), "fill").distinct()


def pack_documents(documents: DataFrame, profiles: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """``pack`` over ``documents.text``, sized by byte_bpe_50k, into ``profiles.max_seq_length`` (a few rows)."""
    count = token_counter(documents, tokenizers)
    rows = profiles.select("profile", "max_seq_length").where("profile is not null").distinct().orderBy("profile").limit(MOST_PROFILES + 1).collect()
    if len(rows) > MOST_PROFILES:
        raise ValueError(f"more than {MOST_PROFILES} profiles")
    return pack(documents.select("doc_id", count(F.col("text")).alias("tokens")), [(r[0], r[1]) for r in rows])


def fill_report(packed: DataFrame, profiles: DataFrame) -> DataFrame:
    """Containers, tokens and share of unused room of each profile."""
    per = packed.groupBy("profile", "container").agg(F.sum("tokens").alias("tokens")).groupBy("profile").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"))
    return per.join(profiles.select("profile", "max_seq_length"), "profile").select(
        "profile", "containers", "tokens", F.round(1 - F.col("tokens") / (F.col("containers") * F.col("max_seq_length")), 6).alias("unused")
    )
