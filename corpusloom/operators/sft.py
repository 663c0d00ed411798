"""Chat examples and codec frames as array expressions: validation, label masks, framing, slot layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The label that keeps a token out of the loss.
IGNORED = -100
# The special ids around text and speech, and the layout of codec codes (7 slots a frame, 4096 codes a slot).
END_OF_TEXT, TOKENISER_LENGTH = 128009, 128256
START_OF_SPEECH, END_OF_SPEECH, START_OF_HUMAN, END_OF_HUMAN, START_OF_AI, END_OF_AI = (TOKENISER_LENGTH + i for i in range(1, 7))
CODE_BASE, SLOTS, CODES = 128266, 7, 4096
MESSAGES = "array<struct<role:string,content:string>>"


def chat_messages(text: Column) -> Column:
    """The messages of a JSON chat record; null if it is no such record."""
    return F.from_json(text, "messages " + MESSAGES, {"mode": "PERMISSIVE"})["messages"]


def chat_problem(messages: Column) -> Column:
    """V1: why a chat record is unusable, null if it is good: no messages, a message without string role and content, or
    a last message that is not the assistant's."""
    broken = F.exists(messages, lambda m: m.isNull() | m["role"].isNull() | m["content"].isNull())
    return (
        F.when(messages.isNull() | (F.size(messages) == 0), "no messages").when(broken, "not text").when(F.element_at(messages, -1)["role"] != "assistant", "last role").otherwise(F.lit(None).cast("string"))
    )


def masked_labels(spans: Column) -> Column:
    """Labels of spans (role, ids): ids of the assistant's spans, IGNORED for each of the others."""
    return F.flatten(F.transform(spans, lambda s: F.when(s["role"] == "assistant", s["ids"]).otherwise(F.array_repeat(F.lit(IGNORED), F.size(s["ids"])))))


def encode_chat(spans: Column, most: int) -> Column:
    """Struct of input_ids, labels, attention_mask; a row error for an over-long or all-masked conversation."""
    ids, labels = F.flatten(F.transform(spans, lambda s: s["ids"])), masked_labels(spans)
    long = F.assert_true(F.size(ids) <= most, F.lit(f"conversation is longer than {most} tokens"))
    masked = F.assert_true(F.exists(labels, lambda x: x != IGNORED), F.lit("no assistant tokens to learn from"))
    out = F.struct(ids.alias("input_ids"), labels.alias("labels"), F.transform(ids, lambda _: F.lit(1)).alias("attention_mask"))
    return F.when(long.isNull() & masked.isNull(), out)


def prefix_monotonic(prefixes: Column) -> Column:
    """Whether each rendered prefix (an array of id arrays) begins with the one before it."""
    pairs = F.sequence(F.lit(2), F.size(prefixes))
    ok = F.forall(pairs, lambda i: F.slice(F.element_at(prefixes, i), 1, F.size(F.element_at(prefixes, i - 1))) == F.element_at(prefixes, i - 1))
    return F.when(F.size(prefixes) < 2, True).otherwise(ok)


def spans_from_prefixes(prefixes: Column) -> Column:
    """The ids each message adds to the prefix before it."""
    return F.transform(prefixes, lambda p, i: F.slice(p, F.when(i == 0, 1).otherwise(F.size(F.get(prefixes, i - 1)) + 1), F.size(p)))


def token_account(labels: Column) -> tuple[Column, Column]:
    """(supervised, all) tokens of a label array."""
    return F.size(F.filter(labels, lambda x: x != IGNORED)), F.size(labels)


def framed_prompt(text_ids: Column, codes: Column) -> tuple[Column, Column]:
    """(input_ids, labels): human turn with the text, AI turn with the speech; the prompt is masked."""
    lit = lambda *xs: F.array(*(F.lit(x) for x in xs))
    prompt = F.concat(lit(START_OF_HUMAN), text_ids, lit(END_OF_TEXT, END_OF_HUMAN, START_OF_AI, START_OF_SPEECH))
    answer = F.concat(codes, lit(END_OF_SPEECH, END_OF_AI))
    return F.concat(prompt, answer), F.concat(F.array_repeat(F.lit(IGNORED), F.size(prompt)), answer)


#: Of each slot of a frame: which codebook, and which of the codebook's codes of this frame.
FRAME = ((0, 0), (1, 0), (2, 0), (2, 1), (1, 1), (2, 2), (2, 3))


def interleave(books: list[Column]) -> Column:
    """Three codebooks (1, 2 and 4 codes a frame) as one stream of 7 ids a frame, each slot in its own id range."""
    rate = (1, 2, 4)
    slot = lambda i, s: F.get(books[FRAME[s][0]], i * rate[FRAME[s][0]] + FRAME[s][1]) + CODE_BASE + s * CODES
    frames = F.transform(F.sequence(F.lit(0), F.size(books[0]) - 1), lambda i: F.array(*(slot(i, s) for s in range(SLOTS))))
    return F.when(F.size(books[0]) > 0, F.flatten(frames)).otherwise(F.array().cast("array<int>"))


def in_slots(ids: Column) -> Column:
    """Whether a stream is whole frames with every id in the range of its slot."""
    return (F.size(ids) % SLOTS == 0) & F.forall(F.transform(ids, lambda x, i: F.floor((x - CODE_BASE) / CODES) == i % SLOTS), lambda ok: ok)


def deinterleave(ids: Column) -> list[Column]:
    """The three codebooks of a stream; null unless ``in_slots``."""
    out = []
    for book in range(3):
        keep = [s for s, (b, _) in enumerate(FRAME) if b == book]
        codes = F.transform(ids, lambda x, i: F.when((i % SLOTS).isin(keep), x - CODE_BASE - i % SLOTS * CODES))
        out.append(F.when(in_slots(ids), F.array_compact(codes)))
    return out


def without_repeated_frames(ids: Column) -> Column:
    """Frames whose first id equals that of the frame before are dropped; null for a stream of broken frames."""
    starts = F.filter(F.sequence(F.lit(0), F.floor(F.size(ids) / SLOTS).cast("int") - 1), lambda f: (f == 0) | (F.get(ids, f * SLOTS) != F.get(ids, (f - 1) * SLOTS)))
    kept = F.flatten(F.transform(starts, lambda f: F.slice(ids, f * SLOTS + 1, SLOTS)))
    return F.when(F.size(ids) % SLOTS != 0, None).when(F.size(ids) == 0, ids).otherwise(kept)


def steps(epochs: Column, rows: Column, batch: Column) -> Column:
    """E5: optimiser steps of a run."""
    return F.floor(epochs * rows / batch)


def task_slice(tables: list[DataFrame], task: str, key: str, seed: int = 3407) -> DataFrame:
    """Rows of one task from several tables, without their provenance column, in hash order (``position``)."""
    rows = None
    for df in tables:
        part = df.where(F.col("task").startswith(task)).drop("task", "provenance")
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows.withColumn("position", F.xxhash64(F.col(key), F.lit(seed)))
