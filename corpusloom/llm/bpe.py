"""Byte-level BPE with a public vocabulary, by a segment tree over byte positions.

Each leaf of the tree holds the rank of the pair that starts at that position (a large number where no mergeable
pair starts), each inner node the least rank below it, the left one on ties. A merge takes the root's position,
joins it to its right neighbour in a linked list and renews at most three leaves, so a pretoken of n bytes costs
O(n log n) however long it is.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Default place of the public vocabularies.
TOKENIZERS = "/opt/tokenizers"

# Fixed value: the public pretoken pattern of the byte_bpe_50k vocabulary.
BYTE_BPE_50K = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Pretoken patterns by vocabulary; for another one the pattern must be given with its name.
PATTERNS = {"byte_bpe_50k": BYTE_BPE_50K}
#: A worker's memo of encoded pretokens is emptied at this size; it changes no result.
MEMO_LIMIT = 400_000
_NONE = 1 << 40


def read_ranks(path: str = TOKENIZERS, name: str = "byte_bpe_50k") -> bytes:
    """The rank file as bytes (under 1 MB, of a fixed size), for a broadcast."""
    with open(f"{path}/{name}.tiktoken", "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


def bpe_merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pretoken."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    end = list(range(1, n + 1))  # where the token that starts here ends
    before = list(range(-1, n - 1))  # the start of the token on the left
    width = 1
    while width < n:
        width *= 2
    tree = [_NONE] * (2 * width)
    get = ranks.get
    for i in range(n - 1):
        tree[width + i] = get(piece[i : i + 2], _NONE)
    for i in range(width - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a <= b else b

    def put(i: int, rank: int) -> None:
        i += width
        tree[i] = rank
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            least = a if a <= b else b
            if tree[i] == least:
                break
            tree[i] = least
            i >>= 1

    while tree[1] < _NONE:
        least, at = tree[1], 1
        while at < width:  # down to the leftmost leaf of this rank
            at *= 2
            if tree[at] != least:
                at += 1
        at -= width
        gone = end[at]
        stop = end[gone]
        end[at] = stop
        put(gone, _NONE)
        if stop < n:
            before[stop] = at
            put(at, get(piece[at : end[stop]], _NONE))
        else:
            put(at, _NONE)
        if (left := before[at]) >= 0:
            put(left, get(piece[left:stop], _NONE))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Encodes whole texts; remembers pretokens, as few distinct ones make up most of a corpus."""

    def __init__(self, raw: bytes, pattern: str = BYTE_BPE_50K):
        import regex

        self.ranks, self.find, self.memo = parse_ranks(raw), regex.compile(pattern).findall, {}

    def _miss(self, piece: str) -> list[int]:
        if len(self.memo) >= MEMO_LIMIT:
            self.memo.clear()
        ids = bpe_merge(piece.encode("utf-8", "surrogatepass"), self.ranks)
        if len(piece) <= 64:
            self.memo[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known, extend = self.memo.get, out.extend
        for piece in self.find(text):
            ids = known(piece)
            extend(ids if ids is not None else self._miss(piece))
        return out

    def count(self, text: str) -> int:
        n, known = 0, self.memo.get
        for piece in self.find(text):
            ids = known(piece)
            n += len(ids if ids is not None else self._miss(piece))
        return n


def pattern_of(name: str, pattern: str | None) -> str:
    if pattern is None and name not in PATTERNS:
        raise ValueError(f"the pretoken pattern of {name} must be given")
    return pattern or PATTERNS[name]


def encode_ids(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = TOKENIZERS, name: str = "byte_bpe_50k", pattern: str | None = None) -> DataFrame:
    """``key`` and ``ids`` (array<int>) of each row of ``df``, without special tokens; rows stay as they are, repeated ones too.

    A null text has null ids, an empty text the empty array; white space is text like any other. No shuffle; the
    text is read whole. Other columns of ``df`` are not read. A vocabulary other than byte_bpe_50k needs its ``pattern``.
    """
    split = pattern_of(name, pattern)
    raw = df.sparkSession.sparkContext.broadcast(read_ranks(path, name))
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(raw.value, split).encode
        for batch in batches:
            ids = [None if t is None else encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["key", "ids"])

    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", key)


def token_counter(df: DataFrame, path: str = TOKENIZERS, name: str = "byte_bpe_50k", pattern: str | None = None):
    """A Column function text -> number of tokens (0 for a null or empty text), as an Arrow UDF."""
    split = pattern_of(name, pattern)
    raw = df.sparkSession.sparkContext.broadcast(read_ranks(path, name))

    @F.arrow_udf("int")
    def count(texts: pa.Array) -> pa.Array:
        n = _encoder(raw.value, split).count
        return pa.array([n(t) if t else 0 for t in texts.to_pylist()], pa.int32())

    def apply(text: Column) -> Column:
        return count(text)

    return apply


_ENCODERS: dict[tuple[bytes, str], Encoder] = {}


def _encoder(raw: bytes, pattern: str) -> Encoder:
    if (raw, pattern) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[raw, pattern] = Encoder(raw, pattern)
    return _ENCODERS[raw, pattern]
