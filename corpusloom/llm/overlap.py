"""Same or near-same records across splits: a partitioned suffix array finds shared spans, an exact word edit distance decides.

Of two word sequences the longer of which has L words, at most k = floor(L / 5) words may be changed, added or dropped.
An edit breaks at most one of k + 1 disjoint spans of either text, so one span or more stands in the other text as it
is, and begins there at a suffix. One side of the split, the one with fewer words, gives all its suffixes; they are
sorted by their leading words into a suffix array, which is cut into ranges of like size. Each text of the other side
gives the k + 1 suffixes that must suffice (``seekers``), each with the number of words that count; a seeker takes its
place in every range its prefix reaches, and its neighbours of the opposite split are those with a common prefix of
that many words. The spans of a pair are merged into the words they cover, and the exact distance is the last word.

Which spans a text contributes is free, any choice finds every partner: a dynamic program takes those that are rarest
together, so that lines which stand in thousands of texts are met only where a text has nothing else. No link is lost,
nothing is capped, and the entries of a text grow with its length alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.lookalike import canonical
from corpusloom.session import checked_broadcast, materialize, written

MIN_WORDS = 8
#: At most a fifth of the words of the longer text may differ.
PER = 5
#: A text may have a partner longer than itself; the most words that may differ then are a quarter of its own.
PER_LONGER = 4
#: Words of a span; with at least 2, floor(n / 4) + 1 disjoint ones fit into any text of 8 words or more.
SPANS = (2, 3, 4, 5)
#: Words a task takes together to choose spans by their counts; it changes no result.
TOGETHER = 2_500_000
#: Words of a longer text that are taken at once; a multiple of PER and PER_LONGER.
BLOCK = 500
#: Suffixes in a range of the array, seekers held against it by one task, and pairs looked at at once; they change no result.
RANGE, SEEKERS, PAIRS = 1_000_000, 2_000_000, 2_000_000
#: Keys looked at for each edge between two ranges.
SAMPLE = 400

# A suffix as a number, in the order of its leading words: codes of five words and the length of its text.
_BITS = (15, 14, 12, 8, 6)
_AT = (48, 34, 22, 14, 8)
_LENGTH = 255

_word = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")

_BLANKS = {i: " " for i in range(128) if not chr(i).isalnum()}


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits with an apostrophe inside; letter case, punctuation and look-alike spellings aside."""
    if not text:
        return []
    if text.isascii():
        if "'" not in text:
            return text.lower().translate(_BLANKS).split()
    else:
        text = canonical(text).replace("’", "'")
    return _word.findall(text.casefold())


def edit_distance(a: list, b: list, most: int) -> int:
    """Word edit distance of two sequences (bit-parallel, any length); a value above ``most`` only says so."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    if a == b:
        return 0
    m = len(b)
    if not m:
        return len(a)
    at: dict = {}
    for i, w in enumerate(b):
        at[w] = at.get(w, 0) | 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, left = mask, 0, m, len(a)
    for w in a:
        eq = at.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        left -= 1
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        if score - left > most:
            return most + 1
        ph = (ph << 1 | 1) & mask
        mh = mh << 1 & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
    return score


def allowed(n: int, m: int) -> int:
    return max(n, m) // PER


def near(a: list, b: list) -> bool:
    k = allowed(len(a), len(b))
    return edit_distance(a, b, k) <= k


# A text of the index: n words, a 128-bit hash of them, the words as 24-bit codes.
INDEX = "id long, train boolean, n int, h1 long, h2 long, codes binary"


def index(texts: DataFrame) -> DataFrame:
    """The index of (id, train, text): one row for each text of MIN_WORDS words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        class Codes(dict):
            def __missing__(self, w: str) -> bytes:
                if len(self) > 300_000:
                    self.clear()
                h = self[w] = xxhash.xxh32_digest(w)[:3]
                return h

        code = Codes().__getitem__
        for batch in batches:
            kept, codes, hashes = [], [], []
            for i, t in enumerate(batch.column(2).to_pylist()):
                ws = words_of(t)
                if len(ws) >= MIN_WORDS:
                    kept.append(i)
                    codes.append(b"".join(map(code, ws)))
                    hashes.append(xxhash.xxh3_128_digest(" ".join(ws)))
            n = pa.array([len(c) // 3 for c in codes], pa.int32())
            h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), n, pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(codes, pa.binary())], names=["id", "train", "n", "h1", "h2", "codes"]
            )

    return texts.select("id", "train", "text").mapInArrow(run, INDEX)


def span_hash(x, w: int):
    """A 64-bit hash of the ``w`` words from each place on; places without so many words hold what must not be used."""
    import numpy as np

    h = np.full(len(x), w, np.uint64)
    for j in range(w):
        y = np.zeros(len(x), np.uint32)
        y[: len(x) - j] = x[j:]
        h = (h ^ y) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
    return h * np.uint64(0x9FB21C651E98DF25)


def span_costs(x) -> dict:
    """For each length of a span the cost of the one that begins at each word: how often it stands in these texts, on
    ties how often its words do. Counted by hash in a table with four places a word; a shared place only costs more."""
    import numpy as np

    bits = max(10, (4 * len(x) - 1).bit_length())
    words = x & np.uint32((1 << 20) - 1)
    logp = np.log2(np.bincount(words)[words] / len(x))
    cost = {}
    for w in SPANS:
        slot = (span_hash(x, w) >> np.uint64(64 - bits)).astype(np.int64)
        lp = sum(np.concatenate((logp[j:], np.zeros(j))) for j in range(w))
        cost[w] = np.bincount(slot)[slot] + np.clip(1 + lp / 160, 0, 1)
    return cost


def choose_spans(cost, n, start, per: int = PER):
    """(place, length, spans per text): for each text of n words floor(n / per) + 1 disjoint spans that cost least together.

    A dynamic program over the words runs for texts of like length at once: least cost of j spans within the first i
    words. A text of over BLOCK words is taken in blocks, so that time and memory grow with its length only."""
    import numpy as np

    many = n // per + 1
    place, length = np.zeros(int(many.sum()), np.int64), np.zeros(int(many.sum()), np.int64)
    first = np.concatenate(([0], np.cumsum(many)[:-1])).astype(np.int64)
    # Blocks: words, where they begin, spans, where those go, words of the text before the block.
    least = MIN_WORDS  # words the last block of a text keeps at least
    long, short = np.flatnonzero(n >= BLOCK + least), np.flatnonzero(n < BLOCK + least)
    blocks = [(n[short], start[short], many[short], first[short], np.zeros(len(short), np.int64))]
    for i in long:
        m = int((n[i] - least) // BLOCK)
        at = BLOCK * np.arange(m + 1)
        size = np.append(np.full(m, BLOCK), n[i] - BLOCK * m)
        k = np.append(np.full(m, BLOCK // per), many[i] - BLOCK // per * m)
        blocks.append((size, start[i] + at, k, first[i] + BLOCK // per * np.arange(m + 1), at))
    size, begin, k, goes, before = (np.concatenate(c) for c in zip(*blocks))
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        take = max(1, min(512, 2_000_000 // int(size[order[min(at + 511, len(order) - 1)]] ** 2 // per + 1)))
        part = order[at : at + take]
        at += take
        _choose(cost, size[part], begin[part], k[part], goes[part], before[part], place, length)
    return place, length, many


def _choose(cost, n, start, k, first, before, place, length) -> None:
    import numpy as np

    most, t = int(n.max()), len(n)
    here = np.arange(most)[None, :]
    where = np.minimum(start[:, None] + here, len(next(iter(cost.values()))) - 1)
    never = 1e15
    costs = {w: np.where(here + w <= n[:, None], c[where], never) for w, c in cost.items()}
    least, steps = np.zeros((t, most + 1)), []
    for _ in range(int(k.max())):
        best, taken = np.full((t, most + 1), 4 * never), np.zeros((t, most + 1), np.int8)
        for w, c in costs.items():
            value = least[:, : most - w + 1] + c[:, : most - w + 1]
            better = value < best[:, w:]
            np.copyto(best[:, w:], value, where=better)
            np.copyto(taken[:, w:], np.int8(w), where=better)
        least = np.minimum.accumulate(best, axis=1)
        # Where the least is reached: the last span ends at the nearest such place on the left.
        steps.append((taken, np.maximum.accumulate(np.where(best <= least, np.arange(most + 1)[None, :], 0), axis=1)))
    i, rows = n.copy(), np.arange(t)
    for j in range(len(steps) - 1, -1, -1):
        on = k > j
        taken, reached = steps[j]
        end = reached[rows, i]
        w = taken[rows, end]
        i = np.where(on, end - w, i)
        place[first[on] + j], length[first[on] + j] = (before + end - w)[on], w[on]


def suffix_keys(x, n, start):
    """The number of each suffix: ordered by its first five words; 0 stands for words behind the end of the text."""
    import numpy as np

    owner = np.repeat(np.arange(len(n)), n)
    left = (start + n)[owner] - np.arange(len(x))
    key = np.minimum(n, _LENGTH)[owner].astype(np.int64)
    for j, (bits, at) in enumerate(zip(_BITS, _AT)):
        y = np.zeros(len(x), np.int64)
        y[: len(x) - j] = x[j:]
        code = 1 + ((y ^ y >> (9 - 2 * j)) % ((1 << bits) - 1))
        key |= np.where(left > j, code, 0) << at
    return key


def reach(key, w, n, least):
    """(lo, hi): the keys that share the first w words of ``key``; with five words, only those of texts of a length that can match."""
    import numpy as np

    low = np.array((0, *_AT), np.int64)[w]
    lo = key >> low << low
    hi = lo | (np.int64(1) << low) - 1
    five = w == len(_AT)
    short = np.where(least > 0, PER * least, n - n // PER)
    long = np.where(least > 0, PER * (n // PER_LONGER) + n % PER_LONGER, PER * (n // PER) + PER - 1)
    return np.where(five, lo + np.minimum(short, _LENGTH), lo), np.where(five, lo + np.minimum(long, _LENGTH), hi)


def seekers(x, n, start):
    """(text, place, length, least) of the suffixes that must suffice to find every partner of each text of n words.

    Partners no longer than the text, or of the same bound k = floor(n / 5), are found by k + 1 spans (least = 0).
    For longer ones the bound is up to floor(n / 4): of that many spans and one more, the i-th cheapest is needed only
    for partners whose bound is at least i, which is what ``least`` says."""
    import numpy as np

    cost = span_costs(x)
    place, length, many = choose_spans(cost, n, start)
    text = np.repeat(np.arange(len(n)), many)
    grows = np.flatnonzero(n // PER_LONGER > n // PER)
    p, w, m = choose_spans(cost, n[grows], start[grows], PER_LONGER)
    t = np.repeat(grows, m)
    price = np.zeros(len(p))
    for s in SPANS:
        mine = np.flatnonzero(w == s)
        price[mine] = cost[s][start[t[mine]] + p[mine]]
    order = np.lexsort((price, t))
    rank = np.empty(len(p), np.int64)
    rank[order] = np.arange(len(p)) - np.repeat(np.cumsum(m) - m, m)
    return np.concatenate((text, t)), np.concatenate((place, p)), np.concatenate((length, w)), np.concatenate((np.zeros(len(text), np.int64), np.maximum(rank, n[t] // PER + 1)))


def _words(batch: pa.RecordBatch, codes: int, n: int):
    """(n, start, word codes) of the texts of a batch of the index."""
    import numpy as np

    size = batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64)
    short = np.frombuffer(b"".join(batch.column(codes).to_pylist()), np.uint8).reshape(-1, 3)
    x = np.pad(short, ((0, 0), (0, 1))).view(np.uint32).ravel()
    return size, np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64), x


_COLUMNS = ("<i8", "<i8", "<u4", "<u4", "<u4")


def _pack(*columns) -> bytes:
    """Sorted keys as differences, then the other columns, byte planes apart, compressed."""
    import numpy as np
    import zstandard

    key = columns[0]
    planes = []
    for c, kind in zip((np.diff(key, prepend=0), *columns[1:]), _COLUMNS):
        planes.append(np.ascontiguousarray(c.astype(kind).view(np.uint8).reshape(len(key), -1).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(raw: bytes):
    import numpy as np
    import zstandard

    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    rows, at, out = len(data) // 28, 0, []
    for kind in _COLUMNS:
        width = int(kind[2])
        out.append(np.ascontiguousarray(data[at : at + rows * width].reshape(width, rows).T).view(kind).ravel())
        at += rows * width
    return [np.cumsum(out[0]), *out[1:]]


def _spread(value, ways):
    """A number below ``ways`` from each id."""
    import numpy as np

    h = value.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.maximum(ways, 1).astype(np.uint64)).astype(np.int64)


ENTRY = "part int, kind int, block binary"


def _entries(array_train: bool, held):
    """A mapInArrow function over (id, train, n, codes): blocks of entries for each part of the array.

    kind 0: suffixes of the side that gives them all; kind 1: seekers of the other. ``held`` is a broadcast of (edges
    between ranges, parts of each range); a range in several parts has its suffixes in each of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        edges, parts = held.value
        offset = np.concatenate(([0], np.cumsum(parts)))

        def blocks(part, kind: int, *columns):
            order = np.lexsort((columns[0], part))
            part, columns = part[order], [c[order] for c in columns]
            cut = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            out = [(int(part[a]), kind, _pack(*(c[a:b] for c in columns))) for a, b in zip(cut[:-1], cut[1:])]
            cols = list(zip(*out)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int32(), pa.binary()))], names=["part", "kind", "block"])

        def repeated(first, last):
            """Each row once for each number from first to last: (row, number)."""
            times = last - first + 1
            row = np.repeat(np.arange(len(first)), times)
            return row, first[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)

        def emit(table: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            batch = pa.Table.from_batches(table).combine_chunks().to_batches()[0]
            side = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for kind, mine in ((0, side == array_train), (1, side != array_train)):
                at = np.flatnonzero(mine)
                if not len(at):
                    continue
                own = batch.take(pa.array(at))
                ident = own.column(0).to_numpy(zero_copy_only=False)
                n, start, x = _words(own, 3, 2)
                keys = suffix_keys(x, n, start)
                if kind == 0:
                    text = np.repeat(np.arange(len(n)), n)
                    lo, hi = np.searchsorted(edges, keys, "left"), np.searchsorted(edges, keys, "right")
                    where = lo + _spread(ident[text], hi - lo + 1)  # a key that fills whole ranges is spread over them
                    row, part = repeated(offset[where], offset[where + 1] - 1)
                    yield blocks(part, 0, keys[row], ident[text[row]], n[text[row]], (np.arange(len(x)) - start[text])[row], np.zeros(len(row), np.int64))
                else:
                    text, place, length, least = seekers(x, n, start)
                    key = keys[start[text] + place]
                    lo, hi = reach(key, length, n[text], least)
                    row, where = repeated(np.searchsorted(edges, lo, "left"), np.searchsorted(edges, hi, "right"))
                    part = offset[where] + _spread(ident[text[row]], parts[where])
                    yield blocks(part, 1, key[row], ident[text[row]], n[text[row]], place[row], (length | least << 3)[row])

        waiting: list[pa.RecordBatch] = []
        words = 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                words += batch.column(3).nbytes // 3
            if words >= TOGETHER:
                yield from emit(waiting)
                waiting, words = [], 0
        if waiting:
            yield from emit(waiting)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The seekers of a part against its suffixes: (a, s, place, words), a neighbour of the opposite split with a common prefix.

    Blocks come by part, suffixes first; of the suffixes one part is held, seekers go by in blocks."""
    import numpy as np

    part, kind, held = None, 0, []
    array: list = []

    def pairs(block) -> Iterator[pa.RecordBatch]:
        keys, ids, sizes, places = array
        key, ident, n, place, rest = _unpack(block)
        n, place, rest = (c.astype(np.int64) for c in (n, place, rest))
        length, least = rest & 7, rest >> 3
        lo, hi = reach(key, length, n, least)
        a, b = np.searchsorted(keys, lo, "left"), np.searchsorted(keys, hi, "right")
        some = np.flatnonzero(b > a)
        upto = np.cumsum(b[some] - a[some])
        at = 0
        while at < len(some):
            done = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
            mine = some[at:end]
            at = end
            times = b[mine] - a[mine]
            s = np.repeat(mine, times)
            o = a[s] + np.arange(len(s)) - np.repeat(np.cumsum(times) - times, times)
            m, d, short = sizes[o], places[o] - place[s], n[s]
            bound = np.where(least[s] > 0, m // PER >= least[s], m // PER <= short // PER)
            # Words dropped and added before the span and after it are edits already.
            ok = bound & (np.abs(d) + np.abs(m - short - d) <= np.maximum(m, short) // PER)
            s, o = s[ok], o[ok]
            order = np.lexsort((ids[o], s))
            s, o = s[order], ids[o[order]]
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
            s, o = s[new], o[new]
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(o), pa.array(ident[s]), pa.array(place[s].astype(np.int32)), pa.array(length[s].astype(np.int32))], names=["a", "s", "place", "words"])

    for batch in batches:
        for p, k, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if p != part:
                part, kind, held, array = p, 0, [], []
            if k == 0:
                held.append(_unpack(block))
                continue
            if held:
                columns = [np.concatenate(c) for c in zip(*held)]
                order = np.argsort(columns[0], kind="stable")
                array = [columns[0][order], columns[1][order], columns[2][order].astype(np.int64), columns[3][order].astype(np.int64)]
                held = []
            if array:
                yield from pairs(block)


def _sampled_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key) of every suffix of (n, codes)."""
    for batch in batches:
        if batch.num_rows:
            n, start, x = _words(batch, 1, 0)
            yield pa.RecordBatch.from_arrays([pa.array(suffix_keys(x, n, start))], names=["key"])


def _cut(indexed: DataFrame, array_train: bool, suffixes: int, others: int):
    """(edges, parts): keys that cut the suffix array into ranges of like size, and into how many parts the seekers of
    each range go. Edges come from a sample of texts, whose size grows with the ranges; they change no result."""
    import numpy as np

    cores = indexed.sparkSession.sparkContext.defaultParallelism
    ranges = max(cores, -(-suffixes // RANGE))

    def sample(train: bool, share: float) -> DataFrame:
        few = indexed.where(F.col("train") == F.lit(train)).where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)))
        return few.select("n", "codes").mapInArrow(_sampled_keys, "key long")

    points = [float(i / ranges) for i in range(1, ranges)]
    at = F.percentile_approx("key", points, max(10_000, 20 * ranges))
    # Of a few long texts the sample may hold none; then all are looked at.
    found = (sample(array_train, SAMPLE * ranges / suffixes).agg(at).first()[0] or sample(array_train, 1.0).agg(at).first()[0]) if points else []
    edges = np.array(found, np.int64)
    seen = np.zeros(ranges, np.int64)
    if others > SEEKERS:
        held = indexed.sparkSession.sparkContext.broadcast(edges)

        def ranges_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, many = np.unique(np.searchsorted(held.value, batch.column(0).to_numpy(), "left"), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(many.astype(np.int64))], names=["range", "n"])

        for r in sample(not array_train, SAMPLE * ranges / others).mapInArrow(ranges_of, "range int, n long").groupBy("range").agg(F.sum("n").alias("n")).collect():  # a row per range
            seen[r["range"]] = r["n"]
    # A text has a seeker for every other word at most.
    parts = np.maximum(1, -(-seen * others // (2 * SEEKERS * max(1, int(seen.sum())))))
    return edges, parts


def candidates(indexed: DataFrame) -> DataFrame:
    """(q, t, covered): each pair of opposite splits that shares a span where a near-copy must share one; covered: words of
    one text within the spans it shares, merged. ``indexed`` should be written: it is read several times."""
    words = {r["train"]: r["w"] for r in indexed.groupBy("train").agg(F.sum("n").alias("w")).collect()}  # two rows
    spark = indexed.sparkSession
    if len(words) < 2:
        return spark.createDataFrame([], "q long, t long, covered long")
    array_train = words[True] < words[False]
    edges, parts = _cut(indexed, array_train, words[array_train], words[not array_train])
    held = spark.sparkContext.broadcast((edges, parts))
    blocks = indexed.select("id", "train", "n", "codes").mapInArrow(_entries(array_train, held), ENTRY)
    met = blocks.repartitionById(int(parts.sum()), "part").sortWithinPartitions("part", "kind").mapInArrow(_meet, "a long, s long, place int, words int")
    q, t = ("s", "a") if array_train else ("a", "s")
    spans = met.groupBy(F.col(q).alias("q"), F.col(t).alias("t")).agg(F.collect_set(F.struct("place", "words")).alias("spans"))  # of a text, so bounded by its words
    return spans.select("q", "t", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"]).alias("covered"))


def _involved(pairs: DataFrame, side: str, df: DataFrame) -> DataFrame:
    """Only rows in a pair travel, if their ids are few enough to be broadcast."""
    return df.join(checked_broadcast(pairs.select(F.col(side).alias("id")).distinct()), "id", "left_semi")


def alike(pairs: DataFrame, indexed: DataFrame) -> DataFrame:
    """The pairs whose word codes are within the bound: equal words have equal codes, so no near-copy is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memo: dict[bytes, tuple] = {}
            keep = []

            def read(raw: bytes) -> tuple:
                got = memo.get(raw)
                if got is None:
                    words = [raw[i : i + 3] for i in range(0, len(raw), 3)]
                    got = memo[raw] = (words, frozenset(words))
                return got

            for i, (a, b) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                (u, us), (v, vs) = read(a), read(b)
                k = allowed(len(u), len(v))
                # Each different word of one text that is not in the other costs an edit.
                keep.append(max(len(us - vs), len(vs - us)) <= k and edit_distance(u, v, k) <= k)
            yield batch.select([0, 1, 2]).filter(pa.array(keep, pa.bool_()))

    q = _involved(pairs, "q", indexed.where(~F.col("train")).select("id", "codes")).select(F.col("id").alias("q"), F.col("codes").alias("a"))
    t = _involved(pairs, "t", indexed.where("train").select("id", "codes")).select(F.col("id").alias("t"), F.col("codes").alias("b"))
    return pairs.join(q, "q").join(t, "t").select("q", "t", "covered", "a", "b").mapInArrow(run, "q long, t long, covered long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (q, t, covered) that are near-copies by the exact distance of their words, with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            memo: dict[str, list[str]] = {}
            out = []
            for i, j, c, x, y in zip(*(batch.column(i).to_pylist() for i in range(5))):
                u = memo.get(x)
                if u is None:
                    u = memo[x] = words_of(x)
                v = memo.get(y)
                if v is None:
                    v = memo[y] = words_of(y)
                k = allowed(len(u), len(v))
                if (d := edit_distance(u, v, k)) <= k:
                    out.append((i, j, d, len(u), len(v), c))
            cols = list(zip(*out)) or [()] * 6
            names = ["q", "t", "distance", "q_words", "t_words", "covered"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), *[pa.int32()] * 4))], names=names)

    a = _involved(pairs, "q", texts).select(F.col("id").alias("q"), F.col("text").alias("a"))
    b = _involved(pairs, "t", texts).select(F.col("id").alias("t"), F.col("text").alias("b"))
    schema = "q long, t long, distance int, q_words int, t_words int, covered int"
    return pairs.join(a, "q").join(b, "t").select("q", "t", "covered", "a", "b").mapInArrow(run, schema)


def _texts(clips: DataFrame) -> DataFrame:
    """id, train, text of the rows that can be in a pair: split and text known, long enough for MIN_WORDS words."""
    known = clips.where(F.col("split").isNotNull() & F.col("text").isNotNull() & F.col("clip_id").isNotNull())
    return known.select(F.col("clip_id").cast("long").alias("id"), (F.col("split") == "train").alias("train"), "text").where(F.length("text") >= 2 * MIN_WORDS - 1)


def copies(indexed: DataFrame) -> DataFrame:
    """(id, rep, train) of the texts of one side with the same words; rep is the least id. Groups of one are left out."""
    keys = ["train", "n", "h1", "h2"]
    slim = indexed.select(*keys, "id")
    groups = slim.groupBy(*keys).agg(F.min("id").alias("rep"), F.count("*").alias("m")).where("m > 1").drop("m")
    return materialize(slim.join(groups, keys).select("id", "rep", "train"))


def near_classes(clips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(close, members): close has q, t, distance, q_words, t_words, covered of each pair of texts (the least id of those
    with the same words on one side stands for all) that are near-copies; members has id, rep, train of the copies."""
    texts = _texts(clips)
    indexed = written(index(texts))
    members = copies(indexed)
    one = indexed.join(checked_broadcast(members.where("id <> rep").select("id")), "id", "left_anti")
    pairs = materialize(candidates(one))
    return materialize(verified(materialize(alike(pairs, one)), texts.select("id", "text"))), members


def near_copies(clips: DataFrame) -> DataFrame:
    """clip_id_q (not in train), clip_id_t (in train), distance, q_words, t_words, covered of every pair with exactly one
    clip in train whose word sequences, both of MIN_WORDS words or more, differ in at most a fifth of the longer.

    Rows with a null id, split or text and texts with fewer words are in no pair; speakers may differ; repeated rows
    count each. Texts with the same words on one side are looked at once and put back at the end, so a text that
    stands in a third of all rows costs no more than one; each place of it is in the result, as the statement wants.
    clip_id must be unique. Texts are read whole. An empty table gives no rows."""
    close, members = near_classes(clips)
    qs = checked_broadcast(members.where(~F.col("train")).select(F.col("rep").alias("q"), F.col("id").alias("clip_id_q")))
    ts = checked_broadcast(members.where("train").select(F.col("rep").alias("t"), F.col("id").alias("clip_id_t")))
    full = close.join(qs, "q", "left").join(ts, "t", "left")
    return full.select(F.coalesce("clip_id_q", "q").alias("clip_id_q"), F.coalesce("clip_id_t", "t").alias("clip_id_t"), "distance", "q_words", "t_words", "covered")


def found(clips: DataFrame) -> DataFrame:
    """clip_id_a < clip_id_b of each pair."""
    p = near_copies(clips)
    return p.select(F.least("clip_id_q", "clip_id_t").alias("clip_id_a"), F.greatest("clip_id_q", "clip_id_t").alias("clip_id_b"))


def report(clips: DataFrame) -> DataFrame:
    """split, speaker, clips, overlapping, exact, links, coverage: how much of each split and speaker also stands in train.

    Counted from classes of copies and their sizes, without a row per pair of copies. coverage: the mean share of the
    words of an overlapping record that the spans it shares with its best partner cover (all, if it has an equal one)."""
    close, members = near_classes(clips)
    sizes = members.where("train").groupBy(F.col("rep").alias("t")).agg(F.count("*").alias("copies"))
    share = F.when(F.col("distance") == 0, 1.0).otherwise(F.least(F.lit(1.0), F.col("covered") / F.least("q_words", "t_words")))
    per = close.join(sizes, "t", "left").groupBy("q").agg(F.sum(F.coalesce("copies", F.lit(1))).alias("links"), F.min("distance").alias("least"), F.max(share).alias("share"))
    others = members.where(~F.col("train")).where("id <> rep").select("id", F.col("rep").alias("q"))
    hit = per.select(F.col("q").alias("id"), "links", "least", "share").unionByName(others.join(per, "q").select("id", "links", "least", "share"))
    rows = clips.where("split <> 'train'").select(F.col("clip_id").cast("long").alias("id"), "split", "speaker").join(hit, "id", "left")
    return rows.groupBy("split", "speaker").agg(
        F.count("*").alias("clips"), F.count("links").alias("overlapping"), F.count_if(F.col("least") == 0).alias("exact"),
        F.coalesce(F.sum("links"), F.lit(0)).alias("links"), F.round(F.avg("share"), 6).alias("coverage"),
    )
