"""Improbable-feature digests: rare byte windows in chained Bloom filters, compared by their bits in common."""

from __future__ import annotations

import base64
import hashlib
import math
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 16             # bytes of a feature
SPAN = 16               # neighbouring windows that choose the rarest of them
POPULAR = 4             # a window is a feature when so many neighbourhoods choose it
LEAST_BITS = 2.0        # windows of lower entropy (of 4 bits at most) are never features
FILTER_BITS = 2_048
FILTER_FEATURES = 160   # then the next filter of the chain begins
BITS_OF_FEATURE = 5
NOISE = 3.0             # bits in common count from so many deviations above chance

CHUNK_CHARS = 500_000   # text digested together
SLICE = 1 << 20         # windows looked at together, so very long texts need little memory
RANGE_BYTES = 16 << 20  # text of one range of keys

# entropy of a window is 4 - weight / 1024 bits, the weight being the sum of 64 c log2 c over its bytes' counts c
_WEIGHT = np.array([0] + [round(64 * c * math.log2(c)) for c in range(1, WINDOW + 1)], np.int32)
WEIGHTS = int(_WEIGHT[WINDOW]) + 1
_HEAVIEST = int((math.log2(WINDOW) - LEAST_BITS) * 64 * WINDOW)
_NEVER = WEIGHTS


def window_weights(x: np.ndarray) -> np.ndarray:
    """The weight of every window of the bytes: low weight is high entropy.

    From one window to the next a byte leaves and a byte enters; how often they occur in the window follows from
    comparing the bytes with themselves at every distance.
    """
    n = len(x) - WINDOW + 1
    out, into = np.ones(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = x[:-d] == x[d:]
        out += same[:n]
        into[:-1] += same[WINDOW - d:WINDOW - d + n - 1]
    first = int(_WEIGHT[np.bincount(x[:WINDOW])].sum())
    step = _WEIGHT[into[:-1] + 1] - _WEIGHT[into[:-1]] - _WEIGHT[out[:-1]] + _WEIGHT[out[:-1] - 1]
    return np.cumsum(np.r_[first, step])


def _within(ends: np.ndarray, tail: int, lo: int, hi: int) -> np.ndarray:
    """Which places of lo..hi have at least ``tail`` bytes before the end of their text."""
    ok = np.ones(hi - lo, bool)
    for end in ends[(ends > lo) & (ends - tail < hi)].tolist():
        ok[max(end - tail + 1 - lo, 0):max(end - lo, 0)] = False
    return ok


def _slices(flat: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
    """Places in slices that have ``reach`` bytes from their last place on."""
    for lo in range(0, len(flat) - reach + 1, SLICE):
        yield lo, min(lo + SLICE, len(flat) - reach + 1)


def _flat(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw])


def weight_counts(raw: list[bytes]) -> np.ndarray:
    """How many windows of the texts have each weight."""
    flat, ends = _flat(raw)
    total = np.zeros(WEIGHTS, np.int64)
    for lo, hi in _slices(flat, WINDOW):
        weights = window_weights(flat[lo:hi + WINDOW - 1])
        total += np.bincount(weights[_within(ends, WINDOW, lo, hi)], minlength=WEIGHTS)
    return total


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each weight, the rarest first (ties: the higher entropy); windows of little entropy are never chosen."""
    ranks = np.empty(WEIGHTS, np.int64)
    ranks[np.lexsort((np.arange(WEIGHTS), counts))] = np.arange(WEIGHTS)
    ranks[_HEAVIEST + 1:] = _NEVER
    return ranks


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Digest:
    """Filters of a text, one row each, and the number of features in all of them."""

    __slots__ = ("filters", "n")

    def __init__(self, filters: np.ndarray, n: int):
        self.filters, self.n = filters, n

    def written(self) -> str:
        return f"{self.n:x}:" + base64.b64encode(self.filters.tobytes()).decode()

    @classmethod
    def read(cls, text: str) -> Digest:
        n, bits = text.split(":", 1)
        return cls(np.frombuffer(base64.b64decode(bits), np.uint8).reshape(-1, FILTER_BITS // 8), int(n, 16))

    def sizes(self) -> np.ndarray:
        """Features of each filter: all are full but the last."""
        k = len(self.filters)
        return np.minimum(self.n - FILTER_FEATURES * np.arange(k), FILTER_FEATURES)


def _contained(x: Digest, y: Digest) -> float:
    """Share of x's features found in y: for each filter of x, the best filter of y, weighted by features."""
    bits_x = np.bitwise_count(x.filters).sum(1, dtype=np.int64)
    bits_y = np.bitwise_count(y.filters).sum(1, dtype=np.int64)
    right = np.unpackbits(y.filters, axis=1).astype(np.float32).T
    best = np.zeros(len(bits_x))
    for i in range(0, len(bits_x), 512):
        left = bits_x[i:i + 512, None]
        common = np.unpackbits(x.filters[i:i + 512], axis=1).astype(np.float32) @ right
        chance = left * bits_y / FILTER_BITS
        noise = NOISE * np.sqrt(chance * (1 - left / FILTER_BITS) * (1 - bits_y / FILTER_BITS))
        share = np.where(common > chance + noise, (common - chance) / np.maximum(left - chance, 1e-9), 0)
        best[i:i + 512] = share.max(1)
    weight = x.sizes()
    return float(np.clip((best * weight).sum() / weight.sum(), 0, 1))


def likeness(x: Digest, y: Digest) -> float:
    """Normalised bits in common, 0 to 1: the share of the smaller digest's features that the other holds.

    Bits in common count beyond what chance gives filters so full, and only where they exceed it clearly.  Equal
    digests have 1; a digest without features (of an empty text) has 0 with any other.
    """
    if x.n == y.n and np.array_equal(x.filters, y.filters):
        return 1.0
    if not x.n or not y.n:
        return 0.0
    if x.n == y.n:
        return max(_contained(x, y), _contained(y, x))
    return _contained(x, y) if x.n < y.n else _contained(y, x)


class Digester:
    """Digests texts by ranks of window weights."""

    def __init__(self, ranks: np.ndarray):
        self.ranks = ranks

    def _votes(self, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each place, how many neighbourhoods choose the window that begins there (the leftmost of the rarest)."""
        votes = np.zeros(len(flat), np.uint8)
        reach = WINDOW + SPAN - 1
        for lo, hi in _slices(flat, reach):
            rank = self.ranks[window_weights(flat[lo:hi + reach - 1])]
            least = rank << 32 | np.arange(len(rank))
            for shift in (1, 2, 4, 8):
                least = np.minimum(least[:-shift], least[shift:])
            chosen = least[_within(ends, reach, lo, hi)]
            chosen = chosen[chosen >> 32 < _NEVER] & 0xFFFFFFFF
            votes[lo:lo + len(rank)] += np.bincount(chosen, minlength=len(rank)).astype(np.uint8)
        return votes

    def digest(self, texts: list[str]) -> list[Digest]:
        """A text's features are its windows that enough neighbourhoods choose, each once, in order.

        Where no window gets enough votes, those with most are taken; a text without any (short, or of little entropy)
        is one feature as a whole, an empty text has none.  A text's digest depends on nothing but the text and the
        ranks.
        """
        raw = [t.encode() for t in texts]
        flat, ends = _flat(raw)
        starts = ends - [len(r) for r in raw]
        votes = self._votes(flat, ends)
        hit = np.flatnonzero(votes)
        doc = np.searchsorted(ends, hit, "right")
        most = np.zeros(len(raw), np.int64)
        np.maximum.at(most, doc, votes[hit])
        enough = votes[hit] >= np.minimum(most, POPULAR)[doc]
        hit, doc = hit[enough], doc[enough]
        if len(hit):
            words = flat[hit[:, None] + np.arange(WINDOW)].view("<u8")
            features = _mixed(_mixed(words[:, 0]) + words[:, 1])
        else:
            features = np.zeros(0, np.uint64)
        alone = [i for i in range(len(raw)) if not most[i] and raw[i]]
        if alone:
            whole = [int.from_bytes(hashlib.blake2b(raw[i], digest_size=8).digest(), "little") for i in alone]
            features = np.r_[features, np.array(whole, np.uint64)]
            hit, doc = np.r_[hit, starts[alone]], np.r_[doc, alone]
        order = np.lexsort((hit, features, doc))            # repeated windows of a text: the first
        new = np.r_[True, (doc[order][1:] != doc[order][:-1]) | (features[order][1:] != features[order][:-1])] \
            if len(order) else np.zeros(0, bool)
        keep = np.sort(order[new])
        keep = keep[np.lexsort((hit[keep], doc[keep]))]
        features, doc = features[keep], doc[keep]

        count = np.bincount(doc, minlength=len(raw))
        filters = -(-count // FILTER_FEATURES)
        first_filter, first = np.cumsum(filters) - filters, np.cumsum(count) - count
        slot = first_filter[doc] + (np.arange(len(doc)) - first[doc]) // FILTER_FEATURES
        bits = np.zeros((int(filters.sum()), FILTER_BITS), bool)
        per = FILTER_BITS.bit_length() - 1
        for k in range(BITS_OF_FEATURE):
            bits[slot, ((features >> np.uint64(per * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits, axis=1)
        return [Digest(packed[f:f + k], n) for f, k, n in zip(first_filter.tolist(), filters.tolist(), count.tolist())]


def _chunks(texts: Iterator[str]) -> Iterator[list[str]]:
    chunk, size = [], 0
    for t in texts:
        chunk.append(t)
        size += len(t)
        if size >= CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def rarity(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Ranks of window weights by how often all windows of all texts have them; at most 4,097 sums reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WEIGHTS, np.int64)
        for batch in batches:
            for chunk in _chunks(v.as_py() or "" for v in batch.column(0)):
                total += weight_counts([t.encode() for t in chunk])
        weights = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(weights.astype(np.int32)), pa.array(total[weights])], ["weight", "n"])

    sums = docs.select(F.col(text).alias("text")).mapInArrow(run, "weight int, n long").groupBy("weight").agg(F.sum("n"))
    counts = np.zeros(WEIGHTS, np.int64)
    for weight, n in sums.collect():
        counts[weight] = n
    return ranks_of(counts)


def fingerprint(docs: DataFrame, ranks: np.ndarray, text: str = "text", target: str = "fingerprint") -> DataFrame:
    """Adds every whole text's digest: the number of features in hexadecimal, ``:``, the filters in base 64.

    Equal texts have equal digests; null counts as empty and gives ``0:``.  An existing column ``target`` is
    replaced.  No shuffle.
    """
    rest = docs.drop(target)
    shipped = rest.select("*", F.col(text).alias(target)) if text != target else docs.select(*rest.columns, target)
    digester = docs.sparkSession.sparkContext.broadcast(Digester(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for chunk in _chunks(v.as_py() or "" for v in batch.column(batch.num_columns - 1)):
                out = pa.array([d.written() for d in digester.value.digest(chunk)], pa.string())
                yield pa.RecordBatch.from_arrays([*(c.slice(at, len(out)) for c in batch.columns[:-1]), out],
                                                 batch.schema.names)
                at += len(out)

    return shipped.mapInArrow(run, shipped.schema)


# Documents come by descending key, nulls last; equal keys by a hash of the text.
Place = tuple[int, int, int]


def _place(key: int | None, text_hash: int) -> Place:
    return (1, 0, text_hash) if key is None else (0, -key, text_hash)


def _range_starts(slim: DataFrame, ranges: int) -> list[Place]:
    """The first place of each of about ``ranges`` equal ranges of the order."""
    dealt = slim.repartitionByRange(ranges, F.desc_nulls_last("doc_id"), F.asc("hash"))
    firsts = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.min(F.struct(
        F.col("doc_id").isNull().cast("int").alias("last"), F.negative("doc_id").alias("down"), "hash")).alias("first"))
    return sorted((r.first.last, r.first.down or 0, r.first.hash) for r in firsts.select("first").collect())


def with_next(docs: DataFrame, compare: Callable[[Iterator[tuple[int | None, str, str]]], Iterator[pa.RecordBatch]],
              schema: str, text: str = "text", key: str = "doc_id", *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``compare`` over every document's key, text and the text of the document after it, in descending order of keys.

    After the last comes the first; null keys (integers otherwise) come last, rows with equal keys by a hash of their
    text; a null text is empty.  The order is cut into ranges of equal numbers of rows, whose starts (one a
    ``range_bytes`` of text) are found on keys and hashes alone and sent to the tasks.  Each range is one run of a
    task's sorted rows; the first document of a range goes to the range before it too.  Texts are shuffled once.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0]
    slim = rows.select("doc_id", F.xxhash64("text").alias("hash"))
    ranges = max(8, -(-(size or 0) // range_bytes))
    starts = docs.sparkSession.sparkContext.broadcast(_range_starts(slim, ranges))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = starts.value
        for batch in batches:
            places = [_place(k, h) for k, h in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            part = [bisect_right(first, p) - 1 for p in places]
            heads = [i for i, p in enumerate(places) if first[part[i]] == p]
            for ids, at, after in (([*range(len(places))], part, False),
                                   (heads, [(part[i] - 1) % len(first) for i in heads], True)):
                if ids:
                    taken = batch.take(pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at, pa.int32()), pa.array([after] * len(ids)), *taken.columns],
                        ["part", "after", "doc_id", "text", "hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            held = None
            for batch in batches:
                for part, after, doc, body in zip(*(batch.column(c).to_pylist() for c in range(3)),
                                                  (v.as_py() for v in batch.column(3))):
                    if held and held[0] == part:
                        yield held[1], held[2], body
                    held = None if after else (part, doc, body)

        return compare(pairs())

    dealt = rows.select("doc_id", "text", F.xxhash64("text").alias("hash")).mapInArrow(
        deal, "part int, after boolean, doc_id long, text string, hash long")
    return dealt.repartition(int(ranges), "part").sortWithinPartitions(
        "part", "after", F.desc_nulls_last("doc_id"), "hash").drop("hash").mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many first characters of the other (or all it has)."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def edits_compared(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every document.

    Each text's digest beside that of its edited text (see ``edited``; the other is the document after it in
    descending order of keys) and of the document after it.  Rarity comes from all windows of all texts.  Null texts
    are empty; a single document follows itself; repeated rows are rows like any other.
    """
    digester = docs.sparkSession.sparkContext.broadcast(Digester(rarity(docs, text)))
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    names = [f.split()[0] for f in schema.split(", ")]

    def compared(chunk: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        changed = [edited(t, n) for _, t, n in chunk]
        # a document's next is mostly the next row of the chunk
        loose = [i for i, (_, _, n) in enumerate(chunk) if i + 1 == len(chunk) or chunk[i + 1][1] is not n]
        made = digester.value.digest([t for _, t, _ in chunk] + changed + [chunk[i][2] for i in loose])
        own, after = made[:len(chunk)], made[len(chunk):2 * len(chunk)]
        following = own[1:] + [own[0]]
        for i, d in zip(loose, made[2 * len(chunk):]):
            following[i] = d
        return pa.RecordBatch.from_arrays([
            pa.array([k for k, _, _ in chunk], pa.int64()), pa.array([len(t) for _, t, _ in chunk], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array([d.written() for d in own], pa.string()), pa.array([d.written() for d in after], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(own, following)], pa.float64())], names)

    def compare(pairs: Iterator[tuple[int | None, str, str]]) -> Iterator[pa.RecordBatch]:
        chunk, size = [], 0
        for pair in pairs:
            chunk.append(pair)
            size += len(pair[1])
            if size >= CHUNK_CHARS:
                yield compared(chunk)
                chunk, size = [], 0
        if chunk:
            yield compared(chunk)

    return with_next(docs, compare, schema, text, key, **options)
