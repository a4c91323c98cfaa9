"""Embedding near-duplicates: inverted lists with product-quantised residuals, distances to codes, exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyard.llm.components import components, local_stars
from panelyard.session import materialise

SAMPLE_ROWS = 20_000        # distinct vectors the index is fitted on, at most; every vector is indexed
SUBSPACES, CODES = 8, 256
FEW = 4_096                 # up to so many distinct vectors there is one list
LISTS_X = 16                # times the square root of the distinct vectors: the number of lists
MOST_PLACES = 64            # lists a vector is put into, on average; with more the index has fewer lists
CELL_ROWS = 8_192           # vectors of one block of a list
TRIED = 20_000              # random pairs that set the least score, and neighbours in the sample, at most
ASKED, LEAST_PAIRS = 2_000, 200     # sample vectors whose neighbours count too, where there are so many pairs
MISSED = 0.001              # share of pairs at the threshold that may share no list
TILE = 1_024                # rows and directions whose products are held at once
PAIRS = 100_000             # candidates reranked at once
CROWD = 32                  # candidates a vector from which on the cheaper test of them comes first
WAVE_X, WAVE_BYTES = 2.5, 512 << 20   # a wave sends so many times the vectors' bytes, or so many bytes
PLACES = 1_000_000          # vectors in cells that are made of a batch at once
GROUP_BYTES, GROUPS = 8 << 20, 4    # of one group of cells; groups of one partition
ODD = np.uint64(0x9E3779B97F4A7C15)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass
class Index:
    """The directions of the lists' centres and the code books of the residuals.

    Every direction has two lists, one for each sign (a single direction has one list of all vectors).  A vector is put
    into every list whose direction's product with it is ``least`` or more, and into the best of all if there is none.
    """

    ways: np.ndarray            # directions x dimensions, of length 1
    books: np.ndarray           # subspaces x codes x dimensions of a subspace (padded with zeros)
    reach: float                # largest distance of unit vectors that are linked
    least: float = -np.inf
    scale: float = 1.0          # length of the lists' centres

    @property
    def lists(self) -> int:
        return 1 if len(self.ways) == 1 else 2 * len(self.ways)

    def pieces(self, x: np.ndarray) -> np.ndarray:
        """Vectors cut into subspaces: subspaces x rows x dimensions of a subspace."""
        m, _, d = self.books.shape
        padded = np.zeros((len(x), m * d), x.dtype)
        padded[:, :x.shape[1]] = x
        return padded.reshape(len(x), m, d).transpose(1, 0, 2)

    def home(self, x: np.ndarray) -> np.ndarray:
        """The best list of each row."""
        if self.lists == 1:
            return np.zeros(len(x), np.int64)
        out = []
        for at in range(0, len(x), TILE // 4):
            scores = x[at:at + TILE // 4] @ self.ways.T
            best = np.abs(scores).argmax(axis=1)
            out.append(best + len(self.ways) * (scores[np.arange(len(scores)), best] < 0))
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def places(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the lists they are put into, in ascending order."""
        if self.lists == 1:
            return np.arange(len(x)), np.zeros(len(x), np.int64)
        keys, k = [], len(self.ways)
        for at in range(0, len(x), TILE // 2):
            for way in range(0, k, TILE):
                scores = x[at:at + TILE // 2] @ self.ways[way:way + TILE].T
                hit = np.flatnonzero(np.abs(scores) >= self.least)
                row, number = np.divmod(hit, scores.shape[1])
                keys.append((row + at) * self.lists + number + way + k * (scores.ravel()[hit] < 0))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        alone = np.flatnonzero(np.bincount(keys // self.lists, minlength=len(x)) == 0)
        keys = np.sort(np.concatenate([keys, alone * self.lists + self.home(x[alone])]))
        return keys // self.lists, keys % self.lists

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best list of each row, and which lists it is put into (rows x lists)."""
        rows, lists = self.places(x)
        seen = np.zeros((len(x), self.lists), bool)
        seen[rows, lists] = True
        return self.home(x), seen

    def centres(self, lists: np.ndarray) -> np.ndarray:
        k = len(self.ways)
        return np.where(lists < k, self.scale, -self.scale).astype(self.ways.dtype)[:, None] * self.ways[lists % k]

    def decoded(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the codes of the rows' residuals in their lists stand for, and how far the rows are from it."""
        meant = self.centres(lists)
        pieces = self.pieces(x - meant)
        one = np.ones((len(x), 1), x.dtype)
        for s, book in enumerate(self.books):       # the nearest code has the largest product less half its square
            key = np.concatenate([book, -(book * book).sum(axis=1, keepdims=True) / 2], axis=1).T
            for at in range(0, len(x), TILE):
                nearest = (np.concatenate([pieces[s][at:at + TILE], one[at:at + TILE]], axis=1) @ key).argmax(axis=1)
                part = meant[at:at + TILE, s * book.shape[1]:(s + 1) * book.shape[1]]
                part += book[nearest][:, :part.shape[1]]
        return meant, np.sqrt(((x - meant) ** 2).sum(axis=1))

    def meet(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The score up to which the two vectors of each pair share a list."""
        out = np.full(len(x), -np.inf, x.dtype)
        for at in range(0, len(x), TILE):
            best = out[at:at + TILE]
            for way in range(0, len(self.ways), TILE):
                a, b = (v[at:at + TILE] @ self.ways[way:way + TILE].T for v in (x, y))
                np.maximum(best, np.minimum(a, b).max(axis=1), out=best)
                np.maximum(best, -np.maximum(a, b).min(axis=1), out=best)
        return out


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None, :], 0)


def _means(x: np.ndarray, k: int, random: np.random.Generator, turns: int = 8) -> np.ndarray:
    k = min(k, len(x))
    centres = x[random.choice(len(x), k, replace=False)].copy()
    for _ in range(turns):
        near = _squares(x, centres).argmin(axis=1)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def build_index(sample: np.ndarray, rows: int, cosine: float, seed: int = 11) -> Index:
    """Fits the index on unit vectors; the number of lists follows the square root of the rows it must hold.

    The lists have random directions, so whether a pair shares one depends on its cosine, not on how the data are
    spread: the least score is the one at which all but MISSED of random pairs at the threshold share a list.  Where the
    sample holds enough neighbours, it is lowered until all but MISSED of them do so too.
    """
    random = np.random.default_rng(seed)
    dims, single = sample.shape[1], sample.astype(np.float32)
    x, z = random.standard_normal((2, TRIED, dims))
    x = _unit(x)
    z -= np.einsum("ij,ij->i", x, z)[:, None] * x
    y = cosine * x + np.sqrt(1 - cosine * cosine) * (_unit(z) if dims > 1 else 0 * z)
    mine, others = _neighbours(sample, cosine, random)
    count = max(1, round(LISTS_X * rows ** 0.5 / 2)) if rows > FEW else 1
    index = Index(np.zeros((1, dims)), np.zeros((SUBSPACES, 1, -(-dims // SUBSPACES))), float(np.sqrt(2 - 2 * cosine)))
    while True:
        turned = [np.linalg.qr(random.standard_normal((dims, dims)))[0] for _ in range(-(-count // dims))]
        index.ways, index.least = np.concatenate(turned)[:count].astype(np.float32), -np.inf
        if count == 1:
            break
        index.least = float(np.quantile(index.meet(x.astype(np.float32), y.astype(np.float32)), MISSED))
        if len(mine) >= LEAST_PAIRS:
            index.least = min(index.least, float(np.quantile(index.meet(mine, others), MISSED)))
        if index.least > 0 and len(index.places(single[:ASKED])[0]) <= MOST_PLACES * len(single[:ASKED]):
            break
        count //= 2
    home = index.home(single)
    index.scale = float(np.einsum("ij,ij->i", single, index.centres(home)).mean())
    index.books = np.stack([_means(p, CODES, random, 5) for p in index.pieces(single - index.centres(home))])
    return index


def _neighbours(sample: np.ndarray, cosine: float, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the sample's vectors that are linked, at most 16 of a vector, so large groups do not outweigh others."""
    mine, others = [sample[:0]], [sample[:0]]
    for some in np.array_split(random.permutation(len(sample))[:ASKED], 20):
        if not len(some):
            continue
        near = sample[some] @ sample.T >= cosine
        near[np.arange(len(some)), some] = False
        i, j = np.nonzero(near)
        mixed = random.permutation(len(i))
        i, j = i[mixed], j[mixed]
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        mine.append(sample[some][i[nth < 16]])
        others.append(sample[j[nth < 16]])
    mine, others = np.concatenate(mine).astype(np.float32), np.concatenate(others).astype(np.float32)
    kept = random.permutation(len(mine))[:TRIED]
    return mine[kept], others[kept]


def _matrix(column: pa.Array, dtype: type = np.float64) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return values.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)       # no overflow of squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of ``values``, cut before the given places, without a copy of each."""
    values = np.ascontiguousarray(values)
    offsets = (np.r_[cuts, len(values)] * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _bytes(column: pa.Array, dtype: np.dtype) -> np.ndarray:
    """What all the values of a binary column hold, one after the other."""
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, dtype)
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(dtype)


_CODED = "cid long, first long, n long, low long, high long, vec binary, lists binary"


def _coder(shared, dtype: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                raw = _matrix(part.column(5), dtype)
                rows, lists = index.places(_unit(raw.astype(np.float64)).astype(np.float32))
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:5], _binary(raw.reshape(-1), np.arange(len(raw)) * raw.shape[1]),
                    _binary(lists.astype(np.int32), np.searchsorted(rows, np.arange(len(raw))))],
                    ["cid", "first", "n", "low", "high", "vec", "lists"])

    return run


def _record(width: int, dtype: type) -> np.dtype:
    """A vector in one cell; ``below`` counts the lists of a lower number that hold it, which follow the records."""
    return np.dtype([("unit", np.int64), ("cid", np.int64), ("first", np.int64), ("n", np.int64), ("below", np.int32),
                     ("side", np.int8), ("vec", dtype, (width,))])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * ODD
    return ((x ^ (x >> np.uint64(29))) * ODD) >> np.uint64(33)


def _blocks(lists: np.ndarray, hot: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The number of blocks of each of the lists; ``blocks`` has those of the hot ones."""
    if not len(hot):
        return np.ones(len(lists), np.int64)
    at = np.minimum(np.searchsorted(hot, lists), len(hot) - 1)
    return np.where(hot[at] == lists, blocks[at], 1)


def _cells(cid: np.ndarray, lists: np.ndarray, many: np.ndarray):
    """The cells of each vector in a list: which of the given rows, the cell's number, the side within the cell.

    A list of several blocks has a cell for every two of them and for each by itself, so any two of its vectors are in
    exactly one cell of the list together (or, of one block, on the same side).
    """
    which = np.repeat(np.arange(len(lists)), many)
    other, own = _ramp(many), (_mixed(cid) % many.astype(np.uint64)).astype(np.int64)[which]
    pair = np.minimum(own, other) * many[which] + np.maximum(own, other)
    return which, (lists[which].astype(np.int64) << 32) | pair, (own > other).astype(np.int8)


def _sender(shared, record: np.dtype, wave: int, waves: int, groups: int):
    """Rows ``group, rows, below``: the vectors of one wave's cells, packed by groups of cells."""
    def packed(batch: pa.RecordBatch, lists: np.ndarray, spans: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
        cid, first, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        row = np.repeat(np.arange(len(cid)), np.diff(spans))
        which, unit, side = _cells(cid[row], lists, many)
        mixed = _mixed(unit)
        mine = np.flatnonzero(mixed % np.uint64(waves) == wave)
        group = ((mixed[mine] // np.uint64(waves)) % np.uint64(groups)).astype(np.int32)
        order = np.argsort(group, kind="stable")
        mine, group = mine[order], group[order]
        place = which[mine]
        row = row[place]
        out = np.empty(len(mine), record)
        out["unit"], out["side"], out["below"] = unit[mine], side[mine], place - spans[row]
        out["cid"], out["first"], out["n"] = cid[row], first[row], n[row]
        out["vec"] = _bytes(batch.column(3), record["vec"].base).reshape(len(cid), -1)[row]
        below = lists[np.repeat(spans[row], out["below"]) + _ramp(out["below"])]
        cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
        ends = np.r_[0, np.cumsum(out["below"], dtype=np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(group[cuts]), _binary(out, cuts), _binary(below, ends[cuts])],
                                          ["group", "rows", "below"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, blocks = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(4)
            spans = np.frombuffer(column.buffers()[1], np.int32)[column.offset:][:batch.num_rows + 1].astype(np.int64) // 4
            spans, lists = spans - spans[0], _bytes(column, np.int32)
            many = _blocks(lists, hot, blocks)
            made = np.add.reduceat(many, spans[:-1]).cumsum() // PLACES      # every vector has a list
            cuts = np.flatnonzero(np.r_[True, made[1:] != made[:-1]])
            for lo, hi in zip(cuts, np.r_[cuts[1:], batch.num_rows]):
                own = slice(spans[lo], spans[hi])
                yield packed(batch.slice(lo, hi - lo), lists[own], spans[lo:hi + 1] - spans[lo], many[own])

    return run


def _compare(unit: np.ndarray, meant: np.ndarray, most: np.ndarray, side: np.ndarray):
    """Pairs of one cell that the distances to the codes leave, by sides where it has two.

    The distance to what a vector's codes stand for, less the vector's own error, cannot exceed the true distance, so
    no pair that is linked is dropped.  The distances of a tile of queries and members are one matrix product.
    """
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    members = two if len(two) else one
    queries, meant, left = unit[one], meant[members], []
    bar = (1 + (meant * meant).sum(axis=1) - most[members]) / 2
    for at in range(0, len(one), TILE // 2):
        for low in range(0 if len(two) else at, len(members), TILE):
            some = meant[low:low + TILE]
            hit = np.flatnonzero(queries[at:at + TILE // 2] @ some.T >= bar[low:low + TILE])
            i, j = np.divmod(hit, len(some))
            i, j = i + at, j + low
            if not len(two):
                i, j = i[i < j], j[i < j]
            left.append((one[i], members[j]))
        if sum(len(i) for i, _ in left) >= PAIRS:
            yield tuple(np.concatenate(x) for x in zip(*left))
            left = []
    if left:
        yield tuple(np.concatenate(x) for x in zip(*left))


def _elsewhere(a: np.ndarray, b: np.ndarray, owner: np.ndarray, below: np.ndarray):
    """For pairs of a cell's rows whether a list of a lower number holds both; each pair counts in the first only."""
    linked = np.unique(np.concatenate([a, b]))
    kept = np.isin(owner, linked)
    owner, below = np.searchsorted(linked, owner[kept]), below[kept]
    _, code, count = np.unique(below, return_inverse=True, return_counts=True)
    shared = count > 1
    code, owner = (np.cumsum(shared) - 1)[code[shared[code]]], owner[shared[code]]
    bits = np.zeros((len(linked), max(1, -(-int(shared.sum()) // 64))), np.uint64)
    np.bitwise_or.at(bits, (owner, code // 64), np.uint64(1) << (code % 64).astype(np.uint64))
    a, b = np.searchsorted(linked, a), np.searchsorted(linked, b)
    step = max(1, PAIRS * 16 // bits.shape[1])
    return np.concatenate([(bits[a[i:i + step]] & bits[b[i:i + step]]).any(axis=1) for i in range(0, len(a), step)])


def _finder(shared, record: np.dtype, cosine: float):
    """Reads packed groups of cells; gives link counts and stars of links."""
    def rows(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(a.astype(np.int64)),
                                           pa.array(b.astype(np.int64))], ["kind", "a", "b"])

    def cell(found: np.ndarray, unit: np.ndarray, single: np.ndarray, meant: np.ndarray, most: np.ndarray,
             owner: np.ndarray, below: np.ndarray) -> Iterator[pa.RecordBatch]:
        links, stars = np.zeros(len(found), np.int64), []

        def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.concatenate([np.einsum("ij,ij->i", unit[a[i:i + PAIRS]], unit[b[i:i + PAIRS]]) >= cosine
                                   for i in range(0, len(a), PAIRS)])

        def here(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return ~_elsewhere(a, b, owner, below) if len(below) else np.ones(len(a), bool)

        for a, b in _compare(single, meant, most, found["side"]):
            # in a crowd nearly all candidates are linked, and many lists hold them; elsewhere few are linked
            for test in (here, linked) if len(a) > CROWD * len(found) else (linked, here):
                if len(a):
                    good = test(a, b)
                    a, b = a[good], b[good]
            if len(a):
                np.add.at(links, a, found["n"][b])
                np.add.at(links, b, found["n"][a])
                stars.append(local_stars(found["first"][a], found["first"][b]))
        if stars:
            yield rows(0, found["cid"][links > 0], links[links > 0])
            yield rows(1, *local_stars(np.concatenate([s[0] for s in stars]), np.concatenate([s[1] for s in stars])))

    def whole(index: Index, parts: list[np.ndarray], below: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, below = np.concatenate(parts), np.concatenate(below)
        start = np.cumsum(found["below"], dtype=np.int64) - found["below"]
        order = np.argsort(found["unit"], kind="stable")
        found, start = found[order], start[order]
        unit = _unit(found["vec"].astype(np.float64))
        single = unit.astype(np.float32)
        meant, error = index.decoded(single, found["unit"] >> 32)
        most = (index.reach + error) ** 2 + 1e-4        # more than single precision rounds off
        cuts = np.flatnonzero(np.r_[True, found["unit"][1:] != found["unit"][:-1]])
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(found)]):
            if hi - lo > 1:
                some = found[lo:hi]
                at = np.repeat(start[lo:hi], some["below"]) + _ramp(some["below"])
                yield from cell(some, unit[lo:hi], single[lo:hi], meant[lo:hi], most[lo:hi],
                                np.repeat(np.arange(hi - lo), some["below"]), below[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        group, parts, below = None, [], []
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else []
            for lo, hi in zip(cuts, np.r_[cuts[1:], len(keys)]):
                if parts and group != keys[lo]:
                    yield from whole(index, parts, below)
                    parts, below = [], []
                group = keys[lo]
                parts.append(_bytes(batch.column(1).slice(lo, hi - lo), record))
                below.append(_bytes(batch.column(2).slice(lo, hi - lo), np.int32))
        if parts:
            yield from whole(index, parts, below)

    return run


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """The shuffle files of a job go when it has ended, so those of one wave do not lie beside those of the next."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", *, cosine: float = 0.9,
                 sample_rows: int = SAMPLE_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Links join vectors with a cosine of at least ``cosine`` in double precision; all returned ones are exact, and
    vectors are put into enough lists to find nearly all (see ``build_index``).  ``n_links`` counts the other vectors
    linked directly, copies included; ``component_id`` is the smallest key reachable; kept rows have that key.

    Null and zero vectors, vectors with null or non-finite components and rows without a key link with nothing.
    Vectors of different lengths never link; each length has an index of its own.  Rows that repeat a key are linked
    each by its own vector.

    Equal vectors are one class with a weight, whatever their number; rows find their class by 128 bits of hashes.  A
    list is cut into cells of at most about twice ``cell_rows`` vectors, so a hot list is shared by many tasks; a cell
    gives counts and stars, not pairs.  Lists are compared in waves, each of which sends about WAVE_X times the
    vectors' bytes.  ``rows`` are read three times, so as not to keep a copy of them.  The index is fitted on at most
    ``sample_rows`` distinct vectors, those with the smallest hash.
    """
    source = rows.select(F.col(key).alias("vec_id"), F.col(vector).alias("vec"))
    source = source.withColumn("ok", F.coalesce(F.col("vec_id").isNotNull() & _sound(source), F.lit(False)))
    source = source.withColumn("width", F.when(F.col("ok"), F.size("vec"))).withColumn("low", F.xxhash64("vec"))
    source = source.withColumn("high", F.xxhash64(F.lit(1), "vec"))
    named = materialise(source.drop("vec"), "vectors")
    out = named.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                       F.col("vec_id").alias("component_id"))
    with _shuffles_dropped(rows.sparkSession):
        sizes = named.where("ok").groupBy("width").agg(F.approx_count_distinct("low").alias("n")).collect()
        for width, n in sorted((r.width, r.n) for r in sizes):
            same = F.col("width") == width
            out = out.unionByName(_linked(source.where(same), named.where(same), width, n, cosine, sample_rows, cell_rows))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _sound(source: DataFrame):
    """Whether a vector has no null or non-finite component and is not zero."""
    v, kind = F.col("vec"), source.schema["vec"].dataType.elementType
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return v.isNotNull() & ~bad & F.exists("vec", lambda x: x != 0)
    # compiled, unlike functions of each component; the first is null where a component is
    most, least = F.array_max(v), F.array_min(v)
    return ~F.array_contains(v, F.lit(float("nan")).cast(kind)) & (most < float("inf")) & (least > float("-inf")) & (
        (most != 0) | (least != 0))


def _linked(source: DataFrame, named: DataFrame, width: int, n: int, cosine: float, sample_rows: int,
            cell_rows: int) -> DataFrame:
    """``vec_id, n_links, component_id`` of sound vectors of one length, about ``n`` of them distinct."""
    spark = source.sparkSession
    dtype = np.float32 if isinstance(source.schema["vec"].dataType.elementType, T.FloatType) else np.float64
    record = _record(width, dtype)

    # only what can be among the smallest hashes is sorted; the margin is ten times the error of the count
    small = source if n < 2 * sample_rows else source.where(F.col("low") < -2 ** 63 + int(2 ** 64 * 1.5 * sample_rows / n))
    sample = small.groupBy("vec").agg(F.min("low").alias("low")).orderBy("low").limit(sample_rows).select("vec")
    sample = sample.toArrow().column(0).combine_chunks()
    index = spark.sparkContext.broadcast(build_index(_unit(_matrix(sample)), n, cosine))

    classes = source.groupBy("vec").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"),
                                       F.min("low").alias("low"), F.min("high").alias("high"))
    classes = classes.select(F.monotonically_increasing_id().alias("cid"), "first", "n", "low", "high", "vec")
    coded = materialise(classes.mapInArrow(_coder(index, dtype), _CODED), "coded")

    count, places = coded.agg(F.count(F.lit(1)), F.sum(F.length("lists")) / 4).first()
    share = max(1, count // 500_000)        # sizes of lists need not be exact, they only set the blocks
    lists = coded.where(F.pmod("low", F.lit(share)) == 0).select(F.col("lists")).mapInArrow(_sizes, "list int, n long")
    hot = lists.groupBy("list").agg((F.sum("n") * share).alias("n")).where(F.col("n") > cell_rows).toArrow()
    number, size = (c.to_numpy() for c in hot.columns)
    order, blocks = np.argsort(number), -(-size // cell_rows)
    cells = spark.sparkContext.broadcast((number[order].astype(np.int64), blocks[order].astype(np.int64)))

    sent = (int(places) + int((size * (blocks - 1)).sum())) * (record.itemsize + 2 * int(places) // count)
    waves = -(-sent // max(WAVE_BYTES, int(WAVE_X * count * record["vec"].itemsize)))
    groups = -(-sent // waves // GROUP_BYTES)
    parts = max(-(-groups // GROUPS), min(spark.sparkContext.defaultParallelism, -(-sent // (1 << 20))))
    groups = max(groups, GROUPS * parts)
    found = []
    for wave in range(waves):
        packed = coded.select("cid", "first", "n", "vec", "lists").mapInArrow(
            _sender(cells, record, wave, waves, groups), "group int, rows binary, below binary")
        packed = packed.repartition(parts, "group").sortWithinPartitions("group")
        found.append(materialise(packed.mapInArrow(_finder(index, record, cosine), "kind byte, a long, b long"), "found"))
    found = reduce(DataFrame.unionByName, found)

    counts = found.where("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("links"))
    roots = materialise(components(found.where("kind = 1").select("a", "b")), "roots")
    labels = coded.join(counts, "cid", "left").join(roots, F.col("first") == F.col("node"), "left").select(
        "low", "high", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "first").alias("component_id"))
    labels = materialise(labels, "labels")
    return named.select("vec_id", "low", "high").join(labels, ["low", "high"]).select("vec_id", "n_links", "component_id")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each list occurs in a batch."""
    for batch in batches:
        lists, counts = np.unique(_bytes(batch.column(0), np.int32), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(lists), pa.array(counts.astype(np.int64))], ["list", "n"])
