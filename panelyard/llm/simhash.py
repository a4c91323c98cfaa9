"""SimHash near-duplicates, found by covering the fingerprints with anchors of a perfect code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.llm.components import components, local_stars
from panelyard.session import materialise

SEED = 42
HASH_ROWS = 1 << 15         # shingles whose bits are counted at once
GROUP_ROWS = 1 << 12        # fingerprints of an anchor compared in one go; larger anchors are split
PAIRED_ROWS = 1 << 8        # up to so many are compared pair by pair, more by a search
HELD_LINKS = 1 << 21
BATCH_ROWS = 1 << 19

# ---- fingerprints


def fingerprint(text: bytes, words_in_shingle: int = 4) -> int:
    """64 majority bits over the shingles' hashes; no words give 0.

    Only A-Z are lower-cased and only ASCII white space separates words, which is what ``bytes`` methods do.
    """
    return _majority(_shingles(text, words_in_shingle))


def _shingles(text: bytes, words_in_shingle: int) -> np.ndarray:
    """A hash of every shingle, in order; fewer words than a shingle has are one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, ">u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - words_in_shingle + 1)
    starts = np.concatenate([[0], ends[:n - 1] + 1])
    lasts = ends[-n:] if len(words) >= words_in_shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[i:j], SEED) for i, j in zip(starts.tolist(), lasts.tolist())], dtype=">u8")


def _majority(hashes: np.ndarray) -> int:
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASH_ROWS):
        block = hashes[at:at + HASH_ROWS]
        bits += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words_in_shingle: int = 4) -> DataFrame:
    """``doc_id, mark, fp`` for every row: a hash of the text and the 64 bits as a signed number.

    Null and empty texts have the bits 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py() or b"", words_in_shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                                             ["doc_id", "mark", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), _mark(text).alias("mark"),
                       F.col(text).cast("binary").alias("body"))
    return rows.mapInArrow(run, "doc_id long, mark long, fp long")


def _mark(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("binary"))


# ---- anchors
#
# A fingerprint has two halves of 32 bits; two within 4 bits differ by at most 2 in one of them.  The first 31 bits of
# a half are covered by the Hamming code with 5 check bits: it is perfect with radius 1.  The midpoint of a pair at
# distance 2 is 1 away from both, and its anchor 1 away from the midpoint: with the threshold counted from the
# midpoint, radius plus threshold is 2.  So a half goes to every anchor within 2, which is 1 anchor for a code word
# and 16 otherwise.  Anchors are computed, never looked for among data.

_CHECK = [sum(1 << i for i in range(31) if (i + 1) >> c & 1) for c in range(5)]


def _near_words() -> np.ndarray:
    """By syndrome: the error patterns of at most two bits that lead to a code word (the pattern 0 repeated at 0)."""
    table = np.zeros((32, 16), np.uint32)
    for s in range(1, 32):
        pairs = [(a, a ^ s) for a in range(1, 32) if a < a ^ s]
        table[s] = [1 << (s - 1)] + [(1 << (a - 1)) | (1 << (b - 1)) for a, b in pairs]
    return table


_ERRORS = _near_words()


def anchors_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, index of the fingerprint) for both halves; an anchor is its code word with the half's number above."""
    out, index = [], []
    for half in (0, 1):
        x = ((fps >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)).astype(np.uint32)
        syndrome = np.zeros(len(x), np.uint32)
        for c, mask in enumerate(_CHECK):
            syndrome |= (np.bitwise_count(x & np.uint32(mask)).astype(np.uint32) & 1) << c
        words = (x[:, None] ^ _ERRORS[syndrome]).astype(np.int64) | (half << 32)
        keep = np.ones(words.shape, bool)
        keep[syndrome == 0, 1:] = False
        out.append(words[keep])
        index.append(np.nonzero(keep)[0])
    return np.concatenate(out), np.concatenate(index)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for at in range(0, len(fps), 1 << 14):
            part = fps[at:at + (1 << 14)]
            anchor, index = anchors_of(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[index])], ["anchor", "fp"])


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; the first axis holds the words of a fingerprint."""
    return np.bitwise_count(a ^ b).sum(axis=0, dtype=np.int16)


def _forest(fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within ``most`` bits in one group: a search that visits each member once."""
    left, a, b = np.arange(fps.shape[1]), [], []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            grown = []
            for at in range(0, len(front), 64):
                if not len(left):
                    break
                some = front[at:at + 64]
                near = _apart(fps[:, some][:, :, None], fps[:, left][:, None, :]) <= most
                hit = near.any(axis=0)
                a.append(fps[0, some[near[:, hit].argmax(axis=0)]])
                b.append(fps[0, left[hit]])
                grown.append(left[hit])
                left = left[~hit]
            front = np.concatenate(grown) if grown else front[:0]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def link_groups(groups: np.ndarray, fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of the links inside the groups (``groups`` sorted), between the first words of ``fps`` (words x members)."""
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, len(groups)])
    a, b, held = [], [], 0

    def add(x: np.ndarray, y: np.ndarray) -> None:
        nonlocal a, b, held
        a.append(x.view(np.int64)), b.append(y.view(np.int64))
        held += len(x)
        if held > HELD_LINKS:                            # many links of few members: keep what connects them
            x, y = local_stars(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], 0

    for lo, n in zip(starts[sizes > PAIRED_ROWS], sizes[sizes > PAIRED_ROWS]):
        add(*_forest(np.unique(fps[:, lo:lo + n], axis=1), most))
    small = np.repeat((sizes > 1) & (sizes <= PAIRED_ROWS), sizes)
    g, f = groups[small], fps[:, small]
    for shift in range(1, PAIRED_ROWS):
        same = np.flatnonzero(g[shift:] == g[:-shift])
        if not len(same):
            break
        near = same[_apart(f[:, same], f[:, same + shift]) <= most]
        add(f[0, near], f[0, near + shift])
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return local_stars(np.concatenate(a), np.concatenate(b))


def _linker(most: int, group_rows: int | None):
    """Reads (group, words of the fingerprint) sorted by group; gives links, and the rows of groups that are too large."""
    def rows(kind: int, a: np.ndarray, *words: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(x.view(np.int64)) for x in (a, *words)]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), *columns],
                                          ["kind", "a", "b", "c"][:len(columns) + 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, f, large = np.zeros(0, np.int64), None, None

        def finish(g: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            if group_rows:
                starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
                sizes = np.diff(np.r_[starts, len(g)])
                over = np.repeat(sizes > group_rows, sizes)
                if over.any():
                    yield rows(1, g[over], *f[:, over])
                g, f = g[~over], f[:, ~over]
            if len(g) > 1:
                a, b = link_groups(g, f, most)
                if len(a):
                    yield rows(0, a, b, *[np.zeros(len(a), np.int64)] * (len(f) - 1))

        for batch in batches:
            more, *words = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            bits = np.array(words).view(np.uint64)
            if large is not None:                        # the rest of a group already known to be too large
                n = int(np.searchsorted(more, large, "right"))
                if n:
                    yield rows(1, more[:n], *bits[:, :n])
                more, bits = more[n:], bits[:, n:]
                if not len(more):
                    continue
                large = None
            g, f = np.concatenate([g, more]), bits if f is None else np.concatenate([f, bits], axis=1)
            last = int(np.searchsorted(g, g[-1], "left")) if len(g) else 0
            if last >= BATCH_ROWS:
                yield from finish(g[:last], f[:, :last])
                g, f, last = g[last:], f[:, last:], 0
            if group_rows and len(g) - last > group_rows:
                if last:
                    yield from finish(g[:last], f[:, :last])
                large = g[-1]
                yield rows(1, g[last:], *f[:, last:])
                g, f = g[:0], f[:, :0]
        if len(g):
            yield from finish(g, f)

    return run


def near_links(fps: DataFrame, most: int = 4, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``a, b``: links that connect exactly those of the distinct ``fps(fp)`` within ``most`` (up to 4) bits.

    Fingerprints are replicated to their anchors, partitioned by anchor and compared there; each task gives a star
    for each component it sees, never the pairs.  An anchor with more than ``group_rows`` fingerprints is handed on:
    its rows are dealt into blocks, each pair of blocks is one group of bounded size, so no task holds a hot anchor.
    """
    if most > 4:
        raise ValueError("two halves with this code cover at most 4 differing bits")
    return _links(fps.select("fp").mapInArrow(_anchored, "anchor long, fp long"), most, group_rows)


def _links(spread: DataFrame, most: int, group_rows: int) -> DataFrame:
    """The links among the fingerprints of each anchor of ``spread(anchor, fp)``, or of ``spread(anchor, fp, more)``:
    there ``more`` is the second word of bits, and fingerprints are named by the first."""
    words = spread.columns[1:]
    form = ", ".join(["kind byte", *(f"{c} long" for c in "abc"[:len(words) + 1])])
    found = materialise(spread.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _linker(most, group_rows), form), "anchored")
    links, over = found.where("kind = 0").select("a", "b"), found.where("kind = 1")
    if over.limit(1).count():
        rows = over.select(F.col("a").alias("anchor"), *[F.col(x).alias(c) for x, c in zip("bc", words)])
        blocks = materialise(rows.groupBy("anchor").agg(
            F.ceil(F.count(F.lit(1)) * 2 / group_rows).alias("blocks")), "blocks")
        own = F.pmod(F.xxhash64(*words), F.col("blocks"))
        pairs = rows.join(blocks, "anchor").withColumn("own", own).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        pairs = pairs.select(F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other"))
                             .alias("group"), *words)
        more = pairs.repartition("group").sortWithinPartitions("group").mapInArrow(_linker(most, None), form)
        links = links.unionByName(materialise(more, "blocked").select("a", "b"))
    return links


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", *, words_in_shingle: int = 4,
                 most: int = 4) -> DataFrame:
    """One row per input row: ``doc_id, mark, fp, root, component_id``.

    Documents whose fingerprints differ in at most ``most`` bits are linked; ``component_id`` is the smallest key
    reachable and ``root`` the smallest fingerprint.  ``mark`` is a hash of the text.  Texts without words have fingerprint 0 and are linked like others.  Null keys count only where a
    component has no other.  Equal fingerprints are one class from the start, so copies cost nothing later; rows
    find their class by fingerprint, which a hot class cannot stall because both sides are written and can be split.
    """
    rows = materialise(fingerprints(docs, key, text, words_in_shingle), "fingerprints")
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = materialise(components(near_links(classes, most)), "roots")
    member = materialise(roots.join(classes.withColumnRenamed("fp", "node"), "node"), "members")
    heads = materialise(member.groupBy("root").agg(F.min("first").alias("component_id")), "heads")
    linked = materialise(member.join(heads, "root").select(F.col("node").alias("fp"), "root", "component_id"), "linked")
    labels = materialise(classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first").alias("component_id")),
        "labels")
    return rows.join(labels, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", *, words_in_shingle: int = 4,
             most: int = 4) -> DataFrame:
    """The rows of ``docs``, unchanged, that stay when one of each near-duplicate component does.

    The row with the smallest key stays (null keys last; on a tie the smaller hash of the text); of rows equal in key
    and text one.  Texts without words are one component.
    """
    return _keep_best(docs, near_classes(docs, key, text, words_in_shingle=words_in_shingle, most=most), key, text)


def _keep_best(docs: DataFrame, rows: DataFrame, key: str, text: str) -> DataFrame:
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark"))
                                    .alias("at"))
    best = materialise(best.select(F.col("at.doc_id").alias("keep_key"), F.col("at.mark").alias("keep_mark")), "best")
    kept = docs.withColumn("keep_text_mark", _mark(text)).join(best, F.col(key).cast("long").eqNullSafe(
        F.col("keep_key")) & (F.col("keep_mark") == F.col("keep_text_mark")), "left_semi")
    return kept.dropDuplicates([key, "keep_text_mark"]).select(*[F.col(f"`{c}`") for c in docs.columns])


# ---- near copies by exact similarity
#
# Two texts with four fifths of their shingles in common differ in 15 % of their fingerprint bits, so 64 bits would need
# hundreds of anchors a text.  Here a fingerprint has WORDS words of majority bits over the set of shingles.  All but the
# first two words are dealt DEALS times into parts of 16 bits; the value of a part is an anchor, so a text goes to
# DEALS * 32 anchors and two texts with fewer than 32 of these 512 bits different always meet.  In 512 bits a pair at 0.8
# differs in 78 on average; by calculation one such pair in 1,000 shares no anchor, and one in 25,000 at 0.85.  Those of
# an anchor that differ in at most LOOSE of the first 128 bits are linked, what is reachable is one group, and
# the texts of a group are compared by their shingles.

WORDS, CHECKED, DEALS, PART = 10, 2, 4, 16
LOOSE = 38                  # of 128 bits; 4.6 standard deviations above what pairs at 0.8 differ in
SET_ROWS, SET_SHINGLES = 1 << 10, 1 << 20       # texts, and shingles, of a group compared in one go
BROADCAST_KEYS = 250_000

_RANDOM = np.random.default_rng(SEED)
_OFFSETS = _RANDOM.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_DEALT = np.concatenate([_RANDOM.permutation(64 * (WORDS - CHECKED)) for _ in range(DEALS)])


def wide_fingerprint(shingles: np.ndarray) -> bytes:
    """Majority bits over ``64 * WORDS`` hash bits of every shingle; a bit is 1 if set in over half of them."""
    counts = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(shingles), 255):              # so the counts of a block fit into a byte
        x = shingles[at:at + 255, None] + _OFFSETS
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        counts += np.add.reduce(np.unpackbits(x.view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(shingles)).tobytes()


def parts_of(prints: np.ndarray) -> np.ndarray:
    """The anchors of wide fingerprints (bytes, one a row): number and value of every part."""
    bits = np.unpackbits(prints[:, 8 * CHECKED:], axis=1)[:, _DEALT]
    values = np.ascontiguousarray(np.packbits(bits, axis=1)).view(">u2").astype(np.int64)
    return values | np.arange(values.shape[1]) << PART


def _parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads wide fingerprints; gives every anchor with the words that are compared there."""
    for batch in batches:
        held = [x.as_py() for x in batch.column(0)]
        for at in range(0, len(held), 1 << 10):
            prints = np.frombuffer(b"".join(held[at:at + (1 << 10)]), np.uint8).reshape(-1, 8 * WORDS)
            anchors = parts_of(prints)
            words = np.ascontiguousarray(prints[:, :8 * CHECKED]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                anchors.ravel(), *(np.repeat(w, anchors.shape[1]) for w in words.T))], ["anchor", "fp", "more"])


def _sketches(words_in_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, prints, sizes = [], [], []
            for body in batch.column(2):
                shingles = np.unique(_shingles(body.as_py() or b"", words_in_shingle).astype(np.uint64))
                nodes.append(xxhash.xxh64_intdigest(shingles.tobytes(), SEED) - (1 << 63) if len(shingles) else 0)
                prints.append(wide_fingerprint(shingles))
                sizes.append(len(shingles))
            fps = np.array([np.frombuffer(x, np.int64, 1)[0] for x in prints], np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(fps),
                pa.array(prints, pa.binary()), pa.array(sizes, pa.int64())],
                ["doc_id", "mark", "node", "fp", "print", "shingles"])

    return run


def near_sets(nodes: list[int], sets: list[np.ndarray], jaccard: float) -> tuple[list[int], list[int]]:
    """Links that connect exactly the sets with a Jaccard similarity of ``jaccard``: each member is visited once."""
    sizes = np.array([len(s) for s in sets])
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)]
    has, left, a, b = np.zeros(len(values), bool), np.ones(len(sets), bool), [], []
    for first in range(len(sets)):
        front = [first] if left[first] else []
        left[first] = False
        while front:
            x = front.pop()
            alike = np.flatnonzero(left & (sizes >= jaccard * sizes[x] - 1e-6) & (sizes * jaccard <= sizes[x] + 1e-6))
            if not len(alike):
                continue
            has[flat[starts[x]:starts[x + 1]]] = True
            n = sizes[alike]
            ends = np.cumsum(n)
            at = np.arange(ends[-1]) + np.repeat(starts[alike] - (ends - n), n)
            both = np.add.reduceat(has[flat[at]].astype(np.int64), ends - n)
            has[flat[starts[x]:starts[x + 1]]] = False
            near = alike[both >= jaccard * (n + sizes[x] - both) - 1e-6]
            left[near] = False
            front.extend(near.tolist())
            a += [nodes[x]] * len(near)
            b += [nodes[y] for y in near]
    return a, b


def _confirmer(words_in_shingle: int, jaccard: float):
    """Reads (group, node, body) sorted by group; gives the links of each group.  Repeated nodes are passed over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, {}

        def finish() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                a, b = near_sets(list(held), list(held.values()), jaccard)
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for g, node, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if g != group:
                    yield from finish()
                    group, held = g, {}
                if node not in held:
                    held[node] = np.unique(_shingles(body.as_py(), words_in_shingle).astype(np.uint64))
        yield from finish()

    return run


def similar_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", *, words_in_shingle: int = 5,
                    jaccard: float = 0.8, set_rows: int = SET_ROWS, set_shingles: int = SET_SHINGLES) -> DataFrame:
    """One row per input row: ``doc_id, mark, root``; rows of one component have one ``root``.

    Texts are linked when their sets of shingles have a Jaccard similarity of ``jaccard`` or more, compared by the
    shingles' 64-bit hashes; none below is linked.  Candidates come from their fingerprints: of the pairs at 0.8 one in
    1,000 is not met by an anchor, of closer ones fewer.  Texts without words are one component.  Equal sets are one class from the start.  A group with more than
    ``set_rows`` texts or ``set_shingles`` shingles is dealt into blocks and each pair of blocks compared by itself.
    """
    body = F.col(text).cast("binary")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), _mark(text).alias("mark"), body.alias("body"))
    rows = materialise(rows.mapInArrow(_sketches(words_in_shingle), "doc_id long, mark long, node long, fp long, "
                                       "print binary, shingles long"), "sketches")
    classes = materialise(rows.groupBy("node").agg(
        F.min(F.struct("doc_id", "mark")).alias("at"), F.first("fp").alias("fp"),
        F.first("print").alias("print"), F.first("shingles").alias("shingles")), "classes")
    spread = classes.where("shingles > 0").select("print").mapInArrow(_parted, "anchor long, fp long, more long")
    loose = components(_links(spread, LOOSE, GROUP_ROWS))
    loose = materialise(loose.select(F.col("node").alias("fp"), F.col("root").alias("super")), "loose")
    member = classes.where("shingles > 0").join(loose, "fp", "left").select(
        "node", "at", "shingles", F.coalesce("super", "fp").alias("super"))
    member = materialise(member, "members")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") * 2 / set_rows), F.ceil(F.col("total") * 2 / set_shingles))
    grid = member.groupBy("super").agg(F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("total")).where("n > 1")
    grid = materialise(grid.select("super", F.when((F.col("n") <= set_rows) & (F.col("total") <= set_shingles), 1)
                                   .otherwise(blocks).cast("long").alias("blocks")), "grid")
    asked = materialise(member.join(grid, "super").select(
        "node", F.col("at.doc_id").alias("at_key"), F.col("at.mark").alias("at_mark"), "super", "blocks"), "asked")
    few = F.broadcast(asked) if asked.count() <= BROADCAST_KEYS else asked
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), _mark(text).alias("mark"), body.alias("body")).join(
        few, (F.col("mark") == F.col("at_mark")) & F.col("doc_id").eqNullSafe(F.col("at_key")))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    pairs = texts.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pairs = pairs.select(F.xxhash64("super", F.least("own", "other"), F.greatest("own", "other")).alias("group"),
                         "node", "body")
    links = materialise(pairs.repartition("group").sortWithinPartitions("group").mapInArrow(
        _confirmer(words_in_shingle, jaccard), "a long, b long"), "similar")
    roots = materialise(components(links), "roots")
    labels = materialise(classes.select("node").join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")), "labels")
    return rows.join(labels, "node").select("doc_id", "mark", "root")


def keep_one_similar(docs: DataFrame, key: str = "doc_id", text: str = "text", *, words_in_shingle: int = 5,
                     jaccard: float = 0.8) -> DataFrame:
    """Like ``keep_one``, with the components of ``similar_classes``."""
    return _keep_best(docs, similar_classes(docs, key, text, words_in_shingle=words_in_shingle, jaccard=jaccard), key, text)
