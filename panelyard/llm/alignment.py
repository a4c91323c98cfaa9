"""Cross-tokenizer alignment: windows between shared ends before space-marked tokens, aligned once per tuple of ids."""

from __future__ import annotations

import gc
import hashlib
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.llm.bpe import byte_letters
from panelyard.session import materialise

CHUNK_CHARS = 1_000_000      # text tokenised together
MEMO_WINDOWS = 500_000      # windows a worker remembers; then it starts anew
BETWEEN = (1 << 16) - 1     # no id
MEMO_TOKENS = 64            # longer windows are aligned where they stand
#: Pairs held by most documents are broadcast, at most this many (some 50 bytes each); the others are joined by shuffle.
FREQUENT_PAIRS = 500_000

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


# Fixed value: how byte-level BPE files of this kind cut a text before merging.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _bytes_of_letters(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file; special tokens have none, as no text gives them."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    value = {c: b for b, c in enumerate(byte_letters())}
    vocab, special = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
    cut = spec["pre_tokenizer"]
    if cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or spec["normalizer"]:
        raise ValueError("not a byte-level BPE file of the kind this operator encodes")
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    if any(x >= y for x, y in zip(merged, merged[1:])):
        raise ValueError("ids must follow the order of merges")
    table = [b""] * (max(vocab.values()) + 1)
    for name, i in vocab.items():
        if name not in special:
            table[i] = bytes(value[c] for c in name)
    return table


def _bytes_of_pieces(model: bytes) -> list[bytes]:
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [bytes([int(pieces.id_to_piece(i)[1:-1], 16)]) if pieces.is_byte(i)
            else pieces.id_to_piece(i).replace("▁", " ").encode() for i in range(pieces.get_piece_size())]


class _Side:
    """One tokenizer's ids: their bytes, byte counts, and which begin with a space."""

    def __init__(self, table: list[bytes]):
        if len(table) > BETWEEN:
            raise ValueError("ids must fit 16 bits")
        self.table = table
        self.size = [len(b) for b in table]
        self.sizes = np.array(self.size, np.int64)
        self.marked = np.array([b[:1] == b" " for b in table])


Group = tuple[str, list[tuple[int, int]]]         # written out; pairs and how often each is linked


def _group(a: list[int], b: list[int]) -> Group:
    """A group's pairs come from its distinct ids with their numbers, so long runs of one token cost little."""
    if len(a) * len(b) <= 64:
        pairs = [(x << 16 | y, 1) for x in a for y in b]
    else:
        pairs = [(x << 16 | y, n * m) for x, n in Counter(a).items() for y, m in Counter(b).items()]
    return f"{','.join([str(x) for x in a])}|{','.join([str(y) for y in b])}", pairs


def align_window(a: list[int], b: list[int], size_a: list[int], size_b: list[int],
                 single: dict[int, str]) -> tuple[list[str], dict[int, int]]:
    """A window's groups, written out, and how often each pair is linked (A id in the upper 16 bits).

    Both id lists are cut wherever a token of each ends at the same byte.  ``single`` remembers groups of one to one.
    """
    written, linked, i, j, k, m = [], {}, 0, 0, 0, 0
    while k < len(a):
        ahead = size_a[a[k]] - size_b[b[m]]         # bytes that A's tokens reach beyond B's
        k, m = k + 1, m + 1
        if not ahead:
            pair = a[i] << 16 | b[j]
            text = single.get(pair)
            if text is None:
                text = single[pair] = f"{a[i]}|{b[j]}"
            written.append(text)
            linked[pair] = linked.get(pair, 0) + 1
        else:
            while ahead:
                if ahead < 0:
                    ahead += size_a[a[k]]
                    k += 1
                else:
                    ahead -= size_b[b[m]]
                    m += 1
            text, pairs = _group(a[i:k], b[j:m])
            written.append(text)
            for pair, n in pairs:
                linked[pair] = linked.get(pair, 0) + n
        i, j = k, m
    return written, linked


class _Memo:
    """Aligned windows by their ids, their pairs in one flat array."""

    def __init__(self, size_a: list[int], size_b: list[int]):
        self.size_a, self.size_b = size_a, size_b
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.single: dict[int, str] = {}
        self.text: list[str] = []
        self.groups = self.count = self.first = self.pairs = self.times = np.zeros(0, np.int64)

    def numbers(self, windows: list[bytes]) -> np.ndarray:
        """A number for each window, valid until the next call; equal short windows are aligned once.

        A window is its ids of A, ``BETWEEN`` and its ids of B, as 16-bit numbers.
        """
        if len(self.text) > MEMO_WINDOWS:
            self.clear()
        out = list(map(self.number.get, windows))
        if None in out:
            self._learn(windows, out)
        return np.array(out, np.int64)

    def _learn(self, windows: list[bytes], out: list) -> None:
        """Aligns the windows that have no number yet and gives them one."""
        known, texts = self.number, self.text
        groups_of, count_of, pairs, times = [], [], [], []
        for i, n in enumerate(out):
            if n is not None:
                continue
            w = windows[i]
            n = known.get(w)
            if n is None:
                ids = memoryview(w).cast("H").tolist()
                cut = ids.index(BETWEEN)
                written, linked = align_window(ids[:cut], ids[cut + 1:], self.size_a, self.size_b, self.single)
                n = len(texts)
                texts.append(";".join(written))
                groups_of.append(len(written))
                count_of.append(len(linked))
                pairs += linked.keys()
                times += linked.values()
                if len(ids) <= MEMO_TOKENS:
                    known[w] = n
            out[i] = n
        self.groups = np.r_[self.groups, np.array(groups_of, np.int64)]
        self.count = np.r_[self.count, np.array(count_of, np.int64)]
        self.first = np.cumsum(self.count) - self.count
        self.pairs = np.r_[self.pairs, np.array(pairs, np.int64)]
        self.times = np.r_[self.times, np.array(times, np.int64)]


def _windows(a: np.ndarray, b: np.ndarray, from_a: np.ndarray, from_b: np.ndarray) -> list[bytes]:
    """The windows that begin at these tokens: ids of A, ``BETWEEN``, ids of B."""
    to_a, to_b = np.r_[from_a[1:], len(a)], np.r_[from_b[1:], len(b)]
    window = np.arange(len(from_a))
    flat = np.full(len(a) + len(b) + len(window), BETWEEN, np.uint16)
    flat[np.arange(len(a)) + np.repeat(from_b + window, to_a - from_a)] = a
    flat[np.arange(len(b)) + np.repeat(to_a + window + 1, to_b - from_b)] = b
    raw, ends = flat.tobytes(), (2 * (to_a + to_b + window + 1)).tolist()
    return [raw[i:j] for i, j in zip([0, *ends], ends)]


class Aligner:
    """Aligns texts; the tokenizers come as tables and file contents, so executors need no files."""

    def __init__(self, side_a: _Side, model_b: bytes, side_b: _Side):
        ranks = {b: i for i, b in enumerate(side_a.table) if b}
        self.a = tiktoken.Encoding("a", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.side_a, self.side_b = side_a, side_b
        self.memo = _Memo(side_a.size, side_b.size)

    def align(self, texts: list[str]) -> list[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
        """Per text: ids of A, ids of B, groups, links, the groups written out, distinct linked pairs, their numbers."""
        out = [(0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(texts)
        at = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in at]
        # special tokens' strings are plain text to both
        ids_a = [self.a.encode_to_numpy(t, disallowed_special=()) for t in spaced]
        ids_b = self.b.encode([texts[i] for i in at], num_threads=1)
        name_b = self.side_b.table.__getitem__
        whole = []
        for k, text in enumerate(spaced):
            raw = text.encode()
            # A's tokens are pieces of the text, one after the other: they give it back if they are as long
            if self.side_a.sizes[ids_a[k]].sum() == len(raw) and b"".join(map(name_b, ids_b[k])) == raw:
                whole.append(k)
        if not whole:
            return out
        n_a, n_b = ([len(ids[k]) for k in whole] for ids in (ids_a, ids_b))
        flat_a, flat_b = (np.concatenate([np.asarray(ids[k], np.int64) for k in whole]) for ids in (ids_a, ids_b))
        # both sides have the same bytes text by text, so one running byte offset serves the chunk
        size_a, size_b = self.side_a.sizes[flat_a], self.side_b.sizes[flat_b]
        start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        # texts begin with a space: their first bytes are anchors too
        anchors = np.intersect1d(start_a[self.side_a.marked[flat_a]], start_b[self.side_b.marked[flat_b]],
                                 assume_unique=True)
        from_a, from_b = np.searchsorted(start_a, anchors), np.searchsorted(start_b, anchors)
        numbers = self.memo.numbers(_windows(flat_a, flat_b, from_a, from_b))

        first_a = np.cumsum([0, *n_a])
        first_window = np.searchsorted(from_a, first_a)      # every text begins with a window
        doc = np.repeat(np.arange(len(whole)), np.diff(first_window))
        pairs, times, ends = self._pairs_by_doc(numbers, doc, len(whole))
        groups = np.bincount(doc, self.memo.groups[numbers], len(whole)).astype(np.int64).tolist()
        number, text = numbers.tolist(), self.memo.text
        for d, k in enumerate(whole):
            i, j = first_window[d], first_window[d + 1]
            p = slice(ends[d], ends[d + 1])
            out[at[k]] = (n_a[d], n_b[d], groups[d], int(times[p].sum()), ";".join([text[n] for n in number[i:j]]),
                          pairs[p], times[p])
        return out

    def _pairs_by_doc(self, numbers: np.ndarray, doc: np.ndarray, docs: int):
        """Distinct pairs of each text in order, how often each is linked, and where each text's begin."""
        seen, repeats = np.unique(doc << 32 | numbers, return_counts=True)
        doc, numbers = seen >> 32, seen & 0xFFFFFFFF
        count = self.memo.count[numbers]
        at = np.repeat(self.memo.first[numbers] - np.cumsum(count) + count, count) + np.arange(count.sum())
        key = np.repeat(doc, count) << 32 | self.memo.pairs[at]
        times = self.memo.times[at] * np.repeat(repeats, count)
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        pairs = key[new]
        return pairs & 0xFFFFFFFF, np.add.reduceat(times, new), np.searchsorted(pairs >> 32, np.arange(docs + 1)).tolist()


_READY: dict[str, Aligner] = {}


def _aligner(name: str, parts: tuple) -> Aligner:
    """The worker's aligner of these tokenizers; later tasks of the worker find its memory warm."""
    if name not in _READY:
        _READY.clear()
        _READY[name] = Aligner(*parts)
    return _READY[name]


def _chunks(values: pa.Array) -> Iterator[list[str]]:
    chunk, size = [], 0
    for v in values:
        chunk.append(v.as_py() or "")
        size += len(chunk[-1])
        if size >= CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def alignments(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: ``doc_id, row, n_a, n_b, n_groups, n_links, groups, pairs, times``.

    A (a byte-level BPE file, 65,535 ids at most, merged as ranks) encodes space + text, B (a sentencepiece model, which adds the space
    itself) the text, both whole and without special tokens.  ``groups`` are the ids between places where a token of
    each ends at the same byte, as ``a1,a2|b1;a3|b2,b3``.  ``pairs`` are the distinct pairs linked by sharing a group
    (A id in the upper 16 bits of an int), ``times`` how often each is.  Null and empty texts, and texts whose tokens
    of either side do not give back space + text, have no tokens: zeros, '' and empty arrays.  ``row`` is unique.
    Other columns are left out; repeated rows and null keys are rows like any other.

    Shared ends that stand before a space-marked token of both sides cut a text into windows of some words; a window
    met before costs a look-up by its id tuples.  Windows between anchors are never cut, so a text without spaces is
    one window.  Both files are read on the driver and broadcast (a few MB).  No shuffle; a lost executor costs its
    own batches.
    """
    table_a = _bytes_of_letters(path_a)
    with open(path_b, "rb") as f:
        model = f.read()
    name = hashlib.sha256(b"\0".join(table_a) + model).hexdigest()
    shipped = docs.sparkSession.sparkContext.broadcast((_Side(table_a), model, _Side(_bytes_of_pieces(model))))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, row long, n_a long, n_b long, n_groups long, n_links long, groups string, "
              "pairs array<int>, times array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()        # no cycles are made, and walking the remembered windows costs a third of the time
        try:
            aligner = _aligner(name, shipped.value)
            row = TaskContext.get().partitionId() << 40
            for batch in batches:
                at = 0
                for chunk in _chunks(batch.column(1)):
                    n = len(chunk)
                    found = aligner.align(chunk)
                    ends = np.cumsum([0] + [len(f[5]) for f in found]).astype(np.int32)
                    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(
                        np.concatenate([f[c] for f in found]).astype(np.uint32).view(np.int32))) for c in (5, 6)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(at, n), pa.array(np.arange(row, row + n)),
                         *[pa.array([f[c] for f in found], pa.int64()) for c in range(4)],
                         pa.array([f[4] for f in found], pa.string()), *lists],
                        ["doc_id", "row", *COUNTS, "groups", "pairs", "times"])
                    at, row = at + n, row + n
        finally:
            gc.enable()

    return rows.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n_docs, best``: documents that hold the pair linked, and whether its A id has no pair with more."""
    counted = materialise(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair")
                          .agg(F.count(F.lit(1)).alias("n_docs")), "pair-counts")
    a = F.shiftrightunsigned("pair", 16)
    tops = counted.groupBy(a.alias("a")).agg(F.max("n_docs").alias("top"))     # at most A's vocabulary
    return materialise(counted.withColumn("a", a).join(F.broadcast(tops), "a")
                       .select("pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best")), "pairs")


def scored(aligned: DataFrame, *, frequent_pairs: int = FREQUENT_PAIRS) -> DataFrame:
    """Replaces ``pairs`` and ``times`` of written alignments by ``n_best`` and ``count_sum``.

    ``n_best`` counts the links whose pair has the most documents of all pairs of its A id (ties included);
    ``count_sum`` sums the documents of the pair over the links.

    Pairs of at least so many documents that no more than ``frequent_pairs`` have as many are looked up in a broadcast
    table; as they make up most links, what is left for the shuffle join are pairs of few documents each, which no key
    dominates.  Both ways add up, so the bound decides the plan and not the result.
    """
    counts = pair_counts(aligned)
    sizes = counts.groupBy(F.floor(F.log2("n_docs")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("power")).collect()                                     # at most 64 rows
    total, least, rest = 0, None, False
    for s in sizes:
        total += s.n
        if total > frequent_pairs:
            rest = True
            break
        least = 1 << s.power
    links = aligned.where(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")) \
        .select("row", F.col("link.pairs").alias("pair"), F.col("link.times").cast("long").alias("times"))
    found = None
    if least is not None:
        often = counts.where(F.col("n_docs") >= least)
        found = links.join(F.broadcast(often), "pair", "left" if rest else "inner")
    if rest:
        if found is None:
            found = links.join(counts, "pair")
        else:
            rare = found.where("n_docs IS NULL").drop("n_docs", "best").join(counts.where(F.col("n_docs") < least), "pair")
            found = found.where("n_docs IS NOT NULL").unionByName(rare)
    if found is None:
        found = links.join(counts, "pair")
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n_docs") * F.col("times")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(sums, "row", "left").withColumns({
        "n_best": F.coalesce("n_best", zero), "count_sum": F.coalesce("count_sum", zero)}).drop("row")
