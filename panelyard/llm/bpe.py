"""BPE encoding and decoding in batched numpy merge rounds, with a public tokenizer's vocabulary file."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 1_000_000     # text tokenised together
CACHE_WORDS = 120_000       # runs a worker remembers; then it starts anew


class Vocabulary:
    """What the merge rounds need, as arrays; its size is that of the vocabulary file, whatever the data.

    Understands files of the kind: added tokens taken from the raw text, NFC, white space to one blank, lower case,
    words by a pattern, bytes as characters, word ends marked by a suffix, and no decoder.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or spec["decoder"] or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a tokenizer file of the kind this operator encodes")
        self.suffix = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        if len(vocab) >= 1 << 16:
            raise ValueError("symbols must fit 16 bits")
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        names = {i: t for t, i in {**vocab, **self.added}.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]


def byte_letters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, others from U+0100 on in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def merge_words(words: list[str], v: Vocabulary) -> list[bytes]:
    """Token ids of each word, as little-endian 32-bit numbers.

    All words' symbols lie in one flat array.  A round looks every neighbouring pair up among the sorted pair keys by
    binary search, takes each word's lowest rank and merges its occurrences from left to right; a pair with a new
    symbol always ranks higher than the merge that made it, so this equals merging one pair at a time.  Words without
    a pair left leave the round.
    """
    raw = [w.encode() for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    flat = np.frombuffer(b"".join(raw), np.uint8)
    symbols = v.inner[flat]
    ends = np.cumsum(sizes) - 1
    symbols[ends] = v.last[flat[ends]]
    word = np.repeat(np.arange(len(raw)), sizes)
    none = np.int64(len(v.keys))

    def ranks(at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at these places; pairs reach into no other word."""
        out = np.full(len(at), none)
        pair = at[at + 1 < len(symbols)]
        pair = pair[word[pair] == word[pair + 1]]
        key = symbols[pair] << 16 | symbols[pair + 1]
        found = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        out[np.searchsorted(at, pair)] = np.where(v.keys[found] == key, v.ranks[found], none)
        return out

    rank = ranks(np.arange(len(symbols)))
    done_word, done_symbols = [], []
    while len(symbols):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(word)]))
        open_ = best < none
        if not open_.all():
            done_word.append(word[~open_]), done_symbols.append(symbols[~open_])
            symbols, word, rank, best = symbols[open_], word[open_], rank[open_], best[open_]
            if not len(symbols):
                break
        # in a run of equal overlapping pairs every other one is merged, from the left
        where = np.flatnonzero(rank == best)
        first = np.r_[True, where[1:] != where[:-1] + 1]
        run = np.arange(len(where)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        where = where[run % 2 == 0]
        symbols[where] = v.merged[rank[where]]
        keep = np.ones(len(symbols), bool)
        keep[where + 1] = False
        symbols, word, rank = symbols[keep], word[keep], rank[keep]
        # only pairs that touch a new symbol are looked up again
        new = where - np.arange(len(where))
        mark = np.zeros(len(symbols), bool)
        mark[new] = mark[np.maximum(new - 1, 0)] = True
        touched = np.flatnonzero(mark)
        rank[touched] = ranks(touched)
    if not done_word:
        return []
    word, symbols = np.concatenate(done_word), np.concatenate(done_symbols)
    order = np.argsort(word, kind="stable")
    ends = (4 * np.cumsum(np.bincount(word, minlength=len(raw)))).tolist()
    packed = symbols[order].astype("<u4").tobytes()
    return [packed[i:j] for i, j in zip([0, *ends], ends)]


class Encoder:
    """Encodes texts; remembers runs between white space, up to ``CACHE_WORDS`` of them."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.words = regex.compile(v.pattern)
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(v.added, key=len, reverse=True))) + ")")
        self.fixed = {t: np.array([i], "<u4").tobytes() for t, i in v.added.items()}
        # added tokens are known under a name with a blank, which no run has
        self.marks = {" " + t: ids for t, ids in self.fixed.items()}
        self.known = dict(self.marks)

    def split(self, text: str) -> list[str]:
        """Runs between white space; no word of the pattern crosses it.  An added token is an item of its own."""
        if not any(t in text for t in self.fixed):
            return self._runs(text)
        out: list[str] = []
        for part in self.parts.split(text):
            out += [" " + part] if part in self.fixed else self._runs(part)
        return out

    def _runs(self, text: str) -> list[str]:
        if not text.isascii():
            # lower case goes by character: no final sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):        # white space to Python, but not to the pattern
            return self.words.findall(text)
        return text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        split = [self.split(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known = dict(self.marks)
        new = list(set().union(*split).difference(self.known))
        pieces = [self.words.findall(run) for run in new]
        words = list(set().union(*pieces))
        ids = dict(zip(words, merge_words(words, self.v)))
        self.known.update(zip(new, (b"".join(map(ids.__getitem__, p)) for p in pieces)))
        return [b"".join(map(self.known.__getitem__, runs)) for runs in split]


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


def _appended(df: DataFrame, source: str, target: str, kind: str, make) -> DataFrame:
    """``df`` with the column ``target`` computed from ``source`` batch by batch; ``make`` builds the function."""
    df = df.drop(target)
    name = "source_column"
    shipped = df.withColumn(name, F.col(source))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{target}` {kind}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            values, rest = batch.column(batch.num_columns - 1), batch.columns[:-1]
            at = 0
            for out in work(values):
                part = [c.slice(at, len(out)) for c in rest] + [out]
                yield pa.RecordBatch.from_arrays(part, [*batch.schema.names[:-1], target])
                at += len(out)

    return shipped.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of every whole text as packed little-endian 32-bit numbers (binary).

    As the tokenizers library does without adding special tokens, truncation or padding (code points that only a
    newer Unicode version assigns may be classed otherwise).  Null and empty texts have
    no ids.  An existing column ``ids`` is replaced.  The vocabulary is read on the driver and broadcast: a few MB,
    whatever the data.  No shuffle; a lost executor costs its own batches.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def make():
        encoder = Encoder(vocabulary.value)

        def work(values: pa.Array) -> Iterator[pa.Array]:
            for chunk in _chunks((v.as_py() or "") for v in values):
                yield pa.array(encoder.encode(chunk), pa.binary())

        return work

    return _appended(docs, text, ids, "binary", make)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the text of packed ids: their tokens joined by blanks, special tokens kept (the file has no decoder)."""
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def make():
        names = vocabulary.value.names

        def work(values: pa.Array) -> Iterator[pa.Array]:
            chunk, size = [], 0
            for v in values:
                numbers = np.frombuffer(v.as_py() or b"", "<u4").tolist()
                chunk.append(" ".join(map(names.__getitem__, numbers)))
                size += len(chunk[-1])
                if size >= CHUNK_CHARS:
                    yield pa.array(chunk, pa.string())
                    chunk, size = [], 0
            if chunk:
                yield pa.array(chunk, pa.string())

        return work

    return _appended(df, ids, decoded, "string", make)
