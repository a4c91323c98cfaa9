"""Toxicity: a support vector machine on a gapped subsequence kernel with Nystroem landmarks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each class that a fit reads at most (those with the smallest hash), and their longest text.
SAMPLE_DOCS, SAMPLE_CHARS = 2_000, 20_000
LANDMARKS = 256             # words the kernel is expanded on, at most
LETTERS, SPAN = 3, 5        # a subsequence's letters and the most characters it may stretch over
DECAY = 0.7                 # for each skipped character
BUCKET_BITS = 20
CHUNK_CHARS, CACHE_WORDS = 1_000_000, 100_000

_STEPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_MULTIPLIERS = tuple(np.uint32(m) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))


_ENDS = re.compile(r"[.!?\n]+")


def bare(word: str) -> str:
    """A word without the signs around it or put between its letters."""
    return word if word.isalnum() else "".join(filter(str.isalnum, word))


def words_of(text: str) -> list[str]:
    return text.lower().split()


class Features:
    """Gapped subsequences of many words: for each (first, second, third letter) in reach, its bucket and weight.

    Words are framed by marks, so a subsequence can hold to a word's start or end.
    """

    def __init__(self, words: list[str]):
        flat = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode("utf-32-le", "surrogatepass"),
                             np.uint32)
        self.n = len(words)
        word = np.repeat(np.arange(self.n, dtype=np.int32), np.fromiter(map(len, words), np.int64, self.n) + 2)
        first, second, third = (flat * m for m in _MULTIPLIERS)
        self.parts, norm = [], np.zeros(self.n)
        for a, b in _STEPS:
            at = np.flatnonzero(word[b:] == word[:-b])
            mixed = first[at] ^ (second[at + a] << np.uint32(7)) ^ (third[at + b] << np.uint32(13))
            mixed = (mixed ^ (mixed >> np.uint32(15))) * _MULTIPLIERS[0]
            weight = DECAY ** (b - LETTERS + 1)
            self.parts.append((word[at], mixed >> np.uint32(32 - BUCKET_BITS), weight))
            norm += weight * weight * np.bincount(word[at], minlength=self.n)
        self.norm = np.sqrt(np.maximum(norm, 1e-12))

    def dot(self, table: np.ndarray) -> np.ndarray:
        """Each word's normalised features times a weight table."""
        out = np.zeros(self.n)
        for word, bucket, weight in self.parts:
            out += weight * np.bincount(word, table[bucket], minlength=self.n)
        return out / self.norm

    def dense(self, place: np.ndarray, width: int) -> np.ndarray:
        """Normalised features over ``width`` chosen buckets; ``place`` gives a bucket's column, or -1."""
        out = np.zeros(self.n * width)
        for word, bucket, weight in self.parts:
            column = place[bucket]
            some = column >= 0
            out += weight * np.bincount(word[some] * np.int64(width) + column[some], minlength=len(out))
        return out.reshape(self.n, width) / self.norm[:, None]


def _pieces(words: list[str], n: int) -> Iterator[list[str]]:
    for at in range(0, len(words), n):
        yield words[at:at + n]


def _dot(words: list[str], table: np.ndarray) -> np.ndarray:
    return np.concatenate([Features(w).dot(table) for w in _pieces(words, 20_000)] or [np.zeros(0)])


@dataclass
class Model:
    """A word's decision is ``features . table + bias``; a text's score follows from its highest decision."""

    table: np.ndarray
    bias: float
    slope: float
    centre: float

    def decisions(self, words: list[str]) -> np.ndarray:
        return _dot([bare(w) for w in words], self.table) + self.bias

    def best(self, text: str) -> float:
        words = list(set(words_of(text)))
        return float(self.decisions(words).max()) if words else self.bias - 1

    def score(self, best: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * (best - self.centre), -30, 30))))


def _machine(z: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Support vector machine with squared hinge loss, by Newton steps on its margin violators."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w, reg = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    reg[-1] = 1e-6
    for _ in range(30):
        inside = y * (x @ w) < 1
        xs, cs = x[inside], cost[inside]
        new = np.linalg.solve(np.diag(reg) + xs.T @ (xs * cs[:, None]), xs.T @ (cs * y[inside]))
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def _fit_words(bad: list[str], good: list[str], random: np.random.Generator) -> tuple[np.ndarray, float]:
    """Machine for toxic against other words, as a weight table over buckets.

    Landmarks are words of both kinds.  The kernel to them is a product of features, so the expansion on landmarks
    folds into one weight for each bucket: scoring costs the same for any number of landmarks.  Negatives are a
    random part of the other words, then twice those that came out worst.
    """
    def pick(words: list[str], n: int) -> list[str]:
        return words if len(words) <= n else [words[i] for i in random.choice(len(words), n, replace=False)]

    land = pick(bad, LANDMARKS // 2) + pick(good, LANDMARKS // 2)
    features = Features(land)
    used = np.unique(np.concatenate([p[1] for p in features.parts]))
    place = np.full(1 << BUCKET_BITS, -1, np.int64)
    place[used] = np.arange(len(used))
    rows = features.dense(place, len(used))
    values, vectors = np.linalg.eigh(rows @ rows.T)
    sound = values > 1e-6 * values.max()
    maps = (vectors[:, sound] / np.sqrt(values[sound])).T @ rows     # K^(-1/2) of the landmarks, over buckets

    def expand(words: list[str]) -> np.ndarray:
        return np.vstack([Features(w).dense(place, len(used)) @ maps.T for w in _pieces(words, 1_000)])

    z_bad, chosen = expand(bad), pick(good, 3_000)
    z_good = expand(chosen)
    for turn in range(3):
        y = np.r_[np.ones(len(bad)), -np.ones(len(chosen))]
        cost = np.r_[np.full(len(bad), 10.0 * max(1.0, len(chosen) / len(bad) / 10)), np.full(len(chosen), 10.0)]
        w = _machine(np.vstack([z_bad, z_good]), y, cost)
        table = np.zeros(1 << BUCKET_BITS)
        table[used] = w[:-1] @ maps
        if turn < 2:
            taken = set(chosen)
            worst = [good[i] for i in np.argsort(-_dot(good, table))[:1_500] if good[i] not in taken]
            if not worst:
                break
            chosen, z_good = chosen + worst, np.vstack([z_good, expand(worst)])
    return table, float(w[-1])


def _sentences(text: str) -> set[str]:
    return {s.strip() for s in _ENDS.split(text.lower())} - {""}


def fit(texts: list[str], toxic: list[int], seed: int = 7) -> Model:
    """Fits on labelled texts; without texts of both labels every score is near 0.

    Sentences take the label of their text, and a sentence of any clean text is clean.  Each distinct sentence counts
    once, so copies of a text weigh no more than one.  A toxic sentence need only hold a toxic word: the first guess
    takes words used in so many toxic sentences, and no clean one, that chance is ruled out (or else the most used);
    then, twice, the machine's own best words of the toxic texts take their place.  A quarter of the texts is held
    back to place the threshold and the slope of the score.
    """
    random = np.random.default_rng(seed)
    label = np.asarray(toxic, int)
    nothing = Model(np.zeros(1 << BUCKET_BITS), -1.0, 30.0, 1.0)
    if len(set(label.tolist())) < 2:
        return nothing
    back = np.arange(len(texts)) % 4 == 3
    for c in (0, 1):                     # few texts of a label are all learned from
        if (label == c).sum() < 16 or not ((label == c) & back).any():
            back[label == c] = False
    clean: set[str] = set()
    for i in np.flatnonzero(~back & (label == 0)):
        clean |= _sentences(texts[i])
    suspect: set[str] = set()
    for i in np.flatnonzero(~back & (label == 1)):
        suspect |= _sentences(texts[i])
    suspect -= clean
    innocent = {bare(w) for s in clean for w in s.split()} if clean else set()
    uses: dict[str, int] = {}
    for s in suspect:
        for w in {bare(w) for w in s.split()} - innocent - {""}:
            uses[w] = uses.get(w, 0) + 1
    ranked = sorted(uses, key=lambda w: (-uses[w], w))
    if not ranked or not innocent:
        return nothing
    share = len(suspect) / (len(suspect) + len(clean))
    least = max(2, int(np.ceil(np.log(1e-4 / len(ranked)) / np.log(share))))
    bad = [w for w in ranked if uses[w] >= least] or [w for w in ranked if uses[w] == uses[ranked[0]]]
    bad, good = bad[:1_000], sorted(innocent)
    bags = [[w for w in sorted(set(words_of(texts[i]))) if bare(w) not in innocent]
            for i in np.flatnonzero(~back & (label == 1))]
    for turn in range(3):
        table, bias = _fit_words(bad, good, random)
        if turn == 2:
            break
        witnesses: set[str] = set()
        for words in filter(None, bags):
            d = Features(words).dot(table) + bias
            witnesses |= {bare(words[j]) for j in np.argsort(-d)[:5] if d[j] > 0}
        bad = sorted(witnesses - {""})[:2_000] or bad
    model = Model(table, bias, 1.0, 0.0)
    judged = np.flatnonzero(back) if len(set(label[back].tolist())) == 2 else np.arange(len(texts))
    best = np.array([model.best(texts[i]) for i in judged])
    truth = label[judged]
    cuts = np.unique(best)
    middles = np.r_[cuts[0] - 0.1, (cuts[1:] + cuts[:-1]) / 2, cuts[-1] + 0.1]
    wrong = np.array([((best >= m) != (truth == 1)).sum() for m in middles])
    least_wrong = middles[wrong == wrong.min()]
    model.centre = float(least_wrong[np.abs(least_wrong).argmin()])
    model.slope = float(np.clip(4 / max(1e-3, np.abs(best - model.centre).mean()), 1, 50))
    return model


def held_out(key: Column) -> Column:
    """A fifth of the keys, by checksum, is never learned from (null keys are)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic", *,
          sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Fits on at most ``sample_docs`` documents of each label, none of them held out, of at most ``sample_chars``.

    A document with several labels counts as toxic if one says so; null labels and null keys are ignored.
    """
    usable = labels.where(F.col(toxic).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(
        F.col(key).alias("label_key")).agg(F.max(toxic).cast("int").alias("label"))
    order = F.xxhash64("label_key")
    short = docs.where(F.length(text) <= sample_chars)
    known = usable.join(short.select(F.col(key).alias("label_key")).distinct(), "label_key", "left_semi")
    part = lambda c: known.where(F.col("label") == c).orderBy(order, "label_key").limit(sample_docs)
    chosen = part(0).unionByName(part(1))
    rows = short.select(F.col(key).alias("label_key"), F.col(text).alias("body")).join(
        F.broadcast(chosen), "label_key").groupBy("label_key", "label").agg(F.min("body").alias("body")).collect()
    rows.sort(key=lambda r: (r.label_key * 2654435761 % (1 << 32), r.label_key))
    return fit([r.body for r in rows], [r.label for r in rows])


def score(docs: DataFrame, model: Model, text: str = "text", target: str = "score") -> DataFrame:
    """Adds the score (0 to 1) of every whole text; an existing column of the name is replaced.

    Each distinct word of a batch is judged once; null and empty texts get what a text without any toxic letter gets.
    The model is a fixed-size table, so broadcasting it is safe; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.drop(target)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema] + [f"`{target}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, {}

        def judged(bags: list[set[str]]) -> list[float]:
            if len(known) > CACHE_WORDS:
                known.clear()
            new = list(set().union(*bags).difference(known))
            if new:
                known.update(zip(new, model.decisions(new).tolist()))
            return [model.score(max(map(known.__getitem__, bag), default=model.bias - 1)) for bag in bags]

        for batch in batches:
            out, bags, size = [], [], 0
            for value in batch.column(batch.num_columns - 1):
                body = value.as_py() or ""
                bags.append(set(words_of(body)))
                size += len(body)
                if size >= CHUNK_CHARS:
                    out += judged(bags)
                    bags, size = [], 0
            out += judged(bags) if bags else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())],
                                             [*batch.schema.names[:-1], target])

    return base.withColumn("text_to_score", F.col(text)).mapInArrow(run, schema)
