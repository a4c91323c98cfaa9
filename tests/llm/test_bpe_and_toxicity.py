import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelyard.llm import bpe, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rnd = random.Random(1)
    out = ["Hello  World\n it's I'LL don't", "<|endoftext|>a<|startoftext|> b <|ENDOFTEXT|>", "É é İstanbul ΑΣ ΟΔΟΣ. ß",
           "a\xa0b​c\x1cd\x85e　f", "123 4.5!?", "😀\x00x", "a" * 3000, "ab" * 2000 + " <|" * 50, "***\t&&&", "x" * 9 + "\n"]
    alphabets = (range(32, 127), range(192, 592), range(0x3041, 0x3097), (32, 97, 39))
    for _ in range(150):
        out.append("".join(chr(rnd.choice(rnd.choice(alphabets))) for _ in range(rnd.randrange(1, 60))))
    return out


def test_ids_and_text_equal_the_library(spark, docs_of, odd_texts, library, clashing):
    rows = odd_texts + list(enumerate(texts(), 100))
    df = clashing(docs_of(rows))
    got = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)
        assert r.shard == "x"
    assert bpe.encode(docs_of([]), PATH).collect() == []


def test_words_are_forgotten_and_learned_again(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    encoder = bpe.Encoder(bpe.Vocabulary(PATH))
    for t in texts()[:40]:
        assert np.frombuffer(encoder.encode([t])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


INSULTS = "blockhead nitwit dunderhead numbskull".split()


def corpus(n, seed):
    rnd = random.Random(seed)
    plain = ["".join(rnd.choice("aeioutnrsl") for _ in range(rnd.randrange(2, 9))) for _ in range(400)]
    out = []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(60)]
        bad = i % 5 == 0
        for _ in range(3 * bad):
            words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS))
        for j in range(9, len(words), 10):
            words[j] += "."
        out.append((" ".join(words), int(bad)))
    return out


def test_held_out_accuracy_and_altered_words():
    data = corpus(600, 4)
    model = toxicity.fit([t for t, _ in data[:400]], [y for _, y in data[:400]])
    said = [int(model.score(model.best(t)) >= 0.5) for t, _ in data[400:]]
    assert np.mean([s == y for s, (_, y) in zip(said, data[400:])]) >= 0.97
    for word in ("nit-wit", "n.i.t.w.i.t", "blockheads", "Dunderhead!"):
        assert model.score(model.best(f"ate {word} lon")) >= 0.5, word
    assert model.score(model.best("ate lon rine")) < 0.5


def test_the_table_equals_the_kernel_expansion():
    words = ["nitwit", "aerial", "wit", "nit"]
    table = np.random.default_rng(0).normal(size=1 << toxicity.BUCKET_BITS)
    place = np.arange(1 << toxicity.BUCKET_BITS)
    used = np.unique(np.concatenate([p[1] for p in toxicity.Features(words).parts]))
    place[:] = -1
    place[used] = np.arange(len(used))
    dense = toxicity.Features(words).dense(place, len(used))
    assert np.allclose(dense @ table[used], toxicity.Features(words).dot(table))


def test_training_never_reads_held_out_rows(spark, docs_of, clashing):
    data = corpus(300, 9)
    docs = docs_of([(i, t) for i, (t, _) in enumerate(data)] + [(None, "x"), (1000, None), (1001, ""), (1001, "")])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)] + [(None, 1), (1000, 0), (5, None), (7, 1)],
                                   "doc_id long, toxic int")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert (a.table == b.table).all() and a.centre == b.centre
    scored = toxicity.score(clashing(docs), a).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert all(r.score < 0.5 for r in scored if not (r.text or "").strip())
    nothing = toxicity.train(docs, labels.where("false"))
    assert all(r.score < 0.5 for r in toxicity.score(docs, nothing).collect())
    assert toxicity.score(docs_of([]), a).collect() == []
