from collections import Counter
from functools import cache

import public_tokenizers
import sentencepiece
from panelyard.llm import alignment
from panelyard.llm.queries import BYTE_VOCABULARY, PIECE_MODEL, QUERIES
from panelyard.session import materialise
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_helpers import sha

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@cache
def bytes_a(i):
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown}
    letters.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)})
    return bytes(letters[c] for c in A.id_to_token(i))


@cache
def bytes_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def brute(text):
    """Ids of A, of B, groups and all linked occurrence pairs."""
    if not text:
        return [], [], [], []
    a, b, raw = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text), (" " + text).encode()
    if b"".join(map(bytes_a, a)) != raw or b"".join(map(bytes_b, b)) != raw:
        return [], [], [], []
    ends = []
    for ids, sizes in ((a, bytes_a), (b, bytes_b)):
        at, out = 0, []
        for i in ids:
            at += len(sizes(i))
            out.append(at)
        ends.append(out)
    number = {end: n for n, end in enumerate(sorted(set(ends[0]) & set(ends[1])))}
    groups = [([], []) for _ in number]
    for side, ids in enumerate((a, b)):
        n = 0
        for i, end in zip(ids, ends[side]):
            groups[n][side].append(i)
            n += end in number
    return a, b, groups, [(x, y) for g, h in groups for x in g for y in h]


def expected(texts):
    found = [brute(t) for t in texts]
    counts = Counter(p for f in found for p in set(f[3]))
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    written = [";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in f[2]) for f in found]
    return [(len(a), len(b), len(g), len(links), sum(counts[p] == top[p[0]] for p in links),
             sum(counts[p] for p in links), sha(w) if a else "") for (a, b, g, links), w in zip(found, written)]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = ["two words", "two words", " leading and  double   blanks ", "tab\tand\nline\r\n", "▁ mark of its own", "é ü ß 漢字かな 😀😀",
       "<|endoftext|> and <s> </s> <0x41> <unk>", "a\0b", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", " ", "\n\n\n", "I'll can't won't", "1234567 89"]


def run(docs, **options):
    rows = alignment.alignments(docs, BYTE_VOCABULARY, PIECE_MODEL)
    stored = materialise(rows.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(""))
                         .drop("groups"), "alignments")
    return alignment.scored(stored, **options).collect()


def test_alignment_matches_brute_force(docs_of, odd_texts):
    texts = [t for _, t in odd_texts] + ODD
    docs = docs_of([(i, t) for i, t in enumerate(texts)])
    want = {i: e for i, e in enumerate(expected(texts))}
    # the number of broadcast pairs decides the plan, not the result
    for frequent in (0, 40, 10_000):
        got = {r.doc_id: tuple(r[n] for n in NAMES) for r in run(docs, frequent_pairs=frequent)}
        assert got == want
    assert want[texts.index("▁ mark of its own")][:2] == (0, 0)


def test_repeated_keys_null_keys_and_clashing_columns(docs_of, odd_texts, clashing):
    got = run(clashing(docs_of(odd_texts)))
    assert Counter((r.doc_id, *(r[n] for n in NAMES)) for r in got) == Counter(
        (k, *e) for (k, _), e in zip(odd_texts, expected([t for _, t in odd_texts])))


def test_no_rows(docs_of):
    assert run(docs_of([])) == []
    assert [r.n_a for r in run(docs_of([(1, None), (2, "")]))] == [0, 0]


def test_long_text_without_spaces_and_forgotten_windows(monkeypatch):
    table = alignment._bytes_of_letters(BYTE_VOCABULARY)
    with open(PIECE_MODEL, "rb") as f:
        model = f.read()
    sides = alignment._Side(table), alignment._Side(alignment._bytes_of_pieces(model))
    monkeypatch.setattr(alignment, "MEMO_WINDOWS", 3)
    aligner = alignment.Aligner(sides[0], model, sides[1])
    texts = ["x9Q" * 20_000, "one two three four five six", "three four five six seven one"] * 2
    for t in texts:
        a, b, groups, links = brute(t)
        found = aligner.align([t])[0]
        assert found[:4] == (len(a), len(b), len(groups), len(links))
        assert dict(zip(found[5].tolist(), found[6].tolist())) == Counter(x << 16 | y for x, y in links)


def test_ids_are_those_of_the_tokenizers_library():
    """Code points of all scripts alone, in runs, and beside letters, digits, blanks and signs."""
    encode = alignment.Aligner(alignment._Side(alignment._bytes_of_letters(BYTE_VOCABULARY)), open(PIECE_MODEL, "rb").read(),
                               alignment._Side([])).a.encode_ordinary
    points = [*range(0xD800), *range(0xE000, 0x30000, 3), *range(0xE0000, 0xE0200)]
    texts = ["".join(" a%sb 1%s%s %s  %s'%s" % ((chr(c),) * 6) for c in points[i:i + 50]) for i in range(0, len(points), 50)]
    texts += [" " * 9_999 + "x", "\n" * 9_999, " \n" * 5_000 + "q", "<|endoftext|>" * 5]
    assert [encode(t) for t in texts] == [e.ids for e in A.encode_batch(texts, add_special_tokens=False)]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in QUERIES["op13_alignment"](spark, sf).collect()}
    assert got == {r.doc_id: e for r, e in zip(rows, expected([r.text for r in rows]))}
