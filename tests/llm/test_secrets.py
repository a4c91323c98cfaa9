import random
import re
import time

from panelyard.llm import secrets
from panelyard.llm.queries import QUERIES
from panelyard.llm.secrets import joined, scan
from pyspark.sql import functions as F

PATTERNS = [("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24)]


def base_brute(text):
    spans = [(m.start(), k, m.end(), kind) for k, (kind, p, g, n) in enumerate(PATTERNS)
             for m in re.finditer(p, text or "") if len(m[g]) >= n]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))


KEY, RANDOM = "ASIA" + "Q7" * 8, "x9Fq" * 6


def found(docs_of, texts):
    rows = scan(docs_of(list(enumerate(texts)))).select("doc_id", joined(F.col("base")).alias("b"),
                                                       joined(F.col("linked")).alias("l")).collect()
    return {r.doc_id: (r.b, r.l) for r in rows}


def test_base_spans_match_brute_force(docs_of, odd_texts):
    texts = [t for _, t in odd_texts] + [
        "password=abcdef", "Api_Key : 'short' token=longer1", "secret=token:abcdefg", "😀 é token = \"q1w2e3r4\" tail",
        "AKIA" + "A" * 15, "AKIA" + "A" * 16 + "AKIAAKIA", "f" * 23, "f" * 24 + "g" + "0" * 30, "password" + " " * 50 + "x",
        "token=" + "ab12" * 10 + ", " + "passwd:'" + "9" * 6 + "'", "x" * 1000 + " secret=abcdefgh " * 300]
    got = found(docs_of, texts)
    assert {i: base_brute(t) for i, t in enumerate(texts)} == {i: b for i, (b, _) in got.items()}


def test_weak_parts_need_their_complement(docs_of):
    far = " filler" * 60
    texts = [KEY, RANDOM, f"{KEY} and {RANDOM}", f"{RANDOM} then {KEY}", f"{KEY}{far} {RANDOM}", "https://db.example.org/x",
             f"https://db.example.org/x {KEY} {RANDOM}", f"https://db.example.org/x {KEY}", f"login=admin secret=abcdefgh",
             f"AKIA{'B' * 16} {RANDOM}"]
    got = found(docs_of, texts)
    kinds = {i: sorted(s.split(":")[0] for s in l.split(",") if s) for i, (_, l) in got.items()}
    assert kinds == {0: [], 1: [], 2: ["key_id", "weak_secret"], 3: ["key_id", "weak_secret"], 4: [], 5: [],
                     6: ["endpoint", "key_id", "weak_secret"], 7: [], 8: ["key_id"], 9: ["weak_secret"]}
    start, end = (int(v) for v in got[2][1].split(",")[1].split(":")[1:])
    assert texts[2][start:end] == RANDOM


def linked_brute(text, scope=200):
    """Every pair of parts compared."""
    base = [(m.start(), m.end(), k, 0 if kind == "access" else 1) for k, (kind, p, g, n) in enumerate(PATTERNS)
            for m in re.finditer(p, text) if len(m[g]) >= n]
    cross = lambda x, y: x[0] < y[1] and y[0] < x[1]
    ids = [(m.start(), m.end(), 3, 0) for m in re.finditer(secrets.IDENTIFIER, text)]
    bare = [s for s in ((m.start(), m.end(), 4, 1) for m in re.finditer(secrets.SECRET, text))
            if not any(cross(s, i) for i in ids)]
    host = re.compile(r"[a-z0-9-]+(\.[a-z0-9-]+)+:[0-9]+")
    places = [(m.start(), m.end(), 5, 2) for m in re.finditer(secrets.ENDPOINT, text)
              if "://" in m[0] or host.fullmatch(m[0])]
    weak = [w for w in ids + bare + places if not any(cross(w, b) for b in base)]
    parts, out = base + weak, []
    near = lambda w, role: any(p is not w and p[3] == role and max(w[0] - p[1], p[0] - w[1]) <= scope for p in parts)
    for w in weak:
        if all(near(w, r) for r in {0: [1], 1: [0], 2: [0, 1]}[w[3]]):
            out.append(w)
    return ",".join(f"{secrets.WEAK[k - 3]}:{a}:{b}" for a, b, k, _ in sorted(out, key=lambda w: (w[0], w[2])))


def test_linking_matches_all_pairs(docs_of):
    rng = random.Random(3)
    pieces = [KEY, RANDOM, "login=admin", "client_id: app_77", "secret=abcdefgh", "AKIA" + "B" * 16, "f" * 24, "x" * 90, " " * 70,
              "https://db.example.org/x", "db.example.org:5432", "a..b.c:80", "localhost:80", "é😀 word ", "login=" + RANDOM,
              "token=" + RANDOM, "\n"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.choice([3, 8, 20, 60, 700]))) for _ in range(60)]
    got = found(docs_of, texts)
    assert {i: linked_brute(t) for i, t in enumerate(texts)} == {i: l for i, (_, l) in got.items()}
    assert sum(bool(l) for _, l in got.values()) > 30


def test_large_texts_end_in_seconds(spark, docs_of):
    """Texts of a MB: dotted labels, findings on every line, and none."""
    line = "client_id: app_{0} secret=abcdefgh{0} db{0}.example.org:5432\n"
    texts = ["AKIA" + "A" * 16 + " password=abcdefgh " + "a." * 500_000, "".join(line.format(i) for i in range(33_400)),
             "word " * 200_000, "k" * 1_000_000, KEY + " " + "aB3" * 300_000]
    began = time.monotonic()
    rows = scan(docs_of(list(enumerate(texts)))).select("doc_id", F.size("base").alias("b"), F.size("linked").alias("l")).collect()
    assert time.monotonic() - began < 60
    assert {r.doc_id: (r.b, r.l) for r in rows} == {0: (2, 0), 1: (33_400, 66_800), 2: (0, 0), 3: (0, 0), 4: (0, 2)}


def test_columns_of_the_user_stay(docs_of):
    names = ("text_", "ids_", "secrets_", "places_", "parts_", "before_", "after_", "spans_")
    docs = docs_of([(1, "token=abcdefgh")])
    for n in names:
        docs = docs.withColumn(n, F.lit("mine"))
    row = scan(docs).first()
    assert all(row[n] == "mine" for n in names) and len(row.base) == 1


def test_clashing_columns_and_no_rows(docs_of, clashing):
    out = scan(clashing(docs_of([(1, "token=abcdefgh")])))
    assert out.select("doc_id", "base.start", "shard").first()[1] == [0]
    assert scan(docs_of([])).collect() == []


def test_query_matches_brute_force(spark):
    from llm_helpers import sha
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op7_secrets"](spark, sf).collect()
    assert len(got) == len(texts)
    assert all(r.base_sha256 == sha(base_brute(texts[r.doc_id])) for r in got)
