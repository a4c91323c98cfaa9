import base64
import math
import random
from collections import Counter

import numpy as np
import pytest
from panelyard.llm import digests
from panelyard.llm.queries import QUERIES

from llm_helpers import sha


def naive_weight(window):
    return sum(round(64 * c * math.log2(c)) for c in Counter(window).values())


def naive_features(raw, ranks):
    """Windows of the text that enough neighbourhoods choose, by loops."""
    windows = [raw[i:i + 16] for i in range(len(raw) - 15)]
    rank = [ranks[naive_weight(w)] for w in windows]
    votes = Counter()
    for i in range(len(windows) - 15):
        best = min(range(i, i + 16), key=lambda j: (rank[j], j))
        if rank[best] < digests.WEIGHTS:
            votes[best] += 1
    if not votes:
        return [raw] if raw else []
    enough = min(digests.POPULAR, max(votes.values()))
    return list(dict.fromkeys(windows[i] for i in sorted(votes) if votes[i] >= enough))


def texts_of(seed, n=40):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    return [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 10, 100, 700]))) for _ in range(n)]


def ranks_for(texts):
    counts = Counter(naive_weight(t.encode()[i:i + 16]) for t in texts for i in range(len(t.encode()) - 15))
    full = np.array([counts[w] for w in range(digests.WEIGHTS)])
    assert (digests.weight_counts([t.encode() for t in texts]) == full).all()
    return digests.ranks_of(full)


def test_weights_and_features_match_naive_loops(monkeypatch):
    texts = texts_of(1) + ["", "x", "a" * 500, "ab" * 40 + " odd tail of some more words", "0123456789abcdef" * 3, "y" * 31]
    ranks = ranks_for(texts)
    for size in (1 << 20, 64):          # slices of a long text give the same
        monkeypatch.setattr(digests, "SLICE", size)
        made = digests.Digester(ranks).digest(texts)
        assert [d.n for d in made] == [len(naive_features(t.encode(), ranks)) for t in texts]
        assert [len(d.filters) for d in made] == [-(-d.n // 160) for d in made]
    alone = digests.Digester(ranks).digest(texts[:1] + texts[-3:])
    assert [d.written() for d in alone] == [made[i].written() for i in (0, -3, -2, -1)]
    assert [digests.Digest.read(d.written()).written() for d in made] == [d.written() for d in made]


def test_ranks_prefer_rare_weights_and_leave_out_plain_windows():
    counts = np.zeros(digests.WEIGHTS, int)
    counts[[100, 200, 4096]] = 50, 3, 1
    ranks = digests.ranks_of(counts)
    assert ranks[200] < ranks[100] and ranks[150] < ranks[200] and ranks[4096] == digests.WEIGHTS


def test_likeness_follows_shared_features():
    texts = [t for t in texts_of(2, 200) if len(t) > 300]
    digester = digests.Digester(ranks_for(texts))
    near, far = [], []
    for a, b in zip(texts, texts[1:]):
        x, y, z = digester.digest([a, b, digests.edited(a, b)])
        assert digests.likeness(x, x) == 1 and digests.likeness(x, y) == digests.likeness(y, x)
        near.append(digests.likeness(x, z))
        far.append(digests.likeness(x, y))
    assert min(near) > max(far) and 0.5 < np.mean(near) < 0.85 and np.mean(far) < 0.2
    empty, = digester.digest([""])
    assert digests.likeness(empty, empty) == 1 and digests.likeness(empty, x) == 0


def ordered(rows):
    """Next texts of rows without repeated keys."""
    last = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return {last[i][0]: last[(i + 1) % len(last)][1] or "" for i in range(len(last))}


@pytest.mark.parametrize("range_bytes", [1 << 24, 100])
def test_edits_compared(docs_of, clashing, odd_texts, range_bytes):
    rows = [(i, t) for i, (_, t) in enumerate(odd_texts)] + [(None, "a document without a key, " * 9)] + [
        (100 + i, t) for i, t in enumerate(texts_of(3))]
    rows += [(500, rows[-1][1]), (499, rows[-1][1]), (-7, "négatif 漢字 😀 " * 20)]
    nexts = ordered(rows)
    got = digests.edits_compared(clashing(docs_of(rows)), range_bytes=range_bytes).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        text = dict(rows)[r.doc_id] or ""
        changed = digests.edited(text, nexts[r.doc_id])
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(changed))
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert by_text.setdefault(changed, r.edited_fingerprint) == r.edited_fingerprint
        assert (r.near_next == 1) if text == nexts[r.doc_id] else 0 <= r.near_next <= 1
    assert {r.near_next for r in got if r.doc_id == 500} == {1.0}
    assert by_text[""] == "0:"


def test_repeated_rows_single_row_and_no_rows(docs_of):
    assert digests.edits_compared(docs_of([])).collect() == []
    one, = digests.edits_compared(docs_of([(4, "only one document")])).collect()
    assert one.near_next == 1 and one.edited_sha256 == sha("only one doc" + "only ")
    same = [(5, "the same row again and again")] * 7 + [(None, None)] * 3
    got = digests.edits_compared(docs_of(same), range_bytes=10).collect()
    assert Counter(r.doc_id for r in got) == {5: 7, None: 3}


def test_fingerprint_column_and_rarity(docs_of):
    texts = texts_of(4) + ["", None]
    docs = docs_of(list(enumerate(texts)))
    ranks = digests.rarity(docs)
    assert (ranks == ranks_for([t or "" for t in texts])).all()
    got = {r.doc_id: r.fingerprint for r in digests.fingerprint(docs, ranks).collect()}
    made = digests.Digester(ranks).digest([t or "" for t in texts])
    assert got == {i: d.written() for i, d in enumerate(made)}
    assert len(base64.b64decode(got[0].split(":")[1])) % 256 == 0


def test_query_matches_the_order(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    nexts, texts = ordered(rows), dict(rows)
    got = QUERIES["op12_digest"](spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.edited_sha256 == sha(digests.edited(texts[r.doc_id] or "", nexts[r.doc_id]))
    long = [r for r in got if r.n_chars > 200 and r.near_next < 1]
    assert sum(r.near_edited > r.near_next for r in long) > 0.98 * len(long)
