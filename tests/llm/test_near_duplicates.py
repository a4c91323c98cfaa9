import random
import re

import numpy as np
import pytest
import xxhash

from panelyard.llm.components import components, local_stars
from panelyard.llm.line_dedup import dedup_lines, one_edit, variants
from panelyard.llm import simhash
from panelyard.llm.simhash import (anchors_of, fingerprint, keep_one, keep_one_similar, near_classes, near_links,
                                   similar_classes)
from panelyard.llm.vectors import build_index, near_vectors


def roots_brute(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    links += [(2000, 2000 + i) for i in range(1, 200)] + [(5, 5)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: r for n, r in roots_brute(nodes, links).items()}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    a, b = local_stars(np.array([5, 9, 2]), np.array([9, 7, 3]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(2, 3), (5, 7), (5, 9)]


def fingerprint_brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd_texts):
    texts = [t for _, t in odd_texts] + ["A b", "a b c d", "É Ab\x0bC\x1cd e  f", "x " * 40_000]
    for t in texts:
        assert fingerprint((t or "").encode()) & (1 << 64) - 1 == fingerprint_brute(t)


def test_anchors_cover_every_pair_within_two_bits_of_a_half():
    rnd = np.random.default_rng(0)
    for _ in range(300):
        x = int(rnd.integers(0, 1 << 63))
        flips = rnd.choice(64, 4, replace=False)
        y = x
        for f in flips:
            y ^= 1 << int(f)
        a = set(anchors_of(np.array([x], np.uint64))[0].tolist())
        b = set(anchors_of(np.array([y], np.uint64))[0].tolist())
        assert a & b and len(a) <= 32


@pytest.mark.parametrize("group_rows", [4, 4096])
def test_links_match_brute_force(spark, group_rows):
    rnd = random.Random(1)
    centres = [rnd.getrandbits(64) for _ in range(30)]
    fps = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(7))) for c in centres for _ in range(12)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    links = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    found = near_links(spark.createDataFrame([(f,) for f in fps], "fp long"), group_rows=group_rows)
    got = [(r.a, r.b) for r in found.collect()]
    assert roots_brute(fps, got) == roots_brute(fps, links)


def test_near_classes_and_keep_one(docs_of, odd_texts, clashing):
    base = " ".join(f"word{i}" for i in range(3000))
    rows = odd_texts + [(20, base), (21, base + " more"), (22, base.replace("word7 ", "w ")), (23, "something else here now")]
    df = clashing(docs_of(rows))
    got = near_classes(df).collect()
    assert len(got) == len(rows)
    texts = [(k, fingerprint_brute(t)) for k, t in rows]
    fps = sorted({f for _, f in texts})
    links = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 4]
    root = roots_brute(fps, links)
    smallest = {}
    for k, f in texts:
        if k is not None:
            smallest[root[f]] = min(smallest.get(root[f], k), k)
    assert sorted(map(str, ((r.doc_id, r.component_id) for r in got))) == sorted(
        map(str, ((k, smallest.get(root[f])) for k, f in texts)))
    kept = keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(root.values())) and {20, 23} <= set(ids) and not {21, 22} & set(ids)
    assert keep_one(docs_of([])).collect() == []


def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("set_rows", [6, 1024])
def test_near_copies_from_four_fifths_on(docs_of, odd_texts, clashing, set_rows):
    rnd, rows = random.Random(7), list(odd_texts)
    for base in range(60):
        words = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([9, 40, 100, 300, 1000]))]
        rows.append((100 + 10 * base, " ".join(words)))
        for copy in range(1, 7):
            share = rnd.choice([0.01, 0.02, 0.025, 0.03, 0.04, 0.06])
            rows.append((100 + 10 * base + copy, " ".join("new" + str(rnd.random()) if rnd.random() < share else w for w in words)))
    sets = {i: shingle_set(t) for i, (_, t) in enumerate(rows)}
    alike = lambda a, b: a == b or bool(a and b) and len(a & b) >= 0.8 * len(a | b)
    links = [(i, j) for i in sets for j in range(i + 1, len(rows)) if alike(sets[i], sets[j])]
    root = roots_brute(list(sets), links)
    assert sum(0.8 <= len(sets[i] & sets[j]) / len(sets[i] | sets[j]) < 0.9 for i, j in links if sets[i]) > 50
    df = clashing(docs_of(rows))
    got = {}
    for r in similar_classes(df, set_rows=set_rows).collect():
        got.setdefault(r.root, []).append(str(r.doc_id))
    want = {}
    for i, (k, _) in enumerate(rows):
        want.setdefault(root[i], []).append(str(k))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    kept = keep_one_similar(df)
    assert kept.columns == df.columns and kept.count() == len(want)


def test_wide_fingerprints_are_majorities_and_their_parts_cover_them():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, n, np.uint64) for n in (1, 2, 255, 256, 1000)]
    for x in sets:
        single = [np.unpackbits(np.frombuffer(simhash.wide_fingerprint(x[i:i + 1]), np.uint8)) for i in range(len(x))]
        got = np.unpackbits(np.frombuffer(simhash.wide_fingerprint(x), np.uint8))
        assert (got == (2 * np.sum(single, axis=0, dtype=np.int64) > len(x))).all()
        assert len(got) == 640 and 250 < got.sum() < 390 or len(x) < 3
    base = rng.integers(0, 2, 640).astype(np.uint8)
    for apart in [0, 1, 16, 31] * 50:                    # whatever the bits: fewer than 32 of 512 always share a part
        other = base.copy()
        other[128 + rng.choice(512, apart, replace=False)] ^= 1
        a, b = simhash.parts_of(np.packbits([base, other], axis=1))
        assert len(set(a) & set(b)) >= 4 and len(set(a)) == 128


def test_candidates_of_near_copies_come_from_their_fingerprints():
    rng, met, pairs = np.random.default_rng(5), 0, 400
    for _ in range(pairs):
        n = int(rng.choice([60, 200, 900]))
        both, one = rng.integers(0, 1 << 63, n, np.uint64), round(n * 0.25 / 2)          # similarity 0.8
        x, y = (np.r_[both, rng.integers(0, 1 << 63, one, np.uint64)] for _ in range(2))
        prints = np.array([np.frombuffer(simhash.wide_fingerprint(v), np.uint8) for v in (x, y)])
        a, b = simhash.parts_of(prints)
        met += bool(set(a) & set(b)) and np.bitwise_count(prints[0, :16] ^ prints[1, :16]).sum() <= simhash.LOOSE
    assert met >= pairs - 3
    prints = np.array([np.frombuffer(simhash.wide_fingerprint(rng.integers(0, 1 << 63, 99, np.uint64)), np.uint8)
                       for _ in range(300)])
    bits = np.array([np.bitwise_count(prints[i, :16] ^ prints[j, :16]).sum() for i in range(300) for j in range(i)])
    assert (bits > simhash.LOOSE).mean() > 0.9999        # texts with nothing in common are no candidates


def test_near_copies_of_no_documents(docs_of):
    assert keep_one_similar(docs_of([])).collect() == []


def test_one_edit_and_variants():
    a = b"a b c d".split()
    for other, want in ((b"a b c d", True), (b"a b x d", True), (b"a c d", True), (b"a b c d e", True), (b"x b c y", False),
                        (b"b c d e", False), (b"a b", False), (b"a b d c", False)):
        assert one_edit(a, other.split()) == want and one_edit(other.split(), a) == want
    less, _ = variants(a)
    assert int(less[1]) == variants(b"a c d".split())[1] and int(less[3]) == variants(b"a b c".split())[1]


def lines_brute(rows, least=3, near=8):
    places = []
    for doc, text in rows:
        places += [(doc is None, doc, n, tuple(line.split())) for n, line in enumerate((text or "").split("\n"))]
    places = sorted({p for p in places if len(p[3]) >= least}, key=lambda p: (p[0], p[1] or 0, p[2]))
    earlier, gone = [], set()
    for p in places:
        for q in earlier:
            if p[3] == q[3] or min(len(p[3]), len(q[3])) >= near and one_edit(list(p[3]), list(q[3])):
                gone.add((p[1], p[2]))
                break
        earlier.append(p)
    return gone


def test_lines_match_brute_force(docs_of, clashing):
    rnd = random.Random(5)
    words = [f"v{i}" for i in range(9)]
    lines = [" ".join(rnd.choice(words[:3]) for _ in range(rnd.randrange(1, 12))) for _ in range(60)]

    def edited(line):
        w = line.split()
        at = rnd.randrange(len(w))
        return " ".join(rnd.choice([w[:at] + w[at + 1:], w[:at] + ["new"] + w[at:], w[:at] + ["put"] + w[at + 1:], w]))

    rows = [(i, "\n".join(edited(rnd.choice(lines)) for _ in range(rnd.randrange(1, 9)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n \n"), (None, "a b c d e f g h i"), (103, "a b c d e f g h z\n" + "q " * 20_000)]
    got = {r.doc_id: r for r in dedup_lines(clashing(docs_of(rows))).collect()}
    gone = lines_brute(rows)
    assert gone
    for doc, text in rows:
        left = None if text is None else "\n".join(
            line for n, line in enumerate(text.split("\n")) if (doc, n) not in gone)
        assert got[doc].text == left
        assert int(got[doc].n_removed) == sum(d == doc for d, _ in gone)
    assert dedup_lines(docs_of([])).collect() == []


def test_rows_that_share_a_key_keep_their_own_lines(docs_of):
    rows = [(1, "one two three four\nfive six seven"), (1, "other words stand here\none two three four"), (None, "x y z"),
            (None, "x y z w")]
    got = sorted((str(r.doc_id), r.text) for r in dedup_lines(docs_of(rows)).collect())
    assert sum("one two three four" in t for _, t in got) == 1
    assert ("None", "x y z") in got and ("None", "x y z w") in got


def test_vectors_match_brute_force(spark, clashing):
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(60, 32))
    x = np.concatenate([centres + 0.45 * rnd.normal(size=centres.shape) * (i > 0) for i in range(6)] + [centres[:1]] * 40)
    x = x.astype(np.float32).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 32), (902, [float("nan")] + [1.0] * 31), (903, [None] + [1.0] * 31), (904, [1.0, 2.0]),
           (905, [float("inf")] * 32), (None, x[0].tolist()), (906, [])]
    df = clashing(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    for cell_rows in (16, 2048):
        got = {r.vec_id: r for r in near_vectors(df, cell_rows=cell_rows).collect()}
        links = np.array([got[i].n_links for i in range(len(x))])
        assert (links <= near.sum(1)).all() and links.sum() >= 0.97 * near.sum() and links[0] >= 40
        assert all(got[i].component_id <= i and got[i].kept == (got[i].component_id == i) for i in range(len(x)))
        assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k, _ in odd)
    assert near_vectors(df.where("vec_id > 5000")).collect() == []
    assert near_vectors(df.where("vec_id = 901")).first().n_links == 0


@pytest.mark.parametrize("kind", ["even", "decaying", "rank 8", "rank 4", "planes of their own"])
def test_probes_meet_neighbours_of_few_effective_dimensions(kind):
    rnd, n, d = np.random.default_rng(4), 8000, 64
    if kind == "even":
        x = np.repeat(rnd.normal(size=(n // 4, d)), 4, axis=0) + 0.3 * rnd.normal(size=(n, d))
    elif kind == "decaying":
        x = rnd.normal(size=(n, d)) / np.arange(1, d + 1)
    elif kind == "planes of their own":
        axes = np.linalg.qr(rnd.normal(size=(n // 40, d, 3)))[0]
        x = np.repeat(rnd.normal(size=(n // 40, d)), 40, axis=0) + np.einsum(
            "kdr,kmr->kmd", axes, 3 * rnd.normal(size=(n // 40, 40, 3))).reshape(n, d)
    else:
        x = rnd.normal(size=(n, int(kind[-1]))) @ rnd.normal(size=(int(kind[-1]), d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    home, seen = build_index(x[rnd.permutation(n)], n, 0.9).probes(x)
    a, b = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    assert len(a) > 1000 and (seen[a, home[b]] | seen[b, home[a]]).mean() >= 0.97


def test_each_vector_length_is_linked_by_itself(spark):
    rows = [(i, [1.0, float(i % 2), 0.0]) for i in range(8)] + [(20, [1.0, 2.0]), (21, [1.0, 2.0]), (22, [1.0, 2.1]),
                                                                (23, [-2.0, 1.0]), (30, [3.0]), (31, [5.0]), (32, [-1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {**{i: (3, i % 2) for i in range(8)}, 20: (2, 20), 21: (2, 20), 22: (2, 20), 23: (0, 23),
                   30: (1, 30), 31: (1, 30), 32: (0, 32)}


def test_vectors_take_little_scratch_space(spark, monkeypatch):
    import os
    import time

    from panelyard.llm import vectors

    for name, value in (("FEW", 100), ("WAVE_BYTES", 1 << 18), ("PLACES", 5_000)):
        monkeypatch.setattr(vectors, name, value, raising=False)
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs())

    def shuffled():
        return sum(os.path.getsize(os.path.join(d, f)) for top in folders for d, _, names in os.walk(top.getPath())
                   for f in names if f.startswith("shuffle_") and os.path.exists(os.path.join(d, f)))

    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(6000, 64))
    x[4000:5000] = x[:1000] + 0.3 * rnd.normal(size=(1000, 64))
    x[5000:] = x[3999] + 0.2 * rnd.normal(size=(1000, 64))
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    before, peaks, write = shuffled(), [], vectors.materialise

    def watched(frame, label):
        out = write(frame, label)
        until = time.time() + 5         # files go a moment after the job
        peaks.append(shuffled())
        while label == "found" and shuffled() > before + x.nbytes // 2 and time.time() < until:
            time.sleep(0.1)
        return out

    monkeypatch.setattr(vectors, "materialise", watched)
    got = {r.vec_id: r for r in near_vectors(df, cell_rows=300).collect()}
    assert max(peaks) - before <= 5 * x.nbytes
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    links = np.array([got[i].n_links for i in range(len(x))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.998 * near.sum() and near.sum() > 500_000
    roots = roots_brute(range(len(x)), np.argwhere(np.triu(near)).tolist())
    assert np.mean([got[i].component_id == roots[i] for i in range(len(x))]) > 0.999
