from collections import Counter, defaultdict
from zlib import crc32

import pytest
from llm_helpers import sha

from panelyard.llm.exact_dedup import exact_copies
from panelyard.llm.sharding import ring_shards


def copies_brute(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    out = []
    for text, keys in groups.items():
        best = max((k for k in keys if k is not None), default=None)
        stayed = False
        for k in keys:
            kept = k == best and not stayed
            stayed |= kept
            out.append((k, best, len(keys), kept, sha(text)))
    return Counter(out)


@pytest.mark.parametrize("broadcast_keys", [0, 1000])
def test_copies_match_brute_force(docs_of, odd_texts, clashing, broadcast_keys):
    rows = odd_texts + [(10 + i, f"copy {i % 3} " + "x" * 300) for i in range(9)]
    got = exact_copies(clashing(docs_of(rows)), hash_all=True, broadcast_keys=broadcast_keys, head_chars=4)
    assert Counter(tuple(r) for r in got.collect()) == copies_brute(rows)


def test_unique_texts_are_not_hashed_in_full(docs_of):
    got = exact_copies(docs_of([(1, "a"), (2, "bb"), (3, "bb"), (4, "cc")]), head_chars=1).collect()
    assert {r.doc_id: r.text_sha256 is not None for r in got} == {1: False, 2: True, 3: True, 4: False}


def test_bound_of_keys_changes_no_result(docs_of):
    rows = [(i, f"text {i % 7}" if i % 3 else f"alone {i}") for i in range(60)] + [(90, None), (91, "")]
    few, many = (sorted(map(tuple, exact_copies(docs_of(rows), broadcast_keys=n).collect())) for n in (0, 10_000))
    assert few == many


def test_no_rows(docs_of):
    assert exact_copies(docs_of([])).collect() == []
    assert ring_shards(docs_of([]), 5).collect() == []


def check_shards(rows, got, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (k, len((t or "").encode()) + 8, crc32((t or "").encode())) for k, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_are_balanced_and_slots_gapless(docs_of, odd_texts, clashing):
    check_shards(odd_texts, ring_shards(clashing(docs_of(odd_texts)), 4).collect(), 4)
    many = [(i, f"text {i}") for i in range(3000)]
    check_shards(many, ring_shards(docs_of(many), 24, cell_rows=10).collect(), 24)


def test_one_key_with_most_rows_is_split(docs_of):
    rows = [(7, "the same")] * 400 + [(7, f"other {i}") for i in range(100)] + [(i, "x") for i in range(100)]
    check_shards(rows, ring_shards(docs_of(rows), 6).collect(), 6)


def test_more_shards_move_little_and_reruns_agree(docs_of):
    rows = [(i, "t") for i in range(4000)]
    at = lambda n: {r.doc_id: r.shard for r in ring_shards(docs_of(rows), n).collect()}
    before, again, after = at(24), at(24), at(25)
    assert before == again
    assert sum(before[k] != after[k] for k in before) < 0.25 * len(rows)


def test_slack_bounds_the_load(docs_of):
    rows = [(i, "t") for i in range(2000)]
    loads = Counter(r.shard for r in ring_shards(docs_of(rows), 10, slack=0.1).collect())
    assert max(loads.values()) <= 2000 * 1.1 / 10 + 1
