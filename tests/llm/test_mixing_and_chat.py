import re
from collections import defaultdict

import pytest

from panelyard.llm.chat import END, rotate_perspectives
from panelyard.llm.mixing import mix


def targets_brute(sizes, weights=(1, 2, 3), most=3.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        if not free:
            break
        level = (total - sum(most * sizes[s] for s in stopped)) / sum(weight[s] for s in free)
        more = {s for s in free if weight[s] * level > most * sizes[s]}
        if not more:
            break
        stopped |= more
    return {s: most * sizes[s] if s in stopped else weight[s] * level for s in names}


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("cut", [True, False])
def test_mix_meets_its_targets(docs_of, clashing, odd_texts, cut):
    rows = [(k, t, "odd") for k, t in odd_texts] + [(i, "word " * (i % 90), ["a", "b", "b", "b", None][i % 5])
                                                    for i in range(100, 900)]
    df = clashing(docs_of(rows))
    got = mix(df, cut=cut).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(k), count(t)) for k, t, _ in rows)
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
        assert r.taken <= 3 * r.size and r.taken // max(1, r.size) >= r.copies >= 0
    want = targets_brute(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= (1 if cut else most[s] / 2 + 1)
    again = mix(df, cut=cut).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_smaller_budgets_take_a_subset(docs_of):
    rows = [(i, "w " * (i % 7 + 1), "a" if i % 3 else "b") for i in range(300)]
    took = lambda w: {r.doc_id for r in mix(docs_of(rows), weights=w, cut=False).collect()
                      if r.source == "a" and r.copies}
    assert took((1, 9)) <= took((1, 4)) <= took((1, 2))


def test_mix_of_nothing(docs_of):
    assert mix(docs_of([])).collect() == []
    only = mix(docs_of([(1, None), (2, " ")])).collect()
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)] * 2


def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_every_speaker_gets_a_view(spark, clashing):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello <|end|>"), (1, 3, "ann", None),
            (1, 2, "bob", "hello <|end|>"), (1, 2, None, "é"), (2, 0, "system", "alone"), (None, None, "zoe", "x")]
    got = {(r.conv_id, r.speaker): r for r in rotate_perspectives(clashing(turns_of(spark, rows))).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "zoe")}
    ann = got[1, "ann"]
    assert ann.rendered == ("<|system|>\nbe kind" + END + "<|assistant|>\nhi" + END + 2 * ("<|user name=bob|>\nhello < |end|>" + END)
                            + "<|user name=unknown|>\né" + END + "<|assistant|>\n" + END)
    assert ann.n_turns == 6
    assert [ann.rendered[m.start:m.end] for m in ann.masks] == ["hi" + END, END]
    bob = got[1, "bob"]
    assert [bob.rendered[m.start:m.end] for m in bob.masks] == ["hello < |end|>" + END] * 2


def test_long_dialogues_come_in_parts(spark):
    rows = [(1, i, "ab"[i % 2], f"t{i}") for i in range(25)]
    got = rotate_perspectives(turns_of(spark, rows), part_turns=10).collect()
    assert sorted((r.speaker, r.part, r.n_turns) for r in got) == [
        (s, p, n) for s in "ab" for p, n in ((0, 10), (1, 10), (2, 5))]
    assert rotate_perspectives(turns_of(spark, [])).collect() == []


def test_every_row_is_a_turn_and_places_cut_the_parts(spark):
    """Repeated, tied and null turns stay; one dialogue with most rows is cut by place, not by number."""
    rows = [(1, None, "ann", "ok"), (1, None, "ann", "ok"), (1, None, "bob", "ok"), (2, 5, "ann", "a"), (2, 5, "ann", "a"),
            (None, 0, "bob", "x")]
    got = {(r.conv_id, r.speaker): r.n_turns for r in rotate_perspectives(turns_of(spark, rows)).collect()}
    assert got == {(1, "ann"): 3, (1, "bob"): 3, (2, "ann"): 2, (None, "bob"): 1}
    hot = [(7, [None, 3][i % 2], "ann" if i % 3 else "bob", f"line {i % 50}") for i in range(3_000)]
    many = turns_of(spark, hot + [(c, t, "ann", "hi") for c in range(5) for t in range(20)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        views = [r for r in rotate_perspectives(many, part_turns=100).collect() if r.conv_id == 7 and r.speaker == "ann"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.part, r.n_turns) for r in views) == [(p, 100) for p in range(30)]
    whole = "".join(r.rendered for r in sorted(views, key=lambda r: r.part))
    order = sorted(hot, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    assert whole == "".join(("<|assistant|>" if r[2] == "ann" else "<|user name=bob|>") + "\n" + r[3] + END for r in order)
