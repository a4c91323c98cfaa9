import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from panelyard.llm import conversations
from panelyard.llm.queries import QUERIES
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm_helpers import sha

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                      T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
SPACE = " \t\n\v\f\r"


def broken(rows):
    """Rows after damage by dialogue."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, fate = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], sha_md5(x[2]))) for c, r in out.items()}


def sha_md5(text):
    import hashlib
    return hashlib.md5(text.encode()).hexdigest()


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "-")
        seen.add((role, text))
    return out


ALLOWED = re.compile("(s?(ua)+)?")


def brute_repair(rows, faults):
    """All edit sequences by dynamic programming over (initials, audit) sets, without the states of the operator."""
    # items: initials so far (their last letters decide) -> least (cost, audit, lines)
    def fits(initials):
        return re.fullmatch("s?(ua)*u?", initials) is not None

    layer = {"": (0, "", ())}

    def grown(layer):
        """Insertions until nothing gets lighter; initials are cut to what decides."""
        todo, best = sorted((v, k) for k, v in layer.items()), dict(layer)
        while todo:
            (cost, audit, lines), initials = todo.pop(0)
            for role in ("user", "assistant"):
                new = initials + role[0]
                if fits(new):
                    new = short(new)
                    item = (cost + 5, audit + "I", lines + (f"{role}:",))
                    if new not in best or item[:2] < best[new][:2]:
                        best[new] = item
                        todo.append((item, new))
            todo.sort()
        return best

    def short(initials):
        return initials if len(initials) < 2 else re.sub("^(s?)(ua)+(u?)$", lambda m: "ua" + m[3], initials)

    for (_, role, text), fault in zip(rows, faults):
        new_layer = {}

        def offer(initials, item):
            if initials not in new_layer or item[:2] < new_layer[initials][:2]:
                new_layer[initials] = item

        for initials, (cost, audit, lines) in grown(layer).items():
            offer(initials, (cost + 2, audit + "D", lines))
            if fault in "bd":
                continue
            extra = 5 if fault == "t" else 0
            if role[:1] and fits(initials + role[:1]):
                offer(short(initials + role[:1]), (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            for to in ("user", "assistant"):
                if fits(initials + to[0]):
                    offer(short(initials + to[0]), (cost + 1 + extra, audit + "R", (*lines, f"{to}:{text}")))
        layer = new_layer
    ends = [v for k, v in grown(layer).items() if ALLOWED.fullmatch(k)]
    return min(ends, key=lambda v: v[:2])


def expected(rows):
    out = {}
    for conv, kept in broken(rows).items():
        faults = faults_of(kept)
        cost, audit, lines = brute_repair(kept, faults)
        turns = [t for t, _, _ in kept if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"),
                     faults.count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha("\n".join(lines)))
    return out


def found(spark, rows, **options):
    turns = spark.createDataFrame(rows, TURNS)
    return result(conversations.repair_structure(conversations.damaged(turns), **options))


def result(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def made(seed, n, long=12):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randint(1, long)):
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, None, turn // 2]),
                         rng.choice(["user", "assistant", "system", "tool", "", None, "User", "user", "assistant"]),
                         rng.choice(["Yes.", "no", "", None, " \n", "Right!  ", "Ok? é", "漢字.", "Yes."]) if rng.random() < .7
                         else f"said {rng.random()}."))
    return rows


def shapes(n):
    return ["".join(i + f for i, f in s) for k in range(n + 1) for s in itertools.product(
        [("u", "-"), ("a", "-"), ("s", "-"), ("u", "t"), ("a", "d"), ("x", "-")], repeat=k)]


def test_agenda_matches_all_edit_sequences():
    """Every sequence of edits of small shapes, with up to two insertions at each place."""
    roles = {"u": "user", "a": "assistant", "s": "system", "x": "x"}
    for shape in shapes(3):
        rows = [(0, roles[shape[i]], str(i)) for i in range(0, len(shape), 2)]
        ways = []
        options = [("D", "K", "R") if shape[i + 1] in "-t" else ("D",) for i in range(0, len(shape), 2)]
        for edits in itertools.product(*options):
            for places in itertools.product(range(2), repeat=len(rows) + 1):
                cost, letters, audit = 5 * sum(places), [], ""
                for i in range(len(rows) + 1):
                    letters += [None] * places[i]
                    audit += "I" * places[i]
                    if i < len(rows):
                        audit += edits[i]
                        cut = 5 * (shape[2 * i + 1] == "t")
                        cost += {"D": 2, "K": cut, "R": 1 + cut}[edits[i]]
                        if edits[i] != "D":
                            letters.append(shape[2 * i] if edits[i] == "K" else None)
                free = letters.count(None)
                for fill in itertools.product("ua", repeat=free):
                    it = iter(fill)
                    if ALLOWED.fullmatch("".join(c or next(it) for c in letters)):
                        ways.append((cost, audit))
                        break
        assert conversations.repair(shape) == min(ways), shape
        assert brute_repair(rows, list(shape[1::2]))[:2] == min(ways), shape


def test_blocks_and_segments_join_to_the_same(monkeypatch):
    rng = random.Random(5)
    for n in (1, 7, 60, 300):
        shape = "".join(rng.choice("uuaasx") + rng.choice("---btd") for _ in range(n))
        whole = conversations.repair(shape)
        for block in (1, 2, 5, 64):
            monkeypatch.setattr(conversations, "BLOCK", block)
            assert conversations.best(conversations.table_of(shape)) == whole
            assert conversations.repair(shape) == whole
        monkeypatch.setattr(conversations, "BLOCK", 256)


def test_repair_matches_brute_force(spark):
    rows = made(1, 60)
    assert found(spark, rows) == expected(rows)


@pytest.mark.parametrize("held", [1, 3])
def test_large_dialogues_are_joined_from_segments(spark, held):
    """One dialogue with most rows, spread over partitions; nothing of it is held whole."""
    rows = made(2, 25, 6) + [(777, t % 900 if t % 11 else None, random.Random(t).choice(["user", "assistant", "system"]),
                              f"line {t % 300}" + "." * (t % 3)) for t in range(1500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows, held_rows=held) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_tables(spark, clashing):
    assert found(spark, []) == {}
    rows = [(1, 0, "user", "A."), (1, 0, "user", "A."), (1, 0, "user", "A."), (2, None, None, None), (None, None, "assistant", "x.")]
    assert found(spark, rows) == expected(rows)
    turns = clashing(spark.createDataFrame(rows, TURNS)).withColumn("present", F.lit("x"))
    assert result(conversations.repair_structure(conversations.damaged(turns))) == expected(rows)
    named = spark.createDataFrame([("a", 1, "assistant", "Hm."), ("b", 1, "user", "Hm.")], "conv_id string, turn int, role string, text string")
    got = result(conversations.repair_structure(named.withColumn("present", F.lit(True))))
    assert {c: r[5:7] for c, r in got.items()} == {"a": (2, "D"), "b": (2, "D")}


def test_dropped_dialogue_stays(spark):
    conv, turn = next((c, t) for c in range(50) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    assert found(spark, [(conv, turn, "user", "Hello.")]) == {conv: (0, 0, 0, 0, 0, 0, "", sha(""))}


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_repair"](spark, sf)
    assert result(got) == expected(rows)
    assert Counter(r.cost > 0 for r in got.collect())[True] > 20
