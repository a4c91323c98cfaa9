import random

import numpy as np
import public_tokenizers
import pytest
from test_bpe_and_toxicity import corpus
from test_mixing_and_chat import count, targets_brute
from test_near_duplicates import lines_brute
from tokenizers import Tokenizer

import corpus_pipeline
from panelyard.llm.queries import ORACLES, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, docs_of, tmp_path_factory):
    """Clean and toxic documents, copies, near copies, shared lines, documents without text, repeated rows."""
    path = str(tmp_path_factory.mktemp("tables"))
    rnd, data = random.Random(2), corpus(200, 6)
    rows = [(i, t.replace(". ", ".\n"), f"src{i % 3}") for i, (t, _) in enumerate(data)]
    rows += [(500 + i, rows[i][1], "src1") for i in range(1, 9)]                       # exact copies
    long = " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(2500))
    rows += [(600, long, "src0"), (601, long + " one more word", "src2"), (602, None, "src0"), (603, "", None),
             (604, "only words of its own here\n" + rows[3][1].split("\n")[0], None), (604, "same key, other text", "src2")]
    docs_of(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, y, 0) for i, (_, y) in enumerate(data)], "doc_id long, toxic int, quality int").write.parquet(
        f"{path}/labels.parquet")
    return path, rows, [i for i, (_, y) in enumerate(data) if y]


def test_stages(spark, folder):
    path, rows, toxic = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_dedup", "mixing", "bpe"]

    first = stages["toxicity"](spark, docs, path).cache()
    assert first.columns == COLUMNS
    assert {r[0] for r in rows} - {r.doc_id for r in first.collect()} == set(toxic) | {500 + i for i in range(1, 9) if i in toxic}

    second = stages["line_dedup"](spark, first, path).cache()
    assert second.columns == COLUMNS
    held = [(r.doc_id, r.text) for r in first.collect()]
    single = [(k, t) for k, t in held if k != 604]
    gone, want = lines_brute(single), {}
    for k, t in single:
        left = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (k, n) not in gone)
        if not any(d == k for d, _ in gone) or count(left):
            want[k] = left
    got = {r.doc_id: r for r in second.collect() if r.doc_id != 604}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text or "") for r in got.values())
    assert sorted(r.text for r in second.collect() if r.doc_id == 604) == ["only words of its own here", "same key, other text"]

    third = stages["simhash_dedup"](spark, second, path).cache()
    assert third.columns == COLUMNS
    lost = [r.doc_id for r in second.exceptAll(third).collect()]
    assert third.exceptAll(second).count() == 0 and 601 in lost and 600 not in lost and set(lost) <= {601, 602, 603}

    fourth = stages["mixing"](spark, third, path).cache()
    assert fourth.columns == COLUMNS
    sizes = {}
    for r in third.collect():
        sizes[r.source] = sizes.get(r.source, 0) + count(r.text)
    most = max(count(r.text) for r in third.collect())
    for source, target in targets_brute(sizes).items():
        taken = sum(count(r.text) for r in fourth.collect() if r.source == source)
        assert abs(taken - target) <= most / 2 + 1
    times = {r.doc_id: r["count"] for r in fourth.groupBy("doc_id", "text").count().collect()}
    assert max(times.values()) <= 3

    last = stages["bpe"](spark, fourth, path)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in fourth.where("doc_id <> 604").collect()}
    for r in last.where("doc_id <> 604").collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) // 4
    assert last.count() == fourth.count()
    assert corpus_pipeline.run(spark, path).count() == last.count()


def test_stages_on_empty_tables(spark, docs_of, tmp_path):
    docs_of([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_every_operator_has_its_query(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, name):
    import duckdb
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    got = QUERIES[name](spark, sf).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
