"""Top-k search, mixing, the pipeline and the registered SQL."""

import math
import random
from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline
from haulbook.llm import catalog, mixing, topk
from haulbook.llm.common import stored
from haulbook.llm.near_dedup import near_classes
from haulbook.llm.toxicity import toxicity

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, source string, text string, size string"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_queries_agree_with_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    got = catalog.QUERIES[name](spark, SMALL)
    sql = con.execute(catalog.ORACLES[name])
    columns = [c[0] for c in sql.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, sql.fetchall()))


def test_top_k_by_brute_force(frame):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 1)]) for _ in range(6)], "x") for i in range(300)]
    rows += [(1000, None, "x"), (1050, [1.0, None], "x"), (1100, [float("nan")] * 6, "x"), (1150, [float("inf")] * 6, "x"), (None, [1.0] * 6, "x")]
    rows += [rows[7], rows[50]]
    whole = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows[:300]}
    want = []
    for q in range(0, 300, 50):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    schema = "vec_id long, embedding array<double>, score string"
    assert sorted(tuple(r) for r in topk.top_k(frame(schema, rows)).select("query_id", "rank", "vec_id", "score").collect()) == want
    assert topk.top_k(frame(schema, [])).count() == 0
    assert topk.top_k(frame(schema, rows[:1])).count() == 0


def test_scores_beyond_doubles_are_exact(frame):
    whole = {0: [1_000_000_005, 3], 1: [1_000_000_005, 1], 2: [1_000_000_005, 0], 3: [1_000_000_004, 1_000_000_008], 4: [-1, -1], 5: [1_000_000_005, 2]}
    rows = [(i, [x / 256 for x in v]) for i, v in whole.items()]
    got = [(r.vec_id, r.score) for r in topk.top_k(frame("vec_id long, embedding array<double>", rows)).orderBy("rank").collect()]
    assert got == sorted(((i, sum(a * b for a, b in zip(whole[0], v))) for i, v in whole.items() if i), key=lambda x: (-x[1], x[0]))
    far = topk.top_k(frame("vec_id long, embedding array<double>", [(0, [1e14]), (1, [1e14]), (2, [-1e14])])).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in far] == [(1, 2 ** 63 - 1), (2, -2 ** 63)]


@pytest.mark.parametrize("one_id", [7, None])
def test_mixing_cuts_between_rows_that_share_an_id(frame, one_id):
    rows = [(one_id, "a", "w " * 10, "s") for _ in range(1000)] + [(5000 + i, "b", "w " * 10, "s") for i in range(3000)]
    docs = frame(DOCS, rows)
    got = mixing.mix_report(docs).collect()
    mine = [r for r in got if r.source_size == 10_000]
    assert len(mine) == 1000 and abs(sum(r.taken for r in mine) - mine[0].target) <= 10 and max(r.taken for r in mine) <= 30
    assert mixing.mixed_documents(docs).filter("source = 'a'").count() == sum(r.taken for r in mine) // 10


def test_mixing_meets_targets_and_bounds(frame):
    rng = random.Random(9)
    rows = [(i, rng.choice(["a", "b", "b", "b", "c", None]), " ".join(["w"] * rng.randint(0, 30)), "s") for i in range(3000)]
    rows += [(9000, "d", None, "s"), (None, "a", "one two", "s"), (1, "a", "one", "s")]
    docs = frame(DOCS, rows)
    got = mixing.mix_report(docs).collect()
    taken, target, source = defaultdict(int), {}, {}
    size = defaultdict(int)
    where = {i: s for i, s, *_ in rows}
    assert len(got) == len(rows)
    for r in got:
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        if r.doc_id is not None and r.doc_id != 1:
            taken[where[r.doc_id]] += r.taken
            target[where[r.doc_id]] = r.target
            size[where[r.doc_id]] += r.size
            source[where[r.doc_id]] = r.source_size
    assert sum(target.values()) == pytest.approx(sum(source.values()))
    for name in target:
        assert target[name] <= 3 * source[name] + 1e-6
        assert abs(taken[name] - target[name]) <= 200
    again = sorted(map(str, mixing.mix_report(docs).collect()))
    assert again == sorted(map(str, got))
    mix = mixing.mixed_documents(docs)
    assert mix.columns == ["doc_id", "source", "text", "size"]
    assert sum(len((r.text or "").split()) for r in mix.collect()) == sum(r.taken for r in got)
    assert mixing.mix_report(frame(DOCS, [])).count() == 0


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SMALL))
        assert out.columns == docs.columns
        before, after = ({r.doc_id: r.text or "" for r in d.select("doc_id", "text").collect()} for d in (docs, out))
        if name == "toxicity":
            scored = toxicity(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
            assert set(after) == {r.doc_id for r in scored.collect() if not r.predicted}
        elif name == "exact_dedup":
            assert sorted(after.values()) == sorted(set(before.values()))
        elif name == "near_dedup":
            assert set(after) == {r.class_id for r in near_classes(docs).collect()}
        else:
            wanted = {r.doc_id: r.taken for r in mixing.mix_report(docs).collect()}
            got = defaultdict(int)
            for r in out.select("doc_id", "text").collect():
                got[r.doc_id] += len(r.text.split())
            assert {i: n for i, n in wanted.items() if n} == {i: n for i, n in got.items() if n}
        docs = out
    name, stage = corpus_pipeline.STAGES[-1]
    last = stage(spark, docs, SMALL)
    assert last.count() == docs.count() and {"doc_id", "n_tokens", "ids_sha256", "ids"} <= set(last.columns)
