"""Quality rules: base measures and thresholds by brute force, sketches merged in any order, labelled junk caught."""

import re

import pytest
from pyspark.sql import functions as F

from haulbook.llm import quality
from haulbook.llm.quality import merged, quality_report, quartile_bounds, sketch, text_measures, thresholds, verdicts

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    repeated = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def bucket(v):
    cut = max(v.bit_length() - 7, 0) if v else 0
    return v >> cut << cut


def test_base_measures(spark):
    texts = [None, "", " \t\n", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\x0by\x0cz\r\nx", "é汉 #*$%&|<>", "l\nl\n\n \nl\nm\r\nm\r",
             "a b c d " * 20, "  word word", " ".join(f"w{k % 37}" for k in range(400)), "q " * 30000]
    docs = spark.createDataFrame([(k, t, "en", "s", 5) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_words int")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in text_measures(docs).collect()}
    assert got == {k: brute_base(t) for k, t in enumerate(texts)}


def test_sketch_quantiles(spark):
    values = [0, 0, 1, 5, 5, 127, 128, 129, 1000, 4999, 5000, 123456789]
    df = spark.createDataFrame([(g, v) for g in ("a", "b", None) for v in values[:len(values) - (g == "b") * 5]], "lang string, v long")
    fine = sketch(df, ["lang"], ["v"])
    assert {(r.lang, r.bucket, r["count"]) for r in fine.collect() if r.lang == "a"} == {("a", b, sum(bucket(v) == b for v in values)) for b in map(bucket, values)}
    everything = merged(fine, [])
    assert {(r.bucket, r["count"]) for r in everything.collect()} == {(r.bucket, r["count"]) for r in sketch(df, [], ["v"]).collect()}


def test_thresholds_and_fallback(spark, monkeypatch):
    monkeypatch.setattr(quality, "GROUP_ROWS", 5)
    rows = [("en", "a", 100 + k) for k in range(8)] + [("en", "b", 3000)] * 2 + [(None, None, 7)] * 2
    df = spark.createDataFrame([(la, so, v, v, v, v, False) for la, so, v in rows] + [("en", "a", 9, 9, 9, 9, True)],
                               "lang string, source string, word_length long, symbols long, dup_lines long, repeats long, base_failed boolean")
    got = {(r.lang, r.source): r for r in thresholds(df).collect()}
    q = lambda vs, k: bucket(sorted(vs)[-(-k * len(vs) // 4) - 1])
    for key, level, vs in ((("en", "a"), "source", [v for la, so, v in rows if so == "a"]), (("en", "b"), "language", [v for la, _, v in rows if la == "en"]),
                           ((None, None), "all", [v for *_, v in rows])):
        reach = lambda slack: max(3 * (q(vs, 3) - q(vs, 1)), slack)
        r = got[key]
        assert r.level == level and r.symbols_high == q(vs, 3) + reach(50) and r.word_length_low == q(vs, 1) - reach(2000)


def test_verdicts(spark, monkeypatch):
    plain = " ".join(f"word{k}" for k in range(80))
    rows = [(k, plain + f" end{k}", "en", "s") for k in range(40)] + [(40, plain.replace(" ", "### "), "en", "s"), (41, None, None, None), (41, "", "en", None),
                                                                      (None, plain, None, "s"), (42, " ".join("x" * 30 + str(k) for k in range(90)), "en", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("level", F.lit(1)).withColumn("kept", F.lit("x"))
    got = {(r.doc_id, r.base_failed): (r.kept, r.reasons) for r in verdicts(docs).collect()}
    assert len(got) == len(rows) - 1 and verdicts(docs).count() == len(rows)
    assert got[40, False] == (False, ["word_length high", "symbols high"]) and got[41, True] == (False, ["base"]) and got[None, False][0] and got[42, False][0] is False
    assert all(got[k, False][0] for k in range(40))
    assert verdicts(docs.limit(0)).count() == 0


def test_labelled_junk_is_caught_and_clean_texts_stay(spark):
    path = "/root/testdata/sf0.01"
    got = quality_report(spark.read.parquet(f"{path}/documents.parquet")).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id")
    counts = {(r.quality, r.base_failed, r.kept): r["count"] for r in got.groupBy("quality", "base_failed", "kept").count().collect()}
    assert (0, False, True) not in counts and (1, False, False) not in counts and counts[0, False, False] > 10


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "doc_id long, text string, lang string, source string")
    plan = verdicts(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
