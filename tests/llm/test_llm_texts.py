"""Token ids, language model, toxicity, licenses, page text and archive records."""

import base64
import gc
import hashlib
import math
import random
import time
import tracemalloc
import weakref
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken

from haulbook.llm import common, language_model, licenses, page_text, tokens, toxicity, warc

DOCS = "doc_id long, text string, _id string"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def random_text(rng):
    alphabet = "abc  theing\n\t\r'0123,.!é漢🙂\x1c ZÄ"
    return "".join(rng.choices(alphabet, k=rng.randint(0, 80)))


def test_the_tables_of_a_task_go_with_it():
    coder = tokens.TextCoder({bytes([b]): b for b in range(256)}, public_tokenizers.PATTERN)
    assert coder.decode(coder.encode("two words")) == b"two words"
    left = weakref.ref(coder)
    gc.disable()
    try:
        del coder
        assert left() is None
    finally:
        gc.enable()


def test_a_coder_holds_frequent_runs_only(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 20)
    coder = tokens.TextCoder(tokens.read_ranks(RANKS), public_tokenizers.PATTERN)
    made = []
    inner = coder.known.coder.encode
    monkeypatch.setattr(coder.known.coder, "encode", lambda data: made.append(data) or inner(data))
    for i in range(200):
        text = f"often w{'xyz'[i % 3] * (i // 3 % 40)}q" + "long" * 40
        assert coder.decode(coder.encode(text).tolist()) == text.encode()
    assert made.count(b"often") == 1 and len(coder.known) + len(coder.known.older) <= 40
    assert max(map(len, coder.known)) <= tokens.LONG


def test_prefix_table_without_tokens_of_its_bytes():
    with pytest.raises(ValueError, match="cover every byte"):
        tokens.PrefixCoder({b"a": 0, b"b": 1, b"ab": 2}).encode(b"abc")


def test_buckets_of_words_are_packed():
    words, known = [f"word{i}of" for i in range(20_000)], toxicity._Terms()
    tracemalloc.start()
    for w in words:
        known[w]
    used = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert used < 250 * len(words)
    assert toxicity.text_terms("", known).tolist() == []
    assert toxicity.text_terms("Word7of word8of word7of", known).tolist() == sorted({*toxicity.term_ids("word7of"), *toxicity.term_ids("word8of")})


def test_a_task_gives_free_memory_back():
    def held():
        return sum(int(line.split()[1]) for line in open("/proc/self/smaps_rollup") if line.startswith("Pss_Anon:"))

    def run(frames):
        held_blocks = [bytes(100_000) for _ in range(1000)]
        pins.extend(bytes(1000) for _ in range(10))
        yield from frames
        del held_blocks

    pins = []
    before = held()
    assert list(common.giving_back(run)(iter([1, 2]))) == [1, 2]
    assert held() - before < 50_000


def test_bpe_agrees_with_the_library(frame):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    texts = [None, "", " ", "it's 12345 words", "x" * 5000, "ab" * 3000] + [random_text(rng) for _ in range(400)]
    got = tokens.bpe_round_trip(frame(DOCS, [(i, t, "z") for i, t in enumerate(texts)]), RANKS, public_tokenizers.PATTERN, with_ids=True)
    for r in got.collect():
        text = texts[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert tokens.bpe_round_trip(frame(DOCS, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_prefix_table_after_an_edit():
    coder, rng = tokens.PrefixCoder(tokens.read_ranks(RANKS)), random.Random(4)
    for _ in range(40):
        old, new = ("".join(rng.choices("thequickanser", k=n)).encode() for n in (60, rng.randint(0, 6)))
        at = rng.randint(0, 50)
        gone = rng.randint(0, 10)
        data, table = coder.edited(old, coder.table(old), at, gone, new)
        assert data == old[:at] + new + old[at + gone:]
        assert table == coder.table(data)


def test_class_model_base_scores_and_normalisation(frame):
    rng = random.Random(5)
    words = ["the", "a", "Cat", "dog", "runs", "sleeps", "today", "now"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12))), "z") for i in range(200)] + [(900, None, "z"), (901, "zz yy qq", None)]
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in rows}
    split = {i: [w.lower() for w in (t or "").split()] + [None] for i, t, _ in rows}
    counts = Counter(w for i, ws in split.items() if not held[i] for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    got = language_model.class_model_scores(frame(DOCS, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        ws = split[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(w in counts for w in ws), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + .1) / (total + .1 * (kinds + 1))) for w in ws))
        assert r.score < 0 and math.isfinite(r.score)
    assert language_model.class_model_scores(frame(DOCS, [])).count() == 0


def test_exchange_ends_where_no_move_helps():
    def objective(pairs, of, classes):
        table = np.zeros((classes + 2, classes + 2))
        np.add.at(table, (of[pairs["a"]], of[pairs["b"]]), pairs["n"])
        return sum(sign * (x * np.log(np.maximum(x, 1e-12))).sum() for sign, x in ((1, table), (-1, table.sum(0)), (-1, table.sum(1))))

    rng, words, classes = np.random.default_rng(10), 12, 3
    for _ in range(20):
        counts = rng.integers(0, 30, (words + 1, words + 1))
        a, b = np.nonzero(counts)
        pairs = pd.DataFrame({"a": a, "b": b, "n": counts[a, b]})
        of = language_model.exchange(pairs, words, classes, sweeps=100)
        best = objective(pairs, of, classes)
        for w in range(1, words):
            for c in range(classes):
                moved = of.copy()
                moved[w] = c
                assert objective(pairs, moved, classes) <= best + 1e-6


def test_toxicity_learns_pairs_of_terms(frame):
    rng = random.Random(6)
    filler = [f"f{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(1500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        text = rng.choices(filler, k=8) + ["vile"] * insult + ["group"] * group
        rng.shuffle(text)
        rows.append((i, " ".join(text), "z"))
        labels.append((i, int(insult and group)))
    rows += [(5000, None, None), (5001, "", None), (None, "f1", None)]
    labels += [(None, 1), (3, None)]
    got = toxicity.toxicity(frame(DOCS, rows), frame("doc_id long, toxic int", labels)).collect()
    truth = dict(labels)
    tested = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in tested) / len(tested) > 0.95
    no_labels = toxicity.toxicity(frame(DOCS, rows[:3]), frame("doc_id long, toxic int", [])).collect()
    assert [r.score for r in no_labels] == [0.5] * 3
    assert toxicity.toxicity(frame(DOCS, []), frame("doc_id long, toxic int", labels)).count() == 0


def test_license_scan_by_brute_force(frame):
    name, notice = max(licenses.NOTICES.items(), key=lambda kv: len(kv[1]))
    rng = random.Random(7)
    words = notice.split()
    changed = words[:]
    changed[len(words) // 2] = "changed"
    noise = [f"n{i}" for i in range(5000)]
    texts = [notice, notice.upper(), " ".join(rng.choices(noise, k=700) + changed + rng.choices(noise, k=300)),
             " ".join(words[:len(words) // 2]), None, "", " ".join(rng.choices(noise, k=3000)),
             " ".join(words + rng.choices(noise, k=900) + words)]
    got = licenses.license_scan(frame(DOCS, [(i, t, "z") for i, t in enumerate(texts)])).collect()

    def runs(text):
        ws = licenses.license_words(text or "")
        return [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)] or ([tuple(ws)] if ws else [])

    template = set(runs(notice))
    want = {i for i, t in enumerate(texts) if len(template & set(runs(t))) >= 0.8 * len(template)}
    assert {r.doc_id for r in got if r.license == name} == want
    assert sum(r.doc_id == 7 and r.license == name for r in got) == 2
    span = next(r for r in got if r.doc_id == 2 and r.license == name)
    assert span.first_word == 700 and span.last_word == 700 + len(licenses.license_words(notice)) - 1
    assert licenses.license_scan(frame(DOCS, [])).count() == 0


def test_page_text(frame):
    body = "A long sentence of the article with &amp; and  white\n space in it, well over the surge."
    page = (f"<html><head><title>T</title><script>var x = '<p>no</p>';</script></head><body><nav><a href='/'>Home</a></nav>"
            f"<main><article><p>{body}</p><p>Second <b>paragraph</b> of it.</p></article></main><footer>Imprint of the page</footer></body></html>")
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, None), (3, "u", "", "x"), (4, "u", "<p>" + "word " * 50_000, "x"), (None, "u", "<div", "x")]
    got = page_text.extract_pages(frame("page_id long, url string, html string, text string", rows)).collect()
    assert len(got) == 6
    by = {r.page_id: r for r in got}
    assert by[1].text == "A long sentence of the article with & and white space in it, well over the surge. Second paragraph of it."
    assert by[2].text == by[3].text == "" and by[2].n_chars == 0
    assert by[4].n_chars == 5 * 50_000 - 1
    assert page_text.extract_pages(frame("page_id long, url string, html string", [])).count() == 0


STORY = "The story goes on and on for a good while. " * 5


@pytest.mark.parametrize("page, want", [
    (f"<div><a href=x>Home</a> <a href=y>News</a></div><p>{STORY}</p><div>Copyright 2020 by us, all rights</div>", STORY),   # plain menu and footer
    (f"<body><div class='page-side-effects'><p>{STORY}</p></div><p>teaser</p>", STORY + "teaser"),                             # a name that only holds a part's word
    (f"<div class='right-sidebar'><p>Beside it all</p></div><article><p>{STORY}</p></article>", STORY),
    (f"<article><p>{STORY}</p><article><p>Inner piece of it.</p></article><p>End of it.</p></article>", STORY + "Inner piece of it. End of it."),
    (f"<article><p>{STORY}</p><div id=comment-list><p>I was first to read this, and say so at length.</p></div></article>", STORY),
    (f"<p>{STORY}<!-- <p>gone --> and more</p><p>a < b and b > a</p>", STORY + "and more a < b and b > a"),
    (f"<title>T</title><p title='a > b'>{STORY}</p><script>if (a < b) x()</script><script/><p>Last words.</p>", STORY + "Last words."),
    ("<p>one<p>two<li>three<br>four", "one two three four"),
])
def test_page_parts(page, want):
    assert page_text.main_text(page) == " ".join(want.split())


@pytest.mark.parametrize("junk", ["<a '", "<a ", "<div>" * 9 + "</p>", "<title>", "<script/>", '<a "x>', "<", "<!--", "<!", "<p><article>", "</div>", "&amp"])
def test_junk_pages_take_linear_time(junk):
    start = time.monotonic()
    page_text.main_text(junk * (1_000_000 // len(junk)))
    assert time.monotonic() - start < 10


def test_toxicity_on_held_out_documents(spark):
    path = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    got = toxicity.toxicity(spark.read.parquet(f"{path}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out and toxic is not null").collect()
    bad, good = [r.score for r in got if r.toxic], [r.score for r in got if not r.toxic]
    above = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))
    assert above > 0.85 and sum(s >= 0.7 for s in good) <= 0.02 * len(good) and sum(s >= 0.7 for s in bad) >= 0.5 * len(bad)


def test_toxicity_without_a_telling_term(frame):
    rows = [(i, f"word{i} text", "z") for i in range(40)]
    got = toxicity.toxicity(frame(DOCS, rows), frame("doc_id long, toxic int", [(i, i % 2) for i in range(40)])).collect()
    assert len(got) == 40 and len({r.score for r in got}) == 1 and 0 < got[0].score < 1


def test_toxicity_rows_are_bounded_when_ids_repeat(frame, monkeypatch):
    rows = [(1, f"good words {i}", "z") for i in range(300)] + [(2, f"vile words {i}", "z") for i in range(300)] + [(3, "x", "z")]
    kept = toxicity.labelled_terms(frame(DOCS, rows), frame("doc_id long, toxic int", [(1, 0), (2, 1), (3, 0)]), most=50)
    assert kept.count() == 50


def test_archive_records_round_trip(spark, frame, tmp_path):
    rows = [(1, "http://x/1", "<title>T &amp; U</title><p>Hello</p><a href='/y'>y</a>", "z"), (2, None, None, None), (2, None, None, None)]
    pages = frame("page_id long, url string, html string, headers string", rows)
    records = warc.derive_records(warc.responses_of(pages), "page_id")
    got = records.collect()
    assert sorted(Counter((r.page_id, r.record_type) for r in got).values()) == [1, 1, 2, 2]
    one = {r.record_type: r for r in got if r.page_id == 1}
    assert len({r.refers_to for r in one.values()}) == 1 and one["conversion"].record_id != one["metadata"].record_id
    assert "Hello" in one["conversion"].block
    assert one["conversion"].source_digest == warc.digest(
        ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(rows[0][2]) + rows[0][2]).encode())
    for r in got:
        headers = dict((h.name, h.value) for h in r.headers)
        assert int(headers["Content-Length"]) == len(r.block.encode()) and headers["WARC-Refers-To"] == r.refers_to
        assert headers["WARC-Block-Digest"] == warc.digest(r.block.encode())
    warc.write_records(records, str(tmp_path / "out"))
    import gzip
    whole = b"".join(gzip.open(f).read() for f in sorted((tmp_path / "out").glob("*.gz")))
    assert whole.count(b"WARC/1.1\r\n") == len(got)
    assert warc.record_report(frame("page_id long, url string, html string", [])).count() == 0
