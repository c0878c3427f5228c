import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dwellmart.llm import quality
from dwellmart.llm.queries import QUERIES
from tests.llm.conftest import ODD, documents


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def check(texts, rows):
    for r in rows:
        want = plain(texts[r.doc_id])
        assert {k: r[k] for k in want} == want
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert r.base_failed == failed and (not failed or not r.kept) and r.kept == (not failed and r.quality >= 0.5)


PARTS = ["a", "b ", "a b c ", "\n", " ", "#", "$$ ", "x\ty\x0bz", "é", "\u00a0", "\U0001f600 ", "\r\n", "a b\n"]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), min_size=1, max_size=25))
def test_measures_by_definition(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = quality.measured(docs, F.col("doc_id")).collect()
    assert {r.kept: {k: r[k] for k in quality.MEASURES} for r in rows} == {i: plain(t) for i, t in enumerate(texts)}


def test_odd_rows(odd, nothing):
    rows = quality.judge(odd).collect()
    assert len(rows) == len(ODD)
    check({i: t for i, t, *_ in ODD}, rows)
    assert quality.judge(nothing).count() == 0
    assert quality.keep_good(odd).schema == odd.schema and quality.keep_good(nothing).count() == 0


def plain_fit(votes, names, rounds):
    """The same fit over single documents, in plain numbers."""
    good = [0.1 if -1 in v else 0.9 for v in votes]
    for step in range(rounds + 1):
        total, bad = sum(good), sum(1 - g for g in good)
        share = min(max((total + 1) / (total + bad + 2), quality.SHARE[0]), quality.SHARE[1])
        rate = [
            {x: ((sum(w for v, w in zip(votes, ws) if v[k] == x) + 1) / (sum(ws) + 3)) for x in quality.VOTES}
            for ws in (good, [1 - g for g in good])
            for k in range(len(names))
        ]
        gains = [{x: math.log(rate[k][x] / rate[k + len(names)][x]) for x in quality.VOTES} for k in range(len(names))]
        odds = [
            math.log(share / (1 - share)) + sum(max(-quality.MOST_GAIN, min(quality.MOST_GAIN, g[x])) for g, x in zip(gains, v))
            for v in votes
        ]
        good = [1 / (1 + math.exp(-o)) for o in odds]
    return good


def test_fit_against_plain_numbers(spark):
    import numpy as np

    draw = np.random.default_rng(4)
    truth = draw.random(600) < 0.8
    votes = [tuple(int(x) for x in np.where(draw.random(4) < 0.3, 0, np.where((draw.random(4) < 0.85) == t, 1, -1))) for t in truth]
    frame = spark.createDataFrame(votes, "a int, b int, c int, d int")
    found = quality.fit(frame, list("abcd"), rounds=10)
    got = frame.withColumn("p", found.posterior()).collect()
    want = dict(zip(votes, plain_fit(votes, "abcd", 10)))
    assert all(r.p == pytest.approx(want[r.a, r.b, r.c, r.d], rel=1e-6) for r in got)
    right = sum((r.p >= 0.5) == (want[r.a, r.b, r.c, r.d] >= 0.5) for r in got)
    assert right == len(got) and sum((want[v] >= 0.5) == t for v, t in zip(votes, truth)) > 0.85 * len(votes)


def clean_text(i):
    """Fifteen sentences of plain words in an order of their own."""
    words = [f"{'lorem ipsum dolor amet sit'.split()[(i * 7 + k * k) % 5]}{chr(97 + (i + k * 5) % 26)}" for k in range(120)]
    return " ".join(w + "." * (k % 8 == 7) for k, w in enumerate(words))


def test_clean_texts_stay_and_junk_goes(spark):
    clean = [(i, clean_text(i)) for i in range(80)]
    junk = [(100 + i, " ".join(f"word{i * k}$$$ | ###" for k in range(60))) for i in range(15)]
    caps = [(200 + i, " ".join(f"LOUD{i * k}X!!" for k in range(60))) for i in range(10)]
    kept = {r.doc_id for r in quality.judge(documents(spark, clean + junk + caps)).where("kept").collect()}
    assert kept == {i for i, _ in clean}


def test_only_clean_texts_all_stay(spark):
    clean = [(i, clean_text(i)) for i in range(30)]
    poem = [(99, clean_text(99).replace(".", "\n"))]
    assert quality.judge(documents(spark, clean + poem)).where("kept").count() == 31


def test_registered_query(spark, sf_dir):
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    frame = QUERIES["op9_quality_votes"](spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = frame.collect()
    assert len(rows) == len(texts)
    check(texts, rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [(r.kept, labels[r.doc_id]) for r in rows if r.doc_id in labels and not r.base_failed]
    assert sum(k == bool(q) for k, q in judged) >= 0.9 * len(judged)
