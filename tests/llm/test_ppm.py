import math
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dwellmart.llm import ppm
from dwellmart.llm.queries import QUERIES
from tests.llm.conftest import ODD, documents


def plain_score(training, text, least=1):
    """PPM by its definition, with one dictionary of counts per order; grams below ``least`` are not kept."""
    counts = [defaultdict(Counter) for _ in range(ppm.DEPTH + 1)]
    for one in training:
        whole = ppm.BEFORE + one + ppm.END
        for i in range(ppm.DEPTH, len(whole)):
            for k in range(ppm.DEPTH + 1):
                counts[k][whole[i - k : i]][whole[i]] += 1
    total, whole = 0.0, ppm.BEFORE + text + ppm.END
    for i in range(ppm.DEPTH, len(whole)):
        excluded, p = set(), 1.0
        for k in range(ppm.DEPTH, -1, -1):
            seen = counts[k].get(whole[i - k : i], {})
            kept = {s: n for s, n in seen.items() if n >= least}
            left = {s: n for s, n in kept.items() if s not in excluded}
            twice = 2 * sum(n for s, n in seen.items() if s not in excluded)
            if not kept or not twice:
                continue
            if whole[i] in left:
                p *= (2 * left[whole[i]] - 1) / twice
                break
            p *= 1 - sum(2 * n - 1 for n in left.values()) / twice
            excluded |= set(kept)
        else:
            p /= 256 - len(excluded)
        total += math.log10(p)
    return total


def trie(training, least=1):
    grams = Counter()
    for one in training:
        grams.update(ppm.grams_of(np.frombuffer(ppm.BEFORE + one + ppm.END, np.uint8)).tolist())

    def low(n):
        sums = Counter()
        for gram, count in grams.items():
            sums[gram & ((1 << 8 * n) - 1)] += count
        kept = {gram: count for gram, count in sums.items() if count >= least}
        return np.array(list(kept), np.int64), np.array(list(kept.values()), np.int64)

    return ppm.Trie(tuple(low(k + 1) for k in range(ppm.DEPTH + 1)), grams.total())


TRAINING = [b"the cat sat on the mat", b"the cat ran", b"", b"a cat and a dog sat", "été au lit".encode(), b"aaaaaaaaab"]
MODELS = {least: ppm.Model(trie(TRAINING, least)) for least in (1, 2, 3)}
MODEL = MODELS[1]
TEXTS = st.lists(st.sampled_from(["the ", "cat", " sat", "a", "é", "z"]), max_size=10).map(lambda p: "".join(p).encode())


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.binary(max_size=30), TEXTS), st.sampled_from([1, 2, 3]))
def test_score_by_definition(text, least):
    assert MODELS[least].scores([text])[0] == pytest.approx(plain_score(TRAINING, text, least), rel=1e-5)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([1, 2, 3]))
def test_probabilities_of_a_context_add_up_to_one(text, least):
    context = int.from_bytes((ppm.BEFORE + text)[-ppm.DEPTH :]) << 8
    assert (10.0 ** MODELS[least].logs(context + np.arange(256))).sum() == pytest.approx(1, abs=1e-5)


def test_without_training_every_byte_is_as_likely():
    assert ppm.Model(ppm.Trie()).scores([b"abc"])[0] == pytest.approx(4 * math.log10(1 / 256))


def test_long_texts_go_in_parts(monkeypatch):
    def grams():
        return Counter(np.concatenate([ppm.grams_of(p) for _, _, p in ppm._framed_parts(TRAINING)]).tolist())

    whole, counted = MODEL.scores(TRAINING), grams()
    monkeypatch.setattr(ppm, "_BYTES_AT_ONCE", 7)
    assert MODEL.scores(TRAINING) == pytest.approx(whole)
    assert grams() == counted


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 1 << 48), max_size=300), st.lists(st.integers(0, 1 << 48), max_size=50))
def test_table_finds_its_keys_and_no_others(keys, others):
    table = ppm._Table(np.array(sorted(keys), np.int64))
    asked = np.array([*keys, *others], np.int64)
    place = table.find(asked)
    assert [table.keys[p] if p >= 0 else None for p in place] == [k if k in keys else None for k in asked.tolist()]


def check(docs, rows):
    """Every row against plain counts and the plain model."""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    words = lambda t: (t or "").encode().lower().split() + [b""]
    counts = Counter(w for i, t in docs if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(docs)
    by_id = {r.doc_id: r for r in rows}
    for i, t in docs:
        row, own = by_id[i], words(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held(i), len(own), sum(w in counts for w in own), n)


@pytest.mark.parametrize("heavy", [200_000, 5])
def test_odd_rows(odd, nothing, heavy):
    rows = ppm.scored(odd, heavy=heavy).collect()
    check([(i, t) for i, t, *_ in ODD], rows)
    by_id = {r.doc_id: r for r in rows}
    training = [(t or "").encode() for i, t, *_ in ODD if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    for i, t, *_ in ODD[:5]:
        assert by_id[i].score == pytest.approx(plain_score(training, (t or "").encode()), rel=1e-4)
    assert ppm.scored(nothing).count() == 0


@pytest.mark.parametrize("most_grams", [ppm.GRAMS, 40, 0])
def test_scores_use_the_whole_trie_whatever_is_broadcast(on_workers, most_grams):
    """Grams that are not broadcast count as well, and texts of both folds get the price of the whole trie."""
    texts = ["the cat sat on the mat", "a cat and a dog sat", "été au lit", "aaaaaaaaab", "thé cat zat", "", "the dog ran"]
    docs = [(i, f"{texts[i % 7]} {texts[i % 5]} {i % 11}") for i in range(60)]
    training = [t.encode() for i, t in docs if zlib.crc32(str(i).encode()) % 5 != 1]
    assert 0 < len(training) < len(docs)
    rows = ppm.scored(documents(on_workers, docs), most_grams=most_grams, heavy=3).collect()
    check(docs, rows)
    by_id = {r.doc_id: r.score for r in rows}
    for i, t in docs:
        assert by_id[i] == pytest.approx(plain_score(training, t.encode()), rel=1e-5)


@pytest.mark.parametrize("at_once", [1, 50, 1 << 19])
def test_prices_are_those_of_the_whole_model(monkeypatch, at_once):
    """Grams come sorted by their last three context bytes, in batches that cut through them."""
    monkeypatch.setattr(ppm, "_MOST_COUNTED", at_once)
    counted, short = trie(TRAINING), dict(zip(*map(np.ndarray.tolist, trie(TRAINING).orders[2]), strict=True))
    counts = dict(zip(*map(np.ndarray.tolist, counted.orders[5]), strict=True))
    asked = np.concatenate([ppm.grams_of(np.frombuffer(ppm.BEFORE + t + ppm.END, np.uint8)) for t in (b"the dog", b"zz \x00")])
    grams = np.array(sorted({*counts, *asked.tolist()}, key=lambda g: (g >> 8) & 0xFFFFFF), np.int64)
    n = np.array([counts.get(g, 0) for g in grams.tolist()], np.int64)
    rows = pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n), pa.array(n + 1)], names=["gram", "n", "m"])
    batches = (rows.slice(i, 7) for i in range(0, len(grams), 7))
    given = SimpleNamespace(value=(np.array(list(short), np.int64), np.array(list(short.values()), np.int64)))
    out = pa.Table.from_batches(list(ppm._price(batches, given)))
    assert out["gram"].to_pylist() == grams.tolist() and out["m"].to_pylist() == (n + 1).tolist()
    assert out["log"].to_numpy() == pytest.approx(MODEL.logs(grams), rel=1e-5)


def test_only_held_out_rows(on_workers):
    # crc32 of "4" modulo 5 is 1: nothing is left to learn from.
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows = ppm.scored(documents(on_workers, [(i, "abc") for i in ids])).collect()
    assert [r.train_tokens for r in rows] == [0, 0] and all(r.base_score == 0 and r.n_known == 0 for r in rows)
    assert rows[0].score == pytest.approx(4 * math.log10(1 / 256))


def test_registered_query(spark, sf_dir):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op4_ppm_scores"](spark, sf_dir).collect()
    check(docs, rows)
    size = {i: len(t.encode()) + 1 for i, t in docs}
    held = [r for r in rows if r.held_out]
    bits = -sum(r.score for r in held) / math.log10(2) / sum(size[r.doc_id] for r in held)
    assert bits < 4  # order 0 needs 4.5 bits a byte on these texts, no model 8
