import zlib

import numpy as np
import pytest

from dwellmart.llm import toxicity
from dwellmart.llm.queries import QUERIES
from tests.llm.conftest import ODD, documents


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def corpus(on_workers):
    draw = np.random.default_rng(1)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(900):
        text = draw.choice(words, 40).tolist()
        toxic = i % 8 == 0
        for _ in range(3 * toxic):
            text[int(draw.integers(40))] = str(draw.choice(["idiot", "moron", "scum"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic), "x"))
    return documents(on_workers, rows), on_workers.createDataFrame(labels, "doc_id long, toxic int, text string"), rows, labels


def test_held_out_texts(corpus):
    docs, labels, rows, marks = corpus
    toxic = {i for i, t, _ in marks if t}
    got = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    assert len(got) == len(rows) and all(got[i].held_out == held(i) for i, _ in rows)
    out = [i for i, _ in rows if held(i)]
    assert sum(got[i].predicted for i in out if i in toxic) >= 0.8 * sum(i in toxic for i in out)
    assert not any(got[i].predicted for i in out if i not in toxic)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_are_never_learned_from(corpus, on_workers):
    docs, labels, _, marks = corpus
    turned = on_workers.createDataFrame([(i, 1 - t if held(i) else t, x) for i, t, x in marks], labels.schema)
    a, b = ({r.doc_id: r.score for r in toxicity.scored(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_stage_keeps_columns(corpus):
    docs, labels, _, _ = corpus
    kept = toxicity.without_toxic(docs, labels)
    assert kept.schema == docs.schema and 0 < kept.count() < docs.count()


def test_odd_rows_and_labels(odd, nothing, on_workers):
    none = on_workers.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.scored(odd, none).collect()
    assert len(rows) == len(ODD) and all(r.score == 0.5 and r.predicted == 0 for r in rows)
    odd_labels = on_workers.createDataFrame([(None, 1), (1, None), (4, 0), (4, 1), (4, 1), (99, 1)], "doc_id long, toxic int")
    assert toxicity.scored(odd, odd_labels).count() == len(ODD)
    assert toxicity.scored(nothing, odd_labels).count() == 0


def test_labels_are_sampled_to_a_bound(on_workers):
    labels = on_workers.range(4000).selectExpr("id AS doc_id", "int(id % 9 = 0) AS toxic")
    assert 700 < toxicity.training_rows(labels, most=1000).count() < 1300


@pytest.mark.parametrize("labels", [10, 12_000, 12_001, 10**6, 8 * 10**9, 10**11, 10**15])
def test_the_share_of_labels_holds_at_any_size(labels):
    share = toxicity.hashes_taken(labels, 12_000) / toxicity.HASHES
    assert share * labels == pytest.approx(min(labels, 12_000), rel=1e-6)


def test_copies_of_an_id_are_one_example(corpus, on_workers):
    docs, labels, rows, _ = corpus
    one = next(i for i, _ in rows if i % 8 == 0 and not held(i))
    copied = docs.unionByName(documents(on_workers, [rows[one]] * 300))
    models = [toxicity.fit(d, labels) for d in (docs, copied)]
    assert len(models[0].index) and np.array_equal(models[0].index, models[1].index)
    assert models[0].bias == models[1].bias and np.array_equal(models[0].weight, models[1].weight)


def test_features(monkeypatch):
    one = toxicity.features(b"You IDIOT, you.")
    assert np.array_equal(one, toxicity.features(b"you idiot you")) and len(one) == 5
    assert len(toxicity.features(b" ,.! ")) == 0 and len(toxicity.features(b"a b c")) == 6
    text = " ".join(f"w{i}" for i in range(1000)).encode()
    whole = toxicity.features(text)
    monkeypatch.setattr(toxicity, "_CHUNK", 64)
    assert np.array_equal(whole, toxicity.features(text))


def test_ftrl_step_by_its_formula():
    model = toxicity.Ftrl(4)
    at, bias = np.array([3, 7]), 16
    z, n, w = np.zeros(17), np.zeros(17), np.zeros(17)
    for toxic in (1, 1, 0, 1):
        model.learn(at, toxic)
        own = [3, 7, bias]
        for i in own:
            l1 = 0 if i == bias else toxicity.L1
            rate = (toxicity.BETA + np.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2
            w[i] = 0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / rate
        g = (1 / (1 + np.exp(-w[own].sum())) - toxic) * (toxicity.TOXIC_WEIGHT if toxic else 1)
        for i in own:
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / toxicity.ALPHA
            z[i] += g - step * w[i]
            n[i] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_registered_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = QUERIES["op5_toxicity_ftrl"](spark, sf_dir).collect()
    assert len(rows) == docs.count() and all(r.held_out == held(r.doc_id) for r in rows)
