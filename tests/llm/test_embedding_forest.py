from collections import defaultdict

import numpy as np
import pytest

from dwellmart.llm import embedding_forest as forest
from dwellmart.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, tree string, path string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


def plain(rows, least=0.98):
    """(n_links, component) of each row by all pairs of its label."""
    unit = {}
    for vec_id, vector, label in rows:
        v = np.array([np.nan if x is None else x for x in vector or []], np.float64)
        usable = label is not None and len(v) and np.isfinite(v).all() and v.any()
        unit[vec_id] = (label, v / np.linalg.norm(v)) if usable else (None, None)
    result = {}
    by_label = defaultdict(list)
    for i, (label, _) in unit.items():
        if label is None:
            result[i] = (0, i)
        else:
            by_label[label].append(i)
    for ids in by_label.values():
        ids = sorted(ids)
        x = np.stack([unit[i][1] for i in ids])
        near = x @ x.T >= least
        np.fill_diagonal(near, False)
        smallest = forest.smallest_linked(len(ids), *np.nonzero(near))
        result |= {i: (int(near[k].sum()), ids[smallest[k]]) for k, i in enumerate(ids)}
    return result


def got(frame):
    return {r.vec_id: (r.n_links, r.component_id) for r in frame.collect()}


def clustered(n, dim=24, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((n // 12, dim))
    rows = [centres[i % len(centres)] + 0.12 * draw.random() * draw.standard_normal(dim) for i in range(n)]
    return [(i, [float(np.float32(x)) for x in v], i % 2) for i, v in enumerate(rows)]


@pytest.mark.parametrize("leaf, tile", [(512, 1024), (40, 1024), (40, 16)])
def test_links_of_all_pairs(on_workers, monkeypatch, leaf, tile):
    monkeypatch.setattr(forest, "TILE", tile)
    rows = clustered(700)
    rows += [(1000 + i, rows[3][1], 1) for i in range(60)]  # copies
    tight = np.random.default_rng(2).standard_normal(24)
    draw = np.random.default_rng(3)
    rows += [(2000 + i, (tight + 1e-3 * draw.standard_normal(24)).tolist(), 0) for i in range(150)]  # no split parts these
    want = plain([(i, np.float32(v).tolist(), label) for i, v, label in rows])
    found = got(forest.near_duplicates(vectors(on_workers, rows), leaf=leaf))
    assert found == want
    assert sum(n for n, _ in want.values()) > 1000


def test_odd_vectors(on_workers):
    inf, nan = float("inf"), float("nan")
    rows = [
        (9, [1.0, 0.0], 1), (2, [2.0, 0.001], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [], 1), (12, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.0], 1), (13, [3e38, 3e38], 3), (14, [1.0, 1.0], 3),
    ]
    found = forest.near_duplicates(vectors(on_workers, rows + [rows[0]]))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    by_id = defaultdict(list)
    for r in found.collect():
        by_id[r.vec_id].append((r.n_links, r.component_id, r.kept))
    assert by_id[9] == [(3, 2, False)] * 2 and by_id[2] == [(3, 2, True)] and by_id[None] == [(3, 2, False)]
    assert all(by_id[i] == [(0, i, True)] for i in (3, 4, 5, 6, 7, 8, 10, 11, 12))
    assert by_id[13] == [(1, 13, True)] and by_id[14] == [(1, 13, False)]
    assert forest.near_duplicates(vectors(on_workers, [])).count() == 0


def test_registered_query_against_all_pairs(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = QUERIES["op1_embedding_forest"](spark, sf_dir)
    assert got(found) == plain(rows)


def test_double_vectors_keep_their_digits(on_workers):
    rows = clustered(200) + [(1002, [1.0, 1e-9], 6), (1003, [1.0, 0.0], 6)]
    large = [(1000, [1e300, 1e300], 5), (1001, [2e300, 2e300], 5)]  # too large for single precision
    frame = on_workers.createDataFrame(rows + large, "vec_id long, embedding array<double>, label int")
    found = got(forest.near_duplicates(frame, leaf=40))
    # The lengths of the large ones overflow in the plain version.
    assert found == plain(rows) | {1000: (1, 1000), 1001: (1, 1000)}
