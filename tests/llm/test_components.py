import os

import pytest

from dwellmart.llm.components import component_of
from dwellmart.llm.queries import QUERIES
from dwellmart.llm.stored import stored, temporary


@pytest.mark.parametrize(
    "links, want",
    [
        ([], {}),
        ([(5, 5), (None, 3), (3, None)], {}),
        ([(2, 1), (1, 2), (2, 1)], {1: 1, 2: 1}),
        ([(i, i + 1) for i in range(60)], {i: 0 for i in range(61)}),
        ([(100, i) for i in range(50)], {**{i: 0 for i in range(50)}, 100: 0}),
        ([(-5, 7), (8, 9), (9, 10)], {-5: -5, 7: -5, 8: 8, 9: 8, 10: 8}),
    ],
)
def test_components(spark, links, want):
    found = component_of(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == want and len(found) == len(want)


def test_blocks_remove_what_they_have_stored(on_workers):
    rows = on_workers.range(3).toDF("n")

    def there(frame):
        folder = frame.inputFiles()[0].removeprefix("file:").rpartition("/")[0]
        return os.path.isdir(folder)

    with temporary(on_workers) as keep:
        outer = stored(rows, "outer")
        with temporary(on_workers) as keep_inner:
            inner = stored(rows, "inner")
            handed_on = keep_inner(inner.where("n > 0"), "handed-on")
        assert not there(inner) and there(handed_on) and there(outer)
        result = keep(handed_on.union(outer), "result")
    assert not there(handed_on) and not there(outer)
    assert sorted(r.n for r in result.collect()) == [0, 1, 1, 2, 2]
    with pytest.raises(KeyError), temporary(on_workers):
        failed = stored(rows, "failed")
        raise KeyError
    assert not there(failed)


@pytest.mark.parametrize(
    "query, most",
    [("op1_embedding_forest", 1), ("op6_simhash_vantage_trees", 2), ("op11_spelling_trie", 2), ("op9_quality_votes", 1),
     ("op5_toxicity_ftrl", 0), ("op13_digest_index", 2), ("op12_conversation_repair", 1)],
)
def test_only_what_the_result_reads_is_left(spark, sf_dir, tmp_path, monkeypatch, query, most):
    made = []
    monkeypatch.setattr("dwellmart.llm.stored.shared_folder", lambda _, name: made.append(name) or f"{tmp_path}/{len(made)}")
    rows = QUERIES[query](spark, sf_dir)
    assert len(os.listdir(tmp_path)) <= most and (made or not most)
    assert rows.count() > 0
