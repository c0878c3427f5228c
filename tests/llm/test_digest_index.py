import hashlib
from collections import defaultdict

import pytest

from dwellmart.llm import digest_index
from dwellmart.llm.digest_index import DigestIndex, deduplicated
from dwellmart.llm.queries import ORACLES, QUERIES
from tests.comparison import duckdb_bag, duckdb_on, spark_bag
from tests.llm.conftest import LONG, ODD, documents

GONE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def bare(text):
    return (text or "").translate(GONE)


def expected(rows):
    """(doc_id, keep_id, group_size, kept, sha) of every row, by definition."""
    groups = defaultdict(list)
    for place, (doc_id, text) in enumerate(rows):
        groups[bare(text)].append((-len(text or ""), doc_id is None, doc_id or 0, place, doc_id))
    found = []
    for text, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(text.encode()).hexdigest()
        found += [(m[4], best[4], len(members), m is best, sha) for m in members]
    return found


def as_list(frame):
    return sorted(frame.collect(), key=repr)


def same(got, rows):
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected(rows)))


def test_odd_rows(odd):
    same(deduplicated(odd), [r[:2] for r in ODD])


def test_ties_white_space_and_length(on_workers):
    rows = [
        (5, "a b"), (3, "ab"), (4, "a\tb"), (9, "a  b"), (8, "a  b"), (2, "AB"), (1, " "), (0, None),
        (7, "é\n" + LONG), (6, "é" + LONG), (None, "ab"), (None, "a \n\x0b\x0c\rb"),
    ]
    same(deduplicated(documents(on_workers, rows)), rows)


def test_nothing(nothing):
    assert deduplicated(nothing).count() == 0


def test_one_text_in_a_third_of_all_rows(on_workers, monkeypatch):
    monkeypatch.setattr(digest_index, "LARGE_SHARE", 8)
    rows = [(i, "same text" if i % 3 == 0 else f"text {i % 40}") for i in range(600)]
    same(deduplicated(documents(on_workers, rows)), rows)


def test_later_batches_meet_earlier_ones(on_workers, folder):
    first, second = [(1, "one"), (2, "o n e"), (3, "two")], [(4, "t w o"), (5, "three"), (6, "three"), (7, "one")]
    index = DigestIndex(on_workers, folder, 4)
    same(index.add(documents(on_workers, first), "a"), first)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in index.add(documents(on_workers, second), "b").collect()}
    assert got == {4: (3, 1, False), 5: (5, 2, True), 6: (5, 2, False), 7: (2, 1, False)}
    assert sorted(r.doc_id for r in index.entries().collect()) == [2, 3, 5]


def test_a_batch_added_again_changes_nothing(on_workers, folder):
    first, second = [(1, "one"), (3, "two")], [(4, "two"), (5, "three")]
    index = DigestIndex(on_workers, folder, 4)
    verdicts = [as_list(index.add(documents(on_workers, rows), name)) for name, rows in (("a", first), ("b", second))]
    entries = as_list(index.entries())
    # Another session opens the index, whose number of buckets it reads, and runs both jobs again.
    other = DigestIndex(on_workers.newSession(), folder)
    assert other.buckets == 4
    again = [as_list(other.add(documents(other.spark, rows), name)) for name, rows in (("a", first), ("b", second))]
    assert again == verdicts and as_list(other.entries()) == entries


def test_a_new_index_needs_buckets(on_workers, folder):
    with pytest.raises(ValueError, match="buckets"):
        DigestIndex(on_workers, folder)


def test_the_index_is_not_shuffled(on_workers, folder):
    index = DigestIndex(on_workers, folder, 8)
    index.add(documents(on_workers, [(i, f"text {i}") for i in range(50)]), "a")
    fresh = on_workers.range(9).selectExpr("unhex(sha2(cast(id AS string), 256)) AS digest")
    before = on_workers.conf.get("spark.sql.shuffle.partitions")
    assert before == "8"
    plan = index.new_entries(fresh, "b")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan


def test_query_matches_sql_without_python(spark, sf_dir):
    result = QUERIES["op13_digest_index"](spark, sf_dir)
    assert "Python" not in result._jdf.queryExecution().executedPlan().toString()
    assert spark_bag(result) == duckdb_bag(duckdb_on(sf_dir), ORACLES["op13_digest_index"])
