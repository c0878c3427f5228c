from collections import defaultdict

import numpy as np
import pytest
import xxhash

from dwellmart.llm import simhash
from dwellmart.llm.queries import QUERIES
from tests.llm.conftest import ODD, documents


def plain_fingerprint(text):
    """Bit by bit, from the definition."""
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((sum(h >> bit & 1 for h in hashes) * 2 > len(hashes)) << bit for bit in range(64))


def groups(prints, max_bits=4):
    """Smallest id reachable, by comparing all pairs."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_fingerprint_by_definition(monkeypatch):
    monkeypatch.setattr(simhash, "_CHUNK", 50)  # long texts go in parts
    for text in ["", "one", "One two THREE", "a b c d", "a b c d e", "é É x y z", " ".join(map(str, range(500)))]:
        assert simhash.fingerprint_of(text.encode()) % 2**64 == plain_fingerprint(text), text


def test_fingerprint_is_the_hash_of_spark(on_workers):
    got = on_workers.sql("SELECT xxhash64('a b c d') AS h").first().h
    assert simhash.fingerprint_of(b"a b c d") == got


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 7])
def test_radii_leave_no_pair_out(bits):
    radii = simhash.lane_radii(bits)
    assert sum(r + 1 for r in radii) == bits + 1 and len(radii) == 4


def test_tree_search_reaches_every_value_in_the_ball():
    home, starts, shards = simhash.vantage_tree(1)
    for value in np.random.default_rng(3).integers(0, simhash.VALUES, 300).tolist():
        near = [value, *(value ^ (1 << bit) for bit in range(16))]
        assert set(home[near].tolist()) == set(shards[starts[value] : starts[value + 1]].tolist())


def linked(spark, prints, max_bits=4):
    frame = spark.createDataFrame([(int(p),) for p in prints], "print long")
    found = simhash.print_links(frame, max_bits).collect()
    return {(r.a, r.b) for r in found}


@pytest.mark.parametrize("tile", [4096, 16])
def test_links_span_the_groups_of_all_pairs(on_workers, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)  # small tiles: every busy shard is dealt out
    draw = np.random.default_rng(5)
    centres = draw.integers(-(2**62), 2**62, 40)
    near = [int(c) ^ sum(1 << int(b) for b in draw.choice(63, n, replace=False)) for c in centres for n in range(6)]
    one_lane = [5 << 48 | i for i in range(200)]
    prints = sorted({*map(int, centres), *near, *one_lane, 0, -1})
    links = linked(on_workers, prints)
    assert all(((a ^ b) % 2**64).bit_count() <= 64 and a != b for a, b in links)
    want = groups({p: p % 2**64 for p in prints})
    by_links = {p: p for p in prints}
    for _ in range(20):
        for a, b in links:
            by_links[a] = by_links[b] = min(by_links[a], by_links[b])
    same = defaultdict(set)
    for p in prints:
        same[want[p]].add(by_links[p])
    assert all(len(v) == 1 for v in same.values()) and len({min(v) for v in same.values()}) == len(same)


def test_odd_rows(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    for doc_id, text, *_ in ODD:
        assert got[doc_id][0] == f"{plain_fingerprint(text):016x}"
    assert got[1] == got[2] == got[3] == ("0" * 16, 1)
    assert got[4][1] == got[6][1] == 4 and got[None][1] is None and got[5][1] == 5
    empty = simhash.near_duplicates(nothing)
    assert empty.columns == ["doc_id", "fingerprint", "component_id"] and empty.count() == 0


def test_one_of_each_group_keeps_columns_and_the_smallest_id(odd, nothing):
    kept = simhash.one_of_each_group(odd)
    assert kept.schema == odd.schema
    rows = kept.collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 4, 5, 7]
    assert simhash.one_of_each_group(nothing).count() == 0


def test_large_group_of_copies(on_workers):
    texts = [(i, "the very same text of a few words" if i % 3 == 0 else f"text {i} on its own {i * 7}") for i in range(300)]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(on_workers, texts)).collect()}
    assert all(got[i] == 0 for i in range(0, 300, 3))


def test_registered_query_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    want = groups(prints)
    rows = QUERIES["op6_simhash_vantage_trees"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{p:016x}", want[i]) for i, p in prints.items()
    }
