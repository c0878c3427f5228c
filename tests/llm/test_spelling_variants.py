import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from dwellmart.llm import spelling_variants as variants_of
from dwellmart.llm.queries import QUERIES
from dwellmart.llm.spelling_variants import Trie, counted_words, near_words, root_of, variants
from tests.llm.conftest import ODD, documents

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_counts(docs, least=6, least_count=5, every=199):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= least_count}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = sorted((a, b), key=len, reverse=True)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_near(words):
    """All near words of each, from the words that deleting or replacing one letter leads to."""
    words = set(words)
    holes, near = {}, {word: set() for word in words}
    for word in words:
        for i in range(len(word)):
            less = word[:i] + word[i + 1 :]
            if less in words:
                near[word].add(less)
                near[less].add(word)
            holes.setdefault((i, less), []).append(word)
    for same in holes.values():
        for word in same:
            near[word].update(w for w in same if w != word)
    return near


def plain_variants(counts):
    near, out = plain_near(counts), {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        out[word] = [best if best and counts[best] >= 5 * n else None, word, n, len(near[word]), None]
        out[word][4] = counts[out[word][0]] if out[word][0] else None
    for word, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {word: tuple(row) for word, row in out.items()}


def table(spark, counts):
    return spark.createDataFrame([*counts.items()], "word string, n long")


def as_dict(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def made_up(seed, n, letters="abcdeéÿ", sizes=(6, 7, 8)):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(n)}
    return {word: rng.choice((5, 6, 30, 200, 1200)) for word in sorted(words)}


def test_the_plain_search_finds_what_the_definition_says():
    words = [*made_up(3, 150, "ab")]
    near = plain_near(words)
    assert all((b in near[a]) == one_apart(a, b) for a in words for b in words if a != b)


@pytest.mark.parametrize("letters, groups", [("ab", 12), ("abcdeéÿ", 12), ("abcdeéÿ", 1), ("abcdefghijklmnopqrstuvwxyzà÷", 12)])
def test_trie_gives_each_pair_once(letters, groups, monkeypatch):
    monkeypatch.setattr(variants_of, "_PAIR_BYTES", 300)
    words = [*made_up(1, 400, letters)]
    by_size = {size: [w for w in words if len(w) == size] for size in (6, 7, 8)}
    found = []
    for size, members in by_size.items():
        trie = Trie(members, groups)
        for queries in (by_size[size], by_size.get(size + 1, [])):
            if queries:
                for left, right in trie.near(queries):
                    found += [frozenset((queries[i], members[j])) for i, j in zip(left, right, strict=True)]
    assert len(found) == len(set(found))
    assert set(found) == {frozenset((a, b)) for a, near in plain_near(words).items() for b in near}


def test_checksum_of_a_prefix_and_a_run():
    counts = variants_of._Counts(1, 7)
    rng = np.random.default_rng(0)
    for size in [1, 2, 5, 300]:
        run, prefix = rng.bytes(size), rng.bytes(9)
        shifted = counts._shift(zlib.crc32(prefix), size)
        assert zlib.crc32(run) ^ shifted == zlib.crc32(prefix + run)


@pytest.mark.parametrize("every, most", [(0, 1 << 19), (2, 1 << 19), (199, 3)])
def test_counts(on_workers, odd, monkeypatch, every, most):
    monkeypatch.setattr(variants_of, "MOST_RUNS", most)
    texts = [(i, f"Étude ÉTUDES étude× voilàvoilà ab{'c' * (i % 7)}DEF 1abcdefg2 Āabcdefā a-b naïvely") for i in range(60)]
    rows = [*[r[:2] for r in ODD], *texts]
    got = counted_words(documents(on_workers, rows), every=every)
    assert {r.word: r.n for r in got.collect()} == plain_counts(rows, every=every)


@pytest.mark.parametrize(
    "groups, shard_words, shard_queries", [(12, 8192, 1 << 17), (12, 20, 1 << 17), (12, 20, 16), (2, 10, 16), (1, 5, 7)]
)
def test_near_words_whatever_the_cut(on_workers, groups, shard_words, shard_queries):
    counts = made_up(5, 500)
    rows = near_words(table(on_workers, counts), groups, shard_words, shard_queries).collect()
    got = [(r.word, r.near) for r in rows]
    assert sorted(got) == sorted((a, b) for a, near in plain_near(counts).items() for b in near)
    assert all(counts[r.near] == r.near_n for r in rows)


def test_variants_with_ties_chains_and_long_words(on_workers):
    counts = made_up(9, 700) | {"x" * 70_000: 9, "x" * 69_999: 90, "y" + "x" * 69_999: 700}
    counts |= {"chains": 5, "chainsa": 25, "chainsab": 125, "chainsabc": 625, "lonely": 8}
    counts |= {"tiedoff": 5, "tiedofg": 25, "tiedofh": 25}
    got = as_dict(variants(table(on_workers, counts)))
    assert got == plain_variants(counts)
    assert got["chains"][1] == "chainsabc" and got["tiedoff"][0] == "tiedofg"


def test_nothing(on_workers, nothing):
    assert variants(counted_words(nothing)).count() == 0
    assert variants(on_workers.createDataFrame([], "word string, n long")).count() == 0


def test_null_and_empty_words(on_workers):
    rows = [(None, 9), ("", 9), ("a", 50), ("ab", 5)]
    got = {r.word: r.form for r in variants(on_workers.createDataFrame(rows, "word string, n long")).collect()}
    assert got == {None: None, "": None, "a": None, "ab": "a"}


def test_roots_of_long_chains(on_workers):
    forms = on_workers.createDataFrame([(str(i), str(i + 1)) for i in range(37)], "word string, form string")
    assert {r.root for r in root_of(forms).collect()} == {"37"}


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    got = as_dict(QUERIES["op11_spelling_trie"](spark, sf_dir))
    assert got == plain_variants(plain_counts(docs)) and any(row[0] for row in got.values())
