import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from dwellmart.llm import token_counts as counts
from dwellmart.llm.queries import QUERIES
from tests.llm.conftest import ODD, documents

VOCABULARY = counts.vocabulary_of(public_tokenizers.path("piece_bpe_32k.model"))
SMALL = counts.Vocabulary({"▁": -3.0, "a": -2.0, "ab": -2.5, "b": -2.0, "▁a": -2.0, "aba": -2.5, "bab": -9.0})


def plain(word, vocabulary=VOCABULARY):
    """Tokens of one word by the whole table, no prefix shared."""
    score, tokens = [0.0], [0]
    for end in range(1, len(word) + 1):
        best = (score[end - 1] + vocabulary.unknown, tokens[end - 1] + len(word[end - 1].encode()))
        for start in range(end - 1, -1, -1):
            gain = vocabulary.scores.get(word[start:end])
            if gain is not None and score[start] + gain > best[0]:
                best = (score[start] + gain, tokens[start] + 1)
        score.append(best[0])
        tokens.append(best[1])
    return tokens[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text("abcz", min_size=1, max_size=12), max_size=6), max_size=5), st.integers(1, 20), st.integers(1, 40))
def test_shared_prefixes_change_nothing(texts, most, nodes):
    counter = counts.Counter(SMALL, most, nodes)
    got = counter.counts([[w.encode() for w in words] for words in texts])
    assert got == [sum(plain("▁" + w, SMALL) for w in words) for words in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.text("abcz", max_size=8), max_size=9), max_size=4))
def test_each_prefix_is_scored_once_in_a_task(batches):
    counter, scored = counts.Counter(SMALL), []
    score = counter.trie._score
    counter.trie._score = lambda word, end, path: (scored.append(word[:end]), score(word, end, path))
    for batch in batches:
        counter.counts([[word.encode() for word in batch]])
    prefixes = {("▁" + word)[:end] for batch in batches for word in batch for end in range(1, len(word) + 2)}
    assert sorted(scored) == sorted(prefixes)
    assert len(counter.trie.score) == len(prefixes) + 1


def test_a_table_of_scores_may_be_given(on_workers):
    docs = documents(on_workers, [(1, "ab aba b"), (2, "ü"), (3, None)])
    got = {r.doc_id: r.n_tokens for r in counts.counted(docs, dict(SMALL.scores)).collect()}
    assert got == {1: sum(plain("▁" + w, SMALL) for w in ("ab", "aba", "b")), 2: plain("▁ü", SMALL), 3: 0}


def test_odd_rows(odd, nothing):
    rows = counts.counted(odd).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: (r.n_words, r.n_tokens) for r in rows}
    for doc_id, text, *_ in ODD:
        words = [w.decode() for w in (text or "").encode().split()]
        assert by_id[doc_id] == (len(words), sum(plain("▁" + w) for w in words)) or len(words) > 1000
    assert by_id[1] == by_id[2] == by_id[3] == (0, 0)
    assert counts.counted(nothing).count() == 0


def test_registered_query_against_plain_tables(spark, sf_dir):
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    known = {}
    for row in QUERIES["op2_token_counts_trie"](spark, sf_dir).collect():
        words = [w.decode() for w in texts[row.doc_id].encode().split()]
        for w in set(words) - set(known):
            known[w] = plain("▁" + w)
        assert (row.n_words, row.n_tokens) == (len(words), sum(known[w] for w in words))
