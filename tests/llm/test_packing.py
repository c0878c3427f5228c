import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dwellmart.llm import packing
from dwellmart.llm.queries import QUERIES
from tests.llm.conftest import LONG, ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")
LOADED = Tokenizer.from_file(PATH)
OWN = packing.Tokenizer(PATH)


def plain_ids(text):
    return LOADED.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list(" \n\t\r\x0b\xa0ab.,'1é\u3000\x1c\x85s<|>")), max_size=40))
def test_ids_word_by_word_are_those_of_the_text(text):
    assert np.frombuffer(OWN.ids(text), "<u4").tolist() == plain_ids(text)


def test_ids_of_long_texts_and_special_strings(monkeypatch):
    texts = [LONG[:5000], "x <|endoftext|> y<|endoftext|>", "it's I'll  he'd", "a" * 300 + " b", "x \r y\r z"]
    texts += ["ab, ab. ab?! ab,,,, ab.\n ab;x ab", "w², Ⅷ. १, é́, _. 9. naïve; don't, 日本。 日本, ! a! " + "z" * 80 + ", z."]
    want = [plain_ids(t) for t in texts]
    monkeypatch.setattr(packing, "_SLICE", 17)
    monkeypatch.setattr(packing, "MOST_WORDS", 50)
    assert [np.frombuffer(packing.Tokenizer(PATH).ids(t), "<u4").tolist() for t in texts] == want


def test_new_words_of_several_texts_are_encoded_together_and_by_their_parts(monkeypatch):
    own, encoded = packing.Tokenizer(PATH), []
    plain_encode = own._encode
    monkeypatch.setattr(own, "_encode", lambda text: encoded.append(text) or plain_encode(text))
    words = ["alpha", "alpha.", "alpha$$$", "alpha.\nBravo", "alpha\nBravo,", "x \ny", "bravo's", "ab<|endoftext|>", "é²\n9a!"]
    texts = [f"First {word} charlie{chr(97 + n)}" for n, word in enumerate(words * 2)]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in own.ids_of(texts)]
    assert got == [plain_ids(text) for text in texts]
    rest = [text for text in encoded if text != "First"]
    assert len(rest) < len(texts) and sum(text.count("alpha") for text in rest) == 1
    assert "\r" not in "".join(encoded)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 8), st.integers(0, 5)), min_size=1, max_size=14), st.integers(8, 12))
def test_cheapest_cuts_of_all_choices(steps, window):
    at, penalty = [0], [0]
    for size, cost in steps:
        at.append(at[-1] + size)
        penalty.append(cost)
    best = [0.0] + [float("inf")] * len(steps)
    for j in range(1, len(at)):
        best[j] = min(best[i] + window - (at[j] - at[i]) + penalty[j] for i in range(j) if at[j] - at[i] <= window)
    cuts = packing.cheapest_cuts(at, penalty, window)
    cost = sum(window - (at[b] - at[a]) + penalty[b] for a, b in zip(cuts, cuts[1:]))
    assert cost == best[-1] and cuts[0] == 0 and cuts[-1] == len(steps)
    assert all(at[b] - at[a] <= window for a, b in zip(cuts, cuts[1:]))


def check(rows, texts, window):
    """Exact round trip: every id in one piece, sequences gapless and in bounds."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place and length > 0
            place += length
        assert place <= window
    assert set(pieces) == set(texts)
    for doc_id, copies in texts.items():
        ids = [*plain_ids(copies[0]), 1]
        own = sorted(pieces[doc_id], key=lambda r: r.start)
        assert sum(r.length for r in own) == len(ids) * len(copies)
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part), len(ids))
    return sum(r.length for r in rows) / (window * len(sequences))


@pytest.mark.parametrize("window", [2048, 64])
def test_odd_rows(odd, nothing, window):
    texts = defaultdict(list)
    for doc_id, text, *_ in ODD:
        texts[doc_id].append(text)
    check(packing.pack(odd, window=window, shard_windows=4).collect(), texts, window)
    assert packing.pack(nothing).count() == 0


def test_order_is_kept_within_a_task(odd):
    rows = sorted(packing.pack(odd.coalesce(1)).collect(), key=lambda r: (r.sequence_id, r.offset))
    seen = list(dict.fromkeys(r.doc_id for r in rows))
    assert seen == list(dict.fromkeys(i for i, *_ in [tuple(r) for r in odd.coalesce(1).collect()]))


def test_registered_query_round_trip(spark, sf_dir):
    texts = {d.doc_id: [d.text] for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    filled = check(QUERIES["op10_packing_windows"](spark, sf_dir).collect(), texts, 2048)
    assert filled > 0.97


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é9²,.!?;:'_\r\n\t\u00a0\u0301Ⅷ日")))
def test_ids_are_those_of_the_whole_text(text):
    assert np.frombuffer(packing._tokenizer(PATH).ids(text), "<u4").tolist() == plain_ids(text)
