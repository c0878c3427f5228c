"""Token counts under a unigram segmentation, computed once for each shared prefix in a trie.

A word is segmented into the pieces of a vocabulary so that the sum of their scores is highest. The forward score
of a prefix does not depend on what follows, so a task keeps the words it has met in a trie whose nodes
hold the best score and the token count of their prefix. A new word goes down the trie as far as others
went before, and only the nodes that it adds are scored. The count of the node where a word ends is its
token count, and documents are sums over their words.

The trie is bounded in its nodes and the words that are remembered in their number; what is over is forgotten as a whole
and built again as words come, which changes no count. Texts stay where they are: nothing is shuffled.

Scores come with the vocabulary, as a table of pieces or a file. Of the public files none is a unigram
model and tokenizers are not trained here, so the scores of such a file are made from the ranks of its pieces.
"""

from array import array
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dwellmart.llm.stored import text_bytes

#: What stands for the space before a word in the vocabulary.
SPACE = "▁"
#: A character without a piece is this much worse than the worst piece, and one token for each of its bytes.
UNKNOWN_GAP = 10.0
#: Words a task remembers, and nodes of its trie: about 130 bytes each.
MOST_WORDS, MOST_NODES = 1 << 20, 1 << 20
_NOT_PIECES = -1e6


class Vocabulary:
    """Pieces and their scores; pieces that only serve as merge steps of another model are left out."""

    def __init__(self, pieces: dict[str, float]):
        self.scores = pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_GAP
        ends: dict[str, list[int]] = {}
        for piece in pieces:
            ends.setdefault(piece[-1], []).append(len(piece))
        #: The lengths that pieces ending in a character have, short ones first.
        self.lengths = {char: sorted(set(found)) for char, found in ends.items()}


@cache
def vocabulary_of(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece file. A score is the logarithm of Zipf's law for the piece's rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranks = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.get_score(i) < _NOT_PIECES):
            ranks[model.id_to_piece(i)] = -model.get_score(i)
    return Vocabulary({piece: -float(np.log(rank + 2.7)) for piece, rank in ranks.items()})


class Trie:
    """Prefixes of words, each with the score and the number of tokens of its best segmentation."""

    def __init__(self, vocabulary: Vocabulary, most_nodes: int = MOST_NODES):
        self.vocabulary, self.most_nodes = vocabulary, most_nodes
        self.clear()

    def clear(self) -> None:
        #: Number of a node and code point of the character after it -> number of the next node.
        self.child: dict[int, int] = {}
        self.score, self.tokens = array("d", [0.0]), array("q", [0])

    def count(self, word: str) -> int:
        """Tokens of the best segmentation; of equally good ones, that whose last piece is shortest."""
        if len(self.score) > self.most_nodes:
            self.clear()
        child, node, path = self.child, 0, [0]
        for end, char in enumerate(word, 1):
            step = node << 21 | ord(char)
            node = child.get(step)
            if node is None:
                node = child[step] = len(self.score)
                self._score(word, end, path)
            path.append(node)
        return self.tokens[path[-1]]

    def _score(self, word: str, end: int, path: list[int]) -> None:
        """Add the node of ``word[:end]``, whose shorter prefixes stand along ``path``."""
        vocabulary, score, tokens = self.vocabulary, self.score, self.tokens
        char = word[end - 1]
        best = score[path[-1]] + vocabulary.unknown
        number = tokens[path[-1]] + len(char.encode("utf-8", "replace"))
        for length in vocabulary.lengths.get(char, ()):
            if length > end:
                break
            gain = vocabulary.scores.get(word[end - length : end])
            if gain is not None:
                before = path[end - length]
                if score[before] + gain > best:
                    best, number = score[before] + gain, tokens[before] + 1
        score.append(best)
        tokens.append(number)


class Counter:
    """Token counts of words, each distinct word segmented once for as long as it is remembered."""

    def __init__(self, vocabulary: Vocabulary, most_words: int = MOST_WORDS, most_nodes: int = MOST_NODES):
        self.trie = Trie(vocabulary, most_nodes)
        self.most_words = most_words
        self.known: dict[bytes, int] = {}

    def learn(self, words: set[bytes]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > self.most_words:
            self.known.clear()
            new = words
        for word in new:
            self.known[word] = self.trie.count(SPACE + word.decode("utf-8", "replace"))

    def counts(self, texts: list[list[bytes]]) -> list[int]:
        self.learn(set().union(*texts))
        known = self.known
        return [sum(map(known.__getitem__, words)) for words in texts]


@cache
def _counter(path: str) -> Counter:
    return Counter(vocabulary_of(path))


def _count(batches: Iterator[pa.RecordBatch], vocabulary: str | dict[str, float]) -> Iterator[pa.RecordBatch]:
    counter = _counter(vocabulary) if isinstance(vocabulary, str) else Counter(Vocabulary(vocabulary))
    for batch in batches:
        texts = [text.split() for text in batch.column("text").to_pylist()]
        columns = [
            batch.column("doc_id"),
            pa.array([len(words) for words in texts], pa.int64()),
            pa.array(counter.counts(texts), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens"])


def counted(docs: DataFrame, vocabulary: str | dict[str, float] | None = None) -> DataFrame:
    """Documents -> (doc_id, n_words, n_tokens), one row per row, repeated rows too.

    Words are parted by ASCII white space and looked up as they are written. ``vocabulary`` is a table of
    pieces and their scores, or the path of a SentencePiece file that every executor has. NULL and empty texts have no tokens. An empty table gives no
    rows. Extra columns are not read.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    given = vocabulary if isinstance(vocabulary, dict) else str(vocabulary)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_bytes(docs["text"]).alias("text"))
    return rows.mapInArrow(partial(_count, vocabulary=given), f"doc_id {kind}, n_words long, n_tokens long")
