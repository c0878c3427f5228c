"""Packing token ids into windows by dynamic programming that keeps the order of the documents.

A task tokenizes its documents in their stored order and packs them shard by shard, a shard being
``SHARD_WINDOWS`` windows' worth of tokens. Inside a shard, windows may end at the end of a document, at
the end of a sentence, or, where none is near, at a fixed grid. The cost of a window is its padding plus a
penalty for the cut at its end, and the cheapest chain of windows is found in one pass: of all
earlier cuts within reach the best stands at the head of a monotone queue. The rest of a shard is its
last window. Nothing is shuffled; a lost task is packed again to the same windows.

Texts are tokenized word by word with the ids of earlier words kept, which gives the ids of the whole
text: the tokenizer's own splitting never joins a space that a visible character follows to what is
before it.
"""

import re
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from dwellmart.llm.stored import text_bytes

WINDOW = 2048
#: Token that ends every document.
END_ID = 1
SHARD_WINDOWS = 256
#: Costs of a cut, in tokens of padding.
SENTENCE_CUT, INNER_CUT = 2, 24
#: A stretch without a sentence end gets cuts at this distance.
GRID = 32
#: Words whose ids a worker keeps, and the longest of them.
MOST_WORDS, LONGEST_WORD = 1 << 20, 64
#: Characters that are tokenized at a time.
_SLICE = 1 << 20
#: Characters of short texts whose new words are learned together.
_GROUP = 1 << 18
_ODD_SPACE = re.compile(r" (?:\s|$)")
#: Letters, marks behind them if any, and the same again on a new line if there is one. A mark is no apostrophe.
_LETTERS, _MARKS = r"[^\W\d_]+", r"[!-&(-/:-@\[-^`{-~]"
_PARTED = re.compile(rf"({_LETTERS})(?:({_MARKS}{{1,3}})|({_MARKS}{{0,3}})(\n{_LETTERS})({_MARKS}{{0,3}}))")
_SPACE_BEFORE_WORD = re.compile(r" (?=\S)")


class Tokenizer:
    """Ids of whole texts by a byte-level BPE file, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Loaded

        self.loaded = Loaded.from_file(path)
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        tokens = self.loaded.get_vocab().items()
        self.after_space = np.zeros(self.loaded.get_vocab_size(), bool)
        self.after_space[[i for token, i in tokens if token.startswith("\u0120")]] = True  # the space there
        self.new_line = self._encode("\n")[0]

    def _encode(self, text: str) -> np.ndarray:
        # This call leaves out the places of the tokens in the text.
        return np.array(self.loaded.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: Iterable[str], known: dict[str, bytes]) -> None:
        """Ids of words with the space before them. Words without another space are learned in one call, where
        each begins with a token that begins with its space.

        The tokenizer splits between letters, marks and a line break, so a word of these is put together from
        its parts, which are often known or new in another form too. Letters on a new line are known with their
        line break.
        """
        plain, lines, odd, parted = {}, {}, [], []
        match = _PARTED.fullmatch
        for word in words:
            if word.isalpha():
                plain[word] = None
                continue
            parts = match(word)
            if parts is not None:
                letters, marks, more, line, last = parts.groups("")
                parted.append((word, letters, marks or more, line, last))
                if letters not in known:
                    plain[letters] = None
                if line and line not in known:
                    lines[line] = None
            elif " " in word or word[-1:].isspace():
                odd.append(word)
            else:
                plain[word] = None
        if plain:
            ids = self._encode(" " + " ".join(plain))
            self._keep(plain, ids, self.after_space[ids], known)
        if lines:
            ids = self._encode("".join(lines))
            self._keep(lines, ids, ids == self.new_line, known)
        for word in odd:
            known[word] = self._encode(f" {word}").tobytes()
        for word, letters, marks, line, last in parted:
            for some in (marks, last):
                if some not in self.marks:
                    self.marks[some] = self._encode(some).tobytes()
            ids = known[letters] + self.marks[marks]
            known[word] = ids + known[line] + self.marks[last] if line else ids

    @staticmethod
    def _keep(words: Iterable[str], ids: np.ndarray, begins: np.ndarray, known: dict[str, bytes]) -> None:
        starts = (4 * np.flatnonzero(begins)).tolist()
        raw = ids.tobytes()
        for word, start, end in zip(words, starts, [*starts[1:], len(raw)], strict=True):
            known[word] = raw[start:end]

    def ids(self, text: str) -> bytes:
        return next(self.ids_of([text]))

    def ids_of(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text in turn. New words of several short texts are learned together."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size > _SLICE:
                *short, text = held
                yield from self._together(short)
                yield b"".join(self._together([part])[0] for part in _slices(text))
            elif size >= _GROUP:
                yield from self._together(held)
            else:
                continue
            held, size = [], 0
        yield from self._together(held)

    def _together(self, texts: list[str]) -> list[bytes]:
        firsts, words, ends = [], [], []
        for text in texts:
            first, *rest = _SPACE_BEFORE_WORD.split(text) if _ODD_SPACE.search(text) else text.split(" ")
            firsts.append(first)
            words += rest
            ends.append(len(words))
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        known = self.known
        found = list(map(known.get, words))
        missing = [place for place, ids in enumerate(found) if ids is None]
        if missing:
            new = {words[place] for place in missing}
            self._learn(new, known)
            for place in missing:
                found[place] = known[words[place]]
            for word in new:
                if len(word) > LONGEST_WORD:
                    parts = _PARTED.fullmatch(word)
                    for some in (word, *(parts.group(1, 4) if parts is not None else ())):
                        known.pop(some, None)
        starts = [0, *ends]
        return [
            self._encode(first).tobytes() + b"".join(found[start:end])
            for first, start, end in zip(firsts, starts, ends)
        ]

    def sentence_ends(self) -> np.ndarray:
        """For each id, whether a sentence may end after it."""
        ends = np.zeros(self.loaded.get_vocab_size(), bool)
        for token, i in self.loaded.get_vocab().items():
            ends[i] = "Ċ" in token or token.rstrip("\"')").endswith((".", "!", "?"))  # U+010A is \n there
        return ends


def _slices(text: str) -> Iterator[str]:
    """Parts of a long text that can be tokenized by themselves, the space before a part left with it."""
    start = 0
    while len(text) - start > _SLICE:
        cut = _SPACE_BEFORE_WORD.search(text, start + _SLICE)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


@cache
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


@cache
def _ends(path: str) -> np.ndarray:
    return _tokenizer(path).sentence_ends()


def cheapest_cuts(at: list[int], penalty: list[int], window: int) -> list[int]:
    """Indexes of the cuts, first and last included, that cost least in padding and penalties.

    ``at`` are the places where a cut is allowed, ascending from 0 and nowhere further apart than a
    window. The tail of the last window is padding too.
    """
    n = len(at)
    # The cost of the windows up to a cut plus its place, which is so much a window and the penalties.
    key, before = [0] * n, [0] * n
    queue = deque([0])
    i, reach, cost = 0, window, window
    for j in range(1, n):
        place = at[j]
        if place > reach:
            while at[queue[0]] < place - window:
                queue.popleft()
            i = queue[0]
            reach, cost = at[i] + window, key[i] + window
        before[j] = i
        key[j] = new = cost + penalty[j]
        # The head costs a window less and stays.
        while key[queue[-1]] >= new:
            queue.pop()
        queue.append(j)
    path = [n - 1]
    while path[-1]:
        path.append(before[path[-1]])
    return path[::-1]


def allowed_cuts(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray) -> tuple[list[int], list[int]]:
    """Places of cuts in a shard and their penalties. ``doc_ends`` ascends to the shard's length."""
    n = len(ids)
    # The penalty of a cut after each token, or -1 for none.
    costs = np.full(n + 1, -1)
    costs[np.flatnonzero(sentence_end[ids]) + 1] = SENTENCE_CUT
    costs[doc_ends] = 0
    costs[0] = 0
    edges = np.flatnonzero(costs >= 0)
    far = np.flatnonzero(np.diff(edges) > 2 * GRID)
    for low, high in zip(edges[far].tolist(), edges[far + 1].tolist(), strict=True):
        costs[low + GRID : high : GRID] = INNER_CUT
    places = np.flatnonzero(costs >= 0)
    return places.tolist(), costs[places].tolist()


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def pack_shard(docs: list[tuple[int | None, bytes]], sentence_end: np.ndarray, first_sequence: int, window: int = WINDOW):
    """Pieces of one shard of (doc_id, ids) as a record batch, and its number of windows."""
    sizes = np.array([len(ids) // 4 for _, ids in docs])
    doc_ends = np.cumsum(sizes)
    everything = b"".join(ids for _, ids in docs)
    at, penalty = allowed_cuts(np.frombuffer(everything, "<u4"), doc_ends, sentence_end)
    cuts = np.array([at[i] for i in cheapest_cuts(at, penalty, window)])
    begin = np.union1d(cuts, np.concatenate([[0], doc_ends]))[:-1]
    end = np.append(begin[1:], doc_ends[-1])
    doc = np.searchsorted(doc_ends, begin, side="right")
    sequence = np.searchsorted(cuts, begin, side="right") - 1
    view = memoryview(everything)
    names = [doc_id for doc_id, _ in docs]
    columns = [
        pa.array([names[d] for d in doc.tolist()], pa.int64()),
        pa.array(begin - (doc_ends - sizes)[doc]),
        pa.array(end - begin),
        pa.array([zlib.crc32(view[4 * b : 4 * e]) for b, e in zip(begin.tolist(), end.tolist(), strict=True)], pa.int64()),
        pa.array(sizes[doc]),
        pa.array(first_sequence + sequence),
        pa.array(begin - cuts[sequence]),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_PIECES), len(cuts) - 1


def _pack(batches: Iterator[pa.RecordBatch], path: str, window: int, shard_windows: int) -> Iterator[pa.RecordBatch]:
    tokenizer, sentence_end = _tokenizer(path), _ends(path)
    next_sequence = TaskContext.get().partitionId() << 40
    end = np.array([END_ID], "<u4").tobytes()
    shard, held = [], 0
    for batch in batches:
        texts = (text.as_py().decode("utf-8", "replace") for text in batch.column(1))
        for doc_id, ids in zip(batch.column(0), tokenizer.ids_of(texts), strict=True):
            ids += end
            shard.append((doc_id.as_py(), ids))
            held += len(ids) // 4
            if held >= shard_windows * window:
                rows, used = pack_shard(shard, sentence_end, next_sequence, window)
                yield rows
                next_sequence += used
                shard, held = [], 0
    if shard:
        yield pack_shard(shard, sentence_end, next_sequence, window)[0]


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, shard_windows: int = SHARD_WINDOWS):
    """Documents -> pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``vocabulary`` is the path of a byte-level BPE file that every executor has. NULL and empty texts are
    the end token alone. Repeated rows are packed each by itself; a NULL doc_id stays NULL. A text longer
    than a window takes several. An empty table gives no rows. Extra columns are not read. Sequence ids
    are unique, not dense.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_bytes(docs["text"]).alias("text"))
    schema = ", ".join(f"{name} long" for name in _PIECES.names)
    return rows.mapInArrow(partial(_pack, path=str(vocabulary), window=window, shard_windows=shard_windows), schema)
