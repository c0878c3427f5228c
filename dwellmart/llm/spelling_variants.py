"""Spelling variants: words that differ by one letter, found with a trie over counts of letter groups.

Letters are dealt to ``GROUPS`` groups and a word is described by how many letters of each it has. The trie
arranges the words of a length by these counts, one level for each group. One letter less lowers one count
by one, another letter instead lowers one count and raises one. So the search for the near words of a word
goes down the trie depth first and may meet one count that is too low and, for words of its own length, one
that is too high. The words of the leaves it comes to are compared letter by letter.

The trie of a large corpus fits no task, so it is cut at nodes that hold at most ``SHARD_WORDS`` words.
Which counts lie above the cut is known from one aggregation, and each word is sent to the few nodes that
the search from it can reach. Queries of a node that come in great numbers are dealt to several tasks, each
with the node's words. A node that is too large with all its levels used up is split by half words: one edit
leaves the first or the last half as it was.

To find each pair once, the word that is longer, or that has more letters of the first group in which the two
differ, looks for the other.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmart.llm.stored import stored, temporary, text_bytes

LEAST_LETTERS, LEAST_COUNT = 6, 5
#: A form has to be so many times as frequent as its variant.
FORM_RATIO = 5
GROUPS = 12
#: Most words of a node below which the trie is not cut further, and most queries of it that one task gets.
SHARD_WORDS, SHARD_QUERIES = 8192, 1 << 17
#: Different runs of letters a task counts in memory before it hands its counts on.
MOST_RUNS = 1 << 19
_QUERIES_AT_A_TIME = 1 << 16
#: A node with so few words is compared without going down further.
_FEW = 32
_PAIR_BYTES = 1 << 22

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# --- counting words --------------------------------------------------------------------------------


class _Numbers(dict):
    """Numbers of the runs, given as they come, with what their checksum needs."""

    def __init__(self):
        super().__init__()
        self.crcs: list[int] = []
        self.sizes: list[int] = []

    def __missing__(self, run: str) -> int:
        encoded = run.encode()
        self[run] = number = len(self)
        self.crcs.append(zlib.crc32(encoded))
        self.sizes.append(len(encoded))
        return number


def changed(run: str, checksum: int) -> str:
    """The run without one letter, which the checksum names."""
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


class _Counts:
    """Counts of the runs of letters of some texts, some of them with a letter less.

    crc32 is linear: the checksum of a prefix and a run is that of the run, changed by what the prefix comes to
    after as many zeros. So one checksum a run and one a length in a text are enough.
    """

    def __init__(self, least: int, every: int):
        self.find = re.compile(f"[a-zÀ-ÿ]{{{least},}}").findall
        self.least, self.every = least, every
        self.zeros: dict[int, tuple[bytes, int]] = {}
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.total = np.zeros(0, np.int64)
        self.others: Counter[str] = Counter()

    def _shift(self, checksum: int, size: int) -> int:
        if size not in self.zeros:
            self.zeros[size] = (bytes(size), zlib.crc32(bytes(size)))
        zeros, plain = self.zeros[size]
        return zlib.crc32(zeros, checksum) ^ plain

    def add(self, batch: list[tuple[int | None, bytes]]) -> None:
        numbers, places, prefixes = self.numbers, [], []
        for doc_id, text in batch:
            found = self.find(text.translate(_LOWER).decode("utf-8", "replace"))
            if found:
                places.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
                prefixes.append(zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
        if not places:
            return
        crcs, sizes = np.array(numbers.crcs, np.uint32), np.array(numbers.sizes)
        everything = np.concatenate(places)
        total = np.bincount(everything, minlength=len(numbers))
        if self.every:
            names = list(numbers)
            for runs_of_text, prefix in zip(places, prefixes, strict=True):
                size = sizes[runs_of_text]
                kinds = np.unique(size)
                shifts = np.array([self._shift(prefix, s) for s in kinds.tolist()], np.uint32)
                checksums = crcs[runs_of_text] ^ shifts[np.searchsorted(kinds, size)]
                hit = np.flatnonzero(checksums % self.every == 0)
                for number, checksum in zip(runs_of_text[hit].tolist(), checksums[hit].tolist(), strict=True):
                    total[number] -= 1
                    less = changed(names[number], checksum)
                    if len(less) >= self.least:
                        self.others[less] += 1
        total[: len(self.total)] += self.total
        self.total = total

    def batches(self) -> Iterator[pa.RecordBatch]:
        names = np.array([*self.numbers], object)
        some = np.flatnonzero(self.total)
        words = [*names[some].tolist(), *self.others]
        counts = [*self.total[some].tolist(), *self.others.values()]
        for at in range(0, len(words), 1 << 15):
            part = slice(at, at + (1 << 15))
            columns = [pa.array(words[part], pa.string()), pa.array(counts[part], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n"])
        self.clear()


def _count(batches: Iterator[pa.RecordBatch], least: int, every: int) -> Iterator[pa.RecordBatch]:
    counts = _Counts(least, every)
    for batch in batches:
        counts.add(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)))
        if len(counts.numbers) > MOST_RUNS:
            yield from counts.batches()
    yield from counts.batches()


def counted_words(docs: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, every: int = 0) -> DataFrame:
    """(word, n): runs of Latin letters of all texts, A-Z in lower case, with so many letters and occurrences at least.

    With ``every``, the runs of a document for which it divides the crc32 of ``doc_id:run`` lose a letter,
    which makes variants to be found again. NULL texts have no words, a NULL doc_id counts as empty.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("text"))
    parts = rows.mapInArrow(partial(_count, least=least, every=every), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- the trie --------------------------------------------------------------------------------------


def group_counts(letters: np.ndarray, groups: int) -> np.ndarray:
    """For words of one length, a row of letters each: how many letters of each group they have."""
    group = letters % groups
    return np.stack([(group == g).sum(1) for g in range(groups)], 1)


def _letters(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points, all of which are below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def differ_by_one(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Row by row: whether two words of one length differ in one letter, or one lacks one letter of the other."""
    size = shorter.shape[1]
    unequal = longer[:, :size] != shorter
    if longer.shape[1] == size:
        return unequal.sum(1) == 1
    same_start = np.where(unequal.any(1), unequal.argmax(1), size)
    unequal = (longer[:, 1:] != shorter)[:, ::-1]
    same_end = np.where(unequal.any(1), unequal.argmax(1), size)
    return same_start + same_end >= size


class Trie:
    """Words of one length arranged by their counts. A node is a range of the sorted words."""

    def __init__(self, words: list[str], groups: int = GROUPS):
        letters = _letters(words)
        counts = group_counts(letters, groups)
        order = np.lexsort(counts.T[::-1])
        self.letters, self.counts, self.order, self.groups = letters[order], counts[order], order, groups

    def near(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers of words, numbers of the trie's words) of pairs one letter apart; each once, as the module says.

        All ``words`` have one length, that of the trie's words or one more.
        """
        letters = _letters(words)
        counts = group_counts(letters, self.groups)
        other_length = letters.shape[1] != self.letters.shape[1]
        # A node, the queries there, and whether each has met a count too low (1), or one too high after that (2).
        stack = [(0, 0, len(self.order), np.arange(len(words)), np.zeros(len(words), np.int8))]
        while stack:
            level, low, high, queries, spent = stack.pop()
            if level == self.groups or high - low <= _FEW:
                yield from self._verified(letters, counts, queries, low, high, other_length)
                continue
            column = self.counts[low:high, level]
            values, starts = np.unique(column, return_index=True)
            edges = [*starts.tolist(), high - low]
            wanted = counts[queries, level]
            for i, value in enumerate(values.tolist()):
                difference = value - wanted
                lower = (difference == -1) & (spent == 0)
                higher = (difference == 1) & (spent == 1) & (not other_length)
                stay = (difference == 0) | lower | higher
                if stay.any():
                    then = (spent + lower + higher)[stay]
                    stack.append((level + 1, low + edges[i], low + edges[i + 1], queries[stay], then))

    def _verified(self, letters, counts, queries, low, high, other_length) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at_a_time = max(1, _PAIR_BYTES // (letters.shape[1] * (high - low)))
        for start in range(0, len(queries), at_a_time):
            some = queries[start : start + at_a_time]
            left = np.repeat(some, high - low)
            right = np.tile(np.arange(low, high), len(some))
            near = differ_by_one(letters[left], self.letters[right])
            left, right = left[near], right[near]
            if not other_length:
                # The first count that differs has to be lower; of words with equal counts the greater one looks.
                both = np.concatenate([counts[left], letters[left]], 1).astype(np.int64)
                difference = both - np.concatenate([self.counts[right], self.letters[right]], 1)
                first = difference[np.arange(len(left)), (difference != 0).argmax(1)]
                left, right = left[first > 0], right[first > 0]
            if len(left):
                yield left, self.order[right]


# --- the trie in parts -----------------------------------------------------------------------------


def _paths(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Adds the path of each word in the trie: its length, then its counts."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        paths = np.empty(len(words), object)
        sizes = np.array([len(w) for w in words])
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            counts = group_counts(_letters([words[i] for i in at.tolist()]), groups).tolist()
            for i, row in zip(at.tolist(), counts, strict=True):
                paths[i] = [size, *row]
        columns = [batch.column(0), batch.column(1), pa.array(paths.tolist(), pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["word", "n", "path"])


def reached(path: list[int], depth: int) -> Iterator[tuple[int, ...]]:
    """Nodes at a depth that the search from a path can come to."""
    size, top = path[0], path[1 : depth + 1]
    for length in (size, size - 1):
        yield (length, *top)
        for i, count in enumerate(top):
            if count:
                lower = [*top[:i], count - 1, *top[i + 1 :]]
                yield (length, *lower)
                if length == size:
                    for j in range(i + 1, depth):
                        yield (length, *lower[:j], lower[j] + 1, *lower[j + 1 :])


def _node_name(node: tuple[int, ...] | list[int]) -> str:
    return ",".join(map(str, node))


def _reach(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """(node, path, words, own) for all nodes that the search from a path can come to, and those it lies below."""
    for batch in batches:
        made = []
        for path, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for d in range(depth + 1):
                own = _node_name(path[: d + 1])
                made.append((own, path, words, True))
                made += ((_node_name(node), path, words, False) for node in reached(path, d))
        columns = zip(*made, strict=True) if made else ([],) * 4
        types = (pa.string(), pa.list_(pa.int32()), pa.int64(), pa.bool_())
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["node", "path", "words", "own"])


def _cut(paths: DataFrame, groups: int, most: int) -> DataFrame:
    """(node, depth, large): nodes at which the trie is cut, and whether one is too large with no level left."""
    name = lambda upto: F.array_join(F.slice("path", F.lit(1), upto), ",")
    nodes = (
        paths.select("path", "words", F.explode(F.sequence(F.lit(0), F.lit(groups))).alias("depth"))
        .groupBy(name(F.col("depth") + 1).alias("node"), "depth", name(F.col("depth")).alias("parent"))
        .agg(F.sum("words").alias("words"))
    )
    nodes = stored(nodes, "nodes")
    split = nodes.where((F.col("words") > most) & (F.col("depth") < groups))
    leaves = nodes.where((F.col("words") <= most) | (F.col("depth") == groups))
    below = leaves.join(split.select(F.col("node").alias("parent")), "parent", "left_semi")
    return (
        leaves.where("depth = 0").unionByName(below).select("node", "depth", (F.col("words") > most).alias("large"))
    )


def _routed(words: DataFrame, groups: int, shard_words: int, shard_queries: int) -> DataFrame:
    """(node, part, half, member, word, n): each word at its own node and at those it looks for others in."""
    paths = stored(words.groupBy("path").agg(F.count(F.lit(1)).alias("words")), "paths")
    cuts = stored(_cut(paths, groups, shard_words), "cuts")
    depth = cuts.agg(F.max("depth")).first()[0] or 0
    reach = paths.mapInArrow(partial(_reach, depth=depth), "node string, path array<int>, words long, own boolean")
    reach = stored(reach.join(cuts, "node"), "reach")
    load = reach.where(~F.col("own")).groupBy("node").agg(F.ceil(F.sum("words") / shard_queries).alias("parts"))
    routes = reach.join(load, "node").drop("words")
    rows = words.join(routes, "path")
    every_part = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    own_part = F.array(F.pmod(F.xxhash64("word"), F.col("parts")))
    rows = rows.withColumn("part", F.explode(F.when(F.col("own"), every_part).otherwise(own_part)))
    size = F.split_part("node", F.lit(","), F.lit(1)).cast("int")
    first = F.concat(F.lit("<"), F.substring("word", F.lit(1), F.floor(size / 2).cast("int")))
    last = F.concat(F.lit(">"), F.right("word", F.ceil(size / 2).cast("int")))
    halves = F.when(F.col("large"), F.array(first, last)).otherwise(F.array(F.lit("")))
    return rows.select("node", "part", F.explode(halves).alias("half"), F.col("own").alias("member"), "word", "n")


_NEAR = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _pairs_of(trie: Trie, members: Sequence[str], member_n: np.ndarray, words: Sequence[str], n: np.ndarray, half: str):
    """Pairs in both directions, as batches."""
    by_size: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_size.setdefault(len(word), []).append(i)
    for some in by_size.values():
        for left, right in trie.near([words[i] for i in some]):
            left = np.array(some)[left]
            if half.startswith(">"):
                # What agrees in the first half too is found there.
                size = len(members[0]) // 2
                new = [words[i][:size] != members[j][:size] for i, j in zip(left.tolist(), right.tolist(), strict=True)]
                left, right = left[new], right[new]
            a, b = [words[i] for i in left.tolist()], [members[j] for j in right.tolist()]
            columns = [pa.array(a + b, pa.string()), pa.array(b + a, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate([member_n[right], n[left]]))], schema=_NEAR)


def _search(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """Near words within each node; a partition is sorted by node, part and half, its words before the queries."""
    key, trie, members, queries = None, None, [], []

    def found() -> Iterator[pa.RecordBatch]:
        nonlocal trie, queries
        if members and queries:
            trie = trie or Trie([word for word, _ in members], groups)
            names, counts = zip(*members, strict=True)
            words, n = zip(*queries, strict=True)
            yield from _pairs_of(trie, names, np.array(counts, np.int64), words, np.array(n, np.int64), key[2])
        queries = []

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("node", "part", "half", "member", "word", "n")]
        for *own, member, word, n in zip(*columns, strict=True):
            if own != key or len(queries) == _QUERIES_AT_A_TIME:
                yield from found()
            if own != key:
                key, trie, members = own, None, []
            (members if member else queries).append((word, n))
    yield from found()


def near_words(
    words: DataFrame, groups: int = GROUPS, shard_words: int = SHARD_WORDS, shard_queries: int = SHARD_QUERIES
) -> DataFrame:
    """(word, n) rows with different words -> (word, near, near_n), every pair one letter apart in both directions.

    Letters are code points below 256. A word comes in one row. NULL and empty words are near to nothing.
    """
    words = words.where("word <> ''").select("word", F.col("n").cast("long").alias("n"))
    with_path = stored(words.mapInArrow(partial(_paths, groups=groups), "word string, n long, path array<int>"), "words")
    rows = _routed(with_path, groups, shard_words, shard_queries)
    keys = ["node", "part", "half"]
    # So many tasks as the session says: the rows are few bytes but much work.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, *keys).sortWithinPartitions(*keys, F.col("member").desc())
    return dealt.mapInArrow(partial(_search, groups=groups), "word string, near string, near_n long")


def variants(words: DataFrame, ratio: int = FORM_RATIO, **options) -> DataFrame:
    """(word, n) rows with different words -> (word, form, root, n, n_near, form_n), one row per word.

    ``form`` is the most frequent near word (of equally frequent ones the first in code-point order) if it
    is ``ratio`` times as frequent as the word, else NULL; ``root`` is where following forms ends.
    No words give no rows.
    """
    with temporary(words.sparkSession) as keep:
        words = stored(words.select("word", "n"), "counted")
        best = F.min(F.struct((-F.col("near_n")).alias("rarer"), "near"))
        near = near_words(words, **options).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        frequent = -F.col("best.rarer") >= ratio * F.col("n")
        formed = words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(frequent, F.col("best.near")).alias("form"),
            F.when(frequent, -F.col("best.rarer")).alias("form_n"),
        )
        formed = keep(formed, "formed")
        roots = keep(root_of(formed.where("form IS NOT NULL").select("word", "form")), "roots")
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def root_of(forms: DataFrame) -> DataFrame:
    """(word, form) rows without cycles -> (word, root): the last form on the way.

    Each round looks up the form reached so far and so doubles the way; a form is ``ratio`` times as
    frequent as its word, so ways are short whatever the number of words.
    """
    reached_so_far = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached_so_far.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = stored(reached_so_far.join(onward, "root", "left"), "roots")
        reached_so_far = further.select("word", F.coalesce("further", "root").alias("root"))
        if further.where("further IS NOT NULL").isEmpty():
            return reached_so_far
