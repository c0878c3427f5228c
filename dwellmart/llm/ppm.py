"""Language-model scores by prediction by partial matching (PPM) over bytes, and a word baseline.

The corpus is counted as a byte-context trie: how often each byte follows each context of up to five
bytes. The counts of six-byte grams hold the whole trie, since shorter contexts are their sums; they are
made for all training texts, each task adding up its own before the shuffle. Texts are framed by bytes
that UTF-8 never uses: 0xFE stands before a text and 0xFF ends it, so the end of a text is a symbol too.

A byte is coded in the longest context that the model holds. Escape is estimated by method D (half an
escape for each distinct byte seen, taken off that byte's count); on escape, the bytes seen in the longer
context are excluded from the shorter one, down to order 0 and then to a uniform choice among what is left.
The model is pretrained, so the probability of a byte is a constant of the six-byte gram that it ends. All
different grams of the table, those of held-out texts too, are priced once from the whole trie: grams that end in
the same three context bytes come to one task, which has all that orders 3 to 5 need; the counts of three-byte
grams, which the lower orders need, are broadcast. The prices of the most frequent grams, at most ``GRAMS``, are
broadcast to the scorer; all other grams meet theirs in a join.

The baseline looks every word up in the training counts. Words with at least 1/``HEAVY`` of all tokens are
at most that many and are broadcast; all others meet their counts in a join.
"""

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmart.llm.stored import fold, stored, text_bytes

FOLDS, HELD_OUT = 5, 1
DEPTH = 5
#: Grams of so many bytes are few enough to be broadcast.
SHORT = 3
GRAMS = 1 << 20
HEAVY = 200_000
BEFORE, END = b"\xfe" * DEPTH, b"\xff"
#: The end of a text as a token; words are never empty.
END_TOKEN = b""
_MOST_COUNTED = 1 << 19
_BYTES_AT_ONCE = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Documents whose rows are put together at a time.
_DOCS_AT_ONCE = 500
_GRAM_BITS = 8 * (DEPTH + 1)


# --- counting ---------------------------------------------------------------------------------------


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["token", "n"])

    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update(text.lower().split())
            counts[END_TOKEN] += 1
            if len(counts) > _MOST_COUNTED:
                yield out()
                counts.clear()
    yield out()


def _windows(framed: np.ndarray) -> np.ndarray:
    """The six bytes that end at each byte from the sixth on, as numbers."""
    n = len(framed) - DEPTH
    grams = np.zeros(n, np.int64)
    for i in range(DEPTH + 1):
        grams <<= 8
        grams |= framed[i : i + n]
    return grams


def grams_of(framed: np.ndarray) -> np.ndarray:
    """The six-byte grams of framed texts, without those that end in a frame byte before a text."""
    return _windows(framed)[framed[DEPTH:] != BEFORE[0]]


def _framed_parts(texts: Iterable[bytes]) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
    """Framed texts put together to arrays of some size; a longer text runs over several of them.

    Each comes with the numbers of the texts in it and how many symbols of each it holds. A part that goes
    on with a text stands alone: its first bytes are context only.
    """
    owners, sizes, held, size = [], [], [], 0
    for number, text in enumerate(texts):
        whole = BEFORE + text + END
        for start in range(0, len(whole) - DEPTH, _BYTES_AT_ONCE):
            part = whole[start : start + _BYTES_AT_ONCE + DEPTH]
            if start:
                yield [number], [len(part) - DEPTH], np.frombuffer(part, np.uint8)
                continue
            owners.append(number)
            sizes.append(len(part) - DEPTH)
            held.append(part)
            size += len(part)
        if size >= _BYTES_AT_ONCE:
            yield owners, sizes, np.frombuffer(b"".join(held), np.uint8)
            owners, sizes, held, size = [], [], [], 0
    if held:
        yield owners, sizes, np.frombuffer(b"".join(held), np.uint8)


def _inner(framed: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Which windows of a part are symbols of its texts: the first bytes of each are context only."""
    inner = np.ones(len(framed) - DEPTH, bool)
    starts = np.cumsum(np.array(sizes) + DEPTH)[:-1]
    inner[(starts[:, None] - np.arange(1, DEPTH + 1)).ravel()] = False
    return inner


def _count_grams(batches: Iterator[pa.RecordBatch], names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    texts = (text for batch in batches for text in batch.column("text").to_pylist())
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=names)

    for _, _, part in _framed_parts(texts):
        new, n = np.unique(grams_of(part), return_counts=True)
        every, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
        keys, counts = every, np.bincount(at, np.concatenate([counts, n])).astype(np.int64)
        if len(keys) > 2 * _MOST_COUNTED:
            yield out()
            keys, counts = keys[:0], counts[:0]
    yield out()


def token_counts(texts: DataFrame) -> DataFrame:
    counted = texts.mapInArrow(_count_tokens, "token binary, n long")
    return stored(counted.groupBy("token").agg(F.sum("n").alias("c")), "tokens")


def gram_counts(training: DataFrame, held_out: DataFrame) -> DataFrame:
    """All different grams: how often training texts (``n``) and all texts (``m``) have them."""
    learned = training.mapInArrow(partial(_count_grams, names=("gram", "n")), "gram long, n long").withColumn("m", F.col("n"))
    asked = held_out.mapInArrow(partial(_count_grams, names=("gram", "m")), "gram long, m long")
    both = learned.unionByName(asked.withColumn("n", F.lit(0).cast("long")))
    return stored(both.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "grams")


# --- the model --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Trie:
    """Counts that the model is made of: for each order from 0 on, (grams, counts) of the kept grams.

    ``total``: how many symbols were counted, those of grams that are not kept among them. ``whole``: every
    counted gram of a context that is there at all is kept, so that the context was there as often as they.
    """

    orders: tuple[tuple[np.ndarray, np.ndarray], ...] = ()
    total: int = 0
    whole: bool = False


def _low(keys: np.ndarray, count: int) -> np.ndarray:
    """The last ``count`` bytes of grams."""
    return keys & np.int64((1 << 8 * count) - 1)


class _Table:
    """Places of many keys at a time: an open-addressed table of numbers that are not negative."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.at = np.zeros(len(keys), np.int64)
        todo, place = np.arange(len(keys)), self._first(keys)
        while len(todo):
            free = self.keys[place] < 0
            self.keys[place[free]] = keys[todo[free]]
            here = self.keys[place] == keys[todo]
            self.at[todo[here]] = place[here]
            todo, place = todo[~here], self._next(place[~here])

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).view(np.int64)

    def _next(self, place: np.ndarray) -> np.ndarray:
        return (place + 1) & (len(self.keys) - 1)

    def spread(self, values: np.ndarray) -> np.ndarray:
        """Values of the keys, each at the place of its key."""
        column = np.zeros(len(self.keys), np.float32)
        column[self.at] = values
        return column

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where there is none."""
        place = self._first(keys)
        got = self.keys[place]
        going = np.flatnonzero((got != keys) & (got >= 0))
        place[(got != keys) & (got < 0)] = -1
        while len(going):
            place[going] = self._next(place[going])
            got = self.keys[place[going]]
            place[going[got < 0]] = -1
            going = going[(got != keys[going]) & (got >= 0)]
        return place


class Model:
    """Log10 probabilities of the kept grams, and what an escape from each context costs.

    The counts of a context's symbols that are not kept belong to its escape, so the probabilities of a
    context still add up to one. What is kept in a context is kept in its suffix as well, so excluding the
    symbols of the last context excludes those of all before it.
    """

    def __init__(self, trie: Trie):
        self.grams: list[tuple[_Table, np.ndarray, np.ndarray]] = []
        self.contexts: list[tuple[_Table, np.ndarray, np.ndarray, np.ndarray]] = []
        self.unseen = 256
        ends = 0
        above = None
        for order, (found, counts) in enumerate(trie.orders):
            sort = np.argsort(found)
            keys, n = found[sort], counts[sort]
            if not order:
                ends = int(n[keys == END[0]].sum())
                self.unseen -= len(keys)
            contexts, row, kinds = np.unique(keys >> 8, return_inverse=True, return_counts=True)
            weight = np.bincount(row, 2 * n - 1, len(contexts))
            left, deeper = np.ones(len(contexts)), np.ones(len(contexts))
            if above is None:
                times = np.full(len(contexts), trie.total)
            else:
                above_keys, above_n, above_contexts, above_times, above_weight = above
                if trie.whole:
                    times = np.bincount(row, n, len(contexts))
                else:
                    # A context was there as often as its own gram; before a text, as often as texts ended.
                    framed = contexts == int.from_bytes(BEFORE[:order])
                    at = np.searchsorted(above_keys, np.where(framed, above_keys[:1], contexts))
                    times = np.where(framed, ends, above_n[at])
                suffix = np.searchsorted(above_contexts, _low(contexts, order - 1))
                excluded = np.bincount(row, above_n[np.searchsorted(above_keys, _low(keys, order))], len(contexts))
                left = above_times[suffix] - excluded
                rest = 2 * left - (above_weight[suffix] - (2 * excluded - kinds))
                deeper = np.where(left > 0, rest / np.maximum(2 * left, 1), 1.0)
            table = _Table(keys)
            here = np.log10((2 * n - 1) / (2 * times[row]))
            self.grams.append((table, table.spread(here), table.spread(np.log10(2 * n - 1))))
            table = _Table(contexts)
            escape = np.log10((2 * times - weight) / (2 * times))
            under = np.log10(np.maximum(2 * left, 1))
            self.contexts.append((table, table.spread(escape), table.spread(under), table.spread(np.log10(deeper))))
            above = keys, n, contexts, times, weight

    def logs(self, grams: np.ndarray) -> np.ndarray:
        """Log10 probability of the last byte of each gram after the bytes before it."""
        result, spent = np.zeros(len(grams)), np.zeros(len(grams))
        under, deeper = np.zeros(len(grams), np.float32), np.zeros(len(grams), np.float32)
        escaped = np.zeros(len(grams), bool)
        todo = np.arange(len(grams))
        for order in reversed(range(len(self.grams))):
            keys = _low(grams[todo], order + 1)
            table, here, top = self.grams[order]
            place = table.find(keys)
            seen = place >= 0
            one, at = todo[seen], place[seen]
            result[one] = np.where(escaped[one], spent[one] + top[at] - under[one], here[at])
            todo, keys = todo[~seen], keys[~seen]
            table, escape, next_under, next_deeper = self.contexts[order]
            place = table.find(keys >> 8)
            one, at = todo[place >= 0], place[place >= 0]
            spent[one] += np.where(escaped[one], deeper[one], escape[at])
            under[one], deeper[one], escaped[one] = next_under[at], next_deeper[at], True
        result[todo] = spent[todo] - math.log10(max(self.unseen, 1))
        return result

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Log10 probability of each text and its end."""
        total = np.zeros(len(texts))
        for owners, sizes, framed in _framed_parts(texts):
            logs = self.logs(_windows(framed)[_inner(framed, sizes)])
            total += np.bincount(np.repeat(owners, sizes), logs, len(texts))
        return total


# --- prices -----------------------------------------------------------------------------------------


def _sums(grams: np.ndarray, n: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The different last ``count`` bytes of grams and how often each was counted."""
    keys, at = np.unique(_low(grams, count), return_inverse=True)
    return keys, np.bincount(at, n, len(keys)).astype(np.int64)


def _trie(short: tuple[np.ndarray, np.ndarray], grams: np.ndarray, n: np.ndarray) -> Trie:
    """The trie as far as ``grams`` need it: all counted grams that end in the same three context bytes are there.

    ``short``: all three-byte grams and their counts. ``n`` is 0 where a gram was not counted.
    """
    keys, counts = short
    if not len(keys):
        return Trie()
    near = np.isin(keys >> 8, _low(grams >> 8, 2))
    orders = [_sums(keys, counts, 1), _sums(keys, counts, 2), (keys[near], counts[near])]
    learned = n > 0
    orders += [_sums(grams[learned], n[learned], count + 1) for count in range(SHORT, DEPTH + 1)]
    return Trie(tuple(orders), int(counts.sum()), whole=True)


def _price(batches: Iterator[pa.RecordBatch], given) -> Iterator[pa.RecordBatch]:
    """Log10 probabilities of grams, which come sorted by their last three context bytes."""
    names, held, size = ("gram", "n", "m"), [], 0

    def out(rows: list[np.ndarray]) -> pa.RecordBatch:
        logs = Model(_trie(given.value, rows[0], rows[1])).logs(rows[0])
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[2]), pa.array(logs)], names=["gram", "m", "log"])

    for batch in batches:
        held.append([batch.column(name).to_numpy() for name in names])
        size += batch.num_rows
        if size < _MOST_COUNTED:
            continue
        rows = [np.concatenate(part) for part in zip(*held, strict=True)]
        near = _low(rows[0] >> 8, SHORT)
        end = np.searchsorted(near, near[-1])
        if end:
            yield out([part[:end] for part in rows])
        held, size = [[part[end:] for part in rows]], 0
    if held:
        yield out([np.concatenate(part) for part in zip(*held, strict=True)])


def prices(grams: DataFrame) -> DataFrame:
    """Counted grams -> (gram, m, log): what each costs by the counts of all of them."""
    # All three-byte grams are at most 2^24 rows.
    counted = grams.where("n > 0").groupBy(_low_bytes(SHORT)).agg(F.sum("n").alias("n")).toArrow()
    given = grams.sparkSession.sparkContext.broadcast((counted["gram"].to_numpy(), counted["n"].to_numpy()))
    near = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * SHORT) - 1).cast("long"))
    rows = grams.withColumn("near", near).repartition("near").sortWithinPartitions("near").select("gram", "n", "m")
    return stored(rows.mapInArrow(partial(_price, given=given), "gram long, m long, log double"), "prices")


def least_count(priced: DataFrame, most_grams: int) -> int:
    """The least ``m`` that no more than ``most_grams`` grams reach."""
    # Different counts are at most about the root of twice their sum.
    found = priced.groupBy("m").count().toArrow().sort_by([("m", "descending")])
    m, kinds = found["m"].to_numpy(), np.cumsum(found["count"].to_numpy())
    over = np.flatnonzero(kinds > most_grams)
    return int(m[over[0]]) + 1 if len(over) else 0


def _low_bytes(count: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << 8 * count) - 1).cast("long")).alias("gram")


# --- scoring ----------------------------------------------------------------------------------------


class Frequent:
    """Prices of the grams that are broadcast; what is made of them is made once in a worker."""

    def __init__(self, grams: np.ndarray, logs: np.ndarray):
        self.grams, self.prices = grams, logs

    @cached_property
    def table(self) -> tuple[_Table, np.ndarray]:
        table = _Table(self.grams)
        return table, table.spread(self.prices)

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """The sum of the prices of each text, and (text, gram, how often) of the grams that are not here."""
        table, prices = self.table
        total, rare = np.zeros(len(texts)), []
        for owners, sizes, framed in _framed_parts(texts):
            grams = _windows(framed)[_inner(framed, sizes)]
            owner, place = np.repeat(owners, sizes), table.find(grams)
            here = place >= 0
            total += np.bincount(owner[here], prices[place[here]], len(texts))
            # A gram has 48 bits, so there is room for the number of its text.
            found, n = np.unique((owner[~here] << _GRAM_BITS) | grams[~here], return_counts=True)
            rare.append((found >> _GRAM_BITS, _low(found, DEPTH + 1), n))
        return total, rare


def _keys(grams: np.ndarray) -> pa.Array:
    """Grams as tokens that are no words, since they begin with a space."""
    data = (grams | (0x20 << 56)).astype(">i8")
    ends = np.arange(0, 8 * len(grams) + 1, 8, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(grams), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _key(gram: Column) -> Column:
    return F.to_binary(F.concat(F.lit("2000"), F.lpad(F.hex(gram), 12, "0")), F.lit("hex"))


def _score(batches: Iterator[pa.RecordBatch], given, under: float) -> Iterator[pa.RecordBatch]:
    """One row per document, and one per document and word or gram that is not broadcast."""
    frequent, heavy = given.value
    known = {token: math.log10((c + 0.5) / under) for token, c in heavy.items()}
    row = TaskContext.get().partitionId() << 40
    doc = pa.struct(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
         ("base", pa.float64()), ("score", pa.float64())]
    )
    names = [f.name for f in doc]
    for batch in (b.slice(i, _DOCS_AT_ONCE) for b in batches for i in range(0, b.num_rows, _DOCS_AT_ONCE)):
        rows, tokens, counts, docs = [], [], [], []
        ids, folds, texts = (batch.column(i).to_pylist() for i in range(3))
        scores, rare_grams = frequent.scores(texts)
        before = row + 1
        for doc_id, held_out, text, score in zip(ids, folds, texts, scores.tolist(), strict=True):
            row += 1
            words = text.lower().split()
            words.append(END_TOKEN)
            base = [known.get(word) for word in words]
            rare = Counter(word for word, value in zip(words, base, strict=True) if value is None)
            values = [value for value in base if value is not None]
            # A key with a space is no word, and no gram's has a digit there: these rows are spread and meet no count.
            rows.append(row)
            tokens.append(b" %d" % row)
            counts.append(0)
            one = (doc_id, held_out, len(words), len(values), math.fsum(values), score)
            docs.append(dict(zip(names, one, strict=True)))
            rows += [row] * len(rare)
            tokens += rare.keys()
            counts += rare.values()
            docs += [None] * len(rare)
        columns = [pa.array(rows, pa.int64()), pa.array(tokens, pa.binary()), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(docs, doc)], names=["row", "token", "n", "doc"])
        for owner, grams, n in rare_grams:
            columns = [pa.array(before + owner), _keys(grams), pa.array(n, pa.int64()), pa.nulls(len(n), doc)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "token", "n", "doc"])


_SCORED = (
    "row long, token binary, n long, doc struct<doc_id:long,held_out:boolean,n_tokens:long,n_known:long,"
    "base:double,score:double>"
)


def scored(docs: DataFrame, most_grams: int = GRAMS, heavy: int = HEAVY) -> DataFrame:
    """Documents -> (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row.

    Learns from the rows outside the held-out fold. ``most_grams`` and ``heavy`` bound what is broadcast and do not
    change the scores. NULL and empty texts are the end alone. Repeated rows
    count and are scored each. Without training rows every byte costs 1/256 and the baseline is 0. An empty
    table gives no rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        text_bytes(F.col("text")).alias("text"),
    )
    training = rows.where(~F.col("held_out")).select("text")
    counts = token_counts(training)
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    under = n + 0.5 * (v + 1)
    frequent = counts.where(F.col("c") * heavy >= n).toArrow()
    tokens = dict(zip(frequent["token"].to_pylist(), frequent["c"].to_pylist(), strict=True))
    priced = prices(gram_counts(training, rows.where("held_out").select("text")))
    least = least_count(priced, most_grams)
    most = priced.where(F.col("m") >= least).toArrow()
    frequent_grams = Frequent(most["gram"].to_numpy(), most["log"].to_numpy())
    given = spark.sparkContext.broadcast((frequent_grams, tokens))
    parts = rows.mapInArrow(partial(_score, given=given, under=under), _SCORED)
    # No document has a gram without a price.
    grams = priced.where(F.col("m") < least).select(_key(F.col("gram")).alias("token"), "log")
    met = parts.join(counts.unionByName(grams, allowMissingColumns=True), "token", "left")
    word = (F.col("n") > 0) & F.col("log").isNull()
    gain = F.when(word, F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / under)).otherwise(0.0)
    gram_gain = F.coalesce(F.col("n") * F.col("log"), F.lit(0.0))
    known = F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)
    one = F.col("doc")
    return (
        met.groupBy("row")
        .agg(
            F.max(one["doc_id"]).alias("doc_id"),
            F.max(one["held_out"]).alias("held_out"),
            F.sum(one["n_tokens"]).alias("n_tokens"),
            (F.sum(F.coalesce(one["n_known"], F.lit(0)) + known)).alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            F.sum(F.coalesce(one["base"], F.lit(0.0)) + gain).alias("base_score"),
            F.sum(F.coalesce(one["score"], F.lit(0.0)) + gram_gain).alias("score"),
        )
        .drop("row")
    )
