"""Mixing sources to target weights, in blocks of words, with DataFrame operations only.

The documents of a source, in the order of a hash of their id, make one long row of words that is cut
into blocks of fixed length. A source takes part with a number of slots; slot k stands for the block that a
permutation of the source's n whole blocks puts at k. The permutation is a keyed Feistel network (see
``permuted``), so any number of blocks is permuted without a table of them. After the whole blocks comes the
shorter rest of the row, then the next pass begins. The last slot of a source is cut so that its words meet
the target to the word.

Each slot draws its output shard by a seeded hash, so the source counts of a shard are a multinomial
draw, on condition that they add up to the source's slots over all shards: free draws would miss the
targets of small sources by several per cent. Slots and document pieces are then joined by source and
block.

Only the table with one row per source is ever put in one order as a whole. Positions within a source
come from sums over 65,536 hash ranges, so a source with a third of all rows is spread over all tasks.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellmart.llm.stored import NOT_WHITE, free_name, stored, with_row_key

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
BLOCK_WORDS = 1024
SHARD_SLOTS = 1024
ROUNDS = 6
#: Most steps of a walk back into the permuted range.
MOST_STEPS = 64
#: Slots that one row of the plan stands for before they are made.
_SLOT_RUN = 4096


@dataclass(frozen=True)
class Mix:
    """``plan``: one row per source; ``spans``: one row per document; ``pieces``: what the mix takes.

    pieces: shard, slot, source_number, pass, block, row, first_word, n_words, start. Rows carry ``row``, the
    number of the document's row in the sized table; ``start`` is the document's place in its source.
    """

    plan: DataFrame
    spans: DataFrame
    pieces: DataFrame


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_WHITE)).cast("long")


def source_plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, size) rows -> one row per source: number, weight, source_size, target.

    Sources are numbered by code point, NULL last, and weigh ``weights``, repeating. A target is the
    source's share of all words by weight; it stops at ``MOST_PASSES`` times the source's size and what is
    over goes to the others by weight. With sources sorted by cap per weight, those that stop come first,
    so one running sum finds the level of the rest.
    """
    everything = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(everything) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("number") % len(weights) + 1)
    rows = by_source.withColumn("number", number).withColumn("weight", weight)
    cap = F.col("source_size") * MOST_PASSES
    rows = rows.withColumn("cap", cap).withColumn("cap_per_weight", F.col("cap") / F.col("weight"))
    sorted_caps = Window.partitionBy(F.lit(0)).orderBy("cap_per_weight", "number")
    earlier = sorted_caps.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))

    def before(name: str) -> Column:
        return F.coalesce(F.sum(name).over(earlier), F.lit(0))

    left = F.sum("source_size").over(whole) - before("cap")
    rows = rows.withColumn("level", left / (F.sum("weight").over(whole) - before("weight")))
    rows = rows.withColumn("stops", F.col("level") > F.col("cap_per_weight"))
    final = F.min_by("level", F.struct("cap_per_weight", "number")).over(whole)
    open_level = F.min(F.when(~F.col("stops"), F.struct("cap_per_weight", "number", "level"))).over(whole)["level"]
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(F.coalesce(open_level, final) * F.col("weight"))
    return rows.select("source", "number", "weight", "source_size", target.alias("target"))


def _spans(sized: DataFrame) -> DataFrame:
    """Adds ``start``: the document's first word in the row of words of its source."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = sized.withColumn("key", key).withColumn("part", F.conv(F.substring("key", 1, 4), 16, 10).cast("int"))
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("of"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("part_start"),
    )
    within = Window.partitionBy("source", "part").orderBy("key", "doc_id", "size", "row")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("in_part", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return placed.join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))).select(
        "row", "doc_id", "source", "size", (F.col("part_start") + F.col("in_part")).alias("start")
    )


def permuted(k: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """The place of ``k`` in a pseudorandom permutation of 0..n-1 that ``key`` chooses.

    A number below ``a * b`` is a row and a column of a table of a rows and b columns. Each round shifts one of
    the two by a hash of the other, which can be undone, so the rounds permute the table. With ``a`` about the root
    of n the table has less than a cells too many; a number that lands there is permuted
    again, until it is below n. Such a walk visits each of these cells once at most, so up to 4,096 it is
    sure to end within 64 steps; above, it ends by then but for a chance of less than 10^-100 a number,
    and the query would fail and not go on with a wrong block.
    """
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    b = _div(n + a - 1, a)

    def shift(round_: Column, other: Column) -> Column:
        digest = F.md5(F.concat_ws(":", key.cast("string"), round_.cast("string"), other.cast("string")).cast("binary"))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")

    def one_round(at: Column, round_: Column) -> Column:
        row, column, even = at["row"], at["column"], round_ % 2 == 0
        return F.struct(
            F.when(even, (row + shift(round_, column)) % a).otherwise(row).alias("row"),
            F.when(even, column).otherwise((column + shift(round_, row)) % b).alias("column"),
        )

    def once(x: Column) -> Column:
        # A fold, so that each round's hash is taken once and not once for every later use of it.
        begin = F.struct(_div(x, b).alias("row"), (x % b).alias("column"))
        numbers = F.sequence(F.lit(0), F.lit(rounds - 1))
        return F.aggregate(numbers, begin, one_round, lambda at: at["row"] * b + at["column"])

    left = F.least(a * b - n, F.lit(MOST_STEPS))
    steps = F.when(left > 0, F.sequence(F.lit(1).cast("long"), left)).otherwise(F.array().cast("array<long>"))
    found = F.aggregate(steps, once(k), lambda x, _: F.when(x < n, x).otherwise(once(x)))
    lost = F.raise_error(F.lit("a walk of the permutation has not ended")).cast("long")
    return F.when(found < n, found).otherwise(lost)


def _div(x: Column, y: Column) -> Column:
    """Whole quotient, without the detour over doubles."""
    return F.call_function("div", x, y)


def _slots(plan: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """Every slot of every source: its shard, block and number of words."""
    size, number = F.col("source_size"), F.col("number")
    rows = plan.where("source_size > 0").select(
        "number",
        size,
        F.floor("target").alias("want"),
        F.floor(size / block_words).alias("whole"),
        F.ceil(size / block_words).alias("blocks"),
    )
    rows = rows.withColumn("passes", F.floor(F.col("want") / size)).withColumn("rest", F.col("want") % size)
    rows = rows.withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block_words))
    rows = rows.withColumn("all_slots", F.sum("slots").over(Window.partitionBy(F.lit(0)))).where("slots > 0")
    runs = rows.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / _SLOT_RUN))))
    # So many tasks as the session says: the rows are few but each makes many slots.
    tasks = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = runs.repartition(tasks, "number", "run")
    first = F.col("run") * _SLOT_RUN
    slots = runs.withColumn("slot", F.explode(F.sequence(first, F.least(first + _SLOT_RUN, F.col("slots")) - 1)))
    k = F.col("slot") % F.col("blocks")
    key = F.concat_ws("-", F.lit(str(seed)), number.cast("string"))
    shuffled = permuted(F.col("k"), F.col("whole"), key)
    slots = slots.withColumn("k", k).withColumn("pass", F.floor(F.col("slot") / F.col("blocks")))
    length = F.least(F.lit(block_words).cast("long"), size - F.col("k") * block_words)
    left = F.when(F.col("pass") < F.col("passes"), length).otherwise(F.col("rest") - F.col("k") * block_words)
    shards = F.ceil(F.col("all_slots") / shard_slots)
    return slots.select(
        F.pmod(F.xxhash64(F.lit(seed), number, F.col("slot")), shards).alias("shard"),
        F.col("number").alias("source_number"),
        "slot",
        "pass",
        F.when(F.col("k") < F.col("whole"), shuffled).otherwise(F.col("whole")).alias("block"),
        F.least(length, left).alias("take"),
    )


def mix(
    sized: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 42,
) -> Mix:
    """The mix of a sized table (row, doc_id, source, size), ``row`` being unique."""
    plan = stored(source_plan(sized, weights), "plan")
    spans = stored(_spans(sized), "spans")
    numbers = plan.select(F.col("source").alias("of"), F.col("number").alias("source_number"))
    first = F.floor(F.col("start") / block_words)
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    parts = spans.where("size > 0").join(numbers, F.col("source").eqNullSafe(F.col("of")))
    parts = parts.select("row", "source_number", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    block_start = F.col("block") * block_words
    begin = F.greatest(F.col("start"), block_start)
    end = F.least(F.col("start") + F.col("size"), block_start + F.col("take"))
    joined = parts.join(_slots(plan, block_words, shard_slots, seed), ["source_number", "block"])
    pieces = joined.where(end > begin).select(
        "shard", "slot", "source_number", "pass", "block", "row",
        (begin - F.col("start")).alias("first_word"), (end - begin).alias("n_words"), "start",
    )
    return Mix(plan, spans, pieces)


def _sized(docs: DataFrame) -> DataFrame:
    return stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "source", word_count(F.col("text")).alias("size")
        ),
        "sized",
    )


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """Documents -> (doc_id, size, source_size, target, taken), one row per row.

    NULL and empty texts have size 0 and are never taken; a NULL source is a source of its own, the last.
    Repeated rows count as documents of their own. Rows of one source with equal doc_id and size may stand
    for one another. An empty table gives no rows. Extra columns are not read.
    """
    made = mix(_sized(docs), **options)
    taken = made.pieces.groupBy(F.col("row").alias("taken_row")).agg(F.sum("n_words").alias("words"))
    sources = made.plan.select(F.col("source").alias("of"), "source_size", "target")
    return (
        made.spans.join(taken, F.col("row") == F.col("taken_row"), "left")
        .join(sources, F.col("source").eqNullSafe(F.col("of")))
        .select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus, as rows with the columns of ``docs``, in the order of the mix.

    A partition holds whole shards, one after another, each in the order of its slots. A row stands where its
    first piece of the pass was dealt to: the smallest of the places of all its pieces would crowd the first shards.
    A document comes once for each pass that takes words of it. Where a pass takes all its words, the row
    is the document as it is. Where a block boundary cuts it, ``text`` is the words taken, parted by single
    spaces, and ``n_chars``, if there is such a column, its length. Texts without words are not in a mix.
    """
    whole = with_row_key(docs, "documents")
    sized = whole.select("row", "doc.doc_id", "doc.source", word_count(F.col("doc.text")).alias("size"))
    made = mix(stored(sized, "sized"), **options)
    sizes = made.spans.select("row", "size")
    piece = F.struct("first_word", "n_words")
    passes = made.pieces.groupBy("row", "pass").agg(
        F.array_sort(F.collect_list(piece)).alias("parts"), F.sum("n_words").alias("n"),
        F.min_by(F.struct("shard", "slot", "source_number", "start"), "first_word").alias("place"),
    )
    rows = whole.join(passes.join(sizes, "row"), "row")
    words = F.regexp_extract_all("doc.text", F.lit(NOT_WHITE), F.lit(0))
    some = rows.withColumn("words", F.when(F.col("n") < F.col("size"), words))
    cut = F.flatten(
        F.transform(
            "parts", lambda p: F.slice("words", (p["first_word"] + 1).cast("int"), p["n_words"].cast("int"))
        )
    )
    some = some.withColumn("cut", F.array_join(cut, " "))
    changed = {"text": F.col("cut"), "n_chars": F.char_length("cut")}
    mixed = F.struct(
        *(
            F.when(F.col("n") < F.col("size"), changed[name].cast(docs.schema[name].dataType))
            .otherwise(F.col(f"doc.`{name}`"))
            .alias(name)
            if name in changed
            else F.col(f"doc.`{name}`")
            for name in docs.columns
        )
    )
    dealt = some.select(mixed.alias("doc"), "place").repartition("place.shard").sortWithinPartitions("place")
    return dealt.select("doc.*")
