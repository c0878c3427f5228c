"""Quality rules as weak supervision, with DataFrame operations only.

Each rule looks at one measure of a text and votes good (1), bad (-1) or abstains (0). Expectation
maximisation over all documents estimates how often each rule casts each vote on good and on bad
documents, without any label, and Bayes' rule turns the votes of a document into its probability of being
good. So one weak rule no longer throws a document away, and several together do.

Documents with the same votes share one row of the fitted table: with R rules it has at most 3^R rows,
whatever the corpus, and every step of the fit is one aggregation over it.

A window of three words is compared by its 64-bit hash, within one text only: of a text with 20,000
words, two different windows are taken for one with a chance of 10^-11.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellmart.llm.stored import NOT_WHITE, stored, temporary

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further measures that only rules use: lines with a word, upper-case letters, runs of symbols, sentence ends.
LOOKS = ("n_lines", "n_capitals", "n_runs", "n_sentences")
VOTES = (-1, 0, 1)
ROUNDS = 15
#: Most that one vote can add to the logarithm of the odds: no rule decides alone.
MOST_GAIN = math.log(20)
#: Between what bounds the fit keeps the share of good documents.
SHARE = (0.5, 0.98)


def measured(docs: DataFrame, keep: Column) -> DataFrame:
    """(kept, the measures, the looks) for each row of documents; NULL text is empty."""
    rows = docs.select(keep.alias("kept"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns(
        {
            "words": F.regexp_extract_all("text", F.lit(NOT_WHITE), F.lit(0)),
            "lines": F.filter(F.split("text", "\n"), lambda line: line.rlike(NOT_WHITE)),
            "n_symbols": F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long"),
            "n_capitals": F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long"),
            "n_runs": F.regexp_count("text", F.lit(r"[#*$%&|<>!]{2,}|\|")).cast("long"),
            "n_sentences": F.regexp_count("text", F.lit(r"[.!?](?=\s|$)")).cast("long"),
        }
    )
    n = F.size("words")
    last = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    window = F.transform(
        last, lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    )
    rows = rows.select(
        "kept",
        "n_symbols",
        *LOOKS[1:],
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        window.alias("windows"),
    )
    # Most texts have no window twice; only the others are sorted.
    places = F.transform("windows", lambda key, i: F.struct(key.alias("key"), i.alias("i")))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("places", F.when(twice, F.array_sort(places)))

    def repeated(place: Column, j: Column) -> Column:
        same = [F.get("places", j - 1)["key"] == place["key"], F.get("places", j + 1)["key"] == place["key"]]
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    at = F.array_sort(F.transform(F.filter("places", repeated), lambda place: place["i"]))
    rows = rows.withColumn("at", at)
    covered = F.transform("at", lambda i, j: F.least(F.lit(3), F.coalesce(F.get("at", j + 1) - i, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select(
        "kept", *MEASURES[:-1], F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"), *LOOKS
    )


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The votes, by rule. All abstain on a text without words."""
    words, chars = F.col("n_words"), F.col("word_chars")
    per_word = {name: F.try_divide(F.col(name), words) for name in (*MEASURES[1:], *LOOKS)}
    capitals = F.try_divide(F.col("n_capitals"), chars)
    lines = F.try_divide(F.col("n_dup_lines"), F.col("n_lines"))
    size, symbols, repeats = per_word["word_chars"], per_word["n_symbols"], per_word["n_repeat_words"]
    runs, sentences = per_word["n_runs"], per_word["n_sentences"]
    return {
        "word_size": _vote(size, size.between(3, 7), (size < 2.5) | (size > 8.5)),
        "symbols": _vote(symbols, symbols < 0.02, symbols > 0.1),
        "symbol_runs": _vote(runs, runs < 0.01, runs > 0.05),
        "capitals": _vote(capitals, capitals < 0.1, capitals > 0.3),
        "sentences": _vote(sentences, sentences.between(0.03, 0.3), (sentences < 0.015) | (sentences > 0.5)),
        "repeated_lines": _vote(lines, lines == 0, lines > 0.3),
        "repeated_words": _vote(repeats, repeats < 0.1, repeats > 0.3),
    }


@dataclass(frozen=True)
class Fit:
    """The share of good documents, and how often a rule casts a vote on good and on bad ones."""

    share: float
    given_good: dict[str, dict[int, float]]
    given_bad: dict[str, dict[int, float]]

    @property
    def prior(self) -> float:
        return math.log(self.share) - math.log1p(-self.share)

    def gains(self, rule: str) -> dict[int, float]:
        """What each vote of a rule adds to the logarithm of the odds."""
        good, bad = self.given_good[rule], self.given_bad[rule]
        return {v: min(max(math.log(good[v]) - math.log(bad[v]), -MOST_GAIN), MOST_GAIN) for v in VOTES}

    def posterior(self) -> Column:
        """Probability that a document is good, from its vote columns."""
        odds = F.lit(self.prior)
        for rule in self.given_good:
            for v, gain in self.gains(rule).items():
                odds = odds + F.when(F.col(rule) == v, gain).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def _rates(sums: list, names: list[str]) -> Fit:
    """Maximisation: the rates that the posterior of each pattern implies."""
    found = {(row.rule, row.vote): row for row in sums}

    def total(kind: str, rule: str) -> float:
        return sum(found[rule, v][kind] for v in VOTES if (rule, v) in found)

    def rates(kind: str) -> dict[str, dict[int, float]]:
        # One document's worth of every vote is added, so that no rate is 0.
        return {
            rule: {
                v: ((found[rule, v][kind] if (rule, v) in found else 0.0) + 1) / (total(kind, rule) + len(VOTES))
                for v in VOTES
            }
            for rule in names
        }

    good, bad = total("good", names[0]), total("bad", names[0])
    share = (good + 1) / (good + bad + 2)
    return Fit(min(max(share, SHARE[0]), SHARE[1]), rates("good"), rates("bad"))


def fit(votes: DataFrame, names: list[str], rounds: int = ROUNDS) -> Fit:
    """Fit over a table with one vote column per rule. It starts from: bad with any bad vote.

    A table without rows gives rates that favour nothing. The rates of a round reach the next one as a
    table of a few rows, not as literals, so that all rounds share their compiled code.
    """
    spark = votes.sparkSession
    with temporary(spark):
        patterns = votes.groupBy(*names).agg(F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id())
        cast = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).cast("int").alias("vote")) for r in names)))
        # At most 3^R patterns of R votes each: one task is enough.
        cast_votes = stored(patterns.select("id", "n", cast.alias("one")).select("id", "n", "one.*"), "patterns").coalesce(1)
        pattern = Window.partitionBy("id")

        def sums(rows: DataFrame, good: Column) -> list:
            weighed = rows.withColumn("p", good)
            n, p = F.col("n"), F.col("p")
            return weighed.groupBy("rule", "vote").agg(F.sum(n * p).alias("good"), F.sum(n * (1 - p)).alias("bad")).collect()

        found = _rates(sums(cast_votes, F.when(F.min("vote").over(pattern) == -1, 0.1).otherwise(0.9)), names)
        for _ in range(rounds):
            rows = ", ".join(
                f"('{rule}', {v}, {gain!r}D, {found.prior!r}D)" for rule in names for v, gain in found.gains(rule).items()
            )
            gains = F.broadcast(spark.sql(f"SELECT * FROM VALUES {rows} AS gains(rule, vote, gain, prior)"))
            odds = F.sum("gain").over(pattern) + F.col("prior")
            found = _rates(sums(cast_votes.join(gains, ["rule", "vote"]), 1 / (1 + F.exp(-odds))), names)
        return found


def _judged(docs: DataFrame, keep: Column, least: float) -> DataFrame:
    votes = rules()
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stored(measured(docs, keep).withColumns(votes).withColumn("base_failed", base_failed), "measured")
    # What the base rule throws out is decided; the fit is over all that it leaves to the votes.
    found = fit(rows.where(~F.col("base_failed")), list(votes))
    rows = rows.withColumn("quality", found.posterior())
    return rows.withColumn("good", ~F.col("base_failed") & (F.col("quality") >= least))


def judge(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents -> doc_id, the measures, base_failed, quality (probability of being good) and kept.

    One row per row, repeated rows too. NULL and empty texts and texts without words have zero measures and
    fail the base rule. An empty table gives no rows. Extra columns are not read.
    """
    return _judged(docs, F.col("doc_id"), least).select(
        F.col("kept").alias("doc_id"), *MEASURES, "base_failed", "quality", F.col("good").alias("kept")
    )


def keep_good(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    return _judged(docs, F.struct("*"), least).where("good").select("kept.*")
