"""URL rules by a bit-parallel wildcard automaton.

Every rule is a glob in which ``*`` stands for any run of characters. All globs together are one Shift-And
automaton: a glob of m characters has m + 1 states in consecutive bits, over as many 64-bit words as it
takes. A step shifts all states at once, keeps those whose character came, and holds the states that a
``*`` follows. The columns of states of many URLs are stepped together, so the cost is the length of the
URLs times the number of words, however many rules there are.

The text that the automaton reads is ``.host?path``. A ``?`` can be in neither part, so a rule for a host
and its subdomains is ``*.host?path*`` and cannot match inside a path.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path) of the base rules. The longest that fits decides.
BASE_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Globs that block what no base rule fits: hosts that sell, and files that are no pages.
BLOCK_GLOBS = (
    *(f".*{word}*?*" for word in ("casino", "free-bets", "betting", "poker", "jackpot", "cheap-pills", "viagra")),
    *(f".*{word}*?*" for word in ("payday-loan", "escort", "xxx", "porn", "warez", "torrent", "replica-watch")),
    *(f".{part}.*?*" for part in ("ads", "adserver", "track", "tracker", "pixel", "doubleclick")),
    *(f"*?*/{part}/*" for part in ("ads", "adserver", "wp-admin", "cgi-bin", "login", "signin", "cart", "checkout")),
    *(f"*?*.{kind}" for kind in ("exe", "zip", "rar", "apk", "dmg", "iso", "mp3", "mp4", "avi", "jpg", "png", "gif")),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: URLs that are stepped together.
_TOGETHER = 4096


@dataclass(frozen=True)
class Automaton:
    """``step[c]``: states that character c leads to; ``hold``: states that stay; ``start``; ``final`` by rule."""

    step: np.ndarray
    hold: np.ndarray
    start: np.ndarray
    final: np.ndarray


def compile_globs(globs: tuple[str, ...]) -> Automaton:
    """Pack globs into one automaton over UTF-8 bytes."""
    parts = [[part.encode() for part in glob.split("*")] for glob in globs]
    states = sum(sum(map(len, p)) + 1 for p in parts)
    words = max(1, -(-states // 64))
    step, hold, start = np.zeros((256, words), np.uint64), np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    final = np.zeros(len(globs), np.int64)

    def put(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    bit = 0
    for rule, pieces in enumerate(parts):
        put(start, bit)
        for k, piece in enumerate(pieces):
            for char in piece:
                bit += 1
                put(step[char], bit)
            if k + 1 < len(pieces):
                put(hold, bit)
        final[rule] = bit
        bit += 1
    return Automaton(step, hold, start, final)


def _states(automaton: Automaton, texts: list[bytes]) -> np.ndarray:
    """The automaton's states after each text, one row of words per text."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order])
    ends = np.cumsum(sizes)
    joined = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
    state = np.tile(automaton.start, (len(texts), 1))
    for place in range(int(sizes[0]) if len(sizes) else 0):
        # The texts stand from long to short, so those that go on are the first ones.
        live = int(np.searchsorted(-sizes, -place, side="left"))
        now = state[:live]
        moved = now << np.uint64(1)
        moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
        moved &= automaton.step[joined[ends[:live] - sizes[:live] + place]]
        moved |= now & automaton.hold
        state[:live] = moved
    result = np.empty_like(state)
    result[order] = state
    return result


def matches(automaton: Automaton, texts: list[bytes]) -> np.ndarray:
    """Which rule matches which text: a row per text, a column per rule."""
    found = np.zeros((len(texts), len(automaton.final)), bool)
    for start in range(0, len(texts), _TOGETHER):
        part = texts[start : start + _TOGETHER]
        state = _states(automaton, part)
        bits = state[:, automaton.final // 64] >> (automaton.final % 64).astype(np.uint64)
        found[start : start + len(part)] = (bits & np.uint64(1)).astype(bool)
    return found


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    place = F.instr(url, "://")
    return F.when(place > 0, F.substring(url, place + 3, F.char_length(url))).otherwise(F.lit(""))


def _judge(batches: Iterator[pa.RecordBatch], base: tuple, globs: tuple) -> Iterator[pa.RecordBatch]:
    # Longest rule first, so that the first match is the one that counts.
    ranked = sorted(base, key=lambda rule: -len(rule[1] + rule[2]))
    automaton = compile_globs((*(f"*.{host}?{path}*" for _, host, path in ranked), *globs))
    names = np.array([host + path for _, host, path in ranked] + [None], object)
    verdicts = np.array([verdict for verdict, _, _ in ranked] + [None], object)
    for batch in batches:
        found = matches(automaton, [text.encode() for text in batch.column("canonical").to_pylist()])
        fits, blocked = found[:, : len(ranked)], found[:, len(ranked) :].any(axis=1)
        first = np.where(fits.any(axis=1), fits.argmax(axis=1) if ranked else 0, len(ranked))
        verdict = np.where(first < len(ranked), verdicts[first], np.where(blocked, "block", "allow"))
        columns = [batch.column(name) for name in ("page_id", "host", "path")]
        columns += [pa.array(names[first], pa.string()), pa.array(verdict, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "host", "path", "rule", "verdict"])


def judged(pages: DataFrame, base: tuple = BASE_RULES, globs: tuple = BLOCK_GLOBS) -> DataFrame:
    """Pages (page_id, url) -> (page_id, host, path, rule, verdict), one row per row, repeated rows too.

    A NULL URL and one without ``://`` have empty host and path and are allowed unless a glob says otherwise. Of
    base rules of equal length the earlier one counts. An empty table gives no rows. Extra columns are not read.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    rows = pages.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"))
    rows = rows.withColumn("canonical", F.concat(F.lit("."), "host", F.lit("?"), "path"))
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, host string, path string, rule string, verdict string"
    return rows.mapInArrow(partial(_judge, base=base, globs=globs), schema)
