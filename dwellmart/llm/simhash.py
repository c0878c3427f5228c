"""SimHash near-duplicates by vantage-point trees: every pair of fingerprints within a few bits.

A fingerprint is one bit vote per word shingle. Documents with equal fingerprints are one class, and only
distinct fingerprints are compared.

The 64 bits are four lanes of 16. Two fingerprints that differ in at most ``max_bits`` bits differ by
at most ``r`` in some lane, where the lanes' radii plus one each add up to more than ``max_bits``: for 4
bits the radii are 1, 0, 0, 0, since more than that in every lane makes 5 differing bits. Each lane has a
vantage-point tree over all 65,536 lane values. A node splits its values by their Hamming distance to a
vantage value at the median distance; a search goes down a branch unless the triangle inequality rules
it out. Leaves are the shards. A fingerprint lives in the shard of its own lane value and also queries
the shards that its radius overlaps, so every pair meets in a shard and is compared there on all 64 bits.
The tree depends on nothing but its seed, so any executor can make it again.

Shards with many members are dealt out as tiles of bounded size. A shard hands on a spanning forest of
its links, never the pairs; components are then found over all shards.
"""

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmart.llm.components import component_of
from dwellmart.llm.stored import runs, smallest_linked, stored, table, temporary, text_bytes, with_row_key

LANES, LANE_BITS = 4, 16
VALUES = 1 << LANE_BITS
LEAF_VALUES = 8
#: Members and visitors of one tile.
TILE = 4096
_CHUNK = 1 << 15


# --- fingerprints -----------------------------------------------------------------------------------


def _shingles(words: list[bytes], length: int) -> Iterator[list[bytes]]:
    if len(words) <= length:
        yield [b" ".join(words)]
        return
    for start in range(0, len(words) - length + 1, _CHUNK):
        part = words[start : start + _CHUNK + length - 1]
        joined = b" ".join(part)
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        ends = np.cumsum(sizes + 1) - 1
        first = (ends - sizes)[: len(part) - length + 1].tolist()
        yield [joined[i:j] for i, j in zip(first, ends[length - 1 :].tolist(), strict=True)]


def fingerprint_of(text: bytes, length: int = 4) -> int:
    """The fingerprint of one text, as a signed 64-bit number; 0 for a text without words."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return 0
    ones, n = np.zeros(64, np.int64), 0
    for shingles in _shingles(words, length):
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64, len(shingles))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
        n += len(shingles)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, length: int = 4) -> Column:
    """Fingerprint of a text column; NULL counts as empty."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t, length) for t in texts.to_pylist()], pa.int64())

    return of(text_bytes(text))


# --- vantage-point trees ----------------------------------------------------------------------------


def lane_radii(max_bits: int) -> list[int]:
    """The smallest radii, one per lane, whose successors add up to more than ``max_bits``; -1: not needed."""
    shares = [(max_bits + 1) // LANES + (lane < (max_bits + 1) % LANES) for lane in range(LANES)]
    return [share - 1 for share in shares]


def _apart(values: np.ndarray, value: int) -> np.ndarray:
    return np.bitwise_count(values ^ np.uint16(value)).astype(np.int8)


@cache
def vantage_tree(radius: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shard of each lane value, and the shards its ball of ``radius`` overlaps, as slices.

    Returns ``home``, ``starts`` and ``shards``: value v queries ``shards[starts[v]:starts[v + 1]]``.
    """
    everything = np.arange(VALUES, dtype=np.uint16)
    home = np.zeros(VALUES, np.int32)
    reached: list[tuple[np.ndarray, int]] = []
    choose = np.random.default_rng(seed)
    todo = [(everything, everything)]
    leaves = 0
    while todo:
        members, visitors = todo.pop()
        middle = 0
        if len(members) > LEAF_VALUES:
            vantage = int(members[choose.integers(len(members))])
            own, far = _apart(members, vantage), _apart(visitors, vantage)
            middle = int(np.median(own))
            if (own > middle).any():
                todo.append((members[own <= middle], visitors[far - radius <= middle]))
                todo.append((members[own > middle], visitors[far + radius > middle]))
                continue
        near = np.zeros(len(visitors), bool)
        for value in members.tolist():
            near |= _apart(visitors, value) <= radius
        home[members] = leaves
        reached.append((visitors[near], leaves))
        leaves += 1
    values = np.concatenate([v for v, _ in reached]).astype(np.int64)
    shards = np.concatenate([np.full(len(v), leaf, np.int32) for v, leaf in reached])
    order = np.lexsort((shards, values))
    starts = np.searchsorted(values[order], np.arange(VALUES + 1))
    return home, starts, shards[order]


def _lane(prints: np.ndarray, lane: int) -> np.ndarray:
    return ((prints.view(np.uint64) >> np.uint64(lane * LANE_BITS)) & np.uint64(VALUES - 1)).astype(np.int64)


_MEMBER, _VISITOR, _BOTH = 0, 1, 2
_PLACED = pa.schema([("shard", pa.int64()), ("tile", pa.int64()), ("role", pa.int8()), ("print", pa.int64())])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _tiles(members: np.ndarray, visitors: np.ndarray) -> dict[int, tuple[int, int]]:
    split = np.flatnonzero((members > TILE) | (visitors > TILE))
    return {int(s): (-(-int(members[s]) // TILE), -(-int(visitors[s]) // TILE)) for s in split}


def _hot_shards(prints: DataFrame, radii: list[int]) -> dict[int, tuple[int, int]]:
    """Shards that need tiles, with the number of member and visitor parts.

    The counts by lane value behind it are at most 4 x 65,536 rows, whatever the input.
    """
    value = [F.shiftrightunsigned("print", lane * LANE_BITS).bitwiseAND(F.lit(VALUES - 1)) for lane in range(LANES)]
    lanes = F.explode(F.array(*(v + lane * VALUES for lane, v in enumerate(value))))
    hot: dict[int, tuple[int, int]] = {}
    counted = prints.select(lanes.alias("value")).groupBy("value").count().toArrow()
    keys, counts = counted["value"].to_numpy(), counted["count"].to_numpy()
    for lane, radius in enumerate(radii):
        if radius < 0:
            continue
        home, starts, shards = vantage_tree(radius)
        own = keys // VALUES == lane
        by_value = np.zeros(VALUES, np.int64)
        by_value[keys[own] % VALUES] = counts[own]
        members = np.bincount(home, by_value, minlength=home.max() + 1)
        visits = np.bincount(shards, np.repeat(by_value, np.diff(starts)), minlength=home.max() + 1)
        hot |= {lane * VALUES + shard: parts for shard, parts in _tiles(members, visits).items()}
    return hot


def _part(prints: np.ndarray, parts: int) -> np.ndarray:
    mixed = prints.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _place(batches: Iterator[pa.RecordBatch], radii: list[int], hot: dict) -> Iterator[pa.RecordBatch]:
    """Each fingerprint in its own shard and in those it queries."""
    for batch in batches:
        prints = batch.column("print").to_numpy()
        for lane, radius in enumerate(radii):
            if radius < 0:
                continue
            home, starts, shards = vantage_tree(radius)
            values = _lane(prints, lane)
            if radius == 0:
                placed = [(home[values], _BOTH, prints)]
            else:
                counts = starts[values + 1] - starts[values]
                at = np.repeat(starts[values] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                placed = [(home[values], _MEMBER, prints), (shards[at], _VISITOR, np.repeat(prints, counts))]
            for where, role, who in placed:
                shard = where.astype(np.int64) + lane * VALUES
                yield from _dealt(shard, role, who, hot)


def _dealt(shard: np.ndarray, role: int, who: np.ndarray, hot: dict) -> Iterator[pa.RecordBatch]:
    busy = np.isin(shard, np.fromiter(hot, np.int64, len(hot)))
    calm = ~busy
    n = int(calm.sum())
    yield table({"shard": shard[calm], "tile": np.zeros(n, np.int64), "role": np.full(n, role), "print": who[calm]}, _PLACED)
    for one in np.unique(shard[busy]).tolist():
        rows, (across, down) = who[shard == one], hot[one]
        for kind in (_MEMBER, _VISITOR) if role == _BOTH else (role,):
            part, copies = (_part(rows, across), down) if kind == _MEMBER else (_part(rows, down), across)
            for other in range(copies):
                tile = part * down + other if kind == _MEMBER else other * down + part
                m = len(rows)
                yield table({"shard": np.full(m, one), "tile": tile, "role": np.full(m, kind), "print": rows}, _PLACED)


def _compare(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links inside each tile, as a spanning forest."""
    for run in runs(batches, ["shard", "tile"]):
        members = run["print"][run["role"] != _VISITOR]
        visitors = run["print"][run["role"] != _MEMBER]
        if not len(members) or not len(visitors):
            continue
        nodes, at = np.unique(np.concatenate([members, visitors]), return_inverse=True)
        if len(nodes) < 2:
            continue
        m, v = at[: len(members)], at[len(members) :]
        codes = nodes.view(np.uint64)
        smallest = np.arange(len(nodes))
        for start in range(0, len(m), 256):
            some = m[start : start + 256]
            near = np.bitwise_count(codes[some][:, None] ^ codes[v][None, :]) <= max_bits
            near &= some[:, None] != v[None, :]
            i, j = np.nonzero(near)
            if len(i):
                smallest = smallest_linked_from(smallest, some[i], v[j])
        linked = np.flatnonzero(smallest != np.arange(len(nodes)))
        if len(linked):
            yield table({"a": nodes[smallest[linked]], "b": nodes[linked]}, _LINKS)


def smallest_linked_from(smallest: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Join more links into a forest whose items point at the smallest item of their tree."""
    joined = smallest_linked(len(smallest), smallest[left], smallest[right])
    return joined[smallest]


def print_links(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """Distinct fingerprints (print) -> links (a, b) that span every group of fingerprints within reach.

    Every pair within ``max_bits`` is connected by the links; no link joins fingerprints further apart
    than that but through others.
    """
    if not 0 <= max_bits < 64:
        raise ValueError("max_bits must be between 0 and 63")
    radii = lane_radii(max_bits)
    hot = _hot_shards(prints, radii)
    placed = prints.mapInArrow(partial(_place, radii=radii, hot=hot), "shard long, tile long, role byte, print long")
    dealt = placed.repartition("shard", "tile").sortWithinPartitions("shard", "tile")
    return dealt.mapInArrow(partial(_compare, max_bits=max_bits), "a long, b long")


# --- the operator -----------------------------------------------------------------------------------


def _groups(prints: DataFrame, max_bits: int) -> DataFrame:
    """(print, id) rows -> (print, first): the smallest id of the group of each distinct fingerprint."""
    with temporary(prints.sparkSession) as keep:
        classes = stored(prints.groupBy("print").agg(F.min("id").alias("id")), "classes")
        components = component_of(print_links(classes.select("print"), max_bits))
        placed = classes.join(components, F.col("node") == F.col("print"), "left").select(
            "print", "id", F.coalesce("component", "print").alias("root")
        )
        roots = placed.groupBy("root").agg(F.min("id").alias("first"))
        return keep(placed.join(roots, "root").select("print", "first"), "groups")


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """Documents (doc_id, text, ...) -> (doc_id, fingerprint, component_id), one row per row.

    NULL and empty texts, and texts without words, have fingerprint zero and form one group. Repeated rows
    each get their row. ``component_id`` is NULL only in a group in which no document has an id. An empty
    table gives no rows. Extra columns, whatever their names, are not read.
    """
    prints = stored(
        docs.select(F.col("doc_id").alias("id"), fingerprint(F.col("text"), shingle_words).alias("print")), "prints"
    )
    return prints.join(_groups(prints, max_bits), "print").select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.col("first").alias("component_id"),
    )


def one_of_each_group(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` without near duplicates: the smallest doc_id of each group stays.

    NULL ids come last. Of several rows with the same id in a group, repeated rows among them, the one with
    the first row key stays. The columns are those of ``docs``; other cases are those of ``near_duplicates``.
    """
    whole = with_row_key(docs, "documents")
    order = F.struct(F.col("doc.doc_id").isNull(), F.col("doc.doc_id"), F.col("row"))
    prints = whole.select(fingerprint(F.col("doc.text"), shingle_words).alias("print"), order.alias("id"))
    groups = _groups(stored(prints, "prints"), max_bits)
    kept = groups.select(F.col("first.row").alias("row")).distinct()
    return whole.join(kept, "row", "left_semi").select("doc.*")
