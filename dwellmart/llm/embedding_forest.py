"""Near-duplicate embeddings by a forest of random-projection trees with spill.

Equal vectors of a label are one class; only classes are compared. In each tree a node splits its members
at the median of their projection on a random direction. Members within ``spill`` of the split go to both
sides. Two unit vectors at the threshold are ``r = sqrt(2 - 2 * least)`` apart, so their projections differ
by about ``r / sqrt(d)``; the spill is half of that, and one tree parts such a pair at about one node in
a hundred. A pair is missed only if every tree parts it. All pairs in a leaf are compared by their cosine
in double precision, so no pair below the threshold is linked.

Trees grow in rounds: nodes above ``LEAF`` members are sampled (``SAMPLE`` members), each sample is split
some levels deep in its own task, and all members are sent down. Nodes that no direction can split, such
as a tight group, stay whole and are compared in tiles of bounded size.

A pair that shares several leaves is counted in one of them: every member carries the codes of its
leaves, and the smallest common code counts. A tile hands on a count per vector and a spanning forest of
its links, never the pairs.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmart.llm.components import component_of
from dwellmart.llm.stored import runs, smallest_linked, stored, temporary

LEAST = 0.98
TREES = 8
LEAF = 512
SAMPLE = 4096
#: Levels that a node is split in one round, and directions that are tried for each split.
LEVELS, TRIES = 6, 3
#: A split must leave each side at most this part of the members.
LARGEST_SIDE = 0.8
TILE = 1024
_NODE = ["label", "dim", "tree", "path"]


def _direction(tree: int, path: int, attempt: int, dim: int) -> np.ndarray:
    drawn = np.random.default_rng([tree, path, attempt, dim]).standard_normal(dim)
    return drawn / np.linalg.norm(drawn)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    rows = np.stack(vectors).astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spill_of(dim: int, least: float) -> float:
    return 0.5 * np.sqrt((2 - 2 * least) / dim)


def _fit(batches: Iterator[pa.RecordBatch], least: float, leaf: int) -> Iterator[pa.RecordBatch]:
    """The splits of each sampled node: (path, attempt, threshold) for the node and those below it."""
    for run in runs(batches, _NODE):
        tree, dim = int(run["tree"][0]), int(run["dim"][0])
        spill, points = spill_of(dim, least), _unit(run["embedding"])
        splits, todo = [], [(int(run["path"][0]), np.arange(len(points)), float(run["members"][0]), 0)]
        while todo:
            path, some, members, level = todo.pop()
            if members <= leaf or level == LEVELS or len(some) < 16:
                continue
            for attempt in range(TRIES):
                along = points[some] @ _direction(tree, path, attempt, dim)
                middle = float(np.median(along))
                sides = some[along <= middle + spill], some[along >= middle - spill]
                if max(map(len, sides)) <= LARGEST_SIDE * len(some):
                    splits.append((path, attempt, middle))
                    for side, own in enumerate(sides):
                        todo.append((2 * path + side, own, members * len(own) / len(some), level + 1))
                    break
        columns = [pa.array(run[name][:1], pa.int64()) for name in _NODE]
        columns += [pa.array([[s[i] for s in splits]], pa.list_(kind)) for i, kind in enumerate((pa.int64(), pa.int32(), pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=[*_NODE, "paths", "attempts", "middles"])


_SPLITS = "label long, dim long, tree long, path long, paths array<long>, attempts array<int>, middles array<double>"


def _send_down(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Members of split nodes, each in every leaf it reaches; ``final`` where nothing was split."""
    names = ["vector", "label", "dim", "embedding", "tree", "path", "final"]
    for batch in batches:
        rows = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in _NODE}
        keys, group = np.unique(np.stack([rows[k] for k in _NODE]), axis=1, return_inverse=True)
        splits_of = {}
        for g, first in zip(*np.unique(group, return_index=True), strict=True):
            p, a, m = (batch.column(c)[int(first)].as_py() for c in ("paths", "attempts", "middles"))
            splits_of[int(g)] = dict(zip(p, zip(a, m, strict=True), strict=True))
        embeddings = batch.column("embedding").to_numpy(zero_copy_only=False)
        at, paths, final = [], [], []
        for g, splits in splits_of.items():
            mine = np.flatnonzero(group == g)
            _, dim, tree, root = keys[:, g].tolist()
            points, spill = _unit(embeddings[mine]), spill_of(dim, least)
            todo = [(root, np.arange(len(mine)))]
            while todo:
                path, some = todo.pop()
                if path in splits:
                    attempt, middle = splits[path]
                    along = points[some] @ _direction(tree, path, attempt, dim)
                    todo += [(2 * path, some[along <= middle + spill]), (2 * path + 1, some[along >= middle - spill])]
                elif len(some):
                    at.append(mine[some])
                    paths.append(np.full(len(some), path))
                    final.append(np.full(len(some), not splits))
        index = pa.array(np.concatenate(at)) if at else pa.array([], pa.int64())
        kept = batch.select([n for n in names if n not in ("path", "final")]).take(index)
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(np.concatenate(paths) if at else [], pa.int64()),
             pa.array(np.concatenate(final) if at else [], pa.bool_())],
            names=[*kept.schema.names, "path", "final"],
        )


def leaves(vectors: DataFrame, least: float, trees: int, leaf: int, sample: int) -> DataFrame:
    """(vector, label, dim, embedding) -> the same with tree and path, once for every leaf it is in."""
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long")))
    kind = vectors.schema["embedding"].dataType.simpleString()
    rows = vectors.select("*", numbers.alias("tree"), F.lit(1).cast("long").alias("path"), F.lit(False).alias("final"))
    done = []
    while True:
        sizes = stored(rows.where("not final").groupBy(*_NODE).agg(F.count("*").alias("members")), "sizes")
        large = sizes.where(F.col("members") > leaf)
        if large.isEmpty():
            break
        # Without broadcast hint: a label may hold most rows, and AQE splits its side of this join.
        growing = rows.where("not final").join(large, _NODE)
        rate = F.pmod(F.xxhash64("vector", "tree"), F.lit(1 << 30)) < F.lit(sample * float(1 << 30)) / F.col("members")
        sampled = growing.where(rate).select(*_NODE, "members", "embedding")
        splits = stored(
            sampled.repartition(*map(F.col, _NODE)).sortWithinPartitions(*_NODE).mapInArrow(
                partial(_fit, least=least, leaf=leaf), _SPLITS
            ),
            "splits",
        )
        sent = growing.drop("members").join(splits, _NODE).mapInArrow(
            partial(_send_down, least=least),
            f"vector long, label long, dim long, embedding {kind}, tree long, path long, final boolean",
        )
        # A node is split at once or never again, so what is not split now is a leaf.
        done.append(rows.where("final").unionByName(rows.where("not final").join(large, _NODE, "left_anti")))
        rows = stored(sent, "sent")
    for part in done:
        rows = rows.unionByName(part)
    return rows.drop("final")


_FOUND = pa.schema([("vector", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])


def _shared_before(left: list[np.ndarray], right: list[np.ndarray], code: int) -> np.ndarray:
    """Whether two members share a leaf whose code is smaller than this one's."""
    sides = [[codes[codes < code] for codes in side] for side in (left, right)]
    every = [np.concatenate(side) if side else np.zeros(0, np.int64) for side in sides]
    known = np.intersect1d(*every)
    if not len(known):
        return np.zeros((len(left), len(right)), bool)
    masks = []
    for side, flat in zip(sides, every, strict=True):
        row = np.repeat(np.arange(len(side)), [len(codes) for codes in side])
        at = np.searchsorted(known, flat)
        ok = known[np.minimum(at, len(known) - 1)] == flat
        mask = np.zeros((len(side), len(known)), np.float32)
        mask[row[ok], at[ok]] = 1
        masks.append(mask)
    return masks[0] @ masks[1].T > 0


def _compare(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Link counts and a spanning forest of the links of each tile of a leaf."""
    for run in runs(batches, ["label", "dim", "code", "low", "high"]):
        n = len(run["vector"])
        if n < 2:
            continue
        low, high = int(run["low"][0]), int(run["high"][0])
        a, b = (np.flatnonzero(run["part"] == part) for part in (low, high))
        if not len(a) or not len(b):
            continue
        unit = _unit(run["embedding"])
        near = unit[a] @ unit[b].T >= least
        near &= run["vector"][a][:, None] != run["vector"][b][None, :]
        rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(rows):
            continue
        a, b, near = a[rows], b[columns], near[np.ix_(rows, columns)]
        own = near & ~_shared_before([run["codes"][i] for i in a], [run["codes"][i] for i in b], int(run["code"][0]))
        links = np.zeros(n, np.int64)
        links[a] += own @ run["copies"][b]
        if low != high:
            links[b] += own.T @ run["copies"][a]
        i, j = np.nonzero(near)
        smallest = smallest_linked(n, a[i], b[j])
        linked, counted = np.flatnonzero(smallest != np.arange(n)), np.flatnonzero(links)
        vector = run["vector"]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([vector[counted], vector[linked]])),
                pa.array(np.concatenate([links[counted], np.zeros(len(linked), np.int64)])),
                pa.array([*[None] * len(counted), *vector[smallest[linked]].tolist()], pa.int64()),
            ],
            schema=_FOUND,
        )


def _compared(members: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """(vector, links, other) rows of all leaves."""
    coded = members.withColumn("code", F.xxhash64("tree", "path"))
    # A vector is in a bounded number of leaves: some for each tree.
    codes = coded.groupBy("vector").agg(F.collect_list("code").alias("codes"))
    sizes = coded.groupBy("label", "dim", "code").agg(F.count("*").alias("members"))
    large = sizes.where(F.col("members") > TILE).select(
        "label", "dim", "code", F.ceil(F.col("members") / TILE).alias("parts")
    )
    dealt = coded.join(large, ["label", "dim", "code"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("vector", F.lit(1)), F.col("parts")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = dealt.join(codes, "vector").join(classes.select("vector", "copies"), "vector").select(
        "label", "dim", "code", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
        "part", "vector", "embedding", "copies", "codes",
    )
    keys = ["label", "dim", "code", "low", "high"]
    tiles = rows.repartition(*map(F.col, keys)).sortWithinPartitions(*keys)
    return tiles.mapInArrow(partial(_compare, least=least), "vector long, links long, other long")


def near_duplicates(
    vectors: DataFrame, least: float = LEAST, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE
) -> DataFrame:
    """Vectors (vec_id, embedding, label) -> (vec_id, n_links, component_id, kept), one row per row.

    Vectors that are NULL, empty or zero, hold NULL or non-finite components or have a NULL label link with
    nothing; nor do vectors of different length. Repeated rows are vectors of their own and link with each
    other. A vector without id counts in the links of others, is in their component and is not kept;
    ``component_id`` is NULL where no vector of a component has an id. An empty table gives no rows. Extra
    columns are not read.
    """
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd & some
    # Only components of single precision are kept as such; others would lose digits, or overflow.
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(
        "vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast(kind).alias("embedding")
    ).withColumn("usable", F.coalesce(usable, F.lit(False)))
    spark = vectors.sparkSession
    with temporary(spark) as keep:
        classes = stored(
            rows.where("usable")
            .groupBy("label", "embedding")
            .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
            .select(
                F.monotonically_increasing_id().alias("vector"), "label", F.size("embedding").cast("long").alias("dim"),
                "embedding", "first_id", "copies",
            ),
            "classes",
        )
        with temporary(spark) as keep_leaves:
            found_leaves = leaves(classes.select("vector", "label", "dim", "embedding"), least, trees, leaf, sample)
            members = keep_leaves(found_leaves, "leaves")
        found = stored(_compared(members, classes, least), "found")
        counts = found.groupBy("vector").agg(F.sum("links").alias("links"))
        components = component_of(found.where("other is not null").select(F.col("vector").alias("a"), F.col("other").alias("b")))
        placed = classes.join(components, F.col("node") == F.col("vector"), "left").join(counts, "vector", "left").select(
            F.col("label").alias("of_label"), F.col("embedding").alias("of_embedding"), "first_id", "copies",
            F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "vector").alias("root"),
        )
        placed = keep(placed, "placed")
    roots = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = placed.join(roots, "root").select(
        "of_label", "of_embedding", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = rows.where("usable").join(
        known, (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of_embedding"))
    )
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
