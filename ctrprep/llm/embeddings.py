"""Near-duplicate vectors by random-hyperplane signs, with exact cosines.

The signs of a vector's products with random hyperplanes are a code; vectors of equal code in one of several tables are compared
in double precision. The number of planes per table grows with the logarithm of the number of vectors, so that buckets stay small,
and the number of tables is what a pair right at the threshold needs to meet in one of them with probability ``RECALL``.

Equal vectors are one node with a multiplicity. Large buckets are cut into blocks and every pair of blocks is a group of its own.
Into the groups go ids and packed signs first. Two vectors that differ in more signs than ``CERTAIN`` standard deviations allow at the
threshold are ruled out, and so are pairs that met in an earlier table; only vectors with a partner left are then sent themselves.
A group reports sums and spanning trees, never pairs; a pair is counted in the first table it meets in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.llm.components import apart, connected
from ctrprep.llm.wordhash import mix
from ctrprep.sources.scratch import store

COSINE, RECALL = 0.95, 0.999
#: Vectors in a bucket that the number of planes aims at, and vectors on either side of a block.
BUCKET, BLOCK = 8, 1024
FEWEST_PLANES, MOST_PLANES = 8, 30
#: Standard deviations by which the number of differing signs may exceed the one to expect at the threshold.
CERTAIN = 8
SEED = 97


def table_plan(vectors: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Planes per table and tables for so many vectors; no planes and one table, where all meet, for a recall of 1."""
    if recall >= 1:
        return 0, 1
    planes = min(MOST_PLANES, max(FEWEST_PLANES, math.ceil(math.log2(max(1, vectors) / BUCKET))))
    meets = (1 - math.acos(cosine) / math.pi) ** planes
    return planes, math.ceil(math.log(1 - recall) / math.log(1 - meets))


def _planes(size: int, planes: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).normal(size=(size, tables * planes))


def most_different(signs: int, cosine: float = COSINE) -> int:
    """The number of differing signs, of so many, up to which two vectors can reach the cosine."""
    share = math.acos(cosine) / math.pi
    return min(signs, math.ceil(signs * share + CERTAIN * math.sqrt(signs * share * (1 - share))))


def signs_of(vectors: np.ndarray, planes: int, tables: int) -> np.ndarray:
    """One row of signs for each vector, table after table."""
    return vectors @ _planes(vectors.shape[1], planes, tables) > 0


def codes(signs: np.ndarray, planes: int, tables: int) -> np.ndarray:
    """The code of each row of signs in each table."""
    return signs.reshape(len(signs), tables, planes) @ (1 << np.arange(planes, dtype=np.int64))


def _unpacked(packed: pa.Array, signs: int) -> np.ndarray:
    joined = np.frombuffer(b"".join(packed.to_pylist()), np.uint8).reshape(len(packed), -1)
    return np.unpackbits(joined, axis=1, count=signs).astype(bool)


def _coded(planes: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size in np.unique(batch["size"].to_numpy()):
                part = batch.filter(pa.array(batch["size"].to_numpy() == size))
                body = part["embedding"].flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)
                body = body / np.abs(body).max(axis=1, keepdims=True)
                signs = signs_of(body, planes, tables)
                ends = pa.array(np.arange(len(signs) + 1, dtype=np.int32) * tables)
                salt = mix((np.arange(tables) + tables * int(size)).astype(np.uint64))
                key = mix(codes(signs, planes, tables).astype(np.uint64) + salt).view(np.int64)
                packed = pa.array([row.tobytes() for row in np.packbits(signs, axis=1)], pa.binary())
                keys = pa.ListArray.from_arrays(ends, pa.array(key.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [part["vec_id"], part["n"], part["embedding"], packed, keys], names=["vec_id", "n", "embedding", "signs", "keys"]
                )

    return run


def _first_met(signs: np.ndarray, a: np.ndarray, b: np.ndarray, table: int, planes: int, tables: int) -> np.ndarray:
    """Whether the vectors of each pair of rows have no bucket before ``table`` in common."""
    code = codes(signs, planes, tables)
    new = np.ones(len(a), bool)
    for t in range(table):
        new &= code[a, t] != code[b, t]
    return new


def _sides(group: pa.RecordBatch) -> tuple[bool, np.ndarray, np.ndarray]:
    """Whether a block meets itself, and which rows stand on either side."""
    own = group["i"][0].as_py() == group["j"][0].as_py()
    every = np.ones(group.num_rows, bool)
    first = every if own else group["first"].to_numpy(zero_copy_only=False)
    return own, np.flatnonzero(first), np.flatnonzero(every if own else ~first)


_PLACE = ["key", "position", "i", "j", "first", "vec_id"]


def _likely(planes: int, tables: int, most: int):
    """The rows of each group that have a partner left there, judged by signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ("key", "i", "j")):
            own, one, other = _sides(group)
            if group.num_rows < 2 or not len(one) or not len(other):
                continue
            signs = _unpacked(group["signs"], planes * tables)
            sides = signs.astype(np.float32) * 2 - 1
            near = sides[one] @ sides[other].T >= planes * tables - 2 * most
            if own:
                near = np.triu(near, 1)
            rows, cols = np.nonzero(near)
            a, b = one[rows], other[cols]
            new = _first_met(signs, a, b, int(group["position"][0].as_py()), planes, tables)
            use = np.zeros(group.num_rows, bool)
            use[a[new]] = use[b[new]] = True
            if use.any():
                yield group.filter(pa.array(use)).select(_PLACE)

    return run


def _grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """One batch for each run of rows with equal keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.column_stack([batch[k].to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((columns[1:] != columns[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(columns[lo])
            if key != last and held:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.concat_batches(held)


def _linked(cosine: float, planes: int, tables: int):
    """Each row's number of links within its group, weighted by multiplicity, and the smallest row it is joined to there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for group in _grouped(batches, ("key", "i", "j")):
            found = _group_links(group, cosine, planes, tables)
            if found is not None:
                out.append(found)
            if len(out) >= 500:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return run


def _batch(parts: list) -> pa.RecordBatch:
    arrays = [pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["vec_id", "links", "root"])


def _group_links(group: pa.RecordBatch, cosine: float, planes: int, tables: int):
    own, one, other = _sides(group)
    if group.num_rows < 2 or not len(one) or not len(other):
        return None
    vec, n = group["vec_id"].to_numpy(), group["n"].to_numpy()
    body = group["embedding"].flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(vec), -1)
    body = body / np.abs(body).max(axis=1, keepdims=True)
    body = body / np.sqrt((body * body).sum(axis=1, keepdims=True))
    near = body[one] @ body[other].T >= cosine
    if own:
        np.fill_diagonal(near, False)
    rows, cols = np.nonzero(near)
    if not len(rows):
        return None
    a, b = one[rows], other[cols]
    new = _first_met(_unpacked(group["signs"], planes * tables), a, b, int(group["position"][0].as_py()), planes, tables)
    links = np.bincount(a[new], n[b[new]], minlength=len(vec))
    if not own:
        links += np.bincount(b[new], n[a[new]], minlength=len(vec))
    root = vec.copy()
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            break
    use = (links > 0) | (root != vec)
    return vec[use], links[use].astype(np.int64), root[use]


def near_duplicates(
    vectors: DataFrame, embedding: str = "embedding", vec_id: str = "vec_id", cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Vectors that are NULL, zero, empty or hold a NULL or non-finite component link with nothing, nor do rows without an id, which are
    kept. Vectors of different lengths are not compared. Rows of one id are one vector, of several different ones the shortest and
    then that of the smallest hash, so that every run takes the same; only other ids count as links. With a ``recall`` of 1 all
    vectors of a length meet, block by block: exact, but quadratic, and meant for samples.
    """
    source = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0)
    valid = source.where(F.coalesce(usable, F.lit(False)))
    same = [F.xxhash64("embedding").alias("one"), F.xxhash64(F.lit(3), F.col("embedding")).alias("two"), F.size("embedding").alias("size")]
    version = F.struct("size", "one", "two")
    several = valid.select("vec_id", *same).groupBy("vec_id").agg(F.min(version).alias("own"), F.max(version).alias("last")).where("own <> last")
    several = store(several.select(F.col("vec_id").alias("__id"), "own"), "vector-versions")
    if not several.isEmpty():
        marked = valid.withColumns({c: e for c, e in zip(("size", "one", "two"), (same[2], same[0], same[1]), strict=True)})
        chosen = marked.join(several, F.col("vec_id") == F.col("__id"), "left")
        valid = chosen.where(F.col("own").isNull() | (F.col("own") == version)).select(*valid.columns)
    hashed = valid.select("vec_id", *same)
    firsts = hashed.groupBy("one", "two", "size").agg(F.min("vec_id").alias("first"), F.count_distinct("vec_id").alias("n"))
    firsts = firsts.select(apart("one").alias("key"), "two", "size", "first", "n")
    copies = hashed.select("vec_id", apart("one").alias("key"), "two", "size").join(firsts, ["key", "two", "size"])
    copies = store(copies.select("vec_id", "first", "n").distinct(), "vector-copies")
    nodes = copies.where("vec_id = first").select("vec_id", "n")
    planes, tables = table_plan(nodes.count(), cosine, recall)

    body = valid.select("vec_id", "embedding", F.size("embedding").alias("size")).dropDuplicates(["vec_id", "size"]).join(nodes, "vec_id")
    kind = valid.schema["embedding"].dataType.simpleString()
    schema = f"vec_id bigint, n bigint, embedding {kind}, signs binary, keys array<bigint>"
    coded = store(body.select("vec_id", "n", "size", "embedding").mapInArrow(_coded(planes, tables), schema), "vector-codes")

    places = coded.select("vec_id", F.posexplode("keys").alias("position", "key"))
    counts = places.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    counts = counts.select(apart("key").alias("apart"), F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    shared = places.withColumn("apart", apart("key")).join(counts, "apart")
    lists = shared.groupBy("vec_id").agg(F.collect_list(F.struct("position", "key", "blocks")).alias("places"))
    each = coded.select("vec_id", "signs").join(lists, "vec_id").withColumn("place", F.explode("places"))
    block = F.pmod(F.xxhash64("vec_id"), F.col("place.blocks")).cast("int")
    each = each.select("vec_id", "signs", "place.*", block.alias("block"))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.col("position").cast("int").alias("position"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") <= F.col("other")).alias("first"), "vec_id", "signs",
    )
    groups = each.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    place = "key bigint, position int, i int, j int, first boolean, vec_id bigint"
    likely = store(groups.mapInArrow(_likely(planes, tables, most_different(planes * tables, cosine)), place), "vector-places")
    sent = likely.join(coded.select("vec_id", "n", "embedding", "signs"), "vec_id")
    sent = sent.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = store(sent.mapInArrow(_linked(cosine, planes, tables), "vec_id bigint, links bigint, root bigint"), "vector-links")

    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    edges = found.where("root <> vec_id").select(F.col("vec_id").alias("a"), F.col("root").alias("b"))
    edges = edges.unionByName(copies.where("vec_id > first").select(F.col("vec_id").alias("a"), F.col("first").alias("b")))
    components = connected(edges, "vectors").withColumnRenamed("node", "vec_id")
    counted = copies.withColumn("key", apart("first")).join(links.select(apart("vec_id").alias("key"), "links"), "key", "left")
    counted = counted.groupBy("vec_id").agg((F.max(F.coalesce("links", F.lit(0)) + F.col("n")) - 1).alias("n_links"))
    labelled = source.select("vec_id").join(counted, "vec_id", "left").join(components, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return labelled.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
