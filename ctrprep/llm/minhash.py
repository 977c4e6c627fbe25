"""Near-duplicate documents by one-permutation MinHash, with exact confirmation on full shingle sets.

**Signature.** One hash per shingle; the hash range is cut into ``BINS`` equal bins and each bin keeps its smallest hash. An empty
bin copies from a bin chosen by a fixed random sequence of its own, the first that is not empty (optimal densification), so that
bins of two sets agree with the probability of their similarity, small sets included.

**Candidates.** Bands of ``ROWS`` bins are bucket keys. With 32 bands of 5, two sets of similarity 0.8 meet in no bucket with
probability 3 in a million, and of 0.85 one in ten million. Documents with equal sets are one node. In each bucket every document is paired with the smallest one
only, a star, so candidates grow with a bucket's size and not with its square.

**Confirmation.** Candidates' texts meet in groups of a bounded size and their full sets are compared. A star can miss a link
between two documents that are both unlike its centre. So after the stars' components are known, the members of a bucket outside its
centre's component meet all its members, blockwise: signatures rule out most pairs, the first bucket that two documents share has their
full sets compared, and a group reports one link for two components at most, so that even there no pairs of a large group are written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.llm.components import apart, connected
from ctrprep.llm.substrings import Rolling
from ctrprep.llm.wordhash import WordBlock, WordHasher, is_space, mix
from ctrprep.sources.scratch import store

SHINGLE = 4
#: Words of a shingle where documents are dropped.
STAGE_SHINGLE = 5
BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
#: Similarity in hundredths from which documents are linked.
PERCENT = 80
#: Signatures that agree in fewer bins cannot belong to sets of the threshold: eight standard deviations below it.
LEAST_AGREEMENT = int(BINS * (0.8 - 8 * (0.8 * 0.2 / BINS) ** 0.5))
#: Documents compared with one centre, and on either side of a block of signatures.
GROUP, BLOCK = 64, 512

_BASE = 0x8CB92BA72F3D8DD7


def shingle_sets(block: WordBlock, roller: Rolling, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; a row of fewer words has one for all of them, an empty one none."""
    sums, at = roller.sums(block.words), block.at
    first = np.arange(max(0, len(block.words) - size + 1))
    every = roller.between(sums, first, first + size)
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if hi - lo >= size:
            out.append(np.unique(every[lo : hi - size + 1]))
        elif hi > lo:
            out.append(roller.between(sums, np.array([lo]), np.array([hi])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``BINS`` hashes for each set that is not empty (zeros for the others)."""
    sizes = [len(s) for s in sets]
    values = np.concatenate([*sets, np.empty(0, np.uint64)])
    row = np.repeat(np.arange(len(sets)), sizes)
    place = row * BINS + ((values >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    bins = np.zeros(len(sets) * BINS, np.uint64)
    full = np.zeros(len(sets) * BINS, bool)
    bins[place[new]], full[place[new]] = values[new], True
    empty = np.flatnonzero(~full & np.repeat(np.array(sizes, bool), BINS))
    attempt = 0
    while len(empty):
        attempt += 1
        bin_number = empty % BINS
        choice = mix((bin_number + BINS * attempt).astype(np.uint64) * np.uint64(_BASE)) % np.uint64(BINS)
        source = empty - bin_number + choice.astype(np.int64)
        found = full[source]
        bins[empty[found]] = bins[source[found]]
        empty = empty[~found]
    return bins.reshape(len(sets), BINS)


def band_keys(bins: np.ndarray) -> np.ndarray:
    """One bucket key for each band of each signature."""
    keys = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(bins), BANDS)).copy()
    parts = bins.reshape(len(bins), BANDS, ROWS)
    for k in range(ROWS):
        keys = mix(keys * np.uint64(_BASE) + parts[:, :, k])
    return keys.view(np.int64)


def _survey(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, roller = WordHasher(is_space(), fold=True), Rolling(_BASE)
        for batch in batches:
            for block in hasher.texts(batch["text"]):
                sets = shingle_sets(block, roller, size)
                bins = signatures(sets)
                keys = band_keys(bins)
                whole = np.array([(s.sum(dtype=np.uint64), mix(s ^ np.uint64(_BASE)).sum(dtype=np.uint64)) for s in sets], np.uint64)
                ends = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS)
                part = batch.slice(block.first, block.last - block.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array([len(s) for s in sets], pa.int64()),
                        *(pa.array(whole.reshape(-1, 2)[:, k].copy().view(np.int64)) for k in (0, 1)),
                        pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1))),
                    ],
                    names=["doc_id", "n_shingles", "one", "two", "bands"],
                )

    return run


def _confirmed(size: int, percent: int):
    """Pairs (a, b) that reach the threshold, of rows sorted so that a group's centre ``a`` comes before its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, roller = WordHasher(is_space(), fold=True), Rolling(_BASE)
        group, centres = None, []
        for batch in batches:
            for block in hasher.texts(batch["text"]):
                sets = shingle_sets(block, roller, size)
                part = batch.slice(block.first, block.last - block.first)
                a, b, found = part["a"].to_pylist(), part["b"].to_pylist(), []
                for k, key in enumerate(zip(a, part["salt"].to_pylist(), strict=True)):
                    if key != group:
                        group, centres = key, []
                    if a[k] == b[k]:
                        centres.append(sets[k])
                    elif any(_similar(c, sets[k], percent) for c in centres):
                        found.append(k)
                yield part.take(pa.array(found, pa.int64())).select(["a", "b"])

    return run


def _similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    if len(one) > len(other):
        one, other = other, one
    if not len(one) or 100 * len(one) < percent * len(other):
        return False
    common = int((other[np.minimum(np.searchsorted(other, one), len(other) - 1)] == one).sum())
    return 100 * common >= percent * (len(one) + len(other) - common)


def placed(source: DataFrame, pairs: DataFrame) -> DataFrame:
    """The documents of the distinct ``pairs`` (a, b) with their texts and the groups in which they are compared.

    A centre ``a`` with many partners gets several groups, each of about ``GROUP`` of them.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("groups")).select(apart("a").alias("key"), "groups")
    dealt = pairs.withColumn("key", apart("a")).join(counts, "key")
    dealt = dealt.select("a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).alias("salt"))
    members = dealt.select(F.col("b").alias("doc_id"), "a", "salt")
    centres = dealt.select(F.col("a").alias("doc_id"), "a", "salt").distinct()
    places = members.unionByName(centres).groupBy("doc_id").agg(F.collect_list(F.struct("a", "salt")).alias("places"))
    return source.join(places, "doc_id").select("doc_id", "text", "places")


def confirm(texts: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Those pairs of :func:`placed` whose full sets reach the threshold."""
    each = texts.select("doc_id", "text", F.explode("places").alias("place"))
    sent = each.select("place.a", "place.salt", F.col("doc_id").alias("b"), "text").repartition("a", "salt")
    rows = sent.sortWithinPartitions("a", "salt", F.col("a") != F.col("b"))
    return rows.mapInArrow(_confirmed(size, percent), "a bigint, b bigint").distinct()


def _compared(size: int, percent: int):
    """Links between open members and others of the same group, one for two components.

    Rows are sorted by group, the open members first; a group has about ``BLOCK`` rows of either kind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, roller = WordHasher(is_space(), fold=True), Rolling(_BASE)
        group, opened = None, _Opened()
        for batch in batches:
            for block in hasher.texts(batch["text"]):
                sets = shingle_sets(block, roller, size)
                bins = signatures(sets)
                keys = band_keys(bins)
                part = batch.slice(block.first, block.last - block.first)
                columns = [part[c].to_pylist() for c in ("band", "i", "j", "is_open", "doc_id", "component")]
                a, b = [], []
                for k, (band, i, j, is_open, doc, component) in enumerate(zip(*columns, strict=True)):
                    if (band, i, j) != group:
                        group, opened = (band, i, j), _Opened()
                    # All texts of a document come; those that brought it into the bucket meet.
                    if band not in keys[k]:
                        continue
                    if is_open:
                        opened.add(sets[k], bins[k], keys[k], doc, component)
                        continue
                    for other in opened.linked(sets[k], bins[k], keys[k], component, band, percent):
                        a.append(min(doc, other))
                        b.append(max(doc, other))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


class _Opened:
    """The open members of one group, and which components the group has linked so far."""

    def __init__(self) -> None:
        self.members: list[tuple] = []
        self.bins = self.keys = None
        self.parent: dict[int, int] = {}

    def add(self, members: np.ndarray, bins: np.ndarray, keys: np.ndarray, doc: int, component: int) -> None:
        self.members.append((members, bins, keys, doc, component))
        self.bins = None

    def _root(self, x: int) -> int:
        while self.parent.get(x, x) != x:
            x = self.parent[x]
        return x

    def linked(self, members: np.ndarray, bins: np.ndarray, keys: np.ndarray, component: int, band: int, percent: int) -> Iterator[int]:
        if not self.members:
            return
        if self.bins is None:
            self.bins, self.keys = (np.stack([m[k] for m in self.members]) for k in (1, 2))
        likely = np.flatnonzero((self.bins == bins).sum(axis=1) >= LEAST_AGREEMENT)
        for k in likely[np.argmax(self.keys[likely] == keys, axis=1) == np.flatnonzero(keys == band)[0]] if len(likely) else ():
            other, _, _, doc, own = self.members[k]
            one, two = self._root(component), self._root(own)
            if one != two and _similar(other, members, percent):
                self.parent[max(one, two)] = min(one, two)
                yield doc


def _missed(source: DataFrame, buckets: DataFrame, components: DataFrame, size: int, percent: int) -> DataFrame:
    """Links within buckets that join different components of the stars."""
    labels = components.withColumnRenamed("node", "doc_id")
    members = buckets.join(labels, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    totals = members.groupBy("band").agg(
        F.count("*").alias("n"), F.max(F.struct(F.col("doc_id") == F.col("centre"), "component"))["component"].alias("main")
    )
    # A bucket of two is settled by its star.
    members = members.withColumn("key", apart("band")).join(totals.where("n > 2").select(apart("band").alias("key"), "n", "main"), "key")
    opened = members.where("component <> main").groupBy("band").agg(F.count("*").alias("n_open"))
    members = members.drop("key").withColumn("key", apart("band")).join(opened.select(apart("band").alias("key"), "n_open"), "key")
    blocks, open_blocks = F.ceil(F.col("n") / BLOCK), F.ceil(F.col("n_open") / BLOCK)
    own = F.xxhash64("doc_id")
    is_open = F.col("component") != F.col("main")
    members = members.select("band", "doc_id", "component", is_open.alias("is_open"), blocks.alias("blocks"), open_blocks.alias("open_blocks"))
    columns = ["band", "doc_id", "component"]
    left = members.where("is_open").select(
        *columns, F.pmod(own, "open_blocks").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(True).alias("is_open")
    )
    right = members.select(
        *columns, F.explode(F.sequence(F.lit(0), F.col("open_blocks") - 1)).alias("i"), F.pmod(own, "blocks").alias("j"), F.lit(False).alias("is_open")
    )
    lists = left.unionByName(right).groupBy("doc_id").agg(F.collect_list(F.struct("band", "i", "j", "is_open", "component")).alias("places"))
    lists = store(lists, "minhash-open")
    if lists.isEmpty():
        return source.sparkSession.createDataFrame([], "a bigint, b bigint")
    texts = source.join(lists, "doc_id").select("doc_id", "text", F.explode("places").alias("place"))
    placed = texts.select("place.*", "doc_id", "text").repartition("band", "i", "j")
    rows = placed.sortWithinPartitions("band", "i", "j", F.desc("is_open"))
    return rows.mapInArrow(_compared(size, percent), "a bigint, b bigint").where("a < b").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row.

    NULL and empty texts have no shingles and link with nothing. A row without an id stays alone: no component, kept. Rows that
    share an id are one document, linked by what any of them is similar to.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id bigint, n_shingles bigint, one bigint, two bigint, bands array<bigint>"
    survey = store(source.mapInArrow(_survey(size), schema), "minhash-survey")
    some = survey.where("n_shingles > 0 and doc_id is not null")
    keys = ["one", "two", "n_shingles"]
    firsts = some.groupBy(*keys).agg(F.min("doc_id").alias("first"))
    firsts = firsts.select(apart("one").alias("key"), "two", "n_shingles", "first")
    copies = store(some.select(apart("one").alias("key"), "two", "n_shingles", "doc_id").join(firsts, ["key", "two", "n_shingles"]).select("doc_id", "first").distinct(), "minhash-copies")
    nodes = copies.where("doc_id = first").select("doc_id").distinct()

    members = some.join(nodes, "doc_id").select("doc_id", F.explode("bands").alias("band"))
    stars = members.groupBy("band").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last")).where("centre < last")
    stars = stars.select(apart("band").alias("key"), "centre")
    buckets = store(members.withColumn("key", apart("band")).join(stars, "key").select("band", "doc_id", "centre").distinct(), "minhash-buckets")
    pairs = store(buckets.where("doc_id > centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct(), "minhash-pairs")
    # Of all texts only these are needed from here on; every member of a bucket is in some pair.
    texts = store(placed(source, pairs), "minhash-texts")
    links = store(confirm(texts, size, percent), "minhash-links")
    components = store(connected(links, "minhash-stars"), "minhash-stars")

    links = links.unionByName(_missed(texts.select("doc_id", "text"), buckets, components, size, percent))
    same = copies.where("doc_id > first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    components = connected(links.unionByName(same), "minhash")
    labelled = survey.select("doc_id", "n_shingles").join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return labelled.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = STAGE_SHINGLE) -> DataFrame:
    """``docs`` with one document, the one of the smallest id, of each group of near duplicates by shingles of ``size`` words."""
    gone = near_duplicates(docs, text, doc_id, size).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(f"`{doc_id}`").cast("long") == F.col("__gone"), "left_anti")
