"""Hard negatives of anchors, by shared candidate lists with certified ends.

Every anchor looks for the candidates of the largest inner product. Anchors are gathered in clusters around few centres. For a cluster
whose members lie within an angle t of its centre, no member's product with a candidate x at angle a from the centre can exceed
``|anchor| * |x| * cos(max(0, a - t))``. So the candidates are sorted once for each cluster by ``|x| * cos(max(0, a - t))``, and all
members walk this one list, best bounds first, each until its own results so far beat everything that the bounds leave open. What a
walk returns is therefore exact.

Candidates are dealt into cells of about ``CELL_ROWS`` rows, whatever their labels, ids or copies; a cell lies in memory once, and the
anchors stream past it in chunks, cluster by cluster. Vectors of candidates are shuffled once for each of two passes: the first finds
each anchor's best rows of its own label, the second the best ones of other labels whose product lies within a share of those. Cells
report at most ``k`` rows for each anchor (and positive), which a window puts together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctrprep.sources.scratch import store

#: Candidates that are in memory together, and anchors that walk together.
CELL_ROWS, CHUNK = 65_536, 1_024
#: Small tables have so many cells of this size, so that several tasks share the work.
FEWEST_CELLS, LEAST_CELL = 8, 1_024
#: The most centres, and the anchors of the sample that they are fitted to. Both decide the speed only.
CENTRES, CENTRE_SAMPLE, CENTRE_ROUNDS = 64, 4_096, 6
#: Candidates looked at in the first step of a walk; each further step doubles it.
FIRST_STEP, LONGEST_STEP = 256, 4_096
#: Products below it are exact in double precision.
_EXACT = 1 << 53
_LIMIT = 1 << 63
POSITIVES, NEGATIVES, SCALE = 5, 10, 256
#: A negative's product, in hundredths of its positive's.
LEAST_SHARE, MOST_SHARE = 30, 90
_NO_ID = np.iinfo(np.int64).max


def quantised(vectors: DataFrame, vec_id: str, embedding: str, label: Column, anchor: Column, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label``, ``anchor``, the vector of whole numbers ``q`` and a number ``row`` that tells rows of one id apart.

    Rows without a label or vector, or with a NULL or non-finite component, are left out; equal rows are one. Components beyond
    2**52 are cut off there.
    """
    usable = F.col(f"`{embedding}`").isNotNull() & ~F.exists(
        F.col(f"`{embedding}`"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    near = lambda x: F.least(F.greatest(F.floor(x.cast("double") * scale), F.lit(-(1 << 52))), F.lit(1 << 52)).cast("long")
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(F.col(f"`{embedding}`"), near).alias("q"),
    )
    rows = store(rows.where("label is not null").withColumn("row", F.xxhash64("label", "q")), "negative-rows")
    repeated = rows.groupBy("vec_id", "row").agg(F.count("*").alias("n")).where("n > 1")
    repeated = store(repeated.select(F.struct("vec_id", "row").alias("__same")), "negative-repeats")
    if repeated.isEmpty():
        return rows
    same = F.struct("vec_id", "row") == F.col("__same")
    single = rows.join(repeated, same, "left_anti")
    # Copies are taken together within tasks before they travel.
    return store(single.unionByName(rows.join(repeated, same, "left_semi").dropDuplicates(["vec_id", "row"])), "negative-rows")


# --- centres ----------------------------------------------------------------------------------------------------------------------


def fit_centres(sample: np.ndarray, most: int = CENTRES) -> np.ndarray:
    """Directions around which the sampled anchors lie, by a few rounds of spherical k-means from evenly chosen first ones."""
    size = np.linalg.norm(sample, axis=1)
    unit = sample[size > 0] / size[size > 0, None]
    k = min(most, max(1, int(math.sqrt(len(unit)))))
    if not len(unit):
        return np.zeros((1, sample.shape[1]))
    centres = unit[np.linspace(0, len(unit) - 1, k).astype(int)]
    for _ in range(CENTRE_ROUNDS):
        own = (unit @ centres.T).argmax(axis=1)
        for c in range(k):
            members = unit[own == c]
            if len(members):
                total = members.sum(axis=0)
                length = np.linalg.norm(total)
                if length > 0:
                    centres[c] = total / length
    return centres


def _centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """Centres for each length of vector, from a bounded sample of the anchors."""
    chosen = rows.where("anchor").orderBy(F.xxhash64("vec_id", "row", F.lit(11)), "row").limit(CENTRE_SAMPLE).select("q").collect()
    by_size: dict[int, list] = {}
    for r in chosen:
        by_size.setdefault(len(r["q"]), []).append(r["q"])
    return {size: fit_centres(np.array(v, float).reshape(len(v), size)) for size, v in by_size.items()}


def _clustered(centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["q"]
            sizes = np.diff(lists.offsets.to_numpy())
            out = np.zeros(batch.num_rows, np.int32)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            start = np.cumsum(sizes) - sizes
            for size in np.unique(sizes):
                if size and size in centres:
                    at = np.flatnonzero(sizes == size)
                    out[at] = (flat[start[at][:, None] + np.arange(size)].astype(float) @ centres[size].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "cluster"])

    return run


# --- walks ------------------------------------------------------------------------------------------------------------------------


class Cell:
    """Candidates of one length in memory, in the order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, body: np.ndarray) -> None:
        order = np.lexsort((rows, ids))
        self.ids, self.labels, self.rows, self.body = ids[order], labels[order], rows[order], body[order]
        self.real = self.body.astype(float)
        self.size = np.sqrt((self.real * self.real).sum(axis=1))
        self.most = int(np.abs(body).max(initial=0))

    def shared_list(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidates in the order of their bounds for these members, and the bounds, for members of length 1.

        The members' own middle and widest angle take the place of the centre's, which brings the bounds closer.
        """
        lengths = np.linalg.norm(members, axis=1)
        unit = members[lengths > 0] / lengths[lengths > 0, None]
        middle = unit.sum(axis=0)
        if not len(unit) or not np.linalg.norm(middle) > 0:
            bounds = self.size
        else:
            middle = middle / np.linalg.norm(middle)
            widest = math.acos(float(np.clip((unit @ middle).min(), -1, 1))) + 1e-7
            cosine = np.divide(self.real @ middle, self.size, out=np.ones(len(self.size)), where=self.size > 0)
            angle = np.arccos(np.clip(cosine, -1, 1))
            bounds = self.size * np.cos(np.clip(angle - widest, 0, math.pi))
        order = np.argsort(-bounds, kind="stable")
        # A little more than computed, so that rounding never ends a walk too early.
        return order, bounds[order] + 1e-9 * self.size[order] + 1e-9

    def products(self, candidates: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Whole products of members with the candidates at these places."""
        if self.most * int(np.abs(members).max(initial=0)) * max(1, members.shape[1]) < _EXACT:
            return np.rint(members.astype(float) @ self.real[candidates].T).astype(np.int64)
        exact = members.astype(object) @ self.body[candidates].T.astype(object)
        return np.clip(exact, -_LIMIT, _LIMIT - 1).astype(np.int64)


class Best:
    """The ``k`` best candidates of each of ``n`` searches: larger products first, then smaller ids."""

    def __init__(self, n: int, k: int) -> None:
        self.n, self.k = n, k
        self.search, self.score, self.place = (np.empty(0, np.int64) for _ in range(3))
        self.least = np.full(n, np.iinfo(np.int64).min)

    def add(self, search: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        """Places follow the ids, so they decide among equal products."""
        if not len(search):
            return
        s, v, p = (np.concatenate(x) for x in ((self.search, search), (self.score, score), (self.place, place)))
        order = np.lexsort((p, -1 - v, s))
        s, v, p = s[order], v[order], p[order]
        first = np.searchsorted(s, np.arange(self.n))
        rank = np.arange(len(s)) - first[s]
        keep = rank < self.k
        self.search, self.score, self.place = s[keep], v[keep], p[keep]
        full = rank == self.k - 1
        self.least[s[full]] = v[full]


def walk(cell: Cell, members: np.ndarray, k: int, searches: np.ndarray, wanted) -> Best:
    """The ``k`` best candidates of each search. ``searches`` has the member of each search; ``wanted(searches, places, products)``
    tells which candidates a search takes, and the least product that it can take at all is ``wanted.least``.

    A search ends when the best product that the rest of the list allows is smaller than its ``k``-th so far, or than it can take.
    """
    best = Best(len(searches), k)
    order, bounds = cell.shared_list(members.astype(float))
    length = np.linalg.norm(members.astype(float), axis=1) * (1 + 1e-12)
    open_, at, step = np.arange(len(searches)), 0, FIRST_STEP
    while at < len(order) and len(open_):
        limit = bounds[at] * length[searches[open_]] + 1e-6
        open_ = open_[limit >= np.maximum(best.least[open_].astype(float), wanted.least[open_].astype(float))]
        if not len(open_):
            break
        places = order[at : at + step]
        own, back = np.unique(searches[open_], return_inverse=True)
        products = cell.products(places, members[own])
        for lo in range(0, len(open_), max(1, (1 << 22) // len(places))):
            part = open_[lo : lo + max(1, (1 << 22) // len(places))]
            values = products[back[lo : lo + len(part)]]
            fits = wanted(part, places, values) & (values >= best.least[part][:, None])
            r, c = np.nonzero(fits)
            best.add(part[r], values[r, c], places[c])
        at += step
        step = min(2 * step, LONGEST_STEP)
    return best


class _SameLabel:
    def __init__(self, cell: Cell, labels: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        self.cell, self.labels, self.ids, self.rows = cell, labels, ids, rows
        self.least = np.full(len(labels), np.iinfo(np.int64).min)

    def __call__(self, search: np.ndarray, places: np.ndarray, products: np.ndarray) -> np.ndarray:
        same = self.cell.labels[places][None, :] == self.labels[search][:, None]
        own = self.cell.rows[places][None, :] == self.rows[search][:, None]
        return same & ~(own & (self.cell.ids[places][None, :] == self.ids[search][:, None]))


class _OtherLabel:
    """Candidates of other labels within a share of the positive's product, without overflow of the comparison."""

    def __init__(self, cell: Cell, labels: np.ndarray, positive: Sequence[int]) -> None:
        self.cell, self.labels = cell, labels
        exact = [int(p) for p in positive]
        self.least = np.array([-((-LEAST_SHARE * p) // 100) for p in exact], np.int64)
        self.most = np.array([(MOST_SHARE * p) // 100 for p in exact], np.int64)
        self.least[self.least > self.most] = np.iinfo(np.int64).max

    def __call__(self, search: np.ndarray, places: np.ndarray, products: np.ndarray) -> np.ndarray:
        other = self.cell.labels[places][None, :] != self.labels[search][:, None]
        return other & (products >= self.least[search][:, None]) & (products <= self.most[search][:, None])


_HIT = "anchor_row bigint, anchor_id bigint, positive_row bigint, positive_id bigint, positive_score bigint, id bigint, row bigint, score bigint"
_HIT_NAMES = ["anchor_row", "anchor_id", "positive_row", "positive_id", "positive_score", "id", "row", "score"]


def _matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of list in the column, the rows that have it and their values."""
    sizes = np.diff(column.offsets.to_numpy())
    start = np.cumsum(sizes) - sizes
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        out[int(size)] = at, flat[start[at][:, None] + np.arange(size)].reshape(len(at), size)
    return out


def _numbers(column: pa.Array, missing: int) -> np.ndarray:
    return column.fill_null(missing).to_numpy(zero_copy_only=False).astype(np.int64)


def _searched(positives: bool):
    """Candidates of a cell come first, then the anchors, a cluster after the other."""

    def search(cells: dict[int, Cell], chunk: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, rows, labels = chunk["vec_id"], _numbers(chunk["row"], 0), _numbers(chunk["label"], 0)
        for size, (at, body) in _matrix(chunk["q"]).items():
            cell = cells.get(size)
            if cell is None:
                continue
            if positives:
                owner, wanted, pairs = np.arange(len(at)), _SameLabel(cell, labels[at], _numbers(ids, _NO_ID)[at], rows[at]), None
            else:
                lists = chunk["positives"].take(pa.array(at))
                pairs = lists.flatten()
                owner = np.repeat(np.arange(len(at)), np.diff(lists.offsets.to_numpy()))
                wanted = _OtherLabel(cell, labels[at][owner], pairs.field("score").to_pylist())
            best = walk(cell, body, POSITIVES if positives else NEGATIVES, owner, wanted)
            if not len(best.search):
                continue
            anchor = pa.array(at[owner[best.search]])
            nothing = pa.nulls(len(best.search), pa.int64())
            taken = [pairs.field(f).take(pa.array(best.search)) for f in ("row", "id", "score")] if pairs is not None else [nothing] * 3
            found = cell.ids[best.place]
            arrays = [
                chunk["row"].take(anchor), ids.take(anchor), *taken,
                pa.array(found, mask=found == _NO_ID), pa.array(cell.rows[best.place]), pa.array(best.score),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=_HIT_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[int, Cell] = {}
        held: list[pa.RecordBatch] = []
        now: tuple = ()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal cells
            if not held:
                return
            chunk = pa.concat_batches(held)
            held.clear()
            if now[1]:
                yield from search(cells, chunk)
                return
            ids, labels, rows = _numbers(chunk["vec_id"], _NO_ID), _numbers(chunk["label"], 0), _numbers(chunk["row"], 0)
            cells = {size: Cell(ids[at], labels[at], rows[at], body) for size, (at, body) in _matrix(chunk["q"]).items()}

        for batch in batches:
            keys = np.column_stack([_numbers(batch[c].cast(pa.int64()), 0) for c in ("cell", "asks", "cluster")])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                key = tuple(keys[lo].tolist())
                if key != now or (key[1] and sum(b.num_rows for b in held) >= CHUNK):
                    yield from flush()
                    if now[:1] != key[:1]:
                        cells = {}
                    now = key
                held.append(batch.slice(lo, hi - lo))
        yield from flush()

    return run


def _pass(candidates: DataFrame, anchors: DataFrame, cells: int, positives: bool) -> DataFrame:
    """The best candidates of every cell for every anchor. Anchors, a stated share of the rows, are copied to each cell; candidates
    are in one cell each."""
    cell = F.pmod(F.xxhash64("vec_id", "row", F.lit(29)), F.lit(cells)).cast("int")
    own = candidates.select(cell.alias("cell"), F.lit(0).alias("asks"), F.lit(0).alias("cluster"), "vec_id", "label", "row", "q")
    asking = anchors.withColumns({"cell": F.explode(F.sequence(F.lit(0), F.lit(cells - 1))), "asks": F.lit(1)})
    both = own.unionByName(asking, allowMissingColumns=True)
    names = ["cell", "asks", "cluster", "vec_id", "label", "row", "q", *([] if positives else ["positives"])]
    dealt = both.select(*names).repartition(2 * cells, "cell").sortWithinPartitions("cell", "asks", "cluster", "row")
    return dealt.mapInArrow(_searched(positives), _HIT)


def _first(hits: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` hits of each search with their rank."""
    window = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return hits.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchor: Column, label: Column, embedding: str = "embedding", vec_id: str = "vec_id", cell_rows: int = CELL_ROWS
) -> DataFrame:
    """For each anchor row and each of its ``POSITIVES`` best rows of the same label, the ``NEGATIVES`` best rows of other labels whose
    product is from ``LEAST_SHARE`` to ``MOST_SHARE`` hundredths of the positive's.

    ``anchor`` and ``label`` are expressions over ``vectors``. Products are those of the vectors times ``SCALE``, rounded down to whole
    numbers; larger ones come first, then smaller ids (rows without an id last). Rows without a label or vector or with a NULL or
    non-finite component take no part; equal rows are one row, different rows of one id are rows of their own. Vectors of different
    lengths do not meet. A product outside the range of a long is the nearest long.
    """
    source = vectors.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").alias("embedding"), label.alias("label"), anchor.alias("anchor")
    )
    rows = quantised(source, "vec_id", "embedding", F.col("label"), F.col("anchor"))
    n = rows.count()
    cells = max(1, math.ceil(n / cell_rows), min(FEWEST_CELLS, n // LEAST_CELL))
    schema = "vec_id bigint, label bigint, row bigint, q array<bigint>, cluster int"
    anchors = rows.where("anchor").select("vec_id", "label", "row", "q").mapInArrow(_clustered(_centres(rows)), schema)
    anchors = store(anchors, "negative-anchors")
    candidates = rows.select("vec_id", "label", "row", "q")

    near = _first(_pass(candidates, anchors, cells, True), ["anchor_id", "anchor_row"], POSITIVES)
    listed = near.groupBy("anchor_id", "anchor_row").agg(F.collect_list(F.struct("row", "id", "score")).alias("positives"))
    listed = listed.select(F.struct("anchor_id", "anchor_row").alias("__asker"), "positives")
    asking = anchors.join(listed, F.struct(F.col("vec_id").alias("anchor_id"), F.col("row").alias("anchor_row")) == F.col("__asker"))
    asking = store(asking.drop("__asker"), "negative-positives")
    by = ["anchor_id", "anchor_row", "positive_id", "positive_row"]
    found = _first(_pass(candidates, asking, cells, False), by, NEGATIVES)
    return found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
