"""The query catalogue: every operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrprep.operators import carry, crossing, featuremap, formats, lookup, sampling, sparse, stats, trees
from ctrprep.plans.runner import commit_outputs, prepare, read_run
from ctrprep.plans.spec import PrepSpec
from ctrprep.sources import model, tables, text
from ctrprep.sources.scratch import new_folder

SEED = 42
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
CONDITIONS = "l_returnflag:R:0.5 l_linestatus:O:0.3"
Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as impressions: a click is a returned item."""
    return _table(spark, folder, "lineitem").withColumns(
        {
            "label": F.when(F.col("l_returnflag") == "R", "1").otherwise("0"),
            "quantity": F.col("l_quantity").cast("bigint"),
            "discount": F.round(F.col("l_discount") * 100).cast("bigint"),
            "tax": F.round(F.col("l_tax") * 100).cast("bigint"),
        }
    )


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as impressions: a click is a purchase."""
    return _table(spark, folder, "events").withColumn(
        "label", F.when(F.col("event_type") == "purchase", "1").otherwise("0")
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").withColumns(
        {
            "label": F.when(F.col("o_orderstatus") == "F", "1").otherwise("0"),
            "order_year": F.year("o_orderdate"),
        }
    )


# --- extraction -------------------------------------------------------------


def extract_typed(spark, folder):
    columns = ["l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"]
    return tables.extract(_table(spark, folder, "lineitem"), columns, ["s", "s", "s", "f"], 100)


def extract_since(spark, folder):
    recent = tables.since(_table(spark, folder, "orders"), "1998-01-01", "o_orderdate")
    return tables.extract(recent, ["o_orderkey", "o_orderstatus", "o_totalprice"], ["s", "s", "f"], 100)


def extract_on(spark, folder):
    one_day = tables.on(_table(spark, folder, "orders"), "1998-01-15", "o_orderdate")
    return tables.extract(one_day, ["o_orderkey", "o_orderpriority"])


def _written_by_year(spark, folder) -> DataFrame:
    """Orders as a table partitioned by the year, ``dt``."""
    path = new_folder(spark, "orders-by-year")
    _table(spark, folder, "orders").withColumn("dt", F.year("o_orderdate")).write.partitionBy("dt").parquet(path)
    return tables.open_table(spark, path)


def partitions_since(spark, folder):
    """A lower bound and a fixed value of the partition column: only the partitions that can match are read."""
    orders, columns = _written_by_year(spark, folder), ["o_orderkey", "o_totalprice", "dt"]
    recent = tables.extract(tables.since(orders, "1997", "dt"), columns, ["s", "f", "s"], 100)
    return recent.unionByName(tables.extract(tables.on(orders, "1995", "dt"), columns, ["s", "f", "s"], 100))


_ORDER_FIELDS = (
    T.StructType()
    .add("o_orderkey", T.LongType())
    .add("o_custkey", T.LongType())
    .add("o_orderstatus", T.StringType())
    .add("o_totalprice", T.DoubleType())
    .add("o_orderpriority", T.StringType())
)


def _order_lines(spark, folder) -> DataFrame:
    """Orders as extracted text; every fifth has an empty last field."""
    orders = _table(spark, folder, "orders").withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.col("o_orderpriority"))
    )
    return text.to_lines(orders, _ORDER_FIELDS.fieldNames())


def delimited_parse(spark, folder):
    return text.parse_lines(_order_lines(spark, folder), _ORDER_FIELDS)


def delimited_parse_short(spark, folder):
    """Trailing empty fields dropped, so the last column is missing there."""
    wanted = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    return text.parse_lines(_order_lines(spark, folder), _ORDER_FIELDS, wanted, keep_trailing=False, short_rows="null")


def _cut_lines(spark, folder) -> DataFrame:
    """Order lines, every seventh cut after three fields."""
    orders = _table(spark, folder, "orders")
    full = text.to_lines(orders, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])
    cut = F.substring_index("value", text.EXTRACT_SEPARATOR, 3)
    number = F.substring_index("value", text.EXTRACT_SEPARATOR, 1).cast("bigint")
    return full.select(F.when(number % 7 == 0, cut).otherwise(F.col("value")).alias("value"))


_CUT_FIELDS = T.StructType([f for f in _ORDER_FIELDS if f.name != "o_totalprice"])


def reject_short_rows(spark, folder):
    return text.parse_lines(_cut_lines(spark, folder), _CUT_FIELDS, ["o_orderkey", "o_orderpriority"])


def reject_counts(spark, folder):
    return text.reject_counts(_cut_lines(spark, folder), len(_CUT_FIELDS))


def short_row_counts(spark, folder):
    """A short line still counts for the columns it has."""
    rows = text.parse_lines(_cut_lines(spark, folder), _CUT_FIELDS, short_rows="null")
    rows = rows.withColumn("label", F.when(F.col("o_orderstatus") == "F", "1").otherwise("0"))
    return stats.pv_click(rows, ["o_orderstatus", "o_orderpriority"], "label")


def partial_join(spark, folder):
    """Orders with the segment of customers in credit, and defaults for the others."""
    orders = tables.extract(_table(spark, folder, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])
    customers = _table(spark, folder, "customer").where(F.col("c_acctbal") >= 0)
    segment = customers.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return tables.attach_part(
        orders, segment, ["o_custkey"], "left", {"c_mktsegment": "none", "c_nationkey": -1}
    )


# --- sampling, noise, shuffling ----------------------------------------------

_SAMPLED = [*LINE_KEY, "l_returnflag", "l_linestatus"]


def sample_union(spark, folder):
    rows = _table(spark, folder, "lineitem").select(*_SAMPLED)
    return sampling.sample_union(rows, sampling.parse_conditions(CONDITIONS), LINE_KEY, SEED)


def sample_any(spark, folder):
    rows = _table(spark, folder, "lineitem").select(*_SAMPLED)
    shrinks = [sampling.parse_conditions(item) for item in CONDITIONS.split()]
    return sampling.sample_any(rows, shrinks, LINE_KEY, SEED)


def sample_keep_unmatched(spark, folder):
    rows = _table(spark, folder, "lineitem").select(*_SAMPLED)
    conditions = sampling.parse_conditions("l_linenumber:1:0.3 l_linenumber:2:0.6")
    return sampling.sample_keep_unmatched(rows, conditions, LINE_KEY, SEED)


def sample_mod10(spark, folder):
    rows = _table(spark, folder, "events").select("event_id", "event_type")
    return sampling.sample_residues(rows, sampling.parse_residues("0:3:7"), ["event_id"], SEED)


def noise(spark, folder):
    rows = _table(spark, folder, "events").select("event_id", "event_type")
    return sampling.add_noise(rows, "event_type", "event_type_n", "unknown", 0.1, ["event_id"], SEED)


def duplicate_positive(spark, folder):
    return sampling.duplicate_positives(_events(spark, folder).select("event_id", "user_id", "label"), "label")


def duplicate_positive_lines(spark, folder):
    lines = text.to_lines(_events(spark, folder), ["label", "event_id", "user_id"], text.SAMPLE_SEPARATOR)
    return sampling.duplicate_positive_lines(lines)


def shuffle(spark, folder):
    rows = _table(spark, folder, "lineitem").select(*LINE_KEY, "l_returnflag", "l_extendedprice")
    return sampling.shuffle_rows(rows, seed=SEED)


def shuffle_by_key(spark, folder):
    rows = _table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return sampling.shuffle_rows(rows, key=["event_id"], seed=SEED)


def train_valid_split(spark, folder):
    return sampling.with_split(_events(spark, folder).select("event_id", "label"), 20, ["event_id"], SEED)


# --- counts and feature maps --------------------------------------------------

_INDEXED = ["l_returnflag", "l_linestatus", "l_linenumber"]
_BUCKETED = [("quantity", 7), ("discount", 10)]


def vocab(spark, folder):
    return stats.vocabulary(_table(spark, folder, "lineitem"), ["l_linestatus", "l_linenumber", "l_partkey"])


def field_vocab(spark, folder):
    """Distinct values of one field of tab-delimited lines."""
    lines = text.to_lines(_table(spark, folder, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"], "\t")
    return stats.distinct_values(text.field_of_lines(lines, 1), "value", ordered=True)


def index_numbering(spark, folder):
    fmap = featuremap.build_feature_map(_lineitem(spark, folder), indexes=[*_INDEXED, "l_partkey"])
    return fmap.entries.select("name", "value", "id")


def value_numbering(spark, folder):
    return featuremap.number_values(_lineitem(spark, folder), _INDEXED, start=0)


def distinct_numbering(spark, folder):
    return featuremap.number_distinct(_table(spark, folder, "orders"), "o_custkey", start=0)


def value_frequency(spark, folder):
    return stats.value_counts(_lineitem(spark, folder), ["quantity", "discount"])


def interval_bucket(spark, folder):
    exact = featuremap.build_feature_map(_lineitem(spark, folder), intervals=_BUCKETED)
    even = replace(exact, mode=featuremap.EVEN)
    return exact.entries.withColumn("mode", F.lit("exact")).unionByName(even.entries.withColumn("mode", F.lit("even")))


def feature_map(spark, folder):
    return featuremap.build_feature_map(_lineitem(spark, folder), _BUCKETED, _INDEXED).entries


def pv_click(spark, folder):
    return stats.pv_click(_lineitem(spark, folder), ["l_linestatus", "l_linenumber", "l_suppkey"], "label")


def pv_click_events(spark, folder):
    return stats.pv_click(_events(spark, folder), ["user_id", "props"], "label")


def feature_map_stats(spark, folder):
    columns = ["l_linestatus", "l_suppkey"]
    counted = stats.pv_click(_lineitem(spark, folder), columns, "label")
    return featuremap.feature_map_with_stats(counted, columns)


def feature_cross(spark, folder):
    crossed = featuremap.cross(_table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])
    names = list(featuremap.crossed_columns(["l_returnflag", "l_linestatus", "l_linenumber"]))
    return featuremap.build_feature_map(crossed, indexes=names).entries.select("name", "value", "id")


_CROSSED = ["l_partkey", "l_suppkey", "l_linenumber"]


def frequent_crossings(spark, folder):
    """Crossings of parts, suppliers and line numbers in eight rows or more, with their clicks; rare members make none."""
    rows = _lineitem(spark, folder).select(*_CROSSED, "label")
    crossed = crossing.cross_frequent(rows, _CROSSED, least=8)
    return crossing.crossing_counts(crossed, list(featuremap.crossed_columns(_CROSSED)), 8, "label")


# --- encoding and formats -----------------------------------------------------

_MAPPED = {"l_orderkey": "order_id", "l_linenumber": "line_id"}


def _side_map(spark, folder) -> DataFrame:
    """The text map of items sold in small quantities: ``name value id pv click``."""
    rows = _lineitem(spark, folder).where(F.col("l_quantity") <= 10)
    counted = featuremap.feature_map_with_stats(stats.pv_click(rows, list(_MAPPED), "label"), list(_MAPPED))
    return text.parse_feature_map(text.to_lines(counted, ["name", "value", "id", "pv", "click"], " "))


def dict_encode_inner(spark, folder):
    rows = _table(spark, folder, "lineitem").select(*LINE_KEY)
    encoded = lookup.add_ids_from(rows, _side_map(spark, folder), _MAPPED)
    return lookup.require_ids(encoded, list(_MAPPED.values()))


def dict_lookup_left(spark, folder):
    rows = _table(spark, folder, "lineitem").select(*LINE_KEY)
    return lookup.add_ids_from(rows, _side_map(spark, folder), _MAPPED)


def shuffled_lookup(spark, folder):
    """The lookup without a byte to broadcast: rows and maps meet by shuffles."""
    rows = _table(spark, folder, "lineitem").select(*LINE_KEY)
    return lookup.add_ids_from(rows, _side_map(spark, folder), _MAPPED, 0, LINE_KEY)


def several_dictionaries(spark, folder):
    """Three columns through dictionaries of which none is broadcast: the rows are shuffled once."""
    rows, names = _lineitem(spark, folder), {"l_orderkey": "order_id", "l_partkey": "part_id", "l_suppkey": "supplier_id"}
    small = stats.pv_click(rows.where(F.col("l_quantity") <= 10), list(names), "label")
    entries = featuremap.feature_map_with_stats(small, list(names))
    wide = rows.select(*LINE_KEY, "l_extendedprice", "l_returnflag")
    return lookup.add_ids_from(wide, entries, names, 0, LINE_KEY).drop("l_returnflag")


def map_round_trip(spark, folder):
    """A map whose values hold blanks, written, read and looked up."""
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    path = new_folder(spark, "map")
    text.write_feature_map(featuremap.build_feature_map(orders, indexes=["o_orderpriority"]).entries, path)
    return lookup.add_ids_from(orders, text.read_feature_map(spark, path), {"o_orderpriority": "priority_id"})


def chained_partials(spark, folder):
    """Three parts of a row, the last with orders that have none."""
    orders = tables.extract(_table(spark, folder, "orders"), ["o_orderkey", "o_custkey"])
    customers = _table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    per_order = _table(spark, folder, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    returned = per_order.agg(F.count(F.lit(1)).alias("returned"))
    parts = [tables.Part(customers, ["o_custkey"], "full"), tables.Part(returned, ["o_orderkey"], "left", {"returned": 0})]
    return tables.attach_parts(orders, parts)


ORDER_SPEC = {
    "name": "orders",
    "partial": [{"name": "orders", "table": "orders", "columns": "label,o_orderpriority,order_year", "type": "s,s,s"}],
    "transform": [{"type": "SIMPLE_INDEX", "columns": "o_orderpriority,order_year"}],
    "format": [{"name": "samples", "pattern": "libsvm"}],
}


def libsvm(spark, folder):
    run = prepare(spark, PrepSpec.from_dict(ORDER_SPEC), {"orders": _orders(spark, folder)})
    return run.samples["samples"]


def template(spark, folder):
    rows = _lineitem(spark, folder)
    fmap = featuremap.build_feature_map(rows, indexes=["l_linestatus", "l_linenumber"])
    encoded = lookup.add_ids(rows.select(*LINE_KEY, "label", "l_linestatus"), fmap, same_rows=True)
    return formats.template(
        encoded,
        "${1} ${2}:1 ${3}:1",
        ["label", "l_linestatus_id", "l_linenumber_id"],
        {"l_linestatus_id": 0.2},
        LINE_KEY,
        SEED,
        keep=LINE_KEY,
    )


def structured_features(spark, folder):
    """Samples as arrays of ``(id, value)``, their features counted per label."""
    rows = _orders(spark, folder).select("label", "o_orderpriority", "order_year")
    fmap = featuremap.build_feature_map(rows, indexes=["o_orderpriority", "order_year"])
    ids = ["o_orderpriority_id", "order_year_id"]
    samples = formats.features(lookup.add_ids(rows, fmap), ids, "label", order_by_id=True)
    single = samples.select("label", F.posexplode("features").alias("place", "feature"))
    return single.groupBy("label", "place", "feature.id", "feature.value").agg(F.count(F.lit(1)).alias("samples"))


def recode(spark, folder):
    listed = F.concat_ws(",", "l_partkey", "l_suppkey", "l_linenumber")
    return _table(spark, folder, "lineitem").select(*LINE_KEY, formats.recode(listed, 10000).alias("ids"))


def recode_lines(spark, folder):
    rows = _lineitem(spark, folder).withColumn("ids", F.concat_ws(",", "l_partkey", "l_suppkey"))
    lines = text.to_lines(rows, ["label", "ids", "l_orderkey"], text.SAMPLE_SEPARATOR)
    return formats.recode_lines(lines, 1, 10000)


def _one_row_per_feature(vectors: DataFrame) -> DataFrame:
    # A plain explode would add a filter that computes every vector again.
    laid_out = vectors.select(*LINE_KEY, F.explode_outer("features").alias("feature", "value"))
    return laid_out.where(F.col("feature").isNotNull())


def sparse_vector(spark, folder):
    """Sparse text whose feature 0 comes twice, parsed and laid out again."""
    rows = _lineitem(spark, folder)
    vector = F.concat_ws(
        ",",
        F.concat(F.lit("0:"), F.col("tax")),
        F.concat(F.lit("1:"), F.col("discount")),
        F.concat(F.lit("0:"), F.col("quantity")),
    )
    return _one_row_per_feature(rows.select(*LINE_KEY, sparse.parse_sparse(vector).alias("features")))


def sparse_fill(spark, folder):
    """Line number as a feature of its own, quantity as feature 9."""
    rows = _lineitem(spark, folder)
    inputs = trees.parse_inputs("l_linenumber:1,9:quantity", rows.columns)
    return _one_row_per_feature(rows.select(*LINE_KEY, sparse.sparse_vector(inputs).alias("features")))


# --- trees ----------------------------------------------------------------------


def leaf_numbering(spark, folder):
    """One small tree per supplier, written and parsed as model text; suppliers
    with an even key split twice."""
    supplier = _table(spark, folder, "supplier")
    key, balance = F.col("s_suppkey").cast("string"), F.floor("s_acctbal").cast("string")
    root = F.concat(F.lit("node_0=1,2,null,4,"), balance, F.lit(",0,,0"))
    leaf = F.lit("=-1,-1,0.0,-1,0,0,,0.1")
    split = F.array(
        F.lit("node_2=3,4,null,6,5.5,0,,0"), F.concat(F.lit("node_3"), leaf), F.concat(F.lit("node_4"), leaf)
    )
    plain = F.array(F.concat(F.lit("node_2"), leaf))
    body = F.concat(
        F.array(F.concat(key, F.lit("]")), root, F.concat(F.lit("node_1"), leaf)),
        F.when(F.col("s_suppkey") % 2 == 0, split).otherwise(plain),
    )
    sections = supplier.select(F.col("s_suppkey").alias("section"), F.array_join(body, "\n").alias("value"))
    numbered = trees.number_leaves(model.parse_model(sections), 1000)
    return numbered.select("tree", "node", "left", "right", "feature", "threshold", "leaf_id")


def nation_model(spark: SparkSession, folder: str) -> DataFrame:
    """A tree of depth two per nation, its thresholds taken from the nation."""
    n = F.col("n_nationkey")

    def inner(node, left, right, feature, threshold):
        return F.struct(
            F.lit(node).alias("node"),
            F.lit(left).alias("left"),
            F.lit(right).alias("right"),
            feature.cast("int").alias("feature"),
            threshold.cast("float").alias("threshold"),
        )

    def leaf(node):
        return inner(node, -1, -1, F.lit(-1), F.lit(0))

    nodes = F.array(
        inner(0, 1, 2, n % 3, n % 8 + 0.5),
        inner(1, 3, 4, (n + 1) % 3, n % 5 + 0.5),
        inner(2, 5, 6, (n + 2) % 3, n % 7 + 1.5),
        *[leaf(k) for k in range(3, 7)],
    )
    exploded = _table(spark, folder, "nation").select(n.alias("tree"), F.posexplode(nodes).alias("line", "entry"))
    return exploded.select(F.col("tree").alias("section"), "line", "tree", "entry.*")


def _leaves(spark, folder, keep) -> DataFrame:
    rows = _lineitem(spark, folder)
    inputs = trees.parse_inputs("0:quantity,1:discount,2:tax", rows.columns)
    numbered = trees.number_leaves(nation_model(spark, folder), 1000)
    return trees.encode_leaves(rows.select(*keep, "quantity", "discount", "tax"), numbered, inputs)


def leaf_encode(spark, folder):
    return _leaves(spark, folder, LINE_KEY).select(*LINE_KEY, F.array_join("leaves", ",").alias("leaves"))


def leaf_columns(spark, folder):
    """One column per tree, counted per combination of all trees."""
    names = trees.output_names("leaf%d", 25)
    wide = trees.leaf_columns(_leaves(spark, folder, []), names)
    return wide.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"))


def _model_text(spark, folder) -> DataFrame:
    """Four trees of depth six over seven features for each nation, as a model file's sections."""
    nation = F.col("n_nationkey")
    tree = _table(spark, folder, "nation").select(F.explode(F.sequence(nation * 4, nation * 4 + 3)).alias("tree"))

    def line(node):
        split = F.concat_ws(
            ",",
            node * 2 + 1,
            node * 2 + 2,
            F.lit("null"),
            (F.col("tree") + node) % 7,
            F.concat((F.col("tree") * 31 + node * 17) % 50, F.lit(".5")),
            F.lit("0"),
            F.lit(""),
            F.lit("0"),
        )
        entry = F.when(node < 63, split).otherwise(F.lit("-1,-1,0.0,-1,0,0,,0.1"))
        return F.concat(F.lit("node_"), node, F.lit("="), entry)

    lines = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(126)), line), "\n")
    sections = F.concat(F.lit("[tree_"), "tree", F.lit("]\n"), lines)
    # One small file, in which the trees stand in order.
    return tree.repartitionByRange(1, "tree").sortWithinPartitions("tree").select(sections.alias("value"))


def _written_model(spark, folder):
    """A model of a hundred trees, written and read back, with rows for it and its inputs."""
    path = new_folder(spark, "model-file")
    text.write_lines(_model_text(spark, folder), path)
    numbered = trees.number_leaves(model.read_model(spark, path), 1000)
    rows = _lineitem(spark, folder).withColumns({f"m{k}": F.col(c) % 50 for k, c in enumerate(["l_partkey", "l_suppkey", "l_orderkey"])})
    inputs = trees.parse_inputs("0:quantity,1:discount,2:tax,3:l_linenumber,4:m0,5:m1,6:m2", rows.columns)
    return rows.select(*LINE_KEY, "quantity", "discount", "tax", "m0", "m1", "m2"), numbered, inputs


def model_file(spark, folder):
    """All line items walked through a model that is sent to the tasks."""
    leaves = trees.encode_leaves(*_written_model(spark, folder))
    return leaves.select(*LINE_KEY, F.md5(F.array_join("leaves", ",")).alias("leaves"))


def model_exchange(spark, folder):
    """The same for a model that stays a table: four groups of trees, which the rows meet by an exchange."""
    leaves = trees.exchange_leaves(*_written_model(spark, folder), group_nodes=25 * 127)
    return leaves.select(*LINE_KEY, F.md5(F.array_join("leaves", ",")).alias("leaves"))


def dense_walk(spark, folder):
    """Features in one array, indexed by their number."""
    rows = _lineitem(spark, folder).withColumn("features", F.array("quantity", "discount", "tax"))
    numbered = trees.number_leaves(nation_model(spark, folder), 1001)
    leaves = trees.encode_vector(rows.select(*LINE_KEY, "features"), numbered, "features")
    return leaves.select(*LINE_KEY, F.array_join("leaves", ",").alias("leaves"))


def sparse_walk(spark, folder):
    """Features in sparse text, zeros left out."""
    rows = _lineitem(spark, folder)
    shown = [
        F.when(F.col(name) != 0, F.concat(F.lit(f"{k}:"), F.col(name)))
        for k, name in enumerate(["quantity", "discount", "tax"])
    ]
    vectors = rows.select(*LINE_KEY, sparse.parse_any(F.concat_ws(",", *shown)).alias("features"))
    leaves = trees.encode_vector(vectors, trees.number_leaves(nation_model(spark, folder), 1000), "features")
    return leaves.select(*LINE_KEY, F.array_join("leaves", ",").alias("leaves"))


def leaf_encode_sparse(spark, folder):
    """The line number names the feature that is set; all others are absent."""
    rows = _lineitem(spark, folder).withColumn("chosen", F.col("l_linenumber") % 3)
    inputs = trees.parse_inputs("chosen:3", rows.columns)
    numbered = trees.number_leaves(nation_model(spark, folder), 1000)
    leaves = trees.encode_leaves(rows.select(*LINE_KEY, "chosen"), numbered, inputs)
    return leaves.select(*LINE_KEY, F.array_join("leaves", ",").alias("leaves"))


# --- whole runs -------------------------------------------------------------------

RUN_SPEC = {
    "name": "line_items",
    "key": LINE_KEY,
    "partial": [
        {
            "name": "impressions",
            "table": "impressions",
            "columns": ["label", "l_linestatus", "l_linenumber", "l_extendedprice", "l_orderkey", "l_partkey", "l_suppkey"],
            "type": "s,s,s,f,s,s,s",
            "convert": "100",
            "dtfrom": "1993-01-01",
            "dt_column": "l_shipdate",
        }
    ],
    "shrink": [{"name": "sample", "args": "l_linenumber:1:0.7 l_linenumber:2:0.2"}],
    "transform": [
        {"type": "INTERVAL_INDEX", "args": "700:10000", "columns": "l_extendedprice"},
        {"type": "SIMPLE_INDEX", "columns": "l_linestatus,l_linenumber"},
    ],
    "format": [{"name": "samples", "pattern": "libsvm"}],
}


def _run(spark, folder):
    return prepare(spark, PrepSpec.from_dict(RUN_SPEC), {"impressions": _lineitem(spark, folder)})


def full_run(spark, folder):
    return _run(spark, folder).samples["samples"]


def full_run_map(spark, folder):
    return _run(spark, folder).feature_map.entries


TEMPLATE_SPEC = {
    "name": "line_items_templated",
    "key": LINE_KEY,
    "sample_mode": "keep_unmatched",
    "missing_rows": "drop",
    "partial": [
        {
            "name": "impressions",
            "table": "impressions",
            "columns": ["label", *LINE_KEY, "l_returnflag", "quantity", "discount", "tax"],
            "type": "s,s,s,s,s,s,s,s,s",
        }
    ],
    "shrink": [{"name": "sample", "args": "l_linenumber:1:0.3 l_linenumber:2:0.6"}],
    "noise": [{"columns": "l_suppkey", "to": "supplier_n", "value": "unknown", "factor": "0.1"}],
    "transform": [{"type": "SIMPLE_INDEX", "columns": "supplier_n,l_linenumber", "to": "supplier_id,line_id"}],
    "filter": [
        {
            "name": "gbdt",
            "inputs": "0:quantity,1:discount,2:tax",
            "outputs": "leaf%d",
            "output_num": 25,
            "args": "nation_model",
            "offset": 100000,
        }
    ],
    "format": [
        {
            "name": "samples",
            "pattern": "${1} ${2}:1 ${3}:1 ${4}:1 ${5}:1",
            "columns": "label,supplier_id,line_id,leaf0,leaf24",
            "random_column": "line_id",
            "random_ratio": "0.2",
            "sample_index": "0:1:2:3:4",
            "shuffle": True,
            "duplicate_positives": True,
        }
    ],
}


def template_run(spark, folder):
    run = prepare(
        spark,
        PrepSpec.from_dict(TEMPLATE_SPEC),
        {"impressions": _lineitem(spark, folder)},
        {"nation_model": nation_model(spark, folder)},
    )
    return run.samples["samples"]


GIVEN_SPEC = {
    "name": "orders_by_given_map",
    "partial": [{"name": "orders", "table": "orders", "columns": "label,o_orderkey,o_custkey,o_orderpriority", "type": "s,s,s,s"}],
    "transform": [{"type": "SIMPLE_INDEX", "columns": "o_custkey,o_orderpriority", "label": "label"}],
    "format": [
        {"name": "ids", "pattern": "libsvm", "on_missing": "null"},
        {"name": "pairs", "pattern": "${1} ${2}:1", "columns": "o_orderkey,o_custkey_id"},
    ],
}


def crossed_map_run(spark, folder):
    """A run whose crossings get their ids from a map of their own, made of earlier rows; clicks of frequent crossings beside it."""
    rows = _lineitem(spark, folder).withColumn("year", F.year("l_shipdate"))
    names = ["l_returnflag", "l_linestatus", "l_linenumber"]
    early = featuremap.cross(rows.where("year < 1998"), names)
    path = new_folder(spark, "map")
    text.write_feature_map(featuremap.build_feature_map(early, indexes=list(featuremap.crossed_columns(names))).entries, path)
    spec = {
        "name": "crossed",
        "partial": [{"name": "rows", "table": "rows", "columns": ["label", *LINE_KEY, "l_returnflag", "l_linestatus"], "type": ["s"] * 7}],
        "intersect": [
            {"columns": names, "mapfile": path},
            {"columns": "l_partkey,l_suppkey", "label": "label", "least": 4},
        ],
        "transform": [{"type": "SIMPLE_INDEX", "columns": "l_partkey_x_l_suppkey"}],
        "format": [{"name": "samples", "pattern": "libsvm"}],
    }
    run = prepare(spark, PrepSpec.from_dict(spec), {"rows": rows})
    counts = run.crossings.select(F.concat_ws(" ", "name", F.replace("value", F.lit(text.EXTRACT_SEPARATOR), F.lit("/")), "pv", "click").alias("value"))
    return run.samples["samples"].unionByName(counts)


def given_map(spark, folder):
    """All orders encoded with the map of those before 1998; later customers have no id."""
    spec, orders = PrepSpec.from_dict(GIVEN_SPEC), _orders(spark, folder)
    first = prepare(spark, spec, {"orders": orders.where("order_year < 1998")})
    second = prepare(spark, spec, {"orders": orders}, feature_map=first.feature_map.entries)
    return second.encoded.select("o_orderkey", "o_custkey_id", "o_orderpriority_id")


def unseen_numbers(spark, folder):
    """Prices of all orders in the buckets of those before 1998, in both modes; a price of no earlier order takes the bucket it falls into."""
    orders = _orders(spark, folder).select("o_orderkey", "order_year", F.floor("o_totalprice").alias("price"))
    early, names, out = orders.where("order_year < 1998"), {"price": "price_id"}, []
    for mode in featuremap.BUCKET_MODES:
        fmap = featuremap.build_feature_map(early, [("price", 50)], mode=mode)
        path = new_folder(spark, "map")
        text.write_feature_map(fmap.entries, path)
        held = lookup.add_ids(orders, fmap, names, unseen_numbers=lookup.NEAREST)
        stored = lookup.add_ids_from(orders, text.read_feature_map(spark, path), names, numbers=["price"], unseen_numbers=lookup.NEAREST)
        for way, df in (("held", held), ("stored", stored)):
            out.append(df.select("o_orderkey", "price_id", F.lit(f"{mode} {way}").alias("way")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def carried_map(spark, folder):
    """The map of orders before 1998 carried on with those since: customers and priorities keep their ids, new customers follow."""
    orders, columns = _orders(spark, folder).withColumn("price", F.floor(F.col("o_totalprice") / 1000)), ["o_custkey", "o_orderpriority"]
    counts = [stats.pv_click(orders.where(c), [*columns, "price"], "label") for c in ("order_year < 1998", "order_year >= 1998")]
    earlier = featuremap.rank_counts(counts[0], [("price", 20)], columns).entries
    path = new_folder(spark, "map")
    text.write_feature_map(earlier, path)
    return carry.carry_forward(text.read_feature_map(spark, path), counts[1], columns, ["price"])


def committed_run(spark, folder):
    """Two runs committed below one folder; what the newest manifest lists is read back."""
    home, orders = new_folder(spark, "committed"), _orders(spark, folder)
    for rows in (orders.where("order_year < 1998"), orders):
        commit_outputs(prepare(spark, PrepSpec.from_dict(GIVEN_SPEC), {"orders": rows}), home)
    found = read_run(spark, home)
    pieces = [F.concat_ws(" ", "name", "value", "id"), F.concat_ws(" ", "name", "value", "pv", "click")]
    named = [found[n].select(F.lit(n).alias("format"), piece.alias("value")) for n, piece in zip(("featuremap", "statistics"), pieces)]
    named += [found[n].select(F.lit(n).alias("format"), "value") for n in ("ids", "pairs")]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


def run_statistics(spark, folder):
    return prepare(spark, PrepSpec.from_dict(GIVEN_SPEC), {"orders": _orders(spark, folder)}).statistics


def several_formats(spark, folder):
    samples = prepare(spark, PrepSpec.from_dict(GIVEN_SPEC), {"orders": _orders(spark, folder)}).samples
    named = [lines.select(F.lit(name).alias("format"), "value") for name, lines in samples.items()]
    return named[0].unionByName(named[1])


CATALOGUE: dict[str, Query] = {
    "q01_extract_typed": extract_typed,
    "q02_extract_since": extract_since,
    "q02_extract_on": extract_on,
    "q03_delimited_parse": delimited_parse,
    "q03_delimited_parse_short": delimited_parse_short,
    "q04_sample_union": sample_union,
    "q05_sample_any": sample_any,
    "q06_sample_keep_unmatched": sample_keep_unmatched,
    "q07_sample_mod10": sample_mod10,
    "q08_noise": noise,
    "q09_vocab": vocab,
    "q09_field_vocab": field_vocab,
    "q10_index_numbering": index_numbering,
    "q10_value_numbering": value_numbering,
    "q10_distinct_numbering": distinct_numbering,
    "q11_value_frequency": value_frequency,
    "q12_interval_bucket": interval_bucket,
    "q13_feature_map": feature_map,
    "q14_pv_click": pv_click,
    "q14_pv_click_events": pv_click_events,
    "q15_feature_map_stats": feature_map_stats,
    "q16_dict_encode_inner": dict_encode_inner,
    "q17_dict_lookup_left": dict_lookup_left,
    "q18_libsvm": libsvm,
    "q18_structured_features": structured_features,
    "q19_template": template,
    "q20_duplicate_positive": duplicate_positive,
    "q20_duplicate_positive_lines": duplicate_positive_lines,
    "q21_recode": recode,
    "q21_recode_lines": recode_lines,
    "q22_shuffle": shuffle,
    "q22_shuffle_by_key": shuffle_by_key,
    "q23_leaf_numbering": leaf_numbering,
    "q24_leaf_encode": leaf_encode,
    "q24_leaf_columns": leaf_columns,
    "q24_leaf_encode_sparse": leaf_encode_sparse,
    "q24_dense_walk": dense_walk,
    "q24_sparse_walk": sparse_walk,
    "q25_sparse_vector": sparse_vector,
    "q25_sparse_fill": sparse_fill,
    "q26_reject_short_rows": reject_short_rows,
    "q26_reject_counts": reject_counts,
    "q26_short_row_counts": short_row_counts,
    "q27_partial_join": partial_join,
    "q28_feature_cross": feature_cross,
    "q28_frequent_crossings": frequent_crossings,
    "q28_crossed_map_run": crossed_map_run,
    "q29_train_valid_split": train_valid_split,
    "q30_full_run": full_run,
    "q30_full_run_map": full_run_map,
    "q31_template_run": template_run,
    "q17_shuffled_lookup": shuffled_lookup,
    "q17_several_dictionaries": several_dictionaries,
    "q27_chained_partials": chained_partials,
    "q32_map_round_trip": map_round_trip,
    "q33_model_file": model_file,
    "q33_model_exchange": model_exchange,
    "q34_given_map": given_map,
    "q34_unseen_numbers": unseen_numbers,
    "q37_carried_map": carried_map,
    "q38_committed_run": committed_run,
    "q02_partitions": partitions_since,
    "q35_run_statistics": run_statistics,
    "q36_several_formats": several_formats,
}
