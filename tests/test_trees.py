import random

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from ctrprep.operators import trees
from ctrprep.sources.model import parse_model, read_model

MODEL = """# a comment line, ignored

[tree_0]
node_0=1,2,null,4,100,0,,0
node_1=-1,-1,0.0,-1,0,0,,0.1
node_2=3,4,null,6,5.5,0,,0
node_3=-1,-1,0.0,-1,0,0,,0.2
node_4=-1,-1,0.0,-1,0,0,,-0.3

[tree_1]
node_0=1,2,null,6,2,0,,0
node_1=-1,-1,0.0,-1,0,0,,0.1
node_2=-1,-1,0.0,-1,0,0,,0.05
"""


@pytest.fixture(scope="module")
def small_model(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("model") / "model.ini"
    path.write_text(MODEL)
    return trees.number_leaves(read_model(spark, str(path)), 1000)


def test_model_file(small_model):
    assert rows_of(small_model, "tree", "node", "left", "right", "feature", "threshold") == sorted(
        [(0, 0, 1, 2, 4, 100.0), (0, 1, -1, -1, -1, 0.0), (0, 2, 3, 4, 6, 5.5), (0, 3, -1, -1, -1, 0.0),
         (0, 4, -1, -1, -1, 0.0), (1, 0, 1, 2, 6, 2.0), (1, 1, -1, -1, -1, 0.0), (1, 2, -1, -1, -1, 0.0)],
        key=str)
    leaves = rows_of(small_model.where("left = -1"), "tree", "node", "leaf_id")
    assert leaves == [(0, 1, 1000), (0, 3, 1001), (0, 4, 1002), (1, 1, 1003), (1, 2, 1004)]
    assert small_model.where("left <> -1 and leaf_id is not null").count() == 0


CASES = [({4: 99.0, 6: 1.0}, [1000, 1003]), ({4: 100.0, 6: 5.0}, [1001, 1004]), ({4: 100.0, 6: 6.0}, [1002, 1004]), ({}, [1000, 1003])]


def test_walk_by_columns(spark, small_model):
    rows = spark.createDataFrame([(k, f.get(4), f.get(6)) for k, (f, _) in enumerate(CASES)], "k int, a float, b float")
    got = trees.encode_leaves(rows, small_model, trees.parse_inputs("4:a,6:b", rows.columns)).orderBy("k")
    assert [r["leaves"] for r in got.collect()] == [leaves for _, leaves in CASES]


def test_walk_by_map_and_array(spark, small_model):
    rows = spark.createDataFrame([(k, f, [0.0, 0.0, 0.0, 0.0, f.get(4), 0.0, f.get(6)]) for k, (f, _) in enumerate(CASES)],
                                 "k int, m map<int,float>, v array<float>").orderBy("k")
    for column in ("m", "v"):
        got = trees.encode_vector(rows, small_model, column).collect()
        assert [r["leaves"] for r in got] == [leaves for _, leaves in CASES]
    short = spark.createDataFrame([([200.0] * 5,)], "v array<float>")
    assert trees.encode_vector(short, small_model, "v").first()["leaves"] == [1001, 1003]


def test_walk_by_chosen_feature(spark, small_model):
    rows = spark.createDataFrame([(4, 9), (6, 9), (None, 9), (5, 9)], "f int, k int")
    got = trees.encode_leaves(rows, small_model, trees.parse_inputs("f:100", rows.columns))
    assert [r["leaves"] for r in got.collect()] == [[1001, 1003], [1000, 1004], [1000, 1003], [1000, 1003]]


def test_later_inputs_win(spark, small_model):
    rows = spark.createDataFrame([(1.0, 200.0)], "a float, b float")
    assert trees.encode_leaves(rows, small_model, trees.parse_inputs("4:a,4:b", rows.columns)).first()["leaves"] == [1001, 1003]


def test_a_null_input_does_not_erase_an_earlier_one(spark, small_model):
    rows = spark.createDataFrame([(200.0, None)], "a float, b float")
    assert trees.encode_leaves(rows, small_model, trees.parse_inputs("4:a,4:b", rows.columns)).first()["leaves"] == [1001, 1003]


def test_threshold_is_compared_in_single_precision(spark):
    model = parse_model(spark.createDataFrame(
        [(0, "0]\nnode_0=1,2,null,0,0.1,0,,0\nnode_1=-1,-1,0,-1,0,0,,0\nnode_2=-1,-1,0,-1,0,0,,0")],
        "section int, value string"))
    rows = spark.createDataFrame([(0.1,), (0.0999999,)], "a double")
    got = trees.encode_leaves(rows, trees.number_leaves(model), [trees.TreeInput("a", 0)])
    assert [r["leaves"] for r in got.collect()] == [[1], [0]]


def test_leaf_columns(spark, small_model):
    rows = spark.createDataFrame([(99.0, 1.0)], "a float, b float")
    inputs = trees.parse_inputs("4:a,6:b", rows.columns)
    leaves = trees.encode_leaves(rows, small_model, inputs, outputs=2)
    wide = trees.leaf_columns(leaves, trees.output_names("leaf%d", 2))
    assert wide.columns == ["a", "b", "leaf0", "leaf1"] and rows_of(wide, "leaf0", "leaf1") == [(1000, 1003)]
    with pytest.raises(ValueError):
        trees.encode_leaves(rows, small_model, inputs, outputs=3)
    with pytest.raises(ValueError):
        trees.output_names("leaf%d")
    assert trees.output_names("x, y") == ["x", "y"]


def random_trees(count, depth, seed):
    """Model text of uneven trees, and the same trees as nested tuples."""
    rng, text, shapes = random.Random(seed), [], []
    for t in range(count):
        nodes = {}

        def grow(node, left_depth):
            if left_depth == 0 or (left_depth < depth and rng.random() < 0.2):
                nodes[node] = "-1,-1,0.0,-1,0,0,,0.5"
                return (node,)
            feature, threshold = rng.randrange(5), rng.randrange(-20, 20) / 4
            left, right = 2 * node + 1, 2 * node + 2
            nodes[node] = f"{left},{right},null,{feature},{threshold},0,,0"
            return (feature, threshold, grow(left, left_depth - 1), grow(right, left_depth - 1))

        shapes.append(grow(0, depth))
        text.append(f"[tree_{t}]\n" + "".join(f"node_{n}={nodes[n]}\n" for n in sorted(nodes)))
    return "\n".join(text), shapes


def brute_force(shapes, offset, values):
    """Leaf ids of one row, by following the nested tuples."""
    found, start = [], offset

    def leaf_nodes(shape):
        return [shape[0]] if len(shape) == 1 else leaf_nodes(shape[2]) + leaf_nodes(shape[3])

    for shape in shapes:
        ids = {n: start + k for k, n in enumerate(sorted(leaf_nodes(shape)))}
        start += len(ids)
        at = shape
        while len(at) > 1:
            at = at[2] if values[at[0]] < at[1] else at[3]
        found.append(ids[at[0]])
    return found


def test_many_trees_match_brute_force(spark, tmp_path, monkeypatch):
    text, shapes = random_trees(60, 6, 5)
    path = tmp_path / "big.ini"
    path.write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        model = read_model(spark, str(path))
        assert model.select(F.col("section.block")).distinct().count() > 3
        numbered = trees.number_leaves(model, 500).cache()
        rng = random.Random(1)
        data = [tuple(rng.randrange(-30, 30) / 4 for _ in range(5)) for _ in range(300)]
        rows = spark.createDataFrame([(k, *d) for k, d in enumerate(data)], "k int, a float, b float, c float, d float, e float")
        inputs = trees.parse_inputs("0:a,1:b,2:c,3:d,4:e", rows.columns)
        expected = [brute_force(shapes, 500, d) for d in data]
        one = trees.encode_leaves(rows, numbered, inputs).orderBy("k")
        assert [r["leaves"] for r in one.collect()] == expected
        monkeypatch.setattr(trees, "GROUP_NODES", 500)
        assert len(list(trees._tree_groups(numbered))) > 2
        several = trees.encode_leaves(rows, numbered, inputs, outputs=60).orderBy("k")
        assert [r["leaves"] for r in several.collect()] == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_walk_is_one_python_pass_without_shuffle(spark, small_model):
    rows = spark.createDataFrame([(99.0, 1.0)], "a float, b float")
    leaves = trees.encode_leaves(rows, small_model, trees.parse_inputs("4:a,6:b", rows.columns))
    plan = plan_of(trees.leaf_columns(leaves, ["x", "y"]))
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize(
    "nodes, complaint",
    [([(0, 0, 1, 2), (0, 1, -1, -1)], "missing"), ([(0, 1, -1, -1)], "node 0"),
     ([(0, 0, -1, -1), (0, 0, -1, -1)], "repeats"), ([(0, 0, 0, 0)], "cycle"), ([], "no trees")],
)
def test_broken_models_raise(spark, nodes, complaint):
    frame = spark.createDataFrame(nodes, "tree int, node int, left int, right int")
    frame = frame.select("*", F.lit(0).alias("feature"), F.lit(0.0).cast("float").alias("threshold"), F.lit(1).cast("bigint").alias("leaf_id"))
    with pytest.raises(ValueError, match=complaint):
        trees.encode_leaves(spark.range(1), frame, [trees.TreeInput("id", 0)])


def test_numbers_do_not_depend_on_how_the_file_is_split(spark, tmp_path):
    """Numbered with small pieces and walked with large ones, every leaf has its id."""
    sections = []
    for tree in range(200):
        leaf = "=-1,-1,0.0,-1,0,0,,0.1"
        sections.append(f"[tree_{tree}]\nnode_0=1,2,null,{tree % 3},{tree % 5}.5,0,,0\nnode_1{leaf}\nnode_2{leaf}\n")
    path = tmp_path / "model.ini"
    path.write_text("".join(sections))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        nodes = read_model(spark, str(path))
        numbered = trees.number_leaves(nodes)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
        leaves = numbered.where("left = -1")
        assert leaves.count() == 400
        assert sorted(r["leaf_id"] for r in leaves.select("leaf_id").collect()) == list(range(400))
        row = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
        inputs = trees.parse_inputs("0:a,1:b,2:c", row.columns)
        assert -1 not in trees.encode_leaves(row, numbered, inputs).first()["leaves"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_leaf_without_an_id_raises(spark):
    nodes = spark.createDataFrame(
        [(0, 0, 1, 2, 0, 0.5, None), (0, 1, -1, -1, -1, 0.0, 7), (0, 2, -1, -1, -1, 0.0, None)],
        "tree int, node int, left int, right int, feature int, threshold float, leaf_id long",
    )
    row = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError, match="no id"):
        trees.encode_leaves(row, nodes, trees.parse_inputs("0:a", row.columns))


def test_wide_models_walk_sparse_vectors(spark):
    """100,000 feature numbers; the vectors hold a few of them."""
    width = 100_000
    split = F.array(
        *[F.struct(*[F.lit(v).cast(t).alias(n) for n, v, t in zip(("node", "left", "right", "threshold"), r, ("int", "int", "int", "float"))])
          for r in ((0, 1, 2, 0.5), (1, -1, -1, 0.0), (2, -1, -1, 0.0))]
    )
    nodes = spark.range(width).select(
        F.col("id").alias("section"), F.col("id").cast("int").alias("tree"), F.col("id").cast("int").alias("feature"),
        F.posexplode(split).alias("line", "n"),
    ).select("section", "line", "tree", "n.*", "feature", F.lit(0.0).cast("float").alias("leaf_value"))
    numbered = trees.number_leaves(nodes)
    rows = spark.createDataFrame([(1, {5: 1.0, 99_999: 2.0, 500_000: 1.0}), (2, {}), (3, None)], "id int, v map<int,float>")
    got = {r["id"]: r["leaves"] for r in trees.encode_vector(rows, numbered, "v").collect()}
    assert [k for k in range(width) if got[1][k] % 2] == [5, 99_999]
    assert not any(leaf % 2 for leaf in got[2]) and got[2] == got[3]


def test_a_model_met_by_exchange_equals_the_shipped_one(spark, monkeypatch):
    """One tree for each group and several cells; repeated rows, NULL inputs and clashing names; no group's nodes go through the driver."""
    nodes = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    from ctrprep.plans.queries import nation_model

    numbered = trees.number_leaves(nation_model(spark, "/root/testdata/sf0.001"), 7)
    rows = spark.range(3000).select(
        (F.col("id") % 40).alias("row"), (F.col("id") % 9).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("group"), F.lit("x").alias("kind")
    )
    inputs = trees.parse_inputs("0:a,1:group,row:4", rows.columns)
    shipped = rows_of(trees.encode_leaves(rows, numbered, inputs))
    assert nodes.count() == 25
    monkeypatch.setattr(trees, "SHIPPED_NODES", 0)
    monkeypatch.setattr(trees, "GROUP_NODES", 1)
    monkeypatch.setattr(trees, "_tree_groups", None)
    got = trees.encode_leaves(rows, numbered, inputs, outputs=25)
    assert got.columns == [*rows.columns, "leaves"]
    assert rows_of(got) == shipped
    assert rows_of(trees.exchange_leaves(rows, numbered, inputs, group_nodes=30, cells=5)) == shipped
    with pytest.raises(ValueError, match="24 outputs for 25 trees"):
        trees.encode_leaves(rows, numbered, inputs, outputs=24)
    with pytest.raises(ValueError, match="no trees"):
        trees.exchange_leaves(rows, numbered.where("false"), inputs)


def _shuffled_records(df):
    """Records that all exchanges of a query that has run wrote."""
    total, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        elif kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        left.extend(children.apply(k) for k in range(children.size()))
    return total


def test_rows_meet_all_groups_of_trees_in_one_exchange(spark):
    """Neither the rows nor their leaves move once for each group, which takes many times the disk."""
    from ctrprep.plans.queries import nation_model

    numbered = trees.number_leaves(nation_model(spark, "/root/testdata/sf0.001"), 7)
    rows = spark.range(20_000).select((F.col("id") % 9).alias("a"), (F.col("id") % 7).alias("b"))
    inputs = trees.parse_inputs("0:a,1:b", rows.columns)
    got = trees.exchange_leaves(rows, numbered, inputs, group_nodes=30, cells=6)
    found = rows_of(got)
    # 175 nodes in five groups, once for each cell and a few times before.
    assert 20_000 + 6 * 175 <= _shuffled_records(got) < 20_000 + 12 * 175
    assert found == rows_of(trees.encode_leaves(rows, numbered, inputs))


def test_whole_rows_of_any_kind_pass_the_exchange(spark, monkeypatch):
    """Texts, times, nested columns and NULLs; cells of a few rows, slices of one, and no rows at all."""
    from ctrprep.plans.queries import nation_model

    numbered = trees.number_leaves(nation_model(spark, "/root/testdata/sf0.001"), 7)
    number = F.col("id")
    flat = spark.range(500).select(
        (number % 40).alias("row"), (number % 9).cast("double").alias("a"), F.when(number % 5 > 0, number % 7).alias("group"),
        F.when(number % 3 > 0, F.repeat(F.lit("é"), (number % 11).cast("int"))).alias("tree"), F.lit(b"x").alias("node"),
        F.timestamp_micros(number * 1_000_003).alias("t"), F.date_from_unix_date(number.cast("int")).alias("d"),
        (number / 7).cast("decimal(20,5)").alias("dec"), (number % 2 == 0).alias("flag"),
    )
    nested = flat.withColumns({"list": F.array("tree"), "pair": F.struct("a", "t"), "map": F.create_map("row", "group")})
    monkeypatch.setattr(trees, "CELL_BYTES", 3000)
    monkeypatch.setattr(trees, "DENSE_CELLS", 2)
    for rows, nodes in ((flat, 30), (flat, None), (nested, 30), (flat.where("false"), 30), (nested.where("false"), 30)):
        inputs = trees.parse_inputs("0:a,1:group,row:4", rows.columns)
        got = trees.exchange_leaves(rows, numbered, inputs, group_nodes=nodes)
        assert got.columns == [*rows.columns, "leaves"] and [x for _, x in got.dtypes[:-1]] == [x for _, x in rows.dtypes]
        shipped = trees.encode_leaves(rows, numbered, inputs)
        assert sorted(map(str, got.collect())) == sorted(map(str, shipped.collect()))


def test_cells_stay_small():
    """However many rows there are, a task holds about as many bytes of rows and leaves."""
    sizes = [(k, 127) for k in range(100)]
    for rows in (10**7, 10**8, 10**10):
        cells = trees._cell_count(rows, 80, sizes, 12)
        assert trees.CELL_BYTES * (cells - 1) < rows * (80 + 4 * 100) <= trees.CELL_BYTES * cells
    assert trees._cell_count(100_000, 80, sizes, 200) == 7
    assert trees._cell_count(0, 80, sizes, 200) == 1


ODD_TEXTS = [
    "1:2", "1:2,0:3.5,1:7", "", None, "5:.5,x", "1:2:3", "-3:-4.", "99999999999:1", "7", ":", "1:", ":1", "1:-", "1:1.2.3", "-:1", "1:--1",
    "3:1,2:2,3:5", " 1 : 2 ", "1:1e3", "1:0x10", "1:NaN", "1:Infinity", "1:5f", "+1:2", "1:+2", "2147483647:1,2147483648:1,-2147483648:2", "1.5:2",
    "1:16777217", "1:0.1,2:0.30000001192092896", "1:3.4028236e38", "1:" + "9" * 60, "1:0." + "0" * 50 + "1", "0001:1", "00000000000001:1", "1:2,", ",1:2",
    "-0:1,0:2", "1:1.00000017881393432617187499", "1:1.00000017881393432617187500001", "1:2,1:3,0:9", "é:1", "1\t:2",
]


def test_plain_texts_are_parsed_as_expressions_do(spark):
    from ctrprep.operators import sparse

    rng = random.Random(8)
    texts = ODD_TEXTS + ["".join(rng.choice("0123459:.,-:,") for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = rows.select("k", F.map_entries(sparse.parse_sparse(F.col("t"))).alias("m")).collect()
    expected = rows.select("k", F.map_entries(sparse.parse_any(F.col("t"))).alias("m")).collect()
    for a, b in zip(sorted(got), sorted(expected)):
        assert str(a["m"]) == str(b["m"]), texts[a["k"]]
