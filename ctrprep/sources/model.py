"""Tree-model files: ``[tree_k]`` sections of
``node_i=left,right,gain,feature,threshold,kind,categories,value`` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrprep.functions.columns import field

SECTION = "[tree_"


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a model file.  Each section is read as one record, so large
    files split by tree."""
    sections = spark.read.option("lineSep", SECTION).text(path)
    meta = F.col("_metadata")
    return parse_model(
        sections.select(
            F.struct(
                meta["file_path"].alias("file"),
                meta["file_block_start"].alias("block"),
                F.monotonically_increasing_id().alias("record"),
            ).alias("section"),
            "value",
        )
    )


def parse_model(sections: DataFrame) -> DataFrame:
    """``(section, value)`` records, a value being the text after ``[tree_``, to
    ``(section, line, tree, node, left, right, feature, threshold, leaf_value)``.
    Text before the first section and lines other than nodes are ignored."""
    trees = sections.where(F.col("value").rlike("^[0-9]+\\]")).select(
        "section",
        F.regexp_extract("value", "^([0-9]+)\\]", 1).cast("int").alias("tree"),
        F.posexplode(F.split(F.col("value"), "\n")).alias("line", "entry"),
    )
    nodes = trees.where(F.startswith("entry", F.lit("node_")))
    parts = F.split(F.substring_index(F.trim("entry"), "=", -1), ",", -1)
    return nodes.select(
        "section",
        "line",
        "tree",
        F.regexp_extract("entry", "^node_([0-9]+)", 1).cast("int").alias("node"),
        field(parts, 0).cast("int").alias("left"),
        field(parts, 1).cast("int").alias("right"),
        field(parts, 3).cast("int").alias("feature"),
        field(parts, 4).cast("float").alias("threshold"),
        field(parts, 7).cast("float").alias("leaf_value"),
    )
