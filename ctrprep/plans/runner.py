"""One run: extract, sample, map, encode, format."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrprep.operators import formats, sampling, trees
from ctrprep.operators.crossing import cross_frequent, crossing_counts
from ctrprep.operators.featuremap import FeatureMap, build_feature_map, counts_as_numbers, rank_counts
from ctrprep.operators.lookup import BROADCAST_BYTES, add_ids, add_ids_from, id_column, require_ids
from ctrprep.operators.stats import pv_click, value_counts
from ctrprep.plans.spec import LIBSVM, Format, Partial, PrepSpec
from ctrprep.sources.commit import Target
from ctrprep.sources.model import read_model
from ctrprep.sources.scratch import store
from ctrprep.sources.tables import Part, attach_parts, extract, open_table, since
from ctrprep.sources.text import (
    read_feature_map,
    read_feature_map_text,
    read_lines,
    write_feature_map,
    write_feature_map_text,
    write_lines,
)


@dataclass(frozen=True)
class Prepared:
    """The frames of a run.  All but what is stored on the way are lazy.

    ``statistics`` are views and clicks per value, for runs with a click label, and ``crossings`` those of the
    crossings that have a label of their own.
    ``feature_map`` is None for runs that encode with a given one.
    """

    rows: DataFrame
    statistics: DataFrame | None
    feature_map: FeatureMap | None
    encoded: DataFrame
    samples: dict[str, DataFrame]
    target: str | None = None
    crossings: DataFrame | None = None


def prepare(
    spark: SparkSession,
    spec: PrepSpec,
    tables: Mapping[str, DataFrame] | None = None,
    models: Mapping[str, DataFrame] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    feature_map: FeatureMap | DataFrame | None = None,
) -> Prepared:
    """Run ``spec``.  ``tables`` and ``models`` (node frames) give frames by name;
    other names are catalog tables, parquet paths and model files.

    With ``feature_map``, an earlier run's or ``(name, value, id)`` as written by one,
    rows are encoded with that map and none is built; values it lacks have no id, but for numbers
    whose transform sets ``unseen_numbers`` to ``nearest``.

    The rows are read once for the vocabulary and once for the samples.  Seeded
    draws make both readings see the same rows, so a single table is not copied
    in between; a join of several is stored, as it costs more to repeat, and so are
    encoded rows that several formats print.
    """
    spec.validate()
    rows = sample(gather(spark, spec, tables), spec)
    if len(spec.partials) > 1:
        rows = store(rows, "rows")
    for noise in spec.noises:
        rows = sampling.add_noise(rows, noise.column, noise.to, noise.value, noise.factor, spec.key, spec.seed)
    crossings = None
    for c in spec.crosses:
        rows = cross_frequent(rows, c.columns, c.factor, c.bundle, c.least, broadcast_bytes, spec.key or None)
    for c in spec.crosses:
        if c.label:
            counted = crossing_counts(rows, c.names(), c.least, c.label)
            crossings = counted if crossings is None else crossings.unionByName(counted)

    statistics, fmap, encoded = None, None, rows
    if spec.transforms:
        if spec.click_label:
            statistics = store(pv_click(rows, list(spec.id_columns), spec.click_label), "statistics")
        if feature_map is None:
            fmap = _built_map(rows, spec, statistics)
            encoded = add_ids(rows, fmap, spec.id_columns, broadcast_bytes, True, spec.key)
        elif isinstance(feature_map, FeatureMap):
            encoded = add_ids(rows, feature_map, spec.id_columns, broadcast_bytes, False, spec.key, spec.unseen_numbers)
        else:
            numbers = [c for c, _ in spec.intervals]
            encoded = add_ids_from(rows, feature_map, spec.id_columns, broadcast_bytes, spec.key, numbers, spec.unseen_numbers)
    for c in spec.crosses:
        if c.map_file:
            entries, ids = open_table(spark, c.map_file, tables), {name: id_column(name) for name in c.names()}
            encoded = add_ids_from(encoded, entries, ids, broadcast_bytes, spec.key or None)
    if spec.missing_rows == "drop":
        encoded = require_ids(encoded, list(spec.feature_ids.values()))
    for step in spec.filters:
        nodes = models[step.model] if models and step.model in models else read_model(spark, step.model)
        numbered = trees.number_leaves(nodes, step.offset)
        inputs = trees.parse_inputs(step.inputs, encoded.columns)
        leaves = trees.encode_leaves(encoded, numbered, inputs, "__leaves", len(step.outputs))
        encoded = trees.leaf_columns(leaves, step.outputs, "__leaves")
    if len(spec.formats) > 1 and encoded is not rows:
        encoded = store(encoded, "encoded")
    samples = {f.name: render(encoded, spec, f) for f in spec.formats}
    return Prepared(rows, statistics, fmap, encoded, samples, spec.target, crossings)


def _built_map(rows: DataFrame, spec: PrepSpec, statistics: DataFrame | None) -> FeatureMap:
    """The run's own map, from the stored statistics where there are some, so that rows are counted once."""
    if statistics is None and not spec.least_counts:
        return build_feature_map(rows, spec.intervals, spec.indexes, spec.bucket_mode)
    counts = value_counts(rows, list(spec.id_columns)) if statistics is None else statistics
    for name, least in spec.least_counts.items():
        counts = counts.where((F.col("name") != name) | (F.col("pv") >= F.lit(least)))
    counts = counts_as_numbers(counts, [c for c, _ in spec.intervals])
    return rank_counts(counts, spec.intervals, spec.indexes, spec.bucket_mode)


def gather(spark: SparkSession, spec: PrepSpec, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The typed columns of all partials."""
    first, *others = spec.partials
    parts = [Part(_read(spark, p, tables), p.join_keys, p.join_type, p.defaults) for p in others]
    return attach_parts(_read(spark, first, tables), parts)


def _read(spark: SparkSession, part: Partial, tables: Mapping[str, DataFrame] | None) -> DataFrame:
    table = open_table(spark, part.table, tables)
    if part.since is not None:
        table = since(table, part.since, part.since_column)
    return extract(table, part.columns, part.types, part.convert)


def sample(rows: DataFrame, spec: PrepSpec) -> DataFrame:
    conditions = [c for shrink in spec.shrinks for c in shrink]
    if spec.sample_mode == "any":
        return sampling.sample_any(rows, spec.shrinks, spec.key, spec.seed)
    chosen = sampling.sample_union if spec.sample_mode == "union" else sampling.sample_keep_unmatched
    return chosen(rows, conditions, spec.key, spec.seed)


def render(encoded: DataFrame, spec: PrepSpec, fmt: Format) -> DataFrame:
    """The lines of one format as ``value``, with ``split`` when some are set
    aside for validation."""
    key, keep = spec.key or None, []
    rows = sampling.sample_residues(encoded, fmt.residues, key, spec.seed)
    if fmt.validate_rate:
        rows, keep = sampling.with_split(rows, fmt.validate_rate, key, spec.seed), ["split"]
    if fmt.duplicate_positives:
        rows = sampling.duplicate_positives(rows, spec.label)
    if fmt.pattern == LIBSVM:
        ids = spec.feature_ids
        if fmt.columns:
            ids = {c: i for c, i in ids.items() if c in fmt.columns}
        lines = formats.libsvm(rows, ids, spec.label, fmt.on_missing, keep)
    else:
        lines = formats.template(rows, fmt.pattern, fmt.columns, fmt.dropout, key, spec.seed, keep)
    return sampling.shuffle_rows(lines, fmt.partitions, seed=spec.seed) if fmt.shuffle else lines


def write_outputs(prepared: Prepared, path: str | None = None, text_map: bool = False) -> None:
    """Write ``<path>/featuremap``, ``<path>/statistics`` and ``<path>/<format>``, replacing only these.

    ``path`` is by default the run's name below the configured ``hdfs_path``.  The map is a parquet table,
    or with ``text_map`` lines of text, which not every value can stand in.
    """
    _write(prepared, _home(prepared, path), text_map)


def commit_outputs(prepared: Prepared, path: str | None = None, text_map: bool = False, keep: int = 2) -> int:
    """Write all outputs to a new folder below ``path`` and list them in a manifest, last; the number of the committed run.

    Until then, and if anything fails on the way, :func:`read_run` gives the run before.  The newest ``keep`` runs stay.
    """
    target = Target(prepared.rows.sparkSession, _home(prepared, path))
    run = target.new_run()
    number = target.commit(run, _write(prepared, run, text_map))
    target.forget(max(1, keep))
    return number


def read_run(spark: SparkSession, path: str, number: int | None = None) -> dict[str, DataFrame]:
    """The outputs of the newest committed run below ``path``, or of an older one, by name: ``featuremap``, ``statistics`` and the formats."""
    manifest = Target(spark, path).manifest(number)
    read = {"map": read_feature_map, "text map": read_feature_map_text, "table": lambda s, p: s.read.parquet(p), "lines": read_lines}
    return {name: read[kind](spark, f"{manifest['path']}/{name}") for name, kind in manifest["outputs"].items()}


def _home(prepared: Prepared, path: str | None) -> str:
    home = (path or prepared.target or "").rstrip("/")
    if not home:
        raise ValueError("the outputs have no target: give a path or configure hdfs_path")
    return home


def _write(prepared: Prepared, home: str, text_map: bool) -> dict[str, str]:
    """Write every output below ``home``; their kinds by name."""
    kinds = {}
    if prepared.feature_map is not None:
        write = write_feature_map_text if text_map else write_feature_map
        write(prepared.feature_map.entries, f"{home}/featuremap")
        kinds["featuremap"] = "text map" if text_map else "map"
    if prepared.statistics is not None:
        prepared.statistics.write.mode("overwrite").parquet(f"{home}/statistics")
        kinds["statistics"] = "table"
    if prepared.crossings is not None:
        prepared.crossings.write.mode("overwrite").parquet(f"{home}/crossings")
        kinds["crossings"] = "table"
    for name, lines in prepared.samples.items():
        if "split" in lines.columns:
            lines.write.mode("overwrite").partitionBy("split").text(f"{home}/{name}")
        else:
            write_lines(lines, f"{home}/{name}")
        kinds[name] = "lines"
    return kinds
