"""What to prepare, as plain data.

``PrepSpec.from_dict`` takes the settings under their configuration names, with
comma lists as text or as Python lists, and checks them before any job runs.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from ctrprep.operators.featuremap import BUCKET_MODES, EXACT, crossed_columns
from ctrprep.operators.lookup import MISSING, UNSEEN, id_column
from ctrprep.operators.sampling import Condition, parse_conditions, parse_residues
from ctrprep.operators.trees import output_names
from ctrprep.sources.tables import column_union

SIMPLE_INDEX = "SIMPLE_INDEX"
INTERVAL_INDEX = "INTERVAL_INDEX"
SAMPLE_MODES = ("union", "any", "keep_unmatched")
LIBSVM = "libsvm"
DEFAULT_CLICK_LABEL = "click"
# Outputs of a run that no format may be named after.
RESERVED_OUTPUTS = ("featuremap", "statistics", "crossings")

# The settings of each block.
_SETTINGS = {
    "run": "name hdfs_path partial shrink noise intersect transform filter format key seed sample_mode missing_rows",
    "partial": "name table columns type convert dtfrom dt_column joint join_type default_values",
    "shrink": "name args",
    "noise": "name columns to value factor",
    "intersect": "name columns factor fix_bundle mapfile label least",
    "transform": "name type args columns to label bucket_mode unseen_numbers",
    "filter": "name inputs outputs output_num offset args",
    "format": "name pattern columns random_column random_ratio sample_index validate_rate on_missing shuffle"
    " duplicate_positives numreduces",
}


@dataclass(frozen=True)
class Partial:
    name: str
    table: str
    columns: tuple[str, ...]
    types: tuple[str, ...]
    convert: float = 100000
    since: str | None = None
    since_column: str = "dt"
    join_keys: tuple[str, ...] = ("pvid", "deliver_id")
    join_type: str = "left"
    defaults: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Noise:
    column: str
    to: str
    value: str
    factor: float


@dataclass(frozen=True)
class Transform:
    kind: str
    columns: tuple[str, ...]
    to: tuple[str, ...]
    buckets: int = 0
    label: str | None = None
    bucket_mode: str = EXACT
    unseen_numbers: str = MISSING


@dataclass(frozen=True)
class Cross:
    columns: tuple[str, ...]
    factor: int = 2
    bundle: tuple[str, ...] = ()
    map_file: str | None = None
    label: str | None = None
    least: int = 1

    def names(self) -> list[str]:
        return list(crossed_columns(self.columns, self.factor, self.bundle))


@dataclass(frozen=True)
class TreeFilter:
    name: str
    inputs: str
    outputs: tuple[str, ...]
    model: str
    offset: int = 0


@dataclass(frozen=True)
class Format:
    name: str
    pattern: str
    columns: tuple[str, ...] = ()
    dropout: Mapping[str, float] = field(default_factory=dict)
    residues: tuple[int, ...] = (-1,)
    validate_rate: float = 0
    on_missing: str = "drop"
    shuffle: bool = False
    duplicate_positives: bool = False
    partitions: int | None = None


@dataclass(frozen=True)
class PrepSpec:
    name: str
    partials: tuple[Partial, ...]
    path: str = ""
    shrinks: tuple[tuple[Condition, ...], ...] = ()
    noises: tuple[Noise, ...] = ()
    crosses: tuple[Cross, ...] = ()
    transforms: tuple[Transform, ...] = ()
    filters: tuple[TreeFilter, ...] = ()
    formats: tuple[Format, ...] = ()
    key: tuple[str, ...] = ()
    seed: int = 42
    sample_mode: str = "union"
    missing_rows: str = "keep"

    @staticmethod
    def from_dict(config: Mapping) -> PrepSpec:
        _settled(config, "run")
        for block in ("partial", "shrink", "noise", "intersect", "transform", "filter", "format"):
            for part in config.get(block, ()):
                _settled(part, block)
        spec = PrepSpec(
            name=config["name"],
            path=config.get("hdfs_path", ""),
            partials=tuple(_partial(p) for p in config["partial"]),
            shrinks=tuple(tuple(parse_conditions(s.get("args", ""))) for s in config.get("shrink", ())),
            noises=tuple(n for block in config.get("noise", ()) for n in _noises(block)),
            crosses=tuple(_cross(c) for c in config.get("intersect", ())),
            transforms=tuple(_transform(t) for t in config.get("transform", ())),
            filters=tuple(_tree_filter(f) for f in config.get("filter", ())),
            formats=tuple(_format(f) for f in config.get("format", ())),
            key=_names(config.get("key", ())),
            seed=int(config.get("seed", 42)),
            sample_mode=config.get("sample_mode", "union"),
            missing_rows=config.get("missing_rows", "keep"),
        )
        spec.validate()
        return spec

    @property
    def source_columns(self) -> list[str]:
        return column_union([p.columns for p in self.partials])

    @property
    def label(self) -> str:
        """The first column, which samples are labelled by."""
        return self.partials[0].columns[0]

    @property
    def click_label(self) -> str | None:
        """The column that clicks are counted by, if there is one."""
        named = next((t.label for t in self.transforms if t.label), DEFAULT_CLICK_LABEL)
        return named if named in self.row_columns() else None

    @property
    def bucket_mode(self) -> str:
        return next((t.bucket_mode for t in self.transforms if t.kind == INTERVAL_INDEX), EXACT)

    @property
    def unseen_numbers(self) -> str:
        """What becomes of numbers that a given map has not seen."""
        return next((t.unseen_numbers for t in self.transforms if t.kind == INTERVAL_INDEX), MISSING)

    @property
    def target(self) -> str | None:
        """Where the run's outputs go, if the configuration says so."""
        return f"{self.path.rstrip('/')}/{self.name}" if self.path else None

    @property
    def intervals(self) -> list[tuple[str, int]]:
        return [(c, t.buckets) for t in self.transforms if t.kind == INTERVAL_INDEX for c in t.columns]

    @property
    def indexes(self) -> list[str]:
        return [c for t in self.transforms if t.kind == SIMPLE_INDEX for c in t.columns]

    @property
    def id_columns(self) -> dict[str, str]:
        """Id column of every transformed column, in the order of the row's columns."""
        named = {c: to for t in self.transforms for c, to in zip(t.columns, t.to)}
        return {c: named[c] for c in self.row_columns() if c in named}

    @property
    def map_file_ids(self) -> dict[str, str]:
        """Id column of every crossing whose ids come from a map of its own."""
        return {name: id_column(name) for c in self.crosses if c.map_file for name in c.names()}

    @property
    def feature_ids(self) -> dict[str, str]:
        """All id columns, in the order of the row's columns."""
        every = self.id_columns | self.map_file_ids
        return {c: every[c] for c in self.row_columns() if c in every}

    @property
    def least_counts(self) -> dict[str, int]:
        """How often a value of a crossing has to occur to be in the map."""
        return {name: c.least for c in self.crosses if c.least > 1 for name in c.names()}

    def row_columns(self) -> list[str]:
        """Columns before encoding: parts, noise, crossings."""
        return column_union([self.source_columns, [n.to for n in self.noises], *[c.names() for c in self.crosses]])

    def all_columns(self) -> list[str]:
        """The full layout of an encoded row."""
        return [*self.row_columns(), *self.feature_ids.values(), *[o for f in self.filters for o in f.outputs]]

    def draws_rows(self) -> bool:
        return any(self.shrinks) or bool(self.noises)

    def validate(self) -> None:
        if not self.partials:
            raise ValueError("no partial")
        if self.sample_mode not in SAMPLE_MODES:
            raise ValueError(f"sample_mode {self.sample_mode!r} is not one of {SAMPLE_MODES}")
        if self.missing_rows not in ("keep", "drop"):
            raise ValueError(f"missing_rows {self.missing_rows!r} is neither 'keep' nor 'drop'")
        outputs = [f.name for f in self.formats]
        if len(set(outputs)) != len(outputs):
            raise ValueError(f"two formats have one name in {outputs}; each would replace the other's output")
        taken = sorted(set(outputs) & set(RESERVED_OUTPUTS))
        if taken:
            raise ValueError(f"format name(s) {taken} are taken by other outputs of the run")
        modes = {t.bucket_mode for t in self.transforms if t.kind == INTERVAL_INDEX}
        if len(modes) > 1:
            raise ValueError(f"transforms name different bucket modes {sorted(modes)}")
        if len({t.unseen_numbers for t in self.transforms if t.kind == INTERVAL_INDEX}) > 1:
            raise ValueError("transforms differ in unseen_numbers")
        labels = {t.label for t in self.transforms if t.label}
        if len(labels) > 1:
            raise ValueError(f"transforms name different labels {sorted(labels)}")
        source, rows = self.source_columns, self.row_columns()
        _known([c.column for s in self.shrinks for c in s], source, "shrink")
        _known([n.column for n in self.noises], source, "noise")
        _known([c for x in self.crosses for c in (*x.bundle, *x.columns)], rows, "intersect")
        _known([c for t in self.transforms for c in t.columns], rows, "transform")
        _known(labels, rows, "label")
        _known([c.label for c in self.crosses if c.label], rows, "label of intersect")
        _known(self.key, source, "key")
        encoded = [c for t in self.transforms for c in t.columns]
        if len(set(encoded)) != len(encoded):
            raise ValueError(f"a column is transformed twice in {encoded}")
        twice = sorted(set(encoded) & set(self.map_file_ids))
        if twice:
            raise ValueError(f"crossing(s) {twice} have both a mapfile and a transform")
        layout = self.all_columns()
        if len(set(layout)) != len(layout):
            raise ValueError(f"an output column repeats in {layout}")
        for f in self.formats:
            _known(f.columns, layout, f"format {f.name}")
            _known(f.dropout, f.columns, f"dropout of format {f.name}")
        if self.draws_rows() and not self.key:
            raise ValueError("sampling and noise need a row key, as the rows are read more than once")


def _settled(config: Mapping, block: str) -> None:
    unknown = sorted(set(config) - set(_SETTINGS[block].split()))
    if unknown:
        raise ValueError(f"{block}: unknown setting(s) {unknown}; have {_SETTINGS[block].split()}")


def _known(names, columns, where: str) -> None:
    unknown = [n for n in names if n not in columns]
    if unknown:
        raise ValueError(f"{where}: unknown column(s) {unknown}; have {list(columns)}")


def _names(value) -> tuple[str, ...]:
    pieces = value.split(",") if isinstance(value, str) else value
    return tuple(p.strip() for p in pieces if p.strip())


def _partial(config: Mapping) -> Partial:
    columns, types = _names(config["columns"]), _names(config["type"])
    if len(columns) != len(types):
        raise ValueError(f"partial {config['name']}: {len(columns)} columns but {len(types)} types")
    unknown = sorted(set(types) - {"s", "f"})
    if unknown:
        raise ValueError(f"partial {config['name']}: unknown type(s) {unknown}")
    return Partial(
        name=config["name"],
        table=config["table"],
        columns=columns,
        types=types,
        convert=float(config.get("convert", 100000)),
        since=config.get("dtfrom"),
        since_column=config.get("dt_column", "dt"),
        join_keys=_names(config.get("joint", "pvid,deliver_id")),
        join_type=config.get("join_type", "left"),
        defaults=config.get("default_values", {}),
    )


def _noises(config: Mapping) -> list[Noise]:
    columns, to = _names(config["columns"]), _names(config["to"])
    values = _names(config["value"])
    if len(values) == 1:
        values *= len(columns)
    if not len(columns) == len(to) == len(values):
        raise ValueError("noise: columns, to and value differ in length")
    return [Noise(c, t, v, float(config["factor"])) for c, t, v in zip(columns, to, values)]


def _cross(config: Mapping) -> Cross:
    least = int(config.get("least", 1))
    if least < 1:
        raise ValueError(f"intersect: least is {least}")
    columns, bundle = _names(config["columns"]), _names(config.get("fix_bundle", ()))
    return Cross(columns, int(config.get("factor", 2)), bundle, config.get("mapfile"), config.get("label"), least)


def _transform(config: Mapping) -> Transform:
    kind, columns = config["type"], _names(config["columns"])
    if kind not in (SIMPLE_INDEX, INTERVAL_INDEX):
        raise ValueError(f"unknown transform type {kind!r}")
    buckets = 0
    if kind == INTERVAL_INDEX:
        buckets = int(str(config["args"]).split(":")[0])
        if buckets < 1:
            raise ValueError(f"{kind} needs at least one bucket, not {buckets}")
    to = _names(config["to"]) if "to" in config else tuple(id_column(c) for c in columns)
    if len(to) != len(columns):
        raise ValueError(f"transform: {len(columns)} columns but {len(to)} outputs")
    mode = config.get("bucket_mode", EXACT)
    if mode not in BUCKET_MODES:
        raise ValueError(f"bucket_mode {mode!r} is not one of {BUCKET_MODES}")
    unseen = config.get("unseen_numbers", MISSING)
    if unseen not in UNSEEN:
        raise ValueError(f"unseen_numbers {unseen!r} is not one of {UNSEEN}")
    return Transform(kind, columns, to, buckets, config.get("label"), mode, unseen)


def _tree_filter(config: Mapping) -> TreeFilter:
    outputs = output_names(config["outputs"], config.get("output_num"))
    return TreeFilter(config["name"], config["inputs"], tuple(outputs), config["args"], int(config.get("offset", 0)))


def _format(config: Mapping) -> Format:
    columns = _names(config.get("columns", ()))
    random_columns = _names(config.get("random_column", ()))
    ratios = [float(r) for r in _names(str(config.get("random_ratio", "")))]
    if len(random_columns) != len(ratios):
        raise ValueError(f"format {config['name']}: random_column and random_ratio differ in length")
    if config["pattern"] != LIBSVM and not columns:
        raise ValueError(f"format {config['name']}: a template needs columns")
    return Format(
        name=config["name"],
        pattern=config["pattern"],
        columns=columns,
        dropout=dict(zip(random_columns, ratios)),
        residues=tuple(parse_residues(str(config.get("sample_index", "-1")))),
        validate_rate=float(config.get("validate_rate", 0)),
        on_missing=config.get("on_missing", "drop"),
        shuffle=bool(config.get("shuffle", False)),
        duplicate_positives=bool(config.get("duplicate_positives", False)),
        partitions=_count(config, "numreduces"),
    )


def _count(config: Mapping, name: str) -> int | None:
    if name not in config:
        return None
    count = int(config[name])
    if count < 1:
        raise ValueError(f"{name} of {config['name']} is {count}")
    return count
