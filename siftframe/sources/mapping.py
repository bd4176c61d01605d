"""Declared schemas: field types, field options, and applying them to raw rows."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.functions.analysis import AS_YOU_TYPE, STANDARD, Analyzer, named_analyzer

# Declared type name -> Spark type. ``scaled_float``, ``object``
# and ``nested`` depend on options and are resolved in ``Field.spark_type``.
SPARK_TYPES = {
    "text": "string",
    "keyword": "string",
    "byte": "tinyint",
    "short": "smallint",
    "integer": "int",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "half_float": "float",
    "unsigned_long": "decimal(20,0)",
    "date": "timestamp_ntz",
    "date_nanos": "bigint",
    "boolean": "boolean",
    "binary": "binary",
    "integer_range": "struct<gte:int,lte:int>",
    "long_range": "struct<gte:bigint,lte:bigint>",
    "float_range": "struct<gte:float,lte:float>",
    "double_range": "struct<gte:double,lte:double>",
    "date_range": "struct<gte:timestamp_ntz,lte:timestamp_ntz>",
    "ip": "string",
    "ip_range": "string",
    "flattened": "map<string,string>",
    "geo_point": "struct<lat:double,lon:double>",
    "completion": "string",
    "search_as_you_type": "string",
    "token_count": "int",
    "rank_feature": "double",
    "rank_features": "map<string,float>",
    "dense_vector": "array<float>",
    "sparse_vector": "map<string,float>",
    "histogram": "struct<values:array<double>,counts:array<bigint>>",
    "join": "string",
}

_TEXTUAL = {"text", "completion", "search_as_you_type"}
_JSON_TYPES = {
    "integer_range", "long_range", "float_range", "double_range", "date_range",
    "flattened", "geo_point", "rank_features", "dense_vector", "sparse_vector",
    "histogram",
}


@dataclass(frozen=True)
class Field:
    """One declared field and its options."""

    type: str
    analyzer: str | Analyzer = STANDARD
    index: bool = True
    formats: tuple[str, ...] = ()
    fields: dict[str, "Field"] = field(default_factory=dict)
    properties: dict[str, "Field"] = field(default_factory=dict)
    ignore_above: int | None = None
    scaling_factor: int = 100
    path: str | None = None  # target of an ``alias``, source text of a ``token_count``

    def __post_init__(self):
        known = self.type in SPARK_TYPES or self.type in ("scaled_float", "object", "nested", "alias")
        if not known:
            raise ValueError(f"unknown field type: {self.type}")

    @property
    def is_text(self) -> bool:
        return self.type in _TEXTUAL

    @property
    def chain(self) -> Analyzer:
        if self.type in ("completion", "search_as_you_type") and self.analyzer is STANDARD:
            return AS_YOU_TYPE
        return named_analyzer(self.analyzer) if isinstance(self.analyzer, str) else self.analyzer

    def spark_type(self) -> str:
        if self.type == "scaled_float":
            return f"decimal(18,{len(str(self.scaling_factor)) - 1})"
        if self.type in ("object", "nested"):
            inner = ",".join(f"`{n}`:{f.spark_type()}" for n, f in self.properties.items())
            return f"struct<{inner}>" if self.type == "object" else f"array<struct<{inner}>>"
        return SPARK_TYPES[self.type]


@dataclass(frozen=True)
class Mapping:
    """Declared fields by name. Fields that are not declared keep whatever type
    the table has and count as not analysed."""

    fields: dict[str, Field] = field(default_factory=dict)

    def lookup(self, path: str) -> Field | None:
        """The declaration behind a dotted path: ``user.name`` walks into an
        object, ``title.keyword`` or ``title__keyword`` picks a multi-field."""
        if path in self.fields:
            found = self.fields[path]
            return self.lookup(found.path) if found.type == "alias" else found
        head, _, rest = path.partition(".")
        parent = self.fields.get(head)
        for name in rest.split(".") if parent and rest else []:
            parent = parent.properties.get(name) or parent.fields.get(name)
            if parent is None:
                return None
        if parent is not None and rest:
            return parent
        base, sep, sub = path.partition("__")
        if sep and base in self.fields:
            return self.fields[base].fields.get(sub)
        return None

    def column_name(self, path: str) -> str:
        """Physical column of a path: aliases are followed and a multi-field
        ``title.keyword`` is the column ``title__keyword``."""
        found = self.fields.get(path)
        if found is not None and found.type == "alias":
            return self.column_name(found.path)
        head, _, rest = path.partition(".")
        if rest and head in self.fields and rest in self.fields[head].fields:
            return f"{head}__{rest}"
        return path

    def extended(self, more: dict[str, Field]) -> "Mapping":
        """Later fields are additive; changing the type of a field is refused."""
        for name, new in more.items():
            old = self.fields.get(name)
            if old is not None and old.type != new.type:
                raise ValueError(f"field {name} is {old.type}, cannot become {new.type}")
        return Mapping({**self.fields, **more})


def parse_dates(c: Column, formats: tuple[str, ...]) -> Column:
    """First format that parses wins; ``epoch_millis`` and ``epoch_second`` are
    numbers. The result has no time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    attempts = []
    for fmt in formats:
        if fmt in ("epoch_millis", "epoch_second"):
            unit = "MILLISECOND" if fmt == "epoch_millis" else "SECOND"
            attempts.append(F.timestamp_add(unit, c.try_cast("bigint"), epoch))
        else:
            attempts.append(F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz"))
    return F.coalesce(*attempts) if attempts else c.try_cast("timestamp_ntz")


def _parsed(c: Column, source: T.DataType, spec: Field) -> Column:
    target = spec.spark_type()
    if spec.type == "date":
        return parse_dates(c, spec.formats) if isinstance(source, T.StringType) else c.cast(target)
    if not isinstance(source, T.StringType):
        return c.cast(target) if isinstance(source, (T.StructType, T.ArrayType, T.MapType)) else c.try_cast(target)
    if spec.type == "binary":
        return F.try_to_binary(c, F.lit("base64"))
    if spec.type in ("object", "nested") or spec.type in _JSON_TYPES:
        return F.from_json(c, target)
    return c if target == "string" else F.trim(c).try_cast(target)


def apply_mapping(df: DataFrame, mapping: Mapping, ignored: str = "_ignored", observation=None) -> DataFrame:
    """Cast raw columns to their declared types in one projection.

    A value that does not parse becomes null and its field name is listed in
    the ``ignored`` array. With an ``Observation`` the number of bad values per
    field is counted while the rows pass, at no extra scan.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    kept = [F.col(n) for n in df.columns if n not in mapping.fields]
    out, bad = [], []
    for name, spec in mapping.fields.items():
        if spec.type == "alias":
            continue
        if spec.type == "token_count":
            source = spec.path or name
            tokens = spec.chain.tokens(F.col(source))
            out.append(F.when(F.col(source).isNotNull(), F.size(tokens)).alias(name))
            continue
        if name not in types:
            out.append(F.lit(None).cast(spec.spark_type()).alias(name))
            continue
        value = _parsed(F.col(name), types[name], spec)
        out.append(value.alias(name))
        for sub, sub_spec in spec.fields.items():
            out.append(_sub_field(F.col(name), types[name], sub_spec).alias(f"{name}__{sub}"))
        bad.append((name, F.col(name).isNotNull() & value.isNull()))
    names = F.filter(F.array(*[F.when(b, F.lit(n)) for n, b in bad]), lambda n: n.isNotNull()) if bad else None
    result = df.select(*kept, *out, *([names.alias(ignored)] if bad else []))
    aliases = {n: F.col(mapping.column_name(f.path)) for n, f in mapping.fields.items() if f.type == "alias"}
    result = result.withColumns(aliases) if aliases else result
    if observation is not None and bad:
        counts = [F.count_if(F.array_contains(ignored, n)).alias(n) for n, _ in bad]
        result = result.observe(observation, *counts)
    return result


def _sub_field(c: Column, source: T.DataType, spec: Field) -> Column:
    if spec.type == "token_count":
        return F.when(c.isNotNull(), F.size(spec.chain.tokens(c)))
    value = _parsed(c, source, spec)
    return limit_keyword(value, spec.ignore_above) if spec.ignore_above else value


def limit_keyword(c: Column, ignore_above: int) -> Column:
    """Keyword values longer than the limit are not searchable."""
    return F.when(F.length(c) <= ignore_above, c)


def with_multi_fields(df: DataFrame, mapping: Mapping) -> DataFrame:
    """Add the ``field__sub`` columns of every declared multi-field."""
    types = {f.name: f.dataType for f in df.schema.fields}
    extra = {
        f"{name}__{sub}": _sub_field(F.col(name), types[name], sub_spec)
        for name, spec in mapping.fields.items()
        for sub, sub_spec in spec.fields.items()
        if name in types
    }
    return df.withColumns(extra) if extra else df


def with_tokens(df: DataFrame, mapping: Mapping, *names: str) -> DataFrame:
    """Store the analysed words of text fields as ``field__tokens`` so that a
    written table is analysed once rather than at every query."""
    chosen = names or [n for n, f in mapping.fields.items() if f.is_text and n in df.columns]
    return df.withColumns({f"{n}__tokens": mapping.lookup(n).chain.tokens(F.col(n)) for n in chosen})


def extend_mapping(df: DataFrame, mapping: Mapping, more: dict[str, Field]) -> tuple[DataFrame, Mapping]:
    """Add declared fields to a table that lacks them; old rows hold null."""
    wider = mapping.extended(more)
    missing = {n: F.lit(None).cast(f.spark_type()) for n, f in more.items() if n not in df.columns}
    return (df.withColumns(missing) if missing else df), wider


def append_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of two mapping versions in one table; absent fields are null."""
    return table.unionByName(rows, allowMissingColumns=True)


def unsearchable(spec: Field) -> Field:
    """The same field with searching switched off."""
    return replace(spec, index=False)
