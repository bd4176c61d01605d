"""A table of documents together with its declared fields."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftframe.sources.mapping import Field, Mapping


@dataclass(frozen=True)
class Slot:
    """A field resolved against a table: its column, type and declaration."""

    name: str
    column: Column
    type: T.DataType
    spec: Field | None
    stored_tokens: Column | None = None
    inside: bool = False  # the column belongs to a lambda

    @property
    def is_text(self) -> bool:
        return self.spec is not None and self.spec.is_text

    @property
    def is_array(self) -> bool:
        return isinstance(self.type, T.ArrayType)

    def tokens(self) -> Column:
        """Analysed words; the values of a list field are analysed one by one."""
        if self.stored_tokens is not None:
            return self.stored_tokens
        if self.is_array:
            return F.flatten(F.transform(self.column, self.spec.chain.tokens_inside))
        return self.spec.chain.tokens_inside(self.column) if self.inside else self.spec.chain.tokens(self.column)

    def terms(self) -> Column:
        """What exact conditions compare with: the tokens of a text field, the
        elements of a list, the value itself otherwise."""
        return self.tokens() if self.is_text else self.column

    @property
    def many(self) -> bool:
        return self.is_text or self.is_array


@dataclass(frozen=True)
class Scope:
    """Resolves field names. The inside of a nested condition is a scope over
    one element of the list instead of over the row."""

    mapping: Mapping
    schema: T.StructType
    element: Column | None = None
    prefix: str = ""

    def slot(self, path: str) -> Slot:
        inner = path[len(self.prefix) + 1:] if self.prefix and path.startswith(self.prefix + ".") else path
        declared = f"{self.prefix}.{inner}" if self.prefix else inner
        spec = self.mapping.lookup(declared) or self.mapping.lookup(inner)
        if spec is not None and not spec.index:
            raise ValueError(f"field {path} is declared as not searchable")
        name = self.mapping.column_name(inner)
        column, dtype = self._walk(name)
        stored = None
        if self.element is None and f"{name}__tokens" in self.schema.names:
            stored = F.col(f"`{name}__tokens`")
        return Slot(path, column, dtype, spec, stored, self.element is not None)

    def _walk(self, name: str) -> tuple[Column, T.DataType]:
        parts = [name] if name in self.schema.names else name.split(".")
        column, dtype = self.element, self.schema
        for i, part in enumerate(parts):
            listed = isinstance(dtype, T.ArrayType)
            inner = dtype.elementType if listed else dtype
            if isinstance(inner, T.MapType):
                key = ".".join(parts[i:])
                return F.element_at(column, F.lit(key)), inner.valueType
            if not isinstance(inner, T.StructType) or part not in inner.names:
                raise ValueError(f"no such field: {name}")
            column = F.col(f"`{part}`") if column is None else column.getField(part)
            dtype = T.ArrayType(inner[part].dataType) if listed else inner[part].dataType
        return column, dtype

    def inside(self, path: str, element: Column) -> "Scope":
        dtype = self.slot(path).type
        if not (isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)):
            raise ValueError(f"{path} is not a list of objects")
        return replace(self, schema=dtype.elementType, element=element, prefix=path)


@dataclass(frozen=True)
class Collection:
    """Rows plus mapping. ``id`` names the column that identifies a row and
    breaks every tie."""

    df: DataFrame
    mapping: Mapping = field(default_factory=Mapping)
    id: str = "_id"

    @property
    def scope(self) -> Scope:
        return Scope(self.mapping, self.df.schema)

    def with_df(self, df: DataFrame) -> "Collection":
        return replace(self, df=df)
