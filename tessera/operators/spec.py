"""What to index and how: the declarative document mapping."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

NUMERIC_TYPES = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


@dataclass(frozen=True)
class IndexSpec:
    """Field roles of an index.

    ``text``     analysed strings: lower-cased, split into tokens, scored BM25.
    ``keyword``  exact strings (or arrays of strings): one term per value.
    ``numeric``  int / bigint / float / double (or arrays of them): exact match,
                 constant score; kept as columns of ``docs``.
    ``stored``   columns returned with hits; may be any type (timestamps,
                 structs, ...), but only the roles above can be searched.

    A custom document mapping is any ``df.select(...)`` (or ``mapInPandas``)
    before :func:`tessera.build_index`.
    """

    text: tuple = field(default_factory=tuple)
    keyword: tuple = field(default_factory=tuple)
    numeric: tuple = field(default_factory=tuple)
    stored: tuple = field(default_factory=tuple)

    def __init__(self, text=(), keyword=(), numeric=(), stored=()):
        for name, value in (("text", text), ("keyword", keyword), ("numeric", numeric), ("stored", stored)):
            if isinstance(value, str):
                value = (value,)
            object.__setattr__(self, name, tuple(value))
        roles = list(self.text) + list(self.keyword) + list(self.numeric)
        if len(set(roles)) != len(roles):
            raise ValueError("a field may have only one of the roles text / keyword / numeric")
        for reserved in ("shard", "doc", "score", "rank", "gen", "bucket", "doc_range", "query_id"):
            if reserved in roles or reserved in self.stored:
                raise ValueError(f"'{reserved}' is a reserved column name")

    @property
    def indexed(self) -> tuple:
        """Fields that go to postings (text and keyword)."""
        return self.text + self.keyword

    @property
    def columns(self) -> tuple:
        """Every input column the index keeps, in a stable order."""
        seen: list[str] = []
        for c in self.stored + self.text + self.keyword + self.numeric:
            if c not in seen:
                seen.append(c)
        return tuple(seen)

    @property
    def doc_columns(self) -> tuple:
        """Columns of ``docs`` visible to readers: stored plus numeric."""
        seen: list[str] = []
        for c in self.stored + self.numeric:
            if c not in seen:
                seen.append(c)
        return tuple(seen)

    def kind(self, name: str) -> str | None:
        if name in self.text:
            return "text"
        if name in self.keyword:
            return "keyword"
        if name in self.numeric:
            return "numeric"
        return None

    def validate(self, schema: T.StructType) -> None:
        by_name = {f.name: f.dataType for f in schema.fields}
        for c in self.columns:
            if c not in by_name:
                raise ValueError(f"column '{c}' of the spec is not in the input")
        for c in self.text + self.keyword:
            dt = by_name[c]
            base = dt.elementType if isinstance(dt, T.ArrayType) else dt
            if not isinstance(base, T.StringType):
                raise TypeError(f"text / keyword field '{c}' must be string or array<string>, got {dt.simpleString()}")
        for c in self.numeric:
            dt = by_name[c]
            base = dt.elementType if isinstance(dt, T.ArrayType) else dt
            if not isinstance(base, NUMERIC_TYPES):
                raise TypeError(f"numeric field '{c}' must be int, bigint, float or double, got {dt.simpleString()}")

    def to_dict(self) -> dict:
        return {"text": list(self.text), "keyword": list(self.keyword),
                "numeric": list(self.numeric), "stored": list(self.stored)}

    @classmethod
    def from_dict(cls, d: dict) -> "IndexSpec":
        return cls(text=d.get("text", ()), keyword=d.get("keyword", ()),
                   numeric=d.get("numeric", ()), stored=d.get("stored", ()))
