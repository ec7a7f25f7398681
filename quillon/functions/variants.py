"""Values of any JSON type as variants: keys that are there, types, truth, and objects rebuilt field by field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(v: Column, key: str) -> Column:
    """The value of a key: null where the key is absent, a variant null where it is null."""
    return F.try_variant_get(v, f"$.{key}", "variant")


def there(v: Column) -> Column:
    """Neither absent nor null."""
    return v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(True))


def is_a(v: Column, kind: str) -> Column:
    """Whether the value is a STRING, ARRAY, OBJECT or BOOLEAN; false where it is absent."""
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit(kind)), F.lit(False))


def truthy(v: Column) -> Column:
    """Whether the value is there and not empty, zero or false."""
    return F.coalesce(there(v) & ~F.to_json(v).isin('""', "0", "0.0", "-0.0", "false", "[]", "{}"), F.lit(False))


def text_of(v: Column) -> Column:
    """The text of a string, else null."""
    return F.when(is_a(v, "STRING"), F.try_variant_get(v, "$", "string"))


def quoted(x: Column) -> Column:
    """A text as a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(x.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def members(v: Column) -> Column:
    """The elements of a list, else null."""
    return F.when(is_a(v, "ARRAY"), F.try_variant_get(v, "$", "array<variant>"))


def json_object(*pairs: tuple[str, Column]) -> Column:
    """Compact JSON text of an object with the pairs whose value, a JSON text, is not null, in order."""
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*[F.concat(F.lit(f'"{k}":'), x) for k, x in pairs])), ","), F.lit("}"))


def json_array(items: Column) -> Column:
    """Compact JSON text of a list of JSON texts."""
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
