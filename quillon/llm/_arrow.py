"""Columns added to a table by a function over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


MOST_GROUPS = 100_000  # whose numbers of texts are broadcast


def add_columns(
    df: DataFrame, inputs: dict[str, Column], new: dict[str, str], make: Callable[[], Callable[[dict[str, pa.Array]], dict[str, object]]]
) -> DataFrame:
    """``df`` with the columns ``new`` (name to type), computed batch by batch.

    ``make`` runs once a task and returns the function that maps the arrays
    named in ``inputs`` to the new ones.  All columns of ``df`` travel inside
    one struct, so their names cannot clash with the inputs.
    """
    keep = [c for c in df.columns if c not in new]
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.struct(*[c.alias(n) for n, c in inputs.items()]).alias("in"))
    out = T.StructType([T.StructField("row", packed.schema["row"].dataType)] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in new.items()])

    names = list(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                given = batch.column(1)
                got = work({n: given.field(n) for n in names})
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(got[n], _ARROW[t]) for n, t in new.items()]], ["row", *new])

    return packed.mapInArrow(run, out).select("row.*", *new)


def fold(key: Column | str, folds: int) -> Column:
    """CRC-32 of a key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string") if isinstance(key, str) else key, F.lit("")).cast("binary")) % folds


def text_order(seed: int) -> Column:
    """The hash of ``text`` by whose ``place_of`` samples are ordered."""
    return F.xxhash64(F.lit(seed), "text")


def place_of(order: str) -> Column:
    return F.shiftrightunsigned(order, 11)


def sampled_texts(rows: DataFrame, groups: list[str], per_group: int, seed: int, value: Column) -> DataFrame:
    """``groups``, ``o`` and ``value`` of at most ``per_group`` distinct texts of each group: those of the smallest hashes ``o``.

    Copies of a text count once, so a hot text takes one place.  A share of the
    hash range that holds half as many again is cut out first, by the number of
    distinct texts of each group; what is ranked in one task is bounded by it.
    """
    order = text_order(seed)
    distinct = rows.select(*groups, order.alias("o")).distinct()
    hashed = rows.select(*groups, order.alias("o"), value.alias("value"))
    if groups:
        sizes = distinct.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).withColumnsRenamed({g: f"_{g}" for g in groups})
        small = sizes.limit(MOST_GROUPS + 1).toArrow()
        if small.num_rows <= MOST_GROUPS:  # else the table is joined by a shuffle
            sizes = F.broadcast(rows.sparkSession.createDataFrame(small.to_pylist() or [], sizes.schema))
        hashed = hashed.join(sizes, [F.col(g) == F.col(f"_{g}") for g in groups])
    else:
        hashed = hashed.withColumn("_n", F.lit(distinct.count()))
    place = place_of("o")
    inside = place.cast("double") * F.lit(2.0**-53) * F.col("_n") < 1.5 * per_group + 50
    once = hashed.where(inside).groupBy(*groups, "o").agg(F.min("value").alias("value"))
    if not groups:
        return once.orderBy(place, "o").limit(per_group)
    ranked = once.withColumn("_r", F.row_number().over(Window.partitionBy(*groups).orderBy(place, "o")))
    return ranked.where(F.col("_r") <= per_group).select(*groups, "o", "value")
