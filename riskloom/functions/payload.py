"""JSON payload columns: packing, parsing and typed extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_pack(fields: dict[str, Column]) -> Column:
    """One JSON object per row; keys may contain dots."""
    return F.to_json(F.struct(*[value.alias(key) for key, value in fields.items()]))


def json_parse_map(payload) -> Column:
    payload = F.col(payload) if isinstance(payload, str) else payload
    return F.from_json(payload, T.MapType(T.StringType(), T.StringType()))


def json_put(payload_map: Column, key: str, value: Column) -> Column:
    """Add a key to a parsed payload, replacing the key when present."""
    kept = F.map_filter(payload_map, lambda k, _: k != F.lit(key))
    return F.map_concat(kept, F.create_map(F.lit(key), value.cast("string")))


def json_extract(
    df: DataFrame, payload: str, fields: dict[str, tuple[str, str]], keep: list[Column] = ()
) -> DataFrame:
    """Typed columns from a JSON object column.

    ``fields`` maps output name -> (exact JSON key, Spark type). The object is parsed once, into a
    struct of texts, whatever the number of fields: as a generator the parse is never copied into
    the expressions or filters above it. Each text is cast with ``try_cast``, so a malformed value
    becomes NULL instead of failing the job, and so does every field of a malformed object.
    """
    keys = list(dict.fromkeys(key for key, _ in fields.values()))
    carried = [column if isinstance(column, Column) else F.col(column) for column in keep]
    schema = T.StructType([T.StructField(key, T.StringType()) for key in keys])
    read = df.select(*carried, F.inline(F.array(F.from_json(payload, schema))))
    kept = read.columns[: len(carried)]
    texts = dict(zip(keys, (f"_text{i}" for i in range(len(keys)))))
    read = read.toDF(*kept, *texts.values())
    return read.select(
        *[_named(name) for name in kept],
        *[F.col(texts[key]).try_cast(kind).alias(name) for name, (key, kind) in fields.items()],
    )


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
