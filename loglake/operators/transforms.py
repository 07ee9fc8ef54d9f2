"""Reshaping of events, in the fixed order drop, scrub, add, shape, sample."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.operators.lines import over


# Columns of the row itself. A field of the event may have the same name; it is then in a map.
ROW_COLUMNS = ("file", "block", "pos", "value", "reject_reason", "data", "extra", "prefix", "sample_rate")
FIELD_MAPS = ("data", "extra", "prefix")


def _kept(df: DataFrame) -> tuple[str, ...]:
    """Columns that are no event fields; only parsed log rows have more than the maps."""
    return ROW_COLUMNS if "reject_reason" in df.columns else FIELD_MAPS


def drop_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Remove event columns, and keys of the maps of fields, where present."""
    out = df.drop(*[n for n in names if n in df.columns and n not in _kept(df)])
    for name in [m for m in FIELD_MAPS if m in df.columns and names]:
        out = out.withColumn(name, F.map_filter(name, lambda k, v: ~k.isin(*names)))
    return out


def scrub_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace values by the hex SHA-256 of their text; absent stays absent.

    A nested value is hashed as its JSON text. Rejected lines keep their raw text.
    """
    out = df
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for name in names:
        if name in kinds and name not in _kept(df):
            out = out.withColumn(name, _hashed(F.col(f"`{name}`"), kinds[name].typeName()))
    for name in [m for m in FIELD_MAPS if m in kinds and names]:
        kind = kinds[name].valueType.typeName()
        out = out.withColumn(
            name, F.transform_values(name, lambda k, v: F.when(k.isin(*names), _hashed(v, kind)).otherwise(v))
        )
    return out


def _hashed(value: Column, kind: str) -> Column:
    if kind == "variant":
        text = F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))
        return F.sha2(text, 256).cast("variant")
    nested = kind in ("array", "map", "struct")
    return F.sha2(F.to_json(value) if nested else value.cast("string"), 256)


def add_fields(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Constant fields; they overwrite."""
    if not values:
        return df
    if "data" in df.columns:
        pairs = [F.lit(x) for item in values.items() for x in item]
        return df.withColumn("data", over(F.col("data"), F.create_map(*pairs)))
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def promote_fields(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Keys of the ``data`` map as typed columns; what does not fit its type stays in the map.

    The rest of the map is pruned from reads that want the columns alone. A name that
    differs from a column, or from another name, by case only stays in the map.
    """
    taken = {c.lower() for c in df.columns}
    chosen: dict[str, Column] = {}
    for name, kind in types.items():
        if name.lower() not in taken:
            taken.add(name.lower())
            chosen[name] = F.element_at("data", F.lit(name)).cast("string").try_cast(kind)
    if not chosen:
        return df
    typed = df.withColumns(chosen)
    fitted = F.array_compact(F.array(*[F.when(F.col(f"`{n}`").isNotNull(), F.lit(n)) for n in chosen]))
    return typed.withColumn("data", F.map_filter("data", lambda k, v: ~F.array_contains(fitted, k)))


def split_namespace(df: DataFrame, field: str = "namespace") -> DataFrame:
    """``db.coll…`` at the first dot; without a dot neither field is set."""
    parts = F.split(F.col(field), r"\.", 2)
    both = F.size(parts) == 2
    return df.withColumns({
        "database": F.when(both, F.get(parts, F.lit(0))),
        "collection": F.when(both, F.get(parts, F.lit(1))),
    })


def sample_key(fields: Sequence[Column]) -> Column:
    """Values joined by ``_``; a missing value counts as empty text."""
    return F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit("")) for c in fields])
