"""Harmonise: make every wave use the same column names and value codes.

Renames are resolved on the driver over the column *list* (metadata only) and
applied together with trims and value recodes in a single ``select``, so the
logical plan stays one projection however many rules there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from trackframe.functions.expressions import recode

# The string columns whose stray whitespace is trimmed.
TRIM_COLUMNS = ("region", "age_group", "brand_used")


def resolve_renames(columns: Sequence[str], rename_map: Mapping[str, str] | None) -> list[str]:
    """Header after the rename entries, taken in map order.

    Names match as the contract matches them: trimmed and without regard to
    case. A source that is missing, or a target that another column already
    has, leaves the header alone, so a canonical column is never clobbered.
    Entries chain (a->b, then b->c).
    """
    loose = [c.strip().lower() for c in columns]
    out = list(columns)
    for source, target in (rename_map or {}).items():
        old, new = source.strip().lower(), target.strip().lower()
        holders = [i for i, c in enumerate(loose) if c == old]
        taken = any(c == new for i, c in enumerate(loose) if i not in holders[:1])
        if holders and not taken:
            out[holders[0]], loose[holders[0]] = target, new
    return out


def _ref(name: str):
    return F.col(f"`{name.replace('`', '``')}`")


def harmonise(
    df: DataFrame,
    rename_map: Mapping[str, str] | None = None,
    region_map: Mapping[str, str] | None = None,
    *,
    recode_maps: Mapping[str, Mapping[str, str]] | None = None,
    trim_columns: Iterable[str] = TRIM_COLUMNS,
) -> DataFrame:
    """Rename columns, trim key string columns and recode values, in one projection.

    Order per column: rename, then trim, then recode (the recode sees the
    trimmed value). Renames, trims and recodes match column names trimmed and
    case-insensitively, as the contract does.
    ``region_map`` is shorthand for ``recode_maps["region"]``. With empty maps
    the frame comes back with the same columns and values.
    """
    maps = {c.lower(): m for c, m in (recode_maps or {}).items() if m}
    if region_map:
        maps["region"] = {**maps.get("region", {}), **region_map}
    trims = {c.lower() for c in trim_columns}
    new_names = resolve_renames(df.columns, rename_map)
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for old, new in zip(df.columns, new_names):
        c, key = _ref(old), new.strip().lower()
        if key in trims and isinstance(types[old], StringType):
            c = F.trim(c)
        if key in maps:
            c = recode(c, maps[key])
        exprs.append(c.alias(new))
    return df.select(*exprs)


def recode_lookup(df: DataFrame, column: str, lookup: DataFrame, code_col: str, value_col: str) -> DataFrame:
    """``df`` with ``column`` recoded by a table of codes; codes that are not in it (and null) pass through.

    For code lists too large for a literal map: one equi-join without a hint on the trimmed value, so that
    Catalyst and AQE choose its strategy by size. Rows neither multiply nor go: a code with one value in several rows
    counts once, one with different values is an error when the result is computed. A null value
    or code in the table recodes nothing. Extra columns of the table are ignored.
    """
    code, value = F.col(code_col).cast("string"), F.col(value_col).cast("string")
    clash = F.raise_error(F.concat(F.lit(f"different values in the recode table of {column} for code "), F.col("__code")))
    table = (lookup.select(F.trim(code).alias("__code"), value.alias("__value")).dropna()
             .groupBy("__code").agg(F.min("__value").alias("__value"), F.max("__value").alias("__other"))
             .select("__code", F.when(F.col("__value") == F.col("__other"), F.col("__value")).otherwise(clash.cast("string")).alias("__value")))
    name = next((c for c in df.columns if c.strip().lower() == column.strip().lower()), None)
    if name is None:
        return df
    joined = df.join(table, F.trim(_ref(name).cast("string")) == F.col("__code"), "left")
    return joined.select(*[F.coalesce("__value", F.trim(_ref(c).cast("string"))).alias(c) if c == name else _ref(c) for c in df.columns])
