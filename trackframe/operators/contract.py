"""The data contract: conform raw rows to the canonical schema and quarantine bad ones.

``enforce_contract`` returns ``(clean, rejects)``. Both come from one tagged
projection (fill + cast + reason in a single ``select``); a row is rejected
with the reason of the *first* rule it fails, in contract order. Nothing is
dropped silently.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from trackframe.functions.casts import parse_as
from trackframe.functions.expressions import is_finite

# The canonical respondent schema, in order.
CANONICAL_SCHEMA = StructType([
    StructField("respondent_id", StringType(), False),
    StructField("wave", IntegerType(), False),
    StructField("fieldwork_date", StringType(), True),
    StructField("region", StringType(), True),
    StructField("age_group", StringType(), True),
    StructField("weight", DoubleType(), True),
    StructField("nps_score", IntegerType(), True),
    StructField("satisfaction", IntegerType(), True),
    StructField("aware", IntegerType(), True),
    StructField("brand_used", StringType(), True),
])
CANONICAL_COLUMNS = [f.name for f in CANONICAL_SCHEMA.fields]
REJECT_REASON = "reject_reason"


@dataclass(frozen=True)
class Rule:
    """A validity rule on one column; null values are always tolerated."""

    column: str
    is_valid: Callable[[Column], Column]
    reason: str


@dataclass(frozen=True)
class Contract:
    """Target schema, required (non-null) columns and range rules, in priority order."""

    schema: StructType = CANONICAL_SCHEMA
    required: tuple[str, ...] = ("respondent_id", "wave")
    rules: tuple[Rule, ...] = field(default_factory=lambda: DEFAULT_RULES)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


# Rule order and reject reasons. The required-key checks come
# first and read "missing respondent_id" and "missing wave".
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("nps_score", lambda c: c.between(0, 10), "nps_score out of range 0-10"),
    Rule("satisfaction", lambda c: c.between(1, 5), "satisfaction out of range 1-5"),
    Rule("aware", lambda c: c.isin(0, 1), "aware not in {0,1}"),
    # NaN > 0 holds in Spark, so finiteness is tested explicitly.
    Rule("weight", lambda c: (c > 0) & is_finite(c), "weight not positive"),
)
CANONICAL_CONTRACT = Contract()


def _ref(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def match_columns(columns: Sequence[str], targets: Sequence[str]) -> dict[str, str]:
    """Map each target name to a raw column: exact first, else trimmed and case-insensitive."""
    exact = set(columns)
    loose: dict[str, str] = {}
    for c in columns:
        loose.setdefault(c.strip().lower(), c)
    found = {}
    for t in targets:
        if t in exact:
            found[t] = t
        elif t.lower() in loose:
            found[t] = loose[t.lower()]
    return found


def conform(df: DataFrame, schema: StructType = CANONICAL_SCHEMA) -> tuple[list[Column], dict[str, tuple[Column, DataType]]]:
    """Projection list that fills, casts and orders the contract columns.

    Returns the typed columns and, per column, the raw value with its type
    (used by strict parsing and by the raw side-output of rejects).
    """
    present = match_columns(df.columns, [f.name for f in schema.fields])
    types = {f.name: f.dataType for f in df.schema.fields}
    typed, raw = [], {}
    for f in schema.fields:
        if f.name in present:
            src = present[f.name]
            raw[f.name] = (_ref(src), types[src])
            typed.append(parse_as(_ref(src), types[src], f.dataType).alias(f.name))
        else:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
    return typed, raw


def reject_reason(contract: Contract = CANONICAL_CONTRACT, parse_checks: Sequence[tuple[Column, str]] = ()) -> Column:
    """First failing rule's reason, or null for a clean row.

    Priority: required columns, then parse failures (strict mode), then the
    range rules in contract order.
    """
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in contract.required]
    checks += [F.when(bad, F.lit(msg)) for bad, msg in parse_checks]
    checks += [
        F.when(F.col(r.column).isNotNull() & ~r.is_valid(F.col(r.column)), F.lit(r.reason))
        for r in contract.rules
    ]
    return F.coalesce(*checks, F.lit(None).cast("string")) if checks else F.lit(None).cast("string")


def tag_rows(
    df: DataFrame,
    contract: Contract = CANONICAL_CONTRACT,
    *,
    strict_parse: bool = False,
    keep_raw: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Canonical columns plus ``reject_reason`` (null = clean), from one projection.

    ``strict_parse`` rejects non-empty text that does not parse as its column
    type (``<col> not parseable``) instead of letting it become a tolerated
    null. ``keep_raw`` adds a ``raw`` struct of the original text values.
    ``carry`` passes extra input columns through unchanged (e.g. lineage).
    """
    typed, raw = conform(df, contract.schema)
    # The raw struct always has every contract column (text, null if absent),
    # so frames of different headers union cleanly.
    raw_struct = F.struct(*[(raw[c][0].cast("string") if c in raw else F.lit(None).cast("string")).alias(c)
                            for c in contract.columns])
    base = df.select(*typed, *[_ref(c) for c in carry],
                     *([raw_struct.alias("raw")] if keep_raw else []),
                     *[v.alias(f"__raw_{k}") for k, (v, t) in raw.items()
                       if strict_parse and isinstance(t, StringType)])
    parse_checks = []
    if strict_parse:
        for f in contract.schema.fields:
            if f.name in raw and isinstance(raw[f.name][1], StringType) and not isinstance(f.dataType, StringType):
                text = F.trim(F.col(f"__raw_{f.name}"))
                parse_checks.append(((text != "") & F.col(f.name).isNull(), f"{f.name} not parseable"))
    extra = ["raw"] if keep_raw else []
    return base.select(*contract.columns, *carry, *extra,
                       reject_reason(contract, parse_checks).alias(REJECT_REASON))


def keep_rows(df: DataFrame, cond: Column) -> DataFrame:
    """Rows of ``df`` where ``cond`` (over ``df``'s own columns) is true, decided after ``df`` is computed.

    A plain ``where`` is pushed below the projection that builds the tagged
    columns, and Catalyst then inlines every cast into the predicate once per
    rule that reads it: the generated filter grows past the JIT's method limit
    and runs interpreted (6x slower on the contract). Exploding a one-element
    array that is null for unwanted rows drops them in a ``Generate`` on top of
    the projection, where each cast is computed once.
    """
    flag = "__keep"
    return (df.select("*", F.explode(F.when(cond, F.array(F.lit(True)))).alias(flag))
            .drop(flag))


def split_tagged(tagged: DataFrame, columns: Sequence[str] = CANONICAL_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejects)`` from a tagged frame: two row filters over the same plan."""
    clean = keep_rows(tagged, F.col(REJECT_REASON).isNull()).select(*columns)
    rejects = keep_rows(tagged, F.col(REJECT_REASON).isNotNull())
    return clean, rejects


def enforce_contract(
    df: DataFrame,
    contract: Contract = CANONICAL_CONTRACT,
    *,
    strict_parse: bool = False,
    keep_raw: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Conform ``df`` to the contract; return ``(clean, rejects)``.

    ``clean`` has exactly the contract columns in order; ``rejects`` has them
    (cast values) plus ``reject_reason``. Missing columns are typed nulls,
    names match exactly or else trimmed and case-insensitively, extra columns
    are dropped. Unparseable optional values become null and are tolerated
    unless ``strict_parse``.
    """
    tagged = tag_rows(df, contract, strict_parse=strict_parse, keep_raw=keep_raw)
    return split_tagged(tagged, contract.columns)
