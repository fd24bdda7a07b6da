"""DuckDB SQL twins of the adapters and operators, used as an independent oracle.

Only text generation lives here: the strings are run by DuckDB over the same
parquet files, never by Spark. Every computed column is aliased to the name
the Spark side uses, and every float is rounded the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

ORDERS_TRACKER = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS respondent_id,
       CAST(year(o.o_orderdate) - 1994 AS INTEGER) AS wave,
       CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS fieldwork_date,
       r.r_name AS region,
       o.o_orderpriority AS age_group,
       CASE WHEN o.o_orderkey % 17 <> 0 THEN o.o_totalprice / 100000.0 END AS weight,
       CASE WHEN o.o_orderkey % 13 <> 0 THEN CAST((o.o_orderkey * 7) % 11 AS INTEGER) END AS nps_score,
       CASE WHEN o.o_orderkey % 19 <> 0 THEN CAST(1 + (o.o_orderkey * 3) % 5 AS INTEGER) END AS satisfaction,
       CAST(CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS aware,
       c.c_mktsegment AS brand_used
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

# The dirty text view, already conformed: bad text replaced by what the
# contract casts it to. ``wave 'x'`` casts to null.
ORDERS_TRACKER_RAW_TYPED = f"""
SELECT CASE WHEN CAST(respondent_id AS BIGINT) % 101 <> 0 THEN respondent_id END AS respondent_id,
       CASE WHEN CAST(respondent_id AS BIGINT) % 103 = 0 THEN NULL ELSE wave END AS wave,
       fieldwork_date, region, age_group,
       CASE WHEN CAST(respondent_id AS BIGINT) % 89 = 0 THEN -1.0 ELSE weight END AS weight,
       CASE WHEN CAST(respondent_id AS BIGINT) % 97 = 0 THEN 99 ELSE nps_score END AS nps_score,
       CASE WHEN CAST(respondent_id AS BIGINT) % 83 = 0 THEN 7 ELSE satisfaction END AS satisfaction,
       CASE WHEN CAST(respondent_id AS BIGINT) % 79 = 0 THEN 2 ELSE aware END AS aware,
       brand_used
FROM ({ORDERS_TRACKER})
"""

# Reject reasons, in rule priority order.
REASON_SQL = """
CASE WHEN respondent_id IS NULL THEN 'missing respondent_id'
     WHEN wave IS NULL THEN 'missing wave'
     WHEN nps_score IS NOT NULL AND NOT (nps_score BETWEEN 0 AND 10) THEN 'nps_score out of range 0-10'
     WHEN satisfaction IS NOT NULL AND NOT (satisfaction BETWEEN 1 AND 5) THEN 'satisfaction out of range 1-5'
     WHEN aware IS NOT NULL AND aware NOT IN (0, 1) THEN 'aware not in {0,1}'
     WHEN weight IS NOT NULL AND NOT (weight > 0 AND isfinite(weight)) THEN 'weight not positive'
END"""

CANONICAL = ("respondent_id, wave, fieldwork_date, region, age_group, weight, "
             "nps_score, satisfaction, aware, brand_used")


def tagged(src: str) -> str:
    return f"SELECT {CANONICAL}, {REASON_SQL} AS reject_reason FROM ({src})"


def clean(src: str) -> str:
    return f"SELECT {CANONICAL} FROM ({tagged(src)}) WHERE reject_reason IS NULL"


def rejects(src: str) -> str:
    return f"SELECT * FROM ({tagged(src)}) WHERE reject_reason IS NOT NULL"


def features(src: str, promoter_min: int = 9, detractor_max: int = 6, top2box_min: int = 4) -> str:
    mean = "avg(weight) OVER (PARTITION BY wave)"
    return f"""
SELECT *,
       CASE WHEN {mean} IS NULL OR {mean} = 0 THEN 1.0 ELSE weight / {mean} END AS weight_norm,
       CASE WHEN nps_score >= {promoter_min} THEN 'promoter'
            WHEN nps_score <= {detractor_max} THEN 'detractor'
            WHEN nps_score IS NOT NULL THEN 'passive' END AS nps_segment,
       CASE WHEN satisfaction IS NULL THEN NULL WHEN satisfaction >= {top2box_min} THEN 1 ELSE 0 END AS top2box
FROM ({src})"""


def _wsum(cond: str) -> str:
    return f"sum(weight_norm) FILTER (WHERE {cond})"


def _share(flag: str, zero_fill: bool) -> str:
    num = _wsum(f"{flag} = 1")
    if zero_fill:
        num = f"coalesce({num}, 0.0)"
    base = _wsum(f"{flag} IS NOT NULL")
    return f"CASE WHEN {base} > 0 THEN round({num} / {base} * 100, 1) END"


def aggregate(src: str, segments: Sequence[str], zero_fill: bool = False) -> str:
    keys = ", ".join(["wave", *segments])
    pos, neg = _wsum("nps_segment = 'promoter'"), _wsum("nps_segment = 'detractor'")
    if zero_fill:
        pos, neg = f"coalesce({pos}, 0.0)", f"coalesce({neg}, 0.0)"
    base = _wsum("nps_segment IS NOT NULL")
    return f"""
SELECT {keys}, count(*) AS n, round(sum(weight_norm), 1) AS weighted_base,
       CASE WHEN {base} > 0 THEN round(({pos} - {neg}) / {base} * 100, 1) END AS nps,
       {_share('top2box', zero_fill)} AS top2box_pct,
       {_share('aware', zero_fill)} AS awareness_pct
FROM ({src}) GROUP BY {keys}"""


def metrics(src: str, segments: Sequence[str], *, strict_previous: bool = False, zero_fill: bool = False) -> str:
    part = f"PARTITION BY {', '.join(segments)} " if segments else ""
    win = f"OVER ({part}ORDER BY wave)"
    delta = f"CASE WHEN lag(nps) {win} IS NOT NULL THEN round(nps - lag(nps) {win}, 1) END"
    if strict_previous:
        delta = f"CASE WHEN lag(wave) {win} = wave - 1 THEN {delta} END"
    rank = (", CAST(dense_rank() OVER (PARTITION BY wave ORDER BY nps DESC NULLS LAST) AS INTEGER)"
            " AS nps_rank_in_wave") if segments else ""
    return f"SELECT *, {delta} AS nps_delta{rank} FROM ({aggregate(src, segments, zero_fill)})"


def share(flag: str, weight: str = "weight_norm", zero_fill: bool = False) -> str:
    num = f"sum({weight}) FILTER (WHERE {flag} = 1)"
    if zero_fill:
        num = f"coalesce({num}, 0.0)"
    base = f"sum({weight}) FILTER (WHERE {flag} IS NOT NULL)"
    return f"CASE WHEN {base} > 0 THEN round({num} / {base} * 100, 1) END"


KEY = "CAST(respondent_id AS BIGINT)"

# Waves 5-7 of the drifted files carry no brand_used column.
DRIFT_TYPED = f"""
SELECT respondent_id, wave, fieldwork_date, region, age_group, weight, nps_score, satisfaction, aware,
       CASE WHEN CAST(substr(fieldwork_date, 1, 4) AS INTEGER) - 1994 >= 5 THEN NULL ELSE brand_used END
         AS brand_used
FROM ({ORDERS_TRACKER_RAW_TYPED})"""

EVENTS_TRACKER = """
SELECT CAST(event_id AS VARCHAR) AS respondent_id, CAST(day(ts) AS INTEGER) AS wave, event_type,
       value AS weight, CAST(user_id % 11 AS INTEGER) AS nps_score,
       CAST(1 + event_id % 5 AS INTEGER) AS satisfaction, CAST(user_id % 2 AS INTEGER) AS aware
FROM events"""

DOCUMENT_FLAGS = """
SELECT d.doc_id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS weight, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""

FEATURE_OUT = f"{CANONICAL}, round(weight_norm, 6) AS weight_norm, nps_segment, top2box"


def upsert_source(tracker: str) -> str:
    """Updated answers for some wave 2-3 keys, all of waves 6 and 7, and late wave-2 respondents."""
    return f"""
SELECT respondent_id, wave, fieldwork_date, region, age_group, weight,
       CAST((nps_score + 1) % 11 AS INTEGER) AS nps_score, satisfaction, aware, brand_used
FROM ({tracker}) WHERE wave IN (2, 3) AND {KEY} % 5 = 0
UNION ALL
SELECT {CANONICAL} FROM ({tracker}) WHERE wave >= 6
UNION ALL
SELECT respondent_id || '-late' AS respondent_id, wave, fieldwork_date, region, age_group, weight,
       nps_score, satisfaction, aware, brand_used
FROM ({tracker}) WHERE wave = 2 AND {KEY} % 7 = 0"""


def merged(target: str, source: str) -> str:
    return f"""
SELECT {CANONICAL} FROM ({target}) t
WHERE NOT EXISTS (SELECT 1 FROM ({source}) s WHERE s.wave = t.wave AND s.respondent_id = t.respondent_id)
UNION ALL SELECT {CANONICAL} FROM ({source})"""
