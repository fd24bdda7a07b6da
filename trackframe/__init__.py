"""trackframe: survey-tracker analytics as Spark DataFrame jobs.

Public API: configuration, the contract, harmonisation, features, metrics,
ingest, the partitioned store, upserts, change tables,
full / incremental runs and the streaming ingest.
"""

from trackframe.config import ConfigError, TrackerConfig
from trackframe.operators.contract import (
    CANONICAL_COLUMNS,
    CANONICAL_CONTRACT,
    CANONICAL_SCHEMA,
    Contract,
    Rule,
    enforce_contract,
    tag_rows,
)
from trackframe.operators.features import add_features, normalise_weights
from trackframe.operators.harmonise import harmonise
from trackframe.operators.metrics import refresh_wave_metrics, wave_metrics, wave_metrics_direct
from trackframe.operators.upsert import DuplicateKeyError, as_of, latest_per_key, merge_upsert
from trackframe.plans.run import RunSummary, run_tracker, upsert_waves
from trackframe.sources.ingest import discover_wave_files, ingest_waves, wave_file_headers
from trackframe.sources.store import (
    existing_waves,
    pending_waves,
    read_store,
    stored_waves,
    write_partitioned,
)
from trackframe.streaming.waves import stream_waves

__version__ = "0.1.0"

__all__ = [
    "CANONICAL_COLUMNS",
    "CANONICAL_CONTRACT",
    "CANONICAL_SCHEMA",
    "ConfigError",
    "Contract",
    "DuplicateKeyError",
    "Rule",
    "RunSummary",
    "TrackerConfig",
    "__version__",
    "add_features",
    "as_of",
    "discover_wave_files",
    "enforce_contract",
    "existing_waves",
    "harmonise",
    "ingest_waves",
    "latest_per_key",
    "merge_upsert",
    "normalise_weights",
    "pending_waves",
    "read_store",
    "refresh_wave_metrics",
    "run_tracker",
    "stored_waves",
    "stream_waves",
    "tag_rows",
    "upsert_waves",
    "wave_file_headers",
    "wave_metrics",
    "wave_metrics_direct",
    "write_partitioned",
]
