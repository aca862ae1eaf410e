"""The catalog's two upsert policies (per-column merge rules)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.operators.merge import COALESCE_TARGET, SOURCE, Rule, const, keep_or_insert


def _ts(run_ts) -> Column:
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp_ntz")


def product_rules(run_ts, include_raw_json: bool = True) -> dict[str, Rule]:
    """Re-ingest of a product page: every column is overwritten except the
    key; ``last_updated`` becomes the run's timestamp on insert and update;
    the raw document is overwritten only when it is collected this run
    (otherwise kept, and NULL on insert)."""
    rules = {"last_updated": const(_ts(run_ts))}
    if not include_raw_json:
        rules["raw_json"] = Rule("keep", "source")
    return rules


def overlay_rules(run_ts) -> dict[str, Rule]:
    """Second-vendor overlay: part number and vendor columns overwrite,
    descriptive columns only fill gaps, everything else is left alone (use
    with ``default=Rule("keep", "source")``); new rows get the run timestamp
    as their ``last_updated``."""
    rules = {c: COALESCE_TARGET for c in S.OVERLAY_FILL_COLUMNS}
    rules.update({c: SOURCE for c in S.VENDOR_COLUMNS})
    rules["mfr_part_number"] = SOURCE
    rules["last_updated"] = keep_or_insert(_ts(run_ts))
    return rules


OVERLAY_DEFAULT = Rule("keep", "source")
