"""The privacy gate: which columns hold personal data, and their salted hashes, as one projection."""

from __future__ import annotations

import logging
import os
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.tables import PERSONAL
from meridian.functions.text import salted_hash

log = logging.getLogger(__name__)


class MissingSalt(ValueError):
    """No salt was given and none is in the environment."""


def resolve_salt(salt: str | None = None, env: str = "SALT_SECRET", insecure_default: str | None = None) -> str:
    """The argument, else the environment; an insecure default only where it is asked for by name."""
    found = salt or os.environ.get(env)
    if found:
        return found
    if insecure_default is None:
        raise MissingSalt(f"give a salt or set {env}")
    log.warning("hashing with an insecure default salt")
    return insecure_default


def load_manifest(path: str | None = None) -> Mapping[str, list[str]]:
    """Source type to personal columns from a YAML file; the built-in one without a path, nothing if it can't be read."""
    if path is None:
        return PERSONAL
    import yaml

    try:
        return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    except (OSError, yaml.YAMLError) as e:
        log.error("manifest %s can't be read: %s", path, e)
        return {}


def personal_columns(source_type: str, columns: Iterable[str], manifest: Mapping[str, list[str]] = PERSONAL) -> list[str]:
    """The manifest's columns that are there, in the manifest's order; looks at the schema only."""
    there = set(columns)
    return [c for c in manifest.get(source_type, []) if c in there]


def anonymize(df: DataFrame, fields: Iterable[str], salt: str) -> tuple[DataFrame, dict]:
    """df with the fields hashed, and the audit."""
    if not isinstance(df, DataFrame):
        raise ValueError("a Spark DataFrame is needed")
    fields = list(fields)
    if not fields:
        return df, {"status": "no_pii_fields_provided", "anonymized_columns": []}
    present = [c for c in fields if c in df.columns]
    for c in set(fields) - set(present):
        log.warning("personal column %s is not there", c)
    return df.withColumns({c: salted_hash(F.col(c), salt) for c in present}), {"status": "success", "anonymized_columns": present}
