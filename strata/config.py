"""Job configuration: defaults, file + environment overlay, deep merge.

Config files are YAML or JSON. ``load_config(path, env)`` reads the base
file, then ``{env}.yaml`` (or ``.json``) next to it if present, then the
explicit ``overrides``; later values win, merged key by key at every depth.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Mapping
from pathlib import Path

#: no sources and no checks: a job names its own
DEFAULT_CONFIG: dict = {
    "sources": {},
    "layers": {
        "bronze": {"path": None, "write_mode": "append"},
        "silver": {"path": None, "write_mode": "merge", "merge_key": "customer_id",
                   "events_key": "event_id", "events_partition_by": ["event_date"],
                   "transactions_key": None, "transactions_partition_by": [],
                   "partition_by": ["region"]},
        "gold": {"path": None, "write_mode": "overwrite", "partition_by": ["event_date"]},
    },
    "events": {"property_keys": ["session_id"], "session_key": "session_id"},
    "segments": {"power_events": 100, "power_types": 5, "active_events": 10},
    "quality": {"fail_on_error": False, "quarantine_path": None, "on_missing": "skip", "checks": []},
}


def deep_merge(base: Mapping, overlay: Mapping) -> dict:
    """``overlay`` over ``base``; nested mappings merge, everything else replaces."""
    out = copy.deepcopy(dict(base))
    for k, v in overlay.items():
        if isinstance(v, Mapping) and isinstance(out.get(k), Mapping):
            out[k] = deep_merge(out[k], v)
        else:
            out[k] = copy.deepcopy(v)
    return out


def _read(path: Path) -> dict:
    text = path.read_text()
    if path.suffix == ".json":
        return json.loads(text)
    import yaml
    return yaml.safe_load(text) or {}


def load_config(path: str | None = None, env: str | None = None,
                overrides: Mapping | None = None) -> dict:
    config = copy.deepcopy(DEFAULT_CONFIG)
    if path is not None:
        base = Path(path)
        config = deep_merge(config, _read(base))
        if env:
            for suffix in (".yaml", ".yml", ".json"):
                overlay = base.parent / f"{env}{suffix}"
                if overlay.exists():
                    config = deep_merge(config, _read(overlay))
                    break
    if overrides:
        config = deep_merge(config, overrides)
    return config
