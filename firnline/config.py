"""Configuration: a document with defaults; keys that are not known pass through."""

from __future__ import annotations

import copy
from pathlib import Path
from typing import Any

#: Defaults per section (fixed values; durations are strings, window offsets microseconds of two-way travel time).
DEFAULTS: dict[str, dict[str, Any]] = {
    "opr": {},
    "region": {},
    "query": {},
    "processing": {"data_product": "CSARP_standard", "decimate_interval": "10s", "layer_margin_m": 50, "ice_permittivity": 3.17, "max_workers": 4, "checkpoint_every": 1000, "retry_after": "1h", "retry_most": "7D"},
    "qc": {"max_heading_change_deg_per_km": None, "min_ice_thickness_m": None, "min_agl_m": None, "min_bed_snr_db": None, "min_traces_after_qc": 10},
    "store": {"backend": "local", "path": "outputs/trace_store", "remove_out_of_scope": False},
}
NOISE = {
    "pre_surface": {"start_offset_us": 1.0, "end_offset_us": 1.0},
    "post_bed": {"start_offset_us": 5.0, "end_offset_us": 5.0},
    "record_tail": {"start_offset_us": 12.0, "end_offset_us": 7.0},
}
#: The check that each limit of the qc section enables (fixed names).
CHECK_OF = {"max_heading_change_deg_per_km": "heading_change", "min_agl_m": "minimum_agl", "min_ice_thickness_m": "ice_thickness_threshold", "min_bed_snr_db": "snr_bed_pick"}
#: Picks serve windows and checks if within the first tolerance of a trace, peaks and availability within the second.
WIDE_TOLERANCE, TIGHT_TOLERANCE = "5s", "1s"


def resolve(given: dict[str, Any] | None) -> dict[str, Any]:
    """The given document over the defaults, section by section."""
    out = copy.deepcopy(given or {})
    for section, values in DEFAULTS.items():
        out[section] = copy.deepcopy(values) | (out.get(section) or {})
    out["processing"]["noise"] = resolve_noise(out["processing"].get("noise"))
    return out


def resolve_noise(given: dict[str, Any] | None) -> dict[str, dict[str, float]]:
    """Each window's offsets; keys that a window doesn't have are ignored."""
    given = given or {}
    return {window: {k: float((given.get(window) or {}).get(k, v)) for k, v in offsets.items()} for window, offsets in NOISE.items()}


def check_limits(config: dict[str, Any]) -> dict[str, float]:
    """Limit per enabled check."""
    return {check: config["qc"][key] for key, check in CHECK_OF.items() if config["qc"].get(key) is not None}


def store_root(config: dict[str, Any]) -> str:
    """Where the store is: a bucket's prefix, or a folder."""
    store = config["store"]
    if store.get("backend") == "s3":
        return "s3a://" + "/".join(part.strip("/") for part in (store["bucket"], store.get("prefix") or "") if part)
    return store["path"]


def load(path: str | Path) -> dict[str, Any]:
    """A YAML or JSON file; FileNotFoundError if there is none."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        import json

        return resolve(json.loads(text))
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading YAML needs the yaml package; a .json file works without it") from error
    return resolve(yaml.safe_load(text))


def for_collection(config: dict[str, Any], collection: str) -> dict[str, Any]:
    """The same configuration for one collection only."""
    out = copy.deepcopy(config)
    out.setdefault("query", {})["collections"] = [collection]
    return out
