"""Naming rules shared by published file headers and their API fields."""

from __future__ import annotations

import re

# Fixed value: the one field name that the publisher shortens with a suffix.
_SHORTENED = {
    "number_of_hospitalizations_included_in_hospital_readmission_summary":
        "number_of_hospitalizations_included_in_hospital_readmission_fc2b",
}


def api_field_name(header: str) -> str:
    """The API field the publisher derives from a CSV header."""
    kept = re.sub(r"[^a-z0-9 ]", "", header.lower())
    name = "_".join(kept.split())
    return _SHORTENED.get(name, name)
