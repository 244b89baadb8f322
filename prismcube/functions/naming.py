"""Cuboid names: one table name per subset of dimensions."""

from __future__ import annotations

from collections.abc import Sequence

MAX_NAME = 64

# Short column names used when a table name would be too long.
ABBREVIATIONS = {
    "category": "cat",
    "brand": "brd",
    "customer_segment": "cseg",
    "store_type": "styp",
    "salesperson_role": "srole",
    "campaign_name": "cname",
    "customer_id": "cid",
    "product_id": "pid",
    "store_id": "sid",
    "salesperson_id": "spid",
    "campaign_id": "campid",
    "store_manager_id": "smid",
    "store_manager_name": "smname",
    "store_manager_role": "smrole",
    "campaign_start_date": "csdate",
    "campaign_end_date": "cedate",
    "campaign_start_year": "csyr",
    "campaign_end_year": "ceyr",
    "campaign_start_month": "csmon",
    "campaign_end_month": "cemon",
    "campaign_start_day": "csday",
    "campaign_end_day": "ceday",
    "campaign_start_weekday": "cswday",
    "campaign_end_weekday": "cewday",
    "campaign_start_quarter": "csqtr",
    "campaign_end_quarter": "ceqtr",
    "campaign_budget": "cbudget",
    "residential_location": "resloc",
    "origin_location": "orloc",
    "store_location": "sloc",
    "store_name": "sname",
    "salesperson_name": "spname",
    "product_name": "pname",
    "first_name": "fname",
    "last_name": "lname",
    "email": "email",
}


def mask_dimensions(dims: Sequence[str], mask: int) -> list[str]:
    """Dimensions kept by ``mask``; bit i stands for dimension i."""
    return [d for i, d in enumerate(dims) if mask >> i & 1]


def power_set(dims: Sequence[str]) -> list[list[str]]:
    """All subsets, ordered by mask."""
    return [mask_dimensions(dims, mask) for mask in range(2 ** len(dims))]


def cuboid_name(subset: Sequence[str]) -> str:
    """Table name of a subset, abbreviated and then cut to fit ``MAX_NAME``."""
    if not subset:
        return "cuboid_apex"
    full = "_".join(["cuboid", *subset])
    if len(full) <= MAX_NAME:
        return full
    return "_".join(["cuboid", *(ABBREVIATIONS.get(d, d) for d in subset)])[:MAX_NAME]


def cuboid_names(dims: Sequence[str]) -> list[str]:
    """Names by mask; refuses a dimension list whose cut names collide."""
    names = [cuboid_name(s) for s in power_set(dims)]
    if len(set(names)) != len(names):
        raise ValueError("two cuboids would share a table name; use shorter dimension names")
    return names
