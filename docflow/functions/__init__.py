"""Column functions: text in, text or a typed value out, all native expressions."""

from docflow.functions.text import (
    address_city,
    address_state,
    first_match,
    money,
    present,
    section_count,
    strip,
    us_date,
    whole_number,
)

__all__ = [
    "address_city",
    "address_state",
    "first_match",
    "money",
    "present",
    "section_count",
    "strip",
    "us_date",
    "whole_number",
]
