"""Shared names and switches."""

from __future__ import annotations

from enum import Enum

# Name of the order-key column carried by every order-dependent frame.
ORD = "ord"


class Semantics(str, Enum):
    """``REFERENCE`` reproduces the observable behaviour of the original
    daily job, quirks included; ``INTENDED`` applies the evident intent
    (group-local fills, id-on-id keys, no double counting)."""

    REFERENCE = "reference"
    INTENDED = "intended"


def as_semantics(value) -> Semantics:
    return value if isinstance(value, Semantics) else Semantics(str(value))
