"""Summary columns for "when and where did each kind of event first happen".

Time, latitude, longitude and any carried ids are each the earliest non-NULL value
of their own, so they may stem from different events. Nearly always one event has
them all: it travels as a single struct (``<kind>_whole``) and the one-value
structs stay NULL. They are filled only by events lacking some value, and the
earlier of the two is taken in the end. A row in the shuffle is thus about as wide
as the event itself.
"""

from __future__ import annotations

from ridelake.functions.columns import earlier, sighting
from ridelake.operators.mergeable import Part

# Column name ending in the silver table -> event column.
PLACE = {"lat": "latitude", "long": "longitude"}


def moment_values(carried: tuple[str, ...] = ()) -> dict[str, str]:
    """Event-level values: the whole event, and each value of an event not whole."""
    values = (*PLACE.values(), *carried)
    whole = " AND ".join(f"{value} IS NOT NULL" for value in values)
    return {
        "whole": f"IF({whole}, {sighting(*values)}, NULL)",
        **{_alone(value): f"IF(whole IS NULL AND {value} IS NOT NULL, {sighting(value)}, NULL)" for value in values},
    }


def moment_parts(kinds: tuple[str, ...], carried: tuple[str, ...] = ()) -> dict[str, Part]:
    parts = {}
    for kind in kinds:
        parts[f"{kind}_timestamp"] = Part("min", "event_timestamp", kind)
        parts[f"{kind}_whole"] = Part("min", "whole", kind)
        for ending, value in PLACE.items():
            parts[f"{kind}_{ending}"] = Part("min", _alone(value), kind)
    for value in carried:
        parts[value] = Part("min", _alone(value))
    return parts


def moments(kinds: tuple[str, ...], carried: tuple[str, ...] = ()) -> list[str]:
    """The plain values of a summary, as SQL with the silver column names.

    ``any_whole``, the earliest whole event of all kinds, is there for the carried ones.
    """
    columns = []
    if carried:
        columns.append(f"least({', '.join(f'{kind}_whole' for kind in kinds)}) AS any_whole")
        columns += [_earliest(value, "any_whole", value) for value in carried]
    for kind in kinds:
        columns.append(f"{kind}_timestamp")
        columns += [_earliest(value, f"{kind}_whole", f"{kind}_{ending}") for ending, value in PLACE.items()]
    return columns


def _alone(value: str) -> str:
    return f"{value}_alone"


def _earliest(value: str, whole: str, alone: str) -> str:
    whole_first = f"{whole} IS NOT NULL AND {earlier(whole, alone)}"
    return f"IF({alone} IS NULL OR ({whole_first}), {whole}.{value}, {alone}.{value}) AS {alone}"
