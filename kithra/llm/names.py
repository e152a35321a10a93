"""Column names of an operator's own beside those of a user's table."""

from __future__ import annotations


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
