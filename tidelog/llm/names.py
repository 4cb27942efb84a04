"""Column names that a table does not use yet."""

from __future__ import annotations


def free_name(taken: list[str], name: str) -> str:
    """``name`` with as many underscores behind it as it takes to be none of ``taken``, whatever the case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name
