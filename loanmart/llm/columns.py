"""Names for columns that an operator adds for itself."""

from __future__ import annotations

from collections.abc import Iterable


def free(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with underscores behind it until it is none of ``taken`` nor of the ones before, in any case."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
