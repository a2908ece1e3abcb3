"""Column names that no table of documents can clash with."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(name: str, columns: Iterable[str]) -> str:
    """``name``, with as many underscores in front as it takes to differ from all ``columns`` in more than case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    """A column name as Spark reads it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
