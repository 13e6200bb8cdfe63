"""Column names: quoting and names that cannot clash."""

from __future__ import annotations

import uuid


def quoted(name: str) -> str:
    """``name`` as one back-tick quoted identifier, so dots stay part of it."""
    return "`" + name.replace("`", "``") + "`"


def fresh(kind: str) -> str:
    """A column name that no input table has."""
    return f"__{kind}_{uuid.uuid4().hex}"
