"""Where a connector's rows lie: under a catalog name or at a path."""
from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from .errors import MissingOptionError, SpecError


@dataclass(frozen=True)
class Place:
    table: str | None = None
    path: str | None = None

    @property
    def identifier(self) -> str:
        """How SQL names a Delta table here."""
        return self.table or f"delta.`{self.path}`"


def place_of(options: Mapping[str, Any], who: str, *, names_win: bool) -> Place:
    """The place that options give. With both a name and a path the name is taken, or
    (``names_win=False``, where a write could end up in the wrong one) the options are refused."""
    table, path = (str(options[k]) if options.get(k) else None for k in ("table", "path"))
    if not (table or path):
        raise MissingOptionError(f"{who}: neither a 'table' nor a 'path' is given")
    if table and path:
        if not names_win:
            raise SpecError(f"{who}: 'table' and 'path' are both given; one of them has to go")
        path = None
    return Place(table, path)
