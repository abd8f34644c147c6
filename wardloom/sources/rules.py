"""SQL predicates for exclusion rules."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

ITEMS = "/*items*/ "


def items(column: str, ids: Sequence[int]) -> str:
    """Marked so that :func:`typed` can compare in the column's own type."""
    return f"{column} in ({ITEMS}{', '.join(str(i) for i in ids)})"


def typed(predicate: str, types: Mapping[str, str]) -> str:
    """The predicate with item lists as the column has them: numbers, or texts for a text column. A list in the column's own type is
    pushed down to the scan, a cast of the column is not."""

    def listed(found: re.Match) -> str:
        column, ids = found[1], found[2]
        if types.get(column.lower()) == "string":
            ids = ", ".join(f"'{i.strip()}'" for i in ids.split(","))
        return f"{column} in ({ids})"

    return re.sub(rf"(\w+) in \({re.escape(ITEMS)}([^)]*)\)", listed, predicate)


def carried(column: str, values: Sequence[str]) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


def positive(column: str) -> str:
    return f"try_cast({column} as double) > 0"


def any_of(*predicates: str) -> str:
    return "(" + " or ".join(f"({p})" for p in predicates) + ")"
