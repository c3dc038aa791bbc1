"""Window frames of the anti-leakage convention (WIN1-5).

On a dense entity x day grid one row is one day, so row frames are day frames:

* ``prior(n)``  rows [t-n, t-1]   known before the morning of day t
* ``incl(n)``   rows [t-n+1, t]   measured on the morning of day t
* ``future(n)`` rows [t, t+n-1]   labels only; features must never use it
* ``all_prior`` rows (-inf, t-1], ``all_incl`` rows (-inf, t]

All frames of one (entity, day) spec share a single Exchange + Sort + Window
when they sit in one ``select``.
"""

from __future__ import annotations

from pyspark.sql import Window, WindowSpec

ENTITY, DAY = "entity_id", "date_day"


def ordered(entity: str | list[str] = ENTITY, day: str | list[str] = DAY) -> WindowSpec:
    keys = [entity] if isinstance(entity, str) else list(entity)
    order = [day] if isinstance(day, str) else list(day)
    return Window.partitionBy(*keys).orderBy(*order)


def prior(n: int, entity=ENTITY, day=DAY) -> WindowSpec:
    return ordered(entity, day).rowsBetween(-n, -1)


def incl(n: int, entity=ENTITY, day=DAY) -> WindowSpec:
    return ordered(entity, day).rowsBetween(-(n - 1), Window.currentRow)


def all_prior(entity=ENTITY, day=DAY) -> WindowSpec:
    return ordered(entity, day).rowsBetween(Window.unboundedPreceding, -1)


def all_incl(entity=ENTITY, day=DAY) -> WindowSpec:
    return ordered(entity, day).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def future(n: int, entity=ENTITY, day=DAY, *, for_label: bool = False) -> WindowSpec:
    """Forward frame; callers must say they build a label (look-ahead guard)."""
    if not for_label:
        raise ValueError("future() frames may only build labels; pass for_label=True")
    return ordered(entity, day).rowsBetween(Window.currentRow, n - 1)


def ahead(n: int, entity=ENTITY, day=DAY) -> WindowSpec:
    """Forward frame over *planned* events (public in advance, e.g. a schedule)."""
    return ordered(entity, day).rowsBetween(Window.currentRow, n - 1)
