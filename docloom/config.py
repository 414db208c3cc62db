"""Routing configuration."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Document categories in the order the rules test them.
CATEGORIES = ("scanned", "table_heavy", "form_heavy", "long_form", "short_form", "unknown")
MODES = ("static", "hybrid")
DEFAULT_FALLBACK = "fallback_non_azure"


@dataclass(frozen=True)
class Strategy:
    """Parser strategy; ``max_pages`` is recorded with the decision, not enforced."""

    name: str = "general"
    model: str | None = None
    max_pages: int | None = None

    @classmethod
    def of(cls, value: Strategy | Mapping[str, object] | str | None) -> Strategy:
        if isinstance(value, Strategy):
            return value
        if isinstance(value, str):
            return cls(value)
        entry = dict(value or {})
        return cls(str(entry.get("name", "general")), entry.get("model"), _int_or_none(entry.get("max_pages")))


def _int_or_none(value: object) -> int | None:
    try:
        return None if value is None else int(value)
    except (TypeError, ValueError):
        return None


@dataclass(frozen=True)
class RoutingConfig:
    mode: str = "hybrid"
    override_flag: str = "parser_override"
    strategies: Mapping[str, Strategy | Mapping[str, object] | str] = field(default_factory=dict)
    fallback: Strategy | Mapping[str, object] | str = DEFAULT_FALLBACK
    static: Strategy | Mapping[str, object] | str | None = None
    short_form_pages: int = 15
    long_form_pages: int = 100
    # page count above which a category is sent to the fallback; 0 or None is off
    page_limits: Mapping[str, int | None] = field(default_factory=dict)
    scanned_share: float = 0.5
    table_share: float = 0.3
    form_share: float = 0.25
    short_form_density: float = 0.55

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"unknown routing mode {self.mode!r}")
        unlimited = set(self.page_limits) & {"scanned", "unknown"}
        if unlimited:
            raise ValueError(f"categories without a page limit: {sorted(unlimited)}")

    def fallback_strategy(self) -> Strategy:
        return Strategy.of(self.fallback)

    def static_strategy(self) -> Strategy | None:
        return Strategy.of(self.static) if self.static else None

    def strategy_by_category(self) -> dict[str, Strategy]:
        """A strategy for every category; unnamed ones use ``unknown``, that one the fallback.

        Keys that are no category count as ``unknown``.
        """
        named: dict[str, Strategy] = {}
        for key, value in self.strategies.items():
            named[key if key in CATEGORIES else "unknown"] = Strategy.of(value)
        unknown = named.get("unknown", self.fallback_strategy())
        return {c: named.get(c, unknown) for c in CATEGORIES}
