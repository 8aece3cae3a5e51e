"""Task parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class TaskParams:
    """What a task asks for. Only the two dates are required.

    ``None`` switches a filter off. An empty tuple is a filter that nothing meets.
    """

    start_date: str
    end_date: str
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[int, ...] | None = None
    target_page_flow: tuple[int, ...] = ()

    @classmethod
    def from_mapping(cls, task: Mapping[str, object]) -> TaskParams:
        """Read the task's parameter names; a missing or blank value means no filter."""
        for name in ("startDate", "endDate"):
            if not _text(task.get(name)):
                raise ValueError(f"task parameter {name} is required")
        return cls(
            start_date=_text(task["startDate"]),
            end_date=_text(task["endDate"]),
            start_age=_whole(task.get("startAge")),
            end_age=_whole(task.get("endAge")),
            professionals=_items(task.get("professionals")),
            cities=_items(task.get("cities")),
            sex=_text(task.get("sex")),
            keywords=_items(task.get("keywords")),
            category_ids=_ids(_items(task.get("categoryIds"))),
            target_page_flow=_pages(_items(task.get("targetPageFlow"))),
        )


def _text(value: object) -> str | None:
    return None if value is None or str(value) == "" else str(value)


def _whole(value: object) -> int | None:
    text = _text(value)
    return None if text is None else int(text)


def _items(value: object) -> tuple[str, ...] | None:
    """Values of a comma-separated text or of a list."""
    if isinstance(value, (list, tuple)):
        value = ",".join(map(str, value))
    text = _text(value)
    return None if text is None else tuple(item for item in text.split(",") if item)


def _ids(items: tuple[str, ...] | None) -> tuple[int, ...] | None:
    """Ids match as text, so "07" or "x" can never equal an id and is left out."""
    return None if items is None else tuple(int(item) for item in items if _is_id(item))


def _pages(items: tuple[str, ...] | None) -> tuple[int, ...]:
    """The pages of a flow. One that is no id would change its neighbours' pairs, so it raises."""
    for item in items or ():
        if not _is_id(item):
            raise ValueError(f"targetPageFlow has {item!r}, which is no page id")
    return tuple(map(int, items or ()))


def _is_id(item: str) -> bool:
    digits = item.removeprefix("-")
    return digits.isascii() and digits.isdecimal() and str(int(item)) == item
