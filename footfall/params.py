"""Task parameters: a JSON object of arrays, of which the first element counts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parameter column -> its key in the task's JSON (fixed names of the task format).
PARAM_KEYS = {
    "start_date": "startDate",
    "end_date": "endDate",
    "start_age": "startage",
    "end_age": "endage",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keyWords",
    "category_ids": "categoryIds",
    "target_page_flow": "targetPageFlow",
}

_AGES = ("start_age", "end_age")
_LIST_PARAMS = ("professionals", "cities", "keywords", "category_ids", "target_page_flow")


def task_param(params, key: str) -> Column:
    """First element of the array under ``key`` of a JSON parameter text.

    NULL when the text is not JSON, the key is missing or the array is empty.
    """
    arrays = F.from_json(params, "map<string,array<string>>")
    return F.get(F.try_element_at(arrays, F.lit(key)), F.lit(0))


def task_params(tasks: DataFrame, *more: str) -> DataFrame:
    """One row per task with its parameters as columns; ages as integers, the rest as text.

    An age that is not a number is NULL here; ``load_task`` rejects it for the task it loads.
    """
    columns = [task_param(F.col("task_param"), key).alias(name) for name, key in PARAM_KEYS.items()]
    return tasks.select("task_id", *columns, *more).withColumns(
        {age: F.col(age).try_cast("int") for age in _AGES}
    )


@dataclass(frozen=True)
class TaskParams:
    """Parameters of one task. Absent filters let every session pass.

    List parameters take a list or one comma text.
    """

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: list[str] | str | None = None
    cities: list[str] | str | None = None
    sex: str | None = None
    keywords: list[str] | str | None = None
    category_ids: list[str] | list[int] | str | None = None
    target_page_flow: list[str] | list[int] | str | None = field(default=None)

    def __post_init__(self):
        for name in _LIST_PARAMS:
            object.__setattr__(self, name, _values(getattr(self, name)))

    def date_range(self) -> tuple[str, str]:
        """Inclusive bounds of the action date; a missing bound is an error."""
        if not self.start_date or not self.end_date:
            raise ValueError("both startDate and endDate are needed")
        return self.start_date, self.end_date

    def page_flow(self) -> list[int]:
        if not self.target_page_flow:
            raise ValueError("targetPageFlow is needed")
        return [int(page) for page in self.target_page_flow]


def load_task(tasks: DataFrame, task_id: int) -> TaskParams:
    """Parameters of the task ``task_id``; a missing task is an error.

    Only this one parameter row comes to the driver.
    """
    texts = [task_param(F.col("task_param"), PARAM_KEYS[age]).alias(f"{age}_text") for age in _AGES]
    one = tasks.where(F.col("task_id") == task_id)
    row = task_params(one.select("*", *texts), *[f"{age}_text" for age in _AGES]).first()
    if row is None:
        raise LookupError(f"no task with id {task_id}")
    for age in _AGES:
        if row[age] is None and row[f"{age}_text"]:
            raise ValueError(f"task {task_id}: {PARAM_KEYS[age]} is not a number: {row[f'{age}_text']!r}")
    return TaskParams(**{name: row[name] for name in PARAM_KEYS})


def _values(value) -> list[str] | None:
    if value is None:
        return None
    parts = value.split(",") if isinstance(value, str) else value
    if not isinstance(parts, Iterable):
        raise TypeError(f"a list or comma text is needed, not {value!r}")
    return [text for text in (str(part) for part in parts) if text] or None
