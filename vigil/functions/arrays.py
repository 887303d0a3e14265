"""Array functions (Column -> Column) over in-record arrays; no shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.text import clean_string, strip


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def remove_first(arr, value) -> Column:
    """Remove the first occurrence of ``value`` (``array_remove`` drops all)."""
    a = _c(arr)
    pos = F.array_position(a, value)
    n = F.size(a)
    return F.when(pos > 0, F.concat(F.slice(a, F.lit(1), pos - 1),
                                    F.slice(a, pos + 1, F.greatest(n - pos, F.lit(0))))
                  ).otherwise(a)


def drop_last_if_prefix(arr, prefix: str) -> Column:
    """Drop the last element when it starts with ``prefix``."""
    a = _c(arr)
    last = F.try_element_at(a, F.lit(-1))
    return F.when(last.startswith(prefix), F.slice(a, F.lit(1), F.size(a) - 1)).otherwise(a)


def non_blank_markers(arr, marker: str = ">") -> Column:
    """Keep elements that are not blank once ``marker`` is removed."""
    return F.filter(_c(arr), lambda x: strip(F.replace(x, F.lit(marker), F.lit(""))) != "")


def breadcrumb_dirs(arr, home: str = "inicio", tail_prefix: str = "numero") -> Column:
    """Breadcrumb texts -> directory names: drop blank/marker pieces, slug each,
    remove the first ``home`` entry, drop a trailing ``tail_prefix`` entry."""
    a = F.transform(non_blank_markers(arr), lambda x: clean_string(x))
    return drop_last_if_prefix(remove_first(a, home), tail_prefix)


def path_join(arr, sep: str = "/") -> Column:
    return F.array_join(_c(arr), sep)


def last_matching(arr, pred: Callable[[Column], Column]) -> Column:
    """Last element satisfying ``pred`` (last match wins); NULL if none."""
    return F.try_element_at(F.filter(_c(arr), pred), F.lit(-1))


def join_field(arr, field: str, sep: str) -> Column:
    """Ordered concat of one field of an array of records."""
    return F.array_join(F.transform(_c(arr), lambda x: x[field]), sep)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def named(**fields: Column) -> Column:
    """A struct of the fields, also where they are made of lambda variables."""
    return F.named_struct(*[x for k, v in fields.items() for x in (F.lit(k), v)])


#: Elements that one inner fold of ``scan`` appends to its result.
SCAN_PART = 256


def scan(arr, zero: Column, step: Callable[[Column, Column], Column], part: int = SCAN_PART) -> Column:
    """All states of a fold: ``step(state, element)`` after each element, from ``zero``.

    A fold that appends to its result copies it every time; folding parts of the array and
    then appending whole parts keeps that to a small factor on arrays of any length."""
    a = _c(arr)
    state = lambda s, out: named(s=s, out=out)
    empty = F.slice(F.array(zero), 1, 0)

    def inner(acc: Column, x: Column) -> Column:
        return let(step(acc["s"], x), lambda s: state(s, F.concat(acc["out"], F.array(s))))

    def outer(acc: Column, k: Column) -> Column:
        done = F.aggregate(F.slice(a, k * part + 1, F.lit(part)), state(acc["s"], empty), inner)
        return let(done, lambda d: state(d["s"], F.concat(acc["out"], F.array(d["out"]))))

    parts = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / part).cast("int"))
    whole = F.aggregate(parts, state(zero, F.slice(F.array(empty), 1, 0)), outer, lambda r: F.flatten(r["out"]))
    return F.when(F.size(a) > 0, whole).otherwise(empty)
