"""JSON helpers for XML-derived documents (Column -> Column).

The source documents were converted from XML: a collection with one element
is a bare object, with several an array. ``from_json`` with a nested
``array<struct>`` schema silently returns NULL for the bare-object case, so
polymorphic fields are kept as raw JSON text and normalised here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from vigil.functions.arrays import let

def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_object(j) -> Column:
    return F.regexp_like(_c(j), F.lit(r"^\s*\{"))


def is_array(j) -> Column:
    return F.regexp_like(_c(j), F.lit(r"^\s*\["))


def json_array(j) -> Column:
    """Object-or-array JSON text -> array of raw JSON element texts.

    A bare object becomes a one-element array; NULL/JSON null/scalars give
    NULL (use ``explode_outer`` to keep the parent row)."""
    j = _c(j)
    return (F.when(is_object(j), F.array(j))
             .when(is_array(j), F.from_json(j, "array<string>")))


def json_records(j) -> Column:
    """Object-or-array JSON text -> ``array<map<string,string>>`` in one parse
    (a bare object becomes a one-element array; nested values keep their raw
    JSON text)."""
    j = _c(j)
    return (F.when(is_object(j), F.array(json_map(j)))
             .when(is_array(j), F.from_json(j, "array<map<string,string>>")))


def record_array(j, element: StructType | str) -> Column:
    """Object-or-array JSON text -> typed ``array<struct>``. At the root of
    the parsed text ``from_json`` wraps a bare object itself."""
    schema: DataType | str = (ArrayType(element) if isinstance(element, StructType)
                              else f"array<{element}>")
    return F.from_json(_c(j), schema)


def json_map(j) -> Column:
    """Object keys as data: JSON object -> ``map<string,string>``; nested
    values keep their raw JSON text."""
    return F.from_json(_c(j), "map<string,string>")


def path(j, p: str) -> Column:
    """JSON path navigation (``$.a.b``), result as raw text."""
    return F.get_json_object(_c(j), p if p.startswith("$") else "$." + p)


# an object's opening brace with its first key
_OPENS = r'\s*+\{\s*+"(?:[^"\\]++|\\.)*+"\s*+:'


def unwrap_single_key(j) -> Column:
    """Descend while the JSON object has exactly one key (a wrapper element), as
    deep as the wrappers go.

    Arrays and scalars stop the descent (they do not parse as a map). A wrapper
    needs an opening brace and a key at the very start of what it wraps, so the
    run of those at the text's start says how often to try; every try parses
    what is left once."""
    j = _c(j)
    opens = F.regexp_extract(j, "^(?:" + _OPENS + ")++", 0)
    tries = F.size(F.regexp_extract_all(opens, F.lit(_OPENS), 0))
    step = lambda x, _: let(json_map(x), lambda m: F.when(F.size(m) == 1, F.map_values(m).getItem(0)).otherwise(x))
    return F.aggregate(F.array_repeat(F.lit(0), F.coalesce(tries, F.lit(0))), j, step)


def unwrap_records(df, col: str, out: str):
    """``col`` unwrapped, and ``out`` its records (``json_records``), each in a
    projection of its own, so that no parse is duplicated in the plan."""
    return df.withColumn(col, unwrap_single_key(col)).withColumn(out, json_records(col))


def first_existing(m, keys: list[str], default: str = "") -> Column:
    """First present, non-null key of a ``map<string,string>`` record, else
    ``default``."""
    m = _c(m)
    return F.coalesce(*[F.element_at(m, F.lit(k)) for k in keys], F.lit(default))
