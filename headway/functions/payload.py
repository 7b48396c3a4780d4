"""Reading JSON payloads and nested documents."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOP_LEVEL = re.compile(r"^\$\.(\w+)$")


def _scalar_only(text: Column, doc: Column, path: str) -> Column:
    """Keep extracted text unless its target was an object or an array.

    Text that opens with a brace may still be a string value, so only that rare case
    pays for a second look at the document.
    """
    kind = F.substring(F.to_json(F.try_variant_get(F.try_parse_json(doc), path, "variant")), 1, 1)
    nested_looking = text.startswith("{") | text.startswith("[")
    return F.when(~nested_looking, text).when(kind == '"', text)


def json_value(doc: Column, path: str) -> Column:
    """Scalar at a path as text; NULL when missing or nested.

    A payload that breaks off may still yield what stands before the break.
    """
    return _scalar_only(F.get_json_object(doc, path), doc, path)


def extract_json(df: DataFrame, doc: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Add ``{output: (path, type)}`` columns from a JSON text column.

    All top-level fields come out of one parse of the payload, and filters on them do not
    parse it again. Text that does not fit the wanted type gives NULL, and so does all of
    a malformed payload (see ``cast_rejects`` to count the former).
    """
    top = {path: f"_{match[1]}" for path, _ in fields.values() if (match := _TOP_LEVEL.match(path))}
    if top:
        names = [name[1:] for name in top.values()]
        df = df.select("*", F.json_tuple(doc, *names).alias(*top.values()))

    def column(path: str, kind: str) -> Column:
        text = F.col(top[path]) if path in top else F.get_json_object(doc, path)
        # The text of an object or array fits no other type, so only strings need a look.
        return _scalar_only(text, F.col(doc), path) if kind == "string" else text.try_cast(kind)

    return df.withColumns({name: column(*spec) for name, spec in fields.items()}).drop(*top.values())


def cast_rejects(df: DataFrame, doc: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Per typed field, how many payloads held text that the type refuses."""
    typed = {name: spec for name, spec in fields.items() if spec[1] != "string"}
    texts = extract_json(df, doc, {f"{name}_text": (path, "string") for name, (path, _) in typed.items()})
    counts = [
        F.count_if(F.col(f"{name}_text").isNotNull() & F.col(f"{name}_text").try_cast(kind).isNull()).alias(name)
        for name, (_, kind) in typed.items()
    ]
    return texts.agg(*counts)


def last_value_of(pairs: Column, key: str) -> Column:
    """Value of the last pair with this key in an array of (key, value) structs."""
    return F.try_element_at(F.filter(pairs, lambda p: p["key"] == key), F.lit(-1))["value"]


def pairs_to_map(pairs: Column) -> Column:
    """Array of (key, value) structs to a map; the last of equal keys wins (see ``session.RUNTIME``)."""
    return F.map_from_entries(pairs)


def int_of(pairs: Column, key: str) -> Column:
    """Whole number under a key, 0 when the key is missing or not a number."""
    return F.coalesce(last_value_of(pairs, key).try_cast("int"), F.lit(0))


def first_or(items: Column, field: str, default: str) -> Column:
    """Field of the first element, a default when there is none."""
    return F.coalesce(F.try_element_at(items, F.lit(1))[field], F.lit(default))


def sorted_head(items: Column, by: str, n: int = 20, missing: str = "") -> Column:
    """The first n structs of an array ordered by a text field, missing ones first."""

    def compare(a: Column, b: Column) -> Column:
        left, right = F.coalesce(a[by], F.lit(missing)), F.coalesce(b[by], F.lit(missing))
        return F.when(left < right, -1).when(left > right, 1).otherwise(0)

    return F.slice(F.array_sort(items, compare), 1, n)
