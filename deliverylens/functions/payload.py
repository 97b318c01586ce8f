"""Typed extraction from JSON payloads whose schema drifts.

Payloads are parsed once into VARIANT (``parse_json``) and fields are read by
path with an asserted type (``variant_get``). Nothing is inferred: a field
that is missing or JSON ``null`` gives NULL; an object read as a string gives
its JSON text. ``mode="strict"`` raises on a value that cannot be cast (the
reference behaviour), ``mode="try"`` gives NULL instead so one bad record does
not stop a stream; :func:`cast_failures` counts what ``try`` hid.

All of this is JVM-side SQL; the Parquet scan only reads the VARIANT paths a
query touches when the payload is stored as VARIANT.

``variant_get`` searches the object anew for each path and plans a cast anew for
each value whose type is not the asked one, which cost more than building and parsing
the payload. :func:`fields_read` and :func:`field_of` read many paths in one walk,
cast by column, and go by path only where that could give another result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FieldSpec:
    """One output column read from a payload path.

    ``path`` is a JSON path as accepted by ``variant_get``, for example
    ``$.fields.status.name`` or ``$.fields["System.State"]`` for keys with dots.
    ``whole``: a text column whose values are mostly whole numbers in the payload.
    """

    name: str
    path: str
    type: str = "string"
    mode: str = "strict"
    whole: bool = False


def parse_payload(c: Column | str, lenient: bool = False) -> Column:
    """JSON text -> VARIANT. Strict raises on malformed text; lenient gives NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_parse_json(c) if lenient else F.parse_json(c)


def get_field(v: Column | str, path: str, type_: str = "string", mode: str = "strict") -> Column:
    v = F.col(v) if isinstance(v, str) else v
    if mode == "try":
        return F.try_variant_get(v, path, type_)
    if mode != "strict":
        raise ValueError(f"mode must be 'strict' or 'try', not {mode!r}")
    return F.variant_get(v, path, type_)


def field_col(v: Column | str, spec: FieldSpec) -> Column:
    return get_field(v, spec.path, spec.type, spec.mode).alias(spec.name)


def extract(df: DataFrame, variant_col: str, specs: list[FieldSpec], keep: list[str] | None = None) -> DataFrame:
    """Select ``keep`` columns plus one typed column per spec."""
    keep = keep or []
    return df.select(*[F.col(k) for k in keep], *[field_col(variant_col, s) for s in specs])


_STEP = re.compile(r'\.([^.\[\]"]+)|\["([^"`]+)"\]')
#: What a field of these types is read as in the walk; the others as themselves.
_READ_AS = {"timestamp": "string", "int": "bigint"}


def _steps(path: str) -> tuple[str, ...]:
    """The keys of a path; none for one with other steps than keys."""
    steps = [m.group(1) or m.group(2) for m in _STEP.finditer(path)]
    return tuple(steps) if "$" + "".join(m.group(0) for m in _STEP.finditer(path)) == path else ()


def fields_read(v: Column | str, specs: list[FieldSpec]) -> Column:
    """The payload walked once: a struct, nested as the paths of ``specs`` are, for :func:`field_of`.

    What cannot be read is NULL in it. It must be a column of its own before its
    fields are taken, else Catalyst walks the payload for each of them.
    """
    v = F.col(v) if isinstance(v, str) else v
    tree: dict = {}
    for s in specs:
        *above, last = _steps(s.path)
        node = tree
        for key in above:
            node = node.setdefault(key, {})
        node[last] = "variant" if s.whole else _READ_AS.get(s.type, s.type)

    def ddl(node: dict | str) -> str:
        if isinstance(node, str):
            return node
        return "struct<" + ",".join(f"`{k}`:{ddl(child)}" for k, child in node.items()) + ">"

    return F.try_variant_get(v, "$", ddl(tree))


def walkable(specs: list[FieldSpec]) -> list[FieldSpec]:
    """Those of ``specs`` that one walk can read: paths of keys, none within or equal to another's."""
    steps = [_steps(s.path) for s in specs]
    return [s for s, own in zip(specs, steps)
            if own and sum(own[:len(o)] == o or o[:len(own)] == own for o in steps if o) == 1]


def field_of(read: str, v: Column | str, spec: FieldSpec) -> Column:
    """What :func:`field_col` gives, from the column ``read`` of :func:`fields_read`. What is NULL there and might be
    a value that does not fit, or is of a form whose text could stand for another value, is read by its path."""
    found = F.col(read)
    for key in _steps(spec.path):
        found = found.getField(key)
    by_path = get_field(v, spec.path, spec.type, spec.mode)
    if spec.whole:  # as text by a cast of the column: variant_get plans one for each number
        number = F.variant_get(found, "$", "bigint").cast("string")
        out = F.when(F.schema_of_variant(found) == "BIGINT", number).otherwise(
            get_field(found, "$", spec.type, spec.mode))
    elif spec.type == "string":
        out = found
    elif spec.type == "timestamp":  # a number, as text, has no dash after four digits
        dated = F.when(F.substring(found, 5, 1) == "-", found.try_cast("timestamp"))
        out = F.when(found.isNotNull(), F.coalesce(dated, by_path))
    elif spec.type == "int":
        out = F.coalesce(F.when(found.between(-2 ** 31, 2 ** 31 - 1), found.cast("int")), by_path)
    else:
        out = F.coalesce(found, by_path)
    return out.alias(spec.name)


def cast_failures(v: Column | str, spec: FieldSpec) -> Column:
    """1 when the path holds a value that the strict cast would reject, else 0."""
    v = F.col(v) if isinstance(v, str) else v
    present = F.variant_get(v, spec.path, "variant").isNotNull() & ~F.is_variant_null(
        F.variant_get(v, spec.path, "variant"))
    return F.when(present & F.try_variant_get(v, spec.path, spec.type).isNull(), 1).otherwise(0)


def array_field_ids(arr: Column, path: str = "$.id", type_: str = "string") -> Column:
    """Map every element of an ARRAY<VARIANT> to one typed field."""
    return F.transform(arr, lambda x: F.variant_get(x, path, type_))


MARKUP_REGEX = r"<[^>]+>"  # fixed value: what counts as a tag


def strip_markup(c: Column | str) -> Column:
    """Tags become one blank each, then outer blanks are trimmed. Entities and
    inner blank runs stay, as in the reference."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(c, MARKUP_REGEX, " "))


PATH_SEPARATOR_REGEX = r"\\"  # one literal backslash


def path_parts(c: Column | str, sep_regex: str = PATH_SEPARATOR_REGEX) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.split(c, sep_regex)


def path_level(parts: Column, level: int) -> Column:
    """1-based element, negative from the end; NULL when the path is shorter
    (``try_element_at``: ``element_at`` raises under ANSI)."""
    return F.try_element_at(parts, F.lit(level))


def with_path_levels(df: DataFrame, path_col: str, prefix: str, levels: int = 3,
                     last_col: str | None = None) -> DataFrame:
    """Split the path once into a helper column, then read the levels from it."""
    helper = f"_{prefix}_parts"
    df = df.withColumn(helper, path_parts(path_col))
    cols = {f"{prefix}_{i}": path_level(F.col(helper), i) for i in range(1, levels + 1)}
    if last_col:
        cols[last_col] = path_level(F.col(helper), -1)
    return df.withColumns(cols).drop(helper)


def comma_list(c: Column | str) -> Column:
    """'a, b,,c ' -> ['a','b','c']: split on commas, trim, drop blanks."""
    c = F.col(c) if isinstance(c, str) else c
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
