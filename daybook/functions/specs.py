"""The step I/O spec grammar (G1) and its tag encoding (G2), as Columns.

Spec text is ``name``, ``name:<n><unit letter>`` (``raw:5d``, ``x:12M``),
``name:<n>`` (days), ``name:*`` or ``name:`` (no window).  The name is
everything before the **first** colon, so ``a:b:3d`` is dataset ``a`` without
a window (``params:<name>`` is no dataset at all; the runner passes the value).  A window needs ``n > 0``; anything else means "no completeness
requirement, read everything".

Tags are the text form ``<prefix>--<name>--<n>--<unit>`` or
``<prefix>--<name>--<n>`` (unit day).  Other prefixes, non-integer or
non-positive ``n`` are dropped; when one name has several tags the last one
wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.calendar import UNIT_LETTERS

_NEW_FORM = r"^([0-9]+)([dDmMqQyY])$"
_OLD_FORM = r"^\s*\+?([0-9]+)\s*$"


def _unit_of_letter(letter: Column) -> Column:
    lower = F.lower(letter)
    expr = None
    for k, v in UNIT_LETTERS.items():
        expr = F.when(lower == k, F.lit(v)) if expr is None else expr.when(lower == k, F.lit(v))
    return expr


def parse_spec(spec: Column | str) -> Column:
    """``struct<name string, n int, unit string>`` parsed from a spec (G1).

    ``n``/``unit`` are NULL when the spec carries no usable window.
    """
    spec = F.col(spec) if isinstance(spec, str) else spec
    has_colon = F.instr(spec, ":") > 0
    name = F.when(has_colon, F.substring_index(spec, ":", 1)).otherwise(spec)
    rest = F.when(has_colon, F.substring(spec, F.instr(spec, ":") + 1, F.length(spec)))
    new_n = F.regexp_extract(rest, _NEW_FORM, 1)
    old_n = F.regexp_extract(rest, _OLD_FORM, 1)
    is_new = rest.rlike(_NEW_FORM)
    is_old = rest.rlike(_OLD_FORM)
    n = (
        F.when(is_new, new_n.try_cast("int"))
        .when(is_old, old_n.try_cast("int"))
    )
    unit = F.when(is_new, _unit_of_letter(F.regexp_extract(rest, _NEW_FORM, 2))).when(is_old, F.lit("day"))
    usable = F.coalesce(n > 0, F.lit(False))
    return F.struct(
        name.alias("name"),
        F.when(usable, n).alias("n"),
        F.when(usable, unit).alias("unit"),
    )


def spec_to_tag(prefix: str, spec: Column | str) -> Column:
    """The tag text the spec encodes to (NULL when the spec has no colon)."""
    spec = F.col(spec) if isinstance(spec, str) else spec
    has_colon = F.instr(spec, ":") > 0
    name = F.substring_index(spec, ":", 1)
    rest = F.substring(spec, F.instr(spec, ":") + 1, F.length(spec))
    new_tag = F.concat_ws(
        "--", F.lit(prefix), name, F.regexp_extract(rest, _NEW_FORM, 1),
        _unit_of_letter(F.regexp_extract(rest, _NEW_FORM, 2)),
    )
    weight = F.when((rest == "*") | (rest == ""), F.lit("0")).otherwise(rest)
    old_tag = F.concat_ws("--", F.lit(prefix), name, weight)
    return F.when(has_colon, F.when(rest.rlike(_NEW_FORM), new_tag).otherwise(old_tag))


def decode_tag(tag: Column | str, prefix: str) -> Column:
    """``struct<name, n, unit>`` from one tag (G2); NULL when the tag is dropped."""
    tag = F.col(tag) if isinstance(tag, str) else tag
    parts = F.split(tag, "--")
    k = F.size(parts)
    n = F.element_at(parts, 3).try_cast("int")
    keep = (F.element_at(parts, 1) == F.lit(prefix)) & k.isin(3, 4) & F.coalesce(n > 0, F.lit(False))
    unit = F.when(k == 4, F.element_at(parts, 4)).otherwise(F.lit("day"))
    return F.when(
        keep,
        F.struct(F.element_at(parts, 2).alias("name"), n.alias("n"), unit.alias("unit")),
    )


def decode_tags(tags: DataFrame, keys: list[str], tag_col: str, order_cols: list[str], prefix: str) -> DataFrame:
    """Decode a table of tags into one window per ``keys + name`` (last one wins).

    ``order_cols`` give the tag order inside a key; the fold is a ``max_by``
    aggregate, which combines map-side, so a key with very many tags never
    lands whole in one task.
    """
    decoded = tags.select(*keys, *order_cols, decode_tag(tag_col, prefix).alias("t")).where(
        F.col("t").isNotNull()
    )
    order = F.struct(*[F.col(c) for c in order_cols])
    return decoded.groupBy(*keys, F.col("t.name").alias("name")).agg(
        F.max_by(F.struct(F.col("t.n").alias("n"), F.col("t.unit").alias("unit")), order).alias("w")
    ).select(*keys, "name", F.col("w.n").alias("n"), F.col("w.unit").alias("unit"))
