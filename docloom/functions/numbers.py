"""Number parsing, array coercion and rectangle arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.text import strip

_FLOAT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
_INT = r"^[+-]?\d+\z"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _digits(value: Column) -> Column:
    return F.regexp_replace(strip(value), r"(?<=\d)_(?=\d)", "")


def parse_double(value: Column | str) -> Column:
    """Number or null.

    A plain cast would take ``1d`` and refuse ``1_000``; the guard keeps document
    text from turning into numbers by accident.
    """
    raw = _col(value)
    text = _digits(raw)
    word = F.lower(F.regexp_replace(text, r"^\+", ""))
    rare = (
        F.when(text.rlike(_FLOAT), text.try_cast("double"))
        .when(word.isin("nan", "-nan"), F.lit(float("nan")))
        .when(word.isin("inf", "infinity"), F.lit(float("inf")))
        .when(word.isin("-inf", "-infinity"), F.lit(float("-inf")))
    )
    # plain numbers take one match; spaces, underscores and words the slower branch
    return F.when(raw.rlike(_FLOAT), raw.try_cast("double")).when(raw.isNotNull(), rare)


def parse_int(value: Column | str) -> Column:
    raw = _col(value)
    text = _digits(raw)
    return F.when(raw.rlike(_INT), raw.try_cast("long")).when(text.rlike(_INT), text.try_cast("long"))


def parse_count(value: Column | str) -> Column:
    """Integer from a JSON number; fractions are cut, anything else is null."""
    return F.coalesce(parse_int(value), parse_double(value).try_cast("long"))


def first_double(*values: Column, default: float | None = None) -> Column:
    """First value that parses as a number."""
    options = [parse_double(v) for v in values]
    if default is not None:
        options.append(F.lit(default))
    return F.coalesce(*options)


def confidence_or_one(value: Column | str) -> Column:
    """Missing confidence counts as 1.0; a non-numeric one stays null (see ``bad_confidence``)."""
    return F.when(_col(value).isNull(), F.lit(1.0)).otherwise(parse_double(value))


def bad_confidence(value: Column | str) -> Column:
    """True where a confidence is given but is no number: the row belongs in quarantine."""
    return _col(value).isNotNull() & parse_double(value).isNull()


def double_array(value: Column | str) -> Column:
    """array<string> to array<double>."""
    return F.transform(_col(value), parse_double)


# Two-point boxes, the usual case, stay inside generated code; longer lists use array functions.
_RECT = """
CASE WHEN size({p}) = 4 THEN named_struct(
       'x', least({p}[0], {p}[2]), 'y', least({p}[1], {p}[3]),
       'w', abs({p}[2] - {p}[0]), 'h', abs({p}[3] - {p}[1]))
     ELSE transform(array(struct(filter({p}, (v, i) -> i % 2 = 0) AS xs, filter({p}, (v, i) -> i % 2 = 1) AS ys)),
       a -> named_struct('x', array_min(a.xs), 'y', array_min(a.ys),
         'w', array_max(a.xs) - array_min(a.xs), 'h', array_max(a.ys) - array_min(a.ys)))[0] END
"""


def rect_from_points(points: str) -> Column:
    """Bounding rectangle of an alternating x, y list column; parts are null for a list without y."""
    return F.expr(_RECT.format(p=points))


def rect_of_region(bounding_box: str, polygon: str) -> Column:
    """Box column first, polygon column when the box is empty, zeros when both are."""
    return F.expr(
        f"CASE WHEN size({bounding_box}) > 0 THEN {_RECT.format(p=bounding_box)} "
        f"WHEN size({polygon}) > 0 THEN {_RECT.format(p=polygon)} "
        "ELSE named_struct('x', 0.0D, 'y', 0.0D, 'w', 0.0D, 'h', 0.0D) END"
    )


def rect_area(bbox: Column | str) -> Column:
    """Area of ``[x0, y0, x1, y1]``; other lengths have none, negative extents count as 0."""
    bbox = _col(bbox)
    width = F.greatest(F.get(bbox, 2) - F.get(bbox, 0), F.lit(0.0))
    height = F.greatest(F.get(bbox, 3) - F.get(bbox, 1), F.lit(0.0))
    return F.when(F.size(bbox) == 4, width * height).otherwise(F.lit(0.0))


def clamp_one(value: Column) -> Column:
    return F.least(value, F.lit(1.0))
