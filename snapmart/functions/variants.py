"""Reading loosely typed JSON held in VARIANT columns.

Two notions of "absent" exist in the source data: a missing key, and any empty
value (null, 0, '', {}, []).  ``*_at`` treat null and missing alike;
``truthy`` implements the second notion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmart.settings import JSON_GUARDS

_EMPTY_SHOWN = r"^(\{\}|\[\]|false|-?0(\.0+)?)$"

_JSON_START = r"^[ \t\r\n]*[\[{\"\-0-9tfn]"

# A body is parsed inside this frame.  Spark's parser stops after the first value
# of a text; inside the frame anything behind that value makes it unreadable.
_OPEN, _CLOSE = '[[{"v":[[', "]]}]]"
_ROOT = "$[0][0].v[0][0]"
_SECOND = "$[0][0].v[0][1]"


def node_at(doc: Column, path: str) -> Column:
    """The sub-document at a path; NULL when any step is missing."""
    return F.try_variant_get(doc, path, "variant")


def text_at(doc: Column, path: str) -> Column:
    """The value at a path as text."""
    return F.try_variant_get(doc, path, "string")


def long_at(doc: Column, path: str) -> Column:
    """The value at a path as a whole number (numeric text included)."""
    return F.try_variant_get(doc, path, "bigint")


def has_value(value: Column) -> Column:
    """Present and not a JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def is_text(value: Column) -> Column:
    """Whether a variant holds a JSON string."""
    return F.schema_of_variant(value) == F.lit("STRING")


def truthy(value: Column) -> Column:
    """Whether a variant is neither missing, null, zero, false nor empty."""
    shown = value.try_cast("string")
    looks_empty = shown.rlike(_EMPTY_SHOWN)
    return F.coalesce((shown != "") & (~looks_empty | is_text(value)), F.lit(False))


def truthy_node(value: Column) -> Column:
    """As :func:`truthy`, for values that are objects as a rule (never rendered as text)."""
    kind = F.schema_of_variant(value)
    return F.coalesce(
        F.when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .when(kind.startswith("ARRAY"), node_at(value, "$[0]").isNotNull())
        .otherwise(truthy(value)),
        F.lit(False),
    )


def truthy_text(value: Column) -> Column:
    """A variant as text, or NULL when it is empty in any sense."""
    return F.when(truthy(value), value.try_cast("string"))


def truthy_long(value: Column) -> Column:
    """0 for empty values, the number for numbers and numeric text, else NULL."""
    empty = F.coalesce(value.try_cast("string"), F.lit("")).isin("", "{}", "[]")
    return F.coalesce(value.try_cast("bigint"), F.when(empty, F.lit(0)))


def count_or_zero(value: Column) -> Column:
    """0 when missing, the number for numbers and numeric text, else NULL (explicit null too)."""
    return F.when(value.isNull(), F.lit(0).cast("bigint")).otherwise(value.try_cast("bigint"))


def filled(text: Column) -> Column:
    """Text, or NULL when it is empty."""
    return F.nullif(text, F.lit(""))


def shaped_at(doc: Column, path: str, shape: str) -> Column:
    """The value at a path as one typed value, in a single walk.

    Missing keys and values of another kind become NULL where they are, without
    affecting the rest.
    """
    return F.try_variant_get(doc, path, shape)


def without_guard(body: Column) -> Column:
    """Remove one leading guard such as ``for (;;);`` from a body."""
    cut = body
    for guard in reversed(JSON_GUARDS):
        cut = F.when(body.startswith(guard), F.substr(body, F.lit(len(guard) + 1))).otherwise(cut)
    return cut


def framed(body: Column) -> Column:
    """A body decoded inside the frame; see :func:`in_frame` and :func:`is_single`."""
    return F.try_parse_json(F.concat(F.lit(_OPEN), body, F.lit(_CLOSE)))


def framed_tolerant(body: Column) -> Column:
    """As is, then without a guard, then from the first ``{``, then from ``[``.

    Attempts that cannot succeed are left out: a body with a guard or with a
    first character that begins no JSON value is not tried as it is.
    """
    guarded = F.lit(False)
    for guard in JSON_GUARDS:
        guarded = guarded | body.startswith(guard)

    def from_first(mark: str) -> Column:
        start = F.instr(body, mark)
        return F.when(start > 1, framed(F.substr(body, start)))

    return F.coalesce(
        F.when(guarded, framed(without_guard(body))).when(
            body.rlike(_JSON_START), framed(body)
        ),
        from_first("{"),
        from_first("["),
    )


def in_frame(path: str) -> str:
    """A path of the body as a path of its framed form."""
    return _ROOT + path[1:]


def is_single(doc: Column) -> Column:
    """Whether a framed body held one value only."""
    return node_at(doc, _SECOND).isNull()


def _single_value(doc: Column) -> Column:
    # The lambda binds the framed document, so that it is parsed only once.
    only = F.transform(F.array(doc), lambda d: F.when(is_single(d), node_at(d, _ROOT)))
    return F.get(only, F.lit(0))


def decode_json(body: Column) -> Column:
    """Strict decoding; NULL for anything that is not exactly one JSON value."""
    return _single_value(framed(body))


def decode_tolerant(body: Column) -> Column:
    """Decoding with the fallbacks of :func:`framed_tolerant`; NULL when all fail."""
    return _single_value(framed_tolerant(body))
