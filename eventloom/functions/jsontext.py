"""JSON text built from column expressions (all JVM-side, no Python per row).

The loader's raw-text fields (``EventData.RawData``, ``Event.RawData``) are JSON
*strings* stored in the destination, so their exact bytes matter.  They follow
the text form of Python's ``json.dumps`` with default arguments:

* separators ``", "`` between items and ``": "`` between key and value;
* every non-ASCII character written as ``\\uXXXX`` with lower-case hex digits
  (characters outside the BMP as a surrogate pair);
* control characters as ``\\n``, ``\\r``, ``\\t``, ``\\b``, ``\\f`` or ``\\u00XX``.

Spark's ``to_json`` with ``writeNonAsciiCharacterAsCodePoint`` gives the same
escapes with upper-case hex; :func:`json_str` lower-cases the four digits that
follow each real ``\\u`` escape (an escaped backslash ``\\\\`` is masked first so
that a literal backslash followed by ``u`` in the data is left alone).
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The item and key separators of Python's json.dumps defaults.
ITEM_SEP = ", "
KEY_SEP = ": "

_ASCII_ESCAPES = {"writeNonAsciiCharacterAsCodePoint": "true"}
# A character that cannot occur in to_json output (control characters are escaped there).
_MASK = "\u0001"


def _lower_unicode_escapes(j: Column) -> Column:
    masked = F.replace(j, F.lit("\\\\"), F.lit(_MASK))
    parts = F.split(masked, r"\\u")
    fixed = F.transform(
        parts,
        lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lower(F.substring(p, 1, 4)), F.substring(p, 5, 1 << 30))),
    )
    return F.replace(F.array_join(fixed, "\\u"), F.lit(_MASK), F.lit("\\\\"))


# Fixed value: printable ASCII other than '"' and '\\' needs no escape in JSON text.
_PLAIN = r"\A[\x20\x21\x23-\x5b\x5d-\x7e]*\z"


def json_text(c: Column) -> Column:
    """JSON string text of a column; NULL becomes ``null``.

    Non-ASCII characters are written as ``\\uXXXX`` (upper-case hex, as Spark
    writes them): the same JSON value as ``json.dumps`` gives.  Use
    :func:`dumps_compatible` on a finished text that is *stored* as a string and
    must equal ``json.dumps`` byte for byte.
    """
    s = c.cast("string")
    arr = F.to_json(F.array(s), _ASCII_ESCAPES)
    # to_json leaves DEL as it is; json.dumps escapes it.
    escaped = F.replace(F.substring(arr, 2, F.length(arr) - 2), F.lit("\x7f"), F.lit("\\u007f"))
    # Fast path: most values are plain ASCII and only need quotes.
    return F.when(s.isNull(), F.lit("null")).when(s.rlike(_PLAIN), F.concat(F.lit('"'), s, F.lit('"'))).otherwise(escaped)


def dumps_compatible(json_text_col: Column) -> Column:
    """Lower-case the hex digits of every ``\\u`` escape of a JSON text (``json.dumps`` form)."""
    return F.when(F.instr(json_text_col, "\\u") > 0, _lower_unicode_escapes(json_text_col)).otherwise(json_text_col)


def json_str(c: Column) -> Column:
    """JSON string text exactly as ``json.dumps`` writes it (see :func:`dumps_compatible`)."""
    return dumps_compatible(json_text(c))


def pair(key: str, value_json: Column) -> Column:
    """``"key": value`` fragment; NULL when ``value_json`` is NULL (so the key is left out)."""
    return F.concat(F.lit(_key_text(key) + KEY_SEP), value_json)


def obj(fragments: Iterable[Column]) -> Column:
    """``{...}`` from fragments; NULL fragments are skipped (concat_ws drops NULLs)."""
    frags = list(fragments)
    if not frags:
        return F.lit("{}")
    return F.concat(F.lit("{"), F.concat_ws(ITEM_SEP, *frags), F.lit("}"))


def _key_text(key: str) -> str:
    return json.dumps(key)


def attrs_and_text(attrs: dict[str, Column], text: Column | None) -> Column:
    """JSON value of one XML element under the usual XML-to-dict conventions.

    No attribute and no text -> ``null``; only text -> the string; otherwise an
    object with ``@attr`` keys and ``#text`` last.  Attributes are taken in the
    given order (the declared schema order).
    """
    any_attr = None
    for c in attrs.values():
        any_attr = c.isNotNull() if any_attr is None else (any_attr | c.isNotNull())
    text_json = json_text(text) if text is not None else F.lit("null")
    if any_attr is None:
        return text_json
    frags = [F.when(c.isNotNull(), pair("@" + name, json_text(c))) for name, c in attrs.items()]
    if text is not None:
        frags.append(F.when(text.isNotNull(), pair("#text", json_text(text))))
    return F.when(any_attr, obj(frags)).otherwise(text_json)


def struct_element(s: Column, attr_names: list[str], has_text: bool) -> Column:
    """JSON value of an element parsed as a struct of ``_attr`` fields (+ ``_VALUE``)."""
    attrs = {a: s[f"_{a}"] for a in attr_names}
    text = s["_VALUE"] if has_text else None
    return attrs_and_text(attrs, text)
