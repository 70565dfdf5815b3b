"""The strict event-line check: one JSON object with the key ``Event``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tracewright.functions.once import computed_once
from tracewright.functions.text import stripped

BLANK, NOT_UTF8, NOT_JSON, MISSING_EVENT, OK = (
    "blank",
    "not_utf8",
    "not_json",
    "missing_event",
    "ok",
)


def _stripped_if_needed(line: str) -> Column:
    """Trimming a character set walks the whole line; one that starts and ends
    with braces has nothing to trim."""
    braced = F.startswith(F.col(line), F.lit("{")) & F.endswith(F.col(line), F.lit("}"))
    return F.when(braced, F.col(line)).otherwise(stripped(line))


#: No limit on the length of a string, a number or a line, nor on its nesting.
_MOST = str((1 << 31) - 1)
_JSON = {
    "maxStringLen": _MOST,
    "maxNumLen": _MOST,
    "maxNestingDepth": _MOST,
    "allowSingleQuotes": "false",
}


def _sealed(text: Column, seal: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit(',{"_seal":"'), seal, F.lit('"}]'))


def with_verdict(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add ``verdict`` (see the names above) and ``event``, the text of the
    line's ``Event``, trimming each line once and parsing a good one once.

    The parser ignores text after the first value, so the line is parsed in an
    array closed by its own hash, ``[line, {seal}]``: anything but one whole
    value before the comma leaves element 1 something other than the seal. Of the
    line only ``Event`` is built; the rest is checked and passed over. Lines
    without an ``Event`` value are looked at again: they are no object, or the
    key is absent, or its value is null.
    """
    parsed, verdict, event = _judged(lines, line)
    judged = parsed.withColumns({"verdict": verdict, "event": F.when(verdict == OK, event)})
    return judged.drop(*_PARSED)


def good_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """The lines whose :func:`with_verdict` is good, with their ``event``. What makes the
    verdict is not compiled, so the filter alone asks for it."""
    parsed, verdict, event = _judged(lines, line)
    return parsed.where(verdict == OK).withColumn("event", event).drop(*_PARSED)


_PARSED = ("_text", "_seal", "_parsed")


def _judged(lines: DataFrame, line: str) -> tuple[DataFrame, Column, Column]:
    """The parsed lines, and the verdict and event of each."""
    text, seal = F.col("_text"), F.col("_seal")
    sealed = _sealed(text, seal)
    braced = F.startswith(text, F.lit("{"))
    whole = "array<struct<Event:string,_seal:string>>"
    # The parse alone stays behind the generator: what is made of it is compiled.
    parsed = computed_once(
        lines.withColumn("_text", _stripped_if_needed(line)).withColumn(
            "_seal", F.xxhash64(text).cast("string")
        ),
        _parsed=F.when(braced, F.from_json(sealed, whole, _JSON)),
    )
    event = F.get("_parsed", 0)["Event"]
    is_object = F.coalesce(F.get("_parsed", 1)["_seal"] == seal, F.lit(False))
    keys = F.map_keys(F.from_json(text, "map<string,string>", _JSON))
    other = F.from_json(sealed, "array<string>", _JSON)
    is_value = F.coalesce(F.from_json(F.get(other, 1), "_seal string", _JSON)["_seal"] == seal, F.lit(False))
    verdict = (
        F.when(text == "", BLANK)
        .when(~F.is_valid_utf8(F.col(line)), NOT_UTF8)
        .when(is_object & event.isNotNull(), OK)
        .when(is_object, F.when(F.array_contains(keys, "Event"), OK).otherwise(MISSING_EVENT))
        .when(~braced & is_value, MISSING_EVENT)
        .otherwise(NOT_JSON)
    )
    return parsed, verdict, event


def event_kind(event: str | Column) -> Column:
    """The class name of an event; SQL events carry a package prefix."""
    return F.substring_index(event, ".", -1)
