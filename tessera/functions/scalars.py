"""Small functions on text, dates and numbers, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the bound of scores.
SCORE_MOST = 30000
#: Fixed value: the characters of a name, for borders of whole names.
NAME_CHAR = "[A-Za-z0-9_]"


def value_score(value: Column, scale: float) -> Column:
    """The score of a winning probability: the logit times ``scale``, held within 30000; certain wins and losses are the bounds."""
    inner = F.when((value > 0) & (value < 1), value)
    logit = -scale * F.ln(1 / inner - 1)
    return F.when(value == 1, F.lit(float(SCORE_MOST))).when(value == 0, F.lit(float(-SCORE_MOST))).otherwise(F.greatest(F.least(logit, F.lit(float(SCORE_MOST))), F.lit(float(-SCORE_MOST))))


def decay_rate(rate: Column, least: Column, epochs: Column) -> Column:
    """The factor that takes a learning rate to ``least`` in so many epochs."""
    return F.pow(least / rate, 1.0 / F.greatest(epochs, F.lit(1)))


def scaled_nodes(nodes: Column, factor: Column) -> Column:
    """Search nodes times a factor, halves rounded up, one at least."""
    return F.greatest(F.floor(nodes * factor + 0.5).cast("bigint"), F.lit(1).cast("bigint"))


def leading_number(text: Column, missing: int) -> Column:
    """The number that a text begins with, sign included: ``missing`` for an empty text, 0 for one without digits there."""
    found = F.regexp_extract(text, r"^([+-]?[0-9]+)", 1)
    return F.when(text == "", F.lit(missing).cast("bigint")).when(found == "", F.lit(0).cast("bigint")).otherwise(F.regexp_replace(found, r"^\+", "").cast("bigint"))


def safe_part(name: Column) -> Column:
    """A part of a path with control characters and ``<>:"|?*`` replaced; ``.`` and ``..`` stay."""
    return F.when(name.isin("", ".", ".."), name).otherwise(F.regexp_replace(name, r"""[\x00-\x1F\x7F-\x9F<>:"|?*]""", "_"))


def replace_names(text: Column, names: Mapping[str, str]) -> Column:
    """Whole names replaced by values: ``a_1`` in ``a_10`` is none. Values aren't searched again."""
    if not names:
        return text
    pairs = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    found = rf"(?<!{NAME_CHAR}){NAME_CHAR}+(?!{NAME_CHAR})"
    between = F.split(text, found, -1)
    words = F.transform(F.regexp_extract_all(text, F.lit(found), 0), lambda w: F.coalesce(F.element_at(pairs, w), w))
    return F.array_join(F.flatten(F.transform(F.arrays_zip(between.alias("a"), words.alias("b")), lambda x: F.array(x["a"], F.coalesce(x["b"], F.lit(""))))), "")


def spaceless(text: str) -> str:
    """A pattern that finds a text whatever white space stands between its characters."""
    return r"\s*".join(c if c.isalnum() else "\\" + c for c in text if not c.isspace())


def bound_day(text: Column, last: bool) -> Column:
    """The day of a bound: a whole date, with - or / and one digit or two, or a year alone, which is its first or last day; null if it is none."""
    t = F.trim(text)
    year = F.when(t.rlike(r"^[0-9]{4}$"), F.make_date(t.cast("int"), F.lit(12 if last else 1), F.lit(31 if last else 1)))
    part = lambda k: F.regexp_extract(t, r"^([0-9]{4})[-/]([0-9]{1,2})[-/]([0-9]{1,2})$", k)
    whole = F.try_to_timestamp(F.concat(part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")), F.lit("yyyyMMdd")).cast("date")
    return F.coalesce(year, F.when(t.rlike(r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}$"), whole))


def days(first: Column, last: Column) -> Column:
    """Every day from the first to the last, as an array; none if the last is before the first."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def place_of(items: Column, item: Column) -> Column:
    """The place of an item in a list, from 0; -1 if it isn't there."""
    return (F.array_position(items, item) - 1).cast("bigint")


def message(fields: Sequence[tuple[str, Column]]) -> Column:
    """One line of a JSON-lines protocol: an object of the fields that aren't null, without spaces."""
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields)))


def command(line: Column, schema: str) -> Column:
    """The object on a line of a JSON-lines protocol; null if the line is no object."""
    return F.when(F.trim(line).startswith("{"), F.from_json(line, schema))
