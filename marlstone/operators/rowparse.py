"""Rows that fail to parse, apart from the valid ones, by regular expressions generated from a schema.

For each kind of fault (too few columns, broken quoting, invalid value) an anchored pattern for whole rows is
generated; a row that fits them all is valid. Only rows that don't fit go through the patterns of growing field
prefixes, which name the first broken field. Everything is evaluated inside the JVM. All repeated groups are
possessive, so texts of any length match without recursion.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.stages import BLANK, strip_blanks

_B = rf"[{BLANK}]*+"
_H = r"[\h\x{200B}\x{2060}\x{FEFF}]*+"
#: U+FFFD and the control characters other than tab and line ends.
DAMAGED = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{84}\x{86}-\x{9F}\x{FFFD}]"


@dataclass(frozen=True)
class Field:
    """A column of delimited rows: its name, the pattern of valid values (None: anything), and whether case is corrected to ``upper`` or ``lower``."""

    name: str
    value: str | None = None
    case: str | None = None

    def any(self, rest: bool) -> str:
        return r"(?s:.*+)" if rest else r"[^|]*+"

    def quoted(self, rest: bool) -> str:
        """Blanks, then either no quote or one that closes at the end, with inner quotes doubled."""
        inner = r'[^"]*+(?:""[^"]*+)*+' if rest else r'[^"|]*+(?:""[^"|]*+)*+'
        return rf'{_B}(?:"{inner}"{_B}|(?!"){self.any(rest)})'

    def valid(self, rest: bool) -> str:
        if self.value is None:
            return self.any(rest)
        v = f"(?i:{self.value})" if self.case else f"(?:{self.value})"
        return rf'{_B}(?:"{_B}{v}{_B}"|{v}){_B}'


def patterns(fields: list[Field]) -> dict[str, list[str]]:
    """For columns, quoting and value: the patterns of the prefixes of 1, 2, ... fields; the last is that of the whole row."""
    out: dict[str, list[str]] = {}
    for fault, part in (("columns", Field.any), ("quoting", Field.quoted), ("value", Field.valid)):
        last = len(fields) - 1
        out[fault] = ["^" + "".join(part(f, k == last) + ("" if k == last else "[|]") for k, f in enumerate(fields[: n + 1])) + (r"\z" if n == last else "") for n in range(last + 1)]
    return out


def unquoted(c: Column) -> Column:
    """``c`` without blanks around it and without correct outer quotes."""
    t = strip_blanks(c)
    quoted = t.rlike(r'^"[^"]*+(?:""[^"]*+)*+"\z')
    return F.when(quoted, F.replace(F.substr(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))).otherwise(t)


def parsed_rows(rows: DataFrame, text: str, fields: list[Field]) -> DataFrame:
    """``rows`` with reason, field and loaded.

    reason is the first that holds of missing (null or blank), columns, quoting and value, or null for a valid row;
    field is the first broken field of that reason (null for missing). loaded is a struct of the fields of a valid
    row, cut and unquoted, else null. Further ``|`` belong to the last field. Columns so named are replaced.
    """
    t, p = F.col(text).cast("string"), patterns(fields)
    fits = {fault: t.rlike(ps[-1]) for fault, ps in p.items()}
    reason = F.when(t.isNull() | (strip_blanks(t) == ""), "missing")
    for fault in p:
        reason = reason.when(~fits[fault], fault)

    def broken(fault: str) -> Column:
        out = None
        for f, prefix in zip(fields[:-1], p[fault][:-1], strict=True):
            out = F.when(~t.rlike(prefix), f.name) if out is None else out.when(~t.rlike(prefix), f.name)
        return out.otherwise(fields[-1].name) if out is not None else F.lit(fields[-1].name)

    field = None
    for fault in p:
        field = F.when(F.col("reason") == fault, broken(fault)) if field is None else field.when(F.col("reason") == fault, broken(fault))
    parts = F.split(t, "[|]", len(fields))
    cells = []
    for k, f in enumerate(fields):
        c = strip_blanks(unquoted(F.get(parts, F.lit(k))))
        cells.append((F.upper(c) if f.case == "upper" else F.lower(c) if f.case == "lower" else c).alias(f.name))
    return rows.drop("reason", "field", "loaded").withColumn("reason", reason).withColumn("field", field).withColumn("loaded", F.when(F.col("reason").isNull(), F.struct(*cells)))


def parsed_texts(rows: DataFrame, text: str, record: list[Field]) -> DataFrame:
    """``rows`` with reason and loaded, for a free text that must not be a glued row of ``record``.

    columns: a line begins with the columns of a record (all but its last); quoting as of a single field; value:
    U+FFFD or a control character other than tab and line ends. loaded is the text without correct outer quotes.
    """
    t = F.col(text).cast("string")
    glued = "(?m)^" + "".join(rf"{_H}(?:{f.value}){_H}[|]" for f in record[:-1])
    alone = "^" + Field(text).quoted(True) + r"\z"
    reason = F.when(t.isNull() | (strip_blanks(t) == ""), "missing").when(t.rlike(glued), "columns").when(~t.rlike(alone), "quoting").when(t.rlike(DAMAGED), "value")
    return rows.drop("reason", "loaded").withColumn("reason", reason).withColumn("loaded", F.when(F.col("reason").isNull(), unquoted(t)))


def split_failures(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, failed) rows of parsed_rows or parsed_texts."""
    return parsed.filter("reason is null").drop("reason", "field"), parsed.filter("reason is not null").drop("loaded")


#: The columns of a model output and of a label row.
OUTPUT = [Field("rt", "[A-E]", "upper"), Field("sk", "[a-u]", "lower"), Field("description")]


def after_thinking(c: Column) -> Column:
    """What follows the last closing think tag."""
    return F.substring_index(c, "</think>", -1)
