"""Texts: white space as Python sees it, word counts, shares of characters, tags and validators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlstone import vocab


def stripped(c: Column) -> Column:
    """``c`` without white space of any kind at either end; trim() would cut spaces only."""
    return F.regexp_replace(c, f"^[{vocab.WHITE}]+|[{vocab.WHITE}]++$", "")


def word_list(c: Column) -> Column:
    """The words of ``c`` between white space of any kind; none for an empty or blank text, null for null."""
    return F.filter(F.split(c, f"[{vocab.WHITE}]+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(word_list(F.coalesce(c, F.lit(""))))


def cjk_count(c: Column) -> Column:
    """Characters of ``c`` from U+4E00 to U+9FFF."""
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\x{4E00}-\x{9FFF}]+", ""))


def cjk_ratio(c: Column) -> Column:
    """Share of such characters; 0 for null and empty texts."""
    return F.coalesce(F.try_divide(cjk_count(c), F.length(c)), F.lit(0.0)).cast("double")


def normal_tags(c: Column, tags: dict[str, str] = vocab.TAGS) -> Column:
    for old, new in tags.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def first_text(*columns: Column) -> Column:
    """The first that is neither null nor empty, else an empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def reasoning_text(identity: Column, scene: Column, conclusion: Column) -> Column:
    """One text of three clues under their tags; null clues count as empty."""
    parts = [stripped(F.coalesce(c, F.lit(""))) for c in (identity, scene, conclusion)]
    return F.concat_ws(" ", *[x for tag, part in zip(vocab.TAGS.values(), parts, strict=True) for x in (F.lit(tag), part)])


def marked(c: Column, *marks: str) -> Column:
    """Whether ``c`` holds one of ``marks``; a null holds none."""
    out = F.lit(False)
    for m in marks:
        out = out | F.contains(c, F.lit(m))
    return F.coalesce(out, F.lit(False))


def mostly_cjk(c: Column) -> Column:
    """More than four and more than a tenth of the characters."""
    return cjk_count(c) > F.greatest(F.lit(4.0), F.length(F.coalesce(c, F.lit(""))) * 0.1)


def record_errors(record: Column) -> Column:
    """What is wrong with a labeler's record (attributes, reasoning_chain, predictions), as an array; null members fail."""
    p, a = record["predictions"], record["attributes"]
    n = word_count(p["description"])
    member = lambda c, values: F.coalesce(c.isin(*values), F.lit(False))
    checks = [
        F.when(~member(p["role_type"], vocab.ROLES), "role_type"),
        F.when(~member(p["sub_keyscene"], vocab.SCENES), "sub_keyscene"),
        F.when(~n.between(10, 40), F.concat(F.lit("description:"), n.cast("string"))),
        F.when(mostly_cjk(record["reasoning_chain"]), "reasoning_chain"),
        *[F.when(~member(a[head], values), head) for head, values in vocab.ATTRIBUTES.items()],
    ]
    return F.array_compact(F.array(*checks))


def rationale_errors(verdict: Column, evidence: Column, chain: Column) -> Column:
    """What is wrong with a rationale: its verdict, empty evidence, and, if supported, a chain of other than 15 to 60 words or mostly CJK."""
    supported = F.coalesce(verdict == "supported", F.lit(False))
    n = word_count(chain)
    checks = [
        F.when(~F.coalesce(verdict.isin("supported", "unsupported"), F.lit(False)), "verdict"),
        F.when(F.coalesce(F.size(evidence), F.lit(0)) <= 0, "evidence"),
        F.when(supported & ~n.between(15, 60), F.concat(F.lit("chain:"), n.cast("string"))),
        F.when(supported & mostly_cjk(chain), "reasoning_chain"),
    ]
    return F.array_compact(F.array(*checks))
