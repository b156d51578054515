"""Column expressions shared by the operators.  All built-in, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from genospark.schemas import DECODE_GENOTYPE, SEPARATORS, VALID_ALLELES


def clean_line(line: Column) -> Column:
    """Strip spaces and line ends at both sides; tabs stay so empty edge fields survive."""
    return F.btrim(line, F.lit(" \r\n"))


_REGEX_META = set(".$|()[{^?*+\\")


def _pattern(sep: str) -> str:
    """Regex for a literal separator.  A single ordinary character stays as
    it is, so the JVM splits it without compiling a regex per row."""
    if len(sep) == 1 and sep not in _REGEX_META:
        return sep
    return "\\Q" + sep + "\\E"


def split_literal(text: Column, sep) -> Column:
    """Split on a literal separator (a Python string or a column).

    ``split`` takes a regex; a non-constant pattern would be compiled for
    every row, so a separator column is matched against the known candidates,
    each with a constant pattern, and only an unknown one is quoted per row.
    """
    if isinstance(sep, str):
        return F.split(text, _pattern(sep), -1)
    out = None
    for s in SEPARATORS:
        branch = F.split(text, _pattern(s), -1)
        out = F.when(sep == s, branch) if out is None else out.when(sep == s, branch)
    return out.otherwise(F.split(text, F.concat(F.lit("\\Q"), sep, F.lit("\\E")), -1))


def decode_pair(a1: Column, a2: Column) -> Column:
    """Allele pair -> genotype digit as int; null when the pair is not decodable."""
    pair = F.concat(a1, a2)
    expr = None
    for p, code in DECODE_GENOTYPE:
        expr = (F.when(pair == p, F.lit(int(code))) if expr is None
                else expr.when(pair == p, F.lit(int(code))))
    return expr


def allele_ok(allele: Column) -> Column:
    return allele.isin(VALID_ALLELES)


def separator_candidates() -> Column:
    """Array of (priority, sep) structs in trial order, as a literal."""
    return F.array(*[F.struct(F.lit(i).alias("priority"), F.lit(s).alias("sep"))
                     for i, s in enumerate(SEPARATORS)])


def first_separator(text: Column, required: list[str]) -> Column:
    """First separator whose split of ``text`` holds every required field name (null if none)."""
    def ok(c):
        fields = split_literal(text, c["sep"])
        cond = None
        for name in required:
            has = F.array_contains(fields, F.lit(name))
            cond = has if cond is None else (cond & has)
        return cond
    return F.get(F.filter(separator_candidates(), ok), 0)["sep"]

