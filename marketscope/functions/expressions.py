"""Scalar expressions (Column -> Column); all JVM-side, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketscope.functions.sections import SECTIONS

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_id(basico: ColumnOrName = "cnpj_basico", ordem: ColumnOrName = "cnpj_ordem",
            dv: ColumnOrName = "cnpj_dv") -> Column:
    """Full company id = root || branch || check digits (NULL if any part is NULL)."""
    return F.concat(_c(basico), _c(ordem), _c(dv))


# Longest numeric prefix, the part of a text a lenient SQL REAL cast reads.
_NUMERIC_PREFIX = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"
_INTEGER_PREFIX = r"^([+-]?[0-9]+)"


def lenient_real(c: ColumnOrName) -> Column:
    """E2+E3: decimal comma to point, then text -> double the lenient way.

    '' and non-numbers give 0.0; '1.234.56' gives 1.234 (longest numeric prefix).
    """
    text = F.trim(F.regexp_replace(_c(c), ",", "."))
    prefix = F.regexp_extract(text, _NUMERIC_PREFIX, 1)
    return F.coalesce(prefix.try_cast("double"), F.lit(0.0))


def lenient_bigint(c: ColumnOrName) -> Column:
    """Id text -> bigint, leading zeros dropped; non-numbers give 0."""
    prefix = F.regexp_extract(F.trim(_c(c)), _INTEGER_PREFIX, 1)
    return F.coalesce(prefix.try_cast("bigint"), F.lit(0).cast("bigint"))


def tax_regime(mei: ColumnOrName = "opcao_mei", simples: ColumnOrName = "opcao_simples") -> Column:
    """1 = MEI, else 2 = Simples, else 3. Applied before the left join so
    companies absent from the regime table stay NULL."""
    return (F.when(_c(mei) == "S", F.lit(1))
            .when(_c(simples) == "S", F.lit(2))
            .otherwise(F.lit(3))).cast("int")


def size_or_unknown(c: ColumnOrName = "porte_empresa") -> Column:
    """A join miss (NULL) becomes '00'; a blank '' stays blank."""
    return F.coalesce(_c(c), F.lit("00"))


def division(code: ColumnOrName, lenient: bool = False) -> Column:
    """Activity division = first two characters as int.

    Strict mode fails the job on a malformed code (as the reference does);
    lenient mode yields NULL instead.
    """
    head = F.substring(_c(code), 1, 2)
    return head.try_cast("int") if lenient else head.cast("int")


def section_of(div: ColumnOrName) -> tuple[Column, Column]:
    """Division -> (section letter, section label); gaps give NULL."""
    d = _c(div)
    letter = label = None
    for lo, hi, sigla, desc in SECTIONS:
        cond = d.between(lo, hi)
        letter = F.when(cond, F.lit(sigla)) if letter is None else letter.when(cond, F.lit(sigla))
        label = F.when(cond, F.lit(desc)) if label is None else label.when(cond, F.lit(desc))
    return letter, label


def classify_section(code: ColumnOrName, lenient: bool = False) -> tuple[Column, Column]:
    """E8+E9: activity code -> (section letter, section label)."""
    return section_of(division(code, lenient))


def split_codes(c: ColumnOrName) -> Column:
    """Comma-separated code list -> array, no trimming (a space is kept)."""
    return F.split(_c(c), ",")


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """One double division."""
    return _c(num).cast("double") / _c(den).cast("double")
