"""Tax documents and postcodes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import digits_only, pad_left

# Check-digit weights of a 14-digit company number.
CNPJ_WEIGHTS = (
    (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2),
    (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2),
)


def cnpj_valid(c: Column) -> Column:
    """Mod-11 check digits of a 14-digit company number (any mask); all-equal digits are rejected, NULL is FALSE."""

    def check_digit(doc: Column, weights: tuple[int, ...]) -> Column:
        total = sum((F.substring(doc, i + 1, 1).cast("int") * F.lit(w) for i, w in enumerate(weights)), F.lit(0))
        rest = total % 11
        return F.when(rest < 2, F.lit(0)).otherwise(F.lit(11) - rest)

    def holds(doc: Column) -> Column:
        shaped = (F.length(doc) == 14) & ~doc.rlike(r"^(\d)\1{13}$")
        digits = [F.substring(doc, 13 + i, 1).cast("int") == check_digit(doc, w) for i, w in enumerate(CNPJ_WEIGHTS)]
        return F.when(shaped, digits[0] & digits[1]).otherwise(F.lit(False))

    # The lambda binds the cleaned number once: the ~30 digit reads do not repeat the caller's expression.
    return F.get(F.transform(F.array(F.coalesce(digits_only(c), F.lit(""))), holds), F.lit(0))


def doc_type(c: Column, null_is_invalid: bool = False) -> Column:
    """CPF (11 digits), CNPJ (14), NULO (missing or blank), else INVALIDO. Older jobs call a missing one INVALIDO."""
    size = F.length(digits_only(c))
    missing = F.lit("INVALIDO" if null_is_invalid else "NULO")
    return (
        F.when(c.isNull() | (F.trim(c.cast("string")) == ""), missing)
        .when(size == 14, F.lit("CNPJ"))
        .when(size == 11, F.lit("CPF"))
        .otherwise(F.lit("INVALIDO"))
    )


def postcode_key(c: Column) -> Column:
    """Eight digits, zero-padded (a longer input is cut; blank becomes 00000000)."""
    return pad_left(digits_only(c), 8)


def is_generic_cep(c: Column) -> Column:
    """Eight digits ending in 000: stands for a whole municipality."""
    return (F.length(c) == 8) & c.endswith("000")


def dashed_cep(c: Column) -> Column:
    return F.concat(F.substring(c, 1, 5), F.lit("-"), F.substring(c, 6, 3))
