"""Text cleaning as pure Column expressions (no Python workers)."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Spellings that mean NULL, one list per job family.
NULL_TOKENS: dict[str, tuple[str, ...]] = {
    "registry": ("", "nan", "NaN", "None", "none", "null", "NULL", "NaT", "na", "NA"),
    "rates": ("", "nan", "None", "none", "null", "NULL"),
    "standing": ("", "NULL", "NAN", "NONE", "-"),
    "number": ("", "null", "nan", "None", "NaN", "NULL", "none"),
    "cst": ("", "nan", "null", "None", "NaN"),
    "cfop": ("", "null", "nan", "None"),
    "municipality": ("", "NULL", "NAN", "NONE", "NAO INFORMADO"),
    "name": ("", "NULL", "NAN", "NONE"),
    "invoice": ("", "-", "NaN", "nan", "0"),
}



def _folding_table() -> tuple[str, str]:
    """Upper-case Latin letters with marks and their base letter, from the Unicode decompositions."""
    pairs = []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        if base != letter and "A" <= base <= "Z":
            pairs.append((letter, base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _folding_table()

# Leading street types that are ignored when street names are compared.
STREET_TYPES = [
    "AVENIDA", "AVENUE", "AV", "RUA", "RODOVIA", "ROD", "ESTRADA", "EST", "ALAMEDA", "AL", "TRAVESSA", "TR", "TV",
    "PRACA", "PCA", "PC", "LARGO", "LGO", "LADEIRA", "VIELA", "BECO", "SETOR", "QUADRA", "QD", "CONJUNTO", "CJ",
    "LOTE", "LT", "VILA", "VL", "PARQUE", "LINHA", "CORREDOR", "GALERIA", "RAMAL", "TRECHO", "TREVO", "VIA",
    "VIADUTO", "ACESSO",
]


def trimmed(c: Column) -> Column:
    return F.trim(c.cast("string"))


def trimmed_upper(c: Column) -> Column:
    return F.upper(trimmed(c))


def is_null_token(c: Column, kind: str, upper: bool = False) -> Column:
    """True for NULL and for every spelling of NULL in the list `kind`."""
    text = trimmed_upper(c) if upper else trimmed(c)
    return c.isNull() | text.isin(*NULL_TOKENS[kind])


def null_tokens(c: Column, kind: str, upper: bool = False) -> Column:
    """Trimmed text, with literal nulls of the list `kind` turned into NULL."""
    return F.when(~is_null_token(c, kind, upper), trimmed(c))


def norm_str(c: Column) -> Column:
    """Trimmed text; blank, NULL, NaN, NONE and '-' in any case become NULL."""
    return null_tokens(c, "standing", upper=True)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings to NULL in every string column, other columns untouched."""
    return df.select(
        *[
            F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def strip_leading_zeros(c: Column) -> Column:
    """'007' -> '7'; a lone '0' stays."""
    return F.regexp_replace(trimmed(c), r"^0+(?=\d)", "")


def strip_decimal_suffix(c: Column) -> Column:
    """'51.0' -> '51': codes that went through a floating-point column."""
    return F.regexp_replace(trimmed(c), r"\.0$", "")


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"\D", "")


def pad_left(c: Column, width: int) -> Column:
    """Zero-padded on the left; longer input is cut to `width` (lpad semantics)."""
    return F.lpad(c, width, "0")


def clean_city(c: Column) -> Column:
    """City without a trailing ' - XX' suffix."""
    return F.trim(F.regexp_replace(c, r"\s*-\s*\w+$", ""))


def norm_text(c: Column) -> Column:
    """Accent-folded upper-case text of A-Z, 0-9 and single blanks; NULL gives ''."""
    folded = F.translate(F.upper(trimmed(c)), ACCENTED, PLAIN)
    # Combining marks that were written decomposed vanish; everything else outside A-Z0-9 is a separator.
    unmarked = F.regexp_replace(folded, r"\p{Mn}", "")
    spaced = F.regexp_replace(unmarked, r"[^A-Z0-9 ]", " ")
    return F.coalesce(F.trim(F.regexp_replace(spaced, r"\s+", " ")), F.lit(""))


def norm_street(c: Column) -> Column:
    """norm_text without the leading street type."""
    return F.trim(F.regexp_replace(norm_text(c), r"^(" + "|".join(STREET_TYPES) + r")\b\s*", ""))


def labelled(*pairs: tuple[str, Column]) -> Column:
    """'K: v | K: v' payload; a NULL value shows as an empty one."""
    return F.concat_ws(" | ", *[F.concat(F.lit(f"{k}: "), F.coalesce(v.cast("string"), F.lit(""))) for k, v in pairs])


def label_chain(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """First matching label of an ordered list of (condition, label)."""
    chain: Column | None = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    if chain is None:
        return default if isinstance(default, Column) else F.lit(default)
    if default is None:
        return chain
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def prepare_category(c: Column) -> Column:
    """Trimmed upper-case category, 'N/A' for NULL."""
    return F.upper(F.trim(F.coalesce(c.cast("string"), F.lit("N/A"))))


def parse_bool(c: Column, unknown: str = "null") -> Column:
    """Tri-state flag. unknown='null' keeps unknown spellings NULL, unknown='false' makes them FALSE."""
    # Spellings of true and false.
    yes = ("S", "SIM", "1", "TRUE", "T", "VERDADEIRO")
    no = ("N", "NAO", "NÃO", "0", "FALSE", "F", "FALSO")
    text = trimmed_upper(c)
    if unknown == "null":
        return F.when(text.isin(*yes), F.lit(True)).when(text.isin(*no), F.lit(False))
    known_null = is_null_token(c, "registry") | F.lower(c.cast("string")).isin(
        *[t.lower() for t in NULL_TOKENS["registry"]]
    )
    return F.when(known_null, F.lit(None).cast("boolean")).otherwise(text.isin("TRUE", "1", "SIM"))


def text_array(values: Iterable[str | None]) -> Column:
    """Constant array of texts, parsed in one go."""
    quoted = ["NULL" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values]
    return F.expr(f"array({', '.join(quoted)})")
