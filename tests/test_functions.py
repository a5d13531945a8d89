import random
import re
import unicodedata

from pyspark.sql import functions as F

from billproof.functions import dates as DT
from billproof.functions import documents as DOC
from billproof.functions import names as NM
from billproof.functions import numbers as N
from billproof.functions import text as T


def one(df, column):
    return [r[0] for r in df.select(column.alias("v")).collect()]


def plain_text(s):
    """Independent reading of the rule: upper, no marks, only A-Z 0-9 and single blanks."""
    s = "".join(ch for ch in unicodedata.normalize("NFD", (s or "").upper().strip()) if unicodedata.category(ch) != "Mn")
    return re.sub(r"\s+", " ", re.sub(r"[^A-Z0-9 ]", " ", s)).strip()


def test_norm_text_matches_unicode_rule(rows):
    samples = ["São João d'Água", None, "", "  ", "ÇÃÕÉ ñ", "é decomposed", "straße", "Łódź", "a\tb\nc", "№ 5ª", "ŸẼỹ"]
    got = one(rows("s string", [(s,) for s in samples]), T.norm_text(F.col("s")))
    assert got == [plain_text(s) for s in samples]


def test_norm_street(rows):
    samples = ["Rua das Flores", "AV. Brasil", "Avenida", "Ruanda", "praça XV", None, "Via"]
    assert one(rows("s string", [(s,) for s in samples]), T.norm_street(F.col("s"))) == ["DAS FLORES", "BRASIL", "", "RUANDA", "PRACA XV".replace("PRACA ", ""), "", ""]


def similarity(a, b):
    """Brute force over word lists."""

    def words(s):
        out, run = [], []
        for w in [*(s or "").split(), None]:
            if w is not None and re.fullmatch(r"[.\-/\d]+", w):
                run.append(w)
                continue
            if len(re.sub(r"\D", "", "".join(run))) < 5:
                out += run
            run = []
            if w is not None:
                out.append(w)
        return out

    x, y = words(a), words(b)
    if not x or not y:
        return None
    left, hits = list(y), 0
    for w in x:
        for i, v in enumerate(left):
            if w.startswith(v) or v.startswith(w):
                hits += 1
                del left[i]
                break
    return hits / max(len(x), len(y))


def test_name_similarity_brute_force(rows):
    rng = random.Random(7)
    vocabulary = ["ESCOLA", "ESC", "E", "MUNICIPAL", "MUN", "LTDA", "ME", "44", "984", "339", "12345", "1", "A", "AB", "ABC", "12.3-4"]
    pairs = [(" ".join(rng.choices(vocabulary, k=rng.randint(0, 6))), " ".join(rng.choices(vocabulary, k=rng.randint(0, 6)))) for _ in range(800)]
    pairs += [(None, "A"), ("", "A"), ("ESC MUN", "ESCOLA MUNICIPAL"), ("JOSE 123 45", "JOSE")]
    got = one(rows("a string, b string", pairs), NM.name_similarity(F.col("a"), F.col("b")))
    assert got == [similarity(a, b) for a, b in pairs]


def check_digits(base):
    w1, w2 = DOC.CNPJ_WEIGHTS
    for w in (w1, w2):
        r = sum(int(d) * x for d, x in zip(base, w)) % 11
        base += str(0 if r < 2 else 11 - r)
    return base


def test_company_number(rows):
    rng = random.Random(3)
    good = [check_digits("".join(rng.choices("0123456789", k=12))) for _ in range(50)]
    bad = [g[:13] + str((int(g[13]) + 1) % 10) for g in good]
    other = [None, "", "123", "1" * 14, good[0][:2] + "." + good[0][2:5] + "." + good[0][5:8] + "/" + good[0][8:12] + "-" + good[0][12:], "abc"]
    got = one(rows("d string", [(d,) for d in good + bad + other]), DOC.cnpj_valid(F.col("d")))
    assert got == [True] * 50 + [False] * 50 + [False, False, False, False, True, False]


def test_document_type_and_postcode(rows):
    docs = rows("d string", [(None,), (" ",), ("123",), ("111.222.333-44",), ("11222333000181",)])
    assert one(docs, DOC.doc_type(F.col("d"))) == ["NULO", "NULO", "INVALIDO", "CPF", "CNPJ"]
    assert one(docs, DOC.doc_type(F.col("d"), null_is_invalid=True))[:2] == ["INVALIDO", "INVALIDO"]
    ceps = rows("c string", [(None,), ("",), ("1234567",), ("12.345-678",), ("123456789",), ("00000000",)])
    assert one(ceps, DOC.postcode_key(F.col("c"))) == [None, "00000000", "01234567", "12345678", "12345678", "00000000"]
    assert one(ceps, DOC.is_generic_cep(DOC.postcode_key(F.col("c")))) == [None, True, False, False, False, True]


def test_null_tokens(rows):
    df = rows("s string", [(None,), ("",), (" nan ",), ("None",), ("-",), ("0",), ("NAO INFORMADO",), ("ok ",)])
    assert one(df, T.norm_str(F.col("s"))) == [None, None, None, None, None, "0", "NAO INFORMADO", "ok"]
    assert one(df, T.is_null_token(F.col("s"), "municipality", upper=True)) == [True, True, True, True, False, False, True, False]
    assert one(df, N.norm_dbl(F.col("s"))) == [None, None, None, None, None, 0.0, None, None]


def test_zeros_and_suffixes(rows):
    df = rows("s string", [("007",), ("0",), ("000",), (None,), ("51.0",), ("5.05",)])
    assert one(df, T.strip_leading_zeros(F.col("s"))) == ["7", "0", "0", None, "51.0", "5.05"]
    assert one(df, T.strip_decimal_suffix(F.col("s"))) == ["007", "0", "000", None, "51", "5.05"]
    city = rows("s string", [("TRES LAGOAS - AN",), ("Rio",), (None,), ("Foz do Iguacu-PR",)])
    assert one(city, T.clean_city(F.col("s"))) == ["TRES LAGOAS", "Rio", None, "Foz do Iguacu"]


def test_dates(rows):
    df = rows("s string", [("31/12/2025",), ("2025-12-31",), ("2025-12-31 10:00:00",), ("lixo",), (None,), ("99/99/2025",), ("",)])
    got = [str(v) if v else None for v in one(df, DT.to_date_safe(F.col("s")))]
    assert got == ["2025-12-31"] * 3 + [None] * 4
    assert DT.cycle_bounds("2025-12")[1].isoformat() == "2026-01-01"
    assert DT.cycle_to_lot("202607") == "2026-07" == DT.cycle_to_lot("2026-07")
    gaps = rows("a string, b string", [("2026-03", "2026-02"), ("2026-01", "2025-11"), ("2025-11", "2026-01"), (None, "2025-11")])
    assert one(gaps, DT.month_gap(F.col("a"), F.col("b"))) == [1, 2, -2, None]


def test_divergence_accepts_percent_and_fraction(rows):
    df = rows("a string, b string", [("17", "17"), ("0.17", "17"), ("17.005", "17"), ("17.0051", "17"), ("0.5", "17"), (None, "17"), ("17", None), ("0", "0")])
    got = one(df, N.diverges(N.rate(F.col("a")), N.rate(F.col("b"))))
    assert got == [False, False, False, True, True, False, False, False]


def test_money_text_and_booleans(rows):
    df = rows("v double", [(1234.56,), (None,), (-0.5,), (1e6,)])
    assert one(df, N.fmt_brl(F.col("v"))) == ["R$ 1.234,56", "R$ 0,00", "R$ -0,50", "R$ 1.000.000,00"]
    flags = rows("s string", [("S",), (" sim ",), ("n",), ("?",), (None,), ("",)])
    assert one(flags, T.parse_bool(F.col("s"))) == [True, True, False, None, None, None]
    assert one(flags, T.parse_bool(F.col("s"), "false")) == [False, True, False, False, None, None]
    assert one(rows("s string", [("1,5",), ("x",), (None,)]), N.decimal_comma(F.col("s"))) == [1.5, 0.0, 0.0]
