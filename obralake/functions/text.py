"""Text normalisation for product names, as built-in expressions only."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_pairs() -> tuple[str, str]:
    """Letters whose canonical decomposition starts with an ASCII character."""
    source, target = [], []
    for code in range(0xC0, 0x2200):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii() and chr(code) != base:
            source.append(chr(code))
            target.append(base)
    return "".join(source), "".join(target)


ACCENTED, PLAIN = _accent_pairs()
COMBINING = r"\p{Mn}"

# Abbreviation patterns and their words, applied in this order.
SYNONYMS = [
    (r"\bDISJ\b", "DISJUNTOR"),
    (r"\bTERM\b", "TERMINAL"),
    (r"\bCOND\b", "CONDUTOR"),
    (r"\bCONECT\b", "CONECTOR"),
    (r"\bELETR\b", "ELETRODUTO"),
    (r"\bPARAF\b", "PARAFUSO"),
    (r"\bGALV\b", "GALVANIZADO"),
    (r"\bFLEX\b", "FLEXIVEL"),
    (r"\bISOL\b", "ISOLADO"),
    (r"\bTOM\b", "TOMADA"),
    (r"\bINTERR\b", "INTERRUPTOR"),
    (r"\bABRAC\b", "ABRACADEIRA"),
    (r"\bMONOP\b", "MONOPOLAR"),
    (r"\bTRIP\b", "TRIPOLAR"),
    (r"\bMT\b|\bMTS\b", "M"),
    (r"\bPLACA\b", "PLACA ESPELHO"),
    (r"\bMODULO\b|\bMOD\b", "MODULO"),
]
# The first version of the list lacks the last two and shortens one more phrase.
SYNONYMS_V1 = [*SYNONYMS[:12], (r"\bCAIXA DE TOMADA\b", "CAIXA"), *SYNONYMS[12:15]]

# Words without meaning, then colours and brands.
STOP_WORDS = ("DE DA DO DAS DOS PARA COM SEM E EM A O OU NA NO P UM UMA TIPO").split()
NOISE_WORDS = (
    "BR BRANCO BRANCA PRETO PRETA CINZA CZ PT BC VM VERMELHA VERMELHO AZ AZUL AM AMARELO "
    "LEGRAND SOPRANO INTELLI FRONTEC SEGURIMAX GRAPHITE PLUS ACCIAO VERDE LARANJA MARROM "
    "CARRETEL").split()
NOISE_WORDS_V1 = NOISE_WORDS[:-4]

# Number, unit and catalogue-code patterns.
UNIT = "MM2|MM|KV|KA|A|V|W|M|CM|KG|L"
MEASURE = rf"\d+(?:\.\d+)?(?:{UNIT})?"
NUMBER = r"(?<![\d.])\d+(?:\.\d+)?"
CATALOGUE_CODE = r"\b(?:\d{5,}[A-Z]*(?:\.\d+)?|[A-Z]{1,4}\d{3,}[A-Z0-9]*|[A-Z]{2,}-\d+(?:-\d+)*)\b"
AMP_RANGE = r"(\d+(?:\.\d+)?)\s*-\s*(\d+(?:\.\d+)?)\s*A\b"
AMP = r"(?<![\d.])(\d+(?:\.\d+)?)\s*A\b"
# Pole words in the order they are tried.
POLE_WORDS = [("MONOPOLAR", 1), ("UNIPOLAR", 1), ("BIPOLAR", 2), ("TRIPOLAR", 3), ("TETRAPOLAR", 4)]


# Forms of numbers, cables, gangs, plates and poles.
DECIMAL_COMMA, POINT_ZERO, LAST_ZEROS = r"(\d),(\d)", r"(\d+)\.0+(?!\d)", r"(\d+\.\d*?)0+(?!\d)"
REEL, CABLE_BRAND, CABLE_NAME = "CARRETEL", "FLEXSIL", "CABO COBRE FLEXIVEL"
CABLE_SIZE, CABLE_SIZED, REEL_OF_CABLE = r"750\s*V\s+(\d+(?:\.\d+)?)\b(?!MM)", "750V $1MM2", "CARRETEL CABO"
GANG_PAIR = r"(\d)\s*\+\s*(\d)\s*POSTOS?"
GANG_TRIPLE = r"(\d)\s*\+\s*(\d)\s*\+\s*(\d)\s*POSTOS?"
PLATE_FORM = r'\b(4)"?\s*X\s*(2|4)"?(?![\d.]|\s*(?:MM|CM))'
ONE_MODULE = r"\b1M\b"
POLES, GANGS, PLATE_SIZE = r"\b(\d) POLOS\b", r"\b(\d)\s*POSTOS?\b", r"\b(4X2|4X4)\b"


def let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once, however often the body names it."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def unaccent(value: Column) -> Column:
    """Accented letters to plain ones; every other character stays."""
    bare = F.translate(value, ACCENTED, PLAIN)
    return F.regexp_replace(bare, COMBINING, "")


def ascii_upper(value: Column) -> Column:
    """Accents stripped, remaining non-ASCII characters dropped, upper case."""
    bare = F.translate(value, ACCENTED, PLAIN)
    return F.upper(F.regexp_replace(bare, r"[^\x00-\x7F]", ""))


def _swap(value: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(value, pattern, to)


def tidy_numbers(value: Column) -> Column:
    """Decimal comma to point, no `.0`, no trailing zeros after the point."""
    pointed = _swap(value, DECIMAL_COMMA, "$1.$2")
    whole = _swap(pointed, POINT_ZERO, "$1")
    return _swap(whole, LAST_ZEROS, "$1")


def cable_words(value: Column) -> Column:
    """One cable brand and its reels, spelled as the catalogue spells them."""
    spelled = F.replace(F.replace(value, F.lit(REEL), F.lit("")),
                        F.lit(CABLE_BRAND), F.lit(CABLE_NAME))
    sized = _swap(spelled, CABLE_SIZE, CABLE_SIZED)
    applies = value.contains(CABLE_BRAND) | value.contains(REEL_OF_CABLE)
    return F.when(applies, sized).otherwise(value)


def normalize(value: Column, synonyms=SYNONYMS, keep: str = "") -> Column:
    """Comparable form of a product name. `keep` lists extra characters that survive."""
    out = ascii_upper(value)
    for pattern, word in synonyms:
        out = _swap(out, pattern, word)
    out = let(tidy_numbers(out), cable_words)
    out = _swap(out, rf"(\d)\s*({UNIT})\b", "$1$2")
    out = _swap(out, rf'[^A-Z0-9."/ {keep}]', " ")
    return F.trim(_swap(out, r"\s+", " "))


def sum_gangs(value: Column) -> Column:
    """`a+b POSTOS` and `a+b+c POSTOS` with the sum spelled out.

    Two terms are looked for before three, so `1+2+3 POSTOS` becomes `1+5 POSTOS`.
    """
    def spell_out(text: Column, pattern: str, terms: int) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

        def spell(acc: Column, hit: Column) -> Column:
            total = sum((F.regexp_extract(hit, pattern, i + 1).try_cast("int")
                         for i in range(terms)), F.lit(0))
            return F.replace(acc, hit, F.concat(total.cast("string"), F.lit(" POSTOS")))

        # Descending order puts `… POSTOS` before `… POSTO`, which it contains.
        return F.aggregate(F.sort_array(F.array_distinct(found), asc=False), text, spell)

    def both(text: Column) -> Column:
        summed = let(spell_out(text, GANG_PAIR, 2), lambda t: spell_out(t, GANG_TRIPLE, 3))
        return F.when(text.contains("+"), summed).otherwise(text)

    return let(value, both)


def plate_size_form(value: Column) -> Column:
    return _swap(value, PLATE_FORM, "$1X$2")


def standardize(value: Column) -> Column:
    """Plates (gang sums, 4X2 and 4X4) in one spelling; `1M` is a width, not a measure."""
    return _swap(plate_size_form(sum_gangs(value)), ONE_MODULE, " ")


def product_text(value: Column, mode: str = "faithful") -> Column:
    """Normalised and standardised name.

    In `faithful` mode the charset filter drops `+` and `-` before the gang sums and the amp
    ranges could see them; `ranges` keeps both characters.
    """
    if mode == "faithful":
        return standardize(normalize(value))
    if mode == "ranges":
        return standardize(normalize(value, keep="+-"))
    raise ValueError(f"unknown mode {mode!r}")


def tokens(value: Column, stop=STOP_WORDS) -> Column:
    """Blank-separated tokens without stop words, in order."""
    words = F.split(F.trim(_swap(value, r"\s+", " ")), " ")
    return F.filter(words, lambda t: (t != "") & ~t.isin(*stop))


def significant_words(token_array: Column, noise=NOISE_WORDS) -> Column:
    return F.filter(token_array, lambda t: t.rlike("^[A-Z]{3,}$") & ~t.isin(*noise))


def terms(token_array: Column) -> Column:
    """Words and adjacent word pairs."""
    def with_pairs(words: Column) -> Column:
        n = F.greatest(F.size(words) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n),
                           lambda a, b: F.concat_ws(" ", a, b))
        return F.concat(words, pairs)

    return let(token_array, with_pairs)


def measures(value: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(value, F.lit(MEASURE), F.lit(0)))


def numbers(value: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(value, F.lit(NUMBER), F.lit(0)))


def strip_codes(value: Column) -> Column:
    return F.trim(_swap(_swap(value, CATALOGUE_CODE, " "), r"\s+", " "))


def _first_digit(value: Column, pattern: str) -> Column:
    found = F.regexp_extract(value, pattern, 1)
    return F.when(found != "", found).try_cast("int")


def pole_count(value: Column) -> Column:
    by_number = _first_digit(value, POLES)
    out = by_number
    for word, n in reversed(POLE_WORDS):
        out = F.when(value.contains(word), F.lit(n)).otherwise(out)
    return out


def gang_count(value: Column) -> Column:
    return F.when(value.contains("CEGA"), F.lit(0)).otherwise(
        _first_digit(value, GANGS))


def plate_size(value: Column) -> Column:
    found = F.regexp_extract(value, PLATE_SIZE, 1)
    return F.when(found != "", found)


def amperages(value: Column) -> Column:
    found = F.regexp_extract_all(value, F.lit(AMP), F.lit(1))
    return F.transform(found, lambda a: a.try_cast("double"))


def amp_ranges(value: Column) -> Column:
    low = F.regexp_extract_all(value, F.lit(AMP_RANGE), F.lit(1))
    high = F.regexp_extract_all(value, F.lit(AMP_RANGE), F.lit(2))
    return F.zip_with(low, high, lambda a, b: F.struct(
        a.try_cast("double").alias("lo"), b.try_cast("double").alias("hi")))


def search_tokens(folded: Column) -> Column:
    """Distinct alphanumeric tokens of an already folded text."""
    words = F.split(folded, r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(words, lambda t: t != ""))


def trigrams(folded: Column) -> Column:
    """Distinct trigrams of each word, padded with two blanks before and one after."""
    words = F.filter(F.split(folded, r"[^\p{L}\p{N}]+"), lambda t: t != "")
    def grams(word):
        padded = F.concat(F.lit("  "), word, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.length(word) + 1),
                           lambda i: F.substring(padded, i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(words, grams)))
