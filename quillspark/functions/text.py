"""Text scalars: normalisation, tokens, names, titles, counts. All are column expressions, evaluated in the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters with marks and the letters they are folded to.
MARKED = "àáâãäåāăąçćčĉċďđèéêëēĕėęěĝğġģĥħìíîïĩīĭįıĵķĺļľłñńņňòóôõöøōŏőŕŗřśŝşšţťŧùúûüũūŭůűųŵýÿŷźżžÀÁÂÃÄÅĀĂĄÇĆČĎĐÈÉÊËĒĖĘĚĜĞĠÌÍÎÏĪĮİŁÑŃŇÒÓÔÕÖØŌŐŘŚŞŠŢŤÙÚÛÜŪŮŰÝŹŻŽ"
LIGATURES = (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("Æ", "AE"), ("Œ", "OE"), ("þ", "th"), ("Þ", "Th"))


def _folded() -> tuple[str, str]:
    import unicodedata

    plain = [unicodedata.normalize("NFD", c)[0] for c in MARKED]
    own = {"đ": "d", "ħ": "h", "ı": "i", "ł": "l", "ø": "o", "ŧ": "t", "Đ": "D", "Ł": "L", "Ø": "O"}
    return MARKED, "".join(own.get(c, p) for c, p in zip(MARKED, plain, strict=True))


FOLD_FROM, FOLD_TO = _folded()

#: Cyrillic and Greek letters in Latin ones; upper-case letters take the same form, which is lower-cased anyway.
ROMAN = {
    **dict(zip("абвгдезийклмнопрстуфхыэіїєґўъь", ["a", "b", "v", "g", "d", "e", "z", "i", "i", "k", "l", "m", "n", "o", "p", "r", "s", "t", "u", "f", "kh", "y", "e", "i", "yi", "ie", "g", "u", '"', "'"], strict=True)),
    "ё": "io", "ж": "zh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ю": "iu", "я": "ia", "ђ": "dj", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "tsh", "џ": "dzh",
    **dict(zip("αβγδεζηικλμνξοπρσςτυφωάέήίόύώϊϋ", ["a", "b", "g", "d", "e", "z", "e", "i", "k", "l", "m", "n", "x", "o", "p", "r", "s", "s", "t", "u", "ph", "o", "a", "e", "e", "i", "o", "u", "o", "i", "u"], strict=True)),
    "θ": "th", "χ": "kh", "ψ": "ps",
}
_ONE = {c: x for c, x in ROMAN.items() if len(x) == 1}
_MORE = {c: x for c, x in ROMAN.items() if len(x) > 1}
ROMAN_FROM, ROMAN_TO = "".join(_ONE) + "".join(_ONE).upper(), "".join(_ONE.values()) * 2


def let(value: Column, f) -> Column:
    """f(value) with value computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def fold(s: Column) -> Column:
    """Latin letters without their marks; Cyrillic and Greek ones in Latin. ASCII stays as it is, and is told by its bytes."""
    return let(s, lambda x: F.when(F.octet_length(x) == F.length(x), x).otherwise(_unmarked(x)))


def _unmarked(s: Column) -> Column:
    for a, b in LIGATURES:
        s = F.replace(s, F.lit(a), F.lit(b))
    return let(F.translate(s, FOLD_FROM, FOLD_TO), lambda x: F.when(x.rlike("[\u0370-\u052f]"), romanised(x)).otherwise(x))


def romanised(s: Column) -> Column:
    for a, b in _MORE.items():
        s = F.replace(F.replace(s, F.lit(a), F.lit(b)), F.lit(a.upper()), F.lit(b))
    return F.translate(s, ROMAN_FROM, ROMAN_TO)


def normalize_string(s: Column) -> Column:
    """Folded, lower case, anything but letters and digits as one blank, runs of one character as that character.

    A string of which nothing would be left is only lower-cased before runs are collapsed."""
    bare = F.lower(F.regexp_replace(fold(s), r"[\W_]+", " "))
    whole = let(bare, lambda b: F.when(F.trim(b) == "", F.lower(s)).otherwise(b))
    return F.regexp_replace(whole, r"(?s)(.)\1+", "$1")


def tokens(s: Column) -> Column:
    """Words of the normal form."""
    return F.filter(F.split(normalize_string(s), r"\s+"), lambda x: x != "")


def token_set(s: Column) -> Column:
    return F.array_sort(F.array_distinct(tokens(s)))


def author_sets(authors: Column) -> Column:
    """Token set of each author."""
    return F.transform(authors, token_set)


def author_initials(authors: Column) -> Column:
    """Token set of each author with all words but the last cut to their first letters."""

    def one(a: Column) -> Column:
        return let(tokens(a), lambda t: F.array_sort(F.array_distinct(F.transform(t, lambda x, i: F.when(i < F.size(t) - 1, F.left(x, F.lit(1))).otherwise(x)))))

    return F.transform(authors, one)


TITLE_TAIL = r"(?iU)\W?\s*(?:archive number|arxiv|corr|doi|math)[.,:]?\s*(?:abs/|pr/|number)?\s*[0-9][^\n]*"


def clean_title(title: Column) -> Column:
    """Title without an identifier (arXiv, CoRR, doi, math, archive number) and what follows it on its line. The name needn't begin a
    word: `Aftermath 2` is cut to `After`."""
    return F.regexp_replace(title, TITLE_TAIL, "")


def words(s: Column) -> Column:
    return F.filter(F.split(s, r"\s+"), lambda x: x != "")


def word_count(s: Column) -> Column:
    return F.coalesce(F.size(words(s)), F.lit(0)).cast("bigint")


def latin_share(s: Column) -> Column:
    """Share of plain Latin letters among the characters; 0 for an empty text."""
    return F.when(F.length(s) > 0, F.length(F.regexp_replace(s, "[^A-Za-z]", "")) / F.length(s)).otherwise(F.lit(0.0))


ABSTRACT = r"(?i)^\s*(?:[0-9ivx]+[.)]?\s*)?abstract\W*$"


def is_abstract(headline: Column) -> Column:
    return F.coalesce(headline.rlike(ABSTRACT), F.lit(False))


def letter_to_int(s: Column) -> Column:
    return F.ascii(F.upper(s)) - 64


def field_names(fields: Column) -> Column:
    """Distinct lower-case names of an array of names."""
    return F.array_distinct(F.transform(fields, lambda x: F.lower(x)))


def dedup_authors(authors: Column) -> Column:
    """The first author of each token set, in order."""
    return let(author_sets(authors), lambda sets: F.filter(authors, lambda a, i: F.array_position(sets, F.get(sets, i)) == i + 1))


def names_covered(pattern: str):
    """A pandas UDF: share of characters whose Unicode name matches pattern; 0 for an empty or null text."""
    @F.pandas_udf("double")
    def share(s: pd.Series) -> pd.Series:
        import re
        import unicodedata
        from collections import Counter

        p = re.compile(pattern)
        known: dict[str, bool] = {}  # each character's name is looked up once
        fits = lambda c: known[c] if c in known else known.setdefault(c, bool(p.search(unicodedata.name(c, ""))))
        return s.map(lambda t: sum(n for c, n in Counter(t).items() if fits(c)) / len(t) if t else 0.0)

    return share
