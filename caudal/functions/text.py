"""Text expressions: transliteration, trimming, masking and name parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from caudal.functions import scripts

# The characters a plain strip() removes from both ends.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

# Characters whose ASCII form is longer than one letter.
LONG_FORMS = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th",
    "«": "<<", "»": ">>", "…": "...", "€": "EUR",
}

# One-letter forms that Unicode decomposition does not give.
SHORT_FORMS = {
    "Ð": "D", "ð": "d", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "ı": "i",
    "¡": "!", "¿": "?", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "×": "x",
}


_FORMS = SHORT_FORMS | {c: f for c, f in scripts.forms()[0].items() if c not in SHORT_FORMS and c not in LONG_FORMS}
_COMBINING = "".join(map(chr, range(0x0300, 0x0370)))
_FROM = "".join(_FORMS) + _COMBINING  # marks have no counterpart, so translate() deletes them
_TO = "".join(_FORMS.values())


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def to_ascii(text: Column) -> Column:
    """Letters of all scripts with a rule become plain Latin letters; pure ASCII text skips the work, and most other
    text is done after one translation. No character of a longer form is ASCII, so these are only looked for where one is left."""
    short = F.translate(text, _FROM, _TO)
    plain = short
    for char, form in LONG_FORMS.items():
        plain = F.replace(plain, F.lit(char), F.lit(form))
    return F.when(_is_ascii(text), text).when(_is_ascii(short), short).when(_is_ascii(plain), plain).otherwise(
        scripts.several_letters(plain))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def normalise(text: Column) -> Column:
    return F.upper(strip(to_ascii(text)))


def name_part(full_name: Column, position: int) -> Column:
    """Word at a position of a name, null when there is none."""
    return F.nullif(F.get(F.split(strip(full_name), r"\s+"), F.lit(position)), F.lit(""))


def mask_account(number: Column, strict: bool = False) -> Column:
    """Last four characters behind stars. Short numbers stay readable unless ``strict``."""
    masked = F.concat(F.lit("****"), F.right(number, F.lit(4)))
    short = F.when(number.isNotNull(), F.lit("****")) if strict else number
    return F.when(F.char_length(number) > 4, masked).otherwise(short)
