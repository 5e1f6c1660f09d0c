"""Latin letters for characters of other scripts: which there are, and how a column of texts is turned into them.

Few letters are listed; the rest follows from Unicode itself: letters with marks and compatibility forms (ligatures, wide and
circled characters, roman numerals) by decomposition, kana by their names, Hangul syllables by their place. Scripts without a
rule here, Chinese characters first of all, stay as they are.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

# Letters of each alphabet in its order, small letters only; capitals follow.
ALPHABETS = [
    ("αβγδεζηθικλμνξοπρστυφχψωςϐϑϕϱ", "a b g d e z e th i k l m n x o p r s t u ph kh ps o s b th ph r"),
    ("абвгдежзийклмнопрстуфхцчшщъыьэюя", "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch ' y ' e iu ia"),
    ("ѐёђѓєѕіїјљњћќѝўџґ", "ie io dj gj ie dz i yi j lj nj tsh kj i u dzh g"),
    ("աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆ",
     "a b g d e z e e t zh i l kh ts k h dz gh ch m y n sh o ch p j r s v t r ts w p k o f"),
    ("აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", "a b g d e v z t i k l m n o p zh r s t u p k gh q sh ch ts dz ts ch kh j h"),
    ("בגדהוזחטיךכלםמןנסעףפץצקרשת", "b g d h v z kh t y k k l m m n n s ` p p ts ts q r sh t"),
    ("ابتثجحخدذرزسشصضطظعغفقكلمنهويىةپچژگ", "a b t th j h kh d dh r z s sh s d t z ` g f q k l m n h w y a h p ch zh g"),
    ("əŋɓɗɣƙƥƭ", "e ng b d g k p t"),
]
# Parts of a Hangul syllable in their order; "-" stands for a silent part.
HANGUL_FIRST = "g gg n d dd r m b bb s ss - j jj c k t p h".split()
HANGUL_VOWEL = "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split()
HANGUL_LAST = "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".split()

_RANGES = ((0x00A0, 0x0530), (0x0531, 0x0700), (0x10A0, 0x1100), (0x1E00, 0x2000), (0x2000, 0x2190), (0x2460, 0x2500),
           (0x3041, 0x3100), (0xFB00, 0xFB50), (0xFF01, 0xFFDD))


@cache
def _letters() -> dict[str, str]:
    out = {}
    for letters, forms in ALPHABETS:
        for letter, form in zip(letters, forms.split(), strict=True):
            out[letter] = form
            # Georgian's other case isn't used in running text, and special forms have capitals of their own letter
            if len(letter.upper()) == 1 and letter.upper() != letter:
                out.setdefault(letter.upper(), form.capitalize())
    return out


def _kana(char: str) -> str | None:
    """A kana's name ends in its sound: KA, SMALL TU."""
    name = unicodedata.name(char, "")
    return name.rpartition(" ")[2].lower() if name.startswith(("HIRAGANA LETTER", "KATAKANA LETTER")) else None


def latin(char: str) -> str | None:
    """The Latin form of one character; None if there is no rule."""
    if char.isascii():
        return char
    if char == "⁄":  # between the digits of a fraction
        return "/"
    if (form := _letters().get(char) or _kana(char)) is not None:
        return form
    parts = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
    if parts == char:
        return None
    forms = [latin(c) for c in parts]
    return None if None in forms else "".join(forms)


@cache
def forms() -> tuple[dict[str, str], dict[str, str]]:
    """Characters with a form of one letter, and those with several."""
    short, long = {}, {}
    for low, high in _RANGES:
        for char in map(chr, range(low, high)):
            form = latin(char)
            if form and form.isprintable():
                (short if len(form) == 1 else long)[char] = form
    return short, long


def _hangul(char: Column) -> Column:
    place = F.ascii(char) - 0xAC00
    parts = [
        F.get(F.split(F.lit(" ".join("" if p == "-" else p for p in names)), " "), (at % len(names) if wrap else at).cast("int"))
        for names, at, wrap in (
            (HANGUL_FIRST, F.floor(place / 588), False), (HANGUL_VOWEL, F.floor(place / 28), True), (HANGUL_LAST, place, True))
    ]
    return F.when((char >= "가") & (char <= "힣"), F.concat(*parts))


def several_letters(text: Column) -> Column:
    """Characters whose Latin form has several letters; others stay as they are."""
    pairs = "\x01".join(f"{char}\x02{form}" for char, form in forms()[1].items())
    known = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))
    letters = F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(known, c), _hangul(c), c))
    return F.array_join(letters, "")
