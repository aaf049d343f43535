"""Problem 2: text decoded with the wrong character encoding.

Round-trip repair. A layer of garbling is undone by re-encoding the text under a candidate legacy
encoding and strictly decoding the bytes as the intended one; layers are peeled while the garbling
cost drops. Two kinds of layer are tried:

* UTF-8 read as a single-byte encoding. Only part of a field may be garbled, so the round trip is
  applied to each character run that is the image of one well-formed UTF-8 sequence; text around it
  stays. A run is replaced only if it decodes to a character in ordinary use.
* a Cyrillic or Greek single-byte encoding read as a Western (or another Cyrillic) one. This affects whole
  words, so the round trip covers the field. It keeps the number of non-ASCII characters, each of which
  costs at least 1; a text that costs little more than that needs no trial.

Characters replaced by U+FFFD or by a question mark inside a word, and fragments of a sequence whose
other bytes are gone, are lost for good: the field is found, its restored text is null. So it is where
peeling ends at a text that still holds the image of a sequence. Question marks of links, of questions
and in brackets by themselves are no loss.

Defined results: null, empty and ASCII text without stray question marks is clean (not returned);
very long text is handled in one pass per layer; repeated rows give repeated results; the operator
looks at the named columns only, so extra columns have no influence.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("ti", "ab", "au", "so")

#: Single-byte encodings that UTF-8 is commonly read with, most usual first.
LEGACY = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "iso8859_2", "cp866", "koi8_r", "cp852", "iso8859_15", "iso8859_9", "cp1254")
#: (read as, meant as) for text that never was UTF-8.
CYRILLIC = tuple((a, b) for b in ("cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic") for a in ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1251", "koi8_r", "cp866") if a != b)
GREEK = tuple((a, b) for b in ("cp1253", "iso8859_7") for a in ("cp1252", "latin-1"))
#: A whole field must cost less than this share of what it did before.
WHOLE = 0.7

_CONTROL = set(range(0x80, 0xA0))
_USUAL_PUNCT = set("–—‘’‚“”„…•°±²³¹µ·×÷−≤≥≈≠∞©®™§«»¿¡€£¥ªº½¼¾′″‰†‡→← ­  ​‑")


@functools.cache
def _table(enc: str) -> dict[int, int]:
    """byte -> code point; bytes the encoding leaves undefined keep their value, as browsers do."""
    out = {}
    for b in range(256):
        try:
            out[b] = ord(bytes([b]).decode(enc))
        except UnicodeDecodeError:
            out[b] = b
    return out


@functools.cache
def _reverse(enc: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for b, c in _table(enc).items():
        out.setdefault(chr(c), b)
    return out


def _char_class(enc: str, lo: int, hi: int) -> str:
    t = _table(enc)
    return "[" + "".join(re.escape(chr(t[b])) for b in range(lo, hi + 1)) + "]"


@functools.cache
def _sequences(enc: str) -> re.Pattern:
    cont = _char_class(enc, 0x80, 0xBF)
    return re.compile(f"{_char_class(enc, 0xC2, 0xDF)}{cont}|{_char_class(enc, 0xE0, 0xEF)}{cont}{{2}}|{_char_class(enc, 0xF0, 0xF4)}{cont}{{3}}")


@functools.cache
def _runs(enc: str) -> re.Pattern:
    return re.compile(f"(?:{_sequences(enc).pattern})+")


@functools.cache
def usual(ch: str) -> bool:
    """Characters in ordinary use in running text of European languages."""
    o = ord(ch)
    if o < 0x80:
        return o >= 32 or ch in "\t\n\r"
    if ch in _USUAL_PUNCT:
        return True
    return (0xC0 <= o <= 0x17F and o not in (0xD7, 0xF7)) or o in (0x218, 0x219, 0x21A, 0x21B) or 0x391 <= o <= 0x3CE or 0x410 <= o <= 0x44F or o in (0x401, 0x451, 0x404, 0x454, 0x406, 0x456, 0x407, 0x457, 0x490, 0x491, 0x1E9E)


@functools.cache
def _acceptable(ch: str) -> bool:
    """Any assigned character, and the controls that are themselves an intermediate layer; the cost decides."""
    return ord(ch) in _CONTROL or unicodedata.category(ch) not in ("Cn", "Co", "Cs", "Cc")

_RUN = re.compile(r"[^\x00-\x7f]{2,}")
_LATIN_HIGH_RUN = re.compile(r"[À-ÿĂ-ſ]{4,}")
_CYR_WORD = re.compile(r"[Ѐ-ӿ]+")
#: Upper case inside a word after lower case: Cyrillic read with the case-swapped KOI8 layout.
_SWAPPED = re.compile(r"\b[а-яё][А-ЯЁ]{2,}")
#: A word half Latin, half Cyrillic: the whole field wasn't Cyrillic.
_MIXED_WORD = re.compile(r"[A-Za-zÀ-ÿ][Ѐ-ӿ]|[Ѐ-ӿ][A-Za-zÀ-ÿ]")
#: Upper case after lower case in a word that isn't ASCII.
_INNER_CAPITAL = re.compile(r"[à-öø-ÿа-яёα-ώ][À-ÖØ-ÞА-ЯЁΑ-Ω]")
#: The no-break space inside a sequence turned into a plain one on the way. A word in capitals may end in Ã.
_SPACED = ((re.compile("ÃƒÂ "), "ÃƒÂ\xa0"), (re.compile("(?<![A-ZÀ-Ý])Ã  "), "Ã\xa0 "), (re.compile("(?<![A-ZÀ-Ý])Ã "), "Ã\xa0"))
#: The image of a sequence that no layer explains.
_REST = re.compile("[ÃÂ][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]|â€|[\x80-\x84\x86-\x9f]|[ÐÑØÙ][°±²³µ¶·¸¹º»¼½¾¿]")
_LOST_MARK = re.compile("�")
#: Question marks that are part of a link or an address, or stand in brackets by themselves.
_Q_PROPER = re.compile(r"(?:https?://|www\.)\S+|\S+\?\w+=\S*|\(\?+\)|\[\?+\]")
_Q_IN_WORD = re.compile(r"\w\?+(?<![a-zß-öø-ÿа-я]\?(?=[A-ZÀ-ÖØ-ÞА-Я][a-zß-öø-ÿа-я]))\w|(?:^|[\s(\[\"“«])\?+[\w.,;)]|[\s(]\?+\s(?![A-ZÀ-Ý])|\d \?+ ?\w")
_Q_AB = re.compile(r"\w\?+ [a-zа-яàáéíóúçãõâêôü(]|\w\?+[,.;:)]")
#: Words that begin a question; its mark may be followed by a small letter.
_ASKING = re.compile(
    r"(?:^|[.!?:;¿]\s*|¿)(?:what|how|why|who|when|where|which|whose|is|are|was|were|do|does|did|can|could|should|would|will|has|have|qué|cómo|por qué|cuál|quién|dónde|o que|como|qual|quem|quel(?:le)?|comment|pourquoi|qui|où|was|wie|warum|wer|wann|wo|welche[rs]?|что|как|почему|кто|когда|где|какой|какие)\b[^.!?]*\?",
    re.I,
)
#: What is left of a sequence of which some bytes were dropped.
_FRAGMENT = re.compile("Ã(?=[\\s.,;:a-z]|$)(?<![A-ZÀ-Ý]Ã)|â€(?!\\w)|Â(?=[\\s °±²³µ©®])|├(?=[\\s\\w]|$)|√(?=[\\s\\w]|$)")


@functools.cache
def _weight(ch: str) -> int:
    o = ord(ch)
    if o < 0x80:
        return 0
    if o in _CONTROL or o == 0xFFFD or 0x2500 <= o <= 0x259F:
        return 3
    if usual(ch):
        return 1
    if 0x530 <= o < 0x2000 or 0x2800 <= o < 0x1F000 or o > 0x1FAFF:
        return _ALONE
    return 3 if o > 0x1F000 else 2


#: What a letter of a script without neighbours of its own costs: more than the image of its sequence.
_ALONE = 7
_OTHER_SCRIPT = re.compile("[\u0530-\u1fff\u2c00-\u2fdf\u3005-\ud7ff\uf900-\ufdff\ufe70-\ufeff\U00020000-\U0003ffff]{2,}")


def _scripts(text: str) -> int:
    """Characters with a neighbour of the same script, for scripts whose letters count as unusual alone."""
    n = 0
    for m in _OTHER_SCRIPT.finditer(text):
        s = [_script(c) for c in m.group()]
        n += sum((k > 0 and s[k - 1] == x) or (k + 1 < len(s) and s[k + 1] == x) for k, x in enumerate(s) if x)
    return n


@functools.cache
def _script(ch: str) -> str:
    name = unicodedata.name(ch, "").split(" ")[0] if unicodedata.category(ch)[0] in "LM" else ""
    return "CJK" if name in ("HIRAGANA", "KATAKANA", "KATAKANA-HIRAGANA", "IDEOGRAPHIC") else name


def cost(text: str) -> int:
    """Garbling cost: unusual characters weigh more, so do long runs of accented letters and words of two scripts."""
    n = sum(_weight(c) for run in re.findall(r"[^\x00-\x7f]+", text) for c in run)
    n += sum(2 * len(m) for m in _LATIN_HIGH_RUN.findall(text))
    n += sum(2 * len(m) for m in _SWAPPED.findall(text))
    n += 3 * len(_MIXED_WORD.findall(text)) + len(_INNER_CAPITAL.findall(text))
    return n - (_ALONE - 1) * _scripts(text)


def _peel_utf8(text: str, enc: str) -> str:
    back = _reverse(enc)

    def run(m: re.Match) -> str:
        """Adjacent sequences together: a letter of another script stays as it is unless it has a neighbour of its own."""
        raw = m.group()
        try:
            chars = bytes(back[c] for c in raw).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            return _sequences(enc).sub(one, raw) if len(raw) > 4 else raw
        out, at = [], 0
        for k, ch in enumerate(chars):
            n = len(ch.encode("utf-8"))
            lone = _weight(ch) == _ALONE and not ((k and _script(chars[k - 1]) == _script(ch)) or (k + 1 < len(chars) and _script(chars[k + 1]) == _script(ch)))
            out.append(ch if _acceptable(ch) and not lone else raw[at : at + n])
            at += n
        return "".join(out)

    def one(m: re.Match) -> str:
        try:
            ch = bytes(back[c] for c in m.group()).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            return m.group()
        return ch if _acceptable(ch) and _weight(ch) < _ALONE else m.group()

    return _runs(enc).sub(run, text)


@functools.cache
def _translation(read_as: str, meant: str) -> dict[int, int | None]:
    """Code points under ``read_as`` -> those meant; None where the byte means nothing."""
    out: dict[int, int | None] = {}
    for c, b in _reverse(read_as).items():
        if ord(c) >= 0x80:
            try:
                out[ord(c)] = ord(bytes([b]).decode(meant))
            except UnicodeDecodeError:
                out[ord(c)] = None
    return out


def _peel_cyrillic(text: str, read_as: str, meant: str) -> str | None:
    """The whole text under another single-byte encoding, if that makes it Cyrillic (or Greek)."""
    table = _translation(read_as, meant)
    high = set(re.findall(r"[^\x00-\x7f]", text))
    if any(table.get(ord(c)) is None for c in high):
        return None
    out = text.translate(table)
    letters = [c for c in out if ord(c) >= 0x80]
    lo, hi = (0x386, 0x3CE) if meant in ("cp1253", "iso8859_7") else (0x410, 0x44F)
    own = sum(lo <= ord(c) <= hi for c in letters)
    return out if letters and own >= 0.9 * len(letters) and not _MIXED_WORD.search(out) else None


def _peel_cyrillic_words(text: str, read_as: str, meant: str) -> str:
    """As above for single words of a text that is Cyrillic otherwise."""

    def one(m: re.Match) -> str:
        t = _peel_cyrillic(m.group(), read_as, meant)
        return m.group() if t is None else t

    return _LATIN_HIGH_RUN.sub(one, text)


#: The commonest letters of Russian and Greek; they decide between texts of equal cost.
_COMMON = frozenset("оеаинтсрвлαάοόιίεέτσςνηήυρ")


def _common(text: str) -> int:
    return sum(c in _COMMON for c in text.lower())


def _high(text: str) -> int:
    return sum(map(len, re.findall(r"[^\x00-\x7f]+", text)))


def repair(text: str) -> str:
    """The text with every layer peeled that lowers the cost."""
    if "Ã" in text:
        for rx, b in _SPACED:
            text = rx.sub(b, text)
    if not _RUN.search(text):
        return text
    now = cost(text)
    while True:  # every turn lowers the cost
        best, best_cost = text, now
        for enc in LEGACY:
            if _sequences(enc).search(text):
                t = _peel_utf8(text, enc)
                if t != text and (c := cost(t)) < best_cost:
                    best, best_cost = t, c
        # a text of another single-byte encoding costs no less than its characters
        some = bool(_LATIN_HIGH_RUN.search(text) and _CYR_WORD.search(text))
        if some or _high(text) < WHOLE * now:
            for a, b in (*CYRILLIC, *GREEK):
                t = _peel_cyrillic(text, a, b)
                if t is None and some and (w := _peel_cyrillic_words(text, a, b)) != text and (c := cost(w)) < best_cost:
                    best, best_cost = w, c
                if t is not None and (c := cost(t)) < WHOLE * now and (c < best_cost or (c == best_cost and _common(t) > _common(best))):
                    best, best_cost = t, c
        if best is text:
            return text
        text, now = best, best_cost


def lost(text: str, fld: str) -> bool:
    """Whether characters are gone for good from a text that is otherwise repaired."""
    if _LOST_MARK.search(text) or _FRAGMENT.search(text):
        return True
    if "?" not in text:
        return False
    text = _Q_PROPER.sub(" ", text)
    return bool(_Q_IN_WORD.search(text) or (fld == "ab" and _Q_AB.search(_ASKING.sub(" ", text))))


def examine(text: str | None, fld: str) -> tuple[bool, str | None]:
    """(garbled, restored): restored is the whole original text, or None if it can't be known."""
    if not text:
        return False, None
    fixed = repair(text) if _RUN.search(text) or "Ã " in text else text
    if lost(fixed, fld) or (fixed != text and _REST.search(fixed)):
        return True, None
    return (True, fixed) if fixed != text else (False, None)


#: What Spark sends to Python at all: two adjacent non-ASCII characters, a replacement mark or a question mark.
SUSPECT = "[^\\x00-\\x7F]{2}|\\uFFFD|\\?|[\\u221A\\u251C\\u00C3\\u00C2]"


def find_garbled(df: DataFrame, id_col: str = "idx", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(id, fld, original, restored) for every garbled field; restored is null where characters are lost."""
    id_type = df.schema[id_col].dataType.simpleString()
    pairs = F.array(*[F.struct(F.lit(f).alias("fld"), F.col(f).alias("original")) for f in fields])
    long = df.select(F.col(id_col).alias("_id"), F.explode(pairs).alias("p")).select("_id", "p.fld", "p.original").where(F.col("original").rlike(SUSPECT))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hits = [(i, f, t, r) for i, f, t in zip(b["_id"], b["fld"], b["original"]) for g, r in (examine(t, f),) if g]
            yield pd.DataFrame(hits, columns=["_id", "fld", "original", "restored"])

    return long.mapInPandas(run, f"_id {id_type}, fld string, original string, restored string").withColumnRenamed("_id", id_col)


def p2_found(df: DataFrame) -> DataFrame:
    return find_garbled(df).select("idx", "fld", F.when(F.col("restored").isNull(), "").otherwise(F.md5(F.col("restored").cast("binary"))).alias("restored_md5"))
