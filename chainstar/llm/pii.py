"""Personal data with offset-preserving deobfuscation (operator 5).

A transducer rewrites the source text: homoglyphs and look-alike digits,
zero-width characters, spelled digits, and at/dot disguises.  Every output
character remembers the source range it came from.  Identifiers are detected
in the rewritten text and their spans mapped back to source characters.  The
spans of the plain patterns (the base) always stay; the transducer only adds.

Defined results: a null text counts as empty and has no span.  Offsets are
code points of the source text, end exclusive.  Repeated rows give equal rows.
Extra columns are ignored by ``detect`` and kept by ``redact``.  An empty
table gives an empty result.  A text is read whole, however long.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainstar.llm.common import c, give_back, map_batches

KINDS = ("email", "ip", "card", "phone")
# The local part is read backwards from each @, the numbers of an address once each: linear on any text.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Letters of other scripts that look like Latin ones.
_CYRILLIC = "\u0430\u0435\u043e\u0440\u0441\u0443\u0445\u0456\u0458\u0455\u0501\u04bb\u051b\u051d" \
            "\u0410\u0412\u0415\u041a\u041c\u041d\u041e\u0420\u0421\u0422\u0423\u0425\u0406\u0408\u0405"
_GREEK = "\u03b1\u03bf\u03b9\u03ba\u03bd\u03c1\u03c4\u03c5" \
         "\u0391\u0392\u0395\u0396\u0397\u0399\u039a\u039c\u039d\u039f\u03a1\u03a4\u03a5\u03a7"
_MARKS = "\u2010\u2011\u2012\u2013\u2212\u00a0\u2007\u202f\u3002\uff61\u2024\uff20\ufe6b"
_LOOKS = dict(zip(_CYRILLIC + _GREEK + _MARKS,
                  "aeopcyxijsdhqw" "ABEKMHOPCTYXIJS" "aoiknptu" "ABEZHIKMNOPTYX" "-----   ...@@", strict=True))
_HIDDEN = "\u200b\u200c\u200d\u200e\u200f\u2060\ufeff\u00ad"
# Digit names in English, German, French and Spanish.
_NAMES = ("zero null zéro cero", "one eins un uno", "two zwei deux dos", "three drei trois tres",
          "four vier quatre cuatro", "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete",
          "eight acht huit ocho", "nine neun neuf nueve")
_DIGIT_NAMES = {w: str(d) for d, names in enumerate(_NAMES) for w in names.split()}
_AT, _DOT, _PLUS = "at|arroba|chez|klammeraffe", "dot|punkt|point|punto", "plus"


def _single(ch: str) -> str | None:
    """The ASCII character that ``ch`` stands for, by table or by rule."""
    if ch in _LOOKS:
        return _LOOKS[ch]
    digit = unicodedata.decimal(ch, None)
    if digit is not None:
        return str(digit)
    flat = unicodedata.normalize("NFKC", ch)
    return flat if len(flat) == 1 and "!" <= flat <= "~" else None


# Full-width forms, mathematical letters and every script's decimal digits, by Unicode's own rules.
_ONE = {chr(i): m for i in [*range(0xff01, 0xff5f), *range(0x1d400, 0x1d800),
                            *(i for i in range(0x80, sys.maxunicode + 1)
                              if unicodedata.category(chr(i)) == "Nd"),
                            *map(ord, _LOOKS)] if (m := _single(chr(i)))}
_ONE |= dict.fromkeys(_HIDDEN, "")
# Last labels of common domains, and words that stand before a noun.
_LAST = frozenset("com org net edu gov mil int info biz io ai app dev co uk us eu de at ch fr es it nl be pl pt se no dk "
                  "fi ru ua cz ie ca mx br ar au nz in jp cn kr test example invalid".split())
_ARTICLES = frozenset("the a an this that these those our your my his her their le la les un une der die das el los "
                      "las una home work school least first last all".split())


def _any(words) -> str:
    """A pattern of these words, one branch a letter (regular expressions try every branch of a plain list)."""
    heads: dict[str, list[str]] = {}
    for w in words:
        if w:
            heads.setdefault(w[0], []).append(w[1:])
    if not heads:
        return ""
    return "(?:" + "|".join(re.escape(k) + _any(v) for k, v in sorted(heads.items())) + ")" + "?" * ("" in words)


def _class(chars) -> str:
    return "[" + re.escape("".join(sorted(chars))) + "]"


# The rules read a lower-case copy of the text, character for character.  Blanks are tried from a run's start only.
_W = _any(list(_DIGIT_NAMES))
_FIRST = "".join(sorted({w[0] for w in _DIGIT_NAMES} | {_PLUS[0]}))
_RUN = r"(?:(?<![\x20\t])[\x20\t]++)?"
_WORDS = (
    r"(?P<entity>&(?:#0*(?:64|46|x40|x2e)|commat|period);)"
    rf"|(?=[{_FIRST}])\b(?:(?P<plus>{_PLUS}[\x20\t]++(?={_W}\b|\d))"
    rf"|(?P<digits>{_W}\b(?:[\x20\t]*+[-,]?+[\x20\t]*+\b{_W}\b)*))"
    rf"|(?=[\x20\t\[({{<])(?:(?P<at>{_RUN}[\[({{<][\x20\t]*(?:{_AT}|@)[\x20\t]*[\])}}>][\x20\t]*)"
    rf"|(?P<dot>{_RUN}[\[({{<][\x20\t]*(?:{_DOT}|\.)[\x20\t]*[\])}}>][\x20\t]*)"
    rf"|(?<![\x20\t])[\x20\t]++(?:(?P<bareat>(?:{_AT})[\x20\t]+)|(?P<baredot>dot[\x20\t]+)"
    rf"|(?P<barepoint>(?:{_DOT})[\x20\t]+)))")
_ASCII_RULES = re.compile(rf"(?=[&\x20\t\[({{<{_FIRST}])(?:{_WORDS})")
_LOWER = _ONE.keys() | {ch.lower() for ch in _ONE}
# Apart, as a class is looked up at once only below U+10000.
_RULES = re.compile(f"(?P<one>{_class(x for x in _LOWER if x < chr(0x10000))}"
                    rf"|(?=[\U00010000-\U0010ffff]){_class(x for x in _LOWER if x >= chr(0x10000))})|{_WORDS}")
_NAME = re.compile(rf"\b{_W}\b")
_PLAIN = {"at": "@", "bareat": "@", "dot": ".", "baredot": ".", "barepoint": ".", "plus": "+"}
SPELLED_LEAST = 4   # spelled digits that make a phone number longer than the base has it


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(.[A-Za-z0-9-]+)+, leftmost, not overlapping."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))      # not before the last match or the @ before
        host = _HOST.match(text, at + 1) if start < at else None
        low = at + 1
        if host:
            out.append((start, host.end()))
            low = host.end()
        at = text.find("@", low)
    return out


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start, then kind."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                d = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(d) <= 19 and luhn(d):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text)
                    if 10 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(out, key=_order)


def _order(span: tuple[str, int, int]):
    return span[1], KINDS.index(span[0]), span[2]


def pieces(text: str) -> list[tuple[str, int, int, str]]:
    """What the rules rewrite, in order: (new text, source start, source end, rule)."""
    out = []
    if text.isascii():
        low, rules = text.lower(), _ASCII_RULES
    else:                                 # letters whose lower case is longer or another letter's variant
        low, rules = text.replace("İ", "i").replace("ı", "i").replace("ſ", "s").lower(), _RULES
    for m in rules.finditer(low):
        name, (a, b) = m.lastgroup, m.span()
        if name == "one":
            if (ch := _ONE.get(text[a])) is not None:
                out.append((ch, a, b, name))
        elif name == "digits":
            for w in _NAME.finditer(low, a, b):
                if a < w.start():
                    out.append(("", a, w.start(), name))
                out.append((_DIGIT_NAMES[w[0]], *w.span(), name))
                a = w.end()
        elif name == "entity":
            out.append(("@" if re.search("64|40|commat", m[0]) else ".", a, b, name))
        else:
            out.append((_PLAIN[name], a, b, name))
    return out


def _joined(text: str, parts: list[tuple[str, int, int, str]]) -> tuple[str, list[int]]:
    """The rewritten text, and where each piece is in it."""
    out, places, at, size = [], [], 0, 0
    for ch, a, b, _ in parts:
        out += (text[at:a], ch)
        size += a - at
        places.append(size)
        size += len(ch)
        at = b
    return "".join([*out, text[at:]]), places


def _source(i: int, parts: list[tuple[str, int, int, str]], places: list[int]) -> tuple[int, int]:
    """Source start and end of the rewritten text's character ``i``."""
    k = bisect_right(places, i) - 1
    if k < 0:
        return i, i + 1
    ch, a, b, _ = parts[k]
    if ch and places[k] == i:
        return a, b
    at = b + i - places[k] - len(ch)
    return at, at + 1


def rewrite(text: str) -> tuple[str, list[int], list[int], list[str]]:
    """The rewritten text; each character's source start, source end and rule ("" if unchanged)."""
    parts = pieces(text)
    flat, places = _joined(text, parts)
    at = [_source(i, parts, places) for i in range(len(flat))]
    rules = {i: rule for (ch, _, _, rule), i in zip(parts, places) if ch}
    return flat, [a for a, _ in at], [b for _, b in at], [rules.get(i, "") for i in range(len(flat))]


def _believable(kind: str, text: str, rules: list[str], length: int, longer: bool = False) -> bool:
    """Whether what the transducer revealed is more than a chance meeting of plain words.
    ``rules``: those used in the span.  ``length``: of the source range.  ``longer``: than a span of the base."""
    used = set(rules) - {""}
    if not used and length == len(text):
        return False                      # nothing rewritten: the base has judged it
    if kind == "email":
        last = text.rsplit(".", 1)[-1]
        if not (last.isalpha() and 2 <= len(last) <= 24):
            return False
        if used.isdisjoint(("bareat", "baredot", "barepoint")):
            return True
        # Plain words alone must read like an address: a disguised dot, no article before it, and, unless the dot is
        # the word "dot" itself, a common last label ("at this point during" is no address).
        host = text.rsplit("@", 1)[-1].lower().split(".")
        return host[0] not in _ARTICLES and (
            last.lower() in _LAST or ("baredot" in used and "barepoint" not in used)) and (
            "bareat" not in used or not used.isdisjoint(("dot", "baredot", "barepoint")))
    if kind == "phone" and longer and "digits" in used:
        return rules.count("digits") >= SPELLED_LEAST
    return True


def spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), both by start, then kind."""
    text = text or ""
    base = plain_spans(text)
    parts = pieces(text)
    if not parts:
        return base, base                 # rewritten, it is the same text
    flat, places = _joined(text, parts)
    found = set(base)
    for kind, a, b in plain_spans(flat):
        rules = [x[3] for x in parts[bisect_left(places, a):bisect_left(places, b)] if x[0]]
        lo, hi = _source(a, parts, places)[0], _source(b - 1, parts, places)[1]
        clash = [s for s in base if s[0] == kind and s[1] < hi and lo < s[2]]
        if _believable(kind, flat[a:b], rules, hi - lo, bool(clash)):
            # A disguise covers the blanks around it; a span never starts or ends with one.
            hi -= len(text[lo:hi]) - len(text[lo:hi].rstrip(" \t"))
            lo += len(text[lo:hi]) - len(text[lo:hi].lstrip(" \t"))
            clash = [s for s in clash if s[1] < hi and lo < s[2]]
            if all(lo <= s[1] and s[2] <= hi and (lo, hi) != s[1:] for s in clash):
                found.add((kind, lo, hi))
    return base, sorted(found, key=_order)


def told(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the number of base spans of each kind, the base spans and all spans."""

    def make():
        def work(ids, texts):
            n, plain, every = [], [], []
            for t in texts:
                base, full = spans(t)
                n.append([sum(s[0] == k for s in base) for k in KINDS])
                plain.append(told(base))
                every.append(told(full))
            return [ids, *([x[i] for x in n] for i in range(4)), plain, every]
        return work

    kind = docs.select(c(id_col)).schema[0].dataType.simpleString()
    return map_batches(docs.select(c(id_col), c(text_col)), make,
                       f"`{id_col}` {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                       "base_spans string, spans string")


def mask(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b in spans(text)[1]:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = b                            # overlapping spans: one mark covers the union
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked; ``n_chars_col``, where present, is the new length.

    A null text stays null (and its length as it was).
    """
    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        give_back()
        return texts.map(mask, na_action="ignore").astype(object)

    row = F.struct(*[c(x) for x in docs.columns])     # names of extra columns can't clash
    new = docs.select(row.alias("r"), masked(c(text_col)).alias("m"))

    def value(x: str):
        old = F.col("r").getField(x)
        if x == text_col:
            return F.col("m")
        return F.coalesce(F.length("m").cast(docs.schema[x].dataType), old) if x == n_chars_col else old

    return new.select(*[value(x).alias(x) for x in docs.columns])


def base_digest(found: str) -> str:
    return hashlib.sha256(found.encode()).hexdigest()
