"""Quality rules, line first (operator 1).

Each line is judged by itself: symbol noise, shouting, navigation and
boilerplate lines fail and are removed; a document that loses too much of its
text is rejected.  The base figures of the contract are counted beside it.

Defined results: a null or empty text has no word and no line, is base_failed
and not kept, and its cleaned text is empty.  Repeated rows are judged alike,
one result row per input row.  Extra columns are ignored (``clean`` keeps
them).  An empty table gives an empty result.  A null doc_id is passed through.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainstar.llm.common import c, give_back, map_batches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TRIM = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"

# Rules of a line (fixed values; the SQL twin uses the same patterns).
NOISE = r"[#*$%&|<>~^=_{}]"
SEPARATOR = r"[|»›·•]"
SHOUT = r"[!?][!?]+"
TERMINAL = r"""[.!?…:;"'”’»)\]]$"""
# Phrases of notices and controls, not single words that prose uses too, by language; sought in the lower-cased line.
BOILERPLATE = "(" + "|".join([
    # English
    r"all rights reserved", r"(copyright|©) *(\(c\)|©)? *[0-9]{4}", r"terms of (use|service)", r"privacy policy",
    r"(use|uses|using|accept|enable|use of) cookies", r"cookie (policy|settings|preferences|notice)",
    r"subscribe (now|today|here|to our)", r"sign up (now|today|here|for our|to our)", r"(sign|log) in to your",
    r"click here", r"read more", r"share this", r"follow us", r"^powered by", r"(enable|requires) javascript",
    r"javascript (is|must be) (disabled|enabled|required)", r"lorem ipsum", r"licensed under", r"spdx-license",
    r"permission is hereby granted", r"without warranty",
    # German
    r"alle rechte vorbehalten", r"datenschutzerklärung", r"nutzungsbedingungen", r"(verwendet|verwenden|akzeptieren) cookies",
    r"cookies (akzeptieren|zulassen)", r"newsletter abonnieren", r"jetzt (abonnieren|anmelden|registrieren)",
    r"hier klicken", r"klicken sie hier", r"folgen sie uns", r"(artikel|beitrag) teilen",
    # French
    r"tous droits réservés", r"mentions légales", r"politique de confidentialité", r"conditions (générales )?d['’]utilisation",
    r"(utilise|accepter) (des|les) cookies", r"abonnez-vous", r"inscrivez-vous", r"cliquez ici", r"lire la suite",
    r"suivez-nous", r"partager cet article",
    # Spanish
    r"todos los derechos reservados", r"aviso legal", r"política de (privacidad|cookies)", r"términos (de uso|y condiciones)",
    r"(utiliza|aceptar) (las )?cookies", r"suscríbete", r"ha(z|ga) clic aquí", r"leer más", r"síguenos", r"comparte este artículo",
    # Russian
    r"все права защищены", r"политика конфиденциальности", r"пользовательское соглашение", r"подпишитесь на",
    r"нажмите здесь", r"читать далее",
]) + ")"
NOISE_PERCENT = 8          # symbols of a line's characters
SEPARATOR_PERCENT = 20     # separators of a line's words
SHOUT_PERCENT = 25         # words with runs of ! or ?
CAPS_PERCENT = 60          # capitals of the letters A-Z, in lines of CAPS_WORDS words
CAPS_WORDS = 4
NAV_WORDS = 4              # a line of so many words at most must end like a sentence
BOILER_WORDS = 40          # boilerplate phrases count in lines of so many words at most
MAX_LOSS_PERCENT = 30      # of the characters of all lines

_NOISE, _SEP, _SHOUT = re.compile(NOISE), re.compile(SEPARATOR), re.compile(SHOUT)
_TERM, _BOILER = re.compile(TERMINAL), re.compile(BOILERPLATE)
_CAPS, _LETTERS = re.compile(r"[A-Z]"), re.compile(r"[A-Za-z]")


def line_fault(line: str) -> str | None:
    """The first rule that a trimmed, non-empty line breaks."""
    n = len(WORD.findall(line))
    if 100 * len(_NOISE.findall(line)) > NOISE_PERCENT * len(line):
        return "noise"
    if 100 * len(_SEP.findall(line)) > SEPARATOR_PERCENT * n:
        return "navigation"
    if 100 * len(_SHOUT.findall(line)) > SHOUT_PERCENT * n:
        return "shouting"
    if n >= CAPS_WORDS and 100 * len(_CAPS.findall(line)) > CAPS_PERCENT * len(_LETTERS.findall(line)) > 0:
        return "shouting"
    if n <= NAV_WORDS and not _TERM.search(line):
        return "navigation"
    if n <= BOILER_WORDS and _BOILER.search(line.lower()):
        return "boilerplate"
    return None


def clean_text(text: str) -> tuple[str, int, int]:
    """(text without its failing lines, characters lost, characters of all lines)."""
    kept, lost, total = [], 0, 0
    for raw in text.split("\n"):
        line = raw.strip(TRIM)
        total += len(line)
        if line and line_fault(line):
            lost += len(line)
        else:
            kept.append(raw)
    return "\n".join(kept), lost, total


def base_figures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(TRIM):
            dup += line in seen
            seen.add(line)
    n, repeat = len(words), 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        count = Counter(windows)
        if len(count) < len(windows):
            reach = 0                      # words before this position are counted
            for i, w in enumerate(windows):
                if count[w] > 1:
                    repeat += i + 3 - max(i, reach)
                    reach = i + 3
    return n, sum(map(len, words)), sum(text.count(s) for s in SYMBOLS), dup, repeat


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50,
            max_repeat_percent: int = 50, max_loss_percent: int = MAX_LOSS_PERCENT,
            with_text: bool = True) -> DataFrame:
    """One row per document: base figures, verdict, characters lost and the cleaned text."""

    def make():
        def work(ids, texts):
            out = []
            for i, t in zip(ids, texts):
                t = t or ""
                n, chars, symbols, dup, rep = base_figures(t)
                bad = n < min_words or 100 * rep > max_repeat_percent * n
                clean, lost, total = clean_text(t)
                kept = not bad and 100 * lost <= max_loss_percent * total
                out.append((i, n, chars, symbols, dup, rep, bad, kept, lost, total,
                            clean if with_text else None))
            return list(zip(*out)) if out else [[]] * 11
        return work

    kind = docs.select(c(id_col)).schema[0].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, base_failed boolean, kept boolean, lost_chars long, line_chars long, "
              "clean_text string")
    return map_batches(docs.select(c(id_col), c(text_col)), make, schema)


def clean(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars", **limits) -> DataFrame:
    """The kept documents with their cleaned text; the columns of ``docs``.

    ``n_chars_col``, where the table has it, is set to the new length.
    """
    row = F.struct(*[c(x) for x in docs.columns])
    judged = _with_verdict(docs.select(row.alias("r"), c(text_col).alias("t")), limits)
    out = [(F.col("clean_text") if x == text_col else F.length("clean_text").cast(docs.schema[x].dataType)
            if x == n_chars_col else F.col("r").getField(x)).alias(x) for x in docs.columns]
    return judged.filter("kept").select(*out)


def _with_verdict(rows: DataFrame, limits: dict) -> DataFrame:
    """``rows`` (r, t) with the verdict of each row beside it, in one pass."""
    lim = {"min_words": 50, "max_repeat_percent": 50, "max_loss_percent": MAX_LOSS_PERCENT} | limits

    @F.pandas_udf("kept boolean, clean_text string")
    def judge(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            t = t or ""
            n, _, _, _, rep = base_figures(t)
            text, lost, total = clean_text(t)
            out.append((n >= lim["min_words"] and 100 * rep <= lim["max_repeat_percent"] * n
                        and 100 * lost <= lim["max_loss_percent"] * total, text))
        give_back()
        return pd.DataFrame(out, columns=["kept", "clean_text"])

    # Not to be repeated by the filter on its own result.
    return rows.withColumn("v", judge.asNondeterministic()("t")).select("r", "v.kept", "v.clean_text")
