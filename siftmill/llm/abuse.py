"""Abusive, hateful or sexual content (problem 9).

A weighted lexicon of word classes is matched by Aho-Corasick automata over folded text: letter case, look-alike
letters, digits and signs in place of letters, spread, stretched and masked words are undone first. Matches that a
harmless phrase covers don't count. What is left counts in passages that fit a pattern of classes, such as an
address before an insult; the weight of a passage is normalised by its length, so that parts which stand far from
one another weigh less.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lexicon

#: Letters that look like Latin ones (Cyrillic, Greek, special Latin), and the Latin ones.
LOOKALIKES = str.maketrans(
    "абвгдезикмнопрстухчьѕіјһԁԛԝёїαβγεζηικνορτυχωıɑɡʀøłđħ",
    "abbrae3ukmhonpctyx4bsijhdqweiabyezhiknoptuxwiagroldh",
)
#: Digits and signs that stand for letters inside words.
SUBSTITUTES = str.maketrans("0134578@$!€+¡", "oieastbasieti")
#: Letters written with two, after accents are gone.
LONG = {"ß": "ss", "æ": "ae", "œ": "oe"}

_CJK = "぀-ヿ㐀-䶿一-鿿"
_INVISIBLE = re.compile("[­᠎​-‏‪-‮⁠-⁤︀-️﻿]")
_FOREIGN = re.compile("[" + "".join(map(chr, LOOKALIKES)) + "]")
#: A word in which one sign stands between letters.
_BROKEN = re.compile(r"(?<![a-z0-9_|*])[a-z]+[_|*][a-z]+(?![a-z0-9_|*])")
_ELIDED = re.compile(r"(?<![^\W_])([cdjlmnst]|qu)['’](?=[a-z])")
_MARKS = re.compile("[̀-ͯ]")
_MASKED = re.compile(r"(?<![a-z*])[a-z]\*+[a-z](?![a-z*])")
_SPREAD = re.compile(r"(?<![a-z0-9])(?:[a-z]([ ._\-*·]))(?:[a-z]\1){2,}[a-z](?![a-z0-9])")
#: Words that hold a digit or sign among their letters; a sign at the end of a word is none of them but $ and @.
_WORDS = re.compile(r"(?<![a-z0-9@$!€+¡])(?:[a-z]+[0-9@$!€+¡]|[0-9@$!€+¡]+[a-z])[a-z0-9@$!€+¡]*(?<![!+¡])")
_ALONE = re.compile(r"(?<!\S)(?:@|4(?= [a-z]+[0-9@$!]+[a-z]| [0-9@$!]+[a-z]))(?!\S)")
_BREAKS = ("\r", "\n", "\x0b", "\x0c", "\u2028", "\u2029", "。", "？", "！", "；")
_ENDS = re.compile(r"[.!?;]+(?=\s|$)|(?<=[a-z0-9]):(?=\s)")
#: Of ASCII text: what isn't a letter, a digit or the mark between sentences.
_SIGNS = str.maketrans(dict.fromkeys([c for c in map(chr, range(128)) if not c.isalnum() and c != "|"], " ") | {"'": ""})
_OTHER = re.compile(r"[^\w|]+|_+")
_RUNS = re.compile(r"([a-z])\1+")
_CJK_GAP = re.compile(f"(?<=[{_CJK}]) +(?=[{_CJK}])")

MASK = "qmaskq"
#: Names of peoples: words with their endings behind a word that points at them, in folded spelling.
_PEOPLES = re.compile(r"(?:(?:those|these|of|for|ai|trust|iike|by|the|\|)|^) ((?:[a-z]{3,}(?:" + "|".join(e.replace("l", "i") for e in lexicon.PEOPLES) + r"))|[a-z]{3,}(?:ish|ese) peopie)(?= )|(?<= )([a-z]{3,}(?:ish|ese) peopie)(?= )|(?<= )(?:diese|aiie|typisch|aiier) ([a-z]{4,}(?:ier|aner))(?= )")


@lru_cache(maxsize=1)
def _words() -> tuple[frozenset[str], dict[str, str]]:
    """Words of the lexicon as they are written, without accents, and each by what it is with one letter hidden behind an asterisk."""
    plain = (unicodedata.normalize("NFD", e).rstrip("*") for c in (*lexicon.CORE.values(), *lexicon.BESIDE.values()) for e in lexicon.entries(c[0]))
    known = frozenset(w for w in (_MARKS.sub("", e) for e in plain) if len(w) >= 3 and w.isascii() and w.isalpha())
    return known | {w + "s" for w in known}, {f"{w[:i]}*{w[i + 1 :]}": w for w in sorted(known) if len(w) >= 4 for i in range(1, len(w) - 1)}


def _mended(broken: re.Match) -> str:
    """A word of the lexicon for one that a sign breaks or an asterisk hides a letter of; other words as they are."""
    known, hidden = _words()
    joined = re.sub(r"[_|*]", "", broken[0])
    return joined if joined in known else hidden.get(broken[0], broken[0])


def fold(text: str) -> str:
    """Text as sentences of lower-case words, ` a b | c d |`, with disguised spellings undone.

    Invisible characters and accents vanish, look-alike letters become Latin, digits and signs inside words
    become letters, words of the lexicon that a sign breaks are mended, words of letters spread by one sign or
    blank are joined, a word masked by asterisks becomes MASK, runs of one letter shrink to one, blanks between
    Chinese or Japanese characters vanish. An l is written i, as 1 and ! may stand for either.
    """
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
        text = unicodedata.normalize("NFC", _MARKS.sub("", unicodedata.normalize("NFD", text))).lower()
        for letter, two in LONG.items():
            text = text.replace(letter, two)
        if _FOREIGN.search(text):
            text = text.translate(LOOKALIKES)
    else:
        text = text.lower()
    if "_" in text or "|" in text or "*" in text:
        text = _BROKEN.sub(_mended, text)
    text = text.replace("|", " ")
    if "'" in text or "’" in text:
        text = _ELIDED.sub(r"\1 ", text)
    for sign in _BREAKS:
        text = text.replace(sign, " | ")
    text = _ENDS.sub(" | ", text)
    text = _ALONE.sub("a", text)
    text = _WORDS.sub(lambda m: m[0].translate(SUBSTITUTES), text)
    if "*" in text:
        text = _MASKED.sub(f" {MASK} ", text)
    text = _SPREAD.sub(lambda m: m[0].replace(m[1], ""), text)
    if text.isascii():
        text = " ".join(text.translate(_SIGNS).split())
    else:
        text = _CJK_GAP.sub("", _OTHER.sub(" ", text.replace("'", "").replace("’", "")))
    text = _RUNS.sub(r"\1", text).replace("l", "i")
    return f" {text} | "


def _is_cjk(text: str) -> bool:
    return bool(re.search(f"[{_CJK}]", text))


def _spelled(text: str) -> Iterator[str]:
    """The folded entries of a class, a star at the end of a word replaced by each ending."""
    for entry in lexicon.entries(text):
        for full in [entry[:-1] + end for end in lexicon.ENDINGS] if entry.endswith("*") else [entry]:
            yield " ".join(fold(full).replace("|", " ").split())


@dataclass(frozen=True)
class Lexicon:
    """Automata of the classes of which one must occur, and of those that are looked up beside them.

    The value of an entry is its length without the blanks around it, how many blanks precede it in the key, and its classes with weights.
    """

    core: ahocorasick.Automaton
    beside: ahocorasick.Automaton
    no_peoples: frozenset[str]


def _automaton(classes: dict[str, tuple[str, float]], more: dict[str, dict[str, float]]) -> ahocorasick.Automaton:
    found: dict[str, dict[str, float]] = {k: dict(v) for k, v in more.items()}
    for kind, (text, weight) in classes.items():
        for entry in _spelled(text):
            if entry:
                found.setdefault(entry, {})[kind] = weight
            if kind in ("dismiss", "harm") and len(entry) > 7 and " " in entry:  # as it is left if all its letters are spread
                found.setdefault(entry.replace(" ", ""), {})[kind] = weight
    made = ahocorasick.Automaton()
    for entry, kinds in found.items():
        blank = 0 if _is_cjk(entry) else 1
        made.add_word(f" {entry} " if blank else entry, (len(entry), blank, tuple(kinds.items())))
    made.make_automaton()
    return made


@lru_cache(maxsize=1)
def automaton() -> Lexicon:
    masked = {MASK: {"insult": 0.6, "adjective": 0.45, "obscene": 0.5, "erotic_part": 0.5, "take_you": 0.4, "slur": 0.5}}
    core = _automaton(lexicon.CORE, masked)
    return Lexicon(core, _automaton({**lexicon.BESIDE, "harmless": (lexicon.HARMLESS, 0.0)}, {}), frozenset(_spelled(lexicon.NO_PEOPLES)))


#: Weight from which a passage is abusive, and the words a passage may span before its weight is lowered in proportion.
THRESHOLD, PASSAGE = 1.0, 14
#: Letters that may stand between parts, for each word that may, so that it holds in writing without blanks too.
LETTERS = 10

_PEOPLE_ENDS = ("ish peopie ", "ese peopie ", "ier ", "aner ", *(f"{e} " for e in lexicon.PEOPLES))
Match = tuple[int, int, float]  # first and last character, weight


def _parsed(pattern: tuple[str | int, ...]) -> tuple[tuple[str, ...], tuple[int, ...], frozenset[str]]:
    kinds = tuple(p for p in pattern if isinstance(p, str))
    return kinds, tuple(p for p in pattern if isinstance(p, int)), frozenset(kinds)


_PATTERNS = [_parsed(p) for p in lexicon.PATTERNS]


def _passage(found: dict[str, list[Match]], sentence: str) -> float:
    """The largest weight of a passage that fits a pattern, normalised by the words it spans."""
    blanks: list[int] | None = None
    peak = 0.0
    here = found.keys()
    for kinds, gaps, needed in _PATTERNS:
        if not needed <= here:
            continue
        if len(kinds) == 1:
            peak = max(peak, *(w for _, _, w in found[kinds[0]]))
            continue
        if blanks is None:
            blanks = [i for i, c in enumerate(sentence) if c == " "]
        # Passages that end with the parts seen so far: last character, first character, weight.
        open_ = [(last, first, w) for first, last, w in found[kinds[0]]]
        for kind, gap in zip(kinds[1:], gaps, strict=True):
            longer, starts = [], [m[0] for m in found[kind]]
            for last, first, weight in open_:
                for n in range(bisect_right(starts, last), len(starts)):
                    start, end, more = found[kind][n]
                    if start - last > LETTERS * (gap + 1) + 4:
                        break
                    if bisect_right(blanks, start) - bisect_right(blanks, last) - 1 <= gap:
                        longer.append((end, first, weight + more))
            open_ = longer
            if not open_:
                break
        for last, first, weight in open_:
            words = bisect_right(blanks, last) - bisect_right(blanks, first) + 1
            peak = max(peak, weight * PASSAGE / max(PASSAGE, words))
    return peak


def _sentence(core: list[tuple[int, int, tuple[tuple[str, float], ...]]], sentence: str, words: Lexicon) -> float:
    """The weight of a sentence with the core matches found in it; what a harmless phrase covers, or is said of a thing, doesn't count."""
    matches = list(core)
    harmless: list[tuple[int, int]] = []
    things: set[int] = set()
    ended: set[int] = set()
    for last, (length, blank, kinds) in words.beside.iter(sentence):
        last -= blank
        if kinds[0][0] == "harmless" or kinds[-1][0] == "harmless":
            harmless.append((last - length + 1, last))
            continue
        if any(k == "thing" for k, _ in kinds):
            things.add(last - length + 1)
            ended.add(last)
        matches.append((last - length + 1, last, kinds))
    found: dict[str, list[Match]] = {}
    said_of_thing = -len(sentence) - 2 * LETTERS
    for first, last, kinds in sorted(matches):
        if any(a <= first and last <= b for a, b in harmless):
            continue
        for kind, weight in kinds:
            if kind in ("adjective", "insult", "demeaning", "obscene") and last + 2 in things:
                continue
            if kind == "is" and first - 2 in ended:
                said_of_thing = last
                continue
            if kind in ("insult", "demeaning") and first - said_of_thing <= 2 * LETTERS:
                continue
            found.setdefault(kind, []).append((first, last, weight))
    return _passage(found, sentence)


def measure(text: str | None, words: Lexicon) -> tuple[float, float]:
    """The largest weight of a passage, and the summed weight of abusive sentences for 1000 characters."""
    if not text or text.isspace():
        return 0.0, 0.0
    folded = fold(text)
    hits = [(last - blank - length + 1, last - blank, kinds) for last, (length, blank, kinds) in words.core.iter(folded)]
    for m in _PEOPLES.finditer(folded) if any(e in folded for e in _PEOPLE_ENDS) else ():
        if m[m.lastindex] not in words.no_peoples:
            hits.append((m.start(m.lastindex), m.end(m.lastindex) - 1, (("group", 0.5),)))
    if not hits:
        return 0.0, 0.0
    hits.sort()
    peak = total = 0.0
    at = 0
    while at < len(hits):
        start, end = folded.rfind("|", 0, hits[at][0]) + 1, folded.find("|", hits[at][0])
        inside = []
        while at < len(hits) and hits[at][0] < end:
            inside.append((hits[at][0] - start, hits[at][1] - start, hits[at][2]))
            at += 1
        weight = _sentence(inside, folded[start:end], words)
        peak, total = max(peak, weight), total + (weight if weight >= THRESHOLD else 0)
    return peak, total * 1000 / max(len(folded), 200)


_MEASURE = "struct<peak: double, score: double>"


def abuse_measure(text: Column | str) -> Column:
    """A struct of `peak`, the largest normalised weight of any passage, and `score`, the abuse per 1000 characters.

    Null, empty and blank texts measure 0. Texts are measured whole, in one Arrow pass without shuffle.
    """

    @F.pandas_udf(_MEASURE)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = automaton()
        for texts in batches:
            yield pd.DataFrame([measure(t, matcher) for t in texts], columns=["peak", "score"], dtype="float64")

    return run(text)


def score_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every document with `peak`, `score` and `flagged`, which is true from a peak of THRESHOLD on.

    `peak` is the weight of the heaviest passage, normalised by the length of the passage, so that one threat
    in a long text is found; `score` is the weight of all abusive sentences normalised by the length of the text. Extra columns are ignored, repeated keys are kept.
    """
    return documents.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), abuse_measure(text).alias("m")).select(
        "doc_id", "source", "m.peak", "m.score", (F.col("m.peak") >= THRESHOLD).alias("flagged")
    )


def source_rates(scored: DataFrame) -> DataFrame:
    """Of every source (null is one): documents, flagged documents, their share, and the mean score."""
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if("flagged").alias("flagged"),
        (F.count_if("flagged") / F.count(F.lit(1))).alias("rate"),
        F.avg("score").alias("mean_score"),
    )
