"""Personal data, also in disguise, with spans of the text as it stands.

Fixed patterns find identifiers in the text itself. Transducers then rewrite it step by
step: look-alike and invisible characters, spelled at and dot, spelled digits, letters
among digits. Each remembers which source characters every rewritten place came from, so
an identifier found in the rewritten text is mapped back, step by step, to the exact
characters of the source. It is reported where rewriting made a difference to it.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likertlake.llm.share import column_udf

KINDS = ("email", "ip", "card", "phone")

#: The patterns of the four kinds. Possessive repeats and looks at the
#: neighbour change no match of theirs; they spare long runs a second try at every place.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            last = m.end()
            yield start, last


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 4 and int(p or "0") <= 255 for p in parts):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and _luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


_FINDERS: tuple[Callable[[str], Iterator[tuple[int, int]]], ...] = (_emails, _ips, _cards, _phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end (code points) of the identifiers in plain sight, by start, then kind."""
    return sorted((s, k, e) for k, find in enumerate(_FINDERS) for s, e in find(text))


# -- rewriting with a way back ----------------------------------------------


class Rewritten:
    """A text after some edits, and where its places were before."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]) -> None:
        """``edits`` are start, end and what stands there instead, in order and apart."""
        parts, at, size = [], 0, 0
        self.starts: list[int] = []  # of what was put in, in the new text
        self.ends: list[int] = []
        self.source: list[tuple[int, int]] = []
        for start, end, new in edits:
            parts += [text[at:start], new]
            size += start - at
            self.starts.append(size)
            size += len(new)
            self.ends.append(size)
            self.source.append((start, end))
            at = end
        self.text = "".join([*parts, text[at:]])

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The source span of a span of the new text; what was put in stands for all it replaced."""
        k = bisect_right(self.starts, start) - 1
        first = start
        if k >= 0:
            first = self.source[k][0] if start < self.ends[k] else self.source[k][1] + start - self.ends[k]
        k = bisect_right(self.starts, end - 1) - 1
        last = end
        if k >= 0:
            last = self.source[k][1] if end - 1 < self.ends[k] else self.source[k][1] + end - self.ends[k]
        return first, last


#: Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟՕ", "P": "РΡ", "S": "ЅՏ",
    "T": "ТΤ", "X": "ХΧ", "Y": "УΥҮ", "Z": "Ζ", "a": "аα", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡց", "h": "һհ", "i": "іıι", "j": "јϳ", "k": "κ",
    "l": "ӏ", "n": "ոп", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "սυ", "v": "νѵ", "w": "ԝѡ", "x": "хχ", "y": "уү",
}
_STOPS = "․。｡"


def _lookalike_table() -> dict[str, str]:
    """What each look-alike stands for; characters that cannot be seen stand for nothing."""
    out = {x: c for c, many in LOOKALIKES.items() for x in many} | {x: "." for x in _STOPS}
    for code in range(0x80, 0x20000):
        c = chr(code)
        kind = unicodedata.category(c)
        if kind == "Nd":
            out[c] = str(unicodedata.decimal(c))
        elif kind == "Zs":
            out[c] = " "
        elif kind == "Pd" or c == "−":
            out[c] = "-"
        elif kind == "Cf":
            out[c] = ""
        elif 0xFF01 <= code <= 0xFF5E or 0xFE50 <= code <= 0xFE6B or 0x1D400 <= code <= 0x1D7FF:
            plain = unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and plain.isascii():
                out[c] = plain
    return out


_TABLE = _lookalike_table()
_LOOKALIKES = frozenset(_TABLE)


def _plain_characters(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    out = []
    for c in _LOOKALIKES.intersection(text):
        at = text.find(c)
        while at >= 0:
            out.append((at, at + 1, _TABLE[c]))
            at = text.find(c, at + 1)
    return sorted(out)


#: Words for at, dot, plus and the digits in the languages of the corpus, and
#: endings of domains that are no words of these languages.
AT, DOT, PLUS = "at|ät|arroba|arobase", "dot|punkt|punto|point", "plus|más"
DIGITS = (
    "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
DOMAINS = "com|org|net|edu|gov|info|biz|io|co|uk|eu|ch|de|fr|dev|app|example"

_OPEN, _CLOSE = r"\x20{0,2}[\[({<]\x20{0,2}", r"\x20{0,2}[\])}>]\x20{0,2}"
_BRACKETED = re.compile(rf"{_OPEN}(?:(?P<at>{AT}|@)|{DOT}|\.){_CLOSE}", re.I)
_SAID = re.compile(
    rf"(?<![A-Za-z0-9._%+-])(?:[A-Za-z0-9._%+-]++\x20(?:{DOT})\x20){{0,4}}[A-Za-z0-9._%+-]++(?:@|\x20(?:{AT})\x20)"
    rf"(?:[A-Za-z0-9-]++(?:\.|\x20(?:{DOT})\x20)){{0,5}}[A-Za-z0-9-]++\x20(?:{DOT})\x20(?:{DOMAINS})(?![\w-])",
    re.I,
)
_SAID_SIGN = re.compile(rf"\x20(?:(?P<at>{AT})|{DOT})\x20", re.I)
_SAID_DOTS = tuple(f" {w} " for w in DOT.split("|"))


def _signs(text: str) -> list[tuple[int, int, str]]:
    """At and dot in brackets, and as words where they make up a whole address."""
    out = [(m.start(), m.end(), "@" if m.group("at") else ".") for m in _BRACKETED.finditer(text)] if "[" in text or "(" in text or "{" in text or "<" in text else []
    low = text.lower()
    if any(w in low for w in _SAID_DOTS):
        taken = [(s, e) for s, e, _ in out]
        for m in _SAID.finditer(text):
            for w in _SAID_SIGN.finditer(text, m.start(), m.end()):
                k = bisect_right(taken, (w.end(), 0)) - 1
                if k < 0 or taken[k][1] <= w.start():
                    out.append((w.start(), w.end(), "@" if w.group("at") else "."))
    return sorted(out)


_VALUE = {w: str(d) for words in DIGITS for d, w in enumerate(words.split())}
_SPELLED = re.compile(rf"(?<!\w)(?:{'|'.join(sorted(_VALUE, key=lambda w: (-len(w), w)))})(?!\w)", re.I)
_WORD, _NEIGHBOUR = re.compile(r"\w+"), frozenset(_VALUE) | frozenset(DOT.split("|"))
_GAP = rf"(?:[\x20.-]|\x20(?:{DOT})\x20)"
_BETWEEN, _DIGIT_BEFORE, _DIGIT_AFTER = re.compile(_GAP, re.I), re.compile(rf"[0-9]{_GAP}\Z", re.I), re.compile(rf"{_GAP}[0-9]", re.I)
_LONGEST_GAP = max(map(len, _SAID_DOTS))


def _may_spell(text: str) -> bool:
    """Whether a word for a digit has one, a digit or a dot for its neighbour, whatever stands between."""
    words = _WORD.findall(text.casefold())
    return any((a in _VALUE and (b in _NEIGHBOUR or b[0].isdecimal())) or (b in _VALUE and (a in _NEIGHBOUR or a[-1].isdecimal())) for a, b in zip(words, words[1:]))


def _spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Words for digits next to another digit; those that follow each other are written together."""
    if not _may_spell(text):
        return []
    found = [m.span() for m in _SPELLED.finditer(text) if m.group().casefold() in _VALUE]  # other letters may fold to these
    # Whether only a gap lies between a word and the one before it.
    linked = [False, *[b[0] - a[1] <= _LONGEST_GAP and bool(_BETWEEN.fullmatch(text, a[1], b[0])) for a, b in zip(found, found[1:])], False]
    out: list[tuple[int, int, str]] = []
    for k, (s, e) in enumerate(found):
        if linked[k] or linked[k + 1] or _DIGIT_AFTER.match(text, e) or _DIGIT_BEFORE.search(text[max(0, s - _LONGEST_GAP - 1) : s]):
            if linked[k] and text[found[k - 1][1] : s] in (" ", "-"):
                out.append((s - 1, s, ""))
            out.append((s, e, _VALUE[text[s:e].casefold()]))
    return out


_DOT_OF_DIGITS = re.compile(rf"(?<=[0-9])\x20(?:{DOT})\x20(?=[0-9])", re.I)
_PLUS_OF_DIGITS = re.compile(rf"(?<!\w)(?:{PLUS})\x20(?=[0-9])", re.I)
_SAID_PLUS = tuple(f"{w} " for w in PLUS.split("|"))


def _signs_of_digits(text: str) -> list[tuple[int, int, str]]:
    low, out = text.lower(), []
    if any(w in low for w in _SAID_DOTS):
        out += [(*m.span(), ".") for m in _DOT_OF_DIGITS.finditer(text)]
    if any(w in low for w in _SAID_PLUS):
        out += [(*m.span(), "+") for m in _PLUS_OF_DIGITS.finditer(text)]
    return sorted(out)


_MIXED = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl]++(?![A-Za-z0-9])(?:[\x20.-][0-9OoIl]++(?![A-Za-z0-9]))*")
_LETTER = {"O": "0", "o": "0", "I": "1", "l": "1"}


def _letters_among_digits(text: str) -> list[tuple[int, int, str]]:
    """Letters that look like digits, in groups that have at least twice as many digits."""
    out = []
    for m in _MIXED.finditer(text):
        own = [(k, k + 1, _LETTER[text[k]]) for k in range(*m.span()) if text[k] in _LETTER]
        if own and 2 * len(own) <= sum(c.isdecimal() for c in m.group()):
            out += own
    return out


TRANSDUCERS = (_plain_characters, _signs, _spelled_digits, _signs_of_digits, _letters_among_digits)


def rewrite(text: str) -> tuple[str, list[Rewritten]]:
    """The text after all transducers, and the steps that changed it."""
    steps = []
    for transducer in TRANSDUCERS:
        if edits := transducer(text):
            steps.append(Rewritten(text, edits))
            text = steps[-1].text
    return text, steps


def spans(text: str) -> list[tuple[int, int, int, bool]]:
    """Start, kind, end and whether it was disguised, by start, kind and end."""
    base = base_spans(text)
    out = [(*x, False) for x in base]
    plain, steps = rewrite(text)
    known = set(base)
    for s, k, e in base_spans(plain) if steps else ():
        first, last = s, e
        for step in reversed(steps):
            first, last = step.back(first, last)
        if text[first:last] != plain[s:e] and (first, k, last) not in known:
            out.append((first, k, last, True))
    return sorted(out)


_SPANS = "array<struct<kind: string, start: bigint, end: bigint, disguised: boolean>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("disguised", pa.bool_())]))


def scan(docs: DataFrame, text: str = "text", to: str = "pii") -> DataFrame:
    """``docs`` with the spans found in the whole text in column ``to``, by start, then kind.

    Spans are kind, start, end (exclusive, in code points) and whether the identifier was
    disguised. Those in plain sight are all there, whatever rewriting finds; of one kind they never
    overlap each other. A disguised one may overlap a part of it that is in plain sight.
    A null or empty text has none. A column ``to`` of ``docs`` is replaced, others stay as they are.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for x in batch:
                found = spans(x.as_py() or "")
                out.append([{"kind": KINDS[k], "start": s, "end": e, "disguised": d} for s, k, e, d in found])
            yield pa.array(out, _TYPE)

    keep = [f"`{c}`" for c in docs.columns if c != to]
    return docs.select(*keep, column_udf(run, _SPANS)(f"`{text}`").alias(to))


def listed(found: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(docs: DataFrame, text: str = "text", found: str = "pii") -> Column:
    """The text with each run of overlapping spans replaced by ``<kind>`` of its first; null stays null."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for row in batch:
                t, at, parts = row["text"].as_py(), 0, []
                for s in row["spans"].as_py() or ():
                    if s["start"] >= at:
                        parts += [t[at : s["start"]], f"<{s['kind']}>"]
                    at = max(at, s["end"])
                out.append(None if t is None else "".join([*parts, t[at:]]))
            yield pa.array(out, pa.string())

    return column_udf(run, "string")(F.struct(docs[text].alias("text"), docs[found].alias("spans")))
