"""Secret scan: fixed patterns, and formats inferred from the credentials they find.

The patterns label credentials. From a sample of each kind a prefix tree is built, and
states whose futures are statistically alike are merged (ALERGIA), which leaves a small
probabilistic automaton of the format. Every other token that could be a credential is
scored by how much likelier the automata make it than ordinary tokens do.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likertlake.llm.share import column_udf, share
from likertlake.session import Workspace

#: The patterns of the three base kinds, and the least length of what is
#: in the last group. Letters of the first pattern stand for either case.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

BASE = ("assign", "access", "hex")
LEARNED = "format"
#: Tokens that could be credentials are of this length, or as short as labelled ones usually are if that is less.
CANDIDATE = 16
ALPHABET = 68
#: Distinct credentials of each kind, and distinct ordinary tokens, to learn from.
SAMPLE, ORDINARY_SAMPLE = 1500, 5000
#: Confidence of a merge test, share of the labelled credentials that may score below the
#: threshold, and the least gain in nats for each character.
ALPHA, BELOW, LEAST_GAIN = 0.05, 0.05, 0.5
PLACEHOLDER = "<redacted>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points) of the matches long enough, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # Runs are maximal, so asking for the length in the pattern drops the same matches.
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(BASE[k], s, e) for s, k, e in sorted(found)]


_ASSIGN = re.compile(ASSIGN, re.I | re.A)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(HEX.replace("+", f"{{{LEAST['hex']},}}"))


def _outside(pattern: re.Pattern[str], text: str, spans: list[tuple[str, int, int]]) -> Iterator[re.Match[str]]:
    """Matches that touch none of the spans, which are in order of their start."""
    starts, ends = [], []  # of runs of overlapping spans
    for _, s, e in spans:
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for m in pattern.finditer(text):
        k = bisect_right(ends, m.start())
        if k == len(starts) or starts[k] >= m.end():
            yield m


def token(least: int) -> re.Pattern[str]:
    return re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{least},}}")


class Automaton:
    """A probabilistic automaton: of each state the visits, ends, and next state by symbol."""

    def __init__(self) -> None:
        self.visits, self.ends, self.next = [0], [0], [{}]
        self.count: list[Counter] = [Counter()]

    def add(self, word: str) -> None:
        state = 0
        self.visits[0] += 1
        for c in word:
            self.count[state][c] += 1
            if c not in self.next[state]:
                self.next[state][c] = len(self.visits)
                self.visits.append(0)
                self.ends.append(0)
                self.next.append({})
                self.count.append(Counter())
            state = self.next[state][c]
            self.visits[state] += 1
        self.ends[state] += 1

    def alike(self, a: int, b: int, alpha: float) -> bool:
        """Hoeffding's test for the ends and symbols of two states and of those they lead to."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = self.visits[a], self.visits[b]
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / alpha)) * (n**-0.5 + m**-0.5)
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a][c] / n - self.count[b][c] / m) > bound:
                    return False
            stack += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys() if self.next[a][c] != self.next[b][c]]
        return True

    def fold(self, a: int, b: int) -> None:
        """Add state ``b``, the root of a tree, to state ``a``."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            self.count[a].update(self.count[b])
            for c, to in self.next[b].items():
                if c in self.next[a]:
                    stack.append((self.next[a][c], to))
                else:
                    self.next[a][c] = to

    def merged(self, alpha: float = ALPHA) -> Automaton:
        """Merge states in order of their shortest word, as long as two are alike."""
        red, blue = [0], [(0, c) for c in sorted(self.next[0])]
        while blue:
            parent, c = blue.pop(0)
            state = self.next[parent][c]
            if state in red:
                continue
            for r in red:
                if self.alike(r, state, alpha):
                    self.next[parent][c] = r
                    self.fold(r, state)
                    break
            else:
                red.append(state)
            known = set(red)
            blue = [(r, c) for r in red for c in sorted(self.next[r]) if self.next[r][c] not in known]
        number = {r: k for k, r in enumerate(red)}
        out = Automaton()
        out.visits, out.ends, out.count = [self.visits[r] for r in red], [self.ends[r] for r in red], [self.count[r] for r in red]
        out.next = [{c: number[to] for c, to in self.next[r].items()} for r in red]
        return out

    def log_likelihood(self, word: str) -> float:
        """Of the word and its end; a symbol never seen in a state leaves the state as it is."""
        state, total = 0, 0.0
        for c in word:
            total += math.log((self.count[state][c] + 1 / ALPHABET) / (self.visits[state] + 1))
            state = self.next[state].get(c, state)
        return total + math.log((self.ends[state] + 0.5) / (self.visits[state] + 1))


def learn(words: list[str], alpha: float = ALPHA) -> Automaton:
    tree = Automaton()
    for w in sorted(words):
        tree.add(w)
    return tree.merged(alpha)


class Ordinary:
    """Pairs of neighbouring characters of tokens that are no credentials."""

    def __init__(self, tokens: list[str]) -> None:
        self.pair, self.single = Counter(), Counter()
        for t in tokens:
            self.pair.update(zip("^" + t, t))
            self.single.update("^" + t)

    def log_likelihood(self, word: str) -> float:
        return sum(math.log((self.pair[a, b] + 4 / ALPHABET) / (self.single[a] + 4)) for a, b in zip("^" + word, word))


class Formats:
    """Automata by kind, and the gain over ordinary tokens that each asks for."""

    def __init__(self, samples: dict[str, list[str]], ordinary: list[str], shortest: int = CANDIDATE) -> None:
        self.shortest = shortest
        self.ordinary = Ordinary(ordinary)
        self.automata = {k: learn(words) for k, words in sorted(samples.items()) if words}
        self.least = {}
        for kind, words in samples.items():
            if words:
                own = sorted(self.gain(kind, w) for w in words)
                self.least[kind] = max(LEAST_GAIN, own[int(BELOW * len(own))])

    def gain(self, kind: str, word: str) -> float:
        return (self.automata[kind].log_likelihood(word) - self.ordinary.log_likelihood(word)) / (len(word) + 1)

    def score(self, word: str) -> float | None:
        """How far a token is beyond the nearest threshold, or None if it is below all."""
        best = max((self.gain(k, word) - least for k, least in self.least.items()), default=-1.0)
        return best if best >= 0 else None


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE, ordinary: int = ORDINARY_SAMPLE) -> Formats:
    """Learn the formats of the credentials that the patterns find in all texts.

    Of each kind the ``sample`` distinct values of the least hash are learned from, and
    as many ``ordinary`` tokens that no pattern matches, as short as the credentials of the whole corpus
    are (but for the shortest twentieth). With no credentials there are no formats, and only the patterns
    find anything.
    """
    space, kind = Workspace(docs.sparkSession, "secrets"), "array<struct<kind string, value string>>"

    def values(least: int, labelled: bool) -> DataFrame:
        pattern = token(least)

        def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                out = []
                for x in batch.to_pylist():
                    t = x or ""
                    spans = base_spans(t)
                    own = [(k, (_ASSIGN.match(t, s).group(2) if k == "assign" else t[s:e])) for k, s, e in spans] if labelled else []
                    own += [("", m.group()) for m in _outside(pattern, t, spans)]
                    out.append([{"kind": k, "value": v} for k, v in own])
                yield pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())])))

        return space.cut(docs.select(F.inline(column_udf(found, kind)(f"`{text}`"))).distinct(), "labelled")

    each = values(CANDIDATE, True)
    # A length that all but a share of the credentials have: a single short one changes nothing for the rest.
    usual = each.where("kind <> ''").agg(F.percentile(F.length("value"), BELOW)).first()[0]
    shortest = min(CANDIDATE, max(LEAST["assign"], CANDIDATE if usual is None else int(usual)))
    plain = each if shortest == CANDIDATE else values(shortest, False)
    got: dict[str, list[str]] = {}
    for k in (*BASE, ""):
        rows = (each if k else plain).where(F.col("kind") == k).orderBy(F.xxhash64("value"), "value").limit(ordinary if k == "" else sample)
        got[k] = [r.value for r in rows.collect()]  # bounded by the sample
    return Formats({k: v for k, v in got.items() if k}, got[""], shortest)


_SPANS = "array<struct<kind: string, start: bigint, end: bigint, score: double>>"


def scan(docs: DataFrame, formats: Formats, text: str = "text", to: str = "secrets") -> DataFrame:
    """``docs`` with the spans found in the whole text in column ``to``, by start, then kind.

    Spans are kind, start, end (exclusive, in code points) and score: base matches (1) in
    full, and tokens that touch none of them but fit an inferred format (``format``, with
    the gain beyond the threshold). Base matches of one kind never overlap, those of
    different kinds may. A null or empty text has none. A column ``to`` of ``docs`` is
    replaced, others stay as they are.
    """
    get = share(docs.sparkSession, formats)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        formats = get()
        pattern = token(formats.shortest)
        for batch in batches:
            yield pa.array([_spans(x or "", formats, pattern) for x in batch.to_pylist()], _TYPE)

    keep = [f"`{c}`" for c in docs.columns if c != to]
    return docs.select(*keep, column_udf(run, _SPANS)(f"`{text}`").alias(to))


_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def _spans(text: str, formats: Formats, pattern: re.Pattern[str]) -> list[dict]:
    base = base_spans(text)
    out = [{"kind": k, "start": s, "end": e, "score": 1.0} for k, s, e in base]
    for m in _outside(pattern, text, base):
        if (score := formats.score(m.group())) is not None:
            out.append({"kind": LEARNED, "start": m.start(), "end": m.end(), "score": score})
    rank = {k: i for i, k in enumerate((*BASE, LEARNED))}
    return sorted(out, key=lambda x: (x["start"], rank[x["kind"]]))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(docs: DataFrame, text: str = "text", secrets: str = "secrets") -> Column:
    """The text with each run of overlapping spans replaced by a placeholder; null stays null."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for row in batch:
                t, at, parts = row["text"].as_py(), 0, []
                for s in row["spans"].as_py() or ():
                    if s["start"] >= at:
                        parts += [t[at : s["start"]], PLACEHOLDER]
                    at = max(at, s["end"])
                out.append(None if t is None else "".join([*parts, t[at:]]))
            yield pa.array(out, pa.string())

    return column_udf(run, "string")(F.struct(docs[text].alias("text"), docs[secrets].alias("spans")))
