"""Secret scans with inferred grammars.

Base rules find assignments, access keys and long hexadecimal runs. The values they find are the labelled credentials: their
prefix tree, over character classes with coarse places, is folded by merging states whose outgoing frequencies are statistically
compatible (the ALERGIA test) into a probabilistic automaton. Other strings of the same kind of characters, nearly all of them ordinary
words, numbers and paths, give a second automaton. Every candidate of every text is scored by the log-likelihood ratio of the two
per character, its end included; those above the threshold become spans of kind ``format``.

Learned from every distinct value and string of the whole table, over the cluster: how often each prefix of formats goes on with
which class, or ends. The ``states`` most frequent prefixes of each kind are the tree; all others, and what follows character
``DEPTH``, are counted too, in one state per place in the string. The threshold lets through at most the share ``false_share`` of
all those other strings; it is found by finer and finer bins of their scores.

A candidate has 12 or more characters, as a base value has, and neither begins nor ends with a sign but for the equal signs at an end.

Defined results: null and empty texts have no spans; texts are scanned whole; repeated rows are scanned each for itself; null
ids are carried along; an empty table, or one without credentials, gives base spans alone; columns other than the id and
the text are ignored; a candidate that touches a base span adds nothing.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import map_rows, pieces
from moorage.session import materialise

# The base rules.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9][A-Za-z0-9+/_.=-]{10,}[A-Za-z0-9=]")
KINDS = ("assign", "access", "hex", "format")
NAMES = ("passw", "secret", "token", "api")

#: Characters of the longest string of a sample.
LONGEST = 4096


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    value: str


def base_spans(text: str) -> list[Span]:
    """Matches of the base rules, leftmost and non-overlapping per kind, by start and then by kind."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES) or not text.isascii() and ASSIGN.search(text):
        found += [Span("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [Span("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [Span("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda span: (span.start, KINDS.index(span.kind), span.end))


#: Places from which on the next coarse place holds; an automaton over them keeps the lengths of formats apart.
PLACES = (4, 8, 12, 16, 20, 24, 28, 32, 36, 40, 48, 64)
CLASSES = "dhlUso"
END = "$"
#: Characters after which no coarse place begins; longer prefixes are not told apart.
DEPTH = PLACES[-1]
_PLACE = [sum(place <= position for place in PLACES) for position in range(DEPTH + 1)]


class _Kinds(dict):
    def __missing__(self, code):
        return "o"


_KNOWN = string.digits + string.ascii_letters + "+/_.=-"
_KNOWN_KINDS = "d" * 10 + "h" * 6 + "l" * 20 + "U" * 26 + "s" * 6
_KIND = _Kinds(zip(map(ord, _KNOWN), _KNOWN_KINDS))


def placed(classes: str) -> list[str]:
    """Each class with its coarse place."""
    return [f"{kind}{_PLACE[min(position, DEPTH)]}" for position, kind in enumerate(classes)]


def symbols(value: str) -> list[str]:
    """A class and a coarse place per character: digit, hexadecimal letter, other small letter, capital, sign, other."""
    return placed(value.translate(_KIND))


class Grammar:
    """A probabilistic automaton folded from a prefix tree of example strings."""

    def __init__(self, examples: list[list[str]], alpha: float = 0.05):
        self.alpha = alpha
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[dict[str, int]] = [{}]
        self.ends = [0]
        for example, times in Counter(map(tuple, examples)).items():
            state = 0
            for symbol in example:
                self.seen[state][symbol] = self.seen[state].get(symbol, 0) + times
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.next)
                    self.next.append({})
                    self.seen.append({})
                    self.ends.append(0)
                state = self.next[state][symbol]
            self.ends[state] += times
        self._rest = len(self.next)
        self._merge()

    @classmethod
    def counted(cls, nodes: dict[str, Counter], rest: list[Counter], alpha: float = 0.05) -> Grammar:
        """From how often each prefix of classes goes on with which class, or ends, and the same for all other prefixes by length.

        With a prefix ``nodes`` holds all shorter ones of it.
        """
        self = cls.__new__(cls)
        self.alpha = alpha
        prefixes = sorted(nodes, key=lambda prefix: (len(prefix), prefix)) or [""]
        number = {prefix: state for state, prefix in enumerate(prefixes)}
        self._rest = len(prefixes)
        self.next, self.seen, self.ends = [], [], []
        for prefix in prefixes:
            self._add(nodes.get(prefix, Counter()), len(prefix), lambda kind: number.get(prefix + kind))
        for length, counts in enumerate(rest):
            self._add(counts, length, lambda kind: None)
        self._merge()
        return self

    def _add(self, counts: Counter, length: int, known) -> None:
        """A state from its counts; what follows that is not ``known`` is in the state of all other prefixes of its length."""
        after = self._rest + min(length + 1, DEPTH)
        going = {f"{kind}{_PLACE[length]}": kind for kind in CLASSES if counts[kind]}
        follows = {symbol: known(kind) for symbol, kind in going.items()}
        self.next.append({symbol: after if state is None else state for symbol, state in follows.items()})
        self.seen.append({symbol: counts[kind] for symbol, kind in going.items()})
        self.ends.append(counts[END])

    def total(self, state: int) -> int:
        return self.ends[state] + sum(self.seen[state].values())

    def _alike(self, a: int, b: int) -> bool:
        """Whether the frequencies of both states, and of what follows them, could come from one state."""
        pairs = [(a, b)]
        done = set()
        while pairs:
            a, b = pairs.pop()
            if a == b or (a, b) in done:
                continue
            done.add((a, b))
            n, m = self.total(a), self.total(b)
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / self.alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for symbol in self.seen[a].keys() | self.seen[b].keys():
                if abs(self.seen[a].get(symbol, 0) / n - self.seen[b].get(symbol, 0) / m) > bound:
                    return False
                after = self.next[a].get(symbol, self._rest), self.next[b].get(symbol, self._rest)
                if max(after) < self._rest:
                    pairs.append(after)
        return True

    def _fold(self, red: int, blue: int) -> None:
        """Add the tree below ``blue`` onto ``red``; merged states share their successors. The states of other prefixes stay."""
        pairs = [(red, blue)]
        while pairs:
            a, b = pairs.pop()
            if a == b:
                continue
            self.ends[a] += self.ends[b]
            for symbol, n in self.seen[b].items():
                self.seen[a][symbol] = self.seen[a].get(symbol, 0) + n
            for symbol, after in self.next[b].items():
                if self.next[a].get(symbol, self._rest) >= self._rest:
                    self.next[a][symbol] = after
                elif after < self._rest:
                    pairs.append((self.next[a][symbol], after))

    def _merge(self) -> None:
        red = [0]
        settled = {0}
        place = 0
        while place < len(red):
            state = red[place]
            place += 1
            for symbol in sorted(self.next[state]):
                blue = self.next[state][symbol]
                if blue in settled or blue >= self._rest:
                    continue
                for known in red:
                    if self._alike(known, blue):
                        self.next[state][symbol] = known
                        self._fold(known, blue)
                        place = 0 if known in red[:place] else place
                        break
                else:
                    red.append(blue)
                    settled.add(blue)
        self.states = len(red)

    def likelihood(self, smooth: float = 0.05) -> Likelihood:
        """Log probabilities, smoothed by ``smooth`` occurrences of every class and of the end."""
        chances, ends, unseen = [], [], []
        most: dict[str, tuple[int, int]] = {}
        for state in range(len(self.next)):
            n = self.total(state) + smooth * (len(CLASSES) + 1)
            chances.append({s: math.log((times + smooth) / n) for s, times in self.seen[state].items()})
            ends.append(math.log((self.ends[state] + smooth) / n))
            unseen.append(math.log(smooth / n))
            for symbol, after in self.next[state].items():
                most[symbol[1:]] = max(most.get(symbol[1:], (-1, 0)), (self.seen[state][symbol], after))
        return Likelihood(chances, ends, unseen, self.next, {place: after for place, (_, after) in most.items()})


class Likelihood(NamedTuple):
    """Log probabilities of an automaton. After a symbol that a state doesn't know, the likeliest state of its place follows."""

    chances: list[dict[str, float]]
    ends: list[float]
    unseen: list[float]
    next: list[dict[str, int]]
    usual: dict[str, int]

    def of(self, classes: list[str]) -> float:
        state, total = 0, 0.0
        for symbol in classes:
            total += self.chances[state].get(symbol, self.unseen[state])
            after = self.next[state].get(symbol)
            state = self.usual.get(symbol[1:], 0) if after is None else after
        return total + self.ends[state]


class Judge:
    """Scores strings by how much more likely their format is under the credentials' grammar than under that of others."""

    def __init__(self, credentials: list[str], words: list[str], threshold: float = 0.1, false_share: float = 0.001):
        self.good = Grammar([symbols(value) for value in credentials]).likelihood()
        self.plain = Grammar([symbols(value) for value in words]).likelihood()
        rest = sorted(map(self.score, words), reverse=True)
        # At most the given share of the other strings may pass; one odd string among them doesn't move it.
        self.threshold = max(threshold, rest[int(false_share * len(rest))] if rest else threshold)

    @classmethod
    def of(cls, good: Likelihood, plain: Likelihood, threshold: float) -> Judge:
        self = cls.__new__(cls)
        self.good, self.plain, self.threshold = good, plain, threshold
        return self

    def score(self, value: str) -> float:
        return self.score_format(value.translate(_KIND))

    def score_format(self, classes: str) -> float:
        found = placed(classes)
        return (self.good.of(found) - self.plain.of(found)) / (len(found) + 1)


def scan_text(text: str | None, judge: Judge | None) -> list[Span]:
    """Base spans, and the candidates clear of them whose format the judge accepts."""
    text = text or ""
    found = base_spans(text)
    if judge is None:
        return found
    formats, place, reach = [], 0, 0
    for match in CANDIDATE.finditer(text):
        start, end = match.span()
        # Both lists go by start; ``reach`` is how far the base spans that begin before this candidate's end go.
        while place < len(found) and found[place].start < end:
            reach = max(reach, found[place].end)
            place += 1
        if reach <= start and judge.score(match[0]) > judge.threshold:
            formats.append(Span("format", start, end, match[0]))
    return sorted([*found, *formats], key=lambda span: (span.start, KINDS.index(span.kind), span.end))


class Smallest:
    """The distinct strings with the smallest hashes; holds a few times ``most`` of them at most. `learn` takes no such sample."""

    def __init__(self, most: int):
        self.most, self.held = most, {}

    def add(self, value: str) -> None:
        if len(value) <= LONGEST and value not in self.held:
            self.held[value] = xxhash.xxh3_64_intdigest(value.encode()) >> 1
            if len(self.held) > 4 * self.most:
                self.held = dict(self.found())

    def found(self) -> list[tuple[str, int]]:
        return sorted(self.held.items(), key=lambda item: (item[1], item[0]))[: self.most]


#: Prefixes of each kind that have a state of their own before states are merged.
STATES = 2000


def formats(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The distinct values of the base rules (``good`` 1) and all other candidates (0) of the whole table, counted by ``classes``."""

    def run(batches):
        for batch in (piece for whole in batches for piece in pieces(whole)):
            found = set()
            for value in batch.column(0).to_pylist():
                found.update((int(span.kind != "format"), span.value) for span in scan_text(value, _Everything()))
            good, values = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(good), pa.int32()), pa.array(list(values), pa.string())], names=["good", "value"]
            )

    values = docs.select(text).mapInArrow(run, "good int, value string").groupBy("value").agg(F.max("good").alias("good"))
    # All their characters are letters, digits and signs of the base rules.
    kinds = F.translate("value", _KNOWN, _KNOWN_KINDS).alias("classes")
    return values.groupBy("good", kinds).agg(F.count("*").alias("n"))


def _counted(steps: DataFrame, states: int) -> Grammar:
    """The grammar of ``steps``: (prefix, next class or end, times)."""
    marks = CLASSES + END
    times = [F.sum(F.when(F.col("after") == mark, F.col("n")).otherwise(0)).alias(f"n{k}") for k, mark in enumerate(marks)]
    counter = lambda row: Counter({mark: row[f"n{k}"] for k, mark in enumerate(marks)})
    rest = [Counter() for _ in range(DEPTH + 1)]
    for row in steps.groupBy("length").agg(*times).collect():
        rest[row["length"]] = counter(row)
    common = steps.where(F.col("length") < DEPTH).groupBy("prefix").agg(F.sum("n").alias("total"), *times)
    # A prefix is at least as frequent as any longer one of it.
    common = common.orderBy(F.desc("total"), F.length("prefix"), "prefix").limit(states)
    nodes = {row["prefix"]: counter(row) for row in common.collect()}
    for prefix, counts in nodes.items():
        rest[len(prefix)].subtract(counts)
    return Grammar.counted(nodes, rest)


def _steps(found: DataFrame) -> DataFrame:
    """What follows each prefix of each format; after ``DEPTH`` characters the prefixes are one, and what follows is summed per class."""
    size, begun = F.length("classes"), F.concat("classes", F.lit(END))
    near = found.select("n", begun.alias("text"), F.explode(F.sequence(F.lit(0), F.least(size, F.lit(DEPTH - 1)))).alias("length"))
    near = near.selectExpr("n", "length", "substring(text, 1, length) AS prefix", "substring(text, length + 1, 1) AS after")
    tail = F.substr(begun, F.lit(DEPTH + 1))
    times = [
        F.struct(F.lit(mark).alias("after"), (size + 1 - F.lit(DEPTH) - F.length(F.replace(tail, F.lit(mark)))).alias("times"))
        for mark in CLASSES + END
    ]
    far = found.where(size >= DEPTH).select("n", F.inline(F.array(*times))).selectExpr(
        "n * times AS n", f"{DEPTH} AS length", "'' AS prefix", "after"
    )
    return near.unionByName(far)


def _share(scored: DataFrame, false_share: float, least: float) -> float:
    """The smallest score, from ``least`` on, that at most the share of all rows (``score``, ``n``) lies above."""
    allowed = int(false_share * (scored.agg(F.sum("n")).first()[0] or 0))
    found, above = least, 0
    for width in (1.0, 0.01, 0.0001, 0.000001):
        place = F.floor(F.col("score") / width)
        bins = scored.groupBy(place.alias("bin")).agg(F.sum("n").alias("n"), F.max("score").alias("highest")).collect()
        for one in sorted(bins, key=lambda row: -row["bin"]):
            if above + one["n"] > allowed:
                found, scored = one["highest"], scored.where(place == one["bin"])
                break
            above += one["n"]
    return max(least, found)


def learn(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", states: int = STATES, threshold: float = 0.1,
    false_share: float = 0.001,
) -> Judge | None:
    """A judge from all base values and other strings of the whole table, however it is split; None without a base value.

    At most ``states`` prefixes and a state for each place come to the driver per grammar.
    """
    found = materialise(formats(docs, text=text), "formats")
    credentials, words = found.where("good = 1"), found.where("good = 0")
    if credentials.isEmpty():
        return None
    judge = Judge.of(*(_counted(_steps(part), states).likelihood() for part in (credentials, words)), threshold)
    scored = map_rows(words, ["classes", "n"], lambda classes, n: (judge.score_format(classes), n), "score double, n long")
    return Judge.of(judge.good, judge.plain, _share(materialise(scored, "scores"), false_share, threshold))


class _Everything:
    """A judge that accepts every candidate."""

    threshold = -1.0

    def score(self, value: str) -> float:
        return 0.0


def scan(docs: DataFrame, judge: Judge | None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and ``spans``, by start and kind; places are code points, ends exclusive."""
    kind = docs.schema[key].dataType.simpleString()

    def row(k, t):
        return k, [span._asdict() for span in scan_text(t, judge)]

    return map_rows(
        docs, [key, text], row, f"`{key}` {kind}, spans array<struct<kind:string,start:long,end:long,value:string>>"
    )
