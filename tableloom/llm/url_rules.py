"""URL filter: host rules, then pattern rules found through their rarest literal.

Host rules name a host and the start of a path; the longest that fits decides.
All other URLs meet the pattern rules. A pattern rule is a regular expression. Its
parsed form tells which tokens, or starts, ends or insides of tokens, every
matching URL has. It is filed under the one that the fewest URLs have, for each
of its alternatives, and its expression runs only on URLs that have it.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from re import _constants as parsed
from re import _parser as parser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.functions.columns import column
from tableloom.llm.tables import whole

TOKEN = re.compile("[a-z0-9]+")
HOST = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class HostRule:
    """``allow`` or ``block`` for a host with its subdomains below a path."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over the lower-cased URL."""

    name: str
    verdict: str
    pattern: str


#: Unwanted kinds of pages, by their URLs.
PATTERN_RULES = (
    PatternRule("pill shop", "block", r"//[^/]*\bcheap-pills\b"),
    PatternRule("spam farm", "block", r"//[^/]*\bspam-farm\b"),
    PatternRule("casino", "block", r"//[^/]*\b(online-)?casino\b"),
    PatternRule("free download", "block", r"\bfree[-/]downloads?\b"),
    PatternRule("login page", "block", r"//[^/]*/(.*/)?login\b"),
    PatternRule("cart page", "block", r"//[^/]*/(.*/)?(add-to-)?cart\b"),
    PatternRule("session id", "block", r"[?&]phpsessid=[0-9a-f]+"),
    PatternRule("mirror host", "block", r"//mirror[0-9]*\."),
)


def host_and_path(url: str) -> tuple[str, str]:
    found = HOST.search(url)
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


class HostRules:
    """Rules by host; only the hosts above a URL's own are looked up."""

    def __init__(self, rules: Sequence[HostRule]):
        self.by_host: dict[str, list[HostRule]] = defaultdict(list)
        for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
            self.by_host[rule.host].append(rule)

    def best(self, host: str, path: str) -> HostRule | None:
        parts, fits = host.split("."), []
        for i in range(len(parts)):
            for rule in self.by_host.get(".".join(parts[i:]), ()):
                if path.startswith(rule.path):
                    fits.append(rule)
                    break
        return min(fits, key=lambda r: (-len(r.name), r.name), default=None)


#: What stands in a parsed alternative besides characters: a place where no token goes on,
#: and text that is not known.
EDGE, GAP = "edge", "gap"
#: Alternatives of a pattern; beyond them a part counts as unknown text.
MOST_WAYS = 256
#: How a literal lies in the token of a URL that it is part of.
WHOLE, START, END, INSIDE = range(4)
_EDGES = {
    parsed.AT_BOUNDARY,
    parsed.AT_BEGINNING,
    parsed.AT_BEGINNING_STRING,
    parsed.AT_END,
    parsed.AT_END_STRING,
}


def _is_token(atom: str) -> bool:
    return len(atom) == 1 and TOKEN.fullmatch(atom) is not None


def _class_way(members: list) -> list[str]:
    """A class none of whose characters is part of a token ends one; any other is unknown."""
    for kind, value in members:
        if kind is parsed.LITERAL and not _is_token(chr(value).lower()):
            continue
        if kind is parsed.CATEGORY and value is parsed.CATEGORY_SPACE:
            continue
        return [GAP]
    return [EDGE]


def _ways(tree: Sequence) -> list[list[str]]:
    """Alternatives of a parsed pattern as characters, edges and gaps."""
    made: list[list[str]] = [[]]
    for kind, value in tree:
        if kind is parsed.LITERAL:
            more = [[chr(value).lower()]]
        elif kind is parsed.AT and value in _EDGES:
            more = [[EDGE]]
        elif kind is parsed.IN:
            more = [_class_way(value)]
        elif kind is parsed.SUBPATTERN:
            more = _ways(value[-1])
        elif kind is parsed.BRANCH:
            more = [way for branch in value[1] for way in _ways(branch)]
        elif kind in (parsed.MAX_REPEAT, parsed.MIN_REPEAT, parsed.POSSESSIVE_REPEAT):
            least, most, inner = value
            once = _ways(inner)
            more = [way + [GAP] * (most > 1) for way in once] if least else [[]]
            if not least:
                more += once if most == 1 else [[GAP, *way] for way in once]
        else:
            more = [[GAP]]
        made = [before + way for before in made for way in more]
        if len(made) > MOST_WAYS:
            made = [[GAP]]
    return made


def literals(pattern: str) -> list[set[tuple[int, str]]]:
    """Of each alternative of a pattern the literals in tokens that every match has."""
    found = []
    for way in _ways(parser.parse(pattern, re.DOTALL)):
        # before and after the pattern stands anything
        atoms, held, at = [GAP, *way, GAP], set(), 0
        while at < len(atoms):
            end = at
            while end < len(atoms) and _is_token(atoms[end]):
                end += 1
            if end > at:
                left, right = atoms[at - 1] != GAP, atoms[end] != GAP
                kind = {(True, True): WHOLE, (True, False): START, (False, True): END}
                held.add((kind.get((left, right), INSIDE), "".join(atoms[at:end])))
            at = end + 1
        found.append(held)
    return found


@dataclass
class Literals:
    """Literals to be looked for in the tokens of URLs, by kind and length."""

    known: set[tuple[int, str]]
    lengths: dict[int, list[int]] = field(init=False)

    def __post_init__(self):
        by_kind = defaultdict(set)
        for kind, text in self.known:
            by_kind[kind].add(len(text))
        self.lengths = {kind: sorted(sizes) for kind, sizes in by_kind.items()}

    def of(self, low: str) -> set[tuple[int, str]]:
        """Those that a lower-cased URL has."""
        met = set()
        for token in set(TOKEN.findall(low)):
            met.add((WHOLE, token))
            for n in self.lengths.get(START, ()):
                met.add((START, token[:n]))
            for n in self.lengths.get(END, ()):
                met.add((END, token[-n:]))
            for n in self.lengths.get(INSIDE, ()):
                met.update((INSIDE, token[i : i + n]) for i in range(len(token) - n + 1))
        return met & self.known


def literals_of(rules: Sequence[PatternRule]) -> dict[str, list[set[tuple[int, str]]]]:
    """Literals of each rule's alternatives; a rule with an alternative without any is refused."""
    made = {}
    for rule in rules:
        made[rule.name] = literals(rule.pattern)
        if not all(made[rule.name]):
            raise ValueError(f"rule '{rule.name}' has an alternative without literal text")
    return made


class PatternIndex:
    """Pattern rules by the rarest literal of each of their alternatives."""

    def __init__(self, rules: Sequence[PatternRule], urls_with: dict[tuple[int, str], int]):
        self.by_literal: dict[tuple[int, str], list[int]] = defaultdict(list)
        self.rules = [(re.compile(rule.pattern, re.DOTALL), rule) for rule in rules]
        held = literals_of(rules)
        for place, rule in enumerate(rules):
            chosen = {
                min(options, key=lambda one: (urls_with.get(one, 0), one[0], -len(one[1]), one[1]))
                for options in held[rule.name]
            }
            for one in chosen:
                self.by_literal[one].append(place)
        self.literals = Literals(set(self.by_literal))

    def candidates(self, low: str) -> list[int]:
        """Places of the rules whose expression a lower-cased URL has to meet, in order."""
        return sorted({p for one in self.literals.of(low) for p in self.by_literal[one]})

    def first(self, url: str) -> PatternRule | None:
        """The earliest listed rule that matches."""
        low = url.translate(LOWER)
        for place in self.candidates(low):
            pattern, rule = self.rules[place]
            if pattern.search(low):
                return rule
        return None


def urls_with(urls: DataFrame, url: str, rules: Sequence[PatternRule]) -> dict[tuple[int, str], int]:
    """How many URLs have each literal of the rules: one row per literal is collected."""
    known = {one for held in literals_of(rules).values() for options in held for one in options}
    if not known:
        return {}
    wanted = Literals(known)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: Counter = Counter()
        for frame in frames:
            for text in frame["_url"]:
                met.update(wanted.of(whole(text).translate(LOWER)))
        rows = [(kind, text, n) for (kind, text), n in met.items()]
        yield pd.DataFrame(rows, columns=["kind", "text", "n"])

    counted = urls.select(column(url).alias("_url")).mapInPandas(
        count, "kind int, text string, n long"
    )
    summed = counted.groupBy("kind", "text").agg(F.sum("n").alias("n"))
    return {(row["kind"], row["text"]): row["n"] for row in summed.collect()}


def filter_urls(
    urls: DataFrame,
    key: str,
    url: str,
    host_rules: Sequence[HostRule],
    pattern_rules: Sequence[PatternRule] = PATTERN_RULES,
    otherwise: str = "allow",
) -> DataFrame:
    """Host, path, deciding rule and verdict of every URL.

    ``rule`` is the host rule (``net/``), ``pattern`` the pattern rule; at most
    one is set. A null URL and one without ``://`` have an empty host and path;
    the patterns judge the latter, and what no rule meets gets ``otherwise``.
    Among host rules of equal length the first by name wins. Only ``key`` and
    ``url`` are read, rows are neither merged nor shuffled. What the workers
    hold grows with the rules alone. A pattern that may match without any literal
    letter or digit raises, since no index can spare URLs its expression.
    """
    index = PatternIndex(pattern_rules, urls_with(urls, url, pattern_rules))
    hosts = HostRules(host_rules)

    def judge(text: str) -> tuple:
        host, path = host_and_path(text)
        rule = hosts.best(host, path) if host else None
        pattern = None if rule else index.first(text)
        verdict = rule or pattern
        return (
            host,
            path,
            rule.name if rule else None,
            pattern.name if pattern else None,
            verdict.verdict if verdict else otherwise,
        )

    def judged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [judge(whole(text)) for text in frame["_url"]]
            made = pd.DataFrame(rows, columns=["host", "path", "rule", "pattern", "verdict"])
            made.insert(0, key, frame[key].to_numpy())
            yield made

    picked = urls.select(column(key).alias(key), column(url).alias("_url"))
    kind = picked.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, host string, path string, rule string, pattern string, verdict string"
    )
    return picked.mapInPandas(judged, schema)
