"""Secrets in texts by regular expressions behind an inverted index of trigrams.

Each rule's expression gives a Boolean query over trigrams that any match must contain (after Cox 2012). The index is
split by documents: a batch has postings for the trigrams that the rules ask for, the queries intersect and unite
them, and only the documents left are searched. Rules without mandatory trigrams search every document.
"""

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import fresh, whole_text
from curveloom.llm.spans import SPANS, in_order, union

ANY = True
LIMIT = 64


# -- Boolean trigram queries -------------------------------------------------------------------------------

def _and(*queries):
    """True, a trigram, or ``(and|or, frozenset of queries)``."""
    parts = set()
    for q in queries:
        if q is not ANY:
            parts |= q[1] if isinstance(q, tuple) and q[0] == "and" else {q}
    return ANY if not parts else next(iter(parts)) if len(parts) == 1 else ("and", frozenset(parts))


def _or(queries):
    parts = set()
    for q in queries:
        if q is ANY:
            return ANY
        parts |= q[1] if isinstance(q, tuple) and q[0] == "or" else {q}
    return next(iter(parts)) if len(parts) == 1 else ("or", frozenset(parts))


def _of_strings(strings: Iterable[str]):
    return _or(_and(*(s[i:i + 3] for i in range(len(s) - 2))) if len(s) > 2 else ANY for s in strings)


@dataclass
class _Part:
    """What a part of an expression says of its matches: all of them, or how they begin and end, and a query."""

    exact: frozenset | None = None
    prefix: frozenset = frozenset([""])
    suffix: frozenset = frozenset([""])
    query: object = ANY

    def opened(self) -> "_Part":
        if self.exact is None:
            return self
        return _Part(None, frozenset(s[:2] for s in self.exact), frozenset(s[-2:] for s in self.exact), _of_strings(self.exact))

    def then(self, other: "_Part") -> "_Part":
        if self.exact is not None and other.exact is not None and len(self.exact) * len(other.exact) <= LIMIT:
            return _Part(frozenset(a + b for a, b in product(self.exact, other.exact)))
        a, b = self.opened(), other.opened()
        middle = {x + y for x, y in product(a.suffix, b.prefix)} if len(a.suffix) * len(b.prefix) <= LIMIT else {""}
        # Two characters of a known start or end are enough; a shorter whole part goes on into its neighbour.
        prefix = frozenset((x + y)[:2] for x, y in product(self.exact, b.prefix)) if self.exact is not None else a.prefix
        suffix = frozenset((x + y)[-2:] for x, y in product(a.suffix, other.exact)) if other.exact is not None else b.suffix
        return _Part(None, prefix, suffix, _and(a.query, b.query, _of_strings(middle)))


def _parts(tokens) -> _Part:
    out = _Part(frozenset([""]))
    for name, value in tokens:
        out = out.then(_part(str(name), value))
    return out


def _part(name: str, value) -> _Part:
    if name == "LITERAL":
        return _Part(frozenset([chr(value).lower()]))
    if name == "IN":
        chars = {chr(v).lower() for n, v in value if str(n) == "LITERAL"}
        small = all(str(n) == "LITERAL" for n, _ in value) and len(chars) <= 8
        return _Part(frozenset(chars)) if small else _Part()
    if name == "SUBPATTERN":
        return _parts(value[-1])
    if name == "BRANCH":
        branches = [_parts(b) for b in value[1]]
        if all(b.exact is not None for b in branches) and sum(len(b.exact) for b in branches) <= LIMIT:
            return _Part(frozenset().union(*(b.exact for b in branches)))
        branches = [b.opened() for b in branches]
        return _Part(None, frozenset().union(*(b.prefix for b in branches)), frozenset().union(*(b.suffix for b in branches)),
                     _or(b.query for b in branches))
    if name.endswith("REPEAT"):
        low, high, inner = value
        inside = _parts(inner)
        if (low, high) == (0, 1) and inside.exact is not None:
            return _Part(inside.exact | {""})
        return inside if (low, high) == (1, 1) else inside.opened() if low else _Part()
    if name in ("AT", "ASSERT", "ASSERT_NOT"):
        return _Part(frozenset([""]))
    return _Part()


def trigram_query(pattern: str, flags: int = re.ASCII):
    """The query of lower-case trigrams that holds for every text with a match; ``ANY`` if there is none.

    Expressions that ignore case beyond ASCII match letters that lower case keeps apart, and lower case of other letters
    depends on those around them, so only ASCII trigrams of expressions that stay within ASCII are asked for.
    """
    from re import _parser  # the standard library's own parser of expressions

    flags = re.compile(pattern, flags).flags  # with those that the pattern itself sets
    if flags & re.IGNORECASE and not flags & re.ASCII:
        return ANY
    # The pattern sets its own flags once more; a parser that is given both kinds of alphabet refuses.
    query = _parts(_parser.parse(pattern, flags & ~re.UNICODE)).opened().query
    return query if all(map(str.isascii, trigrams(query))) else ANY


def trigrams(query) -> set[str]:
    if query is ANY:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def matching(query, postings: dict[str, np.ndarray], n: int) -> np.ndarray:
    """Numbers of the documents that a query leaves."""
    if query is ANY:
        return np.arange(n)
    if isinstance(query, str):
        return postings[query]
    found = sorted((matching(q, postings, n) for q in query[1]), key=len)
    out = found[0]
    for more in found[1:]:
        out = np.intersect1d(out, more, assume_unique=True) if query[0] == "and" else np.union1d(out, more)
    return out


# -- Rules ---------------------------------------------------------------------------------------------------

@dataclass
class Rule:
    """A kind of secret. ``keep`` sees each leftmost match; ``scan`` may say that a text without mandatory trigrams has none."""

    kind: str
    pattern: str
    keep: Callable[[re.Match], bool] = lambda match: True
    flags: int = re.ASCII
    scan: Callable[[str], bool] | None = None
    query: object = field(init=False)

    def __post_init__(self):
        self.query = trigram_query(self.pattern, self.flags)
        self.expression = re.compile(self.pattern, self.flags)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        return [(self.kind, m.start(), m.end()) for m in self.expression.finditer(text) if self.keep(m)]


_HEX_RUN = 24
_HEX = bytes(ord("h") if chr(c) in "0123456789abcdef" else ord(".") for c in range(256))


def _long_hex(text: str) -> bool:
    return b"h" * _HEX_RUN in text.encode("utf-8", "surrogatepass").translate(_HEX)


def default_rules() -> list[Rule]:
    # The three base kinds, then the formats of well-known kinds of keys.
    return [
        Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
             lambda m: m.end(2) - m.start(2) >= 6, re.ASCII | re.IGNORECASE),
        Rule("access", r"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 20),
        # A run of digits starts where none is before it, so only runs that are long enough need be looked at.
        Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", scan=_long_hex),
        Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
        Rule("repository_token", r"gh[opsu]_[A-Za-z0-9]{36,}"),
        Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
        Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ]


BASE_KINDS = ("assign", "access", "hex")


def scan_batch(texts: list[str], rules: list[Rule]) -> list[list[tuple[str, int, int]]]:
    lower = [t.lower() for t in texts]
    postings = {g: np.array([k for k, t in enumerate(lower) if g in t], np.int64)
                for g in sorted(set().union(*(trigrams(r.query) for r in rules)))}
    found: list[list] = [[] for _ in texts]
    for rule in rules:
        for k in matching(rule.query, postings, len(texts)).tolist():
            if rule.scan is None or rule.scan(texts[k]):
                found[k] += rule.spans(texts[k])
    return found


def secrets_in(text: Column, rules: list[Rule] | None = None) -> Column:
    """Array of ``kind, start, end`` by start, then kind in the order of the rules."""
    chosen = rules or default_rules()
    kinds = [r.kind for r in chosen]
    names = [(r.kind, r.pattern, r.keep, r.flags, r.scan) for r in chosen]

    def scan(texts: pd.Series) -> pd.Series:
        own = [Rule(*n) for n in names]
        return pd.Series([in_order(spans, kinds) for spans in scan_batch(texts.tolist(), own)])

    return F.pandas_udf(scan, SPANS)(whole_text(text))


def found(docs: DataFrame, rules: list[Rule] | None = None, text_column: str = "text") -> DataFrame:
    """Every row with ``spans``. Missing and empty texts have none; repeated rows get repeated results.

    The column is called ``_spans`` if the input has one of that name, and so on.
    """
    return docs.withColumn(fresh(docs, "spans")[0], secrets_in(F.col(text_column), rules))


def _replaced(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    kept, at = [], 0
    for start, end in union(spans):
        kept += [text[at:start], mark]
        at = end
    return "".join([*kept, text[at:]])


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each secret, or overlapping secrets, replaced by a mark; a missing text stays missing."""

    def replace(texts: pd.Series, every: pd.Series) -> pd.Series:
        return pd.Series([value if value is None or found_here is None else
                          _replaced(value, [(s["start"], s["end"]) for s in found_here], mark)
                          for value, found_here in zip(texts, every)], dtype=object)

    return F.pandas_udf(replace, "string")(text, spans)


def without_secrets(text: Column, rules: list[Rule] | None = None, mark: str = "[SECRET]") -> Column:
    """Struct of ``n``, how many secrets there are, and ``text``, which has marks in their place; missing where there are none.

    Finding and replacing are one function, so a task has one Python worker and sends it each text once.
    """
    names = [(r.kind, r.pattern, r.keep, r.flags, r.scan) for r in rules or default_rules()]

    def clean(texts: pd.Series) -> pd.DataFrame:
        own = [Rule(*n) for n in names]
        values = texts.tolist()
        every = scan_batch(values, own)
        return pd.DataFrame({"n": np.array([len(spans) for spans in every], np.int32), "text": pd.Series(
            [_replaced(t, [(a, b) for _, a, b in spans], mark) if spans else None for t, spans in zip(values, every)], dtype=object)})

    return F.pandas_udf(clean, "n int, text string")(whole_text(text))
