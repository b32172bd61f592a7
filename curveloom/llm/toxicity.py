"""Toxicity of texts from a weighted lexicon, matched by Aho-Corasick after folding look-alikes and digits.

A term's weight is how much more often toxic documents use it than clean ones, both learned from labels. Matches inside
exception phrases don't count. A term's matches are held against those that a clean text of the same length has, and a
logistic curve turns what is beyond that, and the largest weight, into a probability.
"""

import bisect
import itertools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import documents, fresh, in_share, prepare, whole_text, written

# Look-alikes of Latin letters, and what digits and marks in words stand for.
LOOKALIKES = dict(zip("абвгдеёзијкмнорстухцьѕіїһԁԛԝαβγεικνορτυχωı", "a6braee3ujkmhopctyxubsiihdqwabyeikvoptuxwi"))
DIGITS = dict(zip("013457@$!", "oieastasi"))
# What is used for terms that the labelled documents don't show: common insults, and phrases in which words are harmless.
SEEDS = ("idiot", "moron", "stupid", "scum", "pathetic", "worthless", "disgusting", "loser")
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "clownfish", "disgusting smell")
SEED_TERM = (6.0, 1e-7)
PREFIXES = range(4, 9)
#: Characters a word, with the blank behind it.
WORD_CHARS = 6

_FOLD = {ord(k): v for k, v in LOOKALIKES.items()}
for _code in range(0xC0, 0x250):
    _plain = unicodedata.normalize("NFD", chr(_code))[0]
    if _plain.isascii() and _plain.isalpha():
        _FOLD[_code] = _plain.lower()
_STANDS = re.compile(r"[013457](?=[013457]{0,2}[a-z])|[@$!]{1,2}(?=[a-z])")
# Substitutions at a word's end, where they may also be numbers or marks.
_ENDING = re.compile(r"(?<![a-z013457@$!])[a-z][a-z013457@$!]*[013457@$]{1,3}(?![\w@$])")
# Characters that show nothing, and what may stand between the words of a phrase other than one blank.
_HIDDEN = re.compile("[\u00ad\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe00-\ufe0f\ufeff]")
_BETWEEN = re.compile(r"[\s\-\u2010-\u2015]{2,}|[^\S ]|[\-\u2010-\u2015]")
_WORD = re.compile(r"[^\W\d_]+")


def folded(text: str) -> str:
    """Lower case; look-alikes and accented letters as Latin ones, and digits and marks among letters as letters.

    Characters that show nothing are left out, and whatever is between two words of blanks and hyphens is one blank. Words that
    end in digits or marks come again at the end with letters for them, since there both readings are usual.
    """
    out = text.lower()
    if not out.isascii():
        out = _HIDDEN.sub("", out)
        if not unicodedata.is_normalized("NFKC", out):
            out = unicodedata.normalize("NFKC", out).lower()
        out = out.translate(_FOLD)
    out = _BETWEEN.sub(" ", out)
    again = ["".join(DIGITS.get(c, c) for c in word) for word in _ENDING.findall(out)]
    out = _STANDS.sub(lambda m: "".join(DIGITS[c] for c in m[0]), out)
    return f"{out} {' '.join(again)}" if again else out


def terms_of(text: str) -> Counter:
    """Words (``word$``) and beginnings of words of a folded text, and how often each occurs."""
    out: Counter = Counter()
    for word, n in Counter(_WORD.findall(text)).items():
        out[word + "$"] += n
        for size in PREFIXES:
            if size <= len(word):
                out[word[:size]] += n
    return out


def word_count(text: str) -> float:
    """About as many words as the text has."""
    return len(text) / WORD_CHARS + 1


def surplus(n: int, rate: float, text: str) -> float:
    """How far ``n`` matches are beyond a clean text's ``rate`` a word: the Poisson deviance, 0 if they are not."""
    expected = rate * word_count(text)
    return n * math.log(n / expected) - (n - expected) if n > expected else 0.0


@dataclass
class Lexicon:
    """Terms with weight and rate in clean texts, exception phrases, and the curve from evidence to probability."""

    terms: dict[str, tuple[float, float]]
    exceptions: Sequence[str] = EXCEPTIONS
    curve: tuple[float, float, float] = (-3.0, 1.0, 1.0)
    automaton: object = field(default=None, repr=False)

    def _build(self):
        automaton = ahocorasick.Automaton()
        entries: dict[str, list] = {}
        for term, (weight, _) in self.terms.items():
            plain = term.rstrip("$")
            entries.setdefault(plain, []).append((len(plain), weight, term.endswith("$"), term))
            if "l" in plain:  # 1 also stands for l
                entries.setdefault(plain.replace("l", "i"), []).append((len(plain), weight, term.endswith("$"), term))
        for phrase in self.exceptions:
            entries.setdefault(folded(phrase), []).append((len(folded(phrase)), None, False, phrase))
        for key, values in entries.items():
            automaton.add_word(key, values)
        automaton.make_automaton()
        self.automaton = automaton

    def __getstate__(self):
        return {**self.__dict__, "automaton": None}

    def matches(self, text: str) -> list[tuple[int, int, str, float]]:
        """``(start, end, term, weight)`` in the folded text, outside exception phrases."""
        if self.automaton is None:
            self._build()
        found, safe, n = [], [], len(text)
        for last, values in self.automaton.iter(text) if len(self.automaton) else ():
            for size, weight, whole, term in values:
                start = last + 1 - size
                if (start and text[start - 1].isalpha()) or (whole and last + 1 < n and text[last + 1].isalpha()):
                    continue
                (safe if weight is None else found).append((start, last + 1, term, weight))
        safe.sort()
        starts, reach = [s[0] for s in safe], list(itertools.accumulate((s[1] for s in safe), max, initial=-1))
        # The furthest end of the phrases that start no later tells if one of them holds the match.
        return [f for f in found if reach[bisect.bisect_right(starts, f[0])] < f[1]]

    def evidence(self, text: str) -> tuple[float, float]:
        """The logarithm of all terms' surplus, and the largest weight of a term that has one."""
        counts = Counter(term for _, _, term, _ in self.matches(text))
        found = [(surplus(n, self.terms[t][1], text), self.terms[t][0]) for t, n in counts.items()]
        return math.log1p(sum(s for s, _ in found)), max((w for s, w in found if s > 0), default=0.0)

    def score(self, text: str) -> float:
        a, b, c = self.curve
        total, most = self.evidence(folded(text))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * total + c * most))))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from. A missing id is neither held out nor learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learned(docs: DataFrame, labels: DataFrame, sample: int = 20_000, exceptions: Sequence[str] = EXCEPTIONS) -> Lexicon:
    """A lexicon from about ``sample`` labelled documents that are not held out, picked by a hash of their id.

    Terms are words and beginnings of words. Equal texts count once. Terms must be far more frequent in toxic documents, and
    are taken in turn for the toxic documents that no earlier term explains, so the rare words of a toxic text's many
    near copies get no weight.
    """
    prepare(docs.sparkSession)
    rows = labels.selectExpr("cast(doc_id AS long) AS doc_id", "cast(toxic AS int) AS toxic").where("toxic IN (0, 1)")
    rows = rows.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = rows.count()
    share = min(1.0, sample / max(total, 1))
    picked = written(rows.where(in_share(F.xxhash64("doc_id"), share)), "picked")
    # Not more than the sample, so this side can be sent to all tasks.
    texts = documents(docs).join(F.broadcast(picked), "doc_id").select("toxic", "text")
    taken = written(texts.groupBy(F.xxhash64("text").alias("key")).agg(
        F.max("toxic").alias("toxic"), F.any_value("text").alias("text")).select("toxic", "text"), "labelled")

    def count_terms(kind: int, wanted=None) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                held, used, words = Counter(), Counter(), Counter()
                for text in batch["text"]:
                    terms = terms_of(folded(text))
                    if wanted is not None:
                        terms = {t: n for t, n in terms.items() if t in wanted.value}
                    held.update(terms.keys())
                    used.update(terms)
                    words.update(dict.fromkeys(terms, word_count(text)))
                yield pd.DataFrame({"term": list(held), "docs": list(held.values()), "used": [used[t] for t in held],
                                    "words": [words[t] for t in held]})

        found = taken.where(F.col("toxic") == kind).mapInPandas(run, "term string, docs long, used long, words double")
        return found.groupBy("term").agg(*(F.sum(c).alias(c) for c in ("docs", "used", "words")))

    size = {r["toxic"]: (r["n"], r["words"]) for r in taken.groupBy("toxic").agg(
        F.count("*").alias("n"), F.sum(F.length("text") / WORD_CHARS + 1).alias("words")).collect()}
    if len(size) < 2:
        return Lexicon({f"{s}$": SEED_TERM for s in SEEDS}, exceptions)
    least = max(3, size[1][0] // 150)
    # Each term is in at least that share of the sample's toxic documents, so their number is bounded by its words.
    often = {r["term"]: r for r in count_terms(1).where(F.col("docs") >= least).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(set(often))
    rates = {r["term"]: r for r in count_terms(0, shared).collect()}
    terms = {}
    for term, toxic in often.items():
        clean = rates.get(term)
        # Half an occurrence stands for a term that the sample's clean documents don't have. Rates are those of documents that
        # have the term at all, since a word of one language says nothing of texts in others.
        everywhere = max(clean["used"] if clean else 0, 0.5) / size[0][1]
        base = clean["used"] / clean["words"] if clean else everywhere
        weight = math.log(toxic["used"] / toxic["words"] / base)
        if toxic["used"] / size[1][1] >= 5 * everywhere and weight >= 1:
            terms[term] = (min(weight, 8.0), base)
    wanted = docs.sparkSession.sparkContext.broadcast(terms)

    def explained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for toxic, text in zip(batch["toxic"], batch["text"]):
                found = {t: n for t, n in terms_of(folded(text)).items() if t in wanted.value}
                rows.append((toxic, [t for t, n in found.items() if surplus(n, wanted.value[t][1], text) >= 2]))
            yield pd.DataFrame(rows, columns=["toxic", "terms"])

    held = taken.mapInPandas(explained, "toxic int, terms array<string>").where("size(terms) > 0").collect()
    chosen = _in_turn([set(r["terms"]) for r in held if r["toxic"]], [r["terms"] for r in held if not r["toxic"]], least)
    seeds = {f"{s}$": SEED_TERM for s in SEEDS if f"{s}$" not in rates}
    lexicon = Lexicon(seeds | {t: terms[t] for t in chosen}, exceptions)
    shared_lexicon = docs.sparkSession.sparkContext.broadcast(lexicon)

    def evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(y, *shared_lexicon.value.evidence(folded(t))) for y, t in zip(batch["toxic"], batch["text"])],
                               columns=["toxic", "total", "most"])

    points = taken.mapInPandas(evidence, "toxic int, total double, most double").toPandas()
    lexicon.curve = _curve(points["total"].to_numpy(), points["most"].to_numpy(), points["toxic"].to_numpy(float))
    return lexicon


def _in_turn(toxic: list[set[str]], clean: list[list[str]], least: int) -> list[str]:
    """Terms that explain the most toxic documents that are left, until none explains a quarter of ``least``."""
    cost = Counter(t for terms in clean for t in terms)
    left, chosen = toxic, []
    while left:
        gain = Counter(t for terms in left for t in terms)
        # Of terms that explain as many, a beginning is taken before the words that begin so.
        term, best = max(((t, n - 2 * cost[t]) for t, n in gain.items()), key=lambda x: (x[1], -len(x[0]), x[0]), default=("", 0))
        if best < max(2, least // 4):
            return chosen
        chosen.append(term)
        left = [terms for terms in left if term not in terms]
    return chosen


def _curve(total: np.ndarray, most: np.ndarray, toxic: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps on evidence and largest weight."""
    x = np.stack([np.ones_like(total), total, most], axis=1)
    beta = np.zeros(3)
    penalty = ridge * np.diag([0.0, 1.0, 1.0]) * max(len(x), 1) ** 0.5
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty + 1e-6 * np.eye(3), x.T @ (toxic - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def score_of(text: Column, lexicon: Lexicon, spark) -> Column:
    shared = spark.sparkContext.broadcast(lexicon)

    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return F.pandas_udf(score, "double")(whole_text(text))


def scored(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7, text_column: str = "text") -> DataFrame:
    """Every row with ``score`` (0 to 1) and ``predicted`` (1 if the score reaches the threshold, else 0).

    Missing and empty texts get the score of no evidence. Added columns get underscores in front if the input has
    columns of their names; repeated rows get equal results.
    """
    score, predicted = fresh(docs, "score", "predicted")
    marked = docs.withColumn(score, score_of(F.col(text_column), lexicon, docs.sparkSession))
    return marked.withColumn(predicted, (F.col(score) >= threshold).cast("int"))
