"""Quality rules as weak supervision: each rule votes good, bad or nothing, and a probability replaces all-must-pass.

Nobody says which rules are right. Expectation-maximisation (Dawid and Skene 1979) estimates how often each votes bad on good
and on bad documents, from the counts of vote patterns over all documents, and a document's verdict is the posterior of its
pattern. A rule is believed as far as others that overlap it agree, so each way to be bad has two or more rules. All of it is DataFrame functions: the counts, at most three to the number of rules, are one row, over which a fold
runs the rounds.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import fresh, whole_text

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
#: Words among which different ones are counted: longer texts have ever fewer new ones, so ``RULES`` judge runs of one length.
RUN = 200
GOOD, BAD, NONE = 1, 0, 2
#: Rule: the measure it looks at (larger is worse), up to where it votes good, from where it votes bad. A document of fewer than
#: the last number of words gets no vote of the rule.
RULES = {
    "too_short": ("-n_words", -40, -12, 0),
    "short_words": ("-word_chars / n_words", -3.5, -2.5, 1),
    "long_words": ("word_chars / n_words", 9, 13, 1),
    "symbols": ("n_symbols / n_words", 0.03, 0.12, 1),
    "symbol_characters": ("n_symbols / word_chars", 0.01, 0.03, 1),
    "symbol_words": ("n_symbol_words / n_words", 0.03, 0.12, 5),
    "repeated_lines": ("n_dup_lines / n_lines", 0.1, 0.35, 20),
    "repeated_runs": ("n_repeat_words / n_words", 0.08, 0.2, 20),
    "shouting": ("n_capitals / word_chars", 0.15, 0.4, 5),
    "exclaiming": ("n_exclaims / n_words", 0.05, 0.25, 10),
    "few_different": (f"-n_different / least(n_words, {RUN})", -0.4, -0.2, 40),
    "no_sentences": ("n_words / (n_stops + 1)", 40, 120, 20),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_symbol_words", "n_capitals",
            "n_exclaims", "n_stops", "n_different")
SYMBOLS = "#*$%&|<>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated_words(words: Column) -> Column:
    """Words in windows that are found twice or more.

    Windows are compared by hash first. Where two are equal the windows themselves are sorted with their places, so
    equal ones are neighbours, and the sorted places of the repeated ones tell how many words they cover.
    """
    starts = F.sequence(F.lit(1), F.size(words) - WINDOW + 1)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k - 1) for k in range(WINDOW)]))
    windows = F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("i")))

    def places(ordered: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            return F.coalesce(F.get(ordered, i - 1)["w"] == x["w"], F.lit(False)) | F.coalesce(
                F.get(ordered, i + 1)["w"] == x["w"], F.lit(False))
        return F.sort_array(F.transform(F.filter(ordered, again), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda x, i: F.coalesce(F.least(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    exact = _let(F.sort_array(windows), lambda s: _let(places(s), covered))
    different = _let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when((F.size(words) < WINDOW + 1) | different, 0).otherwise(exact)


def _different_words(words: Column) -> Column:
    """Different words in ``RUN`` running ones: the mean of runs that cover all words, rounded down.

    Runs follow each other; the last one ends at the last word, so it may overlap the one before. A shorter text is one run.
    """
    runs = F.greatest(F.ceil(F.size(words) / RUN).cast("int"), F.lit(1))
    last = F.greatest(F.size(words) - RUN + 1, F.lit(1))
    starts = F.transform(F.sequence(F.lit(0), runs - 1), lambda k: F.least(k * RUN + 1, last))
    different = F.transform(starts, lambda i: F.size(F.array_distinct(F.slice(words, i, RUN))))
    return F.floor(F.aggregate(different, F.lit(0), lambda a, x: a + x) / runs)


def measured(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Every row with ``MEASURES`` (longs) and ``pattern``, its votes as one number in base three.

    Measures are those of the whole text; a missing text counts as an empty one, which has zeros and only the vote for being
    too short. Added columns get underscores in front if the input has columns of their names.
    """
    text, words, marks, lines, bag = fresh(docs, "_text", "_words", "_marks", "_lines", "_measures")
    parts = docs.withColumn(text, whole_text(F.col(text_column))).withColumns({
        words: F.array_remove(F.split(text, SPACE), ""),
        # What the counts of single characters look at, so that one pass over the text serves them all.
        marks: F.regexp_replace(text, rf"[^{SYMBOLS}!.?。A-Z\x20\x09-\x0D]+", ""),
        lines: F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    })

    def marked(kinds: str) -> Column:
        return F.length(F.regexp_replace(marks, f"[^{kinds}]+", ""))

    word = F.col(words)
    found = {
        "n_words": F.size(word), "word_chars": F.length(F.array_join(word, "")), "n_symbols": marked(SYMBOLS),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)), "n_repeat_words": _repeated_words(word),
        "n_lines": F.size(lines), "n_capitals": marked("A-Z"),
        "n_symbol_words": F.length(F.regexp_replace(marks, rf"[^{SYMBOLS}\x20\x09-\x0D]*([{SYMBOLS}])[^\x20\x09-\x0D]*|[^{SYMBOLS}]+", "$1")),
        "n_exclaims": marked("!"), "n_stops": marked(".!?。"),
        "n_different": _different_words(word),
    }
    # Read from the column ``bag``: names of the input's own may equal those of the measures.
    bagged = parts.withColumn(bag, F.struct(*[found[m].cast("long").alias(m) for m in MEASURES]))
    names = fresh(docs, *MEASURES, "pattern")
    votes = F.lit(0)
    for k, rule in enumerate(RULES):
        votes = votes + _vote(rule, F.col(bag)) * 3 ** k
    return bagged.select(*docs.columns, *[F.col(f"{bag}.{m}").alias(n) for m, n in zip(MEASURES, names)], votes.alias(names[-1]))


def _vote(rule: str, measures: Column) -> Column:
    formula, good, bad, least = RULES[rule]
    sides = [part.strip() for part in formula.split(" / ", 1)]

    def term(part: str) -> Column:
        if part.startswith("-"):
            return -term(part[1:])
        if part.startswith("least("):
            name, most = part[6:-1].split(", ")
            return F.least(measures[name], F.lit(int(most)).cast("long"))
        if part.startswith("("):
            name, more = part[1:-1].split(" + ")
            return measures[name] + int(more)
        return measures[part]

    value = term(sides[0]).cast("double")
    if len(sides) == 2:
        value = F.try_divide(value, term(sides[1]).cast("double"))
    vote = F.when(value <= float(good), GOOD).when(value >= float(bad), BAD).otherwise(NONE)
    return F.when(measures["n_words"] < least, NONE).otherwise(vote)


def _log_odds(votes: Column, model: Column) -> Column:
    """Logarithm of the odds of good for one pattern's votes."""
    terms = F.transform(F.arrays_zip(votes.alias("v"), model["on_bad"].alias("b"), model["on_good"].alias("g")), lambda r: F.when(
        r["v"] == BAD, F.log(r["g"] / r["b"])).when(r["v"] == GOOD, F.log((1 - r["g"]) / (1 - r["b"]))).otherwise(0.0))
    return F.aggregate(terms, F.log(model["good"] / (1 - model["good"])), lambda a, x: a + x)


def _round(patterns: Column, model: Column) -> Column:
    """One round of expectation-maximisation over ``patterns``, an array of structs of ``votes`` and ``n``."""
    weighed = F.transform(patterns, lambda p: F.struct(
        p["votes"].alias("votes"), p["n"].alias("n"), (p["n"] / (1 + F.exp(-_log_odds(p["votes"], model)))).alias("good")))
    return _let(weighed, _estimated)


def _estimated(weighed: Column) -> Column:
    """Rates of votes for bad in both classes and the share of good ones, each with one document more on both sides."""
    def total(of: Callable[[Column], Column]) -> Column:
        return F.aggregate(weighed, F.lit(0.0), lambda a, p: a + of(p))

    def rate(k: Column, weight: Callable[[Column], Column]) -> Column:
        says_bad = total(lambda p: F.when(F.get(p["votes"], k) == BAD, weight(p)).otherwise(0.0))
        says = total(lambda p: F.when(F.get(p["votes"], k) != NONE, weight(p)).otherwise(0.0))
        return (says_bad + 1) / (says + 2)

    rules = F.sequence(F.lit(0), F.lit(len(RULES) - 1))
    return F.struct(
        F.transform(rules, lambda k: rate(k, lambda p: p["n"] - p["good"])).alias("on_bad"),
        F.transform(rules, lambda k: rate(k, lambda p: p["good"])).alias("on_good"),
        ((total(lambda p: p["good"]) + 1) / (total(lambda p: p["n"]) + 2)).alias("good"),
    )


def posteriors(found: DataFrame, rounds: int = 30, pattern_column: str = "pattern") -> DataFrame:
    """``pattern, posterior``: the probability that documents with these votes are good, fitted on all rows of ``measured``.

    At first every document with a vote for bad counts as nine tenths bad, since each rule knows one way to be bad, and
    every other one as nine tenths good.
    """
    counts = found.groupBy(F.col(pattern_column).alias("pattern")).agg(F.count("*").alias("n"))
    votes = F.array(*[F.pmod(F.floor(F.col("pattern") / 3 ** k), F.lit(3)).cast("int") for k in range(len(RULES))])
    pattern = F.struct("pattern", votes.alias("votes"), F.col("n").cast("double").alias("n"))
    # One row of at most 3 ^ rules patterns, in one order whichever task counted them.
    gathered = counts.agg(F.sort_array(F.collect_list(pattern)).alias("patterns"))
    said_bad = F.transform(F.col("patterns"), lambda p: F.struct(p["votes"].alias("votes"), p["n"].alias("n"), (
        p["n"] * F.when(F.array_contains(p["votes"], BAD), 0.1).otherwise(0.9)).alias("good")))
    first = _let(said_bad, _estimated)
    model = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, lambda m, _: _round(F.col("patterns"), m))
    fitted = gathered.withColumn("model", model)
    given = F.transform(F.col("patterns"), lambda p: F.struct(
        p["pattern"].alias("pattern"), (1 / (1 + F.exp(-_log_odds(p["votes"], F.col("model"))))).alias("posterior")))
    return fitted.select(F.inline(given))


def judged(found: DataFrame, given: DataFrame, threshold: float = 0.5, pattern_column: str = "pattern") -> DataFrame:
    """The rows of ``measured`` with ``base_failed``, ``posterior`` and ``kept``.

    Kept are rows whose posterior is ``threshold`` or more, unless they fail the base rules: too few words, or over a fifth of
    them in repeated windows. Equal votes get equal results, so repeated rows do; an empty table gives an empty one.
    """
    key = fresh(found, "_pattern")[0]
    joined = found.join(given.select(F.col("pattern").alias(key), F.col("posterior").alias(f"{key}_p")), F.col(pattern_column) == F.col(key))
    named = dict(zip(MEASURES, _added(found, pattern_column)))
    words, repeated = F.col(named["n_words"]), F.col(named["n_repeat_words"])
    failed = (words < 10) | (100 * repeated > 20 * words)
    names = fresh(found, "base_failed", "posterior", "kept")
    results = [failed, F.col(f"{key}_p"), ~failed & (F.col(f"{key}_p") >= threshold)]
    return joined.select(*found.columns, *[r.alias(n) for r, n in zip(results, names)])


def _added(found: DataFrame, pattern_column: str) -> list[str]:
    """Names of the measures, which stand right before the pattern."""
    at = found.columns.index(pattern_column)
    return found.columns[at - len(MEASURES):at]


def filtered(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows that are kept, in their own columns."""
    found = measured(docs, text_column)
    pattern = found.columns[-1]
    verdicts = judged(found, posteriors(found, pattern_column=pattern), pattern_column=pattern)
    return verdicts.where(F.col(verdicts.columns[-1])).select(*docs.columns)
