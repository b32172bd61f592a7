"""SQL that the quality rules must equal: words and windows as rows, and a chain of tables for the rounds of estimation."""

from curveloom.llm.rules import BAD, GOOD, NONE, RULES, SYMBOLS

_BLANK = r"\x20\x09-\x0D"


def _vote(rule: str) -> str:
    formula, good, bad, least = RULES[rule]
    return (f"CASE WHEN n_words < {least} THEN {NONE} WHEN {formula} <= {good} THEN {GOOD} WHEN {formula} >= {bad} THEN {BAD} "
            f"ELSE {NONE} END AS {rule}")


def _rounds(rounds: int) -> str:
    """``p<i>``: each pattern's documents and how many of them count as good; ``m<i>``: the rates estimated from ``p<i>``."""
    steps = [f"p0 AS MATERIALIZED (SELECT pattern, n, n * CASE WHEN list_contains(pattern, {BAD}) THEN 0.1e0 ELSE 0.9e0 END AS good FROM patterns)"]
    for i in range(rounds + 1):
        steps.append(f"""m{i} AS MATERIALIZED (SELECT rule,
  (sum(CASE WHEN vote = {BAD} THEN p.n - good ELSE 0 END) + 1) / (sum(CASE WHEN vote <> {NONE} THEN p.n - good ELSE 0 END) + 2) AS on_bad,
  (sum(CASE WHEN vote = {BAD} THEN good ELSE 0 END) + 1) / (sum(CASE WHEN vote <> {NONE} THEN good ELSE 0 END) + 2) AS on_good,
  (sum(good) + 1) / (sum(p.n) + 2) AS prior FROM votes JOIN p{i} p USING (pattern) GROUP BY rule)""")
        steps.append(f"""p{i + 1} AS MATERIALIZED (SELECT pattern, n, n / (1 + exp(-(any_value(ln(prior / (1 - prior))) + sum(
  CASE vote WHEN {BAD} THEN ln(on_good / on_bad) WHEN {GOOD} THEN ln((1 - on_good) / (1 - on_bad)) ELSE 0 END)))) AS good
  FROM votes JOIN m{i} USING (rule) GROUP BY pattern, n)""")
    return ",\n".join(steps)


def sql(rounds: int = 30, digits: int = 6) -> str:
    return f"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
words AS MATERIALIZED (SELECT id, w, place FROM (
  SELECT id, unnest(list) AS w, generate_subscripts(list, 1) AS place FROM (
    SELECT id, regexp_extract_all(text, '[^{_BLANK}]+') AS list FROM texts))),
windows AS (SELECT id, place, count(*) OVER (PARTITION BY id, w, w1, w2, w3, w4) AS times FROM (
  SELECT id, place, w, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lead(w, 4) OVER o AS w4
  FROM words WINDOW o AS (PARTITION BY id ORDER BY place)) WHERE w4 IS NOT NULL),
repeats AS (SELECT id, count(DISTINCT covered) AS n FROM (
  SELECT id, unnest(generate_series(place, place + 4)) AS covered FROM windows WHERE times > 1) GROUP BY id),
counted AS (SELECT id, count(*) AS n_words, sum(length(w)) AS word_chars, sum(length(regexp_replace(w, '[^{SYMBOLS}]', '', 'g'))) AS n_symbols,
  count(*) FILTER (regexp_matches(w, '[{SYMBOLS}]')) AS n_symbol_words, count(DISTINCT w) FILTER (place <= 200) AS n_different,
  sum(length(regexp_replace(w, '[^A-Z]', '', 'g'))) AS n_capitals, sum(length(regexp_replace(w, '[^!]', '', 'g'))) AS n_exclaims,
  sum(length(regexp_replace(w, '[^.!?。]', '', 'g'))) AS n_stops FROM words GROUP BY id),
lines AS (SELECT id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
  SELECT id, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^{_BLANK}]') GROUP BY id),
measures AS MATERIALIZED (SELECT doc_id, id, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in (
    "n_words", "word_chars", "n_symbols", "n_symbol_words", "n_different", "n_capitals", "n_exclaims", "n_stops", "n_lines", "n_dup_lines"))},
  coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
  FROM texts LEFT JOIN counted USING (id) LEFT JOIN lines USING (id) LEFT JOIN repeats USING (id)),
voted AS MATERIALIZED (SELECT *, [{", ".join(RULES)}] AS pattern FROM (SELECT *, {", ".join(map(_vote, RULES))} FROM measures)),
patterns AS MATERIALIZED (SELECT pattern, count(*) AS n FROM voted GROUP BY pattern),
votes AS MATERIALIZED (SELECT pattern, n, unnest(pattern) AS vote, generate_subscripts(pattern, 1) AS rule FROM patterns),
{_rounds(rounds)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND good / n >= 0.5 AS kept, round(good / n, {digits}) AS posterior
FROM voted JOIN p{rounds + 1} USING (pattern)
"""
