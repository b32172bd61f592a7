"""Quality rules against SQL, against plain Python, and on odd rows."""

import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from curveloom.llm import queries, rules
from curveloom.llm.common import read

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """The contract's measures by plain counting."""
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    places: dict = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def estimate(patterns, rounds=30):
    """Posteriors of documents by expectation-maximisation over the documents themselves."""
    votes = np.array([[p // 3 ** k % 3 for k in range(len(rules.RULES))] for p in patterns])
    good = np.where((votes == rules.BAD).any(axis=1), 0.1, 0.9)
    for _ in range(rounds + 1):
        bad_votes, given = votes == rules.BAD, votes != rules.NONE
        on_bad, on_good = [((bad_votes * w[:, None]).sum(0) + 1) / ((given * w[:, None]).sum(0) + 2) for w in (1 - good, good)]
        share = (good.sum() + 1) / (len(good) + 2)
        odds = np.log(share / (1 - share)) + np.where(bad_votes, np.log(on_good / on_bad), np.where(
            given, np.log((1 - on_good) / (1 - on_bad)), 0)).sum(axis=1)
        good = 1 / (1 + np.exp(-odds))
    return good


def plain(row):
    return tuple(round(v, 5) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_rules_equal_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    cursor = con.execute(queries.SQL["op11_rules"])
    found = queries.op11_rules(spark, folder)
    assert [c[0] for c in cursor.description] == found.columns
    assert sorted(map(plain, cursor.fetchall())) == sorted(plain(r) for r in found.collect())


def test_rules_equal_plain_python(spark, texts):
    found = rules.measured(read(spark, SMALL, "documents").select("doc_id", "text"))
    rows = {r["doc_id"]: r for r in rules.judged(found, rules.posteriors(found)).collect()}
    ids = [d for d, _ in texts]
    expected = dict(zip(ids, estimate([rows[d]["pattern"] for d in ids])))
    for d, text in texts:
        r, measures = rows[d], base(text)
        assert tuple(r[m] for m in rules.MEASURES[:5]) == measures
        assert r["base_failed"] == (measures[0] < 10 or 100 * measures[4] > 20 * measures[0])
        assert abs(r["posterior"] - expected[d]) < 1e-9 and r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)


def test_rules_run_no_python(spark):
    found = rules.measured(read(spark, SMALL, "documents"))
    for df in (found, rules.judged(found, rules.posteriors(found))):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("text", [
    "a b c d e " * 2, "a b c d e x a b c d e", "a " * 30, "a b c d e f g h " * 3, "x y z", "a b c d e f a b c d e g a b c d e",
    "l\nl\n\n \nl ", "　a b \x0b\x0c\r\t c", "a#b ** <c> | d", "\U0001f600\U0001f600 é"])
def test_measures_of_single_texts(spark, text):
    found = rules.measured(spark.createDataFrame([(text,)], "text string")).first()
    assert tuple(found[m] for m in rules.MEASURES[:5]) == base(text)


def different(text):
    """Mean of different words in runs of 200 that cover all words."""
    words = WORD.findall(text or "")
    starts = [*range(0, max(1, len(words) - 199), 200)]
    if len(words) > 200 and len(words) % 200:
        starts.append(len(words) - 200)
    return sum(len(set(words[i:i + 200])) for i in starts) // len(starts)


def test_different_words_of_whole_texts(spark):
    """Texts that are alike in their first 200 words differ by what follows."""
    draw = np.random.default_rng(11)
    fresh_words = [f"w{i}" for i in range(1200)]
    few = [f"a{i}" for i in draw.integers(0, 20, 2000)]
    expected = {" ".join(fresh_words): rules.GOOD, " ".join(fresh_words[:200] + few): rules.BAD, " ".join(few): rules.BAD,
                " ".join(few[:200] + fresh_words[:1000]): rules.GOOD, " ".join(few[:1000] + fresh_words[:200]): rules.NONE}
    texts = [*expected, None, "", "a", *[" ".join(few[:n]) for n in (40, 199, 200, 201, 399, 400, 401, 999)],
             " ".join(fresh_words[:200] + ["b"] * 100_001)]
    place = list(rules.RULES).index("few_different")
    rows = {r["text"]: r for r in rules.measured(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert {t: rows[t]["n_different"] for t in texts} == {t: different(t) for t in texts}
    for text, vote in expected.items():
        assert rows[text]["pattern"] // 3 ** place % 3 == vote
        assert 100 * rows[text]["n_repeat_words"] <= 20 * rows[text]["n_words"]


def test_rules_find_labelled_junk(spark):
    """Nothing of the labels is an input, so all of them are held out."""
    folder = "/root/testdata/sf0.1"
    found = queries.op11_rules(spark, folder).join(read(spark, folder, "labels"), "doc_id")
    n = {(r["quality"], r["kept"]): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    assert n[0, False] >= 0.95 * (n[0, False] + n[0, True])
    judged = found.where("NOT base_failed AND quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert judged >= 0.99


def test_rules_on_odd_rows(odd, nothing):
    clashing = odd.withColumn("n_words", F.lit("mine")).withColumn("kept", F.lit("mine")).withColumn("pattern", F.lit("mine"))
    found = rules.measured(clashing)
    assert found.columns[:len(clashing.columns)] == clashing.columns and found.columns[-1] == "_pattern"
    verdicts = rules.judged(found, rules.posteriors(found, pattern_column="_pattern"), pattern_column="_pattern")
    assert verdicts.columns[-3:] == ["base_failed", "posterior", "_kept"] and verdicts.count() == clashing.count()
    for r in verdicts.collect():
        assert tuple(r[m] for m in ("_n_words", *rules.MEASURES[1:5])) == base(r["text"]) and r["n_words"] == "mine"
        assert r["base_failed"] == (r["_n_words"] < 10) and r["posterior"] is not None
    assert rules.filtered(clashing).columns == clashing.columns
    empty = rules.measured(nothing)
    assert rules.judged(empty, rules.posteriors(empty)).count() == 0 and rules.filtered(nothing).count() == 0
