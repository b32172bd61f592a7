"""The operators on texts against plain-Python versions, on odd rows and on empty tables."""

import math
import random
import re

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curveloom.llm import decontam, packing, pii, quality, queries, secrets, simhash, substrings, toxicity
from curveloom.llm.common import read

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(df, expected):
    assert got(df) == sorted(expected, key=repr)


# -- SimHash ------------------------------------------------------------------------------------------------

def test_simhash_equals_all_pairs(spark, texts):
    same(queries.op3_simhash(spark, SMALL), brute.near_duplicates(texts))


def test_simhash_links_random_fingerprints_in_any_number_of_parts(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(60)]
    prints += [p ^ 1 << rng.randrange(64) for p in prints[:30]] + [p ^ 3 << rng.randrange(63) for p in prints[30:]]
    prints += [0, 1, 3, 7, 15, 2 ** 64 - 1]
    signed = np.unique(np.array(prints, np.uint64)).view(np.int64)
    frame = spark.createDataFrame([(int(p),) for p in signed], "fp long")
    near = {(min(a, b), max(a, b)) for a in signed.tolist() for b in signed.tolist()
            if a != b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2}

    def classes(pairs):
        parent = {p: p for p in signed.tolist()}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[find(max(a, b))] = find(min(a, b))
        out: dict = {}
        for p in parent:
            out.setdefault(find(p), set()).add(p)
        return sorted(map(sorted, out.values()))

    for rows, blocks in ((8192, None), (1, None), (8192, 2), (8192, 6), (2, 11)):
        found = {(r["a"], r["b"]) for r in simhash.links(frame, blocks=blocks, tile_rows=rows).collect()}
        assert classes(found) == classes(near)
        assert len(found) <= 4 * len(signed)


def test_more_fingerprints_make_finer_tiles():
    chosen = [simhash.best_blocks(n, 2) for n in (0, 1, 10 ** 5, 10 ** 7, 10 ** 9, 4 * 10 ** 10)]
    assert chosen == sorted(chosen) and 4 == chosen[0] < chosen[-1] <= 16


def test_simhash_on_odd_rows(odd, nothing):
    found = simhash.near_duplicates(odd).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    same(found, brute.near_duplicates([(r["doc_id"], r["text"]) for r in odd.collect()]))
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 7]
    assert simhash.representatives(nothing).count() == 0


# -- Substrings ----------------------------------------------------------------------------------------------

def test_substrings_equal_brute_force(spark, texts):
    same(queries.op8_substrings(spark, SMALL), brute.substrings(texts))


@pytest.mark.parametrize("width", [1 << 12, 1 << 27])
def test_substrings_lose_nothing_with_a_full_sketch(spark, width):
    rng = random.Random(width)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 90)))) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = substrings.kept(frame, size=8, width=width)
    same(found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256)), brute.substrings(rows, 8))


def test_substrings_on_odd_rows(odd, nothing):
    found = substrings.kept(odd)
    assert found.columns == [*odd.columns, "n_words", "n_removed", "kept_text"]
    by_id = {r["doc_id"]: r for r in found.where("doc_id IS NOT NULL").collect()}
    assert by_id[1]["n_words"] == 0 and by_id[1]["kept_text"] == "" and by_id[1]["text"] is None
    assert by_id[4]["n_removed"] == 0 and by_id[5]["n_removed"] == by_id[5]["n_words"] == 30_001
    assert found.count() == odd.count() and substrings.kept(nothing).count() == 0


# -- Packing --------------------------------------------------------------------------------------------------

def check_packing(rows, expected):
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(expected, key=repr)
    held: dict = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    return len(held)


def test_packing_keeps_all_ids_and_is_tight(spark):
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    rows = queries.op10_packing(spark, MIDDLE).collect()
    texts = [(r["doc_id"], r["text"]) for r in read(spark, MIDDLE, "documents").collect()]
    n = check_packing(rows, brute.pieces(texts, tokenizer))
    assert n <= 1.01 * (-(-sum(r["length"] for r in rows) // 4096))


def test_packing_on_odd_rows_and_small_blocks(odd, nothing):
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    expected = brute.pieces([(r["doc_id"], r["text"]) for r in odd.collect()], tokenizer)
    for block in (4096, 3):
        check_packing(packing.packed(odd.repartition(3), queries.vocabulary(), block_items=block).collect(), expected)
    assert packing.packed(nothing, queries.vocabulary()).count() == 0


def test_runs_give_the_ids_of_whole_texts():
    tokenizer, ids = Tokenizer.from_file(queries.vocabulary()), packing.TokenIds(queries.vocabulary())
    rng = random.Random(3)
    marks = list("aAbzé'’.,,..  \n\t!#&$…«»–0129éÉñçßÜİΣσ̸́<=>≠字  \x1c\x85🙂") + ["'s", "'t", "'ll", "<|endoftext|>"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(50))) for _ in range(3000)]
    for text, found in zip(texts, ids(texts)):
        assert found.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_evolution_never_loses_items_and_improves_on_best_fit():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 70, 200)
    first = packing.Packing(lengths, 100).best_fit(list(range(200)))
    genes = packing.evolve(lengths, 100, [], 40, 6, seed=1)[0]
    fill = np.bincount(genes, weights=lengths)
    assert fill.max() <= 100 and len(fill) <= len(first.bins) and fill.sum() == lengths.sum()


# -- Spans ----------------------------------------------------------------------------------------------------

PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: luhn(re.sub("[^0-9]", "", m[0]))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15),
    "assign": (r"""(?:(?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def luhn(digits):
    odd_sum = sum(map(int, digits[-1::-2]))
    return 12 <= len(digits) <= 19 and (odd_sum + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def plain_spans(text, kinds):
    order = list(PATTERNS)
    found = [(m.start(), order.index(k), k, m.end()) for k in kinds for m in re.finditer(PATTERNS[k][0], text or "") if PATTERNS[k][1](m)]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def digest_rows(rows, kinds):
    out = []
    for doc, text in rows:
        found = plain_spans(text, kinds)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in found)
        out.append((doc, *(sum(k == x for k, _, _ in found) for x in kinds), brute.sha(joined)))
    return out


@pytest.mark.parametrize("name, kinds", [("op4_private", pii.KINDS), ("op6_secrets", secrets.BASE_KINDS)])
def test_base_spans_equal_the_patterns(spark, name, kinds):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, MIDDLE, "documents").collect()]
    found = queries.QUERIES[name](spark, MIDDLE)
    same(found.drop("spans"), digest_rows(rows, kinds))
    for r in found.select("base_sha256", "spans").collect():
        base = [s for s in r["spans"].split(",") if s.split(":")[0] in kinds]
        assert brute.sha(",".join(base)) == r["base_sha256"] or name == "op4_private"


def test_patterns_on_random_texts():
    rng = random.Random(2)
    for _ in range(20000):
        text = "".join(rng.choice("ab@@..+1234560 -()%") for _ in range(rng.randrange(1, 40)))
        assert sorted(pii.base_spans(text)) == sorted(plain_spans(text, pii.KINDS))
    words = ["token", "Secret", "api_key", "apikey", "PASSWORD", ":", "=", " ", "'", '"', "abcdef12", "AKIA", "A1B2C3D4E5F6G7H8", "0a1b2c3d4e5f" * 2, "x"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randrange(1, 12))) for _ in range(5000)]
    for text, found in zip(texts, secrets.scan_batch(texts, secrets.default_rules())):
        assert sorted(s for s in found if s[0] in secrets.BASE_KINDS) == sorted(plain_spans(text, secrets.BASE_KINDS))


def test_long_runs_stay_linear():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 100_000, "+1" + "-" * 300_000, "token" + " " * 300_000):
        pii.Tokens(text, pii.base_spans(text))
        secrets.scan_batch([text], secrets.default_rules())


def test_trigram_queries_hold_for_every_match():
    for rule in secrets.default_rules():
        grams = secrets.trigrams(rule.query)
        assert (rule.kind == "hex") == (rule.query is True) and all(len(g) == 3 for g in grams)
    assert secrets.trigram_query("abc|xbcd?") == ("or", frozenset(["abc", "xbc"])) or secrets.trigram_query("abc|xbcd?")[0] == "or"
    assert secrets.trigram_query("(foo)*bar") == "bar"
    assert secrets.trigram_query("a.b") is True


def test_repeated_tokens_share_their_label(spark):
    text = "call +1 (437) 555-0689 now. " + "word " * 200 + "again (437) 555-0689 or 1234567"
    rows = spark.createDataFrame([(1, text), (2, "555-0689 alone"), (3, None)], "doc_id long, text string")
    spans = {r["doc_id"]: [(s["kind"], text[s["start"]:s["end"]]) for s in r["spans"]] for r in pii.found(rows).collect()}
    assert spans[1] == [("phone", "+1 (437) 555-0689"), ("phone", "(437) 555-0689")]
    assert spans[2] == [] and spans[3] == []


def test_messages_are_those_of_the_full_tables():
    rng = np.random.default_rng(3)
    text = " ".join(rng.choice(["555-0689", "+1 555 0689 00", "a1b2c3", "ab@cd.ef", "ab@x", "1234567", "word"], 60).tolist())
    tokens = pii.Tokens(text, pii.base_spans(text))
    model = pii.from_counts(rng.integers(0, 50, pii.SIZE).astype(float))
    assert tokens.chain and tokens.skip
    unary = model["node"][tokens.shape].copy()
    for k in np.flatnonzero(tokens.label):
        unary[k] = [0.0 if label == tokens.label[k] else -50.0 for label in range(pii.LABELS)]
    links = [(a, b, np.exp(model[kind])) for kind, pairs in (("chain", tokens.chain), ("skip", tokens.skip)) for a, b in pairs]
    sent = {(n, way): np.zeros(pii.LABELS) for n in range(len(links)) for way in (0, 1)}
    for _ in range(pii.ROUNDS):
        held = unary.copy()
        for (n, way), message in sent.items():
            held[links[n][1 - way]] += message
        after = {}
        for n, (a, b, table) in enumerate(links):
            for way, node, square in ((0, a, table), (1, b, table.T)):
                inside = held[node] - sent[n, 1 - way]
                out = np.log(np.exp(inside - inside.max()) @ square)
                after[n, way] = out - out.max()
        done = max(np.abs(after[k] - sent[k]).max() for k in sent) < 1e-4
        sent = {k: 0.5 * sent[k] + 0.5 * after[k] for k in sent}
        if done:
            break
    for (n, way), message in sent.items():
        unary[links[n][1 - way]] += message
    want = np.exp(unary - unary.max(axis=1, keepdims=True))
    assert np.allclose(pii.beliefs(tokens, model), want / want.sum(axis=1, keepdims=True), atol=1e-9)


@pytest.mark.parametrize("repeats, both, mixed, neither, share, labelled",
                         [(40, 3000, 30, 3000, 0.49, 40), (40, 3000, 10, 20_000, 0.12, 27), (400, 3000, 30, 3000, 0.49, 17)])
def test_labels_go_as_far_as_exact_marginals(repeats, both, mixed, neither, share, labelled):
    text = "+1 437-555-0689" + " word 437-555-0689" * repeats
    base = pii.base_spans(text)
    tokens = pii.Tokens(text, base)
    assert [text[s:e] for _, s, e in base] == ["+1 437-555-0689"] and len(tokens.skip) == repeats
    counts, phone = np.zeros(pii.SIZE), pii.KINDS.index("phone") + 1
    shape = pii.NODE + tokens.shape[-1] * pii.LABELS
    counts[shape], counts[shape + phone] = 100_000 * (1 - share), 100_000 * share
    for a, b, n in ((0, 0, neither), (0, phone, mixed), (phone, phone, both)):
        counts[pii.SKIP + a * pii.LABELS + b] = n
    model = pii.from_counts(counts)
    # The skip links are a path, on which one pass forward and one backward are exact.
    unary, table = np.exp(model["node"][tokens.shape[-1]]), np.exp(model["skip"])
    ahead, behind = np.zeros((repeats + 1, pii.LABELS)), np.ones((repeats + 1, pii.LABELS))
    ahead[0, phone] = 1
    for k in range(1, repeats + 1):
        ahead[k] = ahead[k - 1] @ table * unary
        ahead[k] /= ahead[k].sum()
    for k in range(repeats - 1, -1, -1):
        behind[k] = table @ (behind[k + 1] * unary)
        behind[k] /= behind[k].sum()
    exact = ahead * behind / (ahead * behind).sum(axis=1, keepdims=True)
    assert (exact[1:, phone] >= 0.5).sum() == labelled
    assert np.allclose(pii.beliefs(tokens, model)[2:], exact[1:], atol=1e-3)
    assert [text[s:e] for _, s, e in pii.added_spans(text, base, model)] == ["437-555-0689"] * labelled


def test_spans_on_odd_rows(odd, nothing):
    for found, added in ((pii.found, ["_base", "_spans"]), (secrets.found, ["_spans"])):
        assert found(odd).columns == [*odd.columns, *added]
        assert all(r["_spans"] == [] for r in found(odd).collect())
        assert found(nothing).count() == 0


def test_redaction_joins_overlaps(spark):
    rows = spark.createDataFrame([(1, "token = abcdef0123456789abcdef0123 end"), (2, None)], "doc_id long, text string")
    found = secrets.found(rows)
    text = found.select(secrets.redacted(F.col("text"), F.col("spans")).alias("t")).collect()
    assert [r["t"] for r in text] == ["[SECRET] end", None]


def test_finding_and_replacing_at_once_equals_both_steps(docs, odd, nothing):
    for table in (docs, odd, nothing):
        rows = secrets.found(table.select("text")).withColumn("at_once", secrets.without_secrets(F.col("text")))
        for r in rows.withColumn("in_steps", secrets.redacted(F.col("text"), F.col("spans"))).collect():
            assert r["at_once"]["n"] == len(r["spans"])
            assert r["at_once"]["text"] == (r["in_steps"] if r["spans"] else None)


# -- Decontamination -------------------------------------------------------------------------------------------

def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at:at + 1] = rng.choice(["", "q", out[at] + "z"])
    return "".join(out)


def best_edits(pattern, text):
    """Fewest edits of the pattern against any part of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        after = [i]
        for j, t in enumerate(text, 1):
            after.append(min(row[j - 1] + (p != t), row[j] + 1, after[-1] + 1))
        row = after
    return min(row)


def test_leaks_equal_the_full_table():
    rng = random.Random(4)
    alphabet = "etaoin shr"
    items = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(10, 120)))) for i in range(12)]
    items = [(i, decontam.normalised(t)) for i, t in items]
    texts = []
    for _ in range(40):
        _, item = rng.choice(items)
        noise = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(2)]
        texts.append(decontam.normalised(noise[0] + edited(rng, item, rng.randrange(0, max(1, len(item) // 6))) + noise[1]))
    index = decontam.Index.build(items, 0.1, 16)
    for text, found in zip(texts, index.leaks(texts)):
        expected = {}
        for i, item in items:
            if len(item) >= 16 and best_edits(item, text) <= decontam.edit_budget(len(item), 0.1):
                expected[i] = best_edits(item, text)
        assert {i: edits for i, edits, _, _ in found} == expected
        for i, edits, start, end in found:
            assert best_edits(dict(items)[i], text[start:end]) == edits


def test_leaks_behind_empty_and_short_texts():
    rng = random.Random(6)
    for size in (300, 390):
        item = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size))
        index = decontam.Index.build([(1, item)], 0.1, 16)
        for cut in range(0, decontam.edit_budget(size, 0.1) + 1, 3):
            text = item[cut:] + " behind it"
            alone = index.leaks([text])[0]
            assert [r[:3] for r in alone] == [(1, cut, 0)]
            for before in ([""], ["", ""], ["", "", ""], ["a"], ["ab", "c", ""], [""] * 9):
                for shift in range(0, 40, 3):
                    assert index.leaks(["x" * shift, *before, text]) == [[]] * (len(before) + 1) + [alone]


def test_leaks_in_blocks_and_long_texts(spark, docs):
    bench = read(spark, SMALL, "benchmark")
    whole = got(decontam.leaks(docs, bench))
    assert whole and whole == got(decontam.leaks(docs, bench, block_chars=500))
    assert whole == got(decontam.leaks(docs, bench.unionByName(bench).unionByName(bench)))
    assert sum(len(i.items) for i in decontam.indexes(bench.unionByName(bench))) == sum(len(i.items) for i in decontam.indexes(bench))
    items = {r["item_id"]: decontam.normalised(r["text"]) for r in bench.collect()}
    held = {r["doc_id"]: decontam.normalised(r["text"] or "") for r in docs.collect()}
    exact = {(d, i) for d, t in held.items() for i, p in items.items() if len(p) >= 16 and p in t}
    assert exact <= {(d, i) for d, i, *_ in whole}
    item = max(items.values(), key=len)
    far = "filler " * 400_000 + item
    index = decontam.Index.build([(9, item)], 0.1, 16)
    assert index.leaks([far])[0] == [(9, 0, 2_800_000, 2_800_000 + len(item))]
    assert decontam.Index.build([(1, "x" * 60 + item * 20)], 0.1, 16).leaks([item * 20])[0]


def test_leaks_on_odd_rows(spark, odd, nothing):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (None, "w0 w1 w2 w3 w4 w5 w6 w7 w8")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.leaks(odd, bench).collect()} == {(4, -1), (5, -1)}
    assert decontam.clean(odd, bench).columns == odd.columns and decontam.clean(odd, bench).count() == 8
    assert decontam.leaks(nothing, bench).count() == 0 and decontam.leaks(odd, bench.limit(0)).count() == 0


# -- Classifiers ----------------------------------------------------------------------------------------------

def test_quality_agrees_with_labels(spark):
    labels = read(spark, MIDDLE, "labels").select("doc_id", "quality")
    found = queries.op1_quality(spark, MIDDLE)
    assert found.count() == 1000
    rows = found.join(labels, "doc_id").select("rejected", "quality").collect()
    assert sum(r["rejected"] == (r["quality"] == 0) for r in rows) >= 0.97 * len(rows)
    assert not any(r["rejected"] for r in rows if r["quality"] == 1)


def test_accuracies_find_the_better_labeller():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.8
    n = len(quality.LABELLERS)
    rate = np.array([0.95] * (n - 1) + [0.6])
    right = rng.random((4000, n)) < rate
    given = np.where(right, truth[:, None], ~truth[:, None]).astype(int)
    patterns, counts = np.unique((given * 3 ** np.arange(n)).sum(axis=1), return_counts=True)
    model = quality.estimate(patterns, counts.astype(float))
    hit = np.exp(model.log_votes[1, :, quality.GOOD])
    assert hit[:-1].min() > 0.9 and hit[-1] < 0.75


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.op2_toxicity(spark, folder)
    rows = found.join(read(spark, folder, "labels").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    hits, wrong = (sum(r["predicted"] for r in rows if r["toxic"] == kind) for kind in (1, 0))
    # Some of this table's toxic documents hold none of the words that make others toxic.
    toxic = sum(r["toxic"] for r in rows)
    assert hits >= 0.85 * toxic and wrong <= 0.005 * (len(rows) - toxic)


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({t: (6.0, 1e-7) for t in ("idiot$", "loser$", "trash$", "lowei")})
    terms = lambda text: [m[2] for m in lexicon.matches(toxicity.folded(text))]
    assert terms("You 1d10t, IDIOT! ídiot іdiot idiots") == ["idiot$"] * 4
    assert terms("10ser l0ser trash can trash loweichen flowei") == ["loser$", "loser$", "trash$", "lowei"]
    short, long = lexicon.score("idiot"), lexicon.score("idiot " + "word " * 5000)
    assert 0 < lexicon.score("") < long < short < 1
    assert terms("trash can trash " * 50_000) == ["trash$"] * 50_000


def test_terms_of_long_texts_count_in_full(spark):
    lexicon = toxicity.Lexicon({"idiot$": (6.0, 0.002)})
    toxic, clean = ("idiot " + "words " * 49) * 1000, ("idiot " + "words " * 499) * 100
    total, most = lexicon.evidence(toxic)
    assert total > math.log1p(1000) and most == 6.0 and lexicon.score(toxic) > 0.99
    assert lexicon.evidence(clean) == (0.0, 0.0)
    assert toxicity.terms_of(toxic)["idiot$"] == 1000
    # Learned: long clean documents use the term once in 500 words, long toxic ones once in 50.
    rows = [(i, (toxic if i % 4 == 0 else clean) + f"n{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    learned = toxicity.learned(docs, labels)
    held = [rate for _, rate in learned.terms.values()]
    assert held and all(abs(rate - 0.002) < 2e-4 for t, (_, rate) in learned.terms.items() if t.startswith("idio"))
    assert learned.score(toxic) > learned.score(clean)


def test_classifiers_on_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(3, 1, 1), (4, 1, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    for table in (labels, labels.limit(0)):
        lexicon = toxicity.learned(odd, table)
        found = toxicity.scored(odd, lexicon)
        assert found.columns == [*odd.columns, "_score", "predicted"] and found.where("_score BETWEEN 0 AND 1").count() == odd.count()
        assert toxicity.scored(nothing, lexicon).count() == 0
    found = quality.scored(odd)
    assert found.columns == [*odd.columns, "posterior", "_score", "rejected"] and found.where("_score BETWEEN 0 AND 1").count() == odd.count()
    assert quality.scored(nothing).count() == 0


# -- Findings on folding, rules and samples ------------------------------------------------------------------

@pytest.mark.parametrize("text", ["you idio7 there", "an 1d10t", "a55 hole", "a$$ hole", "you i\u200bdi\u00adot", "idiot", "IDIOT5"])
def test_substitutions_anywhere_in_a_word_are_folded(text):
    lexicon = toxicity.Lexicon({"idiot$": toxicity.SEED_TERM, "ass$": toxicity.SEED_TERM})
    assert lexicon.score(text) > 0.9


@pytest.mark.parametrize("text", ["the trash-can", "the trash  can", "the trash\ncan", "the trash can", "the tra\u200bsh \u2013 can", "room4 and 4 cats"])
def test_exception_phrases_hold_over_blanks_and_hyphens(text):
    lexicon = toxicity.Lexicon({"trash$": toxicity.SEED_TERM})
    assert lexicon.score(text) < 0.1 < 0.9 < lexicon.score("my trash")


@pytest.mark.parametrize("pattern, flags, text", [
    ("to ken [0-9]+", re.VERBOSE | re.ASCII, "token123"), ("secret=", re.IGNORECASE, "\u017fecret="), ("(?x) to ken [0-9]+", 0, "token123"),
    ("(?i)kelvin", 0, "\u212aelvin"), ("ΟΔΟΣ", 0, "ΟΔΟΣ Α"), ("Secret=", re.ASCII | re.IGNORECASE, "SECRET="), ("AKIA[A-Z]+", re.ASCII, "xAKIAB")])
def test_queries_of_rules_lose_no_match(pattern, flags, text):
    rule = secrets.Rule("own", pattern, flags=flags)
    assert rule.spans(text) and secrets.scan_batch(["nothing", text], [rule]) == [[], rule.spans(text)]


def test_a_tiny_share_still_samples(spark):
    from curveloom.llm.common import in_share

    hashes = [0, 1, 10 ** 9, 9 * 10 ** 9, 10 ** 10, 2 ** 63 - 1, -1, -2 ** 63, -2 ** 63 + 10 ** 9]
    frame = spark.createDataFrame([(h,) for h in hashes], "h long")
    assert sorted(r["h"] for r in frame.where(in_share(F.col("h"), 1e-9)).collect()) == sorted([0, 1, 10 ** 9, 9 * 10 ** 9, -2 ** 63, -2 ** 63 + 10 ** 9])
    assert frame.where(in_share(F.col("h"), 1.0)).count() == len(hashes)


def test_shapes_are_those_of_whole_words():
    assert pii._shape("1" * 300) != pii._shape("1" * 300 + "-22")


def test_items_with_a_common_opening_take_bounded_memory(monkeypatch):
    """Hits are counted in runs, with the counts of all of them at once; and no item is found but the one that is there."""
    rng = random.Random(8)
    opening = "which of the following statements is correct "
    items = [(i, opening + " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(8))) for i in range(300)]
    index = decontam.Index.build(items, 0.1, 16)
    text = decontam.normalised((opening + "x y z ") * 5 + items[7][1] + " " + opening)
    whole, placed = index.leaks([text, opening]), index.bands(decontam._codes(text))
    monkeypatch.setattr(decontam, "HITS_AT_ONCE", 1000)
    monkeypatch.setattr(decontam, "BANDS_AT_ONCE", 50)
    assert index.leaks([text, opening]) == whole and [r[0] for r in whole[0]] == [7] and not whole[1]
    for one, two in zip(index.bands(decontam._codes(text)), placed):
        assert one.tolist() == two.tolist()


# -- Decontamination, block by block ------------------------------------------------------------------------------

@pytest.mark.parametrize("block_chars", [1 << 20, 250])
def test_leaks_equal_all_items_against_all_texts(spark, block_chars):
    """Items with a common opening, repeated and edited, and short ones; every item is aligned with every text by the full table."""
    rng = random.Random(9)
    opening = "which of the following is true about "
    letters = "abcdefghijklmnop "
    bench = [(i, opening + "".join(rng.choices(letters, k=rng.randrange(20, 60)))) for i in range(8)]
    bench += [(20, "Kettle"), (21, "a-b"), (22, "eleven chars"), (23, "k"), (24, ""), (25, None), (20, "Kettle")]
    texts = []
    for n in range(30):
        _, item = bench[rng.randrange(8)]
        before = opening * rng.randrange(3) + "".join(rng.choices(letters, k=rng.randrange(40)))
        texts.append((n, before + edited(rng, item, rng.randrange(0, 12)) + " " + "".join(rng.choices(letters, k=20))))
    texts += [(40, "The kettle, eleven chars"), (41, "A B"), (42, None), (43, ""), (44, opening * 6)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    for shortest in (16, 3):
        expected = set()
        for n, text in texts:
            for i, item in bench:
                plain = decontam.normalised(item or "")
                edits = best_edits(plain, decontam.normalised(text or ""))
                if len(plain) >= shortest and edits <= decontam.edit_budget(len(plain), 0.1):
                    expected.add((n, i, edits))
        found = decontam.leaks(docs, items, shortest=shortest, block_chars=block_chars).collect()
        assert {(r["doc_id"], r["item_id"], r["edits"]) for r in found} == expected and len(found) == len(expected)
        left = decontam.clean(docs, items, shortest=shortest, block_chars=block_chars)
        assert sorted(r["doc_id"] for r in left.collect()) == sorted({n for n, _ in texts} - {n for n, _, _ in expected})
    assert {(40, 20), (41, 21), (40, 22)} <= {(n, i) for n, i, _ in expected}


def test_a_common_opening_is_told_from_an_item_by_its_short_grams():
    rng = random.Random(8)
    opening = "which of the following statements is correct "
    items = [(i, opening + " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(8))) for i in range(500)]
    index = decontam.Index.build(items, 0.1, 16)
    codes = decontam._codes(decontam.normalised(opening * 20 + items[7][1]))
    passage, band = index.bands(codes)
    near = index.close(codes, passage, band)
    assert len(passage) > 5000 and set(passage[near].tolist()) == {7}


# -- Weak labels ---------------------------------------------------------------------------------------------------

def test_runs_of_words_are_counted_without_keeping_them():
    rng = random.Random(10)
    for n in (0, 1, 4, 5, 6, 300):
        for kinds in (b"a", b"abc", b"abcdefghijklmnop"):
            words = [bytes([rng.choice(kinds)]) * rng.randrange(1, 4) for _ in range(n)]
            assert quality._kinds(words) == (len(set(words)), len(set(zip(*(words[k:] for k in range(5))))))


def test_estimated_posteriors_equal_the_fold_over_documents():
    """Expectation-maximisation over counts of patterns against the same over single documents, vote by vote."""
    rng = random.Random(11)
    n = len(quality.LABELLERS)
    rows = []
    for _ in range(400):
        good = rng.random() < 0.7
        rows.append([2 if rng.random() < 0.2 else int(good) if rng.random() < 0.85 else 1 - int(good) for _ in range(n)])
    numbers = [sum(v * 3 ** k for k, v in enumerate(row)) for row in rows]
    patterns, counts = np.unique(numbers, return_counts=True)
    once = quality.estimate(patterns, counts.astype(float))
    single = quality.estimate(np.array(numbers), np.ones(len(numbers)))
    assert np.allclose(once.log_votes, single.log_votes) and np.allclose(once.log_prior, single.log_prior)
    for row, number in zip(rows[:50], numbers):
        by_hand = [once.log_prior[c] + sum(once.log_votes[c, k, v] for k, v in enumerate(row)) for c in (0, 1)]
        share = 1 / (1 + math.exp(by_hand[0] - by_hand[1]))
        assert abs(float(once.posterior(np.array([number]))[0]) - share) < 1e-9
