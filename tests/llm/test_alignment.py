"""Alignment of two tokenizers against token-by-token Python."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from curveloom.llm import alignment, queries
from curveloom.llm.common import prepare
from curveloom.llm.queries import vocabulary

SMALL = "/root/testdata/sf0.001"
A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def byte_letters():
    """The alphabet of byte-level vocabularies, letter to byte."""
    own = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    letters, n = {chr(b): b for b in own}, 0
    for b in range(256):
        if b not in own:
            letters[chr(256 + n)] = b
            n += 1
    return letters


def brute(rows):
    """``{row: (n_a, n_b, n_groups, n_links, hash, n_best, count_sum)}`` by walking both token lists of whole texts."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = byte_letters()
    found = []
    for text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            found.append([])
            continue
        groups, i, j, at_a, at_b, one, two = [], 0, 0, 0, 0, [], []
        while i < len(ids_a) or j < len(ids_b):
            if at_a <= at_b and i < len(ids_a):
                one.append(ids_a[i])
                at_a += len(bytes_a[i])
                i += 1
            else:
                two.append(ids_b[j])
                at_b += len(bytes_b[j])
                j += 1
            if at_a == at_b:
                groups.append((one, two))
                one, two = [], []
        found.append(groups)
    counts = Counter(p for groups in found for p in {(x, y) for one, two in groups for x in one for y in two})
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for groups in found:
        links = [(x, y) for one, two in groups for x in one for y in two]
        said = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, two)) for one, two in groups)
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                    hashlib.sha256(said.encode()).hexdigest() if groups else "", sum(counts[p] == best[p[0]] for p in links),
                    sum(counts[p] for p in links)))
    return out


def tuples(df):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def expected(rows):
    return sorted(((d, *r) for (d, _), r in zip(rows, brute([t for _, t in rows]))), key=repr)


def test_alignment_equals_a_walk_over_tokens(spark, texts):
    assert tuples(queries.op12_alignment(spark, SMALL)) == expected(texts)


ODD = [None, "", " ", "  ", "a", " a", "a  b ", "a\n\nb\tc", "▁", "x ▁y z", "<|endoftext|> a <s> b </s>", "日本語のテキスト", "naïve café", "é é",
       "\U0001f600 \U0001f469‍\U0001f469", "\x00 a", "a b c　d", "don't we'll I'm", "=" * 300, "ab" * 5000, "the the the the",
       "ﬁ Å ½", "= = =", "a" + " " * 50 + "b", "<0x41> b", "ß" * 40, "x" * 20_000 + " y", "the the the the"]


@pytest.mark.parametrize("size", [1, 64, 1 << 20])
def test_alignment_of_odd_texts_in_blocks_of_any_size(spark, size):
    prepare(spark)
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD)]
    frame = spark.createDataFrame([(d, t, 1, "mine", "mine") for d, t in rows], "doc_id long, text string, n_a int, block string, codes string")
    assert tuples(alignment.aligned(frame, A, B, size)) == expected(rows)


def test_large_groups_are_expanded_in_parts(monkeypatch):
    known = alignment.Vocabularies(A, B)
    import pyarrow as pa

    whole = alignment._block(0, pa.array(range(len(ODD))), ODD, known)
    monkeypatch.setattr(alignment, "EXPANDED", 3)
    assert alignment._block(0, pa.array(range(len(ODD))), ODD, known).equals(whole)


def test_alignment_of_nothing(spark, odd, nothing):
    assert alignment.aligned(nothing, A, B).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert tuples(alignment.aligned(odd, A, B)) == expected(rows)
