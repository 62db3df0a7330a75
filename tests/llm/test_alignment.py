"""Alignment of two tokenizers against a walk over single tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from __spark_entry__ import queries
from lapwise.llm import alignment
from lapwise.llm.queries import PIECES, vocabulary_path
from lapwise.llm.tokens import Encoder, byte_letters, parts

SCHEMA = "doc_id long, text string, block long, pairs string, n long, id string"


@pytest.fixture(scope="module")
def pair():
    import sentencepiece

    a = Tokenizer.from_file(vocabulary_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(PIECES))


def by_hand(rows, pair):
    a, b = pair
    letters = byte_letters()
    kept, counts = [], Counter()
    for doc, text in rows:
        linked, groups, n = [], "", (0, 0, 0)
        if text:
            whole = (" " + text).encode()
            a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            a_parts = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
            b_parts = [alignment.piece_bytes(b.id_to_piece(i)) for i in b_ids]
            if b"".join(a_parts) == whole == b"".join(b_parts):
                spans = []
                for ids, some in ((a_ids, a_parts), (b_ids, b_parts)):
                    at, out = 0, []
                    for i, part in zip(ids, some):
                        out.append((i, at, at + len(part)))
                        at += len(part)
                    spans.append(out)
                linked = [(x[0], y[0]) for x in spans[0] for y in spans[1] if max(x[1], y[1]) < min(x[2], y[2])] if len(whole) < 200 else sweep(*spans)
                cuts = sorted({x[2] for x in spans[0]} & {y[2] for y in spans[1]})
                shown, begin = [], 0
                for end in cuts:
                    shown.append("|".join(",".join(str(i) for i, s, e in some if begin <= s and e <= end) for some in spans))
                    begin = end
                groups, n = ";".join(shown), (len(a_ids), len(b_ids), len(cuts))
        counts.update(linked)
        kept.append((doc, n, linked, hashlib.sha256(groups.encode()).hexdigest() if n[0] else ""))
    best = defaultdict(int)
    for (_, y), c in counts.items():
        best[y] = max(best[y], c)
    return sorted(((doc, *n, len(linked), sum(counts[p] == best[p[1]] for p in linked), sum(counts[p] for p in linked), sha)
                   for doc, n, linked, sha in kept), key=str)


def sweep(one, two):
    out, i, j = [], 0, 0
    while i < len(one) and j < len(two):
        out.append((one[i][0], two[j][0]))
        end = min(one[i][2], two[j][2])
        i, j = i + (one[i][2] == end), j + (two[j][2] == end)
    return out


def aligned(spark, rows, count=3):
    df = spark.createDataFrame([(d, t, 1, "p", 2, "x") for d, t in rows], SCHEMA).repartition(count)
    return sorted((tuple(r) for r in alignment.align_tokenizers(df, vocabulary_path(), vocabulary_path(PIECES)).collect()), key=str)


def test_against_single_tokens(spark, pair, monkeypatch):
    draw = random.Random(7)
    bits = ["the", "tokenizer", " ", " ", " ", "  ", "\n", "\t", "é", "naïve", "😀", "日本語", "1234", "\xa0", ".", ",", "▁", "<s>", "<0x0A>",
            "<|endoftext|>", "\x00", "'s", "don't", "\r\n", "ſ", "x" * 30, "ation", "Ġ"]
    rows = [(i, "".join(draw.choice(bits) for _ in range(draw.randint(0, 25)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, " lead"), (1004, "trail "), (None, "no id"), (None, None)]
    rows += [(2000, "the same words again"), (2000, "the same words again"), (2001, "the same words again")]
    rows += [(3000, "long words here naïve " * 3000), (3001, "odd\tlong  text " * 800)]
    rows += [(4000 + i, "hot copy of a passage") for i in range(300)]
    assert aligned(spark, rows) == by_hand(rows, pair)


def test_documents(spark, real, pair):
    rows = [tuple(r) for r in real.select("doc_id", "text").collect()]
    found = alignment.align_tokenizers(real, vocabulary_path(), vocabulary_path(PIECES))
    assert sorted((tuple(r) for r in found.collect()), key=str) == by_hand(rows, pair)
    assert sorted((tuple(r) for r in queries()["op11_alignment"](spark, "/root/testdata/sf0.001").collect()), key=str) == by_hand(rows, pair)


def test_pointers_end_at_the_last_token_of_a_component():
    draw = np.random.default_rng(2)
    for _ in range(200):
        a, b = (np.r_[np.unique(draw.integers(1, 40, draw.integers(0, 30))), 40] for _ in range(2))
        last = alignment.terminals(alignment.successors(a, b))
        both = np.intersect1d(a, b)
        for ends, labels in ((a, last[: len(a)]), (b, last[len(a) :])):
            assert [a[label] for label in labels] == [both[np.searchsorted(both, end)] for end in ends]


def test_empty_tables(spark):
    assert aligned(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]
    assert alignment.align_tokenizers(spark.createDataFrame([], SCHEMA), vocabulary_path(), vocabulary_path(PIECES)).count() == 0


def test_many_blocks_and_forgotten_chunks(real, pair, monkeypatch):
    rows = [tuple(r) for r in real.select("doc_id", "text").collect()]
    one = alignment.Aligner(vocabulary_path(), vocabulary_path(PIECES))
    monkeypatch.setattr(one._numbers, "_most", 50)
    told = {(d, *n, links, sha) for d, *n, links, _, _, sha in by_hand(rows, pair)}
    for place in range(0, len(rows), 7):
        ids, texts = zip(*rows[place : place + 7])
        counts, hashes, *_ = one.block(list(texts))
        assert {(d, *c, h) for d, c, h in zip(ids, counts.tolist(), hashes)} <= told


def test_long_texts_are_encoded_in_parts():
    text = "word next  odd \n end one two three " * 9
    cut = list(parts(text, most=40))
    one = Encoder(vocabulary_path())
    assert "".join(cut) == text and len(cut) > 5
    assert b"".join(one.ids(p).astype("<u4").tobytes() for p in cut) == one.ids(text).astype("<u4").tobytes()
