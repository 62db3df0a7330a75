"""Phrase mining against counting by hand."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lapwise.llm import phrases

SCHEMA = "doc_id long, text string, lang string, score long, phrase string, n long, shard int"


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", lowered)]


def counts_by_hand(rows, longest):
    out = defaultdict(Counter)
    for text, lang in rows:
        for words in pieces(text):
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    out[lang or "und"][tuple(words[i : i + size])] += 1
    return out


def by_hand(rows, longest=4, least=30, best=2000):
    out = []
    for lang, f in counts_by_hand(rows, longest).items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        candidates = [g for g, c in f.items() if len(g) > 1 and c >= least]
        outer = Counter()
        for g in candidates:
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    outer[g[i : i + size]] = max(outer[g[i : i + size]], f[g])
        scored = []
        for g in candidates:
            if 100 * outer[g] >= 80 * f[g]:
                continue
            score, k = min((2000000 * f[g] // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-score, -f[g], " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(i, t, g, 1, "p", 2, 3) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in phrases.collocations(df, **how).collect())


def made_up(seed, count, lang):
    draw = random.Random(seed)
    words = [f"{'ÀÉ'[i % 2]}w{i}" if i % 5 == 0 else f"W{i}" for i in range(40)]
    ends = [" ", " ", " ", " ", "  ", "\t", " \t ", ", ", ".", "\n", "\r\n", "\x0b", "\x0c", "! "]
    rows = []
    for _ in range(count):
        text = ""
        for _ in range(draw.randint(0, 60)):
            text += draw.choice(["fixed Phrase here now", "fixed phrase here", *words[: 1 + int(40 * draw.random() ** 3)]]) + draw.choice(ends)
        rows.append((text, lang))
    return rows


@pytest.mark.parametrize("how", [{"least": 30, "shards": 3}, {"least": 5, "shards": 2, "best": 40}])
def test_against_counting_by_hand(spark, how):
    rows = made_up(1, 150, "en") + made_up(2, 60, "de") + made_up(3, 40, None) + made_up(4, 10, "und")
    rows += [(None, "en"), ("", "de"), ("   ", "fr"), (None, None), ("...", "es"), ("one two three four " * 700, "fr"), ("copy of it", "en")]
    rows += [("a hot line, a hot passage of words", "en")] * 200
    hand = {k: v for k, v in how.items() if k != "shards"}
    found = mined(spark, rows, **how)
    assert found == by_hand(rows, **hand) and len(found) > 20


def test_a_phrase_that_is_frequent_only_over_all_shards(spark):
    rows = [("new york city hall", "en")] * 30 + [("other words here", "en")] * 29 + [("new york", "en")] * 10
    assert [r[2] for r in mined(spark, rows, shards=3)] == ["new york", "new york city hall"]


def test_scores_pass_64_bits(spark):
    # whole numbers of any size: 2000000 a does not fit 64 bits from about 4.6e12 on
    row = spark.createDataFrame([(1 << 62, 1 << 62, (1 << 62) + 5)], "a long, l long, r long")
    exact = row.selectExpr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").first()[0]
    assert exact == 2000000 * (1 << 62) // ((1 << 63) + 5)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(df).count() == 0
    assert mined(spark, [(None, None), ("", "en"), ("!?", "en")]) == []


def test_filters_miss_nothing():
    draw = np.random.default_rng(1)
    hashes = draw.integers(0, 1 << 63, 50000).astype(np.uint64)
    made = phrases.Filter(2)
    block = phrases._block(hashes, 2)
    for number in (0, 1):
        made.put(number, phrases.block_bytes(hashes[block == number]))
    assert made.has(hashes).all() and made.has(draw.integers(0, 1 << 63, 50000).astype(np.uint64)).mean() < 0.02


def test_long_texts_are_cut_between_pieces():
    text = b"one two, three\nfour five six seven eight nine ten. eleven"
    cut, langs = phrases.cut_long([b"x", text, b"y"], ["a", "b", "c"], most=12)
    assert b"".join(cut) == b"x" + text + b"y" and langs == ["a"] + ["b"] * (len(cut) - 2) + ["c"]
    assert [c for c in cut if len(c) > 12] == [b"four five six seven eight nine ten."]
