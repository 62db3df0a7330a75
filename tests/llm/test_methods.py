"""The methods against brute force on small inputs, and the registered queries on the smallest tables."""

import collections
import hashlib
import re

import numpy as np
import pytest
from words import passage
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from lapwise.llm import neardup, pii
from lapwise.llm.fmindex import FMIndex, suffix_order
from lapwise.llm.hilbert import hilbert_keys
from lapwise.llm.neardup import Sampler, components, middle, near_duplicates, shared_weights, weighted_jaccard
from lapwise.llm.neighbours import nearest
from lapwise.llm.packing import cuts, first_fit
from lapwise.llm.queries import vocabulary_path
from lapwise.llm.repeats import first_occurrences, next_smaller, previous_factors, previous_smaller, remove_repeats, string_order
from lapwise.llm.sharding import place_by_dot_product
from lapwise.llm.tokens import Encoder
from lapwise.llm.urls import Automaton


@pytest.fixture(scope="module")
def texts(real):
    return {r[0]: r[1] for r in real.select("doc_id", "text").collect()}


def test_fm_index_finds_what_a_scan_finds():
    draw = np.random.default_rng(3)
    symbols = draw.integers(0, 5, 3000)
    symbols[0] = symbols[-1] = 0
    assert suffix_order(np.array([0, 2, 1, 2, 1, 0, 1])).tolist() == [0, 5, 6, 4, 2, 3, 1]
    index = FMIndex(symbols, 4)
    phrases = np.array([[1, 2, 3], [4, 4, 0], [1, 0, 0], [2, 2, 2]])
    lengths = np.array([3, 2, 1, 3])
    low, high = index.search(phrases, lengths)
    for phrase, size, a, b in zip(phrases, lengths, low, high):
        found = sorted(index.locate(np.arange(a, b)).tolist())
        assert found == [i for i in range(len(symbols) - size + 1) if (symbols[i : i + size] == phrase[:size]).all()]


def test_hilbert_curve_goes_from_cell_to_cell():
    cells = np.array([(i, j, k) for i in range(8) for j in range(8) for k in range(8)])
    keys = hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512)) and np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_samples_agree_as_often_as_the_weighted_similarity():
    draw = np.random.default_rng(5)
    hashes = np.sort(draw.integers(0, 1 << 63, 300).astype(np.uint64))
    weights = draw.uniform(1, 3, 300)
    mine, other = np.arange(260), np.arange(40, 300)
    sampler = Sampler(2000)
    one = sampler.draw(np.zeros(260, np.int64), hashes[mine], weights[mine])
    two = sampler.draw(np.zeros(260, np.int64), hashes[other], weights[other])
    true = weighted_jaccard((hashes[mine], weights[mine]), (hashes[other], weights[other]))
    assert abs((one == two).mean() - true) < 0.04


def test_components(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y"), ("d", "c"), ("e", "d")], "a string, b string")
    assert {tuple(r) for r in components(edges).collect()} == {*[(n, "a") for n in "abcde"], ("x", "x"), ("y", "x")}


def test_near_copies_that_do_not_link_to_the_centre_find_each_other(spark):
    """A centre with many copies too far from it, of which some are close to each other."""
    centre = passage(0, 200).split()
    rows = [(0, " ".join(centre))]
    for copy in range(1, 41):
        words = list(centre)
        family = (copy - 1) // 2  # two and two share their edits
        for place in range(family % 7, 200, 12):
            words[place] = f"edit{family}at{place}"
        words[199 - copy % 3] = f"own{copy}"
        rows.append((copy, " ".join(words)))
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {0: 0, **{c: c - (c - 1) % 2 for c in range(1, 41)}}


def test_pairs_far_from_every_leader_find_each_other(spark):
    """Texts of six out of fourteen frequent lines: nearly every bucket is large, and its leader far from most members."""
    draw = np.random.default_rng(11)
    lines = [passage(20 * line, 20) for line in range(14)]
    chosen = list({tuple(sorted(draw.permutation(14)[:6])) for _ in range(330)})[:300]
    rows = [(i, " ".join(lines[j] for j in one)) for i, one in enumerate(chosen)]
    for i in range(100):
        words = rows[i][1].split()
        words[30], words[90] = f"own{i}", f"other{i}"
        rows.append((300 + i, " ".join(words)))
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {**{i: i for i in range(300)}, **{300 + i: i for i in range(100)}}


def test_pairs_that_only_lack_what_a_group_carries_find_each_other(spark):
    """Beside each group of copies with a common paragraph, two texts without it that link to each other alone."""
    rows = []
    for group in range(30):
        base, common = [f"base{group}x{i}" for i in range(171)], [f"common{group}x{i}" for i in range(29)]
        for copy in range(14):
            rows.append((100 * group + copy, " ".join(base[:-1] + [f"copy{group}x{copy}"] + common)))
        for own in (50, 51):
            rows.append((100 * group + own, " ".join(base + [f"own{group}x{own}x{i}" for i in range(17)])))
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {doc: doc - doc % 100 + (50 if doc % 100 >= 50 else 0) for doc, _ in rows}


def test_middle_holds_what_most_sets_hold():
    sets = [(np.array(h, np.uint32), np.array(w, np.float64)) for h, w in [([1, 2, 5], [1, 2, 1]), ([1, 3], [1.5, 1]), ([1, 2], [2, 1])]]
    assert [a.tolist() for a in middle(sets)] == [[1, 2], [1.5, 1]]
    assert [a.tolist() for a in middle(sets[:2])] == [[1], [1]]
    assert [len(a) for a in middle([(np.zeros(0, np.uint32), np.zeros(0))] * 3)] == [0, 0]


def test_copies_too_far_from_their_origin_are_not_all_compared(spark, monkeypatch):
    """Copies near the origin share all its buckets with it, and would deal the far ones together if one of them led."""
    draw = np.random.default_rng(7)
    origin, rows = passage(3, 200).split(), []
    for copy in range(400):
        words = list(origin)
        for place in draw.permutation(200)[: 0 if copy == 150 else 3 if copy < 150 else draw.integers(14, 22)]:
            words[place] = f"own{copy}at{place}"
        rows.append((copy, " ".join(words)))
    pairs, real = [], neardup.stage

    def counted(df, label):
        out = real(df, label)
        if label == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(neardup, "stage", counted)
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {copy: 0 if copy <= 150 else copy for copy in range(400)}
    assert sum(pairs) < 8_000, pairs


def test_copies_with_edits_of_their_own_are_dropped_before_pairs_are_made(spark, monkeypatch):
    """Nothing that copies share beside their edits makes a link; pairs that share their edits are still found."""
    draw = np.random.default_rng(13)
    origin, rows = passage(4, 200).split(), []
    for copy in range(500):
        words = list(origin)
        for place in draw.permutation(40)[: 0 if copy < 60 else draw.integers(8, 14)]:
            words[5 * place + 2] = f"own{copy}at{place}"
        words[0] = f"first{copy}"
        rows.append((copy, " ".join(words)))
        if copy >= 480:
            words[199] = f"last{copy}"
            rows.append((copy + 500, " ".join(words)))
    pairs, real = [], neardup.stage

    def counted(df, label):
        out = real(df, label)
        if label == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(neardup, "stage", counted)
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {doc: 0 if doc < 60 else doc - 500 * (doc >= 500) for doc, _ in rows}
    assert sum(pairs[1:]) < 500, pairs


def test_shared_weights_equal_a_scan(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SLICE_BYTES", 400)
    draw = np.random.default_rng(17)
    pool, sets = draw.integers(0, 1 << 32, 150, np.uint64).astype(np.uint32), {}
    for node in range(40):
        hashes = np.sort(draw.choice(pool, draw.integers(0, 30), False))
        sets[str(node)] = (node // 3, hashes, draw.uniform(1, 4, len(hashes)).astype(np.float16))
    rows = [(node, label, bytearray(h.tobytes()), bytearray(w.tobytes())) for node, (label, h, w) in sets.items()]
    frame = spark.createDataFrame(rows, "node string, label long, hashes binary, weights binary")
    found = {r["node"]: (r["whole"], r["shared"]) for r in shared_weights(frame).collect()}
    for node, (label, hashes, weights) in sets.items():
        others = {h for other, held, _ in sets.values() if other != label for h in held.tolist()}
        wanted = sum(float(w) for h, w in zip(hashes.tolist(), weights) if h in others)
        assert not len(hashes) or found[node] == (float(weights.astype(np.float64).sum()), wanted)
    assert len(found) == sum(1 for _, h, _ in sets.values() if len(h))


def test_near_duplicate_classes_equal_all_links(spark, small, texts):
    found = {r["doc_id"]: r["class_id"] for r in queries()["op10_near_duplicates"](spark, small).collect()}
    sets = {}
    for doc, text in texts.items():
        words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.83 * len(sets[a] | sets[b]):
                assert found[a] == found[b]
            if a < b and found[a] == found[b] and texts[a] != texts[b]:
                assert any(c != a and found[c] == found[a] and len(sets[a] & sets[c]) >= 0.77 * len(sets[a] | sets[c]) for c in sets)


def test_repeats_equal_a_scan(spark, small, texts):
    found = {r["doc_id"]: tuple(r)[1:] for r in queries()["op5_repeats"](spark, small).collect()}
    seen = set()
    for doc in sorted(texts):
        data = (texts[doc] or "").encode()
        own = [data[i : i + 50] for i in range(len(data) - 49)]
        gone = [False] * len(data)
        for i, s in enumerate(own):
            if s in seen:
                gone[i : i + 50] = [True] * 50
        seen.update(own)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        assert found[doc] == (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())


def test_string_order_ranks_equal_strings_equally():
    data = np.frombuffer(b"abcabcabcabcabcabdabcabcabcabc", np.uint8)
    rank = string_order(data, 11)
    strings = [bytes(data[i : i + 11]) for i in range(len(data) - 10)]
    assert [strings[i] for i in np.argsort(rank, kind="stable")] == sorted(strings)
    assert len(set(rank.tolist())) == len(set(strings))


@pytest.mark.parametrize("size", [1, 2, 3, 64, 129])
def test_nearest_smaller_places(size):
    values = np.random.default_rng(size).permutation(size)
    assert previous_smaller(values).tolist() == [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(size)]
    assert next_smaller(values).tolist() == [min((j for j in range(i, size) if values[j] < values[i]), default=-1) for i in range(size)]


def test_chains_of_previous_factors_begin_at_the_first_occurrence():
    data = np.random.default_rng(5).integers(97, 99, 2000).astype(np.uint8)
    strings = [bytes(data[i : i + 11]) for i in range(len(data) - 10)]
    found = first_occurrences(previous_factors(data, np.arange(len(strings)), 11))
    assert found.tolist() == [strings.index(s) for s in strings]


def test_repeats_in_texts_longer_than_a_lot(spark):
    letters = np.random.default_rng(6).integers(97, 123, 1_200_000).astype(np.uint8).tobytes().decode()
    # the second text repeats all but three bytes, its stretches are cut elsewhere; the third repeats a piece across a cut
    second = "x" * 333 + letters[:600_000] + "???" + letters[600_000:]
    docs = [(1, letters), (2, second), (3, letters[524_200:524_400] + "!")]
    found = {r["doc_id"]: r for r in remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert not found[1]["spans"] and bytes(found[1]["kept"]) == letters.encode()
    assert [tuple(s) for s in found[2]["spans"]] == [(333, 600_333), (600_336, len(second))]
    assert bytes(found[2]["kept"]) == b"x" * 333 + b"???"
    assert bytes(found[3]["kept"]) == b"!"


def test_decontamination_equals_a_scan(spark, small, texts):
    word, lower = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), {i: i + 32 for i in range(65, 91)}
    items = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    phrases = collections.defaultdict(set)
    for item, text in items:
        words = word.findall(text.translate(lower))
        for i in range(max(1, len(words) - 12) if words else 0):
            phrases[tuple(words[i : i + 13])].add(str(item))
    sizes = {len(p) for p in phrases}
    for row in queries()["op3_decontamination"](spark, small).collect():
        words, hit, found = word.findall((texts[row["doc_id"]] or "").translate(lower)), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in phrases:
                    hit.update(range(i, i + size))
                    found |= phrases[tuple(words[i : i + size])]
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (len(words), len(hit), len(found))
        assert row["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert row["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(words))


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(text):
    digits = [int(c) for c in text if c.isdigit()]
    total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
    return 13 <= len(digits) <= 19 and total % 10 == 0


VALID = {
    "email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")), "card": _luhn,
    "phone": lambda m: 9 <= sum(c.isdigit() for c in m) <= 15,
}


def _base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text) if VALID[k](m.group())]


def test_pii_equals_a_scan_and_stays_native(spark, small, texts):
    found = queries()["op8_pii"](spark, small)
    assert not re.search("Python|Arrow|Pandas", found._jdf.queryExecution().executedPlan().toString())
    for row in found.collect():
        spans = _base(texts[row["doc_id"]] or "")
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k) for s in spans) for k in PATTERNS]


ODD = [
    "a@b.c%d@e.f é\U0001f600x@y.z 1.2.3.4.5.6.7.8 999.1.1.1 +1 (743) 555-3824", "1" * 20000, "1 " * 9000 + "4111111111111111",
    "a" * 20000, "+1" + " " * 20000, "x@" * 9000 + "a.b", "a." * 9000 + "@b.c", "1.2." * 2000, "0000255.1.1.1 4111-1111-1111-1111",
    "iban DE89 3704 0044 0532 0130 00 now", "DE89 3704 0044 0532 0130 01", "ssn 123-45-6789 but 123-45-6789", "x 123-45-6789",
]


def test_pii_of_odd_texts(spark):
    rows = pii.find_pii(spark.createDataFrame([(t,) for t in ODD], "text string")).select(
        "text", pii.listed("spans", list(PATTERNS)).alias("base"), pii.listed("spans").alias("all")).collect()
    for row in rows:
        assert row["base"] == ",".join(_base(row["text"]))
    more = {r["text"]: r["all"] for r in rows}
    assert more[ODD[9]] == "iban:5:32" and more[ODD[10]] == "" and more[ODD[11]] == "ssn:4:15" and more[ODD[12]] == ""
    masked = pii.masked(pii.find_pii(spark.createDataFrame([(ODD[9],)], "text string"))).first()[0]
    assert masked == "iban [IBAN] now"


def test_tokens_are_those_of_whole_texts(texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary_path())
    whole.encode_special_tokens = True
    odd = ["", " ", "  a  b ", "a\n b\n\n c \n d", "it's  we'll\t x", " a  b", "<|endoftext|> x", "café \U0001f600 naïve", "a b " * 50]
    some = odd + [t for t in texts.values() if t][:60]
    found = Encoder(vocabulary_path()).encode(some)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [whole.encode(t, add_special_tokens=False).ids for t in some]


def test_packing_keeps_added_tokens_of_the_vocabulary():
    from tokenizers import Tokenizer

    from lapwise.llm.tokens import encoder

    plain = Tokenizer.from_file(vocabulary_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "a b c", "<|endoftext |> a"]
    found = [np.frombuffer(f, "<u4").tolist() for f in encoder(vocabulary_path()).encode(texts)]
    assert found == [plain.encode(t, add_special_tokens=False).ids for t in texts] and found[0] == [64, 220, 50256, 275]


def test_cuts_fill_their_slots():
    for length in range(1, 3000, 7):
        pieces = list(cuts(length, 1024, 1 / 64))
        assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1].tolist()] and sum(p[1] for p in pieces) == length
        assert all(size * count <= 1024 and 1024 // count - size <= 1024 // count / 64 for _, size, count in pieces)
    assert first_fit([5, 6, 4], 10) == [(1, 0), (0, 0), (0, 6)]


def test_packing_keeps_every_token_once(spark, small, texts):
    whole = Encoder(vocabulary_path())
    import zlib

    pieces = collections.defaultdict(list)
    sequences = collections.Counter()
    for row in queries()["op2_packing"](spark, small).collect():
        pieces[row["doc_id"]].append(row)
        sequences[row["sequence_id"]] += row["length"]
    for doc, text in texts.items():
        ids = whole.encode([text or ""])[0] + bytes(4)
        place = 0
        for row in sorted(pieces[doc], key=lambda r: r["start"]):
            assert row["start"] == place and row["doc_tokens"] == len(ids) // 4
            assert row["ids_crc32"] == zlib.crc32(ids[4 * place : 4 * (place + row["length"])])
            place += row["length"]
        assert place == len(ids) // 4
    assert max(sequences.values()) <= 1024 and sum(sequences.values()) > 0.98 * 1024 * len(sequences)


def test_sharding_balances_bytes(spark, small):
    rows = queries()["op1_sharding"](spark, small)
    sizes = [r[1] for r in rows.groupBy("shard").agg(F.sum("size")).collect()]
    largest = rows.agg(F.max("size")).first()[0]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= max(largest, 0.02 * max(sizes))
    vectors = np.array([[0.6, 0.1], [0.1, 0.6], [0.2, 0.2], [0.4, 0.2], [0.2, 0.4]])
    shard = place_by_dot_product(vectors, 2, (1.0, 1.0))
    assert all(vectors[shard == s].sum(axis=0).max() <= 1 for s in range(2))


def test_automaton_equals_regular_expressions():
    globs = ["*.net/**", "a?c", "**/x*/y", "*", "**", "\\*b", "longer*" + "z" * 80]
    texts = [b".a.net/q/r", b"abc", b"a/c", b"p/q/xr/y", b"x/y", b"", b"*b", b"longer" + b"z" * 90, b".net", b"caf\xc3\xa9"]
    rules = [".*" if g == "**" else re.sub(r"@@", ".*", "".join(
        "\\*" if t == "\\*" else "@@" if t == "**" else "[^/]*" if t == "*" else "[^/]" if t == "?" else re.escape(t)
        for t in re.findall(r"\\\*|\*\*|.", g))) for g in globs]
    found = Automaton(globs).match(texts)
    for text, row in zip(texts, found):
        assert row.tolist() == [re.fullmatch(r.encode(), text, re.S) is not None for r in rules]


def test_held_out_languages(spark, small):
    known = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    found = queries()["op7_language"](spark, small).where("held_out").join(known, "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.01"
    from lapwise.llm.toxicity import toxicity

    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    unseen = labels.where("doc_id % 4 = 0")
    found = toxicity(documents.join(unseen, "doc_id", "left_semi"), documents, labels.where("doc_id % 4 <> 0"))
    both = found.select("doc_id", "toxic_verdict").join(unseen, "doc_id")
    assert both.agg(F.avg((F.col("toxic_verdict").cast("int") == F.col("toxic")).cast("int"))).first()[0] > 0.9


def test_neighbours_reach_the_recall(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").orderBy("vec_id").toPandas()
    vectors, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    for found in (queries()["op9_neighbours"](spark, small), nearest(spark.read.parquet(f"{small}/embeddings.parquet"), block=32, curves=8)):
        mine, all_of_them = _found(found.toPandas(), vectors, ids)
        assert mine >= 0.9 * all_of_them


def _found(found, vectors, ids):
    hits = total = 0
    for query, mine in found.sort_values("rank").groupby("query_id"):
        scores = vectors @ vectors[ids == query][0]
        best = [i for i in ids[np.argsort(-scores, kind="stable")] if i != query][:20]
        hits, total = hits + len(set(best) & set(mine["vec_id"])), total + len(best)
        assert mine["rank"].tolist() == list(range(1, 21)) and (np.diff(mine["score"]) <= 0).all()
        assert mine["score"].to_numpy() == pytest.approx([scores[ids == v][0] for v in mine["vec_id"]])
    return hits, total


def test_pipeline_stages(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, small)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name != "packing":
            assert docs.columns == columns and 0 < docs.count() <= before
            before = docs.count()
    assert docs.agg(F.sum("length")).first()[0] > 0


def test_which_operators_are_checked_by_sql():
    mine = {n for n in queries() if re.match(r"op\d+_|pipeline", n)}
    assert len(mine) == 14 and mine & set(oracle_sql()) == {"op6_url_filter", "op12_archives", "op13_collocations"}
