"""Each operator over odd rows and over empty tables."""


import pytest
from pyspark.sql import functions as F

from lapwise.llm.contamination import contaminated, contamination, without_contaminated
from lapwise.llm.language import identify_languages, language_tables
from lapwise.llm.neardup import near_duplicates, without_near_duplicates
from lapwise.llm.neighbours import nearest
from lapwise.llm.packing import harmonic_pack
from lapwise.llm.pii import find_pii, masked
from lapwise.llm.queries import vocabulary_path
from lapwise.llm.repeats import remove_repeats
from lapwise.llm.sharding import vector_shards
from lapwise.llm.toxicity import toxicity, without_toxic
from lapwise.llm.urls import judge_urls


@pytest.fixture(scope="module")
def benchmark(spark):
    from words import passage

    return spark.createDataFrame(
        [(1, passage(0, 20)), (2, passage(0, 20)), (3, None), (4, ""), (5, "one two"), (None, "x")], "item_id long, text string"
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 1), (2, 1, 1), (7, 0, 0), (10, 1, 0), (None, 1, 1), (11, None, 0)], "doc_id long, quality int, toxic int")


def test_sharding(odd, none):
    found = vector_shards(odd, shards=4).toPandas()
    assert len(found) == odd.count()
    for _, rows in found.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))
    assert set(found[found.doc_id == 4]["size"]) == {8} and set(found[found.doc_id == 4]["text_crc32"]) == {0}
    assert found[found.doc_id == 1]["shard"].tolist() == found[found.doc_id == 2]["shard"].tolist()
    assert vector_shards(none).count() == 0


def test_packing(odd, none):
    path = vocabulary_path()
    found = harmonic_pack(odd, path).toPandas()
    for _, rows in found.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows["offset"].tolist() == [0, *rows["length"].cumsum().tolist()[:-1]] and rows["length"].sum() <= 1024
    assert set(found[found.doc_id == 6]["doc_tokens"]) == {1}
    assert int(found["length"].sum()) == sum(found.drop_duplicates(["doc_id", "doc_tokens"])["doc_tokens"]) + found[found.doc_id == 7]["doc_tokens"].iloc[0]
    assert harmonic_pack(none, path).count() == 0


def test_contamination(odd, none, benchmark, monkeypatch):
    found = {(r["doc_id"], r["n_words"]): r for r in contaminated(contamination(odd, benchmark)).collect()}
    assert found[1, 60]["items"] == ["1", "2"] and found[1, 60]["n_hit"] == 20 and found[1, 60]["contaminated"]
    assert found[8, 2]["items"] == ["5"] and found[4, 0]["n_hit"] == 0 and not found[4, 0]["contaminated"]
    kept = without_contaminated(odd, benchmark)
    assert kept.columns == odd.columns and {r[0] for r in kept.select("doc_id").collect()}.isdisjoint({1, 2, 3, 8})
    assert contamination(none, benchmark).count() == 0
    assert contamination(odd, benchmark.limit(0)).where("size(spans) > 0").count() == 0
    import lapwise.llm.contamination as module

    monkeypatch.setattr(module, "BLOCK_BYTES", 100)
    blocks = {(r["doc_id"], r["n_words"]): r for r in contaminated(contamination(odd, benchmark)).collect()}
    assert {k: (r["n_hit"], r["items"]) for k, r in blocks.items()} == {k: (r["n_hit"], r["items"]) for k, r in found.items()}


def test_toxicity(odd, none, labels):
    found = toxicity(odd, odd, labels)
    assert found.count() == odd.count() and found.where("toxic IS NULL OR toxic < 0 OR toxic > 1").count() == 0
    assert without_toxic(odd, odd, labels).columns == odd.columns
    assert toxicity(none, odd, labels).count() == 0
    assert toxicity(odd, odd, labels.limit(0)).where("toxic_verdict OR toxic <> 0").count() == 0


def test_repeats(odd, none):
    found = {(r["doc_id"], r["n_bytes"]): r for r in remove_repeats(odd).collect()}
    assert len(found) == odd.select("doc_id", F.octet_length(F.coalesce("text", F.lit("")))).distinct().count()
    size = found[1, max(n for d, n in found if d == 1)]["n_bytes"]
    assert bytes(found[2, size]["kept"]) == b"" and found[3, size + 12]["kept"] == b" extra words"
    assert found[7, max(n for d, n in found if d == 7)]["kept"] != b""
    assert found[4, 0]["spans"] == [] and bytes(found[4, 0]["kept"]) == b""
    assert remove_repeats(none).count() == 0


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.NET/x"), (5, "http://a.net"), (6, "x://example.net/en/y?z"),
            (7, "x://example.com/de/"), (8, "x://notexample.com/de/"), (9, "x://org/fr/" + "a" * 20000), (9, "x://org/fr/" + "a" * 20000),
            (None, "x://sub.org/fr"), (11, "http://u@h.org:80/fr/"), (12, "x://a.example.net/EN/"), (13, "http:///a.net/")]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, host string")
    found = {(r["page_id"], r["rule"], r["verdict"], r["host"]) for r in judge_urls(pages).collect()}
    assert found == {
        (1, None, "allow", ""), (2, None, "allow", ""), (3, None, "allow", ""), (4, "net/", "block", "a.net"), (5, None, "allow", "a.net"),
        (6, "example.net/en/", "allow", "example.net"), (7, "example.com/de/", "block", "example.com"), (8, None, "allow", "notexample.com"),
        (9, "org/fr/", "allow", "org"), (None, None, "allow", "sub.org"), (11, None, "allow", "u@h.org:80"),
        (12, "net/", "block", "a.example.net"), (13, None, "allow", ""),
    }
    assert judge_urls(pages).count() == len(rows) and judge_urls(pages.limit(0)).count() == 0


def test_language(odd, none):
    learned = language_tables(odd)
    found = {r["doc_id"]: r for r in identify_languages(odd, learned).collect()}
    assert found[4]["lang_pred"] == found[9]["lang_pred"] == found[6]["lang_pred"] == "und" and found[4]["score"] == 0
    assert found[12]["lang_pred"] == "fr" and 0 < found[12]["score"] <= 1
    assert identify_languages(none, learned).count() == 0
    assert {r["lang_pred"] for r in identify_languages(odd, language_tables(none)).collect()} == {"und"}


def test_pii(odd, none):
    found = find_pii(odd, into="found")
    assert found.columns == [*odd.columns, "found"] and found.count() == odd.count()
    assert masked(found, spans="found").columns == odd.columns
    assert masked(found, spans="found").where("text IS NULL").count() == odd.where("text IS NULL").count()
    assert find_pii(none, into="found").count() == 0


def test_neighbours(spark):
    rows = [(i, [float(i % 5), float(i % 7) - 3.0, 1.0]) for i in range(0, 300)]
    rows += [(1000, None), (1020, []), (1040, [0.0, 0.0, 0.0]), (1060, [1.0, None, 1.0]), (1080, [float("nan"), 1.0, 1.0]),
             (1100, [float("inf"), 1.0, 1.0]), (1120, [1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (20, [0.0, 3.0, 1.0])]
    table = spark.createDataFrame([(*r, 0.5) for r in rows], "vec_id long, embedding array<double>, score double")
    found = nearest(table, k=5).toPandas()
    assert sorted(found["query_id"].unique()) == list(range(0, 300, 20)) and (found.groupby("query_id").size() == 5).all()
    vectors = {i: v for i, v in rows[:300]}
    for query, mine in found.sort_values("rank").groupby("query_id"):
        scores = {i: sum(a * b for a, b in zip(vectors[query], v)) for i, v in vectors.items() if i != query}
        assert mine["vec_id"].tolist() == sorted(scores, key=lambda i: (-scores[i], i))[:5]
    assert nearest(table.limit(0)).count() == 0 and nearest(table.where("vec_id = 20")).count() <= 1


def test_near_duplicates(odd, none):
    found = {(r["doc_id"], r["text_key"]): r for r in near_duplicates(odd).collect()}
    by_id = {k[0]: r for k, r in found.items() if k[0] is not None}
    assert by_id[2]["class_id"] == by_id[3]["class_id"] == 1 and by_id[5]["class_id"] == 4 and by_id[11]["class_id"] == 10
    assert by_id[6]["class_id"] == 6 and by_id[9]["class_id"] == 9
    kept = without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((r[0] for r in kept.select("doc_id").collect()), key=lambda v: (v is None, v)) == [1, 4, 6, 7, 8, 9, 10, 12, None]
    assert near_duplicates(none).count() == 0




def test_benchmark_items_without_an_id_are_searched(spark, odd):
    from words import passage

    items = spark.createDataFrame([(None, passage(10, 30)), (None, passage(200, 20)), (3, passage(10, 20))], "item_id long, text string")
    found = {(r["doc_id"], r["n_words"]): r for r in contaminated(contamination(odd, items)).collect()}
    assert found[1, 60]["n_hit"] == 30 and found[1, 60]["items"] == ["3"]
    assert found[10, 80]["n_hit"] == 20 and found[10, 80]["items"] == [] and found[10, 80]["contaminated"]


def test_one_row_of_each_class_beside_clashing_columns(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(i, t, i + 10, "a", "b", "c", "d") for i, t in ((1, text), (2, text), (2, text), (3, "other words"), (3, "other words"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, count long, __id string, __key string, __own string, row string")
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[3]]
