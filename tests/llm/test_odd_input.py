"""Nulls in any column, empty and very long texts, repeated rows, empty tables, clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import decontaminate, licence_scan, line_runs, near_duplicates, nearest, packing, quality_model, token_counts, toxicity, warc

LONG = "word other thing\n" * 40_000
ODD = [
    (1, None, "en"), (2, "", None), (3, "   \n ", "en"), (None, "alone with a null id and enough words", "en"), (4, "a b c", "en"),
    (4, "a b c", "en"), (5, LONG, "en"), (6, "\x00 \U0001F600 tail", "xx"), (4, "another text under the same id", "en"),
]
CLASHES = (
    "score", "predicted", "held_out", "digest", "fp", "key", "place", "runs", "bin_id", "_row", "c0", "_id", "_digest", "n", "label",
    "similarity", "deleted_lines", "n_tokens", "piece",
)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id bigint, text string, lang string").withColumns({n: F.lit(n) for n in CLASHES})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (4, 1, 0), (4, 0, 1), (5, 0, 1), (None, 1, 1), (6, None, None), (77, 1, 0)], "doc_id bigint, quality bigint, toxic bigint"
    ).withColumns({"text": F.lit("clash"), "score": F.lit(1)})


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, None), (2, ""), (None, "alone with a null id and enough words"), (3, "..")], "item_id bigint, text string"
    ).withColumn("doc_id", F.lit(1))


def per_row(odd, labels, benchmark):
    return {
        "toxicity": toxicity.score_toxicity(odd, labels), "quality": quality_model.score_quality(odd, labels),
        "licences": licence_scan.scan_licences(odd), "tokens": token_counts.count_tokens(odd),
        "lines": line_runs.dedup_lines(odd), "near": near_duplicates.find_near_duplicates(odd),
    }


def test_one_row_for_each_row(odd, labels, benchmark):
    want = sorted(str(r[0]) for r in ODD)
    for name, df in per_row(odd, labels, benchmark).items():
        assert sorted(str(r["doc_id"]) for r in df.collect()) == want, name


def test_defined_results(odd, labels, benchmark):
    tokens = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(odd).collect()}
    assert tokens[1] == tokens[2] == tokens[3] == 0 < tokens[5]
    near = near_duplicates.find_near_duplicates(odd).collect()
    assert {r["component_id"] for r in near if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["fingerprint"] for r in near if r["doc_id"] in (1, 2, 3)} == {"0" * 16}
    assert all(r["component_id"] is None for r in near if r["doc_id"] is None)
    assert all(r["component_id"] == r["doc_id"] for r in near if r["doc_id"] in (4, 5, 6))
    lines = {(r["doc_id"], r["text"]): r["deleted_lines"] for r in line_runs.dedup_lines(odd, line_runs.Settings(3)).collect()}
    assert lines[(1, None)] == 0 and lines[(4, "a b c")] == 0 and lines[(5, LONG[: len("word other thing\n")])] == 39_999
    found = decontaminate.find_contamination(odd, benchmark).collect()
    assert [(r["doc_id"], r["item_id"], r["similarity"]) for r in found] == [(None, None, 1.0)]
    kept = near_duplicates.keep_one(odd)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "None", "4", "4", "5", "6"])
    pieces = packing.pack_documents(odd).collect()
    assert sum(r["n_words"] for r in pieces if r["doc_id"] == 5) == 120_000
    assert sum(r["n_words"] for r in pieces if r["doc_id"] == 4) == 12
    assert [r["bin_id"] for r in pieces if r["doc_id"] in (1, 2, 3)] == [None] * 3


def test_line_runs_of_scripts_without_spaces(spark):
    for start in ("\u4e00", "\u3042", "\u30a2", "\u0e01"):
        passage = "\n".join("".join(chr(ord(start) + i + k) for i in range(20)) for k in range(3))
        short = "".join(chr(ord(start) + 5 + i) for i in range(30))
        rows = [(1, f"{passage}\nown"), (2, f"other\n{passage}"), (3, short), (4, short)]
        got = {r["doc_id"]: r["text"] for r in line_runs.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
        assert got[1] == rows[0][1] and got[2].strip() == "other" and got[3] == got[4] == short
    assert [line_runs.count_words(x) for x in ("a b  c", "\u4e00\u4e01 b", "na\u00efve caf\u00e9")] == [3, 3, 2]


def test_empty_tables(spark, odd, labels, benchmark):
    none = odd.limit(0)
    for name, df in per_row(none, labels, benchmark).items():
        assert df.count() == 0, name
    assert packing.pack_documents(none).count() == 0
    assert decontaminate.find_contamination(none, benchmark).count() == 0
    assert decontaminate.find_contamination(odd, benchmark.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(odd, benchmark.limit(0)).count() == odd.count()
    assert near_duplicates.keep_one(none).count() == 0
    assert toxicity.score_toxicity(odd, labels.limit(0)).where("score > 0.01").count() == 0
    assert quality_model.score_quality(odd, labels.limit(0)).where("abs(score - 0.5) > 1e-9").count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.archive_pages(pages).count() == 0
    assert nearest.nearest_neighbours(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_stages_on_odd_documents(spark, odd, labels, benchmark, tmp_path):
    folder = f"file://{tmp_path}"
    labels.write.parquet(f"{folder}/labels.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns, name
            out.count()
        corpus_pipeline.packing(spark, docs, folder).count()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
        (None, [1.0, 1.0]), (8, [-1.0, 0.5]), (20, [0.0, 0.0]), (1, [1.0, 0.0]), (9, []), (0, [1.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({"cell": F.lit(1), "score": F.lit("x"), "vector": F.lit(2)})
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest.nearest_neighbours(frame).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 2.0), (0, 2, 1, 1.0), (0, 3, 1, 1.0), (0, 4, 8, -1.0)]
    with pytest.raises(ValueError):
        nearest.nearest_neighbours(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "vec_id bigint, embedding array<double>"))
