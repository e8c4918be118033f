"""Pipeline stages on nulls, empty tables, clashing columns and planted copies."""

import pytest

pytest.importorskip("corpus_pipeline")

import corpus_pipeline as cp  # noqa: E402

KIND = "doc_id long, text string, lang string, source string, n_chars long, found string, own int, size string"
ITEM = " ".join(f"q{i}" for i in range(12))
PROSE = "\n".join(" ".join(f"word{i} goes{i * j % 7} here{i % 11}" for i in range(15)) for j in range(1, 6))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def docs(spark):
    texts = [
        (0, PROSE), (1, PROSE), (2, None), (3, ""), (4, "123 ..."), (5, f"Some text, {ITEM} and more."), (None, "no id here at all"),
        (7, PROSE.replace("word3", "other", 1).replace("\n", " ")), (8, "clean words of their own stand here")]
    rows = [(i, t, None if k % 4 == 1 else "en", None if k % 3 == 0 else "s", None, "x", 1, "y") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, KIND)


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, docs, folder, name):
    stage = dict(cp.STAGES)[name]
    out, none = stage(spark, docs, folder), stage(spark, docs.limit(0), folder)
    assert none.count() == 0 and none.columns == out.columns
    if name != "mixing":
        assert out.columns == list(cp.COLUMNS)
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert {0, 8, None} <= kept
    gone = {"language": {2, 3, 4}, "line_dedup": {1}, "near_dedup": {1, 7}, "decontamination": {5}, "mixing": set()}[name]
    assert kept == {0, 1, 2, 3, 4, 5, 7, 8, None} - gone


def test_contaminated_rows_without_an_id(spark, docs, folder):
    """Only the contaminated row goes, whatever ids rows share."""
    texts = [(None, f"x {ITEM}"), (None, "clean words"), (1, f"{ITEM} y"), (1, "clean too")]
    rows = spark.createDataFrame([(i, t, None, "s", 3, "x", 1, "y") for i, t in texts], KIND)
    out = cp.drop_contaminated(spark, rows, folder).collect()
    assert sorted(map(tuple, out), key=str) == [(1, "clean too", None, "s", 3), (None, "clean words", None, "s", 3)]


def test_whole_run(spark, docs, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    rows = cp.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == {0, 8, None}
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
