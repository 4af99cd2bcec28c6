"""What keeps time and memory in proportion to the input: texts are read, kept and shuffled no more than needed."""

import pathlib

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.operators import clean, features, svd, tfidf
from tidemark.plans import features as plans
from tidemark.session import shared_folder
from tidemark.sources import tables


@pytest.fixture
def staged(monkeypatch):
    """The plans of the tables that a fit stores, by their labels."""
    plans = {}

    def keep(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, label)

    stage = tfidf.stage
    monkeypatch.setattr(tfidf, "stage", keep)
    return plans


@pytest.mark.parametrize("carry", [[], ["likes"]])
def test_terms_of_a_text_are_counted_once_by_one_worker(spark, staged, carry):
    texts = [(i, None if i % 9 == 4 else "" if i % 9 == 5 else f"often w{i % 7} w{i % 5} often", i) for i in range(60)]
    frame = spark.createDataFrame([*texts, *texts[:10]], "id int, content string, likes int")
    vectors = tfidf.fit_vectors(frame, ["id"], "content", 8, carry=carry)
    assert all(plan.count("ArrowEvalPython [") == 1 for plan in staged.values())
    empty = vectors.rows.where("size(_ids) = 0").count()
    assert (vectors.rows.count(), empty) == ((70, 16) if carry else (54, 0))
    wide = svd.fit_directions(vectors, 1)
    assert wide.converged and wide.scores().count() == 54


def test_texts_are_split_twice_only(spark, staged):
    texts = [(i, f"a b w{i % 3} a" + " c" * (i % 4)) for i in range(40)]
    frame = spark.createDataFrame(texts, "id int, content string")
    vectors = tfidf.fit_vectors(frame, ["id"], "content", 9)
    assert "regexp_extract_all" in staged["word-places"] and "regexp_extract_all" not in staged["term-vectors"]
    rows = {r["id"]: dict(zip(r["_ids"], r["_tf"])) for r in vectors.rows.collect()}
    for i, content in texts:
        words = content.split()
        grams = words + [f"{x} {y}" for x, y in zip(words, words[1:])]
        kept = {n: grams.count(term) for n, term in enumerate(vectors.vocabulary.terms) if term in grams}
        assert rows[i] == kept


def test_runs_of_rows_are_bounded_by_their_entries():
    sizes = np.array([0, 3, 4, 20, 1, 1, 0, 1, 9, 2])
    runs = tfidf.row_runs(sizes, rows=3, entries=8)
    assert [start for start, _ in runs] == [0, *np.cumsum([n for _, n in runs])[:-1]] and sum(n for _, n in runs) == 10
    assert all(n <= 3 and (n == 1 or sizes[start:start + n].sum() <= 8) for start, n in runs)
    assert tfidf.row_runs(np.zeros(0, dtype=int)) == [(0, 0)]


def test_scores_are_made_before_repeats_go_and_no_text_is_shuffled(spark):
    rows = [
        ("ann", "2024-01-01 10:00", "Buy the dip", "1", "a", 2), ("ann", "2024-01-01 10:00", "Buy  the dip", "5", "a", 1),
        ("ann", "2024-01-01 10:00", "Buy the dip", "7", "b", 3), ("bob", None, "sell now", "1", "a", 4),
        ("bob", "no time", "sell now", "9", "a", 3), (None, "2024-01-02", None, None, "a", 5), (None, "2024-01-02", None, "3", "a", 6),
        ("cid", "2024-01-03", "sell sell buy live", "n/a", None, 7), ("cid", "2024-01-03", "sell sell buy live", "2", None, 7),
    ]
    raw = spark.createDataFrame(rows, "username string, timestamp string, content string, likes string, source_file string, no int")
    found = plans.clean_scores(raw, order_by=["no", "likes"])
    apart = clean.drop_incomplete(clean.clean_posts(raw, order_by=["no", "likes"]))
    expected = features.score_reactions(features.score_text(apart))
    assert found.columns == expected.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect())) and found.count() == 4

    def nodes(node):
        yield node
        for i in range(node.children().size()):
            yield from nodes(node.children().apply(i))

    numbers = found.select("uid", "source_file", "timestamp", "polarity", "engagement")
    windows = [n for n in nodes(numbers._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Window"]
    assert len(windows) == 1
    assert "content" not in [windows[0].output().apply(i).name() for i in range(windows[0].output().size())]


def test_only_wanted_columns_of_posts_are_shuffled(spark):
    rows = [("ann", "2024-01-01 10:00", "Buy the  dip #a", i % 3, f"u{i % 2}") for i in range(9)] + [(None, None, None, 4, None)]
    raw = spark.createDataFrame(rows, "username string, timestamp string, content string, no int, extra string")
    wanted = {"uid": F.col("uid"), "md5": F.md5("content"), "no": F.col("no"), "a b": F.upper("extra")}
    found = clean.clean_posts(raw, "global", order_by=["no", "extra"], columns=wanted)
    whole = clean.clean_posts(raw, "global", order_by=["no", "extra"])
    expected = whole.select(*[column.alias(name) for name, column in wanted.items()])
    assert found.columns == list(wanted) and sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))

    def nodes(node):
        yield node
        for i in range(node.children().size()):
            yield from nodes(node.children().apply(i))

    windows = [n for n in nodes(found._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Window"]
    assert len(windows) == 1
    assert "content" not in [windows[0].output().apply(i).name() for i in range(windows[0].output().size())]


@pytest.mark.parametrize("least", [1, 1 << 30])
def test_csv_by_hashtag_shuffles_a_slice_at_a_time(spark, tmp_path, monkeypatch, least):
    """Dealt out at once, all rows lie in a shuffle beside the files."""
    monkeypatch.setattr(tables, "SLICE_BYTES", least)
    monkeypatch.setattr(tables, "SLICES", 3)
    texts = [(i, "x" if i % 2 else f"t{i % 5}" if i % 3 else None, f'a "{i}"', [f"p{i}", "q"]) for i in range(200)]
    rows = spark.createDataFrame(texts, "no int, hashtag string, content string, l array<string>").repartition(6)
    dealt, csv = [], DataFrameWriter.csv
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, *a, **b: dealt.append(self._df.count()) or csv(self, *a, **b))
    folder = str(tmp_path / "csv")
    tables.write_csv_by_hashtag(rows, folder, compression="gzip")
    assert sum(dealt) == 200 and (max(dealt) < 120 and len(dealt) <= 4 if least == 1 else dealt == [200])
    back = spark.read.option("header", True).option("escape", '"').csv(folder).collect()
    assert sorted((int(r["no"]), r["hashtag"], r["content"], r["l"]) for r in back) == [(i, t, c, ", ".join(l)) for i, t, c, l in texts]
    files = [p.name for p in (tmp_path / "csv").rglob("part-*")]
    assert files and all(name.endswith(".csv.gz") for name in files) and (tmp_path / "csv" / "_SUCCESS").exists()
    assert not list(pathlib.Path(shared_folder(spark).removeprefix("file:")).glob("csv-rows-*"))
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        tables.write_csv_by_hashtag(rows, folder)
    tables.write_csv_by_hashtag(rows.limit(1), folder, "ignore")
    assert spark.read.option("header", True).csv(folder).count() == 200
    tables.write_csv_by_hashtag(rows.where("no < 3"), folder, "overwrite")
    assert spark.read.option("header", True).csv(folder).count() == 3
    tables.write_csv_by_hashtag(rows.where("no < 2"), folder, "append")
    assert spark.read.option("header", True).csv(folder).count() == 5
    tables.write_csv_by_hashtag(rows.limit(0), str(tmp_path / "none"))
    assert (tmp_path / "none" / "_SUCCESS").exists()
