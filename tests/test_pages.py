import random
import re

import pytest

from duoscope.operators import topk as K
from duoscope.operators.pages import PageDirectory


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(2)
    words = ["Heat", "Alien", "straße", "Été", "ab", "", "The Thing", "100%", "a_b", "日本語の映画"]
    rows = [(i, rng.choice([*words, None]) if i % 7 else f"Unique {i}", rng.choice([None, 1.5, 2.25, rng.random() * 100]), i % 50)
            for i in range(2000)]
    return spark.createDataFrame(rows, "id long, title string, score double, `a b` int")


def same(got, want):
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()] and got.columns == want.columns


@pytest.mark.parametrize("ascending", [True, False])
def test_pages_and_searches_equal_browse(table, ascending):
    how = dict(order_by=["score"], tie_break=["id"], ascending=ascending, hidden=["id"])
    with PageDirectory(table, ["score"], ["id"], ascending, ["id"], parts=9) as pages:
        assert pages.size == 2000 and len(pages.parts) > 3
        for page, size in ((1, 15), (134, 15), (135, 15), (3, 700)):
            same(pages.page(page, size), K.browse(table, page=page, size=size, **how))
        for text in ("THE TH", "é", "unique 7", "2.25", "日本語", "100%", "nothing here"):
            page = 2 if text in ("é", "2.25") else 1
            same(pages.search(text, page, 10), K.browse(table, search=text, page=page, size=10, **how))


def test_a_deep_page_reads_one_or_two_parts(table):
    with PageDirectory(table, ["score"], ["id"], parts=12) as pages:
        for page in (1, 50, 100, 133):
            plan = pages.page(page)._jdf.queryExecution().executedPlan().toString()
            (filters,) = set(re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan))
            named = re.findall(r"_part#\d+L? (?:=|IN) \(?([\d,]+)", filters)
            assert named and 1 <= len(named[0].split(",")) <= 2, filters
        plan = pages.search("unique 7")._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[.*_bucket#\d+ (IN|=|INSET)", plan)


def test_files_go_and_empty_tables_have_no_page(spark, table, tmp_path):
    with PageDirectory(table.where("false"), ["score"], path=str(tmp_path)) as pages:
        assert pages.size == 0 and pages.page(1).count() == 0 and pages.search("heat").count() == 0
        assert list(tmp_path.iterdir())
    assert not list(tmp_path.iterdir())


def test_postings_are_lists_made_where_the_rows_lie(spark, table):
    """One row per trigram and batch of a part, not one per trigram and row; nothing but rows is shuffled."""
    with PageDirectory(table, ["score"], ["id"], parts=3) as pages:
        found = spark.read.parquet(f"{pages._root}/postings")
        lists = found.groupBy("tri", "_part").count()
        assert found.count() == lists.count()
        rows = table.where("title LIKE 'Unique 7%'").count()
        assert found.where("tri = 'e 7'").selectExpr("sum(size(places)) AS n").first().n == rows
        plan = pages.search("e 7")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "HashAggregate" not in plan
        same(pages.search("E 7", 2, 4), K.browse(table, search="e 7", order_by=["score"], tie_break=["id"], page=2, size=4))
