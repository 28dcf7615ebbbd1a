"""Plan-shape tests: what Catalyst must (not) do for each job."""

from __future__ import annotations

from statforge.plans import jobs, tables
from statforge.sources import read_table
from tests.conftest import lines

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_map_only_jobs_have_no_exchange(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    from statforge.sources.text import lines_from_columns

    text = lines_from_columns(li, tables.LINEITEM_COLUMNS, "\t")
    subset = jobs.subset_rows(text, bounds={4: 25.0}, equals={9: "O"}, member={8: ("A", "R")})
    assert "Exchange" not in _plan(subset)
    assigned = jobs.assign_clusters(text, [[0.0, 0.0], [1.0, 1.0]], [4, 6])
    assert "Exchange" not in _plan(assigned)
    proj = jobs.year_range_projection(lines(spark, ["a,b,c,1.0,2001"]), year=4)
    assert "Exchange" not in _plan(proj)


def test_aggregations_are_partial_then_final(spark):
    out = jobs.group_max_floor(lines(spark, ["0,t,a,1", "0,t,b,2"]))
    plan = _plan(out)
    assert plan.count("HashAggregate") >= 2 and "partial_max" in plan


def test_profile_is_one_global_aggregate(spark):
    multi = spark.createDataFrame([("1\t2",), ("3\t4",), ("5\t6",)], "value STRING").repartition(3)
    out = jobs.column_moments(multi, width=2)
    plan = _plan(out)
    assert "partial_avg" in plan and "partial_stddev_pop" in plan
    assert plan.count("Exchange SinglePartition") == 1


def test_split_once_despite_filter(spark):
    # the filter must stay above the generator that splits the line
    out = jobs.subset_rows(lines(spark, ["x"]), bounds={1: 5.0}, equals={2: "a"}, member={})
    opt = out._jdf.queryExecution().optimizedPlan().toString()
    assert opt.count("split(") == 1


def test_scan_prunes_columns(spark):
    from statforge.sources.text import lines_from_columns

    li = read_table(spark, SF, "lineitem")
    text = lines_from_columns(li, ("l_quantity", "l_discount"), "\t")
    plan = _plan(jobs.column_moments(text, width=2))
    assert "ReadSchema: struct<l_quantity:double,l_discount:double>" in plan


def test_range_partition_by_id(spark):
    out = jobs.range_partitioned_max(lines(spark, ["0,t,Abba,1", "0,t,Zed,2"]), parts_per_bucket=1)
    plan = _plan(out)
    assert "Exchange" in plan and "bucket" in plan


def test_reducer_output_sorted_without_extra_exchange(spark):
    recs = ["a 1999 1 10", "b 2000 1 20", "nu 2001 1 5", "nuk 1998 1 7"]
    out = jobs.ngram_substring_mean(lines(spark, recs).repartition(3), lines(spark, ["nu x 1997 1 3"]), substrings=("nu",))
    plan = _plan(out)
    assert plan.count("Exchange") == 2  # the repartition above, and the aggregation's own
    assert "Sort [tag_key" in plan
    parts = out.rdd.glom().map(lambda rs: [r["tag_key"] for r in rs]).collect()
    assert all(p == sorted(p) for p in parts)


def test_registered_map_only_queries_do_not_shuffle_their_input(spark):
    from statforge.plans.queries import QUERIES

    for name in ("year_range_project", "row_subset", "standardise", "cluster_assign"):
        plan = _plan(QUERIES[name](spark, SF))
        assert "RoundRobinPartitioning" not in plan and "Exchange" not in plan, name


def test_each_line_is_split_once(spark):
    from statforge.plans.queries import QUERIES

    for name in ("header_skip", "text_roundtrip", "standardise", "cluster_assign", "row_subset", "csv_flag_mean"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1, name
