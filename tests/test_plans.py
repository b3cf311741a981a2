"""Plan shape: pruned scans, one exchange per ordered operator, split only for hot keys."""

import uuid

from roadlens.operators.speed_radar import speed_radar
from roadlens.operators.stopped import accident_reporter, stopped_sliding
from roadlens.session import checkpoint_root
from roadlens.sources.events_view import load_reports
from roadlens.sources.reports import read_reports
from tests.util import SPLIT_ALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark, smoke_dir):
    plan = _plan(speed_radar(load_reports(spark, smoke_dir)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    assert "props" not in plan and "event_type" not in plan


def test_plain_plan_without_hot_keys(spark, smoke_dir):
    plan = _plan(accident_reporter(load_reports(spark, smoke_dir)))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan
    # the view's exchange on user_id is reused by the vehicle window (vid = user_id)
    assert plan.count("Exchange hashpartitioning") == 1


def test_split_plan_for_hot_keys(spark, smoke_dir):
    reports = load_reports(spark, smoke_dir)
    plan = _plan(speed_radar(reports, policy=SPLIT_ALL))
    assert "BroadcastHashJoin" in plan  # the bounded hot-key table
    assert "_blk" in plan  # windows partitioned by (vid, block)


def _formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_parquet_input_pushdown_and_pruning(spark, smoke_dir):
    from roadlens.operators.speed_control import average_speed_control
    from roadlens.plans.jobs import stage_reports

    staged = stage_reports(spark, load_reports(spark, smoke_dir))
    q1 = _formatted(speed_radar(staged))
    assert "GreaterThan(speed,90)" in q1
    assert "ReadSchema: struct<seq:bigint,time:int,vid:bigint,speed:int,xway:int,dir:int,seg:int>" in q1
    folder = f"{checkpoint_root(spark)}/without-seq-{uuid.uuid4().hex}"
    staged.drop("seq").write.parquet(folder)
    assert "GreaterThan(speed,90)" in _formatted(speed_radar(read_reports(spark, folder, parser="parquet")))
    q2 = _formatted(average_speed_control(staged))
    assert "GreaterThanOrEqual(seg,52)" in q2 and "LessThanOrEqual(seg,56)" in q2
    assert "lane" not in q2.split("ReadSchema:")[1].split("\n")[0]
    q3 = _formatted(accident_reporter(staged))
    assert "speed" not in q3.split("ReadSchema:")[1].split("\n")[0]


def test_fold_is_evaluated_once(spark, smoke_dir):
    from roadlens.operators.speed_control import average_speed_control
    from roadlens.sources.events_view import mixed_reports

    plan = _plan(average_speed_control(mixed_reports(load_reports(spark, smoke_dir))))
    assert plan.count("sort_array") == 1


def test_sliding_variant_does_not_shuffle_the_view_again(spark, smoke_dir):
    plan = _plan(stopped_sliding(load_reports(spark, smoke_dir, clock="cadence"), time_unit="s"))
    assert plan.count("Exchange hashpartitioning") == 1
