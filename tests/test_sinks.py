"""Table sinks and fan-out in a temporary warehouse."""

from __future__ import annotations

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

SPARK_ERRORS = (PySparkException, Py4JJavaError)
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from disclosure.plans.job import TableSink, run
from disclosure.sinks import tables as T


@pytest.fixture()
def nine(spark):
    return spark.range(9).select(F.col("id").cast("string").alias("LoanNumber"), (F.col("id") * 1.5).alias("Amount"))


def test_overwrite_replaces_schema(spark, nine):
    T.overwrite_table(nine, "t_over")
    T.overwrite_table(nine.select("LoanNumber"), "t_over")
    assert spark.table("t_over").columns == ["LoanNumber"]
    assert spark.table("t_over").count() == 9


def test_append_twice_and_name_check(spark, nine):
    T.append_table(nine, "t_app")
    T.append_table(nine, "t_app", partitions=3)
    assert spark.table("t_app").count() == 18
    with pytest.raises(SPARK_ERRORS):
        T.append_table(nine.withColumnRenamed("Amount", "Other"), "t_app")


def test_clear_and_append_keeps_schema(spark, nine):
    assert T.clear_and_append(nine, "t_ref") is True
    wider = nine.withColumn("Extra", F.lit("x"))
    with pytest.raises(ValueError, match="Extra"):
        T.clear_and_append(wider, "t_ref")
    assert T.clear_and_append(wider.limit(4), "t_ref", ignore=["Extra"]) is False
    t = spark.table("t_ref")
    assert t.columns == ["LoanNumber", "Amount"] and t.count() == 4
    with pytest.raises(ValueError, match="Amount"):
        T.clear_and_append(nine.select("LoanNumber"), "t_ref")
    assert spark.table("t_ref").count() == 4


def _failing(df):
    """The same rows, but the task that meets the last one fails, after others were written."""
    bad = F.when(F.col("LoanNumber") == "8", F.raise_error(F.lit("mid-write"))).otherwise(F.col("LoanNumber"))
    return df.repartition(4).withColumn("LoanNumber", bad.cast("string"))


@pytest.mark.parametrize("refresh", [T.overwrite_table, T.clear_and_append, T.replace_table])
@pytest.mark.parametrize("with_path", [False, True])
def test_failed_refresh_keeps_the_published_rows(spark, nine, tmp_dir, refresh, with_path):
    import os

    name = f"t_fail_{refresh.__name__}_{with_path}"
    path = os.path.join(tmp_dir, name) if with_path else None
    refresh(nine, name, path=path)
    for _ in range(2):
        with pytest.raises(SPARK_ERRORS):
            refresh(_failing(nine), name, path=path)
        assert sorted(r.LoanNumber for r in spark.table(name).collect()) == [str(i) for i in range(9)]
    # an empty refresh is a refresh; only this and the previous version are kept
    for n in (3, 2, 0):
        refresh(nine.limit(n), name, path=path)
        assert spark.table(name).count() == n
    if with_path:
        assert len(os.listdir(path)) == 2
    T.append_table(nine, name)
    assert spark.table(name).count() == 9


def test_failed_first_write_and_failed_second_sink(spark, nine):
    with pytest.raises(SPARK_ERRORS):
        T.overwrite_table(_failing(nine), "t_never")
    assert not spark.catalog.tableExists("t_never")
    T.overwrite_table(nine, "t_two_a")
    T.overwrite_table(nine, "t_two_b")

    def boom(df):
        raise RuntimeError("sink down")

    with pytest.raises(RuntimeError):
        T.fan_out(nine.limit(5), [TableSink("t_two_a"), boom, TableSink("t_two_b")])
    assert spark.table("t_two_a").count() == 5 and spark.table("t_two_b").count() == 9


def test_refresh_takes_over_a_managed_table(spark, nine):
    nine.write.saveAsTable("t_managed")
    T.overwrite_table(nine.limit(2), "t_managed")
    assert spark.table("t_managed").count() == 2
    T.overwrite_table(nine.withColumn("More", F.lit(1)), "t_managed")
    assert spark.table("t_managed").columns == ["LoanNumber", "Amount", "More"]


def test_create_if_missing(spark, nine):
    assert T.create_if_missing(spark, "t_new", nine.schema) is True
    assert T.create_if_missing(spark, "t_new", nine.schema) is False
    assert spark.table("t_new").count() == 0
    bad = StructType([StructField("m", MapType(StringType(), StringType()))])
    assert T.create_if_missing(spark, "t_new", bad) is False  # an existing table is left alone
    for create in (lambda: T.create_if_missing(spark, "t_bad", bad), lambda: T.clear_and_append(spark.createDataFrame([], bad), "t_bad")):
        with pytest.raises(ValueError):
            create()
    assert not spark.catalog.tableExists("t_bad")
    assert T.create_if_missing(spark, "t_any", bad, store_types=False) is True
    with pytest.raises(ValueError):
        T.create_if_missing(spark, "bad-name", nine.schema)
    with pytest.raises(ValueError):
        T.validate_table_name("x\n")


def test_store_column_types(nine):
    assert T.store_column_types(nine.schema) == [("LoanNumber", "string"), ("Amount", "real")]


def test_replace_table(spark, nine):
    T.overwrite_table(nine.select("LoanNumber"), "t_swap")
    assert T.replace_table(nine, "t_swap") == 9
    assert spark.table("t_swap").columns == ["LoanNumber", "Amount"]
    assert T.replace_table(nine.limit(0), "t_swap") == 0
    assert spark.table("t_swap").count() == 0


@pytest.mark.parametrize("strategy", ["auto", "stage", "cache"])
def test_fan_out(spark, nine, strategy):
    a, b = f"t_fa_{strategy}", f"t_fb_{strategy}"
    T.fan_out(nine, [TableSink(a), TableSink(b, mode="clear_and_append")], strategy=strategy)
    assert spark.table(a).count() == 9 and spark.table(b).count() == 9
    c, d = f"t_fc_{strategy}", f"t_fd_{strategy}"
    T.append_table(nine, c)
    T.fan_out(nine, [TableSink(c, mode="append"), TableSink(d)], strategy=strategy)
    assert spark.table(c).count() == 18 and spark.table(d).count() == 9


def test_fan_out_unpersists_when_a_sink_fails(spark, nine):
    def boom(df):
        raise RuntimeError("sink down")

    with pytest.raises(RuntimeError):
        T.fan_out(nine, [TableSink("t_fc"), boom], strategy="cache")
    assert not nine.is_cached


def test_run_validates_targets_first(spark):
    with pytest.raises(ValueError):
        run(spark, "/nonexistent/folder", sinks=[TableSink("bad name")])


def test_writer_options_reach_the_files(spark, nine, tmp_dir):
    import glob
    import os

    path = os.path.join(tmp_dir, "t_opts")
    TableSink("t_opts", path=path, options={"compression": "gzip"})(nine)
    assert glob.glob(os.path.join(path, "*", "*.gz.parquet"))
    assert spark.table("t_opts").count() == 9


def test_sorted_files_let_lookups_skip_row_groups(spark, tmp_dir):
    import glob
    import os

    import pyarrow.parquet as pq

    df = spark.range(200000).select(F.format_string("%07d", (F.col("id") * 7919) % 200000).alias("LoanNumber"))
    path = os.path.join(tmp_dir, "t_sorted")
    TableSink("t_sorted", path=path, sort_within=("LoanNumber",),
              options={"parquet.block.size": "65536"})(df.repartition(2))
    for f in glob.glob(os.path.join(path, "*", "*.parquet")):
        meta = pq.ParquetFile(f).metadata
        assert meta.num_row_groups > 1
        ranges = [(meta.row_group(i).column(0).statistics.min, meta.row_group(i).column(0).statistics.max)
                  for i in range(meta.num_row_groups)]
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))  # disjoint, ascending
    assert spark.table("t_sorted").filter(F.col("LoanNumber") == "0000000").count() == 1


def test_run_rejects_duplicate_targets(spark):
    with pytest.raises(ValueError):
        run(spark, "/nonexistent/folder", sinks=[TableSink("t_dup"), TableSink("T_DUP", mode="append")])


def test_connector_sink_appends_through_save(spark, nine, tmp_dir):
    import os

    from disclosure.plans.job import ConnectorSink

    target = os.path.join(tmp_dir, "store")
    sink = ConnectorSink("parquet", {"path": target}, partitions=3)
    sink.validate()
    sink(nine)
    sink(nine)
    assert spark.read.parquet(target).count() == 18
    with pytest.raises(ValueError):
        ConnectorSink("parquet", {"path": target}, mode="merge").validate()
    T.fan_out(nine, [TableSink("t_conn_first"), ConnectorSink("parquet", {"path": target})])
    assert spark.read.parquet(target).count() == 27


def test_bloom_filter_option_for_key_lookups(spark, tmp_dir):
    import os

    df = spark.range(50000).select(F.format_string("%07d", F.col("id")).alias("LoanNumber"), F.col("id"))
    path = os.path.join(tmp_dir, "t_bloom")
    TableSink("t_bloom", path=path, options={"parquet.bloom.filter.enabled#LoanNumber": "true"})(df)
    hit = spark.table("t_bloom").filter(F.col("LoanNumber") == "0012345")
    assert [r["id"] for r in hit.collect()] == [12345]
    assert spark.table("t_bloom").filter(F.col("LoanNumber") == "missing").count() == 0


# ---------------------------------------------------------------- refreshes that overlap, batches


def _meanwhile(spark, monkeypatch, action):
    """Runs ``action`` once, after a refresh has written its version and before it is published."""
    real, done = T._claim, []

    def claim(*args):
        if not done:
            done.append(1)
            action()
        return real(*args)

    monkeypatch.setattr(T, "_claim", claim)


@pytest.mark.parametrize("refresh", [T.overwrite_table, T.clear_and_append, T.replace_table])
def test_overlapping_refresh_loses_and_the_winners_rows_stay(spark, nine, tmp_dir, monkeypatch, refresh):
    name = f"t_overlap_{refresh.__name__}"
    path = f"{tmp_dir}/{name}"
    T.overwrite_table(nine, name, path=path)
    _meanwhile(spark, monkeypatch, lambda: T.overwrite_table(nine.limit(4), name, path=path))
    with pytest.raises(T.ConcurrentRefresh):
        refresh(nine.limit(2), name, path=path)
    assert spark.table(name).count() == 4
    monkeypatch.undo()
    refresh(nine.limit(3), name, path=path)  # a later refresh is not held up
    assert spark.table(name).count() == 3


def test_overlapping_refresh_with_retries_is_written_on_top(spark, nine, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t_retry"
    T.overwrite_table(nine, "t_retry", path=path)
    _meanwhile(spark, monkeypatch, lambda: T.overwrite_table(nine.limit(4), "t_retry", path=path))
    T.overwrite_table(nine.limit(2), "t_retry", path=path, retries=1)
    assert spark.table("t_retry").count() == 2


def test_refresh_published_between_claim_and_repoint_or_clean_up_stays(spark, nine, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t_between"
    T.overwrite_table(nine, "t_between", path=path)
    for step in ("_point_at_newest", "_remove_old"):
        real, done = getattr(T, step), []

        def later(*args, real=real, done=done):
            if not done:
                done.append(1)
                T.overwrite_table(nine.limit(4), "t_between", path=path)
            return real(*args)

        monkeypatch.setattr(T, step, later)
        T.overwrite_table(nine.limit(2), "t_between", path=path)
        monkeypatch.undo()
        assert spark.table("t_between").count() == 4  # the later generation, whichever came last


def test_folder_being_written_is_not_removed_and_an_old_one_is(spark, nine, tmp_dir):
    import os

    path = f"{tmp_dir}/t_retention"
    T.overwrite_table(nine, "t_retention", path=path)
    for folder, age in (("version-young", 0), ("version-old", 8 * 24 * 3600)):
        nine.write.parquet(f"{path}/{folder}")
        then = os.stat(f"{path}/{folder}").st_mtime - age
        os.utime(f"{path}/{folder}", (then, then))
    T.overwrite_table(nine, "t_retention", path=path)
    names = os.listdir(path)
    assert "version-young" in names and "version-old" not in names


def test_table_named_next_is_left_alone(spark, nine):
    spark.sql("DROP TABLE IF EXISTS t_schema__next")
    nine.write.saveAsTable("t_schema__next")
    T.overwrite_table(nine, "t_schema")
    T.overwrite_table(nine.select("LoanNumber"), "t_schema")
    assert spark.table("t_schema").columns == ["LoanNumber"]
    assert spark.table("t_schema__next").count() == 9


def test_failing_rename_keeps_the_old_entry(spark, nine, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t_rename"
    T.overwrite_table(nine, "t_rename", path=path)
    real = type(spark).sql

    def sql(self, text, *args, **kwargs):
        if "RENAME TO" in text:
            raise RuntimeError("rename failed")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.raises(RuntimeError, match="rename failed"):
        T.overwrite_table(nine.select("LoanNumber"), "t_rename", path=path)
    monkeypatch.undo()
    assert spark.table("t_rename").columns == ["LoanNumber", "Amount"] and spark.table("t_rename").count() == 9
    assert [t.name for t in spark.catalog.listTables() if "t_rename__next" in t.name] == []
    T.overwrite_table(nine.select("LoanNumber"), "t_rename", path=path)
    assert spark.table("t_rename").columns == ["LoanNumber"]


def test_job_that_ended_after_taking_a_generation_blocks_nobody(spark, nine, tmp_dir):
    from disclosure.session import create_exclusively

    path = f"{tmp_dir}/t_ended"
    T.overwrite_table(nine, "t_ended", path=path)
    assert create_exclusively(spark, f"{path}__commits/{2:012d}")
    T.overwrite_table(nine.limit(5), "t_ended", path=path)
    assert spark.table("t_ended").count() == 5


def test_append_after_refresh_with_path(spark, nine, tmp_dir):
    path = f"{tmp_dir}/t_mixed"
    T.overwrite_table(nine, "t_mixed", path=path)
    TableSink("t_mixed", mode="append", path=path)(nine)
    assert spark.table("t_mixed").count() == 18
    T.overwrite_table(nine, "t_mixed", path=path)
    T.append_table(nine.limit(1), "t_mixed", path=path + "/")
    assert spark.table("t_mixed").count() == 10
    with pytest.raises(SPARK_ERRORS):
        T.append_table(nine, "t_mixed", path=f"{tmp_dir}/elsewhere")


@pytest.mark.parametrize("refreshed", [False, True])
def test_batch_is_appended_once(spark, nine, tmp_dir, refreshed):
    name = f"t_batch_{refreshed}"
    path = f"{tmp_dir}/{name}"
    if refreshed:
        T.overwrite_table(nine.limit(1), name, path=path)
    start = 1 if refreshed else 0
    assert T.append_table(nine, name, path=path, batch="2024-01-01") is True
    assert T.append_table(nine, name, path=path, batch="2024-01-01") is False
    assert T.append_table(nine.limit(2), name, path=path, batch="2024-01-02", partitions=2) is True
    assert spark.table(name).count() == start + 11
    with pytest.raises(ValueError, match="batch name"):
        T.append_table(nine, name, path=path, batch="../x")
    with pytest.raises(ValueError, match="Columns"):
        T.append_table(nine.select("LoanNumber"), name, path=path, batch="b")


def test_batch_repeated_after_a_failure_counts_once(spark, nine, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t_batch_fail"
    T.append_table(nine.limit(2), "t_batch_fail", path=path, batch="a")
    with pytest.raises(SPARK_ERRORS):
        T.append_table(_failing(nine), "t_batch_fail", path=path, batch="b")
    assert spark.table("t_batch_fail").count() == 2

    def ended(*args):
        raise RuntimeError("ended")

    monkeypatch.setattr(T, "create_exclusively", ended)  # all files are there, the record is not
    with pytest.raises(RuntimeError, match="ended"):
        T.append_table(nine, "t_batch_fail", path=path, batch="b", partitions=3)
    monkeypatch.undo()
    assert T.append_table(nine, "t_batch_fail", path=path, batch="b") is True
    assert spark.table("t_batch_fail").count() == 11


# ---------------------------------------------------------------- a run that goes on where it stopped


class _Sink:
    def __init__(self, table, fail=0):
        self.table, self.fail, self.calls, self.rows = table, fail, 0, None

    def __call__(self, df):
        self.calls += 1
        if self.calls <= self.fail:
            raise RuntimeError("sink failed")
        self.rows = sorted(r.LoanNumber for r in df.collect())


def test_repeated_fan_out_skips_finished_sinks_and_reads_the_staged_rows(spark, nine, tmp_dir):
    import os

    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source = nine.mapInArrow(count, nine.schema)
    journal = f"{tmp_dir}/journal"
    sinks = [_Sink("a"), _Sink("b", fail=1), _Sink("c")]
    with pytest.raises(RuntimeError, match="sink failed"):
        T.fan_out(source, sinks, journal=journal)
    assert [s.calls for s in sinks] == [1, 1, 0]
    T.fan_out(source, sinks, journal=journal)
    assert [s.calls for s in sinks] == [1, 2, 1] and reads.value == 9
    assert all(s.rows == [str(i) for i in range(9)] for s in sinks)
    assert not os.path.exists(journal)
    T.fan_out(source, sinks, journal=journal)  # a new run
    assert [s.calls for s in sinks] == [2, 3, 2]


def test_repeated_run_appends_once(spark, tmp_dir, monkeypatch):
    from disclosure.schema import LOAN_COLUMNS

    with open(f"{tmp_dir}/loans.csv", "w") as f:
        f.write("\n".join([",".join(LOAN_COLUMNS), *[",".join([str(i)] + [""] * (len(LOAN_COLUMNS) - 1)) for i in range(5)]]) + "\n")
    boom = _Sink("later", fail=1)
    boom.validate = lambda: None
    sinks = [TableSink("t_run_once", mode="append", path=f"{tmp_dir}/once"), boom]
    for _ in range(2):
        try:
            run(spark, f"{tmp_dir}/loans.csv", sinks=sinks, journal=f"{tmp_dir}/journals")
        except RuntimeError:
            pass
    assert spark.table("t_run_once").count() == 5 and boom.calls == 2
    run(spark, f"{tmp_dir}/loans.csv", sinks=sinks[:1], journal=f"{tmp_dir}/journals")  # the same files again
    assert spark.table("t_run_once").count() == 5
