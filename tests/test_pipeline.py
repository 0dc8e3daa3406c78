"""Load, consolidation and the batch / streaming daily jobs on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from tallyspark.config import DEFAULT
from tallyspark.operators import consolidate, load
from tallyspark.plans import catalog, synth
from tallyspark.plans.consolidate import run_consolidate
from tallyspark.plans.daily import DailyPaths, run_daily
from tallyspark.plans.joins import materialize
from tallyspark.session import scratch_path
from tallyspark.sources import statements, versions
from tallyspark.streaming.daily import run_daily_stream, start_daily_stream

SF = "/root/testdata/sf0.001"


def paths(spark, inbox):
    return DailyPaths(inbox=inbox, months=scratch_path(spark, "m"), rejects=scratch_path(spark, "r"),
                      runs=scratch_path(spark, "runs"), processed=scratch_path(spark, "p"))


@pytest.fixture(scope="module")
def inbox(spark):
    p = scratch_path(spark, "inbox")
    synth.write_statement_files(synth.read_table(spark, SF, "lineitem"), DEFAULT, p)
    return p


def test_second_identical_load_appends_nothing(spark):
    batch = catalog.batch_with_month(spark, SF).drop("file_name", "line_no")
    base = scratch_path(spark, "months")
    first = load.route(batch, base)
    second = load.route(batch, base)
    assert first.delta == batch.count() and second.delta == 0
    assert spark.read.parquet(base).count() == batch.count()


def test_two_month_batch_one_appends_one_fresh(spark):
    batch = catalog.batch_with_month(spark, SF).drop("file_name", "line_no")
    months = load.batch_months(batch)
    base = scratch_path(spark, "months")
    load.route(batch.filter(F.col("month") == months[0]), base)
    two = batch.filter(F.col("month").isin(months[0], months[1]))
    res = load.route(two, base)
    assert res.delta == two.filter(F.col("month") == months[1]).count()


def test_guard_stops_run_and_reports_failure(spark, inbox):
    p = paths(spark, inbox)
    with pytest.raises(RuntimeError):
        run_daily(spark, DEFAULT, p)                 # default limit: 2 files
    runs = spark.read.parquet(p.runs).collect()
    assert [r.status for r in runs] == ["FAILURE"]


def test_daily_then_consolidate(spark, inbox):
    p = paths(spark, inbox)
    res = run_daily(spark, DEFAULT, p, max_files=1000)
    assert res.delta == res.rows and res.rejects > 0
    again = run_daily(spark, DEFAULT, p, max_files=1000)   # processed files are skipped
    assert again.rows == 0
    master = scratch_path(spark, "master")
    c = run_consolidate(spark, DEFAULT, p.months, master, p.runs)
    m = versions.read(spark, master)
    assert m.count() == m.select("uuid").distinct().count() == c.rows_after
    assert c.duplicates_removed == res.rows - c.rows_after
    statuses = [r.status for r in spark.read.parquet(p.runs).collect()]
    assert statuses.count("SUCCESS") == 3


def test_streaming_available_now_matches_batch(spark, inbox):
    # a private copy of the inbox: the stream archives (moves) the files it finished
    own = scratch_path(spark, "inbox")
    synth.write_statement_files(synth.read_table(spark, SF, "lineitem"), DEFAULT, own)
    p = paths(spark, own)
    archive_dir = scratch_path(spark, "archived")
    q = start_daily_stream(spark, DEFAULT, p, scratch_path(spark, "ckpt"), max_files_per_trigger=1,
                           archive_dir=archive_dir)
    q.awaitTermination(600)
    assert q.exception() is None
    streamed = spark.read.parquet(p.months)
    batch = catalog.batch_with_month(spark, SF)
    assert streamed.count() == batch.count()
    assert streamed.select("uuid").subtract(batch.select("uuid")).count() == 0
    # files of all but the last micro-batch have been moved to the archive
    archived = spark.read.text(archive_dir, wholetext=True).count() if os.path.exists(
        archive_dir.replace("file:", "")) else 0
    assert archived >= 1


def test_dedup_keeps_latest_month(spark):
    rows = [("k1", "2026-04", 1), ("k1", "2026-05", 2), ("k2", "2026-04", 3)]
    df = spark.createDataFrame(rows, "uuid string, source_month string, v int")
    got = {r.uuid: (r.source_month, r.v) for r in consolidate.deduplicate(df).collect()}
    assert got == {"k1": ("2026-05", 2), "k2": ("2026-04", 3)}


def test_listing_newest_first(spark, inbox):
    listing = statements.list_statements(spark, inbox).collect()
    mods = [r.modified for r in listing]
    assert mods == sorted(mods, reverse=True) and len(listing) > 2


def test_write_fresh_replaces_only_present_months(spark):
    batch = catalog.batch_with_month(spark, SF).drop("file_name", "line_no")
    months = load.batch_months(batch)
    base = scratch_path(spark, "months")
    load.write_fresh(batch, base)
    one = batch.filter(F.col("month") == months[0]).limit(1)
    load.write_fresh(one, base)                            # S8: that month now holds one row
    after = spark.read.parquet(base)
    assert after.filter(F.col("month") == months[0]).count() == 1
    assert after.filter(F.col("month") != months[0]).count() == batch.filter(F.col("month") != months[0]).count()


def test_empty_batch_touches_nothing_and_consolidation_reports(spark):
    batch = catalog.batch_with_month(spark, SF).drop("file_name", "line_no").limit(0)
    base = scratch_path(spark, "months")
    res = load.route(batch, base)
    assert res.delta == 0 and res.months == []
    runs = scratch_path(spark, "runs")
    with pytest.raises(ValueError):
        run_consolidate(spark, DEFAULT, base, scratch_path(spark, "master"), runs)
    assert [r.status for r in spark.read.parquet(runs).collect()] == ["FAILURE"]


def _write(folder, name, lines, **kw):
    import gzip
    data = ("\n".join(lines) + "\n").encode()
    (folder / name).write_bytes(gzip.compress(data)[:20] if kw.get("broken") else data)


def _axis(*rows):
    return [f"preamble {i}" for i in range(17)] + ["Tran Date,CHQNO,PARTICULARS,DR,CR,BAL"] + [
        f"01-04-2026,,UPI/{i}/payee/P2A/food,{amount},,5.00" for i, amount in rows]


def test_redelivered_file_bad_files_and_rejects(spark, tmp_path):
    """A file of an old name is new; files without a header are rejects; nothing vanishes."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    p = paths(spark, str(inbox))
    p.archive_dir = str(tmp_path / "archive")
    _write(inbox, "axis_statement.csv", _axis((1, "10.00"), (2, "abc")))
    _write(inbox, "axis_short.csv", ["only", "two"])
    _write(inbox, "axis_empty.csv", [])
    _write(inbox, "axis_broken.csv.gz", _axis((9, "1.00")), broken=True)
    _write(inbox, "notes.md", ["not a statement"])
    import dataclasses
    settings = dataclasses.replace(DEFAULT, file_glob="*.{csv,csv.gz}")
    one = run_daily(spark, settings, p, max_files=10)
    assert (one.files, one.rows, one.delta, one.banks) == (4, 1, 1, 1)
    reasons = [r.reason for r in spark.read.parquet(p.rejects).collect()]
    assert sorted(reasons) == ["bad_amount", "no_header", "no_header", "no_header"]
    assert sorted(f.name for f in inbox.iterdir() if not f.name.startswith(".")) == ["notes.md"]
    _write(inbox, "axis_statement.csv", _axis((3, "10.00"), (4, "x"), (5, "y")))
    two = run_daily(spark, settings, p, max_files=10)
    assert (two.files, two.rows, two.delta, two.rejects) == (1, 1, 1, 2)
    assert spark.read.parquet(p.months).count() == 2 and spark.read.parquet(p.rejects).count() == 6
    assert [r.groups for r in spark.read.parquet(p.runs).collect()] == [1, 1]


def test_lines_are_numbered_over_splits_and_scratch_goes(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    rows = [(i, "10.00" if i % 50 else "bad") for i in range(3000)]
    _write(inbox, "axis_long.csv", _axis(*rows))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        p = paths(spark, str(inbox))
        from tallyspark.session import ensure_checkpoint_dir
        root = os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "tables")
        before = set(os.listdir(root)) if os.path.isdir(root) else set()
        res = run_daily(spark, DEFAULT, p, max_files=1)
        left = set(os.listdir(root)) - before
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert res.rows == 2940 and res.rejects == 60
    got = sorted(r.line_no for r in spark.read.parquet(p.rejects).collect())
    assert got == [18 + i for i in range(0, 3000, 50)]
    assert left <= {os.path.basename(x) for x in (p.months, p.rejects, p.runs, p.processed)}


def test_lines_keep_their_numbers_when_the_listing_is_not_broadcast(spark, tmp_path, monkeypatch):
    from tallyspark.plans import joins
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for k in range(3):
        _write(inbox, f"axis_{k}.csv", _axis(*((i, "10.00" if i % 50 else "bad") for i in range(3000))))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().conf()
    spill = "spark.shuffle.spill.numElementsForceSpillThreshold"
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    env.set(spill, "100")
    try:
        p = paths(spark, str(inbox))
        res = run_daily(spark, DEFAULT, p, max_files=3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        env.remove(spill)
    assert res.rejects == 180 and res.rows == 3 * 2940
    got = sorted(r.line_no for r in spark.read.parquet(p.rejects).collect())
    assert got == sorted(3 * [18 + i for i in range(0, 3000, 50)])


def test_stream_is_one_run_by_default_and_reports(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    _write(inbox, "axis_a.csv", _axis((1, "10.00"), (2, "11.00")))
    _write(inbox, "axis_b.csv", _axis((1, "10.00"), (3, "12.00")))
    batch, stream = paths(spark, str(inbox)), paths(spark, str(inbox))
    run_daily(spark, DEFAULT, batch)
    start_daily_stream(spark, DEFAULT, stream, str(tmp_path / "ckpt")).awaitTermination(300)
    rows = lambda p: sorted(r.particulars for r in spark.read.parquet(p.months).collect())
    assert rows(stream) == rows(batch) and len(rows(batch)) == 4
    assert [(r.status, r.rows, r.groups) for r in spark.read.parquet(stream.runs).collect()] == [("SUCCESS", 4, 1)]


def test_consolidation_without_rows_leaves_the_old_master(spark):
    batch = catalog.batch_with_month(spark, SF).drop("file_name", "line_no")
    months, master, runs = (scratch_path(spark, x) for x in ("months", "master", "runs"))
    load.route(batch, months)
    done = run_consolidate(spark, DEFAULT, months, master, runs)
    empty = scratch_path(spark, "months")
    batch.limit(0).withColumn("month", F.lit("2026-01")).write.parquet(f"{empty}/month=2026-01")
    with pytest.raises(ValueError):
        run_consolidate(spark, DEFAULT, empty, master, runs)
    kept = versions.read(spark, master)
    assert kept.count() == done.rows_after > 0
    rows = [(r.date, r.uuid) for r in consolidate.sort_master(kept).collect()]
    assert rows == sorted(rows)                                            # O1


def test_key_prefix_collision_drops_no_row(spark):
    import datetime as dt
    from decimal import Decimal
    schema = "uuid string, source_month string, month string, date date, particulars string, dr decimal(18,2), cr decimal(18,2)"
    a = ("same", "2026-04", "2026-04", dt.date(2026, 4, 1), "a", Decimal("1.00"), None)
    b = ("same", "2026-04", "2026-04", dt.date(2026, 4, 1), "b", Decimal("1.00"), None)
    df = spark.createDataFrame([a, b, a], schema)
    assert sorted(r.particulars for r in consolidate.deduplicate(df).collect()) == ["a", "b"]
    new, old = spark.createDataFrame([a, b], schema), spark.createDataFrame([a], schema)
    assert [r.particulars for r in load.anti_join(new, old).collect()] == ["b"]


def _rejects(spark, p):
    return sorted((r.file, r.line_no, r.reason) for r in spark.read.parquet(p.rejects).collect())


def test_stream_and_batch_answer_for_empty_corrupt_and_short_files(spark, tmp_path):
    import dataclasses
    settings = dataclasses.replace(DEFAULT, file_glob="*.{csv,csv.gz}")
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    _write(inbox, "axis_statement.csv", _axis((1, "10.00"), (2, "abc")))
    _write(inbox, "axis_short.csv", ["only", "two"])
    _write(inbox, "axis_broken.csv.gz", _axis((9, "1.00")), broken=True)
    (inbox / "hdfc zero bytes.csv").write_bytes(b"")
    (inbox / "axis_zero.csv").write_bytes(b"")
    listed = {r.file_name: (r.size, r.modified) for r in statements.list_statements(spark, str(inbox), settings.file_glob).collect()}
    assert len(listed) == 5 and listed["axis_zero.csv"][0] == listed["hdfc zero bytes.csv"][0] == 0
    assert all(abs(m.timestamp() - os.path.getmtime(inbox / n.replace("%20", " "))) < 1 for n, (_, m) in listed.items())
    batch, stream = paths(spark, str(inbox)), paths(spark, str(inbox))
    one = run_daily(spark, settings, batch, max_files=10)
    assert (one.files, one.rows, one.rejects) == (5, 1, 5)
    settled = run_daily_stream(spark, settings, stream, str(tmp_path / "ckpt"), max_files_per_trigger=1)
    assert _rejects(spark, stream) == _rejects(spark, batch)
    assert [r for _, _, r in _rejects(spark, batch)].count("no_header") == 4
    assert settled.files >= 2                                             # the empty ones are in no micro-batch
    done = lambda p: sorted(r.file_name for r in spark.read.parquet(p.processed).collect())
    assert len(done(batch)) == 5 and {x.replace("%20", " ") for x in done(stream)} == {x.replace("%20", " ") for x in done(batch)}
    # nothing twice, and a later empty file is answered for
    assert run_daily(spark, settings, batch, max_files=10).rejects == 0
    assert run_daily_stream(spark, settings, stream, str(tmp_path / "ckpt")) is None
    (inbox / "axis_later.csv").write_bytes(b"")
    assert run_daily(spark, settings, batch, max_files=10).rejects == 1
    assert run_daily_stream(spark, settings, stream, str(tmp_path / "ckpt")).rejects == 1
    assert _rejects(spark, stream) == _rejects(spark, batch)


def test_drain_loads_all_micro_batches_at_once(spark, tmp_path, monkeypatch):
    import json
    from tallyspark.streaming import daily
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for at, (name, rows) in enumerate({"axis_a.csv": ((1, "10.00"), (1, "10.00"), (2, "abc")), "axis_b.csv": ((1, "10.00"), (3, "12.00")),
                                       "axis_c.csv": ((4, "13.00"),)}.items()):
        _write(inbox, name, _axis(*rows))
        os.utime(inbox / name, (1_700_000_000 + at, 1_700_000_000 + at))
    p, ckpt = paths(spark, str(inbox)), str(tmp_path / "ckpt")

    def lost(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(daily, "load_landed", lost)
        with pytest.raises(RuntimeError, match="lost"):
            run_daily_stream(spark, DEFAULT, p, ckpt, max_files_per_trigger=1)
    run_daily_stream(spark, DEFAULT, p, ckpt, max_files_per_trigger=1)           # what has landed is not lost
    run_daily_stream(spark, DEFAULT, p, ckpt, max_files_per_trigger=1)
    rows = spark.read.parquet(p.months)
    assert sorted(str(r.dr) for r in rows.collect()) == ["10.00", "10.00", "12.00", "13.00"]    # J1: the second file's first row is known
    assert len({f for f in rows.inputFiles()}) == rows.select("month").distinct().count()       # one append, not one a micro-batch
    assert [x[2] for x in _rejects(spark, p)] == ["bad_amount"]
    runs = sorted((r.rows, r.groups, json.loads(r.details)["delta"], json.loads(r.details)["files"], json.loads(r.details)["rejects"])
                  for r in spark.read.parquet(p.runs).filter("status = 'SUCCESS'").collect())
    assert runs == [(1, 1, 1, 1, 0), (2, 1, 1, 1, 0), (2, 1, 2, 1, 1)]
    assert spark.read.parquet(p.processed).count() == 3


def test_a_drain_writes_micro_batches_at_a_time_and_reads_lost_ones(spark, tmp_path, monkeypatch):
    import threading
    from tallyspark.streaming import daily
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for i in range(6):
        _write(inbox, f"axis_{i}.csv", _axis((i + 1, "10.00")))
        os.utime(inbox / f"axis_{i}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
    p, ckpt = paths(spark, str(inbox)), str(tmp_path / "ckpt")
    real, two, calls = daily.place, threading.Barrier(2), []

    def place(batch):
        calls.append(1)
        if len(calls) <= 2:
            two.wait(60)                                   # the first write goes on until the second one has begun
        if len(calls) > 3:
            raise RuntimeError("lost")
        return real(batch)
    with monkeypatch.context() as m:
        m.setattr(daily, "place", place)
        with pytest.raises(Exception, match="lost"):
            run_daily_stream(spark, DEFAULT, p, ckpt, max_files_per_trigger=1)
    assert not os.path.exists(p.months.removeprefix("file:"))
    # half of a write that died is not taken for landed
    real(spark.createDataFrame([], daily.LANDED_SCHEMA.rsplit(", at", 1)[0])).write.parquet(f"{ckpt}/landed/batch=77")
    run_daily_stream(spark, DEFAULT, p, ckpt, max_files_per_trigger=1)
    run_daily_stream(spark, DEFAULT, p, ckpt, max_files_per_trigger=1)
    assert sorted(r.particulars for r in spark.read.parquet(p.months).collect()) == sorted(
        r.particulars for r in _batch_rows(spark, str(inbox)))
    assert spark.read.parquet(p.processed).count() == 6 and not spark.read.parquet(p.rejects).count()


def _batch_rows(spark, inbox):
    p = paths(spark, inbox)
    run_daily(spark, DEFAULT, p, max_files=10)
    return spark.read.parquet(p.months).collect()


def test_an_inbox_of_empty_files_and_an_empty_inbox(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    p = paths(spark, str(inbox))
    assert run_daily(spark, DEFAULT, p).files == 0
    (inbox / "axis_zero.csv").write_bytes(b"")
    res = run_daily(spark, DEFAULT, p)
    assert (res.files, res.rows, res.rejects) == (1, 0, 1)


def test_header_beyond_the_first_split(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    lines = _axis(*((i, "10.00") for i in range(40)))
    lines[:17] = ["x" * 3000] * 17
    _write(inbox, "axis_wide.csv", lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        res = run_daily(spark, DEFAULT, paths(spark, str(inbox)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (res.rows, res.rejects) == (40, 0)


def test_daily_run_stages_its_input_once(spark, inbox, monkeypatch):
    from tallyspark.plans import joins
    from tallyspark import session
    names, real = [], session.scratch_path

    def noted(s, name):
        names.append(name)
        return real(s, name)
    monkeypatch.setattr(joins, "scratch_path", noted)
    run_daily(spark, DEFAULT, paths(spark, inbox), max_files=1000)
    # one table of lines; the others have a row a file, a split or a distinct value
    assert sorted(names) == ["headers", "listing", "lookup", "prepared", "splits"]


def test_pivot_columns_add_up(spark):
    import datetime as dt
    from decimal import Decimal
    from tallyspark.operators import report
    rows = [("a", dt.date(2026, 1, 1), Decimal(5)), ("a", dt.date(1980, 1, 1), Decimal(7)), ("a", None, Decimal(1)), ("b", dt.date(2026, 2, 1), Decimal(2))]
    df = spark.createDataFrame(rows, "Category string, date date, dr decimal(18,2)")
    got = {r.Category: r for r in report.month_pivot_view(df, ["2026-01", "2026-02"]).collect()}
    assert (got["a"]["2026-01"], got["a"]["2026-02"], got["a"]["other"]) == (5, None, 8)
    assert (got["b"]["2026-02"], got["b"]["other"]) == (2, None)


def test_known_rows_are_found_without_moving_all_rows(spark, monkeypatch):
    batch = catalog.batch_with_month(spark, SF).drop("file_name", "line_no")
    months = load.batch_months(batch)
    new, old = batch.filter(F.col("month") < months[40]), batch.filter(F.col("month") >= months[40])
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert load.unseen(new, old) is new                                  # no common key: nothing to join
    few = old.filter(F.col("month") == months[41]).unionByName(new)
    left = load.unseen(few, old)
    assert "strategy=broadcast" in plan(left) and left.count() == new.count()
    monkeypatch.setattr("tallyspark.plans.joins.BROADCAST_BYTES", 0)     # many known rows: the join of whole rows
    assert load.unseen(few, old).count() == new.count()


def test_many_known_rows_are_found_by_their_digests(spark, monkeypatch):
    batch = catalog.batch_with_month(spark, SF).drop("file_name", "line_no")
    batch = materialize(batch, "batch")
    half = batch.filter(F.xxhash64("uuid") % 2 == 0)
    want = sorted(r.uuid for r in load.anti_join(batch, half).collect())
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr("tallyspark.plans.joins.BROADCAST_BYTES", 0)
    for power in (28, 15, 12, 4):                          # room for all hashes, many that meet, a bitmap for the unknown ones only, none
        monkeypatch.setattr("tallyspark.plans.joins.BITMAP_POWER", power)
        assert sorted(r.uuid for r in load.unseen(batch, half, grouped=power > 4).collect()) == want, power
        again = load.unseen(batch, batch)                  # all known: no whole row is joined with the old ones
        assert "LeftAnti" not in plan(again) and again.isEmpty()


def test_rows_grouped_by_month_are_written_without_a_shuffle(spark):
    rows = {}
    for grouped in (False, True):
        batch = catalog.batch_with_month(spark, SF, grouped=grouped).drop("file_name", "line_no")
        base = scratch_path(spark, "months")
        load.route(batch, base, grouped=grouped)
        assert load.route(batch, base, grouped=grouped).delta == 0
        load.write_fresh(batch.filter("dr IS NOT NULL"), base, grouped=grouped)
        got = spark.read.parquet(base)
        rows[grouped] = sorted((r.uuid, r.month) for r in got.collect())
        months = got.select("month").distinct().count()
        assert len(got.inputFiles()) <= 3 * months
    assert rows[True] == rows[False]


def test_compaction_moves_no_row_through_a_shuffle(spark):
    base = scratch_path(spark, "months")
    rows = spark.range(400).select((F.col("id") % 2 + 1).cast("string").alias("m"), F.col("id").cast("string").alias("uuid"))
    rows = rows.select("uuid", F.concat(F.lit("2026-0"), "m").alias("month"))
    rows.repartition(8).write.partitionBy("month").parquet(base)
    made = []
    union = load.DataFrame.unionByName
    try:
        load.DataFrame.unionByName = lambda a, b, *x, **k: made.append(union(a, b, *x, **k)) or made[-1]
        assert load.compact(spark, base, max_files=2) == ["2026-01", "2026-02"]
    finally:
        load.DataFrame.unionByName = union
    assert "Exchange" not in made[-1]._jdf.queryExecution().executedPlan().toString()
    after = spark.read.parquet(base)
    assert sorted(int(r.uuid) for r in after.collect()) == list(range(400)) and len(after.inputFiles()) <= 4
