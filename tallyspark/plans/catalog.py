"""Registered queries: one per operator group of the inventory.

Each query takes ``(spark, sf_dir)``, reads the driver's tables, derives
statement rows from ``lineitem`` (``plans.synth``) and runs the operator over
all of them.  ``ORACLE`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DEFAULT, Settings
from ..functions.keys import DIGEST
from ..operators import category, clean, consolidate, keys, load, parse, report
from ..session import scratch_path
from ..sources import sinks, statements, versions
from . import oracle, synth, transform as tr
from .consolidate import run_consolidate
from .daily import DailyPaths, run_daily
from .joins import materialize

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- shared steps
def parsed_lines(spark: SparkSession, sf_dir: str, s: Settings = DEFAULT) -> DataFrame:
    li = synth.read_table(spark, sf_dir, "lineitem")
    return clean.parse_lines(synth.statement_rows(li, s), s)


def cleaned_rows(spark: SparkSession, sf_dir: str, s: Settings = DEFAULT,
                 lineage: bool = False) -> DataFrame:
    return clean.cleaned(parsed_lines(spark, sf_dir, s), lineage=lineage)


def transformed_rows(spark: SparkSession, sf_dir: str, s: Settings = DEFAULT,
                     lineage: bool = False, digest: bool = False, grouped: bool = False) -> DataFrame:
    """E3 over the cleaned rows.

    The parsed rows (T1-T11 done) are written once to the shared scratch
    folder: the category step reads its input twice (distinct values, then
    the join back), and the parse should run once, not twice.  ``grouped`` for
    queries that load month tables: the cleaned rows are brought together by month.
    """
    keep = ("file_name", "line_no") if lineage else ()
    rows = cleaned_rows(spark, sf_dir, s, lineage)
    return tr.transform(load.by_month(rows) if grouped else rows, s, keep=keep,
                        stage=lambda d: materialize(d, "prepared"), digest=digest)


def parsed_rows(spark: SparkSession, sf_dir: str, s: Settings = DEFAULT) -> DataFrame:
    """T1-T11 over the cleaned rows, without the category step and keys."""
    df = parse.clean_raw_category(parse.data_preprocessor(cleaned_rows(spark, sf_dir, s), s), s)
    df = parse.capitalize_raw_category(parse.apply_raw_category_transformation(df, s))
    return parse.modify_salaried_record(df, s)


def _flat(df: DataFrame) -> DataFrame:
    """Array column rendered as text so results compare across engines; the stored digest is left out."""
    return df.withColumn("split", F.array_join("split", "|")).drop(DIGEST)


# ---------------------------------------------------------------- queries
def q_clean(spark, sf_dir):
    """Cleaned, typed statement rows."""
    return cleaned_rows(spark, sf_dir, lineage=True)


def q_rejects(spark, sf_dir):
    """Rejected lines with the reason."""
    return clean.rejects(parsed_lines(spark, sf_dir)).select("file", "line_no", "reason")


def q_transform(spark, sf_dir):
    """Full transform, every row."""
    return _flat(transformed_rows(spark, sf_dir, lineage=True))


def q_category_resolution(spark, sf_dir):
    """Each raw value with its sub-category, category and row count."""
    return (transformed_rows(spark, sf_dir)
            .groupBy("raw_category", "SubCategory", "Category")
            .agg(F.count(F.lit(1)).alias("rows")))


def q_manual_audit(spark, sf_dir):
    """Raw values that fell to the fallback label."""
    return category.audit_unresolved(transformed_rows(spark, sf_dir), "raw_category",
                                     "SubCategory", DEFAULT.manual_label)


def q_unspecified_audit(spark, sf_dir):
    """Sub-categories left without a parent."""
    return category.audit_unresolved(transformed_rows(spark, sf_dir), "SubCategory",
                                     "Category", DEFAULT.unspecified_label)


def q_monthly_category(spark, sf_dir):
    """Flagship: E3 then totals by month and category."""
    df = transformed_rows(spark, sf_dir)
    return (df.groupBy(parse.month_of(F.col("date")).alias("month"), "Category")
              .agg(F.count(F.lit(1)).alias("n_txn"),
                   F.sum("dr").cast("decimal(38,2)").alias("total_dr"),
                   F.sum("cr").cast("decimal(38,2)").alias("total_cr")))


def batch_with_month(spark, sf_dir, grouped: bool = False) -> DataFrame:
    """Transformed rows with lineage and month.

    Their prepared columns lie in the shared scratch folder.  What is added to these, label, key and month,
    costs a reader less than a second copy, which also would hold columns that a query does not use.
    """
    return load.with_month(transformed_rows(spark, sf_dir, lineage=True, digest=True, grouped=grouped))


def _seed(batch: DataFrame) -> DataFrame:
    """The 'already loaded' half: statements whose file group number is even."""
    return batch.filter(F.regexp_extract("file_name", r"_([0-9]+)[.]csv$", 1).cast("bigint") % 2 == 0)


def q_incremental_load(spark, sf_dir):
    """J1 + J2 + S7-S10: load half, then everything; the month table holds each row once."""
    batch = batch_with_month(spark, sf_dir, grouped=True).drop("line_no")
    base = scratch_path(spark, "months")
    load.route(_seed(batch).drop("file_name"), base, grouped=True)
    load.route(batch.drop("file_name"), base, grouped=True)
    return _flat(spark.read.parquet(base))


def q_delta_counts(spark, sf_dir):
    """G3 (+J1): incoming / existing / delta rows per month for the second load."""
    batch = batch_with_month(spark, sf_dir)
    seed = _seed(batch)
    delta = load.anti_join(batch, seed)
    return load.month_counts(batch, seed, delta)


def _write_inbox(spark, sf_dir) -> str:
    inbox = scratch_path(spark, "inbox")
    synth.write_statement_files(synth.read_table(spark, sf_dir, "lineitem"), DEFAULT, inbox)
    return inbox


def q_statement_files(spark, sf_dir):
    """S3 + S4 + S5 + S6: statement exports read back from files, cleaned."""
    inbox = _write_inbox(spark, sf_dir)
    lines, _ = statements.read_statements(spark, inbox, DEFAULT, DEFAULT.file_glob)
    return clean.cleaned(clean.parse_lines(lines, DEFAULT), lineage=True).drop("line_no")


def q_listing(spark, sf_dir):
    """Statement files with their line counts (listing joined to a line count), empty ones with 0."""
    inbox = _write_inbox(spark, sf_dir)
    listing = statements.list_statements(spark, inbox).select(F.col("file_name").alias("statement"), "path")
    counts = (spark.read.text(inbox).select(F.col("_metadata.file_path").alias("path"))
                   .groupBy("path").agg(F.count(F.lit(1)).alias("n_lines")))
    return listing.join(counts, "path", "left").select("statement", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


def _daily_paths(spark, inbox) -> DailyPaths:
    return DailyPaths(inbox=inbox, months=scratch_path(spark, "months"),
                      rejects=scratch_path(spark, "rejects"), runs=scratch_path(spark, "runs"),
                      processed=scratch_path(spark, "processed"))


def q_daily(spark, sf_dir):
    """E1 (+S14): run the daily job, then re-run it on the same files (delta 0)."""
    paths = _daily_paths(spark, _write_inbox(spark, sf_dir))
    run_daily(spark, DEFAULT, paths, max_files=10**9)
    # same files delivered again (fresh processed list): the anti join appends nothing
    again = DailyPaths(**{**paths.__dict__, "processed": scratch_path(spark, "processed")})
    run_daily(spark, DEFAULT, again, max_files=10**9)
    return _flat(spark.read.parquet(paths.months))


def q_consolidate(spark, sf_dir):
    """E2 (U1, U2, O1, F1, S11, S12): master rebuilt from the month tables."""
    paths = _daily_paths(spark, _write_inbox(spark, sf_dir))
    run_daily(spark, DEFAULT, paths, max_files=10**9)
    master = scratch_path(spark, "master")
    run_consolidate(spark, DEFAULT, paths.months, master, paths.runs)
    return _flat(versions.read(spark, master))


def q_duplicates(spark, sf_dir):
    """Rows before and after key de-duplication (one aggregation, no cross join)."""
    per_key = batch_with_month(spark, sf_dir).groupBy("uuid").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").cast("bigint").alias("rows_before"),
                       F.count(F.lit(1)).alias("rows_after")).select(
        "rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("duplicates_removed"))


def q_dedup(spark, sf_dir):
    """One row per key (latest month, then greatest columns)."""
    batch = batch_with_month(spark, sf_dir).drop("file_name", "line_no").withColumnRenamed("month", "source_month")
    return _flat(consolidate.deduplicate(batch))


def q_banks(spark, sf_dir):
    """G1."""
    return report.distinct_banks(cleaned_rows(spark, sf_dir))


def q_months(spark, sf_dir):
    """G2."""
    return report.distinct_months(parsed_rows(spark, sf_dir))


def q_source_months(spark, sf_dir):
    """G4."""
    b = load.with_month(parsed_rows(spark, sf_dir)).withColumnRenamed("month", "source_month")
    return report.count_distinct_months(b)


def q_filter_app(spark, sf_dir):
    """rows per filter_app value."""
    df = consolidate.add_filter_col(transformed_rows(spark, sf_dir), DEFAULT)
    return df.groupBy("filter_app").agg(F.count(F.lit(1)).alias("rows"))


def q_export(spark, sf_dir):
    """S13 + T12: export projection, every cell as text."""
    return sinks.export_projection(transformed_rows(spark, sf_dir, lineage=True))


def q_token_layouts(spark, sf_dir):
    """Token counts, manual flag and transaction type per bank."""
    return (parsed_rows(spark, sf_dir)
            .groupBy("bank", "len_split", "is_manual", "transaction_type")
            .agg(F.count(F.lit(1)).alias("rows")))


def q_salary(spark, sf_dir):
    """Salary rows per (shifted) month."""
    df = parsed_rows(spark, sf_dir)
    return (df.groupBy(parse.month_of(F.col("date")).alias("month"),
                       (F.col("raw_category") == DEFAULT.salary_label).alias("is_salary"))
              .agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date")))


def q_txn_key(spark, sf_dir):
    """D-K: transaction id as key when usable, else the hash."""
    df = keys.build_txn_key(transformed_rows(spark, sf_dir, lineage=True), DEFAULT, "txn_key")
    return df.select("file_name", "line_no", "transaction_no", "uuid", "txn_key")


def q_summary_view(spark, sf_dir):
    """D-V: category / sub-category roll-up."""
    return report.summary_view(transformed_rows(spark, sf_dir))


def q_month_pivot(spark, sf_dir):
    """D-V: debit totals pivoted by month."""
    return report.month_pivot_view(transformed_rows(spark, sf_dir), PIVOT_MONTHS)


def q_fuzzy(spark, sf_dir):
    """Values left after exact and substring tiers, their best label and token-sort score."""
    vals = transformed_rows(spark, sf_dir).select("raw_category").distinct()
    return category.fuzzy_candidates(vals, "raw_category", DEFAULT)


def q_run_report(spark, sf_dir):
    """run reports of a daily run and of a re-delivery of the same files."""
    paths = _daily_paths(spark, _write_inbox(spark, sf_dir))
    run_daily(spark, DEFAULT, paths, max_files=10**9)
    again = DailyPaths(**{**paths.__dict__, "processed": scratch_path(spark, "processed")})
    run_daily(spark, DEFAULT, again, max_files=10**9)
    runs = spark.read.parquet(paths.runs)
    return runs.select("pipeline", "status", "rows", "groups",
                       F.get_json_object("details", "$.delta").cast("bigint").alias("delta"))


def q_stream_daily(spark, sf_dir):
    """E1 as a Structured Streaming job (AvailableNow, several micro-batches)."""
    paths = _drained(spark, sf_dir)
    return _flat(spark.read.parquet(paths.months))


def _drained(spark, sf_dir) -> DailyPaths:
    from ..streaming.daily import run_daily_stream
    paths = _daily_paths(spark, _write_inbox(spark, sf_dir))
    run_daily_stream(spark, DEFAULT, paths, scratch_path(spark, "stream-ckpt"), max_files_per_trigger=8)   # no key spans two files here
    return paths


def _balance(spark, paths: DailyPaths) -> DataFrame:
    clean_rows = spark.read.parquet(paths.months).agg(F.count(F.lit(1)).alias("clean"))
    rejected = spark.read.parquet(paths.rejects).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    return rejected.unionByName(clean_rows.select(F.lit("clean").alias("reason"), F.col("clean").alias("rows")))


def q_stream_balance(spark, sf_dir):
    """S6 + D4 on the stream: clean rows and rejects, empty files included; the same as the batch job's."""
    return _balance(spark, _drained(spark, sf_dir))


def q_master_order(spark, sf_dir):
    """O1: the written master's rows in file order: none out of order, no two files overlapping, its ends."""
    batch = batch_with_month(spark, sf_dir, grouped=True).drop("file_name", "line_no")
    base, master = scratch_path(spark, "months"), scratch_path(spark, "master")
    load.route(batch, base, grouped=True)
    run_consolidate(spark, DEFAULT, base, master, scratch_path(spark, "runs"))
    return consolidate.order_report(consolidate.order_witness(versions.read(spark, master)))


def q_incremental_consolidate(spark, sf_dir):
    """E2 after each of three loads (half the files, all, credits of even years taken out): the last master."""
    batch = batch_with_month(spark, sf_dir, grouped=True).drop("line_no")
    base, master, runs = scratch_path(spark, "months"), scratch_path(spark, "master"), scratch_path(spark, "runs")
    load.route(_seed(batch).drop("file_name"), base, grouped=True)
    run_consolidate(spark, DEFAULT, base, master, runs)
    batch = batch.drop("file_name")
    load.route(batch, base, grouped=True)
    run_consolidate(spark, DEFAULT, base, master, runs)
    load.write_fresh(batch.filter(F.col("dr").isNotNull() & (F.substring("month", 1, 4).cast("int") % 2 == 0)), base, grouped=True)
    run_consolidate(spark, DEFAULT, base, master, runs)
    return _flat(versions.read(spark, master))


def q_compaction(spark, sf_dir):
    """Eight appends to every month, then compaction: rows by month, and whether few files are left."""
    batch = batch_with_month(spark, sf_dir, grouped=True).drop("line_no")
    base, appends = scratch_path(spark, "months"), 8
    nth = F.pmod(F.regexp_extract("file_name", r"_([0-9]+)[.]csv$", 1).cast("bigint"), F.lit(appends))
    for i in range(appends):
        load.route(batch.filter(nth == i).drop("file_name"), base, grouped=True)
    load.compact(spark, base, max_files=2)
    rows = spark.read.parquet(base).select("month", F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("month").agg(F.count(F.lit(1)).alias("rows"), (F.count_distinct("file") <= 2).alias("few_files"))


def q_column_check(spark, sf_dir):
    """K2: key columns as they are, and with faults: rows and distinct keys, or why no key can be built."""
    df = materialize(transformed_rows(spark, sf_dir).drop("uuid"), "rows")
    variants = {
        "as_read": df, "timestamp_date": df.withColumn("date", F.col("date").cast("timestamp")), "no_dr": df.drop("dr"),
        "text_date": df.withColumn("date", F.col("date").cast("string")), "float_amounts": df.withColumns({
            c: F.col(c).cast("double") for c in ("dr", "cr")}),
        "three_places": df.withColumn("dr", F.col("dr").cast("decimal(18,3)"))}
    out = []
    for name, v in variants.items():
        try:
            found, fault = keys.build_unique_key(v, DEFAULT).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("uuid").alias("keys")), None
        except ValueError as e:
            found, fault = v.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("bigint").alias("keys")), str(e)
        out.append(found.select(F.lit(name).alias("variant"), "rows", "keys", F.lit(fault).cast("string").alias("fault")))
    return reduce(DataFrame.unionByName, out)


def q_latest_month(spark, sf_dir):
    """U2 (D3): keys that span two months and differ in another column; the later month wins."""
    batch = batch_with_month(spark, sf_dir)
    late = _seed(batch).withColumns({
        "month": F.date_format(F.add_months(F.concat("month", F.lit("-01")).cast("date"), 1), "yyyy-MM"),
        "payment_to": F.concat(F.lit("late "), "payment_to")})
    both = batch.unionByName(late).drop("file_name", "line_no").withColumnRenamed("month", "source_month")
    return _flat(consolidate.deduplicate(both))


def q_fresh_write(spark, sf_dir):
    """Months written, then those of even years replaced by their debits."""
    batch = batch_with_month(spark, sf_dir, grouped=True).drop("file_name", "line_no")
    base = scratch_path(spark, "months")
    load.write_fresh(batch, base, grouped=True)
    load.write_fresh(batch.filter(F.col("dr").isNotNull() & (F.substring("month", 1, 4).cast("int") % 2 == 0)), base, grouped=True)
    return _flat(spark.read.parquet(base))


def q_file_guard(spark, sf_dir):
    """More files than allowed stop the run, which is reported with their number."""
    paths = _daily_paths(spark, _write_inbox(spark, sf_dir))
    try:
        run_daily(spark, DEFAULT, paths, max_files=1)
    except RuntimeError:
        pass
    return spark.read.parquet(paths.runs).select(
        "pipeline", "status", F.regexp_extract("error", r"^(\d+) input files", 1).cast("bigint").alias("files"))


def q_balance(spark, sf_dir):
    """Clean rows and rejects of a daily run; together they are all lines of the files."""
    inbox = _write_inbox(spark, sf_dir)
    paths = _daily_paths(spark, inbox)
    run_daily(spark, DEFAULT, paths, max_files=10**9)
    run_daily(spark, DEFAULT, paths, max_files=10**9)   # nothing new: no reject is logged twice
    return _balance(spark, paths)


#: Columns of the month pivot: a fixed list, so that the result has one schema whatever the data; other months share one column.
PIVOT_MONTHS = [f"{y}-{m:02d}" for y in range(1994, 2004) for m in range(1, 13)]


QUERIES: dict[str, Query] = {
    "E3_monthly_category": q_monthly_category,
    "P_clean": q_clean,
    "P_rejects": q_rejects,
    "E3_transform": q_transform,
    "C_category_resolution": q_category_resolution,
    "C8_manual_audit": q_manual_audit,
    "C10_unspecified_audit": q_unspecified_audit,
    "T_token_layouts": q_token_layouts,
    "T11_salary": q_salary,
    "J2_incremental_load": q_incremental_load,
    "G3_delta_counts": q_delta_counts,
    "S3_statement_files": q_statement_files,
    "S1_listing": q_listing,
    "E1_daily": q_daily,
    "E2_consolidate": q_consolidate,
    "U2_dedup": q_dedup,
    "G5_duplicates": q_duplicates,
    "G1_banks": q_banks,
    "G2_months": q_months,
    "G4_source_months": q_source_months,
    "F1_filter_app": q_filter_app,
    "S13_export": q_export,
    "DK_txn_key": q_txn_key,
    "DV_summary": q_summary_view,
    "DV_month_pivot": q_month_pivot,
    "C5_fuzzy": q_fuzzy,
    "F2_run_report": q_run_report,
    "E1_stream_daily": q_stream_daily,
    "U2_latest_month": q_latest_month,
    "S8_fresh_write": q_fresh_write,
    "S2_file_guard": q_file_guard,
    "D4_balance": q_balance,
    "D4_stream_balance": q_stream_balance,
    "O1_master_order": q_master_order,
    "E2_incremental": q_incremental_consolidate,
    "S9_compaction": q_compaction,
    "K2_column_check": q_column_check,
}


# ---------------------------------------------------------------- oracle SQL
def _sql_rejects() -> str:
    return "WITH " + oracle.synth_cte().strip() + f""",
all_lines AS (
  SELECT file_name AS file, CAST(slot + c.copy - 1 AS INTEGER) AS line_no, m
  FROM rows, (SELECT unnest([1, 2]) AS copy) c WHERE c.copy = 1 OR m = 10)
SELECT file, line_no, {oracle.reject_reason_sql()} AS reason FROM all_lines
WHERE m BETWEEN 0 AND 9"""


def _transformed_select(body: str) -> str:
    return oracle.with_transformed() + "\n" + body


ORACLE: dict[str, str] = {
    "E3_monthly_category": _transformed_select("""
SELECT strftime(date, '%Y-%m') AS month, Category, count(*) AS n_txn,
       CAST(sum(dr) AS DECIMAL(38,2)) AS total_dr, CAST(sum(cr) AS DECIMAL(38,2)) AS total_cr
FROM transformed GROUP BY ALL"""),
    "P_clean": "WITH " + oracle.synth_cte().strip() + """
SELECT date, particulars, dr, cr, bank, file_name, line_no FROM cleaned""",
    "P_rejects": _sql_rejects(),
    "E3_transform": _transformed_select("""
SELECT date, particulars, dr, cr, bank, array_to_string(split, '|') AS split, len_split, is_manual,
       transaction_type, transaction_no, payment_to, raw_category, SubCategory, Category, uuid,
       file_name, line_no
FROM transformed"""),
    "C_category_resolution": _transformed_select("""
SELECT raw_category, SubCategory, Category, count(*) AS rows FROM transformed GROUP BY ALL"""),
    "C8_manual_audit": _transformed_select(f"""
SELECT raw_category AS value, count(*) AS rows FROM transformed
WHERE SubCategory = {oracle._q(DEFAULT.manual_label)} GROUP BY ALL"""),
    "C10_unspecified_audit": _transformed_select(f"""
SELECT SubCategory AS value, count(*) AS rows FROM transformed
WHERE Category = {oracle._q(DEFAULT.unspecified_label)} GROUP BY ALL"""),
}


TRANSFORMED_TEXT_COLS = ("date, particulars, dr, cr, bank, array_to_string(split, '|') AS split, len_split, "
                         "is_manual, transaction_type, transaction_no, payment_to, raw_category, "
                         "SubCategory, Category, uuid")

_BATCH = """,
batch AS (SELECT *, strftime(date, '%Y-%m') AS month FROM transformed),
seed AS (SELECT * FROM batch WHERE CAST(regexp_extract(file_name, '_([0-9]+)[.]csv$', 1) AS BIGINT) % 2 = 0),
delta AS (SELECT * FROM batch b WHERE NOT EXISTS (
            SELECT 1 FROM seed s WHERE s.month = b.month AND s.uuid = b.uuid))"""


def _filter_app_sql(col: str = "Category") -> str:
    kept = " ".join(f"WHEN {col} = {oracle._q(v)} THEN {oracle._q(v)}" for v in DEFAULT.filter_app_kept)
    blank = ", ".join(oracle._q(v) for v in DEFAULT.filter_app_blank)
    return f"CASE {kept} WHEN {col} IN ({blank}) THEN '' ELSE {oracle._q(DEFAULT.filter_app_other)} END"


def _lines_per_file_sql() -> str:
    s = DEFAULT
    return "WITH " + oracle.synth_cte().strip() + f""",
all_lines AS (SELECT file_name, axis FROM rows, (SELECT unnest([1, 2]) AS copy) c WHERE c.copy = 1 OR m = 10)
SELECT file_name AS statement,
       count(*) + max(CASE WHEN axis THEN {s.bank('axis').skip_rows} ELSE {s.bank('hdfc').skip_rows} END) + 1 AS n_lines
FROM all_lines GROUP BY file_name
UNION ALL SELECT unnest({list(synth.EMPTY_FILES)}), 0"""


_DEDUP = f"""
SELECT DISTINCT {TRANSFORMED_TEXT_COLS}, month AS source_month FROM batch"""

ORACLE.update({
    "T_token_layouts": _transformed_select("""
SELECT bank, len_split, is_manual, transaction_type, count(*) AS rows FROM transformed GROUP BY ALL"""),
    "T11_salary": _transformed_select(f"""
SELECT strftime(date, '%Y-%m') AS month, raw_category = {oracle._q(DEFAULT.salary_label)} AS is_salary,
       count(*) AS rows, min(date) AS first_date FROM transformed GROUP BY ALL"""),
    "J2_incremental_load": _transformed_select(_BATCH + f"""
SELECT {TRANSFORMED_TEXT_COLS}, month FROM seed
UNION ALL SELECT {TRANSFORMED_TEXT_COLS}, month FROM delta"""),
    "G3_delta_counts": _transformed_select(_BATCH + """
SELECT b.month, b.incoming, coalesce(e.existing, 0) AS existing, coalesce(d.delta, 0) AS delta
FROM (SELECT month, count(*) AS incoming FROM batch GROUP BY month) b
LEFT JOIN (SELECT month, count(*) AS existing FROM seed GROUP BY month) e ON e.month = b.month
LEFT JOIN (SELECT month, count(*) AS delta FROM delta GROUP BY month) d ON d.month = b.month"""),
    "S3_statement_files": "WITH " + oracle.synth_cte().strip() + """
SELECT date, particulars, dr, cr, bank, file_name FROM cleaned""",
    "S1_listing": _lines_per_file_sql(),
    "E1_daily": _transformed_select(_BATCH + f"""
SELECT {TRANSFORMED_TEXT_COLS}, month FROM batch"""),
    "E2_consolidate": _transformed_select(_BATCH + f"""
SELECT *, {_filter_app_sql()} AS filter_app FROM ({_DEDUP})"""),
    "U2_dedup": _transformed_select(_BATCH + _DEDUP),
    "G5_duplicates": _transformed_select(_BATCH + """
SELECT count(*) AS rows_before, count(DISTINCT uuid) AS rows_after,
       count(*) - count(DISTINCT uuid) AS duplicates_removed FROM batch"""),
    "G1_banks": _transformed_select("SELECT DISTINCT bank FROM transformed"),
    "G2_months": _transformed_select("SELECT DISTINCT strftime(date, '%Y-%m') AS month FROM transformed"),
    "G4_source_months": _transformed_select("SELECT count(DISTINCT strftime(date, '%Y-%m')) AS months FROM transformed"),
    "F1_filter_app": _transformed_select(f"""
SELECT {_filter_app_sql()} AS filter_app, count(*) AS rows FROM transformed GROUP BY ALL"""),
    "S13_export": _transformed_select("""
SELECT coalesce(strftime(date, '%Y-%m-%d'), '') AS date, coalesce(particulars, '') AS particulars,
       coalesce(CAST(dr AS VARCHAR), '') AS dr, coalesce(CAST(cr AS VARCHAR), '') AS cr,
       coalesce(bank, '') AS bank, coalesce(array_to_string(split, '|'), '') AS split,
       coalesce(CAST(len_split AS VARCHAR), '') AS len_split, coalesce(is_manual, '') AS is_manual,
       coalesce(transaction_type, '') AS transaction_type, coalesce(transaction_no, '') AS transaction_no,
       coalesce(payment_to, '') AS payment_to, coalesce(raw_category, '') AS raw_category,
       coalesce(SubCategory, '') AS SubCategory, coalesce(Category, '') AS Category,
       coalesce(uuid, '') AS uuid, coalesce(file_name, '') AS file_name,
       coalesce(CAST(line_no AS VARCHAR), '') AS line_no
FROM transformed"""),
    "DK_txn_key": _transformed_select(f"""
SELECT file_name, line_no, transaction_no, uuid,
       CASE WHEN length(upper({oracle.strip('transaction_no')})) >= {DEFAULT.min_txn_id_len}
             AND upper({oracle.strip('transaction_no')}) NOT IN ({", ".join(oracle._q(w) for w in DEFAULT.invalid_txn_ids)})
            THEN upper({oracle.strip('transaction_no')}) ELSE uuid END AS txn_key
FROM transformed"""),
    "DV_summary": _transformed_select("""
SELECT Category, SubCategory, count(*) AS n_txn, CAST(sum(dr) AS DECIMAL(38,2)) AS total_dr,
       CAST(sum(cr) AS DECIMAL(38,2)) AS total_cr
FROM transformed GROUP BY ROLLUP (Category, SubCategory)"""),
    "DV_month_pivot": _transformed_select("SELECT Category, " + ", ".join(
        f"CAST(sum(dr) FILTER (WHERE strftime(date, '%Y-%m') = '{m}') AS DECIMAL(38,2)) AS \"{m}\"" for m in PIVOT_MONTHS)
        + f", CAST(sum(dr) FILTER (WHERE strftime(date, '%Y-%m') NOT BETWEEN '{PIVOT_MONTHS[0]}' AND '{PIVOT_MONTHS[-1]}') AS DECIMAL(38,2)) AS other FROM transformed GROUP BY Category"),
    "U2_latest_month": _transformed_select(_BATCH + f""",
both_ AS (SELECT {TRANSFORMED_TEXT_COLS}, month AS source_month FROM batch
  UNION ALL SELECT {TRANSFORMED_TEXT_COLS.replace("payment_to", "'late ' || payment_to AS payment_to")},
         strftime(CAST(month || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m') FROM seed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY source_month DESC) AS rk FROM both_)
SELECT * EXCLUDE (rk) FROM ranked WHERE rk = 1"""),
    "S8_fresh_write": _transformed_select(_BATCH + f"""
SELECT {TRANSFORMED_TEXT_COLS}, month FROM batch
WHERE dr IS NOT NULL OR month NOT IN (SELECT month FROM batch WHERE dr IS NOT NULL AND CAST(substr(month, 1, 4) AS INTEGER) % 2 = 0)"""),
    "S2_file_guard": "WITH " + oracle.synth_cte().strip() + f"""
SELECT 'ETL' AS pipeline, 'FAILURE' AS status, count(DISTINCT file_name) + {len(synth.EMPTY_FILES)} AS files FROM rows""",
    "D4_balance": "WITH " + oracle.synth_cte().strip() + f""",
all_lines AS (SELECT m FROM rows, (SELECT unnest([1, 2]) AS copy) c WHERE c.copy = 1 OR m = 10)
SELECT CASE WHEN m BETWEEN 0 AND 9 THEN {oracle.reject_reason_sql()} ELSE 'clean' END AS reason, count(*) AS rows
FROM all_lines GROUP BY ALL
UNION ALL SELECT 'no_header', {len(synth.EMPTY_FILES)}""",
    "O1_master_order": _transformed_select(_BATCH + f""",
master AS (SELECT DISTINCT date, uuid FROM ({_DEDUP}))
SELECT (SELECT count(*) FROM ({_DEDUP})) AS rows, CAST(0 AS BIGINT) AS out_of_order, CAST(0 AS BIGINT) AS overlapping_files,
       min(k).date AS first_date, min(k).uuid AS first_uuid, max(k).date AS last_date, max(k).uuid AS last_uuid
FROM (SELECT {{'date': date, 'uuid': uuid}} AS k FROM master)"""),
    "E2_incremental": _transformed_select(_BATCH + f""",
left_in AS (SELECT * FROM batch WHERE dr IS NOT NULL
  OR month NOT IN (SELECT month FROM batch WHERE dr IS NOT NULL AND CAST(substr(month, 1, 4) AS INTEGER) % 2 = 0))
SELECT *, {_filter_app_sql()} AS filter_app FROM (SELECT DISTINCT {TRANSFORMED_TEXT_COLS}, month AS source_month FROM left_in)"""),
    "S9_compaction": _transformed_select(_BATCH + """
SELECT month, count(*) AS rows, true AS few_files FROM batch GROUP BY month"""),
    "K2_column_check": _transformed_select("""
, counted AS (SELECT count(*) AS rows, count(DISTINCT uuid) AS keys FROM transformed)
SELECT variant, rows, CASE WHEN fault IS NULL THEN keys ELSE 0 END AS keys, fault FROM counted, (VALUES
  ('as_read', NULL), ('timestamp_date', NULL),
  ('no_dr', 'no row key can be built from dr: absent'),
  ('text_date', 'no row key can be built from date: string'),
  ('float_amounts', 'no row key can be built from dr: double, cr: double'),
  ('three_places', 'no row key can be built from dr: decimal(18,3)')) v(variant, fault)"""),
})


def _fuzzy_sql() -> str:
    # reuse the transform CTEs, then expose the fuzzy tier's best pair per value
    return oracle.with_transformed() + """
SELECT v AS raw_category, label AS best_label, score FROM (
  SELECT v, label, score, row_number() OVER (PARTITION BY v ORDER BY score DESC, ord) AS rk FROM scored)
WHERE rk = 1"""


ORACLE["D4_stream_balance"] = ORACLE["D4_balance"]
ORACLE.update({
    "C5_fuzzy": _fuzzy_sql(),
    "F2_run_report": _transformed_select(_BATCH + """
SELECT 'ETL' AS pipeline, 'SUCCESS' AS status, count(*) AS rows, count(DISTINCT bank) AS groups,
       count(*) AS delta FROM batch
UNION ALL SELECT 'ETL', 'SUCCESS', count(*), count(DISTINCT bank), CAST(0 AS BIGINT) FROM batch"""),
    "E1_stream_daily": _transformed_select(_BATCH + f"""
SELECT {TRANSFORMED_TEXT_COLS}, month FROM batch"""),
})
