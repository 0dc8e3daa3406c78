"""Statement lines derived from the driver's ``lineitem`` table.

The driver's tables hold no bank statements, so each lineitem becomes one
statement line (a few become two, or a marker / footer / broken line) with
plain integer arithmetic that the DuckDB oracle repeats exactly.  Work grows
with ``lineitem``; nothing is sampled or capped.

Shape, per lineitem (k = l_orderkey, p = l_partkey, s = l_suppkey,
n = l_linenumber):

* bank = axis when s is even, else hdfc; file ``<bank>_stmt_<k div 1000>.csv``
* m = (7k + n) mod 97 picks a special line: 0 all-null, 1 ``****`` date,
  2 ``Generated`` footer, 3-5 bad amounts, 6 null date, 7 impossible date,
  8 null particulars, 9 three nulls, 10 the line appears twice
* t = k mod 5 picks the token layout of ``particulars``
* amount = round(l_extendedprice * 100) cents; a credit when l_returnflag = 'R'
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import Settings

# Our own synthetic vocabulary (raw category tokens and payees).
CAT_WORDS = (
    "Grocery", "swigy", "Netflix", "upi", "payment", "taxi rent", "card", "restuarant",
    "premium", "sal 77001234 acme", " Dairy ", "chai", "advance", "groceries", "fuel", "uber",
    "books", "gym membership", "elec bill", "movie", "intrest", "Jio", "mf", "school fees",
    "credit card bill", "misc", "cash back", "Refund", "transfer to", "kids school",
    "wife gifts", "rent taxi",
)
PAY_WORDS = (
    "swiggy", "zomato", "amazon", "flipkart", "acme traders", "metro cash", "dr reddy",
    "self", "landlord", "ola", "gas agency", "uber",
)

AXIS_HEADER = "Tran Date,CHQNO,PARTICULARS,DR,CR,BAL"
HDFC_HEADER = "Date,Narration,Chq./Ref.No.,Value Dt,Withdrawal Amt.,Deposit Amt.,Closing Balance"
FILE_GROUP = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from ..sources.tables import balanced
    return balanced(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_array(words: tuple[str, ...]) -> str:
    return "array(" + ", ".join(_sql_str(w) for w in words) + ")"


def _csv_cell(c: str) -> str:
    """SQL for one CSV cell: quoted when it holds a comma or quote, null -> empty."""
    return (f"coalesce(CASE WHEN contains({c}, ',') OR contains({c}, '\"') "
            f"THEN concat('\"', replace({c}, '\"', '\"\"'), '\"') ELSE {c} END, '')")


def _line(cells: list[str]) -> str:
    blank = _sql_str("," * (len(cells) - 1))
    return f"CASE WHEN m = 0 THEN {blank} ELSE concat_ws(',', {', '.join(_csv_cell(c) for c in cells)}) END"


def statement_lines(lineitem: DataFrame, settings: Settings) -> DataFrame:
    """(file_name, line_no, line, header, bank) — one row per statement data line.

    Written as Spark SQL expressions (``selectExpr``): each stage is one call
    to the JVM instead of hundreds of Column-building round trips, and each
    stage computes its values once for the next.
    """
    axis_skip = settings.bank("axis").skip_rows
    hdfc_skip = settings.bank("hdfc").skip_rows
    df = lineitem.selectExpr(
        "l_orderkey AS k", "l_partkey AS p", "l_suppkey AS s", "CAST(l_linenumber AS BIGINT) AS n",
        "CAST(round(l_extendedprice * 100) AS BIGINT) AS cents", "l_returnflag = 'R' AS credit",
        "l_shipdate AS ship")
    df = df.selectExpr(
        "*", "(k * 7 + n) % 97 AS m", "k % 5 AS t", "s % 2 = 0 AS axis",
        f"get({_sql_array(CAT_WORDS)}, CAST(p % {len(CAT_WORDS)} AS INT)) AS cat",
        f"get({_sql_array(PAY_WORDS)}, CAST((s div 2) % {len(PAY_WORDS)} AS INT)) AS payee")
    df = df.selectExpr(
        "*", "CAST(k AS STRING) AS ks", "CAST(n AS STRING) AS ns",
        "replace(cat, ' ', '') AS hcat", "replace(payee, ' ', '') AS hpay",
        "CASE WHEN axis THEN 'axis' ELSE 'hdfc' END AS bank",
        "CASE WHEN axis THEN date_format(ship, 'dd-MM-yyyy') ELSE date_format(ship, 'dd/MM/yy') END AS dtxt")
    df = df.selectExpr(
        "*",
        """CASE WHEN m = 8 THEN NULL WHEN axis THEN
             CASE WHEN t = 0 THEN concat('ATM WDL ', ks)
                  WHEN t = 1 THEN concat('UPI/', ks, '/', payee, '/P2A/', cat)
                  WHEN t = 2 THEN concat('UPI/P2M/', ks, '/', payee,
                                         CASE WHEN n % 2 = 0 THEN '/ /' ELSE '/' END, cat, '/SBIN')
                  WHEN t = 3 THEN concat('UPI/P2M/', ks, '/', payee, '/note ', ns, '/', cat, '/AXIS')
                  ELSE concat('NEFT/', ks, '/', payee, '/x/y/', cat, '/z/w') END
           ELSE
             CASE WHEN t IN (1, 2) THEN concat('UPI-', hpay, '-HDFC-', ks, '-', hcat)
                  WHEN t = 3 THEN concat('POS ', ks, ' ', hcat)
                  WHEN t = 0 THEN concat('NEFT-', ks, '-', hpay)
                  ELSE concat('IMPS-', ks, '-', hpay, '-REF-', ns, '-', hcat) END
           END AS part_txt""",
        """CASE WHEN m = 1 THEN '********' WHEN m = 2 THEN concat('Generated on ', dtxt)
                WHEN m = 6 THEN NULL WHEN m = 7 THEN concat('31/02/', date_format(ship, 'yy'))
                ELSE dtxt END AS date_cell""",
        """CASE WHEN m = 3 THEN '1,234.50' WHEN m = 4 THEN concat(CAST(cents div 100 AS STRING), 'd')
                WHEN m = 5 THEN 'abc'
                ELSE concat(CAST(cents div 100 AS STRING), '.', lpad(CAST(cents % 100 AS STRING), 2, '0'))
           END AS amt""")
    df = df.selectExpr(
        "*", "CASE WHEN NOT credit THEN amt END AS dr", "CASE WHEN credit THEN amt END AS cr",
        "concat(CAST((k * 13 + p) % 100000 AS STRING), '.00') AS bal",
        "CASE WHEN (m IN (6, 8) OR t = 4) AND m != 9 THEN ks END AS chq",
        "CASE WHEN m != 9 THEN lpad(ks, 10, '0') END AS ref",
        "CASE WHEN m != 9 THEN dtxt END AS vdt")
    axis_line = _line(["date_cell", "chq", "part_txt", "dr", "cr", "CASE WHEN m != 9 THEN bal END"])
    hdfc_line = _line(["date_cell", "part_txt", "ref", "vdt", "dr", "cr", "bal"])
    df = df.selectExpr(
        f"concat(bank, '_stmt_', lpad(CAST(k div {FILE_GROUP} AS STRING), "
        f"greatest(5, length(CAST(k div {FILE_GROUP} AS STRING))), '0'), '.csv') AS file_name",
        "explode(sequence(1, CASE WHEN m = 10 THEN 2 ELSE 1 END)) AS copy",
        f"CASE WHEN axis THEN {axis_skip} ELSE {hdfc_skip} END + 1 + ((k % {FILE_GROUP}) * 8 + n) * 2 AS slot",
        f"CASE WHEN axis THEN {axis_line} ELSE {hdfc_line} END AS line",
        f"CASE WHEN axis THEN {_sql_str(AXIS_HEADER)} ELSE {_sql_str(HDFC_HEADER)} END AS header",
        "bank")
    return df.selectExpr("file_name", "CAST(slot + copy - 1 AS INT) AS line_no", "line", "header", "bank")


_LAYOUTS: dict = {}


def _layouts(spark: SparkSession, settings: Settings) -> dict:
    """Header layout of the two synthetic exports, interpreted once per process."""
    from ..operators.clean import header_layout
    if settings not in _LAYOUTS:
        df = header_layout(spark.createDataFrame(
            [("axis", AXIS_HEADER), ("hdfc", HDFC_HEADER)], "bank string, header string"), settings)
        _LAYOUTS[settings] = {r["bank"]: r.asDict() for r in df.collect()}
    return _LAYOUTS[settings]


def statement_rows(lineitem: DataFrame, settings: Settings) -> DataFrame:
    """Statement lines with their header layout, ready for ``clean.parse_lines``.

    The two synthetic layouts are interpreted by ``header_layout`` on a
    two-row table (bounded by the configured banks) and attached per bank.
    """
    from ..operators.clean import LAYOUT_COLUMNS
    per_bank = _layouts(lineitem.sparkSession, settings)

    def lit(v):
        return ("true" if v else "false") if isinstance(v, bool) else str(int(v))

    cols = []
    for c in LAYOUT_COLUMNS:
        cases = " ".join(f"WHEN bank = {_sql_str(b)} THEN {lit(r[c])}" for b, r in per_bank.items())
        cols.append(f"CASE {cases} END AS {c}")
    return statement_lines(lineitem, settings).selectExpr("file_name", "line_no", "line", *cols)


def preamble_lines(lines: DataFrame, settings: Settings) -> DataFrame:
    """Preamble + header lines for each synthetic file (one small row set per file)."""
    files = lines.select("file_name", "bank", "header").distinct()
    skip = F.when(F.col("bank") == "axis", settings.bank("axis").skip_rows).otherwise(
        settings.bank("hdfc").skip_rows)
    pre = files.select("file_name", "header", F.explode(F.sequence(F.lit(0), skip)).alias("line_no"), skip.alias("skip"))
    return pre.select(
        "file_name", F.col("line_no").cast("int").alias("line_no"),
        F.when(F.col("line_no") == F.col("skip"), F.col("header"))
         .otherwise(F.concat(F.lit("Statement detail "), F.col("line_no").cast("string"), F.lit(",,,")))
         .alias("line"))


#: Exports of 0 bytes that come with the written statements, one a bank.
EMPTY_FILES = ("axis_stmt_empty.csv", "hdfc_stmt_empty.csv")


def write_statement_files(lineitem: DataFrame, settings: Settings, path: str) -> None:
    """Write the synthetic statements as real export files under ``path``, with an empty one for each bank.

    One text file per statement (``path/file_name=<name>/part-*.txt``):
    preamble, header, then the data lines in order.  Each statement is one
    task's sorted run, bounded by ``FILE_GROUP`` orders.
    """
    data = statement_lines(lineitem, settings)
    pre = preamble_lines(data, settings)
    allrows = data.select("file_name", "line_no", "line").unionByName(pre)
    (allrows.repartition("file_name").sortWithinPartitions("file_name", "line_no")
            .select("file_name", "line").write.mode("overwrite").partitionBy("file_name").text(path))
    nothing = lineitem.sparkSession.createDataFrame([], "line string")
    for name in EMPTY_FILES:
        nothing.write.mode("overwrite").text(f"{path}/file_name={name}")
