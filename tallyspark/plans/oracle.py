"""DuckDB oracle SQL for the registered queries.

Each oracle recomputes, in plain SQL over the driver's parquet views, what
the Spark query computes: the synthetic statement rows (``plans.synth``),
the transform (E3) and the downstream operators.  It is written
independently of the Spark code path (e.g. the fuzzy tier uses the textbook
LCS dynamic programme through ``list_reduce``, the Spark side a bit-parallel
fold), so agreement is a real check.
"""

from __future__ import annotations

from ..config import DEFAULT, Settings
from .synth import CAT_WORDS, FILE_GROUP, PAY_WORDS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]"


_WS = "[\\s\\x0B\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]"
STRIP = "regexp_replace({x}, '^" + _WS + "+|" + _WS + "+$', '', 'g')"


def strip(x: str) -> str:
    return STRIP.format(x=x)


def synth_cte(s: Settings = DEFAULT) -> str:
    """CTEs ``li`` (per lineitem scalars) and ``cleaned`` (rows that pass cleaning)."""
    nc, npay = len(CAT_WORDS), len(PAY_WORDS)
    return f"""
li AS (
  SELECT l_orderkey AS k, l_partkey AS p, l_suppkey AS s, CAST(l_linenumber AS BIGINT) AS n,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_returnflag = 'R' AS credit,
         l_shipdate AS ship,
         (l_orderkey * 7 + l_linenumber) % 97 AS m, l_orderkey % 5 AS t, l_suppkey % 2 = 0 AS axis,
         {_list(CAT_WORDS)}[CAST(l_partkey % {nc} AS INTEGER) + 1] AS cat,
         {_list(PAY_WORDS)}[CAST((l_suppkey // 2) % {npay} AS INTEGER) + 1] AS payee
  FROM lineitem
),
li2 AS (
  SELECT *, replace(cat, ' ', '') AS hcat, replace(payee, ' ', '') AS hpay,
         CAST(k AS VARCHAR) AS ks, CAST(n AS VARCHAR) AS ns,
         CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS amt_txt
  FROM li
),
rows AS (
  SELECT *,
    CASE WHEN axis THEN 'axis' ELSE 'hdfc' END AS bank,
    CASE WHEN axis THEN
      CASE WHEN t = 0 THEN 'ATM WDL ' || ks
           WHEN t = 1 THEN 'UPI/' || ks || '/' || payee || '/P2A/' || cat
           WHEN t = 2 THEN 'UPI/P2M/' || ks || '/' || payee || CASE WHEN n % 2 = 0 THEN '/ /' ELSE '/' END || cat || '/SBIN'
           WHEN t = 3 THEN 'UPI/P2M/' || ks || '/' || payee || '/note ' || ns || '/' || cat || '/AXIS'
           ELSE 'NEFT/' || ks || '/' || payee || '/x/y/' || cat || '/z/w' END
    ELSE
      CASE WHEN t IN (1, 2) THEN 'UPI-' || hpay || '-HDFC-' || ks || '-' || hcat
           WHEN t = 3 THEN 'POS ' || ks || ' ' || hcat
           WHEN t = 0 THEN 'NEFT-' || ks || '-' || hpay
           ELSE 'IMPS-' || ks || '-' || hpay || '-REF-' || ns || '-' || hcat END
    END AS particulars,
    (CASE WHEN axis THEN {s.bank('axis').skip_rows} ELSE {s.bank('hdfc').skip_rows} END)
      + 1 + ((k % {FILE_GROUP}) * 8 + n) * 2 AS slot,
    CASE WHEN axis THEN 'axis' ELSE 'hdfc' END || '_stmt_' || lpad(CAST(k // {FILE_GROUP} AS VARCHAR), CAST(greatest(5, length(CAST(k // {FILE_GROUP} AS VARCHAR))) AS INTEGER), '0') || '.csv' AS file_name
  FROM li2
),
cleaned AS (
  SELECT CAST(ship AS DATE) AS date, particulars,
         CASE WHEN NOT credit THEN CAST(amt_txt AS DECIMAL(18,2)) END AS dr,
         CASE WHEN credit THEN CAST(amt_txt AS DECIMAL(18,2)) END AS cr,
         bank, file_name, CAST(slot + c.copy - 1 AS INTEGER) AS line_no
  FROM rows, (SELECT unnest([1, 2]) AS copy) c
  WHERE m NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 9) AND (c.copy = 1 OR m = 10)
)"""


def reject_reason_sql() -> str:
    return """CASE m WHEN 0 THEN 'all_null' WHEN 1 THEN 'marker_row' WHEN 2 THEN 'footer_row'
      WHEN 3 THEN 'bad_amount' WHEN 4 THEN 'bad_amount' WHEN 5 THEN 'bad_amount'
      WHEN 6 THEN 'null_date' WHEN 7 THEN 'bad_date' WHEN 8 THEN 'null_particulars'
      WHEN 9 THEN 'too_many_nulls' END"""


def labels_cte(s: Settings = DEFAULT) -> str:
    """Labels from the raw taxonomy pairs: of a label under several parents the last parent wins."""
    rows = ", ".join(f"({ord_}, {_q(cat)}, {_q(lab)})" for ord_, cat, lab in s.taxonomy.entries())
    return f"""taxonomy(ord, category, lab) AS (VALUES {rows}),
labels AS (
  SELECT lower({strip('lab')}) AS norm, arg_max(lab, ord) AS label, min(ord) AS ord, arg_max(category, ord) AS category,
         array_to_string(list_sort(string_split_regex(lower({strip('lab')}), '\\s+')), ' ') AS srt
  FROM taxonomy GROUP BY 1)"""


def resolve_cte(values_cte: str, s: Settings = DEFAULT, src: str = "v",
                threshold: int | None = None) -> str:
    """CTEs resolving each distinct ``src`` of ``values_cte`` to ``sub``.

    Produces ``resolved(v, sub)``.
    """
    thr = s.fuzzy_threshold if threshold is None else threshold
    nv = f"lower({strip(src)})"
    return f"""
{labels_cte(s)},
vals AS (SELECT DISTINCT {src} AS v, {nv} AS nv FROM {values_cte}),
t1 AS (SELECT v, label AS sub FROM vals JOIN labels ON labels.norm = vals.nv),
t2 AS (SELECT v, label AS sub FROM (
         SELECT v, label, row_number() OVER (PARTITION BY v ORDER BY length(label) DESC, ord) AS rk
         FROM vals JOIN labels ON labels.norm <> '' AND contains(vals.nv, labels.norm)) WHERE rk = 1),
fz AS (SELECT v, array_to_string(list_sort(string_split_regex(nv, '\\s+')), ' ') AS a FROM vals
       WHERE v IS NOT NULL AND v NOT IN (SELECT v FROM t1) AND v NOT IN (SELECT v FROM t2)),
pairs AS (SELECT v, a, srt AS b, label, ord FROM fz, labels
          WHERE 200 * least(length(a), length(srt)) >= {thr} * (length(a) + length(srt))),
scored AS (SELECT v, label, ord,
   CASE WHEN length(a) + length(b) = 0 THEN 0.0 ELSE 200.0 * (CASE WHEN length(b) = 0 THEN 0 ELSE
     list_reduce(string_split(a, ''),
       lambda prev, ch: list_reduce(range(1, length(b) + 1),
          lambda acc, j: list_append(acc, CASE WHEN ch = b[j] THEN prev[j] + 1 ELSE greatest(acc[j], prev[j + 1]) END),
          [0::BIGINT]),
       list_transform(range(0, length(b) + 1), lambda x: 0::BIGINT))[length(b) + 1] END) / (length(a) + length(b)) END AS score
   FROM pairs),
t3 AS (SELECT v, label AS sub FROM (
         SELECT v, label, score, row_number() OVER (PARTITION BY v ORDER BY score DESC, ord) AS rk
         FROM scored) WHERE rk = 1 AND score >= {thr}),
resolved AS (
  SELECT vals.v, CASE WHEN vals.v IS NULL THEN {_q(s.manual_label)}
                      ELSE coalesce(t1.sub, t2.sub, t3.sub, {_q(s.manual_label)}) END AS sub
  FROM vals LEFT JOIN t1 ON t1.v = vals.v LEFT JOIN t2 ON t2.v = vals.v LEFT JOIN t3 ON t3.v = vals.v
)"""


def transform_cte(s: Settings = DEFAULT, src: str = "cleaned") -> str:
    """CTE ``transformed`` = E3 over ``src`` (needs labels/resolved built inside)."""
    vmap = " ".join(
        f"WHEN {_q(raw.lower() if s.normalize_map_keys else raw)} THEN {_q(std)}"
        for raw, std in s.value_map)
    generic = ", ".join(_q(g) for g in s.generic_categories)
    split_cases = " ".join(
        f"WHEN bank = {_q(b.bank)} THEN regexp_split_to_array(particulars, {_q(_re_class(b.split_class))})"
        for b in s.banks)
    return f"""
tok AS (
  SELECT *, list_filter(CASE {split_cases} END, lambda x: {strip('x')} <> '') AS split FROM {src}
),
tok2 AS (SELECT *, CAST(len(split) AS INTEGER) AS len_split FROM tok),
fields AS (
  SELECT *,
    CASE WHEN cr IS NOT NULL THEN 'Y' WHEN bank = 'hdfc' THEN 'Y'
         WHEN bank = 'axis' AND len_split IN (1, 5) THEN 'Y' ELSE 'N' END AS is_manual,
    CASE WHEN (bank = 'axis' AND len_split IN (5, 6, 7)) OR bank = 'hdfc' THEN split[1] END AS transaction_type,
    CASE WHEN bank = 'axis' AND len_split IN (6, 7) THEN split[3]
         WHEN bank = 'hdfc' AND len_split = 5 THEN split[4] END AS transaction_no,
    CASE WHEN bank = 'axis' AND len_split IN (6, 7) THEN split[4] END AS payee0,
    CASE WHEN bank = 'axis' AND len_split IN (5, 6) THEN split[5]
         WHEN bank = 'axis' AND len_split = 7 THEN split[6]
         WHEN bank = 'hdfc' AND len_split = 5 THEN split[5] END AS raw0
  FROM tok2
),
std AS (
  SELECT *, coalesce(CASE lower(raw0) {vmap} ELSE lower(raw0) END, {_q(s.null_category)}) AS raw1,
         coalesce(lower({strip('payee0')}), {_q(s.null_payee)}) AS payment_to
  FROM fields
),
std2 AS (
  SELECT *, CASE WHEN lower({strip('raw1')}) IN ({generic}) THEN payment_to
                 ELSE lower({strip('raw1')}) END AS raw2
  FROM std
),
std3 AS (SELECT *, upper(left(raw2, 1)) || lower(substr(raw2, 2)) AS raw3 FROM std2),
sal AS (
  SELECT * EXCLUDE (date),
    CASE WHEN contains(raw3, {_q(s.salary_account)})
         THEN CAST(date_trunc('month', date) + INTERVAL 1 MONTH AS DATE) ELSE date END AS date,
    CASE WHEN contains(raw3, {_q(s.salary_account)}) THEN {_q(s.salary_label)} ELSE raw3 END AS raw_category
  FROM std3
),
{resolve_cte('sal', s, 'raw_category')[1:]},
catmap AS (SELECT norm, category FROM labels),
transformed AS (
  SELECT sal.date, sal.particulars, sal.dr, sal.cr, sal.bank, sal.split, sal.len_split, sal.is_manual,
         sal.transaction_type, sal.transaction_no, sal.payment_to, sal.raw_category,
         r.sub AS SubCategory, coalesce(cm.category, {_q(s.unspecified_label)}) AS Category,
         left(sha256(
           coalesce(strftime(CAST(sal.date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), '') || '|' ||
           coalesce(lower({strip('sal.particulars')}), '') || '|' ||
           coalesce(regexp_replace(CAST(sal.dr AS VARCHAR), '0$', ''), '') || '|' ||
           coalesce(regexp_replace(CAST(sal.cr AS VARCHAR), '0$', ''), '')), 16) AS uuid,
         sal.file_name, sal.line_no
  FROM sal LEFT JOIN resolved r ON r.v IS NOT DISTINCT FROM sal.raw_category
           LEFT JOIN catmap cm ON cm.norm = lower({strip('r.sub')})
)"""


def _re_class(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "\\]^-[" else c for c in chars) + "]"


def with_transformed(s: Settings = DEFAULT) -> str:
    return "WITH " + synth_cte(s).strip() + "," + transform_cte(s)
