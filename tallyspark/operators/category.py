"""Two-level category resolution.

Sub-category: exact -> substring (longest label, then earliest) -> fuzzy
token-sort score >= threshold (best score, then earliest) -> fallback label.
Category: sub-category's parent (the later parent wins for labels listed
under two), unknown -> "Unspecified".

The taxonomy is configuration, bounded in size and independent of the data,
so it is compiled into literal maps / arrays and every tier is one native
expression evaluated inside the scan's projection: no join, no shuffle, and
no skew to worry about however the values are distributed.

With ``distinct=True`` the resolver instead runs once per distinct value and
joins the (value -> label) table back.  That table grows with the data, so
it is materialised to the checkpoint folder, its bytes are summed, and it is
broadcast only up to ``Settings.max_broadcast_bytes``; otherwise it is a shuffle
join that deals hot values over many parts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Settings
from ..functions.fuzzy import MAX_BITS, lcs_bits, lcs_dp, match_masks, ratio, token_sort, token_sort_py
from ..functions.literals import json_literal, string_map
from ..functions.text import norm
from ..plans.joins import lookup_join


@dataclass(frozen=True)
class Label:
    norm: str        # normalised label (strip, lower unless case-sensitive)
    label: str       # label text returned (last declaration wins)
    ord: int         # first declaration position (tie-break)
    category: str    # parent (last declaration wins)
    sorted: str      # token-sorted norm for the fuzzy tier


def _normalize_py(s: str, case_sensitive: bool) -> str:
    s = s.strip()
    return s if case_sensitive else s.lower()


def label_table(settings: Settings, case_sensitive: bool | None = None) -> list[Label]:
    """One entry per distinct normalised label."""
    cs = settings.case_sensitive if case_sensitive is None else case_sensitive
    by_norm: dict[str, Label] = {}
    for ord_, cat, lab in settings.taxonomy.entries():
        n = _normalize_py(lab, cs)
        first = by_norm.get(n)
        by_norm[n] = Label(n, lab, first.ord if first else ord_, cat, token_sort_py(n))
    return sorted(by_norm.values(), key=lambda l: l.ord)


_LABEL_DDL = ("array<struct<norm:string,label:string,ord:int,len:int,sorted:string,slen:int,"
              "masks:map<string,bigint>,full:bigint>>")


def _labels_array(labels: list[Label]) -> Column:
    items = []
    for l in labels:
        blen = len(l.sorted)
        short = blen <= MAX_BITS
        items.append({
            "norm": l.norm, "label": l.label, "ord": l.ord, "len": len(l.label),
            "sorted": l.sorted, "slen": blen,
            "masks": match_masks(l.sorted) if short else {},
            "full": (1 << blen) - 1 if short else 0,
        })
    return json_literal(items, _LABEL_DDL)


def _exact_map(labels: list[Label]) -> Column:
    return string_map((l.norm, l.label) for l in labels)


def tier_exact(v: Column, labels: list[Label]) -> Column:
    """C3."""
    return F.try_element_at(_exact_map(labels), v)


def tier_substring(v: Column, labels: list[Label]) -> Column:
    """C4: labels contained in the value; longest label, then earliest."""
    arr = _labels_array([l for l in labels if l.norm])
    hits = F.filter(arr, lambda l: v.contains(l["norm"]))
    best = F.array_max(F.transform(hits, lambda l: F.struct(
        l["len"].alias("len"), (-l["ord"]).alias("nord"), l["label"].alias("label"))))
    return best["label"]


def fuzzy_scores(v: Column, labels: list[Label], threshold: int) -> Column:
    """(score, -order, label) of every label that a length bound leaves.

    LCS <= min(|a|, |b|), so a label with 200*min(|a|,|b|) < threshold*(|a|+|b|)
    can never reach the threshold: the bound never drops a pair that could pass.
    Labels that fit a 64-bit mask are scored by bits, longer ones by the table.
    """
    short = [l for l in labels if len(l.sorted) <= MAX_BITS]
    long_ = [l for l in labels if len(l.sorted) > MAX_BITS]
    a = token_sort(v)
    la = F.length(a)

    def scored(arr: Column, lcs_of) -> Column:
        cand = F.filter(arr, lambda l: F.lit(200) * F.least(la, l["slen"]) >= F.lit(threshold) * (la + l["slen"]))
        return F.transform(cand, lambda l: F.struct(
            ratio(lcs_of(l), la, l["slen"]).alias("score"), (-l["ord"]).alias("nord"),
            l["label"].alias("label")))

    parts = []
    if short:
        parts.append(scored(_labels_array(short),
                            lambda l: lcs_bits(a, l["masks"], l["full"], l["slen"])))
    if long_:
        parts.append(scored(_labels_array(long_), lambda l: lcs_dp(a, l["sorted"])))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def tier_fuzzy(v: Column, labels: list[Label], threshold: int) -> Column:
    """Best token-sort score >= threshold; ties go to the earliest label."""
    best = F.array_max(fuzzy_scores(v, labels, threshold))
    return F.when(best["score"] >= F.lit(float(threshold)), best["label"])


def fuzzy_candidates(values: DataFrame, col: str, settings: Settings,
                     fuzzy_threshold: int | None = None) -> DataFrame:
    """C5 audit: for values no exact or substring label catches, the best
    pruned label and its score (whether or not it reaches the threshold)."""
    thr = settings.fuzzy_threshold if fuzzy_threshold is None else fuzzy_threshold
    labels = label_table(settings)
    v = norm(F.col(col), settings.case_sensitive)
    best = F.array_max(fuzzy_scores(v, labels, thr))
    open_ = F.col(col).isNotNull() & tier_exact(v, labels).isNull() & tier_substring(v, labels).isNull()
    out = values.select(F.col(col), open_.alias("__open"), best.alias("__best"))
    return (out.select(F.explode(F.filter(F.array(F.struct(
                F.col(col).alias(col), F.col("__best.label").alias("best_label"),
                F.col("__best.score").alias("score"))),
                lambda _: F.col("__open") & F.col("__best").isNotNull())).alias("r"))
               .select("r.*"))


def resolve_expr(src: Column, settings: Settings, manual_label: str | None = None,
                 case_sensitive: bool | None = None, fuzzy_threshold: int | None = None) -> Column:
    """C1 + C3..C6 as one expression over the raw value column."""
    cs = settings.case_sensitive if case_sensitive is None else case_sensitive
    thr = settings.fuzzy_threshold if fuzzy_threshold is None else fuzzy_threshold
    manual = settings.manual_label if manual_label is None else manual_label
    labels = label_table(settings, cs)
    v = norm(src, cs)
    return F.when(src.isNull(), F.lit(manual)).otherwise(F.coalesce(
        tier_exact(v, labels), tier_substring(v, labels), tier_fuzzy(v, labels, thr), F.lit(manual)))


def create_subcategory(df: DataFrame, settings: Settings, source_col: str = "raw_category",
                       target_col: str = "SubCategory", manual_label: str | None = None,
                       case_sensitive: bool | None = None, fuzzy_threshold: int | None = None,
                       distinct: bool = False) -> DataFrame:
    """C7."""
    if not distinct:
        return df.withColumn(target_col, resolve_expr(
            F.col(source_col), settings, manual_label, case_sensitive, fuzzy_threshold))
    values = df.groupBy(F.col(source_col).alias("__v")).agg(F.count(F.lit(1)).alias("n"))
    resolved = values.select("__v", "n", resolve_expr(
        F.col("__v"), settings, manual_label, case_sensitive, fuzzy_threshold).alias("__label"))
    return lookup_join(df, F.col(source_col), resolved, settings.max_broadcast_bytes).withColumnRenamed("__label", target_col)


def category_map(settings: Settings, case_sensitive: bool | None = None) -> Column:
    cs = settings.case_sensitive if case_sensitive is None else case_sensitive
    return string_map((l.norm, l.category) for l in label_table(settings, cs))


def create_category(df: DataFrame, settings: Settings, source_col: str = "SubCategory",
                    target_col: str = "Category", unspecified_label: str | None = None,
                    case_sensitive: bool | None = None) -> DataFrame:
    """C9."""
    cs = settings.case_sensitive if case_sensitive is None else case_sensitive
    unspecified = settings.unspecified_label if unspecified_label is None else unspecified_label
    v = norm(F.col(source_col), cs)
    return df.withColumn(target_col, F.coalesce(
        F.try_element_at(category_map(settings, cs), v), F.lit(unspecified)))


def audit_unresolved(df: DataFrame, source_col: str, target_col: str, label: str) -> DataFrame:
    """Distinct source values that fell to ``label``, with row counts."""
    return (df.filter(F.col(target_col) == label)
              .groupBy(F.col(source_col).alias("value"))
              .agg(F.count(F.lit(1)).alias("rows")))


def build_category_pipeline(df: DataFrame, settings: Settings, raw_col: str = "raw_category",
                            subcategory_col: str = "SubCategory", category_col: str = "Category",
                            fuzzy_threshold: int | None = None, distinct: bool = True) -> DataFrame:
    """C11."""
    df = create_subcategory(df, settings, raw_col, subcategory_col,
                            fuzzy_threshold=fuzzy_threshold, distinct=distinct)
    return create_category(df, settings, subcategory_col, category_col)
