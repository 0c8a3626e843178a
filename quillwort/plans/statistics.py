"""Queries of sessions and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.names import SPLITS
from quillwort.operators import stats
from quillwort.operators.sessions import sessionize
from quillwort.plans.inputs import CANDIDATES, MANIFEST, candidates, manifest
from quillwort.session import table


def w1_sessionize(spark: SparkSession, d: str) -> DataFrame:
    s = sessionize(table(spark, d, "events"), ["user_id"], "ts", "event_id")
    return s.select("event_id", "session_no", "session_id")


def a1_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))


def a2_session_sizes(spark: SparkSession, d: str) -> DataFrame:
    s = sessionize(table(spark, d, "events"), ["user_id"], "ts", "event_id")
    sizes = s.groupBy("user_id", "session_id").agg(F.count("*").alias("n"))
    return sizes.groupBy("user_id").agg(
        F.count("*").alias("n_sessions"), F.min("n").alias("size_min"), F.max("n").alias("size_max"), F.floor(F.percentile("n", 0.5)).alias("size_median")
    )


def a3_group_mix(spark: SparkSession, d: str) -> DataFrame:
    m = manifest(spark, d).where("group_key is not null")
    return stats.composition(m, ["source", "group_key"], F.col("split"), list(SPLITS))


def a3_group_mix_json(spark: SparkSession, d: str) -> DataFrame:
    return stats.composition_json(manifest(spark, d).where("group_key is not null"), ["source", "group_key"], F.col("split"))


def a4_rollup(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).where("source is not null and split is not null").rollup("source", "split").agg(F.count("*").alias("n_rows"), F.sum("n_boxes").alias("n_boxes"))


def a5_distinct_groups(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).groupBy("source").agg(F.countDistinct("group_key").alias("n_groups"))


def a6_fd_violations(spark: SparkSession, d: str) -> DataFrame:
    return stats.dependency_violations(manifest(spark, d), "group_key", "split")


def a7_fd_specified(spark: SparkSession, d: str) -> DataFrame:
    return stats.dependency_violations(candidates(spark, d), "group_key", "split")


def a9_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return stats.exact_percentiles(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", {"p10": 0.1, "median": 0.5, "p99": 0.99})


def a10_shares(spark: SparkSession, d: str) -> DataFrame:
    return stats.share_below(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", 8)


def a11_dims_mode(spark: SparkSession, d: str) -> DataFrame:
    m = manifest(spark, d).where("width > 0 and height > 0")
    size = F.concat_ws("x", F.col("width").cast("string"), F.col("height").cast("string"))
    ends = m.groupBy("source").agg(*[f(c).alias(f"{c}_{n}") for c in ("width", "height") for n, f in (("min", F.min), ("max", F.max))])
    return ends.join(stats.mode_with_tie(m, ["source"], size, "row_id"), "source").withColumn("consistent", F.col("n_distinct") == 1)


def a12_hist_of_hist(spark: SparkSession, d: str) -> DataFrame:
    return stats.histogram_of_counts(table(spark, d, "lineitem"), "l_orderkey", "n_lines")


def a14_class_freq(spark: SparkSession, d: str) -> DataFrame:
    return stats.set_frequency(manifest(spark, d).where("split = 'train'"), "mapped_class").withColumn("share", F.round("share", 9))


def a15_class_yields(spark: SparkSession, d: str) -> DataFrame:
    drops = table(spark, d, "dedupe_result").select("donor").distinct().select(F.translate(F.lower(F.trim("donor")), "-", "_").alias("source"), F.lit(1).alias("gone")).distinct()
    rows = manifest(spark, d).where("split is not null").join(drops, "source", "left")
    rows = rows.withColumn("class", F.explode(F.split(F.coalesce("mapped_class", F.lit("")), r"\+"))).where("class <> ''")
    return rows.groupBy("class", "split").agg(F.count("*").alias("n_before"), F.count_if(F.col("gone").isNull()).alias("n_after"))


def a16_macro(spark: SparkSession, d: str) -> DataFrame:
    per = manifest(spark, d).where("split is not null").groupBy("split", "source").agg(F.round(F.avg((F.col("n_boxes") > 0).cast("double")), 6).alias("rate"))
    return stats.macro_average(per, ["split"], "rate", 4)


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    one = lambda c: F.when(~F.contains(F.col(c), F.lit("+")) & (F.col(c) != ""), F.lower(F.trim(F.col(c))))
    return manifest(spark, d).select(one("original_class").alias("truth"), one("mapped_class").alias("predicted"))


def a17_confusion(spark: SparkSession, d: str) -> DataFrame:
    return stats.confusion_counts(_labelled(spark, d), "truth", "predicted")


def a18_class_metrics(spark: SparkSession, d: str) -> DataFrame:
    return stats.class_metrics(stats.confusion_counts(_labelled(spark, d), "truth", "predicted"))


def a20_bytes(spark: SparkSession, d: str) -> DataFrame:
    top = F.split_part(F.regexp_replace(F.translate(F.trim("path"), "\\", "/"), r"^\./", ""), F.lit("/"), F.lit(1))
    sums = table(spark, d, "image_files").groupBy(top.alias("folder")).agg(F.count("*").alias("n_files"), F.sum("n_bytes").alias("n_bytes"))
    return sums.withColumn("size", stats.human_bytes(F.col("n_bytes")))


def a21_list_digest(spark: SparkSession, d: str) -> DataFrame:
    return stats.list_digests(table(spark, d, "manifest"), "mapped_class", "row_id", F.col("original_path"))


def a22_tree_digest(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.col("doc_id").cast("string"), F.lit(" "), F.sha2(F.coalesce("text", F.lit("")), 256))
    return stats.list_digests(table(spark, d, "documents"), "source", "doc_id", line)


def a23_candidate_counts(spark: SparkSession, d: str) -> DataFrame:
    c = candidates(spark, d)
    tiny = (F.col("n_boxes") > 0) & (F.col("width") <= 640)
    return c.groupBy("batch_id").agg(
        F.count("*").alias("n_records"), F.sum("n_boxes").alias("n_boxes"), F.count_if("empty_label").alias("n_empty"),
        F.coalesce(F.round(F.try_divide(F.count_if(tiny).cast("double"), F.count_if(F.col("n_boxes") > 0)), 6), F.lit(0.0)).alias("small_share"),
    )


def a24_sizes(spark: SparkSession, d: str) -> DataFrame:
    c = candidates(spark, d)
    return c.where("width > 0 and height > 0").groupBy("width", "height").agg(F.count("*").alias("n"), F.countDistinct("digest").alias("n_digests"))


QUERIES = {f.__name__: f for f in (
    w1_sessionize, a1_counts, a2_session_sizes, a3_group_mix, a3_group_mix_json, a4_rollup, a5_distinct_groups, a6_fd_violations, a7_fd_specified,
    a9_percentiles, a10_shares, a11_dims_mode, a12_hist_of_hist, a14_class_freq, a15_class_yields, a16_macro, a17_confusion, a18_class_metrics,
    a20_bytes, a21_list_digest, a22_tree_digest, a23_candidate_counts, a24_sizes,
)}

_SESSIONS = """s as (
  select *, sum(new) over (partition by user_id, day order by ts, event_id rows unbounded preceding)::int as session_no from (
    select *, ts::date as day, case when ts - lag(ts) over (partition by user_id, ts::date order by ts, event_id) <= interval 600 second then 0 else 1 end as new from events)),
named as (select *, format('s_{}_{}_s{:02d}', user_id, strftime(day, '%Y%m%d'), session_no) as session_id from s)"""
_LABELLED = """l as (
  select case when position('+' in original_class) = 0 and original_class <> '' then lower(trim(original_class)) end as truth,
    case when position('+' in mapped_class) = 0 and mapped_class <> '' then lower(trim(mapped_class)) end as predicted from m),
k as (
  select class, count(*) filter (truth = class and predicted = class)::bigint as tp, count(*) filter (truth = class and predicted is distinct from class)::bigint as fn,
    count(*) filter (truth is distinct from class and predicted = class)::bigint as fp
  from l, (select truth as class from l where truth is not null union select predicted from l where predicted is not null) group by class)"""
_VIOLATIONS = """select group_key, count(distinct split) as n_values, string_agg(distinct split, '+' order by split) as found
  from {t} where group_key is not null group by 1 having count(distinct split) > 1"""
_DIGEST = """
  with p as (select {by} as k, floor({order} / 1000)::bigint as chunk, count(*) as n, sha256(string_agg({line}, chr(10) order by {order}) || chr(10)) as d from {t} group by 1, 2)
  select k as {by}, sum(n)::bigint as n_lines, sha256(string_agg(d, chr(10) order by chunk)) as digest from p group by 1"""

SQL = {
    "w1_sessionize": f"with {_SESSIONS} select event_id, session_no, session_id from named",
    "a1_counts": "select event_type, count(*) as n from events group by 1",
    "a2_session_sizes": f"""with {_SESSIONS}, z as (select user_id, session_id, count(*) as n from named group by 1, 2)
        select user_id, count(*) as n_sessions, min(n) as size_min, max(n) as size_max, floor(quantile_cont(n, 0.5))::bigint as size_median from z group by 1""",
    "a3_group_mix": f"""with {MANIFEST} select source, group_key, count(*) filter (split = 'train') as n_train, count(*) filter (split = 'val') as n_val,
        count(*) filter (split = 'test') as n_test, count(*) filter (split is null) as n_unsplit from m where group_key is not null group by 1, 2""",
    "a3_group_mix_json": f"""with {MANIFEST}, k as (select source, group_key, coalesce(split, 'unsplit') as s, count(*) as n from m where group_key is not null group by all)
        select source, group_key, '{{' || string_agg('"' || s || '":' || n, ',' order by s) || '}}' as mix from k group by 1, 2""",
    "a4_rollup": f"with {MANIFEST} select source, split, count(*) as n_rows, sum(n_boxes)::bigint as n_boxes from m where source is not null and split is not null group by rollup (source, split)",
    "a5_distinct_groups": f"with {MANIFEST} select source, count(distinct group_key) as n_groups from m group by 1",
    "a6_fd_violations": f"with {MANIFEST} {_VIOLATIONS.format(t='m')}",
    "a7_fd_specified": f"with {CANDIDATES} {_VIOLATIONS.format(t='c')}",
    "a9_percentiles": """select l_returnflag, quantile_cont(l_extendedprice, 0.1) as p10, quantile_cont(l_extendedprice, 0.5) as median,
        quantile_cont(l_extendedprice, 0.99) as p99 from lineitem group by 1""",
    "a10_shares": "select l_returnflag, avg((l_quantity < 8)::double) as share from lineitem group by 1",
    "a11_dims_mode": f"""with {MANIFEST}, k as (select * from m where width > 0 and height > 0),
        z as (select source, width || 'x' || height as size, count(*) as n, min(row_id) as f from k group by 1, 2),
        b as (select source, arg_min(size, (-n, f)) as mode, max(n) as mode_count, count(*) as n_distinct from z group by 1)
        select source, min(width) as width_min, max(width) as width_max, min(height) as height_min, max(height) as height_max,
          any_value(mode) as mode, any_value(mode_count) as mode_count, any_value(n_distinct) as n_distinct, any_value(n_distinct) = 1 as consistent
        from k join b using (source) group by 1""",
    "a12_hist_of_hist": "select n_lines, count(*) as n_keys from (select l_orderkey, count(*) as n_lines from lineitem group by 1) group by 1",
    "a14_class_freq": f"""with {MANIFEST}, t as (select * from m where split = 'train'),
        e as (select row_id, unnest(list_distinct(string_split(coalesce(mapped_class, ''), '+'))) as value from t)
        select value, count(*) as n_rows, round(count(*)::double / (select count(*) from t), 9) as share from e where value <> '' group by 1""",
    "a15_class_yields": f"""with {MANIFEST}, gone as (select distinct replace(lower(trim(donor)), '-', '_') as source from dedupe_result),
        e as (select source, split, unnest(string_split(coalesce(mapped_class, ''), '+')) as class from m where split is not null)
        select class, split, count(*) as n_before, count(*) filter (not exists (select 1 from gone g where g.source = e.source)) as n_after from e where class <> '' group by 1, 2""",
    "a16_macro": f"""with {MANIFEST}, p as (select split, source, round(avg((n_boxes > 0)::double), 6) as rate from m where split is not null group by 1, 2)
        select split, coalesce(round(avg(rate), 4), 0) as macro from p group by 1""",
    "a17_confusion": f"with {MANIFEST}, {_LABELLED} select * from k",
    "a18_class_metrics": f"""with {MANIFEST}, {_LABELLED}, r as (
          select class, tp + fn > 0 as present, case when tp + fn > 0 then coalesce(tp::double / nullif(tp + fp, 0), 0) end as p, case when tp + fn > 0 then tp::double / (tp + fn) end as r from k)
        select class, present, round(p, 6) as precision, round(r, 6) as recall, round(2 * p * r / (p + r + 1e-16), 6) as f1 from r""",
    "a20_bytes": r"""with z as (select split_part(regexp_replace(replace(trim(path), '\', '/'), '^\./', ''), '/', 1) as folder, count(*) as n_files, sum(n_bytes)::bigint as n_bytes from image_files group by 1)
        select *, case when n_bytes < 1000 then n_bytes || ' B' when n_bytes < 1000000 then format('{:.1f} KB', n_bytes / 1e3) when n_bytes < 1000000000 then format('{:.1f} MB', n_bytes / 1e6)
          when n_bytes < 1000000000000 then format('{:.1f} GB', n_bytes / 1e9) else format('{:.1f} TB', n_bytes / 1e12) end as size from z""",
    "a21_list_digest": _DIGEST.format(by="mapped_class", order="row_id", line="coalesce(original_path, '')", t="manifest"),
    "a22_tree_digest": _DIGEST.format(by="source", order="doc_id", line="doc_id || ' ' || sha256(coalesce(text, ''))", t="documents"),
    "a23_candidate_counts": f"""with {CANDIDATES} select batch_id, count(*) as n_records, sum(n_boxes)::bigint as n_boxes, count(*) filter (empty_label) as n_empty,
        coalesce(round(count(*) filter (n_boxes > 0 and width <= 640)::double / nullif(count(*) filter (n_boxes > 0), 0), 6), 0) as small_share from c group by 1""",
    "a24_sizes": f"with {CANDIDATES} select width, height, count(*) as n, count(distinct digest) as n_digests from c where width > 0 and height > 0 group by 1, 2",
}
