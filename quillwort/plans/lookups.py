"""Queries of joins between images, labels, groups and runs, and of set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.paths import file_key, stem
from quillwort.operators import lookups, splits
from quillwort.plans.assignment import GREEDY
from quillwort.plans.inputs import CANDIDATES, MANIFEST, candidates, manifest
from quillwort.session import table


def _files(spark: SparkSession, d: str, name: str) -> DataFrame:
    key = file_key("path")
    return table(spark, d, name).select("file_id", key.alias("path"), F.split_part(key, F.lit("/"), F.lit(1)).alias("source"), stem(key).alias("stem"), *([F.col("n_lines")] if name == "label_files" else [F.col("n_bytes")]))


def _candidate_stems(spark: SparkSession, d: str) -> DataFrame:
    key = file_key("relative_path")
    return candidates(spark, d).withColumn("path", key).withColumn("stem", stem(key)).withColumn("label", file_key("label_path"))


def j1_image_label(spark: SparkSession, d: str) -> DataFrame:
    c = _candidate_stems(spark, d).where("stem is not null").select("record_id", "source", "stem")
    return lookups.with_label(c, _files(spark, d, "label_files").select("source", "stem", "n_lines"), ["source", "stem"], "n_lines").select("record_id", "n_lines")


def j2_label_fallback(spark: SparkSession, d: str) -> DataFrame:
    c = _candidate_stems(spark, d).select("record_id", F.col("label").alias("path"), "stem")
    return lookups.with_fallback(c, _files(spark, d, "label_files").select("path", "stem", "file_id"), "path", "stem", "file_id").select("record_id", "file_id", "matched_by")


def j3_label_resolution(spark: SparkSession, d: str) -> DataFrame:
    c = _candidate_stems(spark, d).select("record_id", F.col("label").alias("path"), "stem")
    return lookups.resolve_label(c, _files(spark, d, "label_files").select("path", "stem", "file_id"), "record_id", ["path", "stem"], "file_id")


def j4_group_split(spark: SparkSession, d: str) -> DataFrame:
    """Rows per source and newly assigned split; a row whose group has no assignment would fail the job."""
    m = manifest(spark, d).where("group_key is not null and source is not null")
    assigned = splits.assign_greedy(m.groupBy("source", "group_key").agg(F.count("*").alias("n")), "source", "group_key", "n").withColumnRenamed("split", "new_split")
    return lookups.lookup_complete(m, assigned, ["source", "group_key"], "new_split").groupBy("source", "new_split").agg(F.count("*").alias("n_rows"))


def j5_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Stems with an image but no label, and the other way round."""
    return lookups.both_ways_missing(_files(spark, d, "image_files"), _files(spark, d, "label_files"), "stem")


def j13_annotations(spark: SparkSession, d: str) -> DataFrame:
    """Annotations (line items) with their image (order) and category (part): boxes per category and image status."""
    a, i, c = table(spark, d, "lineitem"), table(spark, d, "orders"), table(spark, d, "part")
    joined = a.join(i, a.l_orderkey == i.o_orderkey).join(c, a.l_partkey == c.p_partkey)
    return joined.groupBy("p_type", "o_orderstatus").agg(F.count("*").alias("n_boxes"), F.countDistinct("o_orderkey").alias("n_images"))


def j14_kept_yields(spark: SparkSession, d: str) -> DataFrame:
    """Boxes per source and split of the rows that no drop names, and of all rows."""
    drops = table(spark, d, "dedupe_result").select(stem(file_key("path")).alias("stem")).distinct()
    m = manifest(spark, d).where("split is not null").withColumn("stem", stem(file_key("original_path")))
    kept = m.join(drops, "stem", "left_anti")
    before = m.groupBy("source", "split").agg(F.sum("n_boxes").alias("n_before"))
    after = kept.groupBy("source", "split").agg(F.sum("n_boxes").alias("n_after"))
    return before.join(after, ["source", "split"], "left").select("source", "split", "n_before", F.coalesce("n_after", F.lit(0)).alias("n_after"))


def j15_shared_families(spark: SparkSession, d: str) -> DataFrame:
    return lookups.shared_families(manifest(spark, d), "group_key", F.col("source"), "lotus_a", "lotus_b", F.col("split").isNull())


def j16_subset(spark: SparkSession, d: str) -> DataFrame:
    """Per source the candidate paths that the image list lacks."""
    c = _candidate_stems(spark, d).where("path is not null").select("source", "path").distinct()
    listed = _files(spark, d, "image_files").select("path").distinct()
    return c.join(listed, "path", "left_anti").groupBy("source").agg(F.count("*").alias("n_missing"))


def j17_stem_dims(spark: SparkSession, d: str) -> DataFrame:
    """Bytes per pixel of candidate images, matched by path rather than by position."""
    c = _candidate_stems(spark, d).where("width > 0 and height > 0").select("path", "width", "height").distinct()
    files = _files(spark, d, "image_files").groupBy("path").agg(F.max("n_bytes").alias("n_bytes"))
    return c.join(files, "path").groupBy("width", "height").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("n_bytes"))


def j18_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Listed label lines against audited boxes per source."""
    expected = _files(spark, d, "label_files").groupBy("source").agg(F.sum("n_lines").cast("long").alias("n"))
    actual = candidates(spark, d).where("source is not null").groupBy("source").agg(F.sum("n_boxes").alias("n"))
    return lookups.reconcile(expected, actual, "source", "n")


def j19_head_to_head(spark: SparkSession, d: str) -> DataFrame:
    """Mean value per event type and user, of the first fortnight against later."""
    e = table(spark, d, "events")
    early = F.dayofmonth("ts") <= 15
    mean = lambda df: df.groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 6).alias("value"))
    both = lookups.head_to_head(mean(e.where(early)), mean(e.where(~early)), ["user_id", "event_type"], "value")
    return both.withColumn("delta", F.round("delta", 6))


def j20_trajectory(spark: SparkSession, d: str) -> DataFrame:
    """Daily means of logins and purchases as one run of epochs."""
    e = table(spark, d, "events")
    run = lambda kind: e.where(F.col("event_type") == kind).groupBy(F.dayofmonth("ts").alias("epoch")).agg(F.round(F.avg("value"), 6).alias("value"))
    return lookups.stitch(run("view"), run("error"), "epoch")


def u1_setops(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the difference, intersection and union of the stems of both file lists."""
    a = _files(spark, d, "image_files").select("stem")
    b = _files(spark, d, "label_files").select("stem")
    parts = [("difference", a.subtract(b)), ("intersection", a.intersect(b)), ("union", a.union(b).distinct())]
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n") for name, df in parts]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def u2_distinct(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).select("source", "split").distinct()


def u3_union(spark: SparkSession, d: str) -> DataFrame:
    m = manifest(spark, d).select("source", F.col("original_path").alias("path"), "n_boxes")
    c = candidates(spark, d).select("source", F.col("relative_path").alias("path"), "n_boxes")
    return m.unionByName(c).groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("n_boxes").alias("n_boxes"))


def pr1_drop_paths(spark: SparkSession, d: str) -> DataFrame:
    """Incoming images that no earlier drop names, per batch."""
    drops = table(spark, d, "dedupe_result").select(file_key("matched_path").alias("key")).distinct()
    i = table(spark, d, "accepted_images").withColumn("key", file_key("path"))
    return i.join(drops, "key", "left_anti").groupBy(F.date_format("accepted_at", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


def pr2_drop_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Accepted images without those whose (split, stem) a drop of one source names."""
    drops = table(spark, d, "dedupe_result").where("category = 'vs_existing'").select("split", F.col("matched_stem").alias("stem")).distinct()
    return table(spark, d, "accepted_images").join(drops, ["split", "stem"], "left_anti").groupBy("split").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (
    j1_image_label, j2_label_fallback, j3_label_resolution, j4_group_split, j5_orphans, j13_annotations, j14_kept_yields, j15_shared_families,
    j16_subset, j17_stem_dims, j18_reconcile, j19_head_to_head, j20_trajectory, u1_setops, u2_distinct, u3_union, pr1_drop_paths, pr2_drop_pairs,
)}

_KEY = r"""nullif(regexp_replace(regexp_replace(array_to_string(list_filter(string_split(replace(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '\', '/'), '/'), lambda x: x not in ('', '.')), '/'), '[^/]+/\.\./', '', 'g'), '[^/]+/\.\./', '', 'g'), '')"""
_STEM = r"""regexp_replace(regexp_extract({c}, '([^/]*)$', 1), '(.)\.[^.]*$', '\1')"""


def _files_sql(t: str, name: str, value: str) -> str:
    return f"""{name} as (select file_id, path, split_part(path, '/', 1) as source, {_STEM.format(c='path')} as stem, {value} from (select * replace ({_KEY.format(c='path')} as path) from {t}))"""


_FILES = f"{_files_sql('image_files', 'img', 'n_bytes')}, {_files_sql('label_files', 'lab', 'n_lines')}"
_STEMS = f"""{CANDIDATES}, s as (select *, {_STEM.format(c='path')} as stem from (select *, {_KEY.format(c='relative_path')} as path, {_KEY.format(c='label_path')} as label from c))"""

SQL = {
    "j1_image_label": f"with {_STEMS}, {_FILES}, k as (select source, stem, max(n_lines) as n_lines from lab group by 1, 2) select record_id, coalesce(n_lines, 0) as n_lines from s left join k using (source, stem) where stem is not null",
    "j2_label_fallback": f"""with {_STEMS}, {_FILES}, a as (select path as label, min(file_id) as f from lab group by 1), b as (select stem, min(file_id) as f from lab group by 1)
        select record_id, coalesce(a.f, b.f) as file_id, case when a.f is not null then 'path' when b.f is not null then 'stem' end as matched_by from s left join a using (label) left join b using (stem)""",
    "j3_label_resolution": f"""with {_STEMS}, {_FILES}, a as (select path as label, min(file_id) as f, count(distinct file_id) as n from lab group by 1), b as (select stem, min(file_id) as f, count(distinct file_id) as n from lab group by 1)
        select record_id, case when coalesce(a.n, b.n) = 1 then coalesce(a.f, b.f) end as file_id, case when coalesce(a.n, b.n) is null then 'missing' when coalesce(a.n, b.n) = 1 then 'found' else 'ambiguous' end as status
        from s left join a using (label) left join b using (stem)""",
    "j4_group_split": f"""with recursive {MANIFEST}, g as (select source as unit, group_key, count(*) as n from m where group_key is not null and source is not null group by 1, 2),
        i as (select *, row_number() over (partition by unit order by n desc, group_key) as i, sum(n) over (partition by unit) as total from g), {GREEDY},
        done as (select i.unit, i.group_key, w.split as new_split from greedy w join i using (unit, i))
        select source, new_split, count(*) as n_rows from m join done on unit = source and done.group_key = m.group_key group by 1, 2""",
    "j5_orphans": f"""with {_FILES} select 'left' as side, stem from (select stem from img where stem is not null except select stem from lab)
        union all select 'right', stem from (select stem from lab where stem is not null except select stem from img)""",
    "j13_annotations": """select p_type, o_orderstatus, count(*) as n_boxes, count(distinct o_orderkey) as n_images
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey group by 1, 2""",
    "j14_kept_yields": f"""with {MANIFEST}, drops as (select distinct {_STEM.format(c='p')} as stem from (select {_KEY.format(c='path')} as p from dedupe_result)),
        k as (select *, {_STEM.format(c='p')} as stem from (select *, {_KEY.format(c='original_path')} as p from m where split is not null))
        select source, split, sum(n_boxes)::bigint as n_before, coalesce(sum(n_boxes) filter (not exists (select 1 from drops d where d.stem = k.stem)), 0)::bigint as n_after from k where source is not null group by 1, 2""",
    "j15_shared_families": f"""with {MANIFEST} select group_key, count(*) filter (source = 'lotus_a') as n_a, count(*) filter (source = 'lotus_b') as n_b, count(*) filter (split is null) as n_dropped
        from m where group_key is not null group by 1 having count(*) filter (source = 'lotus_a') > 0 and count(*) filter (source = 'lotus_b') > 0""",
    "j16_subset": f"with {_STEMS}, {_FILES} select source, count(distinct path) as n_missing from s where path is not null and path not in (select path from img where path is not null) group by 1",
    "j17_stem_dims": f"""with {_STEMS}, {_FILES}, f as (select path, max(n_bytes) as n_bytes from img group by 1), k as (select distinct path, width, height from s where width > 0 and height > 0)
        select width, height, count(*) as n, sum(n_bytes)::bigint as n_bytes from k join f using (path) group by 1, 2""",
    "j18_reconcile": f"""with {CANDIDATES}, {_FILES}, e as (select source, sum(n_lines)::bigint as expected from lab group by 1), a as (select source, sum(n_boxes)::bigint as actual from c where source is not null group by 1)
        select source, expected, actual, case when expected is not distinct from actual then 'PASS' else 'FAIL' end as status from e full join a using (source)""",
    "j19_head_to_head": """with a as (select user_id, event_type, round(avg(value), 6) as v from events where day(ts) <= 15 group by 1, 2), b as (select user_id, event_type, round(avg(value), 6) as v from events where day(ts) > 15 group by 1, 2)
        select user_id, event_type, coalesce(a.v, 0) as control, coalesce(b.v, 0) as treatment, round(coalesce(b.v, 0) - coalesce(a.v, 0), 6) as delta from a full join b using (user_id, event_type)""",
    "j20_trajectory": """with a as (select day(ts)::int as epoch, round(avg(value), 6) as value from events where event_type = 'view' group by 1), b as (select day(ts)::int as epoch, round(avg(value), 6) as value from events where event_type = 'error' group by 1)
        select epoch, value from a union all select epoch + (select coalesce(max(epoch), 0) from a), value from b""",
    "u1_setops": f"""with {_FILES} select 'difference' as op, count(*) as n from (select stem from img except select stem from lab)
        union all select 'intersection', count(*) from (select stem from img intersect select stem from lab) union all select 'union', count(*) from (select stem from img union select stem from lab)""",
    "u2_distinct": f"with {MANIFEST} select distinct source, split from m",
    "u3_union": f"with {MANIFEST}, {CANDIDATES} select source, count(*) as n_rows, sum(n_boxes)::bigint as n_boxes from (select source, n_boxes from m union all select source, n_boxes from c) group by 1",
    "pr1_drop_paths": f"""with drops as (select {_KEY.format(c='matched_path')} as key from dedupe_result), i as (select *, {_KEY.format(c='path')} as key from accepted_images)
        select strftime(accepted_at, '%Y-%m') as month, count(*) as n from i where not exists (select 1 from drops d where d.key = i.key) group by 1""",
    "pr2_drop_pairs": """select split, count(*) as n from accepted_images i where not exists (select 1 from dedupe_result d where d.category = 'vs_existing' and d.split = i.split and d.matched_stem = i.stem) group by 1""",
}
