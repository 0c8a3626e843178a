"""Queries of scalar functions, mappings, predicates, label lines and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions import grouping, names, paths
from quillwort.functions.bits import hamming
from quillwort.operators import mapping
from quillwort.operators.checks import in_unit_range
from quillwort.operators.tiling import to_centre, to_corners
from quillwort.plans.inputs import MANIFEST, manifest
from quillwort.session import fresh_path, table
from quillwort.sources import readers, sinks
from quillwort.sources.labels import VARIANTS, bad_lines, format_box, line_issues, parse_boxes


def f3_hamming(spark: SparkSession, d: str) -> DataFrame:
    """Distances of accepted images that follow each other by id."""
    a = table(spark, d, "accepted_images").select("image_id", F.col("phash").alias("a"))
    b = a.select((F.col("image_id") - 1).alias("image_id"), F.col("a").alias("b"))
    return a.join(b, "image_id").select("image_id", hamming(F.col("a"), F.col("b")).alias("distance"))


def f5_digests(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text").cast("binary")
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.md5(t).alias("md5"), F.sha2(t, 256).alias("sha256"))


def f6_time_key(spark: SparkSession, d: str) -> DataFrame:
    digits = F.regexp_extract("path", r"_\d{8}_(\d{6})_", 1)
    return table(spark, d, "accepted_images").select("image_id", grouping.seconds_of_day(digits).alias("second")).where("second is not null")


def f7_prefix_group(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "incoming_images").select("image_id", grouping.prefix_group(F.col("stem"), "g_").alias("grp"))


def f9_family_group(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "incoming_images").select("image_id", grouping.family_group(F.col("stem"), "fam_", "CLIP_").alias("grp"))


def f10_export_group(spark: SparkSession, d: str) -> DataFrame:
    """Groups of the stems by their export suffix; null for stems without one, which would fail a job that takes them all."""
    stem = F.col("stem")
    group = F.when(stem.rlike(grouping.EXPORT), grouping.export_group(stem, "x_"))
    return table(spark, d, "incoming_images").select("image_id", group.alias("grp"))


def f11_soft_strip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "incoming_images").select("image_id", grouping.export_group(F.col("stem"), "", strict=False).alias("grp"))


def f12_candidate_group(spark: SparkSession, d: str) -> DataFrame:
    key = paths.file_key("relative_path")
    c = table(spark, d, "candidate_records").select("record_id", key.alias("path")).where("path is not null").withColumn("stem", paths.stem("path"))
    modes = F.array(*[F.struct(F.lit(m).alias("mode"), grouping.candidate_group(F.col("path"), F.col("stem"), m).alias("grp")) for m in ("per-image", "auto", "stem")])
    return c.select("record_id", F.inline(modes))


def f13_path_split(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "incoming_images").select("image_id", paths.split_of_path("path").alias("split"))


def f14_label_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest").select("row_id", names.label_text("original_class").alias("label"))


def f15_corners(spark: SparkSession, d: str) -> DataFrame:
    """Centre form to corners and back, of boxes that line items give."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_discount").alias("cx"), F.max("l_tax").alias("cy"), F.min("l_discount").alias("w"), F.min("l_tax").alias("h"))
    corners = lines.select("l_orderkey", *to_corners(F.col("cx"), F.col("cy"), F.col("w"), F.col("h")))
    back = corners.select("l_orderkey", "x_min", "y_max", *to_centre(F.col("x_min"), F.col("y_min"), F.col("x_max"), F.col("y_max")))
    return back.select("l_orderkey", *[F.round(c, 6).alias(c) for c in ("x_min", "y_max", "cx", "cy", "w", "h")])


def f19_rounding(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.round("p_retailprice", 1).alias("half_up"), F.bround(F.col("p_retailprice").cast("decimal(18,2)"), 1).cast("double").alias("half_even"), F.floor("p_retailprice").alias("floored"))


def f20_json(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, d, "events").select("event_id", k.alias("k"), F.to_json(F.struct(F.col("event_type").alias("a"), k.alias("b"))).alias("packed"))


def f21_set_strings(spark: SparkSession, d: str) -> DataFrame:
    values = F.array_union(mapping.expand_set(F.col("mapped_class")), mapping.expand_set(F.lower("original_class")))
    return table(spark, d, "manifest").select("row_id", mapping.join_set(values).alias("classes"))


def f22_casefold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "image_files").select(F.lower("path").alias("key")).groupBy("key").agg(F.count("*").alias("n"))


def f23_format(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.max("l_discount").alias("x"), F.min("l_tax").alias("y"))
    x, y = F.col("x"), F.col("y")
    return t.select("l_suppkey", F.lpad(F.col("l_suppkey").cast("string"), 9, "0").alias("padded"), format_box(F.lit(1), x, y, x, y).alias("line"))


def f24_truncate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.substring("text", 1, 60).alias("excerpt"))


def f25_label_path(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "accepted_images").select("image_id", paths.label_path_of("path").alias("label_path"))


def pr3_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """Part types mapped by a vocabulary table; an unknown type would fail the job."""
    parts = table(spark, d, "part")
    vocabulary = parts.groupBy("p_type").agg(F.min("p_partkey").alias("type_id")).withColumnRenamed("p_type", "name")
    return mapping.vocabulary_class(parts, "p_type", vocabulary, "name", "type_id").select("p_partkey", "type_id")


def pr4_alias_map(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "manifest").select("row_id", F.explode(mapping.expand_set(F.col("original_class"))).alias("name"))
    return m.groupBy("name").agg(F.count("*").alias("n")).select("name", "n", mapping.alias_class("name", {"Floating Debris": "litter"}).alias("class"))


def pr5_taxonomies(spark: SparkSession, d: str) -> DataFrame:
    m = manifest(spark, d).select(F.explode(mapping.expand_set(F.col("mapped_class"))).alias("name"))
    return m.select(*mapping.class_ids(F.col("name"))).groupBy("id3", "id2").agg(F.count("*").alias("n"))


def pr6_partition(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).groupBy((F.col("n_boxes") == 0).alias("empty"), "split").agg(F.count("*").alias("n"))


def pr7_range_check(spark: SparkSession, d: str) -> DataFrame:
    inside = in_unit_range(F.array("l_discount", "l_tax", F.col("l_quantity") / 50))
    return table(spark, d, "lineitem").groupBy(inside.alias("inside")).agg(F.count("*").alias("n"))


def pr9_escaping_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths as written that could leave their root: absolute, with a drive, or with a `..` step."""
    p = F.translate(F.trim("relative_path"), "\\", "/")
    escaping = p.rlike(r"^(/|[A-Za-z]:)|(^|/)\.\.(/|$)")
    return table(spark, d, "candidate_records").where(escaping).select("record_id")


def pr10_rebase(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "accepted_images").select("image_id", paths.rebase("path", "images/", "/data").alias("path"))


def pr13_slug(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", names.safe_slug(F.concat(F.lit(" ."), "c_name", F.lit(" / "), "c_mktsegment", F.lit("!-"))).alias("slug"))


def _label_lines(spark: SparkSession, d: str) -> DataFrame:
    """All lines of documents, read as label lines, whatever they are."""
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def s4_parse_lines(spark: SparkSession, d: str) -> DataFrame:
    boxes = parse_boxes(_label_lines(spark, d), "line", "eq5", "record", ("range", "size", "class"), 3)
    return boxes.select("doc_id", "line_no", "cls", "cx", "cy", "w", "h", F.array_join("issues", ";").alias("issues"))


def s4_bad_lines(spark: SparkSession, d: str) -> DataFrame:
    bad = bad_lines(_label_lines(spark, d), "line", "eq5", ("range", "size", "class"), 3)
    return bad.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


def s4_levels(spark: SparkSession, d: str) -> DataFrame:
    """For each way to read label lines what it makes of the lines of all documents: kept, and with an issue; counters only count."""
    lines = _label_lines(spark, d)
    parts = []
    for name, v in VARIANTS.items():
        found = line_issues("line", v["arity"], v["checks"], 3, v.get("cls", "int"))
        bad = F.size(found) > 0
        kept = ~bad if v["on_error"] != "record" else ~F.arrays_overlap(found, F.array(F.lit("expected_5_fields"), F.lit("not_numeric")))
        parts.append(F.struct(F.lit(name).alias("level"), kept.alias("kept"), bad.alias("bad")))
    five = F.size(F.split(F.trim("line"), r"\s+")) == 5
    for name, counted in (("count_nonblank", F.lit(True)), ("count_five", five)):
        parts.append(F.struct(F.lit(name).alias("level"), counted.alias("kept"), (~counted).alias("bad")))
    rows = lines.where(F.trim("line") != "").select(F.explode(F.array(*parts)).alias("x"))
    return rows.groupBy("x.level").agg(F.count_if("x.kept").alias("n_kept"), F.count_if("x.bad").alias("n_bad"))


def s11_tag_strip(spark: SparkSession, d: str) -> DataFrame:
    text = F.regexp_replace("text", r"<[^>]+>", "\n")
    return table(spark, d, "documents").select("doc_id", text.alias("text"))


def k1_csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Customers written as CSV and read again under their schema."""
    customers, path = table(spark, d, "customer"), fresh_path(spark, "csv")
    sinks.write_csv(customers, path)
    return readers.read_csv(spark, path, customers.schema, ("c_custkey",))


def k5_lists(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the list files of each source and split, train rows repeated as often as the manifest says."""
    m = table(spark, d, "manifest").select(names.source_key("source").alias("source"), names.split_key("split").alias("split"), "original_path", "rfs_repeat").where("source is not null and split is not null")
    rows = m.withColumn("n", F.when(F.col("split") == "train", F.coalesce("rfs_repeat", F.lit(1))).otherwise(1))
    path = fresh_path(spark, "lists")
    sinks.write_lists(rows, F.coalesce("original_path", F.lit("")), ["source", "split"], path, "n")
    return spark.read.option("basePath", path).text(path).groupBy("source", "split").agg(F.count("*").alias("n_lines"))


def k10_cache(spark: SparkSession, d: str) -> DataFrame:
    """A digest cache filled for even ids, then for all: only what it lacks is added."""
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))
    path = fresh_path(spark, "cache")
    sinks.append_cache(rows.where("doc_id % 2 = 0"), path, "doc_id")
    return sinks.append_cache(rows, path, "doc_id")


def k4_label_texts(spark: SparkSession, d: str) -> DataFrame:
    boxes = parse_boxes(_label_lines(spark, d), "line", "eq5", "drop", ("range", "size", "class"), 3)
    named = boxes.withColumn("id2", F.when(F.col("cls") == 2, 0).otherwise(F.col("cls")))
    return sinks.label_texts(named, ["doc_id"], "line_no", {"cls": "text3", "id2": "text2"})


QUERIES = {f.__name__: f for f in (
    f3_hamming, f5_digests, f6_time_key, f7_prefix_group, f9_family_group, f10_export_group, f11_soft_strip, f12_candidate_group, f13_path_split,
    f14_label_text, f15_corners, f19_rounding, f20_json, f21_set_strings, f22_casefold, f23_format, f24_truncate, f25_label_path, pr3_vocabulary,
    pr4_alias_map, pr5_taxonomies, pr6_partition, pr7_range_check, pr9_escaping_paths, pr10_rebase, pr13_slug, s4_parse_lines, s4_bad_lines, s4_levels,
    s11_tag_strip, k1_csv_round_trip, k4_label_texts, k5_lists, k10_cache,
)}

_LINES = r"""l as (select doc_id, i - 1 as line_no, line from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents)
  where trim(line, ' ') <> ''),
f as (select *, regexp_split_to_array(trim(line, ' '), '\s+') as f from l),
v as (select doc_id, line_no, f, try_cast(f[1] as int) as cls, try_cast(f[2] as double) as cx, try_cast(f[3] as double) as cy, try_cast(f[4] as double) as w, try_cast(f[5] as double) as h from f),
k as (select *, len(f) = 5 as right_, cls is not null and cx is not null and cy is not null and w is not null and h is not null as numeric_,
  list_filter([case when not (cx between 0 and 1 and cy between 0 and 1 and w between 0 and 1 and h between 0 and 1) then 'coordinate_out_of_range' end,
    case when not (w > 0 and h > 0) then 'non_positive_box' end, case when not (cls >= 0 and cls < 3) then 'class_out_of_range' end], lambda x: x is not null) as issues from v)"""
_BOX = "format('{{:d}} {{:.6f}} {{:.6f}} {{:.6f}} {{:.6f}}', {0}, cx, cy, w, h)"
_KEY = r"""nullif(regexp_replace(regexp_replace(array_to_string(list_filter(string_split(replace(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '\', '/'), '/'), lambda x: x not in ('', '.')), '/'), '[^/]+/\.\./', '', 'g'), '[^/]+/\.\./', '', 'g'), '')"""
_EXPORT = r"(?i)^(.+)_[A-Za-z0-9]+\.rf\.[0-9a-f]{32}$"
_CASES = r"""case when not regexp_matches({bare}, '(?i)^.+_frame_[0-9]+(_(jpg|jpeg|png|webp))?$') then {other} else 'frame_' || lower(regexp_extract({bare}, '(?i)^(.+)_frame_[0-9]+(?:_(?:jpg|jpeg|png|webp))?$', 1)) end"""

SQL = {
    "f3_hamming": "select a.image_id, bit_count(xor(a.phash, b.phash))::int as distance from accepted_images a join accepted_images b on b.image_id = a.image_id + 1",
    "f5_digests": "select doc_id, md5(text) as md5, sha256(text) as sha256 from documents where text is not null",
    "f6_time_key": r"""with k as (select image_id, regexp_extract(path, '_[0-9]{8}_([0-9]{6})_', 1) as s from accepted_images)
        select image_id, s[1:2]::int * 3600 + s[3:4]::int * 60 + s[5:6]::int as second from k where s <> ''""",
    "f7_prefix_group": "select image_id, 'g_' || split_part(stem, '_', 1) as grp from incoming_images",
    "f9_family_group": "select image_id, case when starts_with(stem, 'CLIP_') then 'fam_v' || split_part(stem, '_', 1) || '_' || split_part(stem, '_', 2) else 'fam_' || stem end as grp from incoming_images",
    "f10_export_group": rf"select image_id, case when regexp_matches(stem, '{_EXPORT}') then 'x_' || lower(regexp_extract(stem, '{_EXPORT}', 1)) end as grp from incoming_images",
    "f11_soft_strip": r"""select image_id, coalesce(nullif(regexp_extract(stem, '(?i)^(.+)_(?:jpg|png)\.rf\.[0-9a-f]{32}$', 1), ''), stem) as grp from incoming_images""",
    "f12_candidate_group": rf"""with k as (select record_id, {_KEY.format(c='relative_path')} as path from candidate_records),
        s as (select record_id, path, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') as stem from k where path is not null),
        b as (select *, coalesce(nullif(regexp_extract(stem, '{_EXPORT}', 1), ''), stem) as bare from s)
        select record_id, 'per-image' as mode, 'img_' || path as grp from b
        union all select record_id, 'auto', {_CASES.format(bare='bare', other="'img_' || path")} from b
        union all select record_id, 'stem', {_CASES.format(bare='bare', other="'stem_' || lower(bare)")} from b""",
    "f13_path_split": r"""with k as (select image_id, string_split_regex(lower(path), '[/\\]') as p from incoming_images)
        select image_id, case when list_contains(p, 'train') then 'train' when list_has_any(p, ['val', 'valid', 'validation']) then 'val' when list_contains(p, 'test') then 'test' when p is null then 'unspecified' else 'unspecified' end as split from k""",
    "f14_label_text": r"select row_id, regexp_replace(replace(lower(trim(original_class)), '-', '_'), '\s+', ' ', 'g') as label from manifest",
    "f15_corners": """with k as (select l_orderkey, max(l_discount) as cx, max(l_tax) as cy, min(l_discount) as w, min(l_tax) as h from lineitem group by 1),
        c as (select l_orderkey, cx - w / 2 as x_min, cy - h / 2 as y_min, cx + w / 2 as x_max, cy + h / 2 as y_max from k)
        select l_orderkey, round(x_min, 6) as x_min, round(y_max, 6) as y_max, round((x_min + x_max) / 2, 6) as cx, round((y_min + y_max) / 2, 6) as cy, round(x_max - x_min, 6) as w, round(y_max - y_min, 6) as h from c""",
    "f19_rounding": """with k as (select *, round(p_retailprice * 100)::bigint as c from part)
        select p_partkey, round(p_retailprice, 1) as half_up, (c // 10 + (c % 10 > 5 or (c % 10 = 5 and (c // 10) % 2 = 1))::bigint)::double / 10 as half_even, floor(p_retailprice)::bigint as floored from k""",
    "f20_json": """select event_id, (props->>'$.k')::bigint as k, '{"a":"' || event_type || '","b":' || (props->>'$.k') || '}' as packed from events""",
    "f21_set_strings": """select row_id, array_to_string(list_sort(list_distinct(list_filter(list_concat(string_split(coalesce(mapped_class, ''), '+'), string_split(coalesce(lower(original_class), ''), '+')), lambda x: x <> ''))), '+') as classes from manifest""",
    "f22_casefold": "select lower(path) as key, count(*) as n from image_files group by 1",
    "f23_format": f"""with k as (select l_suppkey, max(l_discount) as x, min(l_tax) as y from lineitem group by 1)
        select l_suppkey, lpad(l_suppkey::varchar, 9, '0') as padded, {_BOX.format('1').replace('cx, cy, w, h', 'x, y, x, y')} as line from k""",
    "f24_truncate": "select doc_id, array_to_string(list_slice(string_split(text, ''), 1, 60), '') as excerpt from documents",
    "f25_label_path": r"""select image_id, regexp_replace(regexp_replace(path, '^(.*)/images/', '\1/labels/'), '\.[^./]*$', '.txt') as label_path from accepted_images""",
    "pr3_vocabulary": "select p_partkey, min(p_partkey) over (partition by p_type) as type_id from part",
    "pr4_alias_map": r"""with e as (select unnest(list_filter(string_split(original_class, '+'), lambda x: x <> '')) as name from manifest where original_class is not null),
        k as (select name, count(*) as n, regexp_replace(replace(lower(trim(name)), '-', '_'), '\s+', ' ', 'g') as key from e group by 1)
        select name, n, case when key in ('floating debris', 'litter', 'floating_waste', 'floating waste', 'garbage') then 'litter' when key in ('hyacinth', 'water_hyacinth', 'water hyacinth', 'eichhornia crassipes') then 'hyacinth'
          when key in ('ent_litter', 'entangled_plastic', 'entangled plastic') then 'entangled_plastic' end as class from k""",
    "pr5_taxonomies": f"""with {MANIFEST}, e as (select unnest(list_filter(string_split(mapped_class, '+'), lambda x: x <> '')) as name from m where mapped_class is not null)
        select case name when 'litter' then 0 when 'hyacinth' then 1 when 'entangled_plastic' then 2 end as id3, case name when 'litter' then 0 when 'hyacinth' then 1 when 'entangled_plastic' then 0 end as id2, count(*) as n from e group by 1, 2""",
    "pr6_partition": f"with {MANIFEST} select n_boxes = 0 as empty, split, count(*) as n from m group by 1, 2",
    "pr7_range_check": "select l_discount between 0 and 1 and l_tax between 0 and 1 and l_quantity / 50 between 0 and 1 as inside, count(*) as n from lineitem group by 1",
    "pr9_escaping_paths": r"""select record_id from candidate_records where regexp_matches(replace(trim(relative_path), '\', '/'), '^(/|[A-Za-z]:)|(^|/)\.\.(/|$)')""",
    "pr10_rebase": r"""with k as (select image_id, replace(path, '\', '/') as p from accepted_images)
        select image_id, case when contains(p, 'images/') then '/data/' || string_split(p, 'images/')[-1] else p end as path from k""",
    "pr13_slug": r"select c_custkey, nullif(trim(regexp_replace(' .' || c_name || ' / ' || c_mktsegment || '!-', '[^A-Za-z0-9._-]+', '_', 'g'), '._-'), '') as slug from customer",
    "s4_parse_lines": f"with {_LINES} select doc_id, line_no::int as line_no, cls, cx, cy, w, h, array_to_string(issues, ';') as issues from k where right_ and numeric_",
    "s4_bad_lines": f"""with {_LINES}, i as (select unnest(case when not right_ then ['expected_5_fields'] when not numeric_ then ['not_numeric'] else issues end) as issue from k)
        select issue, count(*) as n from i group by 1""",
    "s4_levels": f"""with {_LINES}, n as (select *, cx is not null and cy is not null and w is not null and h is not null as xy, f[1] is not null and f[1] <> '' as any_,
          cx between 0 and 1 and cy between 0 and 1 and w between 0 and 1 and h between 0 and 1 as unit, w > 0 and h > 0 as pos, cls >= 0 and cls < 3 as known,
          cx - w / 2 >= -1e-4::double and cx + w / 2 <= 1 + 1e-4::double and cy - h / 2 >= -1e-4::double and cy + h / 2 <= 1 + 1e-4::double as inside, len(f) >= 5 as five_, len(f) = 5 as is5 from k),
        g as (select unnest([
          {{'level': 'lenient', 'k': five_ and numeric_, 'b': not (five_ and numeric_)}}, {{'level': 'replay', 'k': five_ and numeric_, 'b': not (five_ and numeric_)}},
          {{'level': 'explore', 'k': five_ and xy and unit, 'b': not (five_ and xy and unit)}}, {{'level': 'profile', 'k': five_ and numeric_, 'b': not (five_ and numeric_)}},
          {{'level': 'donor', 'k': five_ and numeric_, 'b': not (five_ and numeric_ and unit and pos)}}, {{'level': 'candidate', 'k': is5 and numeric_, 'b': not (is5 and numeric_ and unit and pos and known)}},
          {{'level': 'verify', 'k': is5 and numeric_, 'b': not (is5 and numeric_ and unit)}}, {{'level': 'preflight', 'k': is5 and numeric_ and unit and pos and known and inside, 'b': not (is5 and numeric_ and unit and pos and known and inside)}},
          {{'level': 'count_nonblank', 'k': true, 'b': false}}, {{'level': 'count_five', 'k': is5, 'b': not is5}}]) as x from n)
        select x.level as level, count(*) filter (x.k) as n_kept, count(*) filter (x.b) as n_bad from g group by 1""",
    "s11_tag_strip": "select doc_id, regexp_replace(text, '<[^>]+>', chr(10), 'g') as text from documents",
    "k1_csv_round_trip": "select * from customer",
    "k4_label_texts": f"""with {_LINES}, g as (select *, case when cls = 2 then 0 else cls end as id2 from k where right_ and numeric_ and len(issues) = 0)
        select doc_id, string_agg({_BOX.format('cls')}, chr(10) order by line_no) as text3, string_agg({_BOX.format('id2')}, chr(10) order by line_no) as text2 from g group by 1""",
    "k5_lists": f"""with {MANIFEST} select m.source, m.split, sum(case when m.split = 'train' then greatest(1, coalesce(rfs_repeat, 1)) else 1 end)::bigint as n_lines
        from m join manifest r using (row_id) where m.source is not null and m.split is not null group by 1, 2""",
    "k10_cache": "select doc_id, md5(text) as digest from documents where text is not null",
}
