"""Queries of constraint checks, gates and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.names import SPLITS
from quillwort.functions.paths import file_key, label_path_of
from quillwort.operators import checks, lookups, sampling, stats
from quillwort.plans.assignment import DOMINANT, POOL
from quillwort.plans.inputs import CANDIDATES, MANIFEST, candidates, manifest
from quillwort.session import table

#: The classes, and the gates of a candidate with the beginnings of the reasons that close them.
CLASSES = ("litter", "hyacinth", "entangled_plastic")
GATES = {
    "labels_complete": "missing_label", "labels_unambiguous": "ambiguous_label", "images_decodable": "image_decode_failed",
    "no_exact_duplicates": "exact_duplicate", "no_near_duplicates": "near_duplicate", "boxes_valid": "line",
}


#: Codes of label lines that are no boxes, that lie outside the image, and that name no class.
_LINE = r"(^|;)line[0-9]+:"
TILE = r"^x([0-9]+)_y([0-9]+)_s([0-9]+)$"
CAP = 0.35


def _held(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Paths of the files that the store holds now, once each."""
    return table(spark, d, name).where("removed_at is null").select(file_key("path").alias("path"), *(["n_lines"] if name == "label_files" else [])).where("path is not null")


def v1_checks(spark: SparkSession, d: str) -> DataFrame:
    """All checks of the manifest, of the audited labels and of the files held, one row each."""
    m, c = manifest(spark, d), candidates(spark, d)
    torn = stats.dependency_violations(m, "group_key", "split")
    stems = stats.dependency_violations(m, "final_stem", "split")
    per_source = stats.dependency_violations(m.withColumn("unit", F.concat_ws("/", F.coalesce("source", F.lit("")), "group_key")).where("group_key is not null"), "unit", "split")
    twice = m.groupBy("final_stem").agg(F.count("*").alias("n")).where("n > 1")
    images, labels = _held(spark, d, "image_files").select("path").distinct(), _held(spark, d, "label_files")
    wanted = images.select("path", label_path_of("path").alias("label"))
    named = labels.groupBy(F.col("path").alias("label")).agg(F.max("n_lines").alias("n_lines"))
    issue = lambda code: c.where(F.coalesce("issues", F.lit("")).rlike(_LINE + code))
    lines = c.where("n_boxes > 0").select("record_id", file_key("label_path").alias("label"), "n_boxes").join(named, "label").where("n_lines < n_boxes")
    train = m.where("split = 'train'")
    pool = F.col("source").isin(*POOL) & (F.col("n_boxes") > 0)
    share = train.agg((F.count_if(F.coalesce(pool, F.lit(False))) / F.count("*")).alias("share"))
    tile = table(spark, d, "manifest").where("coalesce(tile_info, '') <> ''").select("row_id", "tile_info", "width", "height")
    side = F.regexp_extract("tile_info", TILE, 3)
    beyond = tile.where(~F.col("tile_info").rlike(TILE) | (side.try_cast("long") < F.greatest(F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0)))))
    return checks.all_checks(
        checks.check_none("stem_in_one_split", stems, F.col("final_stem")),
        checks.check_none("group_of_source_in_one_split", per_source, F.col("unit")),
        checks.check_none("group_in_one_split", torn, F.col("group_key")),
        checks.check_none("stem_once", twice, F.col("final_stem")),
        checks.check_none("split_known", m.where("split is null"), F.col("row_id")),
        checks.check_none("source_known", m.where("source is null"), F.col("row_id")),
        checks.check_none("size_positive", m.where("not coalesce(width > 0 and height > 0, false)"), F.col("row_id")),
        checks.check_none("boxes_have_class", m.where("n_boxes > 0 and coalesce(mapped_class, '') = ''"), F.col("row_id")),
        checks.check_none("label_lines_well_formed", issue("(expected_5_fields|not_numeric)"), F.col("record_id")),
        checks.check_none("label_values_0_1", issue("coordinate_out_of_range"), F.col("record_id")),
        checks.check_none("boxes_positive", issue("non_positive_box"), F.col("record_id")),
        checks.check_none("class_ids_valid", issue("class_-?[0-9]+_out_of_range"), F.col("record_id")),
        checks.check_none("images_have_labels", wanted.join(named, "label", "left_anti"), F.col("path")),
        checks.check_none("labels_have_images", named.join(wanted, "label", "left_anti"), F.col("label")),
        checks.check_none("boxes_have_lines", lines, F.col("record_id")),
        checks.check_none("empty_labels_have_no_boxes", c.where("empty_label and n_boxes > 0"), F.col("record_id")),
        checks.check_none("tiles_hold_their_image", beyond, F.col("row_id")),
        checks.check_at_most("pool_share_within_cap", share, "share", CAP),
        checks.check_value("splits_used", m.where("split is not null").agg(F.countDistinct("split").alias("n")), "n", len(SPLITS)),
    )


def _blockers(spark: SparkSession, d: str) -> DataFrame:
    issues = F.explode(F.split(F.coalesce("issues", F.lit("")), ";")).alias("reason")
    return candidates(spark, d).select("batch_id", issues).where("reason <> '' and not startswith(reason, 'proposed_split=') and reason <> 'empty_label'")


def a19_gates(spark: SparkSession, d: str) -> DataFrame:
    return checks.gates(_blockers(spark, d).select("reason"), GATES)


def v2_candidate_audit(spark: SparkSession, d: str) -> DataFrame:
    """Each batch's gates and status, fail-closed: a batch with any blocker is quarantined."""
    b = _blockers(spark, d)
    cells = [(~F.coalesce(F.bool_or(F.col("reason").startswith(p)), F.lit(False))).alias(g) for g, p in GATES.items()]
    judged = b.groupBy("batch_id").agg(F.count("*").alias("n_blockers"), *cells)
    batches = candidates(spark, d).groupBy("batch_id").agg(F.count("*").alias("n_records"))
    return batches.join(judged, "batch_id", "left").select(
        "batch_id", "n_records", F.coalesce("n_blockers", F.lit(0)).alias("n_blockers"), *[F.coalesce(F.col(g), F.lit(True)).alias(g) for g in GATES],
        F.when(F.coalesce("n_blockers", F.lit(0)) == 0, "READY_FOR_MERGE").otherwise("QUARANTINED").alias("status"),
    )


#: Checks before training in the order in which they are made.
PREFLIGHT = (
    "columns_present", "path_once_per_split", "path_in_one_split", "listed_images_exist", "group_in_one_split", "stem_in_one_split",
    "unassigned_not_in_train", "digest_in_one_split",
)


def v3_preflight(spark: SparkSession, d: str) -> DataFrame:
    """Checks before training, up to the first that fails: columns, repeated and torn paths, images that no store ever held, torn
    groups and stems, images outside the splits (kept for a later test) that train has, equal bytes over splits."""
    m, c = manifest(spark, d).where("split is not null"), candidates(spark, d)
    repeated = m.groupBy("original_path", "split").agg(F.count("*").alias("n")).where("n > 1")
    known = table(spark, d, "image_files").select(file_key("path").alias("path")).distinct()
    listed = c.where("split is not null").select(file_key("relative_path").alias("path")).where("path is not null").distinct()
    train = c.where("split = 'train' and digest is not null").select("digest").distinct()
    missing = [n for n in ("source", "split", "group_id", "final_stem", "n_boxes") if n not in table(spark, d, "manifest").columns]
    made = checks.all_checks(
        checks.check_none("columns_present", spark.createDataFrame([(n,) for n in missing], "name string"), F.col("name")),
        checks.check_none("path_once_per_split", repeated, F.col("original_path")),
        checks.check_none("path_in_one_split", stats.dependency_violations(m, "original_path", "split"), F.col("original_path")),
        checks.check_none("listed_images_exist", listed.join(known, "path", "left_anti"), F.col("path")),
        checks.check_none("group_in_one_split", stats.dependency_violations(m, "group_key", "split"), F.col("group_key")),
        checks.check_none("stem_in_one_split", stats.dependency_violations(m, "final_stem", "split"), F.col("final_stem")),
        checks.check_none("unassigned_not_in_train", c.where("split is null").join(train, "digest", "left_semi"), F.col("record_id")),
        checks.check_none("digest_in_one_split", stats.dependency_violations(c.where("split is not null"), "digest", "split"), F.col("digest")),
    )
    return made


def v3_first_failure(spark: SparkSession, d: str) -> DataFrame:
    """The checks before training in order, with those after the first failure skipped."""
    return checks.stop_at_first(v3_preflight(spark, d), list(PREFLIGHT))


def v4_asserts(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of a bundle: an image for each label and a label for each image per split, known classes, entries that resolve, whole groups."""
    c = candidates(spark, d).where("split is not null")
    pairs = c.select("split", file_key("relative_path").alias("image"), file_key("label_path").alias("label"))
    counts = pairs.groupBy("split").agg(F.count_distinct("image").alias("i"), F.count_distinct("label").alias("l")).where("i <> l")
    known = table(spark, d, "image_files").select(file_key("path").alias("image")).distinct()
    classes = c.select("record_id", F.explode(F.split(F.coalesce("mapped_classes", F.lit("")), r"\+")).alias("name")).where("name <> ''")
    return checks.all_checks(
        checks.check_none("as_many_labels_as_images", counts, F.col("split")),
        checks.check_none("names_agree", pairs.where(label_path_of("image") != F.col("label")), F.col("image")),
        checks.check_none("classes_known", classes.where(~F.col("name").isin(*CLASSES)), F.col("record_id")),
        checks.check_none("entries_resolve", pairs.select("image").where("image is not null").distinct().join(known, "image", "left_anti"), F.col("image")),
        checks.check_none("groups_whole", stats.dependency_violations(c, "group_key", "split"), F.col("group_key")),
        checks.check_none("digests_whole", stats.dependency_violations(c, "digest", "split"), F.col("digest")),
    )


def v4_bundle(spark: SparkSession, d: str) -> DataFrame:
    """Expected against counted rows of each split: what the targets ask for, within two points of share."""
    m = manifest(spark, d).where("split is not null")
    total = m.agg(F.count("*").alias("total"))
    shares = m.groupBy("split").agg(F.count("*").alias("n")).join(F.broadcast(total)).select("split", F.round(F.col("n") / F.col("total"), 6).alias("share"))  # one row
    targets = table(spark, d, "split_targets").select("split", F.col("target_share").alias("share"))
    return checks.drift(targets, shares, ["split"], "share", 0.02).withColumn("drift", F.round("drift", 6))


def v5_drift(spark: SparkSession, d: str) -> DataFrame:
    """Mean values per event type of both fortnights, with the tolerance of a metric gate, 5e-4."""
    e = table(spark, d, "events")
    mean = lambda rows: rows.groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("value"))
    early = F.dayofmonth("ts") <= 15
    return checks.drift(mean(e.where(early)), mean(e.where(~early)), ["event_type"], "value").withColumn("drift", F.round("drift", 6))


def v7_hygiene(spark: SparkSession, d: str) -> DataFrame:
    """Per source what audits found: records, empty and missing labels, blockers of each kind."""
    c = candidates(spark, d)
    kinds = {"n_decode": "image_decode_failed", "n_line": "line", "n_duplicate": "exact_duplicate", "n_near": "near_duplicate"}
    has = lambda p: F.exists(F.split(F.coalesce("issues", F.lit("")), ";"), lambda x: x.startswith(p))
    return c.groupBy("source").agg(
        F.count("*").alias("n_records"), F.count_if("empty_label").alias("n_empty"), F.count_if(F.coalesce("label_path", F.lit("")) == "").alias("n_unlabelled"),
        *[F.count_if(has(p)).alias(n) for n, p in kinds.items()],
    )


def v6_totals(spark: SparkSession, d: str) -> DataFrame:
    """Boxes per source in the manifest, once by rows and once by stems, held against each other."""
    m = manifest(spark, d).where("source is not null")
    rows = m.groupBy("source").agg(F.sum("n_boxes").alias("n"))
    stems = m.groupBy("source", "final_stem").agg(F.max("n_boxes").alias("b")).groupBy("source").agg(F.sum("b").alias("n"))
    return lookups.reconcile(rows, stems, "source", "n")


def v6_cap_replay(spark: SparkSession, d: str) -> DataFrame:
    """How the boxes of each source in train come about: all rows, less rows written twice, less what the cap drops, is what is left."""
    train = manifest(spark, d).where("split = 'train' and source is not null")
    pool = F.col("source").isin(*POOL) & (F.col("n_boxes") > 0)
    return sampling.cap_replay(train, "source", "n_boxes", "final_stem", pool, F.col("source") == DOMINANT, "row_id", CAP)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Are the splits free of leaks? Per source: rows, groups, groups that the split tears apart, and rows in them."""
    m = manifest(spark, d).where("group_key is not null and split is not null and source is not null")
    torn = stats.dependency_violations(m, "group_key", "split").select("group_key", F.lit(1).alias("torn"))
    cells = m.groupBy("source", "group_key").agg(F.count("*").alias("n")).join(torn, "group_key", "left")
    return cells.groupBy("source").agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_groups"), F.count("torn").alias("n_torn_groups"), F.coalesce(F.sum(F.when(F.col("torn") == 1, F.col("n"))), F.lit(0)).alias("n_torn_rows")
    )


QUERIES = {f.__name__: f for f in (v1_checks, a19_gates, v2_candidate_audit, v3_preflight, v3_first_failure, v4_bundle, v4_asserts, v5_drift, v6_totals, v6_cap_replay, v7_hygiene, flagship)}


def _none(name: str, bad: str, detail: str) -> str:
    return f"select '{name}' as \"check\", case when count(*) = 0 then 'PASS' else 'FAIL' end as status, count(*) as n_bad, coalesce(min({detail}::varchar), '')[1:400] as detail from ({bad})"


def _torn(t: str, key: str) -> str:
    return f"select {key} from {t} where {key} is not null and split is not null group by 1 having count(distinct split) > 1"


def _issue(code: str) -> str:
    return f"select record_id from c where regexp_matches(coalesce(issues, ''), '{_LINE}{code}')"


_KEY = r"""nullif(regexp_replace(regexp_replace(array_to_string(list_filter(string_split(replace(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '\', '/'), '/'), lambda x: x not in ('', '.')), '/'), '[^/]+/\.\./', '', 'g'), '[^/]+/\.\./', '', 'g'), '')"""
_LABEL = r"""regexp_replace(regexp_replace({c}, '^(.*)/images/', '\1/labels/'), '\.[^./]*$', '.txt')"""
_FILES = f"""held as (select distinct {_KEY.format(c='path')} as path from image_files where removed_at is null),
  wanted as (select path, {_LABEL.format(c='path')} as label from held where path is not null),
  named as (select {_KEY.format(c='path')} as label, max(n_lines) as n_lines from label_files where removed_at is null and {_KEY.format(c='path')} is not null group by 1)"""
_PREFLIGHT = f"""{MANIFEST}, {CANDIDATES}, known as (select {_KEY.format(c='path')} as path from image_files),
  listed as (select distinct {_KEY.format(c='relative_path')} as path from c where split is not null), made as (
        select 'columns_present' as "check", 'PASS' as status, 0::bigint as n_bad, '' as detail
        union all {_none('path_once_per_split', 'select original_path from m where split is not null group by original_path, split having count(*) > 1', 'original_path')}
        union all {_none('path_in_one_split', _torn('m', 'original_path'), 'original_path')}
        union all {_none('listed_images_exist', 'select path from listed where path is not null and path not in (select path from known where path is not null)', 'path')}
        union all {_none('group_in_one_split', _torn('m', 'group_key'), 'group_key')}
        union all {_none('stem_in_one_split', _torn('m', 'final_stem'), 'final_stem')}
        union all {_none('unassigned_not_in_train', "select record_id from c where split is null and digest in (select digest from c where split = 'train' and digest is not null)", 'record_id')}
        union all {_none('digest_in_one_split', _torn('c', 'digest'), 'digest')})"""
_BLOCKERS = f"""{CANDIDATES}, b as (select batch_id, reason from (select batch_id, unnest(string_split(coalesce(issues, ''), ';')) as reason from c)
  where reason <> '' and not starts_with(reason, 'proposed_split=') and reason <> 'empty_label')"""
_CELLS = ", ".join(f"not coalesce(bool_or(starts_with(reason, '{p}')), false) as {g}" for g, p in GATES.items())

SQL = {
    "v1_checks": f"""with {MANIFEST}, {CANDIDATES}, {_FILES},
        t as (select row_id, tile_info, regexp_matches(tile_info, '{TILE}') as ok, try_cast(nullif(regexp_extract(tile_info, '{TILE}', 3), '') as bigint) as side, greatest(coalesce(width, 0), coalesce(height, 0)) as longer from manifest where coalesce(tile_info, '') <> ''),
        sh as (select count(*) filter (source in {POOL} and n_boxes > 0)::double / count(*) as share from m where split = 'train')
        {_none('stem_in_one_split', _torn('m', 'final_stem'), 'final_stem')}
        union all {_none('group_of_source_in_one_split', "select coalesce(source, '') || '/' || group_key as unit from m where group_key is not null and split is not null group by 1 having count(distinct split) > 1", 'unit')}
        union all {_none('group_in_one_split', _torn('m', 'group_key'), 'group_key')}
        union all {_none('stem_once', 'select final_stem from m group by 1 having count(*) > 1', 'final_stem')}
        union all {_none('split_known', 'select row_id from m where split is null', 'row_id')}
        union all {_none('source_known', 'select row_id from m where source is null', 'row_id')}
        union all {_none('size_positive', 'select row_id from m where not coalesce(width > 0 and height > 0, false)', 'row_id')}
        union all {_none('boxes_have_class', "select row_id from m where n_boxes > 0 and coalesce(mapped_class, '') = ''", 'row_id')}
        union all {_none('label_lines_well_formed', _issue('(expected_5_fields|not_numeric)'), 'record_id')}
        union all {_none('label_values_0_1', _issue('coordinate_out_of_range'), 'record_id')}
        union all {_none('boxes_positive', _issue('non_positive_box'), 'record_id')}
        union all {_none('class_ids_valid', _issue('class_-?[0-9]+_out_of_range'), 'record_id')}
        union all {_none('images_have_labels', 'select path from wanted where label not in (select label from named)', 'path')}
        union all {_none('labels_have_images', 'select label from named where label not in (select label from wanted)', 'label')}
        union all {_none('boxes_have_lines', f"select record_id from (select record_id, n_boxes, {_KEY.format(c='label_path')} as label from c where n_boxes > 0) join named using (label) where n_lines < n_boxes", 'record_id')}
        union all {_none('empty_labels_have_no_boxes', 'select record_id from c where empty_label and n_boxes > 0', 'record_id')}
        union all {_none('tiles_hold_their_image', 'select row_id from t where not ok or side < longer', 'row_id')}
        union all select 'pool_share_within_cap', case when share <= {CAP} + 1e-12 then 'PASS' else 'FAIL' end, (not share <= {CAP} + 1e-12)::bigint, 'got ' || round(share, 6) from sh
        union all select 'splits_used', case when count(distinct split) = 3 then 'PASS' else 'FAIL' end, (count(distinct split) <> 3)::bigint, 'got ' || count(distinct split) from m""",
    "a19_gates": f"with {_BLOCKERS} select {_CELLS}, case when count(*) = 0 then 'READY_FOR_MERGE' else 'QUARANTINED' end as status from b",
    "v2_candidate_audit": f"""with {_BLOCKERS}, j as (select batch_id, count(*) as n_blockers, {_CELLS} from b group by 1), r as (select batch_id, count(*) as n_records from c group by 1)
        select batch_id, n_records, coalesce(n_blockers, 0) as n_blockers, {', '.join(f'coalesce({g}, true) as {g}' for g in GATES)}, case when coalesce(n_blockers, 0) = 0 then 'READY_FOR_MERGE' else 'QUARANTINED' end as status
        from r left join j using (batch_id)""",
    "v3_preflight": f"with {_PREFLIGHT} select * from made",
    "v3_first_failure": f"""with {_PREFLIGHT}, o as (select *, list_position({list(PREFLIGHT)}, "check")::int as place from made), z as (select min(place) as z from o where status = 'FAIL')
        select place, "check", case when place > z then 'SKIPPED' else status end as status, case when place > z then 0 else n_bad end::bigint as n_bad, case when place > z then '' else detail end as detail from o, z""",
    "v4_asserts": f"""with {CANDIDATES}, s as (select * from c where split is not null),
        p as (select split, {_KEY.format(c='relative_path')} as image, {_KEY.format(c='label_path')} as label from s),
        k as (select {_KEY.format(c='path')} as image from image_files)
        {_none('as_many_labels_as_images', 'select split from p group by 1 having count(distinct image) <> count(distinct label)', 'split')}
        union all {_none('names_agree', f"select image from p where {_LABEL.format(c='image')} <> label", 'image')}
        union all {_none('classes_known', f"select record_id from (select record_id, unnest(string_split(coalesce(mapped_classes, ''), '+')) as name from s) where name <> '' and name not in {CLASSES}", 'record_id')}
        union all {_none('entries_resolve', 'select distinct image from p where image is not null and image not in (select image from k where image is not null)', 'image')}
        union all {_none('groups_whole', _torn('s', 'group_key'), 'group_key')} union all {_none('digests_whole', _torn('s', 'digest'), 'digest')}""",
    "v6_cap_replay": f"""with {MANIFEST}, a as (select *, source in {POOL} and n_boxes > 0 as pool, row_number() over (partition by final_stem order by row_id) as i from m where split = 'train' and source is not null),
        o as (select * from a where i = 1), n as (select count(*) as n, count(*) filter (pool) as p, count(*) filter (pool and source = '{DOMINANT}') as d from o),
        k as (select case when p::double / n > {CAP}::double then least(d, greatest(0, p - floor({CAP}::double * (n - p) / (1 - {CAP}::double)))) else 0 end as gone from n),
        r as (select row_id, row_number() over (order by md5('42:' || row_id), row_id) as j from o where pool and source = '{DOMINANT}'),
        x as (select a.*, coalesce(r.j <= k.gone, false) as dropped from a left join r using (row_id), k),
        y as (select source, sum(n_boxes)::bigint as raw, coalesce(sum(n_boxes) filter (i > 1), 0)::bigint as doubled, coalesce(sum(n_boxes) filter (i = 1 and dropped), 0)::bigint as capped, coalesce(sum(n_boxes) filter (i = 1 and not dropped), 0)::bigint as final from x group by 1)
        select *, case when raw - doubled - capped = final then 'PASS' else 'FAIL' end as status from y""",
    "v4_bundle": f"""with {MANIFEST}, s as (select split, round(count(*)::double / (select count(*) from m where split is not null), 6) as now from m where split is not null group by 1)
        select split, target_share as before, now, round(abs(now - target_share), 6) as drift, case when coalesce(abs(now - target_share) <= 0.02::double, false) then 'PASS' else 'FAIL' end as status from split_targets full join s using (split)""",
    "v5_drift": """with a as (select event_type, round(avg(value), 6) as before from events where day(ts) <= 15 group by 1), b as (select event_type, round(avg(value), 6) as now from events where day(ts) > 15 group by 1)
        select event_type, before, now, round(abs(now - before), 6) as drift, case when coalesce(abs(now - before) <= 5e-4::double, false) then 'PASS' else 'FAIL' end as status from a full join b using (event_type)""",
    "v6_totals": f"""with {MANIFEST}, r as (select source, sum(n_boxes)::bigint as expected from m where source is not null group by 1),
        s as (select source, sum(b)::bigint as actual from (select source, final_stem, max(n_boxes) as b from m where source is not null group by 1, 2) group by 1)
        select source, expected, actual, case when expected is not distinct from actual then 'PASS' else 'FAIL' end as status from r full join s using (source)""",
    "v7_hygiene": f"""with {CANDIDATES}, i as (select *, string_split(coalesce(issues, ''), ';') as x from c)
        select source, count(*) as n_records, count(*) filter (empty_label) as n_empty, count(*) filter (coalesce(label_path, '') = '') as n_unlabelled,
          {', '.join(f"count(*) filter (len(list_filter(x, lambda y: starts_with(y, '{p}'))) > 0) as {n}" for n, p in (('n_decode', 'image_decode_failed'), ('n_line', 'line'), ('n_duplicate', 'exact_duplicate'), ('n_near', 'near_duplicate')))}
        from i group by 1""",
    "flagship": f"""with {MANIFEST}, k as (select * from m where group_key is not null and split is not null and source is not null), t as ({_torn('k', 'group_key')}),
        g as (select source, group_key, count(*) as n from k group by 1, 2)
        select source, sum(n)::bigint as n_rows, count(*) as n_groups, count(t.group_key) as n_torn_groups, coalesce(sum(n) filter (t.group_key is not null), 0)::bigint as n_torn_rows from g left join t using (group_key) group by 1""",
}
