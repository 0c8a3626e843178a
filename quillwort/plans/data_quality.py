"""Queries of the record-level checks: orphan references and rows that fail to parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.paths import file_key
from quillwort.operators.orphans import orphan_references, orphan_report
from quillwort.operators.rejects import FIELDS, RULES, load_lines
from quillwort.session import table


def candidate_references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """References of the audited candidates and the stays of the files they may denote."""
    records = table(spark, d, "candidate_records")
    refs = [
        records.select(F.col("record_id").alias("row"), F.lit(c).alias("field"), file_key(c).alias("key"), F.col("audited_at").alias("at"))
        for c in ("relative_path", "label_path")
    ]
    stays = [
        table(spark, d, t).select(
            F.lit(c).alias("field"), file_key("path").alias("key"), F.col("first_seen_at").alias("since"), F.col("removed_at").alias("until")
        )
        for t, c in (("image_files", "relative_path"), ("label_files", "label_path"))
    ]
    return refs[0].unionByName(refs[1]), stays[0].unionByName(stays[1])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """References of candidate records to files that the store did not hold at audited_at."""
    refs, stays = candidate_references(spark, d)
    return orphan_references(refs, stays).select(F.col("row").alias("record_id"), F.col("field").alias("ref_field"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans and references per referenced table and month."""
    refs, stays = candidate_references(spark, d)
    month = F.date_format(F.col("at"), "yyyy-MM")
    report = orphan_report(refs, orphan_references(refs, stays), month)
    ref_table = F.when(F.col("field") == "relative_path", "image_files").otherwise("label_files")
    return report.select(ref_table.alias("ref_table"), F.col("period").alias("month"), "n_references", "n_orphans")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are no valid candidate record."""
    return load_lines(table(spark, d, "raw_candidate_lines")).where("reason is not null").select("line_id")


def p4_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Failed lines per reason."""
    return load_lines(table(spark, d, "raw_candidate_lines")).groupBy("reason").agg(F.count("*").alias("n_lines"))


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    """The valid lines, loaded with their types; phash as the signed long with the same bits."""
    rows = load_lines(table(spark, d, "raw_candidate_lines")).where("reason is null")
    number = F.col("phash").try_cast("decimal(20,0)")
    top = F.lit("18446744073709551616").cast("decimal(20,0)")
    signed = F.when(number >= F.lit("9223372036854775808").cast("decimal(20,0)"), number - top).otherwise(number).cast("long")
    typed = {
        "phash": signed,
        "width": F.col("width").cast("long"),
        "height": F.col("height").cast("long"),
        "n_boxes": F.col("n_boxes").cast("long"),
        "empty_label": F.col("empty_label") == "True",
    }
    return rows.select("line_id", *[typed.get(f, F.col(f)).alias(f) for f in FIELDS])


QUERIES = {"p3_found": p3_found, "p3_report": p3_report, "p4_found": p4_found, "p4_reasons": p4_reasons, "p4_records": p4_records}

_KEY = r"""nullif(regexp_replace(regexp_replace(array_to_string(list_filter(string_split(replace(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '\', '/'), '/'), lambda x: x not in ('', '.')), '/'), '[^/]+/\.\./', '', 'g'), '[^/]+/\.\./', '', 'g'), '')"""
_REFS = f"""refs as (
  select record_id, 'relative_path' as ref_field, {_KEY.format(c='relative_path')} as key, audited_at as at from candidate_records
  union all
  select record_id, 'label_path', {_KEY.format(c='label_path')}, audited_at from candidate_records),
stays as (
  select 'relative_path' as ref_field, {_KEY.format(c='path')} as key, first_seen_at, removed_at from image_files
  union all
  select 'label_path', {_KEY.format(c='path')}, first_seen_at, removed_at from label_files),
missed as (
  select r.* from refs r where key is not null and not exists (
    select 1 from stays s where s.ref_field = r.ref_field and s.key = r.key and s.first_seen_at <= r.at and (s.removed_at is null or s.removed_at > r.at)))"""
_QUOTED = r"""(?:[^",]*|"(?:[^"]|"")*")"""
_CHECKED = rf"""lines as (
  select line_id, regexp_replace(raw, '\r$', '') as line from raw_candidate_lines
  where coalesce(line_no, 0) <> 1 and regexp_matches(raw, '\S')),
cut as (
  select line_id, line, regexp_full_match(line, '{_QUOTED}(?:,{_QUOTED})*', 's') as quoted,
    list_transform(regexp_extract_all(line || ',', '({_QUOTED}),', 1),
      lambda x: case when starts_with(x, '"') then replace(x[2:-2], '""', '"') else x end) as f
  from lines),
checked as (
  select line_id, f, coalesce(quoted and len(f) = 12 and f[1] <> '' and f[4] <> ''
    and (f[2] = '' or (ends_with(f[2], '.txt') and not regexp_matches(f[2], '^(?:[/\\]|[A-Za-z]:)')))
    and f[3] in ('train', 'val', 'test', 'unspecified')
    and regexp_full_match(f[5], '[0-9a-f]{{64}}')
    and (f[6] = '' or (regexp_full_match(f[6], '[0-9]+') and coalesce(try_cast(f[6] as hugeint) < 18446744073709551616::hugeint, false)))
    and regexp_full_match(f[7], '[0-9]+') and regexp_full_match(f[8], '[0-9]+') and regexp_full_match(f[9], '[0-9]+')
    and regexp_full_match(f[10], '{RULES["mapped_classes"].removeprefix("|")}|')
    and f[11] in ('True', 'False')
    and regexp_full_match(f[12], '{RULES["issues"].removeprefix("|")}|'), false) as good
  from cut)"""

_REASON = rf"""case when not coalesce(quoted, false) then 'broken_quoting' when len(f) <> 12 then 'wrong_field_count' when f[1] = '' then 'invalid_relative_path'
  when not (f[2] = '' or (ends_with(f[2], '.txt') and not regexp_matches(f[2], '^(?:[/\\]|[A-Za-z]:)'))) then 'invalid_label_path'
  when f[3] not in ('train', 'val', 'test', 'unspecified') then 'invalid_official_split' when f[4] = '' then 'invalid_group_id'
  when not regexp_full_match(f[5], '[0-9a-f]{{64}}') then 'invalid_sha256'
  when not (f[6] = '' or (regexp_full_match(f[6], '[0-9]+') and coalesce(try_cast(f[6] as hugeint) < 18446744073709551616::hugeint, false))) then 'invalid_phash'
  when not regexp_full_match(f[7], '[0-9]+') then 'invalid_width' when not regexp_full_match(f[8], '[0-9]+') then 'invalid_height' when not regexp_full_match(f[9], '[0-9]+') then 'invalid_n_boxes'
  when not regexp_full_match(f[10], '{RULES["mapped_classes"].removeprefix("|")}|') then 'invalid_mapped_classes' when f[11] not in ('True', 'False') then 'invalid_empty_label'
  when not regexp_full_match(f[12], '{RULES["issues"].removeprefix("|")}|') then 'invalid_issues' end"""

SQL = {
    "p4_reasons": f"with {_CHECKED} select {_REASON} as reason, count(*) as n_lines from cut group by 1",
    "p3_found": f"with {_REFS} select record_id, ref_field from missed",
    "p3_report": f"""
        with {_REFS}
        select case r.ref_field when 'relative_path' then 'image_files' else 'label_files' end as ref_table,
          strftime(r.at, '%Y-%m') as month, count(*) as n_references, count(m.record_id) as n_orphans
        from refs r left join missed m on m.record_id = r.record_id and m.ref_field = r.ref_field
        where r.key is not null group by 1, 2""",
    "p4_found": f"with {_CHECKED} select line_id from checked where not good",
    "p4_records": f"""
        with {_CHECKED}
        select line_id, f[1] as relative_path, f[2] as label_path, f[3] as official_split, f[4] as group_id, f[5] as sha256,
          case when f[6] = '' then null when f[6]::hugeint >= 9223372036854775808::hugeint
            then (f[6]::hugeint - 18446744073709551616::hugeint)::bigint else f[6]::bigint end as phash,
          f[7]::bigint as width, f[8]::bigint as height, f[9]::bigint as n_boxes, f[10] as mapped_classes,
          f[11] = 'True' as empty_label, f[12] as issues
        from checked where good""",
}
