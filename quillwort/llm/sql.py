"""The same results in SQL, for checks."""


def _strip(c: str) -> str:
    return rf"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"


def _split(c: str) -> str:
    return f"case when {_strip(c)} in ('valid', 'validation') then 'val' when {_strip(c)} in ('train', 'val', 'test') then {_strip(c)} end"


def _source(c: str) -> str:
    return f"nullif(replace({_strip(c)}, '-', '_'), '')"


_AUDITED = f"""audited as (
  select record_id as id, {_split('official_split')} as split, {_source('source')} as source, nullif({_strip('sha256')}, '') as digest, nullif(phash, 0) as hash
  from candidate_records)"""
_TWINS = """twins as (
  select t.id as train_id, h.id as held_id, case when t.digest = h.digest then 'exact' else 'near' end as kind
  from audited t join audited h on t.split = 'train' and h.split in ('val', 'test')
  where t.digest = h.digest or bit_count(xor(t.hash, h.hash)) <= 8)"""
_SIZES = f"""images as (
  select {_source('arg_min(source, row_id)')} as source, greatest(coalesce(arg_min(coalesce(n_boxes, 0), row_id), 0), 0) as boxes
  from manifest group by coalesce(final_stem, 'row ' || row_id)
  union all
  select {_source('arg_min(source, record_id)')}, greatest(coalesce(arg_min(coalesce(n_boxes, 0), record_id), 0), 0)
  from candidate_records group by coalesce(relative_path, 'row ' || record_id)),
sizes as (
  select t.source, t.target_share, t.max_repeat, coalesce(sum(boxes), 0) as s
  from mix_targets t left join images i on i.source = {_source('t.source')} group by all)"""

SQL = {
    "p1_found": f"""
        select {_strip('group_id')} as group_key from manifest
        where {_strip('group_id')} <> '' group by 1 having count(distinct {_split('split')}) > 1""",
    "p2_found": f"""
        with {_SIZES} select source from sizes where max_repeat * s < target_share * (select sum(s) from sizes)""",
    "p6_found": f"""
        with {_AUDITED}, {_TWINS}
        select distinct least(train_id, held_id) as record_id_a, greatest(train_id, held_id) as record_id_b from twins""",
    "p6_report": f"""
        with {_AUDITED}, {_TWINS}, best as (select held_id as id, min(kind) as kind from twins group by 1)
        select a.split, a.source, count(*) as n_records, count(*) filter (kind = 'exact') as n_exact, count(*) filter (kind = 'near') as n_near
        from audited a left join best using (id) where a.split in ('val', 'test') group by 1, 2""",
}
