"""Queries of split assignment, samples, caps, budgets and allocations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.operators import sampling, splits, stats
from quillwort.plans.inputs import MANIFEST, manifest
from quillwort.session import table

#: The grid of thresholds of repeat-factor sampling.
REPEAT_TS = [0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0]
#: Which sources form the capped pool, and which of them gives way.
POOL, DOMINANT = ("kanal_fx", "delta_uav", "weir_cam"), "kanal_fx"
#: Sources whose groups share one namespace and are assigned together.
JOINT = {"lotus_a": "lotus", "lotus_b": "lotus"}


def groups(spark: SparkSession, d: str) -> DataFrame:
    m = manifest(spark, d).where("group_key is not null and source is not null")
    unit = F.when(F.col("source").isin(*JOINT), F.regexp_replace("source", "_[ab]$", "")).otherwise(F.col("source"))
    return m.groupBy(unit.alias("unit"), F.col("group_key")).agg(F.count("*").alias("n"))


def o1_greedy(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign_greedy(groups(spark, d), "unit", "group_key", "n")


def o2_lightest(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign_lightest(groups(spark, d), "unit", "group_key", "n")


def o3_choose(spark: SparkSession, d: str) -> DataFrame:
    g = groups(spark, d)
    return splits.choose_method(splits.assign_greedy(g, "unit", "group_key", "n"), splits.assign_lightest(g, "unit", "group_key", "n"), "unit", "n")


def o4_joint_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows per source and split once groups of sources with one namespace are assigned together."""
    assigned = splits.assign_greedy(groups(spark, d), "unit", "group_key", "n")
    m = manifest(spark, d).where("group_key is not null and source is not null")
    unit = F.when(F.col("source").isin(*JOINT), F.regexp_replace("source", "_[ab]$", "")).otherwise(F.col("source"))
    return m.withColumn("unit", unit).join(assigned.withColumnRenamed("split", "new_split"), ["unit", "group_key"]).groupBy("source", "new_split").agg(F.count("*").alias("n_rows"))


def o5_rank_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.sample_rows(table(spark, d, "documents").select("doc_id"), 100, "doc_id")


def o7_quota(spark: SparkSession, d: str) -> DataFrame:
    """Of the empty images of a group as many as 15 % of its others."""
    m = manifest(spark, d).where("group_key is not null")
    sizes = m.groupBy("group_key").agg(F.least(F.count_if(F.col("n_boxes") == 0), F.floor(F.count_if(F.col("n_boxes") > 0) * 0.15)).alias("quota"))
    empty = m.where("n_boxes = 0").join(sizes.where("quota > 0"), "group_key")
    return sampling.sample_per_group(empty, ["group_key"], F.col("quota"), "row_id").select("group_key", "row_id")


def o8_cap(spark: SparkSession, d: str) -> DataFrame:
    train = manifest(spark, d).where("split = 'train'")
    pool = F.col("source").isin(*POOL) & (F.col("n_boxes") > 0)
    kept, _ = sampling.cap_share(train, pool, F.col("source") == DOMINANT, "row_id")
    return kept.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("row_id").alias("id_sum"))


def o9_budget(spark: SparkSession, d: str) -> DataFrame:
    train = manifest(spark, d).where("split = 'train'")
    return sampling.background_budget(train, F.col("n_boxes") == 0, F.col("source") == "kanal_fx", "row_id").select("row_id", "source")


def _frequencies(spark: SparkSession, d: str) -> DataFrame:
    return stats.set_frequency(manifest(spark, d).where("split = 'train'"), "mapped_class").withColumn("share", F.round("share", 9))


def o10_repeat_grid(spark: SparkSession, d: str) -> DataFrame:
    return sampling.repeat_grid(_frequencies(spark, d), REPEAT_TS).select("value", "t", F.round("r", 6).alias("r"))


def o10_choose_t(spark: SparkSession, d: str) -> DataFrame:
    return sampling.choose_t(sampling.repeat_grid(_frequencies(spark, d), REPEAT_TS), "hyacinth")


def o11_repeats(spark: SparkSession, d: str) -> DataFrame:
    grid = sampling.repeat_grid(_frequencies(spark, d), REPEAT_TS)
    chosen = grid.join(F.broadcast(sampling.choose_t(grid, "hyacinth").select(F.col("t").alias("used"))), F.col("t") == F.col("used"))  # one row
    rows = sampling.row_repeats(manifest(spark, d).where("split = 'train'"), "mapped_class", chosen.select("value", "r"), "row_id")
    return sampling.repeat_rows(rows, "repeats").groupBy("repeats").agg(F.count("*").alias("n_lines"), F.countDistinct("row_id").alias("n_rows"))


def o12_largest_remainder(spark: SparkSession, d: str) -> DataFrame:
    per = manifest(spark, d).where("split = 'train' and source is not null").groupBy("source").agg(F.count("*").alias("capacity"))
    return sampling.largest_remainder(per, "source", "capacity", 1024)


def o13_stratified(spark: SparkSession, d: str) -> DataFrame:
    train = manifest(spark, d).where("split = 'train' and source is not null")
    return sampling.stratified_sample(train, F.contains("mapped_class", F.lit("hyacinth")), "source", "row_id", 1024).select("row_id", "source")


def o14_floors(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.halves(sampling.floors_then_rest(orders, "o_orderpriority", "o_orderkey", 10, 200), 100)


def o15_proposed(spark: SparkSession, d: str) -> DataFrame:
    return splits.propose_balanced(groups(spark, d), "unit", "group_key", "n")


def o16_top_pairs(spark: SparkSession, d: str) -> DataFrame:
    from quillwort.operators.vectors import cosine_search

    e = table(spark, d, "embeddings")
    pairs = cosine_search(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding", 0.3)
    return pairs.orderBy(F.col("cosine").desc(), "vec_id", "neighbour").limit(50)


def o17_clip_holdout(spark: SparkSession, d: str) -> DataFrame:
    """Groups held out by digest rank: the first 30 % of each source's groups, rounded up."""
    g = manifest(spark, d).where("group_key is not null and source is not null").select("source", "group_key").distinct()
    quota = g.groupBy("source").agg(F.ceil(F.count("*") * 0.3).alias("quota"))
    return sampling.sample_per_group(g.join(quota, "source"), ["source"], F.col("quota"), "group_key").select("source", "group_key")


def pr12_strided(spark: SparkSession, d: str) -> DataFrame:
    return sampling.strided_sample(manifest(spark, d).where("source is not null").select("source", "row_id"), ["source"], "row_id", 300)


def w2_rank_groups(spark: SparkSession, d: str) -> DataFrame:
    """The ten largest groups of each unit."""
    from pyspark.sql import Window

    w = Window.partitionBy("unit").orderBy(F.col("n").desc(), "group_key")
    return groups(spark, d).withColumn("place", F.row_number().over(w)).where("place <= 10")


def w5_first_k(spark: SparkSession, d: str) -> DataFrame:
    """The first 20 rows of each source."""
    return sampling.first_rows(manifest(spark, d).where("source is not null").select("source", "row_id"), ["source"], "row_id", 20)


def w7_even_picks(spark: SparkSession, d: str) -> DataFrame:
    return sampling.even_picks(manifest(spark, d).where("source is not null").select("source", "row_id"), ["source"], "row_id")


def w8_peaks(spark: SparkSession, d: str) -> DataFrame:
    """Per event type the day with the highest mean value, and where the run ended."""
    daily = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.round(F.avg("value"), 6).alias("mean"))
    best = F.max_by(F.col("day"), F.struct("mean", "day"))
    return daily.groupBy("event_type").agg(best.alias("best_day"), F.max("mean").alias("best_mean"), F.max_by("mean", "day").alias("last_mean"))


QUERIES = {f.__name__: f for f in (
    o1_greedy, o2_lightest, o3_choose, o4_joint_rows, o5_rank_sample, o7_quota, o8_cap, o9_budget, o10_repeat_grid, o10_choose_t, o11_repeats,
    o12_largest_remainder, o13_stratified, o14_floors, o15_proposed, o16_top_pairs, o17_clip_holdout, pr12_strided, w2_rank_groups, w5_first_k, w7_even_picks, w8_peaks,
)}

_UNIT = "case when source in ('lotus_a', 'lotus_b') then 'lotus' else source end"
_GROUPS = f"""g as (select {_UNIT} as unit, group_key, count(*) as n from m where group_key is not null and source is not null group by 1, 2),
i as (select *, row_number() over (partition by unit order by n desc, group_key) as i, sum(n) over (partition by unit) as total from g)"""
GREEDY = f"""greedy as (
  select unit, i::bigint as i, (case when n <= total * 0.8::double + 0.5 * n then n else 0 end)::bigint as a,
    (case when n <= total * 0.8::double + 0.5 * n then 0 when n <= total * 0.1::double + 0.5 * n then n else 0 end)::bigint as b,
    case when n <= total * 0.8::double + 0.5 * n then 'train' when n <= total * 0.1::double + 0.5 * n then 'val' else 'test' end as split
  from i where i = 1
  union all
  select i.unit, i.i, p.a + case when p.a + n <= total * 0.8::double + 0.5 * n then n else 0 end,
    p.b + case when p.a + n <= total * 0.8::double + 0.5 * n then 0 when p.b + n <= total * 0.1::double + 0.5 * n then n else 0 end,
    case when p.a + n <= total * 0.8::double + 0.5 * n then 'train' when p.b + n <= total * 0.1::double + 0.5 * n then 'val' else 'test' end
  from greedy p join i on i.unit = p.unit and i.i = p.i + 1)"""
_BIN = "case when {p}0 <= {p}1 and {p}0 <= {p}2 then 0 when {p}1 <= {p}2 then 1 else 2 end"
_LIGHT = f"""light as (
  select unit, i::bigint as i, n::bigint as s0, 0::bigint as s1, 0::bigint as s2, 0 as bin from i where i = 1
  union all
  select i.unit, i.i, p.s0 + case when {_BIN.format(p='p.s')} = 0 then n else 0 end, p.s1 + case when {_BIN.format(p='p.s')} = 1 then n else 0 end,
    p.s2 + case when {_BIN.format(p='p.s')} = 2 then n else 0 end, {_BIN.format(p='p.s')}
  from light p join i on i.unit = p.unit and i.i = p.i + 1),
sums as (select unit, arg_max(s0, i) as s0, arg_max(s1, i) as s1, arg_max(s2, i) as s2, arg_max(s0 + s1 + s2, i) as t from light group by 1),
ways as (select * from (values (0, 0, 1, 2), (1, 0, 2, 1), (2, 1, 0, 2), (3, 1, 2, 0), (4, 2, 0, 1), (5, 2, 1, 0)) v(o, x, y, z)),
fit as (select unit, o, x, y, z, round(abs([s0, s1, s2][x + 1] / t - 0.8::double) + abs([s0, s1, s2][y + 1] / t - 0.1::double) + abs([s0, s1, s2][z + 1] / t - 0.1::double), 12) as e from sums, ways),
best as (select unit, arg_min(x, (e, o)) as x, arg_min(y, (e, o)) as y from fit group by 1),
lightest as (select i.unit, i.group_key, i.n, case l.bin when b.x then 'train' when b.y then 'val' else 'test' end as split
  from light l join i using (unit, i) join best b using (unit))"""


def _ratios(t: str) -> str:
    return f"""select unit, count(*) as n_groups, round(abs(round(coalesce(sum(n) filter (split = 'train'), 0) / sum(n), 3) - 0.8::double)
      + abs(round(coalesce(sum(n) filter (split = 'val'), 0) / sum(n), 3) - 0.1::double) + abs(round(coalesce(sum(n) filter (split = 'test'), 0) / sum(n), 3) - 0.1::double), 6) as err from {t} group by 1"""


_FREQ = f"""t as (select * from m where split = 'train'),
e as (select row_id, unnest(list_distinct(string_split(coalesce(mapped_class, ''), '+'))) as value from t),
f as (select value, round(count(*)::double / (select count(*) from t), 9) as share from e where value <> '' group by 1),
grid as (select value, share, t, least(6.0, greatest(1.0, sqrt(t / share))) as r from f, (select unnest({REPEAT_TS}::double[]) as t))"""
_RANK = "md5('42:' || {k})"
_STRIDE = """k as (select source, row_id, row_number() over (partition by source order by row_id) - 1 as i, count(*) over (partition by source) as n from m where source is not null)"""
_SPLIT_TURN = """turn as (
  select unit, i::bigint as i, 0::bigint as test, 0::bigint as train, 0::bigint as val, ''::varchar as split, 0::bigint as n from i where i = 1
  union all
  select p.unit, p.i + 1,
    p.test + case when p.test <= p.train and p.test <= p.val then i.n else 0 end,
    p.train + case when p.test <= p.train and p.test <= p.val then 0 when p.train <= p.val then i.n else 0 end,
    p.val + case when p.test <= p.train and p.test <= p.val then 0 when p.train <= p.val then 0 else i.n end,
    case when p.test <= p.train and p.test <= p.val then 'test' when p.train <= p.val then 'train' else 'val' end, i.n::bigint
  from turn p join i on i.unit = p.unit and i.i = p.i)"""

SQL = {
    "o1_greedy": f"with recursive {MANIFEST}, {_GROUPS}, {GREEDY} select i.unit, i.group_key, i.n, w.split from greedy w join i using (unit, i)",
    "o2_lightest": f"with recursive {MANIFEST}, {_GROUPS}, {_LIGHT} select * from lightest",
    "o3_choose": f"""with recursive {MANIFEST}, {_GROUPS}, {GREEDY}, {_LIGHT}, done as (select i.unit, i.n, w.split from greedy w join i using (unit, i)),
        a as ({_ratios('done')}), b as ({_ratios('lightest')})
        select a.unit, a.n_groups, a.err as greedy_err, b.err as lightest_err, case when a.err <= b.err then 'greedy' else 'lightest' end as chosen from a join b using (unit)""",
    "o4_joint_rows": f"""with recursive {MANIFEST}, {_GROUPS}, {GREEDY}, done as (select i.unit, i.group_key, w.split as new_split from greedy w join i using (unit, i))
        select source, new_split, count(*) as n_rows from m join done on done.unit = {_UNIT} and done.group_key = m.group_key group by 1, 2""",
    "o5_rank_sample": f"select doc_id from documents order by {_RANK.format(k='doc_id')}, doc_id limit 100",
    "o7_quota": f"""with {MANIFEST}, q as (select group_key, least(count(*) filter (n_boxes = 0), floor(count(*) filter (n_boxes > 0) * 0.15::double)) as quota from m where group_key is not null group by 1),
        r as (select group_key, row_id, row_number() over (partition by group_key order by {_RANK.format(k='row_id')}, row_id) as i from m where n_boxes = 0)
        select r.group_key, row_id from r join q using (group_key) where i <= quota""",
    "o8_cap": f"""with {MANIFEST}, t as (select *, source in {POOL} and n_boxes > 0 as pool from m where split = 'train'),
        a as (select count(*) as n, count(*) filter (pool) as p, count(*) filter (pool and source = '{DOMINANT}') as d from t),
        k as (select case when p::double / n > 0.35::double then least(d, greatest(0, p - floor(0.35::double * (n - p) / (1 - 0.35::double)))) else 0 end as gone from a),
        r as (select row_id, row_number() over (order by {_RANK.format(k='row_id')}, row_id) as i from t where pool and source = '{DOMINANT}')
        select source, count(*) as n_rows, sum(row_id)::bigint as id_sum from t where row_id not in (select row_id from r, k where i <= gone) group by 1""",
    "o9_budget": f"""with {MANIFEST}, t as (select *, n_boxes = 0 as e, coalesce(source = 'kanal_fx', false) as f from m where split = 'train'),
        b as (select floor(0.10::double * count(*) filter (not e))::bigint as budget, count(*) filter (e and f) as a from t),
        r as (select row_id, source, f, row_number() over (partition by f order by row_id) as i from t where e)
        select row_id, source from r, b where (f and i <= least(a, budget // 2)) or (not f and i <= budget - least(a, budget // 2))""",
    "o10_repeat_grid": f"with {MANIFEST}, {_FREQ} select value, t, round(r, 6) as r from grid",
    "o10_choose_t": f"""with {MANIFEST}, {_FREQ} select coalesce(min(t) filter (value = 'hyacinth' and r between 3 and 6), max(t)) as t,
        min(t) filter (value = 'hyacinth' and r between 3 and 6) is null as fallback from grid""",
    "o11_repeats": f"""with {MANIFEST}, {_FREQ}, u as (select coalesce(min(t) filter (value = 'hyacinth' and r between 3 and 6), max(t)) as used from grid),
        x as (select t.row_id, greatest(1, floor(max(coalesce(grid.r, 1.0))))::int as repeats from t left join e on e.row_id = t.row_id
          left join grid on grid.value = e.value and grid.t = (select used from u) group by 1)
        select repeats, sum(repeats)::bigint as n_lines, count(*) as n_rows from x group by 1""",
    "o12_largest_remainder": f"""with {MANIFEST}, k as (select source, count(*) as capacity from m where split = 'train' and source is not null group by 1),
        q as (select *, least(1024, sum(capacity) over ()) as n, least(1024, sum(capacity) over ()) * capacity::double / sum(capacity) over () as q from k),
        r as (select *, floor(round(q, 9)) as f, round(q - floor(round(q, 9)), 9) as rest from q),
        z as (select *, row_number() over (order by rest desc, source) as i, sum(f) over () as placed from r)
        select source, capacity, (f + (i <= n - placed)::int)::bigint as quota from z""",
    "o13_stratified": f"""with {MANIFEST}, t as (select *, coalesce(contains(mapped_class, 'hyacinth'), false) as s from m where split = 'train' and source is not null),
        h as (select least(count(*) filter (s), 256) as k from t),
        k as (select source, count(*) as capacity from t where not s group by 1),
        q as (select *, least(1024 - (select k from h), sum(capacity) over ()) as n from k),
        q2 as (select *, n * capacity::double / sum(capacity) over () as q from q),
        r as (select *, floor(round(q, 9)) as f, round(q - floor(round(q, 9)), 9) as rest from q2),
        z as (select *, row_number() over (order by rest desc, source) as i, sum(f) over () as placed from r),
        quota as (select source, f + (i <= n - placed)::int as quota from z),
        x as (select row_id, source, s, row_number() over (partition by s order by {_RANK.format(k='row_id')}, row_id) as i,
          row_number() over (partition by s, source order by {_RANK.format(k='row_id')}, row_id) as j from t)
        select row_id, source from x left join quota using (source) where (s and i <= (select k from h)) or (not s and j <= quota)""",
    "o14_floors": f"""with r as (select *, row_number() over (partition by o_orderpriority order by {_RANK.format(k='o_orderkey')}, o_orderkey) as i from orders),
        x as (select o_orderkey, o_orderpriority from r order by (i > 10)::int, {_RANK.format(k='o_orderkey')}, o_orderkey limit 200),
        p as (select *, row_number() over (order by md5('43:' || o_orderkey), o_orderkey)::int as place from x)
        select *, case when place <= 100 then 'train' else 'val' end as split from p""",
    "o15_proposed": f"with recursive {MANIFEST}, {_GROUPS}, {_SPLIT_TURN} select i.unit, i.group_key, i.n, t.split from turn t join i on i.unit = t.unit and i.i = t.i - 1 where t.split <> ''",
    "o16_top_pairs": """select a.vec_id, b.vec_id as neighbour, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 4) as cosine
        from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0 and round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 4) >= 0.3
        order by 3 desc, 1, 2 limit 50""",
    "o17_clip_holdout": f"""with {MANIFEST}, g as (select distinct source, group_key from m where group_key is not null and source is not null),
        r as (select *, row_number() over (partition by source order by {_RANK.format(k='group_key')}, group_key) as i, ceil(count(*) over (partition by source) * 0.3::double) as q from g)
        select source, group_key from r where i <= q""",
    "pr12_strided": f"with {MANIFEST}, {_STRIDE} select source, row_id from k where i % greatest(1, n // 300) = 0",
    "w2_rank_groups": f"with {MANIFEST}, {_GROUPS} select unit, group_key, n, i::int as place from i where i <= 10",
    "w5_first_k": f"with {MANIFEST}, {_STRIDE} select source, row_id from k where i < 20",
    "w7_even_picks": f"with {MANIFEST}, {_STRIDE} select source, row_id from k where i % greatest(1, n // 5) = 0 and i // greatest(1, n // 5) < 5",
    "w8_peaks": """with k as (select event_type, ts::date as day, round(avg(value), 6) as mean from events group by 1, 2)
        select event_type, arg_max(day, (mean, day)) as best_day, max(mean) as best_mean, arg_max(mean, day) as last_mean from k group by 1""",
}
