"""Queries of duplicates, neighbours and the tile join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.bits import fingerprint64
from quillwort.functions.names import computed_hash, digest_key
from quillwort.operators import dedupe, tiling
from quillwort.operators.hamming import near_values, nearest
from quillwort.operators.vectors import cosine_search
from quillwort.plans.inputs import CANDIDATES, candidates, strip_sql
from quillwort.session import table

#: Every row whose id this divides is asked, against all rows.
ASKED = 50


def f1_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", fingerprint64(F.col("embedding")).alias("hash"))


def j6_hamming_nn(spark: SparkSession, d: str) -> DataFrame:
    """The nearest other fingerprint of every 50th embedding among all embeddings."""
    prints = f1_fingerprints(spark, d)
    return nearest(prints.where(F.col("vec_id") % ASKED == 0), prints, "vec_id", "vec_id", "hash", others=True)


def _images(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, name).select("image_id", digest_key("sha256").alias("digest"), computed_hash("phash").alias("hash"))


def j7_hamming_bank(spark: SparkSession, d: str) -> DataFrame:
    """The nearest accepted image of every 50th incoming one, whatever the distance."""
    asked = _images(spark, d, "incoming_images").where(F.col("image_id") % ASKED == 0)
    return nearest(asked, _images(spark, d, "accepted_images"), "image_id", "image_id", "hash")


def j8_cosine_nn(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return cosine_search(e.where(F.col("vec_id") % ASKED == 0), e, "vec_id", "embedding")


def j9_pairs_over(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours of every 50th embedding at each of three thresholds."""
    e = table(spark, d, "embeddings")
    pairs = cosine_search(e.where(F.col("vec_id") % ASKED == 0), e, "vec_id", "embedding", 0.25)
    thresholds = F.explode(F.array(F.lit(0.25), F.lit(0.3), F.lit(0.35))).alias("threshold")
    return pairs.select("vec_id", "neighbour", "cosine", thresholds).where("cosine >= threshold")


def j10_two_sided(spark: SparkSession, d: str) -> DataFrame:
    """Incoming images near an accepted one, and near an earlier incoming one: the closest of each side."""
    incoming, accepted = _images(spark, d, "incoming_images"), _images(spark, d, "accepted_images")
    mine = incoming.where("hash is not null").select("image_id", F.col("hash").alias("probe"))
    sides = []
    for kind, bank in (("incumbent", accepted), ("candidate", incoming)):
        pairs = near_values(incoming, bank, "hash")
        other = bank.where("hash is not null").select(F.col("hash").alias("stored"), F.col("image_id").alias("matched_id"))
        joined = mine.join(pairs, "probe").join(other, "stored")
        if kind == "candidate":
            joined = joined.where("matched_id < image_id")
        best = joined.groupBy("image_id").agg(F.min(F.struct("distance", "matched_id")).alias("m"))
        sides.append(best.select("image_id", F.lit(kind).alias("kind"), F.col("m.matched_id").alias("matched_id"), F.col("m.distance").alias("distance")))
    return sides[0].unionByName(sides[1])


def j11_exact_first(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.exact_matches(_images(spark, d, "incoming_images"), _images(spark, d, "accepted_images"), "digest", "image_id")


def a8_exact_dupes(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.redundancy(dedupe.exact_groups(table(spark, d, "documents"), F.md5(F.col("text").cast("binary")), "doc_id"))


def a8_dupe_groups(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.exact_groups(table(spark, d, "documents"), F.md5(F.col("text").cast("binary")), "doc_id")


def _arrivals(spark: SparkSession, d: str) -> DataFrame:
    known = _images(spark, d, "accepted_images").select(F.col("image_id").alias("seq"), "hash", F.lit(True).alias("incumbent"))
    return known.unionByName(_images(spark, d, "incoming_images").select(F.col("image_id").alias("seq"), "hash", F.lit(False).alias("incumbent")))


def o6_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """Drops of first-seen removal over both image tables, accepted images being incumbents."""
    return dedupe.first_seen(_arrivals(spark, d))[1]


def w4_keep_first(spark: SparkSession, d: str) -> DataFrame:
    """The images that first-seen removal keeps."""
    return dedupe.first_seen(_arrivals(spark, d))[0].select(F.col("seq").alias("image_id"))


def v8_cross_split_bytes(spark: SparkSession, d: str) -> DataFrame:
    """Texts with the same bytes in different sources, digested only where the sizes agree."""
    documents = table(spark, d, "documents").where("text is not null").select(F.length("text").alias("size"), "source", F.col("text").cast("binary").alias("bytes"))
    return dedupe.cross_split_bytes(documents, "size", "source", "bytes")


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """A box in an image for each line item: the part is the image, discount and tax place the box."""
    lines, parts = table(spark, d, "lineitem"), table(spark, d, "part")
    sizes = parts.select(F.col("p_partkey").alias("l_partkey"), (F.lit(640) + F.col("p_size") * 40).alias("width"), (F.lit(600) + F.col("p_size") * 24).alias("height"))
    x, y = F.col("l_discount") * 10 * F.col("width"), F.col("l_tax") * 12 * F.col("height")
    placed = lines.join(sizes, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "width", "height", x.alias("x_min"), y.alias("y_min"), (x + 10 + F.col("l_quantity") * 6).alias("x_max"), (y + 8 + F.col("l_quantity") * 4).alias("y_max"))
    return placed.select("l_orderkey", "l_linenumber", "l_partkey", "width", "height", "x_min", "y_min", F.least("x_max", "width").alias("x_max"), F.least("y_max", "height").alias("y_max"))


def j12_tile_join(spark: SparkSession, d: str) -> DataFrame:
    hits = tiling.tile_hits(boxes(spark, d))
    return hits.select("l_orderkey", "l_linenumber", "col", "row", F.round("fraction", 6).alias("fraction"))


def a13_appearances(spark: SparkSession, d: str) -> DataFrame:
    b = boxes(spark, d).withColumn("box", F.struct("l_orderkey", "l_linenumber", "l_partkey", "x_min", "y_min", "x_max", "y_max"))
    return tiling.appearance_histogram(b, tiling.tile_hits(b), "box")


def v6_tie_out(spark: SparkSession, d: str) -> DataFrame:
    return tiling.reconcile_appearances(a13_appearances(spark, d))


def f17_tile_grid(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "part").select("p_partkey", (F.lit(640) + F.col("p_size") * 40).alias("width"), (F.lit(600) + F.col("p_size") * 24).alias("height"))
    return tiling.tile_grid(sizes, "width", "height").select("p_partkey", "x0", "y0", "tag")


def f18_letterbox(spark: SparkSession, d: str) -> DataFrame:
    """Share of boxes whose shorter side is below 8 pixels once their image is fitted into 640 and 960 pixels."""
    b = boxes(spark, d).withColumn("imgsz", F.explode(F.array(F.lit(640), F.lit(960))))
    side = F.least(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min")) * F.col("imgsz") / F.greatest("width", "height")
    return b.groupBy("imgsz").agg(F.count("*").alias("n"), F.round(F.avg((side < 8).cast("double")), 6).alias("share_lt8px"))


def pr11_tiny(spark: SparkSession, d: str) -> DataFrame:
    b = boxes(spark, d)
    side = F.least(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min")) * 960 / F.greatest("width", "height")
    return b.where(side < 4).select("l_orderkey", "l_linenumber")


def pr8_tile_overhang(spark: SparkSession, d: str) -> DataFrame:
    """Hits whose box reaches beyond its tile by more than a thousandth of it."""
    h = tiling.tile_hits(boxes(spark, d))
    eps = 0.001 * tiling.TILE
    beyond = (F.col("x_min") < F.col("x0") - eps) | (F.col("y_min") < F.col("y0") - eps) | (F.col("x_max") > F.col("x0") + tiling.TILE + eps) | (F.col("y_max") > F.col("y0") + tiling.TILE + eps)
    return h.where(beyond).groupBy("col", "row").agg(F.count("*").alias("n"))


def a24_twins(spark: SparkSession, d: str) -> DataFrame:
    """Records of each digest that several records of a source, or of several sources, have."""
    c = candidates(spark, d).where("digest is not null")
    cells = c.groupBy("digest").agg(F.count("*").alias("n"), F.countDistinct("source").alias("n_sources"))
    return cells.where("n > 1").groupBy((F.col("n_sources") > 1).alias("across")).agg(F.count("*").alias("n_groups"), F.sum("n").alias("n_records"))


QUERIES = {f.__name__: f for f in (
    f1_fingerprints, j6_hamming_nn, j7_hamming_bank, j8_cosine_nn, j9_pairs_over, j10_two_sided, j11_exact_first, a8_exact_dupes, a8_dupe_groups,
    o6_first_seen, w4_keep_first, v8_cross_split_bytes, j12_tile_join, a13_appearances, v6_tie_out, f17_tile_grid, f18_letterbox, pr8_tile_overhang, pr11_tiny, a24_twins,
)}

_PRINTS = """med as (select vec_id, embedding, list_sort(embedding[2:64])[32] as med from embeddings),
long as (select vec_id, med, unnest(embedding) as x, generate_subscripts(embedding, 1) as i from med),
prints as (select vec_id, (sum(case when x > med and i > 1 then 1::hugeint << (64 - i)::int else 0::hugeint end)
  - max(case when x > med and i = 1 then 9223372036854775808::hugeint else 0::hugeint end))::bigint as hash from long group by vec_id)"""
_BOXES = """sized as (select l.*, 640 + p_size * 40 as width, 600 + p_size * 24 as height from lineitem l join part p on p_partkey = l_partkey),
placed as (select *, l_discount * 10 * width as x_min, l_tax * 12 * height as y_min from sized),
b as (select l_orderkey, l_linenumber, l_partkey, width, height, x_min, y_min, least(x_min + 10 + l_quantity * 6, width) as x_max, least(y_min + 8 + l_quantity * 4, height) as y_max from placed),
grid as (select b.*, c.c as col, r.r as row, least(c.c * 512, width - 640) as x0, least(r.r * 512, height - 640) as y0
  from b, (select unnest(range(0, 8)) as c) c, (select unnest(range(0, 8)) as r) r
  where c.c < greatest(1, floor((width - 640) / 512)::int + 1) and r.r < greatest(1, floor((height - 640) / 512)::int + 1) and x_max > x_min and y_max > y_min),
hits as (select *, greatest(0, least(x_max, x0 + 640) - greatest(x_min, x0)) * greatest(0, least(y_max, y0 + 640) - greatest(y_min, y0))
  / greatest((x_max - x_min) * (y_max - y_min), 1e-9) as fraction from grid),
h as (select * from hits where fraction >= 0.40::double)"""
_HIST = """w as (select count(h.col) as n_tiles from b left join h using (l_orderkey, l_linenumber, l_partkey, x_min, y_min, x_max, y_max)
  group by l_orderkey, l_linenumber, l_partkey, x_min, y_min, x_max, y_max),
hist as (select n_tiles, count(*) as n_boxes from w group by 1)"""
_SIDE = "least(x_max - x_min, y_max - y_min)"


def _img(t: str, name: str) -> str:
    return f"{name} as (select image_id, nullif({strip_sql('sha256')}, '') as digest, nullif(phash, 0) as hash from {t})"


_IMAGES = f"{_img('accepted_images', 'acc')}, {_img('incoming_images', 'inc')}"
_COS = "round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 4)"

_SEEN = """r as (select image_id as seq, nullif(phash, 0) as hash, true as incumbent from accepted_images union all select image_id, nullif(phash, 0), false from incoming_images),
  a as (select *, row_number() over (order by seq) as i from r),
  w as (
    select 0::bigint as i, null::bigint as seq, []::struct(distance integer, seq bigint, hash bigint)[] as kept, null::struct(distance integer, seq bigint, hash bigint) as near
    union all
    select i, seq, case when near is null and hash is not null then list_append(kept, {'distance': 0, 'seq': seq, 'hash': hash}) else kept end, near from (
      select a.i, a.seq, a.hash, w.kept, case when not a.incumbent and a.hash is not null then
        list_min(list_transform(list_filter(w.kept, lambda x: bit_count(xor(x.hash, a.hash)) <= 8), lambda x: {'distance': bit_count(xor(x.hash, a.hash))::integer, 'seq': x.seq, 'hash': x.hash})) end as near
      from w join a on a.i = w.i + 1))"""

SQL = {
    "f1_fingerprints": f"with {_PRINTS} select vec_id, hash from prints",
    "j6_hamming_nn": f"""with {_PRINTS} select a.vec_id, arg_min(b.vec_id, (bit_count(xor(a.hash, b.hash)), b.vec_id)) as nearest_id, min(bit_count(xor(a.hash, b.hash)))::int as distance
        from prints a join prints b on a.vec_id % 50 = 0 and b.vec_id <> a.vec_id group by 1""",
    "j7_hamming_bank": f"""with {_IMAGES} select a.image_id, arg_min(b.image_id, (bit_count(xor(a.hash, b.hash)), b.image_id)) filter (a.hash is not null and b.hash is not null) as nearest_id,
        min(bit_count(xor(a.hash, b.hash)))::int as distance from inc a cross join acc b where a.image_id % 50 = 0 group by 1""",
    "j8_cosine_nn": f"select a.vec_id, arg_min(b.vec_id, (-{_COS}, b.vec_id)) as neighbour, max({_COS}) as cosine from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0 group by 1",
    "j9_pairs_over": f"""with p as (select a.vec_id, b.vec_id as neighbour, {_COS} as cosine from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0)
        select p.*, threshold from p, (select unnest([0.25, 0.3, 0.35]::double[]) as threshold) where cosine >= threshold""",
    "j10_two_sided": f"""with {_IMAGES}, p as (
        select a.image_id, 'incumbent' as kind, b.image_id as matched_id, bit_count(xor(a.hash, b.hash)) as distance from inc a join acc b on bit_count(xor(a.hash, b.hash)) <= 8
        union all select a.image_id, 'candidate', b.image_id, bit_count(xor(a.hash, b.hash)) from inc a join inc b on b.image_id < a.image_id and bit_count(xor(a.hash, b.hash)) <= 8)
        select image_id, kind, arg_min(matched_id, (distance, matched_id)) as matched_id, min(distance)::int as distance from p group by 1, 2""",
    "j11_exact_first": f"""with {_IMAGES}, k as (select digest, min(image_id) as i from acc where digest is not null group by 1), f as (select digest, min(image_id) as i from inc where digest is not null group by 1)
        select image_id, coalesce(k.i, f.i) as matched, case when k.i is not null then 'incumbent' else 'candidate' end as kind
        from inc left join k using (digest) left join f using (digest) where k.i is not null or f.i < image_id""",
    "a8_exact_dupes": "with g as (select count(*) as n from documents where text is not null group by md5(text) having count(*) > 1) select count(*) as n_groups, coalesce(sum(n - 1), 0)::bigint as redundant from g",
    "a8_dupe_groups": "select md5(text) as digest, count(*) as n, min(doc_id) as first from documents where text is not null group by 1 having count(*) > 1",
    "o6_first_seen": f"with recursive {_SEEN} select seq, near.seq as matched_seq, near.distance::int as distance from w where near is not null",
    "w4_keep_first": f"with recursive {_SEEN} select seq as image_id from w where i > 0 and near is null",
    "v8_cross_split_bytes": """select sha256(text) as digest, count(*) as n, string_agg(distinct source, '+' order by source) as splits from documents
        where text is not null and source is not null group by 1 having count(distinct source) > 1""",
    "j12_tile_join": f"with {_BOXES} select l_orderkey, l_linenumber, col::int as col, row::int as row, round(fraction, 6) as fraction from h",
    "a13_appearances": f"with {_BOXES}, {_HIST} select * from hist",
    "v6_tie_out": f"""with {_BOXES}, {_HIST} select sum(n_boxes)::bigint as raw, coalesce(sum(n_boxes) filter (n_tiles = 0), 0)::bigint as boundary_dropped,
        coalesce(sum((n_tiles - 1) * n_boxes) filter (n_tiles > 1), 0)::bigint as overlap_gain, sum(n_tiles * n_boxes)::bigint as tiled from hist""",
    "f17_tile_grid": """with s as (select p_partkey, 640 + p_size * 40 as width, 600 + p_size * 24 as height from part)
        select p_partkey, least(c * 512, width - 640)::int as x0, least(r * 512, height - 640)::int as y0, 'x' || least(c * 512, width - 640) || '_y' || least(r * 512, height - 640) || '_s512' as tag
        from s, (select unnest(range(0, 8)) as c), (select unnest(range(0, 8)) as r)
        where c < greatest(1, floor((width - 640) / 512)::int + 1) and r < greatest(1, floor((height - 640) / 512)::int + 1)""",
    "f18_letterbox": f"""with {_BOXES} select imgsz, count(*) as n, round(avg(({_SIDE} * imgsz / greatest(width, height) < 8)::double), 6) as share_lt8px
        from b, (select unnest([640, 960]) as imgsz) group by 1""",
    "pr11_tiny": f"with {_BOXES} select l_orderkey, l_linenumber from b where {_SIDE} * 960 / greatest(width, height) < 4",
    "pr8_tile_overhang": f"""with {_BOXES} select col::int as col, row::int as row, count(*) as n from h
        where x_min < x0 - 0.64 or y_min < y0 - 0.64 or x_max > x0 + 640.64 or y_max > y0 + 640.64 group by 1, 2""",
    "a24_twins": f"""with {CANDIDATES}, k as (select digest, count(*) as n, count(distinct source) as s from c where digest is not null group by 1 having count(*) > 1)
        select s > 1 as across, count(*) as n_groups, sum(n)::bigint as n_records from k group by 1""",
}
