"""Deduplication of new batches against everything accepted before, through a persisted index."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.bits import Bands, hamming
from quillwort.llm.minwise import Minwise
from quillwort.operators.dedupe import settle
from quillwort.session import durable, parallelism


class AcceptedIndex:
    """Band keys, fingerprints and digests of the accepted images, in hash buckets at a path that can be opened again.

    ``keys`` has (key, stored, image_id): each distinct fingerprint under every band of its minwise
    signature (negative keys, so sorted apart) and under five bands of its bits, the exact way for
    what minwise keys miss; ``digests`` has (digest, image_id, hash). A probe shuffles the batch only: the index is
    read in its buckets. Accepting rows appends files; nothing written before is read for that, and
    appending the same rows twice, as after a lost driver, changes no result.

    The tables are files of the path; the session's catalog only holds how they are bucketed, under
    names of this object that ``close`` removes.
    """

    TABLES = {"keys": "key bigint, stored bigint, image_id bigint", "digests": "digest string, image_id bigint, hash bigint"}

    def __init__(self, spark: SparkSession, path: str, threshold: int, bit_bands: int, minwise_bands: int, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.cut, self.minwise = Bands(threshold, bit_bands), Minwise(minwise_bands)
        self.names = {k: f"quillwort_{k}_{uuid.uuid4().hex}" for k in self.TABLES}
        for k, columns in self.TABLES.items():
            by = columns.split()[0]
            spark.sql(
                f"create table {self.names[k]} ({columns}) using parquet clustered by ({by}) sorted by ({by}) into {buckets} buckets "
                f"location '{os.path.join(path, k)}'"
            )

    @classmethod
    def create(cls, spark: SparkSession, path: str, threshold: int = 8, bit_bands: int = 5, minwise_bands: int = 16, buckets: int | None = None) -> AcceptedIndex:
        """An empty index at a path that holds nothing yet. ``buckets`` are fixed for its life: choose them for the history to come."""
        about = [threshold, bit_bands, minwise_bands, buckets or max(2, parallelism(spark))]
        place = spark._jvm.org.apache.hadoop.fs.Path(path, "about.json")
        out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, False)
        out.write(bytearray(json.dumps(about).encode()))
        out.close()
        return cls(spark, path, *about)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> AcceptedIndex:
        """The index that ``create`` once made at the path, with all that was appended since."""
        return cls(spark, path, *json.loads(spark.read.text(os.path.join(path, "about.json")).first()[0]))

    def __enter__(self) -> AcceptedIndex:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def append(self, accepted: DataFrame) -> None:
        """Add rows of (image_id, digest, hash); null digests and hashes are not indexed.

        Equal fingerprints or digests count as one, with the lowest image_id.
        """
        stored = F.col("stored")
        hashes = accepted.where("hash is not null").groupBy(F.col("hash").alias("stored")).agg(F.min("image_id").alias("image_id"))
        keys = F.concat(self.minwise.keys(stored), self.cut.stored_keys(stored))
        digests = accepted.where("digest is not null").groupBy("digest").agg(F.min(F.struct("image_id", "hash")).alias("m")).select("digest", "m.image_id", "m.hash")
        self._write("keys", hashes.select(F.explode(keys).alias("key"), "stored", "image_id"), "key")
        self._write("digests", digests, "digest")

    def _write(self, name: str, df: DataFrame, by: str) -> None:
        (
            df.repartition(self.buckets, by).write.mode("append").format("parquet")
            .bucketBy(self.buckets, by).sortBy(by).option("path", os.path.join(self.path, name)).saveAsTable(self.names[name])
        )

    def nearest(self, batch: DataFrame) -> DataFrame:
        """(hash, near): for each distinct hash of the batch with a neighbour, the closest (distance, image_id), ties to the lowest id.

        The minwise keys are probed first. What they find bounds the search by bits: nothing further
        away matters, and within as many bits as there are bands a hash meets its neighbour in a
        whole band, so that only the others look up the variants of their bands.
        """
        cut, apart = self.cut, hamming(F.col("probe"), F.col("stored"))
        hashes = batch.select(F.col("hash").alias("probe")).where("probe is not null").distinct()

        def best(keyed: DataFrame, kind: str) -> DataFrame:
            index = self.spark.table(self.names["keys"]).where(kind)
            return (
                keyed.repartition(self.buckets, "key").hint("merge").join(index, "key").where(apart <= cut.threshold)
                .groupBy("probe").agg(F.min(F.struct(apart.alias("distance"), "image_id")).alias("near"))
            )

        first = durable(hashes.join(best(hashes.select("probe", F.explode(self.minwise.keys(F.col("probe"))).alias("key")), "key < 0"), "probe", "left"))
        own, around = cut.stored_keys(F.col("probe")), cut.probe_keys(F.col("probe"))
        keys = F.when(F.col("near.distance") < cut.count, own).otherwise(around)
        second = best(first.select("probe", F.explode(keys).alias("key")), "key >= 0")
        found = first.where("near is not null").unionByName(second)
        return found.groupBy(F.col("probe").alias("hash")).agg(F.min("near").alias("near"))

    def pairs(self, probes: DataFrame, stored: DataFrame) -> DataFrame:
        """(probe, stored, distance) of all distinct hashes of two sides within the threshold, once each: by minwise keys, and by bits for the rest."""
        cut, apart = self.cut, hamming(F.col("probe"), F.col("stored"))
        p = probes.select(F.col("hash").alias("probe")).where("probe is not null").distinct()
        s = stored.select(F.col("hash").alias("stored")).where("stored is not null").distinct()
        minwise = self.minwise.keys(F.col("probe")), self.minwise.keys(F.col("stored"))
        bits = cut.probe_keys(F.col("probe")), cut.stored_keys(F.col("stored"))
        found = None
        for probe_keys, stored_keys in (minwise, bits):
            met = (
                p.select("probe", F.explode(probe_keys).alias("key")).hint("merge")
                .join(s.select("stored", F.explode(stored_keys).alias("key")), "key").where(apart <= cut.threshold)
                .select("probe", "stored", apart.alias("distance"))
            )
            found = met if found is None else found.unionByName(met)
        return found.distinct()

    def same(self, batch: DataFrame) -> DataFrame:
        """(digest, same): the lowest accepted id of each digest of the batch, with its hash."""
        digests = batch.select("digest").where("digest is not null").repartition(self.buckets, "digest").distinct()
        found = digests.hint("merge").join(self.spark.table(self.names["digests"]), "digest")
        return found.groupBy("digest").agg(F.min(F.struct("image_id", "hash")).alias("same"))

    def close(self) -> None:
        """Forget the tables in this session; the files stay."""
        for name in self.names.values():
            self.spark.sql(f"drop table if exists {name}")

    def drop(self) -> None:
        """Close the index and delete its files."""
        self.close()
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def dedupe_batches(index: AcceptedIndex, incoming: DataFrame) -> DataFrame:
    """(image_id, matched_id, hamming, by_digest) of the incoming images that repeat an accepted one; the others join the index.

    ``incoming`` has (image_id, batch_no, digest, hash). Images are taken in order of batch_no (null
    last), then image_id; all batches at hand are decided together, as in that order. An image is a
    case if an image accepted before it has its digest, or a hash within the threshold. The match is
    the lowest image_id with the same digest, else the closest, ties to the lowest image_id; hamming
    is the distance to it, 0 for a digest match whose hashes cannot be compared. A null digest or
    hash matches nothing; an image with neither is accepted. Rows without an image_id are ignored
    and rows with the same image_id count once, as the one of the first batch. Empty tables give no cases.
    """
    last = F.coalesce(F.col("batch_no").cast("int"), F.lit((1 << 31) - 1))
    batch = (
        incoming.where("image_id is not null").select("image_id", "digest", "hash", last.alias("batch_no"))
        .groupBy("image_id").agg(F.min(F.struct("batch_no", "digest", "hash")).alias("r"))
        .select(F.struct("r.batch_no", "image_id").alias("seq"), "r.digest", "r.hash")
    )
    seen = durable(batch.join(index.same(batch).hint("merge"), "digest", "left").join(index.nearest(batch).hint("merge"), "hash", "left"))
    open_ = seen.where("same is null and near is null").select("seq", "digest", "hash")
    pairs = durable(index.pairs(seen, open_))
    accepted = settle(open_, pairs)
    rest = seen.join(accepted.select("seq"), "seq", "left_anti")
    new_same = accepted.where("digest is not null").select("digest", F.col("seq").alias("ds"), F.struct(F.col("seq.image_id").alias("image_id"), "hash").alias("new_same"))
    new_hash = accepted.where("hash is not null").select(F.col("hash").alias("stored"), F.col("seq").alias("hs"))
    closest = (
        rest.select("seq", F.col("hash").alias("probe")).join(pairs, "probe").join(new_hash, "stored").where("hs < seq")
        .groupBy("seq").agg(F.min(F.struct("distance", F.col("hs.image_id").alias("image_id"))).alias("new_near"))
    )
    same = F.least("same", F.when(F.col("ds") < F.col("seq"), F.col("new_same")))
    near = F.least("near", "new_near")
    cases = durable(
        rest.join(new_same, "digest", "left").join(closest, "seq", "left")
        .select("seq.image_id", "hash", same.alias("same"), near.alias("near"))
        .select(
            "image_id", F.coalesce("same.image_id", "near.image_id").alias("matched_id"),
            F.when(F.col("same").isNull(), F.col("near.distance")).otherwise(F.coalesce(hamming(F.col("hash"), F.col("same.hash")), F.lit(0))).cast("int").alias("hamming"),
            F.col("same").isNotNull().alias("by_digest"),
        )
    )
    index.append(accepted.select("seq.image_id", "digest", "hash"))
    return cases
