"""Items that appear together: an incrementally maintained table of pair counts with association scores.

State lives below one folder: memberships (basket, item) and pair counts, both in hash buckets, and marginals. A change names
the baskets that changed with their whole new contents. Comparing those with the old contents gives signed membership
deltas; these give marginal deltas, and each changed basket emits signed pair deltas (+1 for a pair it gained, -1 for one
it lost, nothing for one it kept). Deltas are summed before and during the shuffle and merged into the buckets they
touch; other buckets are carried over by reference and keep their files. A score depends on the counts of a pair, of its items and of all
baskets, so a change of any basket moves every score: counts alone are stored, and scores are computed from them and the marginals when read.

Buckets hold about `rows_per_bucket` rows: when a table outgrows its buckets, their number is doubled until it fits and the table
is written anew, which a growing table does rarely enough to cost a constant share.

Pairs are only kept for admitted items. With n baskets and the wanted bounds n_both >= min_both and lift >= min_lift, a
pair can qualify only if min_both <= n_a and min_lift * n_a <= n (as n_both <= n_b), and the same for b. Both bounds follow
exactly from the wanted ones. When an item is admitted or loses admission, the baskets holding it emit its pairs as if
they had gained or lost it, so counts stay right however admission moves.

A basket with more than `block` admitted items is cut into blocks by item hash, and every pair of blocks is its own unit of work. Where a
join meets a hot basket or item, the rows of that key are split over tasks (by salts before they are grouped, else by the adaptive plan).

One table can hold several collections (column `space`), which share its jobs but no counts.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isolake.operators.blocks import meeting_pairs
from isolake.operators.skew import hot_keys
from isolake.session import new_dir, remove_dir

PAIR_COLUMNS = ("space", "a", "b", "n_both", "n_a", "n_b", "n", "lift", "g2")


def g2(n_both: Column, n_a: Column, n_b: Column, n: Column) -> Column:
    """Log-likelihood ratio of the 2 x 2 table of two items, signed: negative where they avoid each other."""
    total = F.lit(0.0)
    for observed, row, col in ((n_both, n_a, n_b), (n_a - n_both, n_a, n - n_b), (n_b - n_both, n - n_a, n_b), (n - n_a - n_b + n_both, n - n_a, n - n_b)):
        o, e = observed.cast("double"), row.cast("double") * col / n
        total = total + F.when(o > 0, 2 * o * F.log(o / e)).otherwise(0.0)
    return F.when(n_both * n >= n_a * n_b, total).otherwise(-total)


class PairTable:
    """The persistent pair table below `path`; a fresh path is an empty table. `buckets` is the least number of hash buckets."""

    SCHEMAS = {"memberships": "space string, basket string, item string", "pairs": "space string, a string, b string, n_both long"}
    KEYS = {"memberships": ("space", "basket"), "pairs": ("space", "a", "b")}

    def __init__(self, spark: SparkSession, path: str, min_both: int = 1, min_lift: int = 0, buckets: int = 8, block: int = 512, rows_per_task: int = 2_000_000, rows_per_bucket: int = 1_000_000):
        self.spark, self.path, self.min_both, self.min_lift = spark, path, min_both, min_lift
        self.block, self.rows_per_task, self.rows_per_bucket = block, rows_per_task, rows_per_bucket
        self.buckets = {"memberships": buckets, "pairs": buckets}
        self.rows = {"memberships": 0, "pairs": 0}
        self.version, self.sizes, self.at = 0, {}, {"memberships": {}, "pairs": {}}
        self._load()

    @property
    def n(self) -> int:
        """How many baskets hold an item, over all collections."""
        return sum(self.sizes.values())

    def _n(self, sizes: dict[str, int]) -> Column:
        """The number of baskets of the row's collection. Collections are named by the caller and few."""
        out = F.lit(0).cast("long")
        for space, n in sizes.items():
            out = F.when(F.col("space") == space, F.lit(n).cast("long")).otherwise(out)
        return out

    def _load(self) -> None:
        try:
            rows = self.spark.read.text(f"{self.path}/manifest").collect()  # one line a version
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return
        last = max((json.loads(r[0]) for r in rows), key=lambda m: m["version"])
        for k, v in last.items():
            setattr(self, k, v)

    def _commit(self) -> None:
        line = json.dumps({k: getattr(self, k) for k in ("version", "sizes", "at", "buckets", "rows")})
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/manifest")

    def _folder(self, table: str, bucket: str) -> str:
        return f"{self.path}/{table}/v={self.at[table][bucket]}/bucket={bucket}"

    def _read(self, table: str, buckets: list[str] | None = None) -> DataFrame:
        paths = [self._folder(table, b) for b in self.at[table] if buckets is None or b in buckets]
        schema = self.SCHEMAS[table]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _folders(self, path: str) -> list[str]:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName().partition("=")[2] for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("bucket=")]

    def memberships(self) -> DataFrame:
        return self._read("memberships")

    def marginals(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], "space string, item string, n_item long, admitted boolean")
        return self.spark.read.parquet(f"{self.path}/marginals/v={self.version}")

    def counts(self) -> DataFrame:
        """(space, a, b, n_both) of the counted pairs, smaller item first."""
        return self._read("pairs")

    def pairs(self, least: int = 1) -> DataFrame:
        """Counted pairs in at least `least` baskets with their scores."""
        m = self.marginals().select("space", "item", "n_item")
        c = self.counts().where(F.col("n_both") >= least)
        for x in ("a", "b"):
            c = c.join(m.select("space", F.col("item").alias(x), F.col("n_item").alias(f"n_{x}")), ["space", x])
        c = c.withColumn("n", self._n(self.sizes))
        lift = F.col("n_both").cast("double") * F.col("n") / (F.col("n_a").cast("double") * F.col("n_b"))
        return c.withColumn("lift", lift).withColumn("g2", g2(F.col("n_both"), F.col("n_a"), F.col("n_b"), F.col("n"))).select(*PAIR_COLUMNS)

    def _bucket(self, table: str) -> Column:
        return F.pmod(F.xxhash64(*self.KEYS[table]), F.lit(self.buckets[table])).cast("int")

    def _grown(self, table: str, rows: int) -> bool:
        """Whether the table needs more buckets for so many rows; if so it gets them."""
        before = self.buckets[table]
        while self.buckets[table] * self.rows_per_bucket < rows:
            self.buckets[table] *= 2
        return self.buckets[table] != before

    def _replace(self, table: str, changes: DataFrame, gained: DataFrame, merge, version: int) -> None:
        """Merge changes into the buckets they touch, or into all if the table has outgrown its buckets.

        `merge` gives the new rows from the old rows of those buckets and what was `gained`. A bucket left empty leaves the manifest. The buckets
        touched are listed on the driver: at most as many numbers as there are buckets.
        """
        if self._grown(table, self.rows[table] + gained.count()):
            touched = list(self.at[table])
        elif self.version:
            touched = [str(r[0]) for r in changes.select(self._bucket(table)).distinct().collect()]
        else:
            touched = []
        out = f"{self.path}/{table}/v={version}"
        old = self._read(table, touched)
        df = (merge(old) if self.version else gained).withColumn("bucket", self._bucket(table))
        if table == "memberships":  # a bucket may hold a hot basket; pairs are spread evenly by their hash
            keys = [x.select(*self.KEYS[table]).withColumn("bucket", self._bucket(table)) for x in (old, gained)]
            hot = F.broadcast(hot_keys(keys[0].unionByName(keys[1]), ["bucket"], self.rows_per_task))  # at most one row per rows_per_task rows
            df = df.join(hot, "bucket", "left").withColumn("__spread", F.pmod(F.xxhash64("item"), F.coalesce("__salts", F.lit(1)))).drop("__salts")
            df = df.repartition("bucket", "__spread").drop("__spread")
        else:
            df = df.repartition("bucket")
        df.write.mode("overwrite").partitionBy("bucket").parquet(out)
        for b in touched:
            self.at[table].pop(b, None)
        for b in self._folders(out):
            self.at[table][b] = version
        self.rows[table] = self._read(table).count()

    def apply(self, contents: DataFrame) -> None:
        """Replace the contents of every basket in `contents` (basket, item, and space if there are several collections); a basket with only null
        items becomes empty.

        Null baskets are ignored, repeated rows count once.
        """
        version, grown = self.version + 1, bool(self.version)
        space = F.col("space").cast("string") if "space" in contents.columns else F.lit("")
        c = contents.select(space.alias("space"), F.col("basket").cast("string").alias("basket"), F.col("item").cast("string").alias("item")).where("space IS NOT NULL AND basket IS NOT NULL")
        new = c.where("item IS NOT NULL").distinct()
        work = f"{self.path}/work/v={version}"
        basket, item = ["space", "basket"], ["space", "item"]
        delta = new.withColumn("now", F.lit(1)).withColumn("was", F.lit(0))
        if grown:
            changed = c.select(*basket).distinct()
            old = self.memberships().join(changed, basket, "left_semi").withColumn("now", F.lit(0)).withColumn("was", F.lit(1))
            delta = delta.unionByName(old).groupBy("space", "basket", "item").agg(F.max("now").alias("now"), F.max("was").alias("was"))
        delta.write.mode("overwrite").parquet(f"{work}/delta")
        delta = self.spark.read.parquet(f"{work}/delta")

        held = delta.groupBy(*basket).agg(F.max("now").alias("now"), F.max("was").alias("was")).groupBy("space").agg((F.sum("now") - F.sum("was")).alias("more")).collect()
        sizes = dict(self.sizes)
        for r in held:  # a row a collection
            sizes[r.space] = sizes.get(r.space, 0) + r.more
        self._marginals(delta, sizes, version)
        items = self.spark.read.parquet(f"{self.path}/marginals/v={version}")
        live = items.where("admitted OR was_admitted").select(*item, "admitted", "was_admitted")

        rows = delta.join(live, item)
        if grown:
            flipped = items.where("admitted <> was_admitted").select(*item)
            reached = self.memberships().join(flipped, item, "left_semi").select(*basket).distinct().join(changed, basket, "left_anti")
            idle = self.memberships().join(reached, basket, "left_semi").join(live, item)
            rows = rows.unionByName(idle.withColumn("now", F.lit(1)).withColumn("was", F.lit(1)))
        now = (F.col("now") == 1) & F.col("admitted")
        was = (F.col("was") == 1) & F.col("was_admitted")
        rows = rows.select(*basket, "item", (now.cast("int") - was.cast("int")).alias("st")).where(now | was)
        rows.write.mode("overwrite").parquet(f"{work}/rows")
        deltas = self._pair_deltas(self.spark.read.parquet(f"{work}/rows"))
        deltas.write.mode("overwrite").parquet(f"{work}/pairs")
        deltas = self.spark.read.parquet(f"{work}/pairs")
        gained = deltas.select("space", "a", "b", F.col("change").alias("n_both"))
        self._replace("pairs", deltas, gained, lambda old: old.unionByName(gained).groupBy("space", "a", "b").agg(F.sum("n_both").alias("n_both")).where("n_both > 0"), version)
        fresh = delta.where("now = 1").select(*basket, "item")
        self._replace("memberships", delta, fresh, lambda old: old.join(delta.select(*basket).distinct(), basket, "left_anti").unionByName(fresh), version)
        self.version, self.sizes = version, sizes
        self._commit()
        remove_dir(self.spark, work)

    def vacuum(self) -> None:
        """Remove what the newest version no longer refers to. Frames of older versions cannot be read afterwards."""
        for v in range(1, self.version):
            remove_dir(self.spark, f"{self.path}/marginals/v={v}")
        for table, held in self.at.items():
            for v in range(1, self.version + 1):
                try:
                    there = self._folders(f"{self.path}/{table}/v={v}")
                except Exception as e:  # noqa: BLE001
                    if "FileNotFound" not in str(e):
                        raise
                    continue
                for b in there:
                    if held.get(b) != v:
                        remove_dir(self.spark, f"{self.path}/{table}/v={v}/bucket={b}")

    def _marginals(self, delta: DataFrame, sizes: dict[str, int], version: int) -> None:
        change = delta.groupBy("space", "item").agg(F.sum(F.col("now") - F.col("was")).alias("change"))
        before = self.marginals().select("space", "item", "n_item", F.col("admitted").alias("was_admitted"))
        m = (
            before.unionByName(change.select("space", "item", F.col("change").alias("n_item"), F.lit(False).alias("was_admitted")))
            .groupBy("space", "item")
            .agg(F.sum("n_item").alias("n_item"), F.max("was_admitted").alias("was_admitted"))
        )
        admitted = (F.col("n_item") >= max(1, self.min_both)) & (F.col("n_item") * self.min_lift <= self._n(sizes))
        m.withColumn("admitted", admitted).where("n_item > 0 OR was_admitted").write.mode("overwrite").parquet(f"{self.path}/marginals/v={version}")

    def _pair_deltas(self, rows: DataFrame) -> DataFrame:
        """(space, a, b, change), changes summed and not 0, of rows (space, basket, item, st): st 1 gained, -1 lost, 0 kept.

        Only pairs of which an item was gained or lost are made; baskets above `block` items are cut into blocks.
        """
        p = meeting_pairs(rows, ["space", "basket"], "item", ["st", "space"], self.block, self.rows_per_task, lambda x, y: (x["st"] != 0) | (y["st"] != 0))
        # in both now: neither lost; in both before: neither gained
        change = ((F.col("x.st") >= 0) & (F.col("y.st") >= 0)).cast("int") - ((F.col("x.st") <= 0) & (F.col("y.st") <= 0)).cast("int")
        return (
            p.select("x.space", F.col("x.item").alias("a"), F.col("y.item").alias("b"), change.alias("change"))
            .groupBy("space", "a", "b").agg(F.sum("change").alias("change")).where("change <> 0")
        )


def associated(table: PairTable) -> DataFrame:
    """The pairs that meet the table's bounds, compared in whole numbers."""
    return table.pairs(table.min_both).where(F.col("n_both") * F.col("n") >= F.col("n_a") * F.col("n_b") * table.min_lift)


def _trim(c: str) -> Column:
    return F.btrim(F.col(c), F.lit(" \t\r\n"))


def presence_baskets(presence: DataFrame) -> DataFrame:
    """(basket, item) of gene_presence_absence: samples holding genes; a contradicted row counts if any copy says present."""
    return presence.where("present = 1").select(_trim("sample_id").alias("basket"), _trim("gene").alias("item")).where("basket IS NOT NULL AND item IS NOT NULL")


def determinant_baskets(calls: DataFrame) -> DataFrame:
    return calls.select(_trim("sample_id").alias("basket"), _trim("gene").alias("item")).where("basket IS NOT NULL AND item IS NOT NULL")


def pair_table(spark: SparkSession, *changes: DataFrame, min_both: int = 6, min_lift: int = 3, **options) -> PairTable:
    """A table in a fresh shared folder to which the changes were applied one after the other; only the last version is kept."""
    t = PairTable(spark, new_dir(spark, "pairs"), min_both, min_lift, **options)
    for c in changes:
        t.apply(c)
    t.vacuum()
    return t


def in_changes(baskets: DataFrame, n: int) -> list[DataFrame]:
    """The baskets shared out over `n` changes, each basket whole; all of them together are all rows."""
    part = F.pmod(F.xxhash64("basket"), F.lit(n))
    return [baskets.where(part == k) for k in range(n)]
