"""Keyed tables whose writes touch only the files that hold the keys.

The rows of a key are in one bucket (a hash of the key); within a bucket files are cut by the
order of the keys. Beside the least and greatest key of every file the table keeps Bloom bits
(``marks``): a key has one 64-bit number of its file's and a few bits in it. A written key meets
the files of its bucket whose range it is in, then their bits by an equality join, and only files
that pass both are opened.

``upsert`` and ``update`` write those files anew without the replaced rows. ``insert`` adds files
and changes none. ``merge`` adds the new rows as files with a later number, too, and notes which
older files they hide keys of; readers leave the hidden rows out (merge on read), and ``compact``
writes that down for good. Only files that something hides take part in that join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linecheck.operators.keyed import KeyConflict, demand_keys
from linecheck.operators.lookup import unused
from linecheck.operators.measured import small_side, written
from linecheck.sources.versions import ADD, HIDE, REMOVE, VersionedTable

BUCKET = "linecheck_bucket"

# Bits of a key in its file's number, and rows of a file per number.
BITS = 4
ROWS_PER_WORD = 6

# Rows of a file, if the table does not say.
FILE_ROWS = 1_000_000


class KeyedFiles:
    """A keyed table by its folder; see the module."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = VersionedTable(spark, root)

    # What the table is.

    @classmethod
    def create(
        cls, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int = 1, file_rows: int = FILE_ROWS
    ) -> KeyedFiles:
        """Make an empty table; ``buckets`` bounds how many files a key is looked up in."""
        unknown = [key for key in keys if key not in schema.names]
        if unknown or not keys:
            raise ValueError(f"keys must be columns of the table: {unknown or 'none given'}")
        if buckets < 1 or file_rows < 1:
            raise ValueError("a table has one bucket, and a file one row, at least")
        made = cls(spark, root)
        made.table.create(schema, keys, keys=list(keys), buckets=buckets, file_rows=file_rows)
        return made

    def _known(self) -> dict:
        return self.table.properties()

    def _bucket(self, known: dict) -> Column:
        return F.pmod(F.xxhash64(*known["keys"]), F.lit(known["buckets"])).cast("int")

    def _word(self, known: dict) -> Column:
        words = max(1, known["file_rows"] // ROWS_PER_WORD)
        return F.pmod(F.xxhash64(F.lit(1), *known["keys"]), F.lit(words))

    def _mask(self, known: dict) -> Column:
        h = F.xxhash64(F.lit(2), *known["keys"])
        places = [F.shiftright(h, 8 * turn).bitwiseAND(F.lit(63)).cast("int") for turn in range(BITS)]
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
        return reduce(lambda a, b: a.bitwiseOR(b), bits)

    # Files that may hold keys.

    def _arranged(self, known: dict):
        def arrange(rows: DataFrame) -> DataFrame:
            rows = rows.withColumn(BUCKET, self._bucket(known))
            return rows.repartition(BUCKET).sortWithinPartitions(BUCKET, *known["keys"])

        return arrange

    def _store(self, rows: DataFrame, known: dict) -> DataFrame:
        """Write files with their marks; returns their index rows."""
        name = self.table.write(rows, self._arranged(known), known["file_rows"], [BUCKET])
        schema = self.table.schema(known)
        keys = self.table.read_files([name], schema).select(self.table._path().alias("path"), *known["keys"])
        marks = keys.groupBy("path", self._word(known).alias("word")).agg(F.bit_or(self._mask(known)).alias("bits"))
        marks.write.parquet(f"{self.table.root}/marks/{name}")
        return written(self.table.described(name, known), "keyed-index")

    def _marks(self, paths: Sequence[str]) -> DataFrame:
        schema = "path string, word long, bits long"
        names = sorted({path.split("/")[0] for path in paths})
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.table.root}/marks/{name}" for name in names])

    def _places(self, delta: DataFrame, files: DataFrame, known: dict) -> DataFrame:
        """The keys of ``delta`` with the files that hold them: ``path`` and the keys.

        ``files`` are live index rows. Range and marks choose the files that are opened.
        """
        keys = known["keys"]
        adds = files.where(F.col("action") == ADD)
        bucket = F.regexp_extract("path", f"/{BUCKET}=(\\d+)/", 1).cast("int")
        adds = adds.select("path", bucket.alias(BUCKET), "least", "greatest")
        asked = delta.select(*keys, self._bucket(known).alias(BUCKET), self._word(known).alias("word"), self._mask(known).alias("mask"))
        inside = [F.col(f"`{k}`").between(F.col(f"least.`{k}`"), F.col(f"greatest.`{k}`")) for k in keys]
        met = asked.join(small_side(adds), BUCKET).where(reduce(lambda a, b: a & b, inside))
        met = written(met.select("path", "word", "mask", *keys), "keyed-ranges")
        in_range = [row.path for row in met.select("path").distinct().collect()]
        marks = self._marks(in_range)
        met = met.join(marks, ["path", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select("path", *keys)
        met = written(met, "keyed-candidates")
        open_ = [row.path for row in met.select("path").distinct().collect()]
        rows = self.table.read_files(open_, self.table.schema(known)).select(self.table._path().alias("path"), *keys)
        return written(rows.join(met, ["path", *keys], "left_semi"), "keyed-places")

    # Reading.

    def _visible(self, paths: Sequence[str], files: DataFrame, known: dict) -> DataFrame:
        """Rows of files that no later file hides, with their ``path``."""
        keys, schema = known["keys"], self.table.schema(known)
        pairs = files.where(F.col("action") == HIDE).select("path", "by")
        pairs = [(row.path, row.by) for row in pairs.collect()]
        wanted = set(paths)
        covered = sorted({path for path, _ in pairs} & wanted)
        plain = self.table.read_files(sorted(wanted - set(covered)), schema).select(self.table._path().alias(BUCKET), *schema.names)
        if not covered:
            return plain
        hiders = sorted({by for path, by in pairs if path in wanted})
        newer = self.table.read_files(hiders, schema).select(self.table._path().alias("by"), *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
        which = self.spark.createDataFrame([pair for pair in pairs if pair[0] in wanted], "path string, by string")
        hidden = newer.join(small_side(which), "by").select("path", *[f"k{i}" for i in range(len(keys))])
        rows = self.table.read_files(covered, schema).select(self.table._path().alias(BUCKET), *schema.names)
        same = [F.col(BUCKET) == F.col("path"), *[F.col(f"`{k}`") == F.col(f"k{i}") for i, k in enumerate(keys)]]
        left = rows.join(hidden.toDF("path", *[f"k{i}" for i in range(len(keys))]), reduce(lambda a, b: a & b, same), "left_anti")
        return plain.unionByName(left)

    def paths(self, version: int | None = None) -> list[str]:
        """Files of a version."""
        return self.table.chosen(upto=version)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest if none is named."""
        known = self._known()
        files = self.table.files(version)
        return self._visible(self.paths(version), files, known).select(*self.table.schema(known).names)

    # Writing.

    def _demand(self, rows: DataFrame, known: dict, partly: bool = False) -> DataFrame:
        keys, schema = known["keys"], self.table.schema(known)
        unknown = [c for c in rows.columns if c not in schema.names]
        if unknown:
            raise KeyConflict(f"the table has no column {', '.join(unknown)}")
        absent = [c for c in (keys if partly else schema.names) if c not in rows.columns]
        if absent:
            raise KeyConflict(f"rows to write lack {', '.join(absent)}")
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema if f.name in rows.columns])
        rows = written(rows, "keyed-rows")
        demand_keys(rows, keys, "rows to write")
        counts = rows.groupBy(*keys).agg(F.count("*").alias(unused(keys, "n_rows")))
        if not counts.where(F.col(counts.columns[-1]) > 1).isEmpty():
            raise KeyConflict(f"rows to write repeat a key in {', '.join(keys)}")
        return rows

    def _commit(self, make, run: str | None) -> int:
        def index(seen: int):
            files = written(self.table.files(seen), "keyed-files")
            made = make(files)
            return None if made is None else [self.table.note(made, self._known())]

        return self.table.commit(index, run)

    def insert(self, rows: DataFrame, run: str | None = None) -> int:
        """Add rows in files of their own; a key that is already there is an error."""
        known = self._known()
        rows = self._demand(rows, known)
        stored = self._store(rows, known)

        def make(files: DataFrame) -> DataFrame:
            if not self._places(rows, files, known).isEmpty():
                raise KeyConflict("a key to insert exists already")
            return stored

        return self._commit(make, run)

    def merge(self, rows: DataFrame, run: str | None = None) -> int:
        """Add rows in files of their own that hide older rows of the same keys."""
        known = self._known()
        rows = self._demand(rows, known)
        stored = self._store(rows, known)

        def make(files: DataFrame) -> DataFrame:
            bucket = F.regexp_extract("path", f"/{BUCKET}=(\\d+)/", 1)
            older = self._places(rows, files, known).select("path").distinct().withColumn(BUCKET, bucket)
            newer = stored.select(F.col("path").alias("by"), bucket.alias(BUCKET))
            hides = older.join(newer, BUCKET).select("path", F.lit(HIDE).alias("action"), "by")
            return stored.unionByName(hides, allowMissingColumns=True)

        return self._commit(make, run)

    def _replaced(self, files: DataFrame, paths: Sequence[str], rows: DataFrame, known: dict) -> DataFrame:
        """Index rows that put new files with ``rows`` in the place of others."""
        stored = self._store(rows, known)
        gone = self.spark.createDataFrame([(path,) for path in paths], "path string").withColumn("action", F.lit(REMOVE))
        # What a replaced file hid, the new files of its bucket hide.
        bucket = F.regexp_extract("by", f"/{BUCKET}=(\\d+)/", 1)
        hid = files.where(F.col("action") == HIDE).select("path", "by").join(gone.select("path"), "path", "left_anti")
        hid = hid.join(gone.select(F.col("path").alias("by")), "by", "left_semi").select("path", bucket.alias(BUCKET)).distinct()
        newer = stored.select(F.col("path").alias("by"), F.regexp_extract("path", f"/{BUCKET}=(\\d+)/", 1).alias(BUCKET))
        hides = hid.join(newer, BUCKET).select("path", F.lit(HIDE).alias("action"), "by")
        return stored.unionByName(gone, allowMissingColumns=True).unionByName(hides, allowMissingColumns=True)

    def upsert(self, rows: DataFrame, run: str | None = None) -> int:
        """Add rows, replacing those with the same key; only the files that hold such rows are written anew."""
        known = self._known()
        rows = self._demand(rows, known)

        def make(files: DataFrame) -> DataFrame:
            paths = [row.path for row in self._places(rows, files, known).select("path").distinct().collect()]
            kept = self._visible(paths, files, known).drop(BUCKET)
            kept = kept.join(rows.select(*known["keys"]), known["keys"], "left_anti")
            return self._replaced(files, paths, kept.unionByName(rows), known)

        return self._commit(make, run)

    def update(self, rows: DataFrame, run: str | None = None) -> int:
        """Take over the columns that ``rows`` has; a key that is not there is an error.

        Only the files that hold the keys are written anew.
        """
        known = self._known()
        keys, names = known["keys"], self.table.schema(known).names
        rows = self._demand(rows, known, partly=True)
        changed = [c for c in rows.columns if c not in keys]

        def make(files: DataFrame) -> DataFrame | None:
            places = self._places(rows, files, known)
            if not rows.join(places.select(*keys), keys, "left_anti").isEmpty():
                raise KeyConflict("a key to update does not exist")
            if not changed:
                return None
            paths = [row.path for row in places.select("path").distinct().collect()]
            new = unused(names, "new")
            values = rows.select(*keys, F.struct(*changed).alias(new))
            old = self._visible(paths, files, known).drop(BUCKET).join(values, keys, "left")
            took = F.col(new).isNotNull()
            merged = [F.when(took, F.col(f"{new}.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) if c in changed else F.col(f"`{c}`") for c in names]
            return self._replaced(files, paths, old.select(*merged), known)

        return self._commit(make, run)

    def compact(self, least: int | None = None, run: str | None = None) -> int:
        """Write anew files that are hidden in part, those that hide them, and small files of a bucket.

        Small are files under ``least`` rows (half of a file's) beside other such files. All others
        stay. Readers of older versions are not disturbed, as no file is deleted.
        """
        known = self._known()
        least = known["file_rows"] // 2 if least is None else least

        def make(files: DataFrame) -> DataFrame | None:
            bucket = F.regexp_extract("path", f"/{BUCKET}=(\\d+)/", 1)
            adds = files.where(F.col("action") == ADD).select("path", "rows", bucket.alias("bucket"))
            hides = files.where(F.col("action") == HIDE)
            small = adds.where(F.col("rows") < least)
            several = small.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
            chosen = small.join(several, "bucket", "left_semi").select("path").union(hides.select("path")).union(hides.select("by"))
            paths = [row.path for row in chosen.distinct().collect()]
            if not paths:
                return None
            return self._replaced(files, paths, self._visible(paths, files, known).drop(BUCKET), known)

        return self._commit(make, run)
