"""Versioned tables: rows are written aside, checked there, and shown to readers by one new manifest.

A manifest lists, for every table, the folders that hold its rows. A run writes new folders that no manifest lists, so
readers see nothing of it; publishing adds one manifest, which lists them in place of those they replace. A run that fails
or is killed leaves folders that nobody reads, and ``vacuum`` removes them.
"""

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapework.session import stage_table

#: Partition columns of every versioned table: the year, and the run that wrote the rows.
YEAR, LOT = "ano_parte", "lote"
#: Rows of one bucket that a single task may read; above, a table is read without its buckets.
MAX_BUCKET_ROWS = 50_000_000
ROWS_PER_BUCKET = 5_000_000
#: Most folders a year may have before a run folds them into one.
FOLD_AFTER = 32


@dataclass
class Part:
    """A folder with the rows that one run wrote for one year (0: a table without years)."""

    lot: str
    year: int
    rows: int
    first: int | None
    last: int | None
    buckets: dict


@dataclass
class Versioned:
    """A table of a manifest; ``count`` is its number of buckets by ``key``, None for none."""

    schema: str
    key: str | None = None
    count: int | None = None
    parts: list = field(default_factory=list)

    def largest_bucket(self):
        sizes = {}
        for part in self.parts:
            for bucket, rows in part.buckets.items():
                sizes[bucket] = sizes.get(bucket, 0) + rows
        return max(sizes.values(), default=0)


@dataclass
class Manifest:
    version: int = 0
    tables: dict = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def text(self):
        return json.dumps(self, default=vars, sort_keys=True)

    @staticmethod
    def of(text):
        got = json.loads(text)
        tables = {n: Versioned(t["schema"], t["key"], t["count"], [Part(**p) for p in t["parts"]]) for n, t in got["tables"].items()}
        return Manifest(got["version"], tables, got["notes"])


class Store:
    """Versioned tables under ``root``; ``layer`` is the database that holds their bucketed tables."""

    def __init__(self, spark, root, layer="marts", max_bucket_rows=MAX_BUCKET_ROWS):
        self.spark, self.root, self.layer, self.max_bucket_rows = spark, root.rstrip("/"), layer, max_bucket_rows

    # --- files -----------------------------------------------------------------------------------

    def _path(self, *names):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *names):
        path, files = self._path(*names)
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    def manifest(self):
        """The newest manifest; version 0 without tables before the first."""
        versions = [n for n in self._names("manifests") if re.fullmatch(r"\d+\.json", n)]
        if not versions:
            return Manifest()
        rows = self.spark.read.text(f"{self.root}/manifests/{max(versions)}", wholetext=True)
        return Manifest.of(rows.first()[0])

    def publish(self, manifest):
        """Show ``manifest`` to readers as the version after the one it was made from. One rename of a written file, which
        fails when another run has published in the meantime."""
        manifest.version += 1
        temporary, files = self._path("manifests", f".{uuid.uuid4().hex}")
        target, _ = self._path("manifests", f"{manifest.version:012d}.json")
        out = files.create(temporary, False)
        out.write(manifest.text().encode())
        out.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(temporary, target, options)
        return manifest

    def vacuum(self, keep=1):
        """Remove manifests but the last ``keep``, and the folders that none of these lists. Returns the folders removed.

        For times when no other run writes: a run in progress has folders that no manifest lists yet."""
        versions = sorted(n for n in self._names("manifests") if re.fullmatch(r"\d+\.json", n))
        held = [Manifest.of(self.spark.read.text(f"{self.root}/manifests/{n}", wholetext=True).first()[0]) for n in versions[-keep:]]
        listed = {(name, p.lot) for m in held for name, t in m.tables.items() for p in t.parts}
        gone = []
        for name in self._names():
            if name != "manifests":
                gone += [(name, lot) for folder in self._names(name) if (lot := folder.removeprefix(f"{LOT}=")) and (name, lot) not in listed]
        for name, lot in gone:
            path, files = self._path(name, f"{LOT}={lot}")
            files.delete(path, True)
        for name in versions[:-keep]:
            path, files = self._path("manifests", name)
            files.delete(path, True)
        return gone

    # --- tables ----------------------------------------------------------------------------------

    def write_aside(self, df, name, lot, table=None, day="tempo_id", key=None):
        """Write ``df`` as run ``lot`` of table ``name`` and return its parts; readers do not see them.

        Rows with a column ``day`` (YYYYMMDD) get a folder for each year. ``key`` names the column of the buckets; their number
        comes from the first write and stays.
        """
        dated = day in df.columns
        columns = [f for f in df.schema.fields if f.name not in (YEAR, LOT)]
        schema = T.StructType(columns)
        count = table.count if table else None
        rows = df.select(schema.names)
        if key and count is None:
            rows = stage_table(rows, name)  # counted before it is written in buckets
            count = max(1, -(-rows.count() // ROWS_PER_BUCKET))
        year = F.floor(F.col(day) / 10_000).cast("int") if dated else F.lit(0)
        rows = rows.withColumn(YEAR, year)
        writer = rows.hint("rebalance", *[F.col(c) for c in ([YEAR] + [key] * bool(key))]).write.partitionBy(YEAR)
        path = f"{self.root}/{name}/{LOT}={lot}"
        if key:
            aside = f"`{self.layer}`.`{name}_aside_{lot}`"
            writer.bucketBy(count, key).sortBy(key, day).option("path", path).saveAsTable(aside)
            self.spark.sql(f"DROP TABLE {aside}")  # its files stay
        else:
            writer.parquet(path)
        written = self.spark.read.schema(T.StructType([*columns, T.StructField(YEAR, T.IntegerType())])).parquet(path)
        bucket = F.pmod(F.hash(key), F.lit(count)) if key else F.lit(0)
        first, last = (F.min(day), F.max(day)) if dated else (F.lit(None).cast("int"), F.lit(None).cast("int"))
        # a row for every year and bucket of this run
        sizes = written.groupBy(YEAR, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), first.alias("first"), last.alias("last")).collect()
        parts = []
        for y in sorted({r[YEAR] for r in sizes}):
            own = [r for r in sizes if r[YEAR] == y]
            parts.append(Part(lot, y, sum(r["n"] for r in own), min((r["first"] for r in own), default=None) if dated else None,
                              max((r["last"] for r in own), default=None) if dated else None, {str(r["bucket"]): r["n"] for r in own} if key else {}))
        return Versioned(schema.json(), key, count, parts)

    def read(self, name, manifest=None, parts=None):
        """Table ``name`` as ``manifest`` (the newest) lists it, or only ``parts`` of it, with the partition column ``ano_parte`` where
        it has years."""
        table = (manifest or self.manifest()).tables[name]
        schema = T.StructType.fromJson(json.loads(table.schema))
        stored = T.StructType([*schema.fields, T.StructField(YEAR, T.IntegerType()), T.StructField(LOT, T.StringType())])
        listed = table.parts if parts is None else parts
        if listed:
            paths = [f"{self.root}/{name}/{LOT}={p.lot}/{YEAR}={p.year}" for p in listed]
            rows = self.spark.read.schema(stored).option("basePath", f"{self.root}/{name}").parquet(*paths)
        else:
            rows = self.spark.createDataFrame([], stored)
        return rows.drop(LOT) if any(p.year for p in table.parts) else rows.drop(LOT, YEAR)

    def table(self, name, manifest=None):
        """Table ``name`` for readers, from the catalog: partitions of other years are skipped, and joins and aggregations by
        the key of its buckets need no exchange.

        While a bucket holds more than ``max_bucket_rows`` rows, the table is known without its buckets: a scan that splits
        files freely keeps a hot key from landing in one task.
        """
        manifest = manifest or self.manifest()
        table = manifest.tables[name]
        schema = T.StructType.fromJson(json.loads(table.schema))
        target = f"`{self.layer}`.`{self._catalog_name(name, manifest)}`"
        if not self.spark.catalog.tableExists(target):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            split = bool(table.key) and table.largest_bucket() <= self.max_bucket_rows
            buckets = f"CLUSTERED BY (`{table.key}`) INTO {table.count} BUCKETS " if split else ""
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {target} ({columns}, `{YEAR}` int, `{LOT}` string) USING parquet "
                           f"PARTITIONED BY (`{YEAR}`, `{LOT}`) {buckets}LOCATION '{self.root}/{name}'")
            places = " ".join(f"PARTITION ({YEAR}={p.year}, {LOT}='{p.lot}') LOCATION '{self.root}/{name}/{LOT}={p.lot}/{YEAR}={p.year}'" for p in table.parts)
            if places:
                self.spark.sql(f"ALTER TABLE {target} ADD IF NOT EXISTS {places}")
        return self.spark.table(target).select(schema.names + [YEAR] * any(p.year for p in table.parts))

    def _catalog_name(self, name, manifest):
        return f"{name}_v{manifest.version}"

    def show(self, names, manifest=None):
        """Views ``layer.name`` of the newest version, for every session of the catalog; tables of versions before the last
        are forgotten, their files stay until ``vacuum``."""
        manifest = manifest or self.manifest()
        for name in names:
            columns = ", ".join(f"`{c}`" for c in self.table(name, manifest).columns)
            self.spark.sql(f"CREATE OR REPLACE VIEW `{self.layer}`.`{name}` AS SELECT {columns} FROM `{self.layer}`.`{self._catalog_name(name, manifest)}`")
        for found in self.spark.catalog.listTables(self.layer):
            old = re.fullmatch(r"(.+)_v(\d+)", found.name)
            if old and old[1] in names and int(old[2]) < manifest.version - 1:
                self.spark.sql(f"DROP TABLE IF EXISTS `{self.layer}`.`{found.name}`")


def overlapping(table, since):
    """Parts of ``table`` with rows on or after day key ``since``."""
    return [p for p in table.parts if p.last is None or p.last >= since]
