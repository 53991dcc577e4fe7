"""The star schema as Parquet tables: load, append, scan, and SQL on top."""

from __future__ import annotations

import json
import logging
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import star
from ..operators.quality import PRIMARY_KEYS, REPORT
from .files import by_year
from .staging import CODEC, Scratch

log = logging.getLogger(__name__)

TABLES = ("dim_time", "dim_products", "dim_customers", "fact_transactions")
# What the dimensions were chosen by, so that an append can merge old and new rows.
STATES = ("state_products", "state_customers")
FACT, KEY = "fact_transactions", PRIMARY_KEYS["fact_transactions"]


class Warehouse:
    """Four tables under one folder, in versions; the fact is partitioned by order year.

    A load writes new folders beside the old ones, and then a manifest that names the folders of its
    version: `<path>/versions/<number>.json`. That one file is the switch. Whoever opened the
    warehouse before keeps reading the version it opened; a load that fails leaves no manifest and so
    no trace but folders, which `vacuum` removes. One writer at a time is assumed, a second one with the same
    number fails. Of the fact, a version has the folder of a load for each order year, so that an append
    writes only the years it touches.

    `misfits` has, after a load, the number of values of each fact column that its type can't hold and which
    are therefore NULL, in the rows that the load brought into the fact.
    """

    def __init__(self, spark: SparkSession, path: str, version: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self._scans: dict[str, DataFrame] = {}
        self.misfits: dict[str, int] = {}
        found = self.versions()
        self.version = version if version is not None else max(found, default=0)
        self._manifest = self._read(self.version) if self.version else {}

    # --- versions ------------------------------------------------------------

    def _hadoop(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        """Numbers of the complete versions, ascending."""
        fs, folder = self._hadoop("versions")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit() and n.endswith(".json"))

    def _read(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/versions/{version}.json", wholetext=True).first()[0])

    def _publish(self, manifest: dict) -> None:
        """The switch to a new version: written aside, then renamed, which fails if the number is taken."""
        version = self.version + 1
        fs, aside = self._hadoop(f"versions/.{version}")
        out = fs.create(aside, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        final = self._hadoop(f"versions/{version}.json")[1]
        if fs.exists(final) or not fs.rename(aside, final):
            raise RuntimeError(f"version {version} of {self.path} was written by someone else")
        self.version, self._manifest = version, manifest
        self._scans.clear()

    def vacuum(self) -> int:
        """Remove what this version doesn't name; older versions can't be opened any more. Returns how many folders went."""
        live = {f"{name}/{folder}" for name, folder in self._manifest.items() if name != FACT}
        live |= {f"{FACT}/order_year={year}/load={load}" for year, load in self._manifest.get(FACT, {}).items()}
        gone = 0
        fs, _ = self._hadoop()
        for version in self.versions():
            if version != self.version:
                fs.delete(self._hadoop(f"versions/{version}.json")[1], False)
        for pattern in (*(f"{name}/*" for name in (*TABLES, *STATES) if name != FACT), f"{FACT}/order_year=*/load=*"):
            root = self._hadoop(pattern)[1]
            for status in fs.globStatus(root) or ():
                name = status.getPath().toString().rstrip("/")
                if not any(name.endswith(f"/{x}") for x in live) and not name.rsplit("/", 1)[-1].startswith("_"):
                    fs.delete(status.getPath(), True)
                    gone += 1
        return gone

    # --- loading -------------------------------------------------------------

    def load(self, cleaned: DataFrame, truncate: bool = True) -> DataFrame:
        """Build and write dimensions and fact as a new version; returns (table_name, row_count).

        truncate=False gives what a joint load of old and new rows would: dimensions are merged by what they
        were chosen by, and of a transaction with several rows the first one counts, whichever load brought it.
        Only the order years that gain or lose a row are written. A repeated load changes nothing.
        """
        keep = [c for c in star.PRODUCT_COLUMNS if c in star.with_synonyms(cleaned).columns]
        merge = not truncate and bool(self._manifest)
        # A folder of its own, whatever an earlier load that failed left behind.
        load, manifest = f"v{self.version + 1}-{uuid.uuid4().hex[:12]}", dict(self._manifest)
        if merge:
            keep = [c for c in star.PRODUCT_COLUMNS if c in keep or c in self.table("dim_products").columns]

        def write(name: str, df: DataFrame) -> DataFrame:
            manifest[name] = f"load={load}"
            df.write.parquet(f"{self.path}/{name}/load={load}")
            return self.spark.read.parquet(f"{self.path}/{name}/load={load}")

        def days() -> None:
            bounds = star.order_bounds(cleaned)
            if merge:
                old = self.table("dim_time").agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))
                bounds = bounds.unionByName(old).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            write("dim_time", star.build_dim_time(bounds))

        def products() -> None:
            state = star.product_state(cleaned)
            state = write("state_products", star.merged_products(state.unionByName(self._state("products"))) if merge else state)
            write("dim_products", star.dim_products_of(state).select(*keep))

        def customers() -> None:
            state = star.customer_state(cleaned)
            state = write("state_customers", star.merged_customers(state.unionByName(self._state("customers"))) if merge else state)
            write("dim_customers", star.dim_customers_of(state))

        # Four independent pieces of work: what one leaves idle another one uses.
        jobs = (days, products, customers, lambda: manifest.update({FACT: self._load_fact(cleaned, load, merge)}))
        with ThreadPoolExecutor(len(jobs)) as pool:
            running = [pool.submit(inheritable_thread_target(self.spark)(job)) for job in jobs]
        for done in running:
            done.result()
        self._publish(manifest)
        if self.misfits:
            log.warning("values that the fact's types can't hold are NULL: %s", self.misfits)
        return self.row_counts()

    def _load_fact(self, cleaned: DataFrame, load: str, merge: bool) -> dict[str, str]:
        """Write the order years that change and return the load of every year."""
        live = dict(self._manifest[FACT]) if merge else {}
        counts, seen = [n.alias(c) for c, n in star.misfits().items()], Observation()
        with Scratch(self.spark) as stage:
            fact = star.build_fact_transactions(cleaned, marked=True, stage=stage).withColumn("order_year", F.year("order_date"))
            present = star.order_years(cleaned)
            if merge:
                present = present.unionByName(self._fact(self._manifest[FACT]).select("order_year"))
                gained, fact, years = self._changed_years(stage(fact), stage)
                live = {y: n for y, n in live.items() if int(y) not in years}
                found = gained.agg(*counts).first().asDict()
            else:
                fact = fact.observe(seen, *counts)
            laid = by_year(fact.drop(star.MISFITS).withColumn("load", F.lit(load)), "order_year", present.where("order_year IS NOT NULL"), moved=merge)
            # By day and customer within a file: statistics of row groups and pages prune by either.
            laid.sortWithinPartitions("order_year", "load", "order_date", "customer_id").write.mode("append") \
                .option("compression", CODEC).partitionBy("order_year", "load").parquet(f"{self.path}/{FACT}")
        fs, written = self._hadoop(f"{FACT}/order_year=*/load={load}")
        names = sorted(s.getPath().getParent().getName() for s in fs.globStatus(written) or ())
        if not merge:
            found = seen.get if names else {}
        self.misfits = {c: n for c, n in found.items() if n}
        return live | {n.removeprefix("order_year="): load for n in names}

    def _changed_years(self, new: DataFrame, stage: Scratch) -> tuple[DataFrame, DataFrame, set[int]]:
        """Rows that are new or take another one's place; all rows, after the load, of the order years that change; these years."""
        old = self._fact(self._manifest[FACT]).withColumn(star.MISFITS, F.lit(0))
        names = list(star.FACT_COLUMNS)
        tie = F.xxhash64(*names)
        known = old.select(KEY, F.col("order_date").alias("_date"), tie.alias("_tie"), F.col("order_year").alias("_year"))
        comes_first = F.struct(F.col("order_date").alias("a"), tie.alias("b")) < F.struct(F.col("_date").alias("a"), F.col("_tie").alias("b"))
        gained = stage(new.join(known, KEY, "left").where(F.col("_date").isNull() | comes_first).select(*new.columns, "_year"))
        years = {y for r in gained.select("order_year", "_year").distinct().collect() for y in r if y is not None}  # some hundreds at most
        stay = old.where(F.col("order_year").isin(sorted(years))).join(gained.where("_year IS NOT NULL").select(KEY), KEY, "left_anti")
        return gained, gained.select(*new.columns).unionByName(stay.select(*new.columns)), years

    # --- reading -------------------------------------------------------------

    def _state(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/state_{name}/{self._manifest[f'state_{name}']}")

    def _fact(self, loads: dict[str, str]) -> DataFrame:
        root = f"{self.path}/{FACT}"
        if not loads:
            return self.spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in star.FACT_COLUMNS.items()) + ", order_year int")
        paths = [f"{root}/order_year={y}/load={n}" for y, n in loads.items()]
        return self.spark.read.option("basePath", root).parquet(*paths).drop("load")

    def table(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(f"unknown table {name}")
        if name not in self._scans:
            if not self._manifest:
                raise FileNotFoundError(f"nothing was loaded into {self.path}")
            self._scans[name] = (self._fact(self._manifest[FACT]) if name == FACT
                                 else self.spark.read.parquet(f"{self.path}/{name}/{self._manifest[name]}"))
        return self._scans[name]

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.table(t) for t in TABLES}

    def load_report(self) -> DataFrame:
        """Of the last load of this object: for each fact column the values that its type couldn't hold, as rows of a quality report."""
        rows = [("misfits", c, "values", str(n)) for c, n in sorted(self.misfits.items())]
        return self.spark.createDataFrame(rows, REPORT)

    def row_counts(self) -> DataFrame:
        counts = [
            self.table(t).agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(t).alias("table_name"), "row_count")
            for t in TABLES
        ]
        out = counts[0]
        for c in counts[1:]:
            out = out.unionByName(c)
        return out

    def register(self) -> None:
        """Expose the tables as temporary views under their own names."""
        for t in TABLES:
            self.table(t).createOrReplaceTempView(t)

    def sql(self, query: str, params: dict | None = None) -> DataFrame:
        """Ad-hoc SQL with bound parameters (:name). Errors propagate."""
        self.register()
        return self.spark.sql(query, args=params or {})

    def years(self) -> DataFrame:
        return self.table("dim_time").select("year").distinct().orderBy("year")

    def year_range(self) -> DataFrame:
        return self.table("dim_time").agg(
            F.min("year").alias("min_year"), F.max("year").alias("max_year")
        )


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict, truncate: bool = True,
    batchsize: int = 5000,
) -> bool:
    """Load one table into a database in batches, every partition on its own connection.

    An empty frame is skipped; returns whether anything was written.
    """
    if df.isEmpty():
        return False
    options = {**properties, "batchsize": str(batchsize), "truncate": str(truncate).lower()}
    df.write.jdbc(url, table, mode="overwrite" if truncate else "append", properties=options)
    return True
