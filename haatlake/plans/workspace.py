"""Raw input -> cleaned dataset -> warehouse, built once per session and folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators.cleaning import clean_all, clean_groups, clean_rows, enrich_from_catalog
from ..operators.quality import REPORT, write_report
from ..sources.files import is_complete, load_raw_data, read_clean, write_clean
from ..sources.sample_sales import catalog_raw, sales_raw
from ..sources.staging import Scratch, in_parts, materialise, new_path
from ..sources.warehouse import Warehouse
from .session import tune
from .views import Star


class Workspace:
    """Each step is written when first asked for, then scanned.

    With an out_dir the cleaned dataset, the warehouse and the report lie there under those
    names, and a later workspace opens what is complete. Without, they go to the shared folder.
    """

    def __init__(self, spark: SparkSession, raw: DataFrame, catalog: DataFrame, out_dir: str | None = None):
        self.spark = tune(spark, raw)
        self._raw, self.catalog, self.out_dir = raw, catalog, out_dir and out_dir.rstrip("/")
        self._anew: set[str] = set()

    def _path(self, name: str) -> str:
        return f"{self.out_dir}/{name}" if self.out_dir else new_path(self.spark, name)

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str) -> Workspace:
        return cls(spark, sales_raw(spark, sf_dir), catalog_raw(spark, sf_dir))

    @classmethod
    def from_files(cls, spark: SparkSession, raw_dir: str, out_dir: str | None = None, **options) -> Workspace:
        tx, catalog, _ = load_raw_data(spark, raw_dir, **options)
        return cls(spark, tx, catalog, out_dir)

    @cached_property
    def raw(self) -> DataFrame:
        return materialise(self._raw, "raw")

    def raw_once(self) -> DataFrame:
        """Raw rows for who reads them, or some of their columns, in one pass: what is staged, else straight from the input."""
        return self.raw if "raw" in vars(self) else self._raw

    @cached_property
    def cleaned(self) -> DataFrame:
        path = self._path("cleaned")
        if self.out_dir and "cleaned" not in self._anew and is_complete(self.spark, path):
            return read_clean(self.spark, path)
        with Scratch(self.spark) as stage:
            rows, parts = in_parts(stage(clean_rows(self.raw_once())))
            enriched = enrich_from_catalog(clean_groups(rows, stage), self.catalog, stage=stage if parts > 1 else None)
            write_clean(enriched, path, counted=rows, parts=parts)
        return read_clean(self.spark, path)

    @cached_property
    def warehouse(self) -> Warehouse:
        path = self._path("warehouse")
        warehouse = Warehouse(self.spark, path)
        if not warehouse.version or "warehouse" in self._anew:
            warehouse.load(self.cleaned)
        return warehouse

    def rebuild(self, names: tuple[str, ...]) -> None:
        """Build the named results ("cleaned", "warehouse") from the raw input when next asked for, whatever is there."""
        self._anew |= set(names)
        for name in names:
            vars(self).pop(name, None)

    def append(self, raw: DataFrame) -> DataFrame:
        """Clean further raw rows and add them to the warehouse, as a joint load would; returns its row counts.

        The cleaned dataset keeps only the rows it was built of; the warehouse has all.
        """
        with Scratch(self.spark) as stage:
            cleaned = stage(enrich_from_catalog(clean_all(raw, stage), self.catalog))
            return self.warehouse.load(cleaned, truncate=False)

    def report(self) -> DataFrame:
        """The quality report before and after cleaning, and what the last load couldn't store, written as JSON lines and read again."""
        path = self._path("report")
        write_report(self.raw, self.cleaned.drop("order_year_dt"), path, more=self.warehouse.load_report())
        return self.spark.read.schema(REPORT).json(path)

    def star(self, years: tuple[int, int] | None = None) -> Star:
        return Star.of(self.warehouse, years)


_WORKSPACES: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WORKSPACES:
        _WORKSPACES[key] = Workspace.from_tables(spark, sf_dir)
    return _WORKSPACES[key]
