"""Table catalog: the driver's tables, the derived inputs and the stage outputs.

Like the reference's table store, stages hand over through written tables:
the derived input tables and each stage's output are computed once per
session, when they are first asked for, and written as Parquet under the shared checkpoint folder; every
later read is a plain (pruned, filter-pushed) Parquet scan with no lineage
back to the computation.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credtrail.session import COMPRESSION, scratch_path, shuffles_freed, temporary_snapshots, write_snapshot
from credtrail.sources import arranged, testdata
from credtrail.sources.schemas import cast_to_schema
from credtrail.sources.versions import Folder

DEFAULT_AS_OF = dt.date(2001, 11, 15)
INPUT_TABLES = ("vendor_master", "purchase_register", "gstr2b_data", "vendor_filing_compliance")
RAW_TABLES = ("supplier", "nation", "lineitem")
LINES_PER_PART = 500_000     # order lines that a task sums in memory
STAGE_TABLES = ("invoice_reconciliation_results", "itc_leakage_summary", "vendor_risk_scores")

_lock = threading.RLock()
_written: dict[tuple, str] = {}


class Catalog:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of=DEFAULT_AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.as_of = as_of
        self._stamp: tuple | None = None

    def stamp(self) -> tuple:
        """Names, sizes and times of the raw files, so that tables derived from files that were
        written anew are derived anew."""
        if self._stamp is None:
            found = []
            for name in RAW_TABLES:
                folder = Folder(self.spark, f"{self.sf_dir}/{name}.parquet")
                found += [(name, s.getPath().getName(), s.getLen(), s.getModificationTime())
                          for s in folder.fs.listStatus(folder._path(folder.path))]
            self._stamp = tuple(sorted(found))
        return self._stamp

    # -- driver tables ------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- written tables -----------------------------------------------------
    def _key(self, name: str) -> tuple:
        app = self.spark.sparkContext.applicationId
        as_of = self.as_of if name in STAGE_TABLES else None
        return (app, self.sf_dir, name, str(as_of), self.stamp())

    def _write(self, name: str, df: DataFrame, path: str | None = None) -> str:
        path = path or scratch_path(self.spark, name)
        cast_to_schema(df, name).write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        return path

    def _materialize_inputs(self) -> None:
        supplier, nation, lineitem = self.raw("supplier"), self.raw("nation"), self.raw("lineitem")
        paths = {name: scratch_path(self.spark, name) for name in INPUT_TABLES}
        # the invoice base feeds three tables: what it follows from is written once to the checkpoint folder,
        # and deleted with the shuffles when the tables are written
        with temporary_snapshots(self.spark), shuffles_freed(self.spark):
            parts = max(8, -(-lineitem.count() // LINES_PER_PART))
            base = testdata.invoice_columns(write_snapshot(testdata.invoice_sums(lineitem, supplier, nation, parts), "invoice-base"))
            frames = {
                "vendor_master": testdata.vendor_master(supplier, nation),
                "purchase_register": testdata.purchase_register(base),
                "gstr2b_data": testdata.gstr2b_data(base),
                "vendor_filing_compliance": testdata.vendor_filing_compliance(base),
            }
            for name in INPUT_TABLES:
                self._write(name, frames[name], paths[name])
        _written.update({self._key(name): path for name, path in paths.items()})

    def _materialize_stage(self, name: str) -> None:
        """One stage output; the reconciliation detail behind all of them is written once."""
        from credtrail.plans import pipeline
        pr = self.table("purchase_register")
        path = self._kept("reconciliation-detail", lambda p: pipeline.stage_detail(pr, self.table("gstr2b_data"))
                          .write.option("compression", COMPRESSION).parquet(p))
        detail = self.spark.read.parquet(path)
        output = pipeline.stage_output(name, detail, pr, self.table("vendor_master"), self.table("vendor_filing_compliance"),
                                       as_of=self.as_of)
        _written[self._key(name)] = self._write(name, output)

    def _kept(self, name: str, make) -> str:
        """The path of something that ``make(path)`` writes once per session."""
        with _lock:
            if self._key(name) not in _written:
                path = scratch_path(self.spark, name)
                make(path)
                _written[self._key(name)] = path
            return _written[self._key(name)]

    def by_period(self, name: str) -> str:
        """The path of a table written partitioned by tax period."""
        def make(path: str) -> None:
            salt = F.pmod(F.xxhash64(*self.table(name).columns), F.lit(8))
            self.table(name).repartition("tax_period", salt).write.partitionBy("tax_period").option("compression", COMPRESSION).parquet(path)
        return self._kept(f"{name}-by-period", make)

    def arranged_inputs(self) -> arranged.ArrangedInputs:
        """The purchase register and the filings, bucketed by the reconciliation key."""
        path = self._kept("arranged", lambda p: arranged.arrange(self.table("purchase_register"), self.table("gstr2b_data"), p))
        return arranged.ArrangedInputs.open(self.spark, path)

    def table(self, name: str) -> DataFrame:
        """A derived input table or a stage output, written once per session."""
        with _lock:
            if self._key(name) not in _written:
                if name in INPUT_TABLES:
                    self._materialize_inputs()
                elif name in STAGE_TABLES:
                    self._materialize_stage(name)
                else:
                    raise KeyError(name)
            path = _written[self._key(name)]
        return self.spark.read.parquet(path)
