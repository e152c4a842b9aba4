"""Readers and writers: CSV inputs, date coercion, ordered multi-table load, sinks, models."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credtrail.sources import versions
from credtrail.sources.schemas import TABLES, cast_to_schema

INPUT_ORDER = ["vendor_master", "gstr2b_data", "purchase_register", "vendor_filing_compliance"]
# all seven tables, parents before children
LOAD_ORDER = [*INPUT_ORDER, "invoice_reconciliation_results", "itc_leakage_summary", "vendor_risk_scores"]
# Text layouts beyond ISO, tried in this order after the ISO forms; the slashed and
# dashed ones read the month first unless ``day_first``.
MONTH_FIRST = ("M/d/yyyy", "M-d-yyyy", "M.d.yyyy")
DAY_FIRST = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy")
OTHER_LAYOUTS = ("yyyy/M/d", "yyyy.M.d", "d MMM yyyy", "d-MMM-yyyy", "MMM d, yyyy", "MMM d yyyy",
                 "d MMMM yyyy", "MMMM d, yyyy", "MMM yyyy", "MMMM yyyy")


def coerce_dates(c, data_type: T.DataType | None = None, *, day_first: bool = False) -> F.Column:
    """A date from a date, a timestamp or text; unparseable text -> NULL.

    Timestamps are cast as they are. Text may be ISO (with or without a time, a fraction or a
    ``T``, months and days of one digit), ``yyyyMMdd``, or one of the layouts above; a time after
    the date is ignored. ``01/02/2023`` is 2 January, with ``day_first`` 1 February; a date that
    only makes sense in the other order is read in that order.
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    s = F.trim(col.cast("string"))
    day = F.regexp_replace(s, r"[T ]\d{1,2}:\d{2}.*$", "")
    order = (*DAY_FIRST, *MONTH_FIRST) if day_first else (*MONTH_FIRST, *DAY_FIRST)
    return F.coalesce(
        F.when(day.rlike(r"^\d{8}$"), F.try_to_date(day, "yyyyMMdd")),
        F.when(day.rlike(r"^\d{4}-\d{1,2}(-\d{1,2})?$|^\d{4}$"), day.try_cast("date")),
        *[F.when(day.rlike(r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{4}$"), F.try_to_date(day, f)) for f in order],
        *[F.try_to_date(day, f) for f in OTHER_LAYOUTS])


def date_columns(df: DataFrame) -> list[str]:
    """Columns to coerce: those whose lower-cased name contains 'date', unless dates already."""
    return [f.name for f in df.schema.fields
            if "date" in f.name.lower() and not isinstance(f.dataType, T.DateType)]


def coerce_date_columns(df: DataFrame, *, day_first: bool = False) -> DataFrame:
    """Every column whose lower-cased name contains 'date' becomes a DATE column."""
    return df.withColumns({c: coerce_dates(c, df.schema[c].dataType, day_first=day_first)
                           for c in date_columns(df)})


def lost_dates(df: DataFrame, *, day_first: bool = False) -> list[F.Column]:
    """For ``observe`` or ``agg`` over the raw frame: per date column, how many non-empty values
    become NULL."""
    out = []
    for c in date_columns(df):
        given = F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
        lost = given & coerce_dates(c, df.schema[c].dataType, day_first=day_first).isNull()
        out.append(F.count_if(lost).alias(c))
    return out


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with all columns as text, named by the header.

    A folder may hold several files; each must have the same header, as Spark binds columns by
    position (``enforceSchema=false`` makes a different header an error instead of a wrong column).
    """
    names = spark.read.option("header", True).csv(path).columns  # reads the first header only
    text = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    return spark.read.option("header", True).option("enforceSchema", False).schema(text).csv(path)


def read_csv(spark: SparkSession, path: str, table: str | None = None, *, day_first: bool = False) -> DataFrame:
    """Header CSV; with a declared table, columns are bound by name and cast to its schema
    (no schema inference pass)."""
    if table is None:
        return coerce_date_columns(spark.read.option("header", True)
                                   .option("inferSchema", True).csv(path), day_first=day_first)
    return cast_to_schema(coerce_date_columns(read_csv_text(spark, path), day_first=day_first), table)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """No rows, the declared schema: what stands in for a missing or unreadable table."""
    return spark.createDataFrame([], TABLES[table])


def load_tables(spark: SparkSession, input_dir: str, fmt: str = "parquet", names=LOAD_ORDER, *,
                day_first: bool = False, raw: dict | None = None) -> tuple[dict[str, DataFrame], dict]:
    """Parents first; a missing or unreadable table is reported and skipped.

    What can be found without reading the data is found here (no file, no readable footer or
    header); files are read when the table is used, see ``plans.pipeline.stage_inputs``. ``raw``
    receives each table before its dates are coerced.
    """
    tables, report = {}, {}
    for name in names:
        path = f"{input_dir.rstrip('/')}/{name}" + (".csv" if fmt == "csv" else "")
        if not _exists(spark, path):
            alt = path + ".parquet"
            if fmt == "parquet" and _exists(spark, alt):
                path = alt
            else:
                report[name] = {"status": "missing", "path": path}
                continue
        try:
            df = read_csv_text(spark, path) if fmt == "csv" else spark.read.parquet(path)
            tables[name] = cast_to_schema(coerce_date_columns(df, day_first=day_first), name)
            if raw is not None:
                raw[name] = df
            report[name] = {"status": "loaded", "path": path}
        except Exception as e:  # one bad table does not stop the others
            report[name] = {"status": "error", "path": path, "error": str(e)[:500]}
    return tables, report


def write_staged(raw: DataFrame, table: str, path: str, *, day_first: bool = False) -> dict:
    """Coerce, cast and write one input table; returns {"lost_dates": {column: count}}, counted
    while writing (no pass of its own). Columns named like dates of the schema are counted."""
    from pyspark.sql import Observation

    counts = lost_dates(raw, day_first=day_first)
    if counts:
        seen = Observation(f"lost dates of {table}")
        raw = raw.observe(seen, *counts)
    write_table(coerce_date_columns(raw, day_first=day_first), table, path)
    lost = {c: n for c, n in seen.get.items() if n} if counts else {}
    if lost:
        warnings.warn(f"{table}: values that are no dates became NULL: {lost}", stacklevel=2)
    return {"lost_dates": lost}


def write_table(df: DataFrame, table: str, path: str, partition_by=None, files_per_value: int = 8,
                versioned: bool = False) -> str:
    """Replace-contents sink: cast to the declared schema, write beside the old table, then take its place.

    A write that fails leaves the old table as it was, and the rows may be read from the table itself.
    ``versioned`` keeps numbered manifests that readers follow (``sources.versions``); without it the folder
    itself is swapped. With ``partition_by`` the rows are first dealt by those columns and a salt, so each
    value gets at most ``files_per_value`` files instead of one from every task.
    """
    out = cast_to_schema(df, table)
    if partition_by:
        salt = F.pmod(F.xxhash64(*out.columns), F.lit(files_per_value))
        out = out.repartition(*partition_by, salt)
    if versioned:
        versions.replace_version(out, path, partition_by)
    else:
        versions.swap_folder(out, path, partition_by)
    return path


SERIES_FORECAST = ("ds", "yhat", "yhat_lower", "yhat_upper")


def write_forecast_csv(fc: DataFrame, path: str) -> str:
    """Series columns, if any, then ds, yhat, yhat_lower, yhat_upper, with a header.

    One series is one file in the order of its dates; many series are written by as many tasks as they take."""
    series = [c for c in fc.columns if c not in SERIES_FORECAST]
    out = fc.select(*series, *SERIES_FORECAST)
    out = out if series else out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def save_model(model, path: str) -> str:
    """MLlib models use their own writer; the forests save their node tables."""
    from credtrail.operators.forest import ForestModel
    if isinstance(model, ForestModel):
        model.save(SparkSession.getActiveSession(), path)
        return path
    if hasattr(model, "write"):
        model.write().overwrite().save(path)
        return path
    from credtrail.operators.isoforest import IsolationForestModel
    if isinstance(model, IsolationForestModel):
        import json
        spark = SparkSession.getActiveSession()
        spark.createDataFrame(model.nodes).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = {"means": model.means, "stds": model.stds, "features": model.features,
                "sample_size": model.sample_size, "offset": model.offset}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite") \
            .text(f"{path}/meta")
        return path
    raise TypeError(type(model))


def load_model(path: str, kind: str = "pipeline"):
    """Load a saved model if the artefact exists, else None (the caller falls back)."""
    spark = SparkSession.getActiveSession()
    if not _exists(spark, path):
        return None
    if kind == "pipeline":
        from credtrail.operators.forest import ForestModel
        if _exists(spark, f"{path}/forest"):
            return ForestModel.load(spark, path)
        from pyspark.ml import PipelineModel
        return PipelineModel.load(path)
    import json

    from credtrail.operators.isoforest import IsolationForestModel
    nodes = spark.read.parquet(f"{path}/nodes").toPandas()
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return IsolationForestModel(nodes, meta["means"], meta["stds"], meta["features"],
                                meta["sample_size"], meta["offset"])
