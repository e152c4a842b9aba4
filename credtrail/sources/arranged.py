"""Reconciliation inputs kept arranged by their join key, so that a repeated run joins without a shuffle.

``arrange`` writes both sides once as bucketed Parquet tables, dealt and sorted by the normalised key
(supplier, invoice number). A later full outer join of the two reads bucket n of one side with
bucket n of the other: there is no exchange under it. The key columns of the tables are texts
that are never NULL (a NULL has a text of its own), because Spark only uses buckets for plain equality.

Keys that ``hot_keys_of`` finds would fill one bucket; their rows are written apart, unbucketed, and are
joined through the grid of ``operators.joins``. ``append`` deals new rows to the same buckets (or
to the hot part) and arranges anew if a key has become hot meanwhile.

What goes to disk: the plain rows go through the shuffle and get their key texts behind it; a key column
that is text is not stored beside its key text, which tells it; buckets are small enough to be sorted in memory.

The folder has everything: ``ArrangedInputs.open`` registers its tables in a new session.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credtrail.functions import scalars as S
from credtrail.operators.joins import BROADCAST_KEYS, IN_LEFT, IN_RIGHT, full_outer_join, hot_keys_of
from credtrail.operators.reconcile import JOIN_KEYS, LEFT_SUFFIX, RIGHT_SUFFIX, classify, suffixed
from credtrail.session import COMPRESSION, shuffles_freed

KEY1, KEY2, KEY_HASH = "_key_supplier", "_key_number", "_key_hash"
KEY_TEXTS = dict(zip(JOIN_KEYS, (KEY1, KEY2), strict=True))
ROWS_PER_BUCKET = 2_000_000
BYTES_PER_BUCKET = 128 << 20  # of rows in memory, which a task sorts
SIDES = ("register", "filings")


def never_null(c: Column) -> Column:
    """A text that tells NULL from every value."""
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), c.cast("string")))


def told(key_text: str) -> Column:
    """The text column that ``never_null`` made ``key_text`` from, byte by byte."""
    return F.when(F.col(key_text) != "-", F.substring(F.col(key_text).cast("binary"), 2, 2**31 - 1).cast("string"))


def _normalised(df: DataFrame) -> DataFrame:
    return df.withColumn("invoice_number", S.normalize_invoice_number("invoice_number"))


def _keyed(df: DataFrame) -> DataFrame:
    """Rows with the two key texts."""
    return df.withColumns({text: never_null(F.col(key)) for key, text in KEY_TEXTS.items()})


_BYTES, _LONG, _SIZES = "_text_bytes", "_long_texts", "_text_sizes"
_BITS, _PER_WORD = 9, 7                            # a text's size takes 9 bits, a word has the sizes of 7 texts
_IS_LONG, _IS_NULL = (1 << _BITS) - 2, (1 << _BITS) - 1


def packed(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """(``df`` with all text columns in one: a leaner row for a shuffle, names of those columns).

    Their bytes stand one after another, with the sizes in words of their own. Rows with a text of more than
    509 bytes also have all their texts in an array. ``texts_of`` is the way back."""
    texts = [c for c in df.columns if df.schema[c].dataType == T.StringType()]
    sizes = {c: F.coalesce(F.least(F.octet_length(c), F.lit(_IS_LONG)), F.lit(_IS_NULL)).cast("bigint") for c in texts}
    own = {c: F.when(sizes[c] < _IS_LONG, F.col(c)).otherwise(F.lit("")).cast("binary") for c in texts}
    words = [sum((F.shiftleft(sizes[c], _BITS * i) for i, c in enumerate(texts[at:at + _PER_WORD])), F.lit(0).cast("bigint"))
             .alias(f"{_SIZES}{at // _PER_WORD}") for at in range(0, len(texts), _PER_WORD)]
    any_long = F.greatest(*[F.coalesce(F.octet_length(c), F.lit(0)) for c in texts], F.lit(0), F.lit(0)) >= _IS_LONG
    others = sorted((c for c in df.columns if c not in texts), key=lambda c: df.schema[c].dataType.simpleString())
    return df.select(*others, *words, F.when(any_long, F.array(*texts)).alias(_LONG),
                     F.concat(F.lit(b""), *own.values()).alias(_BYTES)), texts


def texts_of(texts: list[str]) -> dict[str, Column]:
    """The text columns again, from the columns of ``packed``."""
    size = [F.shiftright(f"{_SIZES}{i // _PER_WORD}", _BITS * (i % _PER_WORD)).bitwiseAND(_IS_NULL).cast("int") for i in range(len(texts))]
    at, out = F.lit(1), {}
    for i, c in enumerate(texts):
        out[c] = F.when(size[i] < _IS_LONG, F.substring(F.col(_BYTES), at, size[i]).cast("string")) \
            .when(size[i] == _IS_LONG, F.col(_LONG)[i])
        at = at + F.when(size[i] < _IS_LONG, size[i]).otherwise(0)
    return out


def _buckets(pr: DataFrame, g2b: DataFrame) -> int:
    """As many as a bucket of either side fits its bounds of rows and bytes, by the planner's width of a row."""
    def of(df: DataFrame) -> int:
        rows, width = df.count(), _keyed(df)._jdf.schema().defaultSize()
        return max(-(-rows // ROWS_PER_BUCKET), -(-rows * width // BYTES_PER_BUCKET))

    most = int(pr.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(max(8, of(pr), of(g2b)), most)


class ArrangedInputs:
    """The two arranged sides in ``root``; see the module docstring."""

    def __init__(self, spark: SparkSession, root: str, buckets: int, options: dict):
        self.spark, self.root, self.buckets, self.options = spark, root.rstrip("/"), buckets, options

    # -- tables ---------------------------------------------------------------
    def name(self, side: str) -> str:
        return f"arranged_{hashlib.md5(self.root.encode()).hexdigest()[:16]}_{side}"

    def _save(self, df: DataFrame, side: str, mode: str, columns: list[str] | None = None) -> None:
        """One file a bucket: the rows are dealt by the hash that bucketing uses. ``columns`` as an earlier
        write stored them."""
        lean, texts = packed(df)
        again = texts_of(texts)
        dealt = lean.repartition(self.buckets, *[never_null(again.get(k, F.col(k))) for k in JOIN_KEYS])
        dealt = dealt.select(*[again.get(c, F.col(c)).alias(c) for c in df.columns])
        if columns is None:
            told_by_text = {k for k in JOIN_KEYS if df.schema[k].dataType == T.StringType()}
            columns = [*(c for c in df.columns if c not in told_by_text), KEY1, KEY2]
        with shuffles_freed(self.spark):
            (_keyed(dealt).select(*columns).write.mode(mode).format("parquet")
             .option("path", f"{self.root}/{side}").option("compression", COMPRESSION).bucketBy(self.buckets, KEY1, KEY2).sortBy(KEY1, KEY2)
             .saveAsTable(self.name(side)))

    def cold(self, side: str) -> DataFrame:
        stored = self.spark.table(self.name(side))
        return stored.withColumns({k: told(text) for k, text in KEY_TEXTS.items() if k not in stored.columns})

    def hot(self, side: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{side}-hot")

    def hot_keys(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/hot-keys")

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> ArrangedInputs:
        """The arranged inputs that an earlier session wrote."""
        about = json.loads(spark.read.text(f"{root.rstrip('/')}/about").first()[0])
        out = cls(spark, root, about["buckets"], about["options"])
        for side in SIDES:
            if not spark.catalog.tableExists(out.name(side)):
                columns = spark.read.parquet(f"{out.root}/{side}").schema.toDDL()
                spark.sql(f"CREATE TABLE {out.name(side)} ({columns}) USING parquet CLUSTERED BY ({KEY1}, {KEY2}) "
                          f"SORTED BY ({KEY1}, {KEY2}) INTO {out.buckets} BUCKETS LOCATION '{out.root}/{side}'")
        return out

    # -- writing --------------------------------------------------------------
    def _split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows of ordinary keys, rows of hot keys with their key texts)."""
        rows, hot = _normalised(df), self.hot_keys().select(KEY_HASH)
        keys = hot.count()
        if not keys:
            return rows, _keyed(rows.limit(0))
        if keys <= BROADCAST_KEYS:
            hot = F.broadcast(hot)
        hashed = rows.withColumn(KEY_HASH, F.xxhash64(*JOIN_KEYS))
        return (hashed.join(hot, KEY_HASH, "left_anti").drop(KEY_HASH),
                _keyed(hashed.join(hot, KEY_HASH, "left_semi").drop(KEY_HASH)))

    def append(self, pr: DataFrame | None = None, g2b: DataFrame | None = None) -> ArrangedInputs:
        """More rows for either side; returns the inputs to use from now on."""
        for side, more in zip(SIDES, (pr, g2b), strict=True):
            if more is not None:
                cold, hot = self._split(more)
                self._save(cold, side, "append", self.spark.table(self.name(side)).columns)
                hot.select(*self.hot(side).columns).write.mode("append").parquet(f"{self.root}/{side}-hot")
                self.spark.catalog.refreshTable(self.name(side))
        left, right = (self.cold(s).select(*JOIN_KEYS) for s in SIDES)
        if hot_keys_of(left, right, JOIN_KEYS, **self.options).isEmpty():
            return self
        whole = [self.cold(s).drop(KEY1, KEY2).unionByName(self.hot(s).drop(KEY1, KEY2)) for s in SIDES]
        return arrange(*whole, f"{self.root}/rearranged", buckets=self.buckets, **self.options)

    # -- reading --------------------------------------------------------------
    def merged(self) -> DataFrame:
        """What ``reconcile.merge_invoices`` returns for the two inputs."""
        shared = (set(self.cold(SIDES[0]).columns) & set(self.cold(SIDES[1]).columns)) - {*JOIN_KEYS, KEY1, KEY2}
        left = suffixed(self.cold(SIDES[0]), LEFT_SUFFIX, shared).withColumn(IN_LEFT, F.lit(True))
        right = suffixed(self.cold(SIDES[1]), RIGHT_SUFFIX, shared).withColumn(IN_RIGHT, F.lit(True))
        both = left.join(right, (left[KEY1] == right[KEY1]) & (left[KEY2] == right[KEY2]), "full")
        own = [c for c in (*left.columns, *right.columns) if c not in (*JOIN_KEYS, KEY1, KEY2, IN_LEFT, IN_RIGHT)]
        cold = both.select(*[F.coalesce(left[k], right[k]).alias(k) for k in JOIN_KEYS], *own,
                           F.coalesce(F.col(IN_LEFT), F.lit(False)).alias(IN_LEFT),
                           F.coalesce(F.col(IN_RIGHT), F.lit(False)).alias(IN_RIGHT))
        if self.hot_keys().isEmpty():
            return cold
        l_hot, r_hot = (suffixed(self.hot(s).drop(KEY1, KEY2), x, shared) for s, x in zip(SIDES, (LEFT_SUFFIX, RIGHT_SUFFIX), strict=True))
        return cold.unionByName(full_outer_join(l_hot, r_hot, JOIN_KEYS, hot_keys=self.hot_keys()))

    def detail(self, **rules) -> DataFrame:
        """What ``reconcile.reconcile_detail`` returns for the two inputs."""
        return classify(self.merged(), **rules)


def arrange(pr: DataFrame, g2b: DataFrame, root: str, *, buckets: int | None = None, **options) -> ArrangedInputs:
    """Write both sides arranged under ``root``. ``options`` go to ``hot_keys_of``."""
    spark = pr.sparkSession
    if buckets is None:
        buckets = _buckets(pr, g2b)
    out = ArrangedInputs(spark, root, buckets, options)
    keys = [df.select(JOIN_KEYS[0], S.normalize_invoice_number("invoice_number").alias(JOIN_KEYS[1])) for df in (pr, g2b)]
    hot_keys_of(*keys, JOIN_KEYS, **options).write.mode("overwrite").parquet(f"{out.root}/hot-keys")
    for side, df in zip(SIDES, (pr, g2b), strict=True):
        cold, hot = out._split(df)
        out._save(cold, side, "overwrite")
        hot.write.mode("overwrite").parquet(f"{out.root}/{side}-hot")
    spark.createDataFrame([(json.dumps({"buckets": buckets, "options": options}),)], "about string") \
        .coalesce(1).write.mode("overwrite").text(f"{out.root}/about")
    return out
