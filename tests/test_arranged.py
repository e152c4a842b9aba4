"""J1 over inputs that are kept arranged by their key."""

import tempfile

import pytest
from pyspark.sql import functions as F

from credtrail.operators import reconcile
from credtrail.sources import arranged
from credtrail.sources.arranged import ArrangedInputs, arrange


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below(plan, node):
    """The lines of the plan under (indented deeper than) the first line that names ``node``."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if node in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    out = []
    for line in lines[at + 1:]:
        if line.strip() and depth(line) <= depth(lines[at]):
            break
        out.append(line)
    return "\n".join(out)


def rows(df):
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


@pytest.fixture(scope="module")
def inputs(spark, catalog):
    pr, g = catalog.table("purchase_register"), catalog.table("gstr2b_data")
    # NULL keys match each other, and a NULL is not the text "-" or an empty one
    odd = pr.limit(1).withColumn("purchase_invoice_id", pr.invoice_number)
    extra = [odd.selectExpr("* except(supplier_gstin, invoice_number)", f"{a} as supplier_gstin", f"{b} as invoice_number").select(*pr.columns)
             for a, b in (("null", "null"), ("'-'", "'-'"), ("''", "null"))]
    for x in extra:
        pr = pr.unionByName(x)
    first = g.limit(1).selectExpr("* except(supplier_gstin, invoice_number)", "cast(null as string) as supplier_gstin",
                                  "cast(null as string) as invoice_number").select(*g.columns)
    return pr, g.unionByName(first)


def test_no_exchange_under_the_join_and_the_same_rows(spark, inputs):
    pr, g = inputs
    kept = arrange(pr, g, tempfile.mkdtemp(prefix="credtrail-arranged-"), buckets=5)
    detail = kept.detail()
    plan = plan_of(detail)
    assert "SortMergeJoin" in plan and "Exchange" not in below(plan, "SortMergeJoin")
    want = reconcile.reconcile_detail(pr, g, hot_keys=None)
    assert sorted(detail.columns) == sorted(want.columns) and rows(detail) == rows(want)
    # the same from a session that only knows the folder
    other = spark.newSession()
    for name in ("register", "filings"):
        spark.sql(f"DROP TABLE {kept.name(name)}")
    again = ArrangedInputs.open(other, kept.root).detail()
    assert "Exchange" not in below(plan_of(again), "SortMergeJoin") and rows(again) == rows(want)


def test_appended_rows_and_hot_keys(spark, inputs):
    pr, g = inputs
    half = "pmod(xxhash64(invoice_number), 2) = 0"
    late = f"not coalesce({half}, true)"
    kept = arrange(pr.filter(f"not ({late})"), g, tempfile.mkdtemp(prefix="credtrail-arranged-"), buckets=3).append(pr=pr.filter(late))
    assert rows(kept.detail()) == rows(reconcile.reconcile_detail(pr, g, hot_keys=None))
    assert "Exchange" not in below(plan_of(kept.detail()), "SortMergeJoin")
    # a key that becomes hot moves out of its bucket
    one = pr.filter("supplier_gstin is not null").limit(1)
    many = one.crossJoin(spark.range(50)).drop("id")
    options = {"min_rows": 20, "fraction": 1.0, "pairs_per_cell": 10}
    kept = arrange(pr, g, tempfile.mkdtemp(prefix="credtrail-arranged-"), buckets=3, **options)
    assert kept.hot("register").isEmpty()
    more = kept.append(pr=many)
    assert more.hot("register").count() > 50 and more.root != kept.root
    assert rows(more.detail()) == rows(reconcile.reconcile_detail(pr.unionByName(many), g, hot_keys=None))


def test_text_columns_go_through_a_shuffle_as_one(spark):
    names = [f"t{i}" for i in range(9)]
    texts = [None, "", "-", "+", " é ", "x" * 509, "x" * 510, "x" * 511, "y" * 70_000]
    df = spark.createDataFrame([(n, *(texts[(n + j * (n // 9)) % 9] for j in range(9))) for n in range(81)], "n int, " + ", ".join(f"{c} string" for c in names))
    df = df.withColumn("t8", F.when(F.col("n") % 3 == 0, F.unhex(F.lit("FFE28241")).cast("string")).otherwise(F.col("t8")))  # no UTF-8
    lean, told_texts = arranged.packed(df)
    assert told_texts == names and not {*names} & {*lean.columns}
    again = arranged.texts_of(told_texts)
    back = lean.repartition(3).select("n", *[again[c].alias(c) for c in names])
    as_bytes = lambda x: sorted(tuple(r) for r in x.select("n", *[F.hex(F.col(c).cast("binary")) for c in names]).collect())
    assert as_bytes(back) == as_bytes(df)
    key = df.select("t8", arranged.never_null(F.col("t8")).alias("_key_number"))
    assert key.filter(~F.col("t8").cast("binary").eqNullSafe(arranged.told("_key_number").cast("binary"))).isEmpty()


def test_what_arranging_writes(spark, inputs, monkeypatch, tmp_path):
    """Key texts stand for the key columns, buckets are sized by the bytes of their rows."""
    pr, g = inputs
    monkeypatch.setattr(arranged, "BYTES_PER_BUCKET", 20_000)
    kept = arrange(pr, g, f"{tmp_path}/arranged")
    assert kept.buckets > 8
    for side, df in zip(arranged.SIDES, inputs, strict=True):
        stored = spark.read.parquet(f"{kept.root}/{side}")
        assert {*stored.columns} == {*df.columns, arranged.KEY1, arranged.KEY2} - {"supplier_gstin", "invoice_number"}
        assert {*kept.cold(side).columns} == {*df.columns, arranged.KEY1, arranged.KEY2}
        files = [r.f for r in stored.select(F.input_file_name().alias("f")).distinct().collect()]
        assert 8 < len(files) <= kept.buckets
    want = reconcile.reconcile_detail(pr, g, hot_keys=None)
    assert rows(kept.detail().select(want.columns)) == rows(want)
    # keys that are no text stay as they are
    pr, g = (x.withColumn("supplier_gstin", F.length("supplier_gstin")).limit(300) for x in (pr, g))
    want = reconcile.reconcile_detail(pr, g, hot_keys=None)
    got = arrange(pr, g, f"{tmp_path}/numbers").detail()
    assert got.schema["supplier_gstin"].dataType == want.schema["supplier_gstin"].dataType and rows(got.select(want.columns)) == rows(want)


def test_arranged_query_writes_no_copy_of_the_join(spark, monkeypatch):
    from credtrail.plans.registry import QUERIES
    names = []
    write = reconcile.write_snapshot
    monkeypatch.setattr(reconcile, "write_snapshot", lambda df, name="x": (names.append(name), write(df, name))[1])
    sf = "/root/testdata/sf0.001"
    got = QUERIES["j1_reconcile_arranged"](spark, sf)
    assert names == []
    want = QUERIES["j1_reconcile"](spark, sf)
    assert names and rows(got) == rows(want)


def test_shuffle_files_go_when_their_write_ends(spark, tmp_path):
    import time

    from credtrail.session import shuffles_freed
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        found = blocks.getAllBlocks()
        return {found.apply(i).name() for i in range(found.size()) if found.apply(i).name().startswith("shuffle_")}

    before = held()
    data = spark.range(1000).repartition(3, "id")
    with shuffles_freed(spark):
        data.write.parquet(f"{tmp_path}/freed")
    for _ in range(100):
        if held() <= before:
            break
        time.sleep(0.1)
    assert held() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    data.write.parquet(f"{tmp_path}/kept")
    assert not held() <= before and data.count() == 1000
