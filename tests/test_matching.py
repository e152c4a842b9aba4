"""J11: one-to-one matching to the end, against a greedy matching by hand."""

import hashlib
import itertools
import random

import pytest

from credtrail.operators.matching import deletion_variants, fuzzy_matches

PR = "purchase_invoice_id string, supplier_gstin string, invoice_number string, total_tax decimal(12,2)"
G2B = "gstr2b_id string, supplier_gstin string, invoice_number string, igst decimal(12,2), cgst decimal(12,2), sgst decimal(12,2)"


def frames(spark, left, right):
    from decimal import Decimal
    pr = spark.createDataFrame([(i, s, n, None if t is None else Decimal(t)) for i, s, n, t in left], PR)
    g = spark.createDataFrame([(i, s, n, None if t is None else Decimal(t), Decimal(0), Decimal(0)) for i, s, n, t in right], G2B)
    return pr.repartition(3), g.repartition(3)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def greedy(left, right, distance, tolerance):
    """{pairs} by taking the best pair of classes of free rows again and again."""
    from decimal import Decimal
    clean = lambda n: None if n is None else n.strip().upper()
    keys_l, keys_r = {(s, clean(n)) for _, s, n, _ in left}, {(s, clean(n)) for _, s, n, _ in right}

    def classes(rows, others, scale):
        out = {}
        for i, s, n, t in rows:
            if s is not None and n is not None and t is not None and (s, clean(n)) not in others:
                out.setdefault((s, clean(n), Decimal(t).quantize(Decimal("0.01"))), []).append(i)
        return {k: sorted(v) for k, v in out.items()}

    def digest(c):
        return hashlib.md5("\x1f".join([c[0], c[1], str(c[2])]).encode()).hexdigest()

    p, g = classes(left, keys_r, 2), classes(right, keys_l, 2)
    pairs = []
    for a, b in itertools.product(p, g):
        if a[0] == b[0] and edits(a[1], b[1]) <= distance and abs(a[2] - b[2]) < tolerance:
            pairs.append((edits(a[1], b[1]), abs(a[2] - b[2]), hashlib.md5((digest(a) + digest(b)).encode()).hexdigest(), a, b))
    found = set()
    for e, _, _, a, b in sorted(pairs):
        while p[a] and g[b]:
            found.add((p[a].pop(0), g[b].pop(0), e))
    return found


def matched(df):
    return {(r.purchase_invoice_id, r.gstr2b_id, r.edits) for r in df.collect()}


@pytest.mark.parametrize("seed,distance", [(1, 1), (2, 2)])
def test_matching_equals_a_greedy_one_by_hand(spark, seed, distance):
    r = random.Random(seed)
    number = lambda: "".join(r.choices("ab1", k=r.randint(1, 4)))
    left = [(f"p{i:03d}", r.choice("xy"), number(), r.choice(["10.00", "10.30", "11.20", "12.00"])) for i in range(70)]
    right = [(f"g{i:03d}", r.choice("xy"), number() + r.choice(["", " "]), r.choice(["10.00", "10.40", "11.00"])) for i in range(60)]
    left += [("n1", None, "ab", "10.00"), ("n2", "x", None, "10.00"), ("n3", "x", "zzzz", None)]
    right += [("m1", "x", "zzzy", None), ("m2", "x", "zzzy", "10.00")]
    got = fuzzy_matches(*frames(spark, left, right), distance=distance, tolerance=1.0)
    rows = got.collect()
    want = greedy(left, right, distance, 1)
    assert {(x.purchase_invoice_id, x.gstr2b_id, x.edits) for x in rows} == want and len(rows) == len(want) > 5
    # nothing is left that could still be matched
    assert len({x.purchase_invoice_id for x in rows}) == len({x.gstr2b_id for x in rows}) == len(rows)


@pytest.mark.parametrize("m,k", [(9, 9), (200, 150)])
def test_tied_copies_are_matched_to_the_last(spark, m, k):
    left = [(f"p{i:04d}", "s", "INV-100", "50.00") for i in range(m)]
    right = [(f"g{i:04d}", "s", "INV-1O0", "50.00") for i in range(k)]
    got = fuzzy_matches(*frames(spark, left, right)).collect()
    assert sorted((x.purchase_invoice_id, x.gstr2b_id) for x in got) == [(f"p{i:04d}", f"g{i:04d}") for i in range(min(m, k))]


def test_many_equally_good_classes_take_few_rounds(spark, monkeypatch):
    from credtrail.operators import matching
    names = []
    write = matching.write_snapshot
    monkeypatch.setattr(matching, "write_snapshot", lambda df, name="x": (names.append(name), write(df, name))[1])
    left = [(f"p{i:02d}", "s", f"A{i:02d}", "50.00") for i in range(40)]
    right = [(f"g{i:02d}", "s", f"B{i:02d}", "50.00") for i in range(40)]
    got = fuzzy_matches(*frames(spark, left, right), distance=3)
    assert matched(got) == greedy(left, right, 3, 1)
    assert got.count() == 40 and names.count("match-hits") <= 14


def test_empty_sides_and_hot_variants(spark):
    left = [(f"p{i}", "s", "INV-7", "5.00") for i in range(30)] + [("q", "s", "EXACT", "1.00")]
    right = [("g1", "s", "INV-8", "5.00"), ("g2", "s", "exact", "1.00")]
    pr, g = frames(spark, left, right)
    assert matched(fuzzy_matches(pr, g)) == {("p0", "g1", 1)}
    assert matched(fuzzy_matches(pr, g, sample_fraction=1.0, min_hot_rows=2, pairs_per_cell=2)) == {("p0", "g1", 1)}
    assert fuzzy_matches(pr.limit(0), g).count() == 0 and fuzzy_matches(pr, g.limit(0)).count() == 0


def test_variants_meet_within_the_distance(spark):
    words = ["", "a", "ab", "abc", "abcd", "xbcd", "abxd", "bacd", "abcdef"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for distance in (1, 2):
        variants = {r.w: set(r.v) for r in df.select("w", deletion_variants(df.w, distance).alias("v")).collect()}
        for a, b in itertools.combinations(words, 2):
            if edits(a, b) <= distance:
                assert variants[a] & variants[b], (a, b)


def long_numbers(r, n, mark):
    return [(f"{mark}{i:03d}", f"s{r.randint(0, 9)}", "INV-" + "".join(r.choices("0123456789", k=16)), f"{r.randint(10, 30)}.00") for i in range(n)]


def with_slips(r, rows, mark):
    """Some of ``rows`` with one digit lost, as the other side's rows."""
    return [(f"{mark}{i:03d}", s, n[:8] + n[9:], t) for i, (_, s, n, t) in enumerate(r.sample(rows, 25))]


def test_few_rows_are_written_where_groups_are_small(spark, monkeypatch):
    from credtrail.operators import matching
    written = {}

    def write(df, name="x", real=matching.write_snapshot):
        out = real(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(matching, "write_snapshot", write)
    r = random.Random(5)
    left = long_numbers(r, 80, "p")
    right = with_slips(r, left, "g") + long_numbers(r, 50, "h")
    got = matched(fuzzy_matches(*frames(spark, left, right), distance=2, tolerance=1.0))
    assert got == greedy(left, right, 2, 1) and len(got) == 25
    # two deletions from twenty characters make some 200 variants a row, three bands each on one side
    assert sum(written.values()) < 5 * (len(left) + len(right)), written


@pytest.mark.parametrize("most", [0, 1])
def test_crowded_groups_meet_by_variants(spark, monkeypatch, most):
    from credtrail.operators import matching
    names = []
    write = matching.write_snapshot
    monkeypatch.setattr(matching, "write_snapshot", lambda df, name="x": (names.append(name), write(df, name))[1])
    monkeypatch.setattr(matching, "PAIRS_PER_ROW", most)  # 0: every group that has pairs; 1: some of them
    r = random.Random(6)
    left = long_numbers(r, 60, "p") + [(f"q{i:02d}", "s1", f"INV-{i}", "20.00") for i in range(12)]
    right = with_slips(r, left, "g") + [(f"h{i:02d}", "s1", f"JNV-{i}", f"{20 + i % 2}.00") for i in range(12)]
    rows = fuzzy_matches(*frames(spark, left, right), distance=2, tolerance=1.5).collect()
    want = greedy(left, right, 2, 1.5)
    assert {(x.purchase_invoice_id, x.gstr2b_id, x.edits) for x in rows} == want and len(rows) == len(want) > 20
    assert "fuzzy-variants-p" in names


def test_left_over_rows_are_those_without_the_other_sides_key(spark):
    from credtrail.operators.matching import left_over
    shape = "gstin string, number string, id int"
    p = spark.createDataFrame([("x", f"n{i % 40}", i) for i in range(120)] + [("xn", "1", 900), ("x", "n1", 901)], shape)
    g = spark.createDataFrame([("x", f"n{i}", i) for i in range(30, 60)] + [("x", "n1", 900), ("x", "n1", 901)], shape)
    a, b = ({x.id for x in side.collect()} for side in left_over(p, g))
    assert a == {i for i in range(120) if i % 40 < 30 and i % 40 != 1} | {900} and b == set(range(40, 60))
    one, none = left_over(p, g.limit(0))
    assert one.count() == 122 and none.count() == 0
