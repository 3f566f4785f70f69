from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cartulary.functions import keys as K, measures as M, ranges as R
from cartulary.operators import aggregates as A, enrich, ids, linkage, matching, sampling, survive
from cartulary.plans import images
from cartulary.plans.reconcile import cascade, rebuild
from cartulary.schemas import INVENTORY, RATIO_RECAP, RECAP, REFERENCE


def values(spark, rows, schema, *columns):
    return [tuple(r) if len(columns) > 1 else r[0] for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_schemas():
    assert len(REFERENCE) == 35 and len(RECAP) == 11 and len(RATIO_RECAP) == 14


def test_names(spark):
    names = ["a.tif", "a.b.jpg", ".bashrc", "..x.y", "noext", "d/e.f/g", "a.", None, "a.csv.gz", "", "x.TIF"]
    import os.path

    got = values(spark, [(n,) for n in names], "n string", K.basename(F.col("n")).alias("b"), K.stem(K.basename(F.col("n"))).alias("s"), K.splitext_extension(K.basename(F.col("n"))).alias("e"), K.last_extension(F.col("n")).alias("l"))
    for n, (b, s, e, l) in zip(names, got):
        if n is None:
            assert (b, s, e, l) == (None,) * 4
            continue
        base = os.path.basename(n)
        assert (b, s, e) == (base, *os.path.splitext(base))
        m = re.match(r".*(\..*)$", n)
        assert l == (m[1] if m else None)
    assert values(spark, [("x.csv.gz",), ("x.JPG",), ("x.zzz",), (None,)], "n string", K.mime_type(F.col("n"))) == ["text/csv", "image/jpeg", None, None]


def test_unpad_and_expand_agree_with_their_rules(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab0019_-.", k=rng.randint(0, 12))) for _ in range(500)]
    got = values(spark, [(t,) for t in texts], "t string", K.unpad(F.col("t")))
    assert got == [re.sub(r"\d+", lambda m: m[0].lstrip("0") or "0", t) for t in texts]

    def expand(a, b):
        ta, tb = re.findall(r"\d+|\D+", a), re.findall(r"\d+|\D+", b)
        d = [i for i, (x, y) in enumerate(zip(ta, tb)) if x != y]
        if len(ta) != len(tb) or len(d) != 1 or not (ta[d[0]].isdigit() and tb[d[0]].isdigit()):
            return None
        i, lo, hi = d[0], int(ta[d[0]]), int(tb[d[0]])
        return None if hi < lo else ["d/" + "".join([*ta[:i], str(n).zfill(len(ta[i])), *ta[i + 1 :]]) + ".tif" for n in range(lo, hi + 1)]

    pairs = [("P_01", "P_08"), ("P_08", "P_01"), ("P_1_1", "P_2_2"), ("P_1", "P_1_2"), ("P_9", "P_11"), ("P_1", "P_1"), ("P_a", "P_b"), ("", "")]
    pairs += [(f"x{rng.randint(0, 30):0{rng.randint(1, 3)}d}y{rng.choice('ab1')}", f"x{rng.randint(0, 30):0{rng.randint(1, 3)}d}y{rng.choice('ab1')}") for _ in range(400)]
    rows = [(f"d/{a}.tif", f"d/{b}.tif") for a, b in pairs]
    assert values(spark, rows, "a string, b string", R.expand(F.col("a"), F.col("b"))) == [expand(a, b) for a, b in pairs]
    spans = R.members(R.with_span(spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a string, b string"), F.col("a"), F.col("b"))).collect()
    assert sorted((r.k, r.href) for r in spans) == sorted((k, x) for k, p in enumerate(pairs) for x in expand(*p) or ())
    assert all((r.size == 1) or (r.position == "first") == (r.href == expand(*pairs[r.k])[0]) for r in spans)
    assert values(spark, [("access:image:first",), ("last_image",), ("x",), (None,)], "r string", R.bound(F.col("r"))) == [("access:image", "first"), ("image", "last"), None, None]


def test_measures(spark):
    assert values(spark, [(2.5,), (3.5,), (None,)], "x double", F.bround("x")) == [2, 4, None]
    got = values(spark, [(1000.0,), (8000.0,), (None,), (float("nan"),)], "w double", M.reduction(F.col("w"), 0.5))
    assert got == [1.0, 0.5, None, None]
    assert values(spark, [("2025-12-24 20:35:27+00:00",), ("x",), (None,)], "t string", M.day_number(F.col("t"))) == [20251224, None, None]
    assert values(spark, [(12,), (None,)], "s int", M.estimate(F.col("s"), 12)) == [1, None]
    assert values(spark, [("12",), ("x",), ("",)], "s string", M.estimate(F.col("s"), 12)) == [1, None, None]
    bins = M.right_closed_bin(F.col("x"), [0, 25, 50])
    assert values(spark, [(0.0,), (25.0,), (25.1,), (51.0,), (None,)], "x double", bins) == ["[0, 25]", "[0, 25]", "(25, 50]", None, None]


OLD = [("a", "p", 1, 1.0, 1.0, "c1", "u1"), ("b", "p", 2, 1.0, 1.0, "c2", "u2"), ("c", "p", 3, 1.0, 1.0, "c3", "u3"), ("d", "p", 4, 1.0, 1.0, "c4", "u4"), ("d", "q", 4, 1.0, 1.0, "c4", "u5"), ("e", "p", 5, 1.0, 1.0, None, "u6"), ("z", "p", 9, 1.0, 1.0, "c9", "u9")]
NEW = [("a", "p", 1, 1.0, 1.0, None), ("b", "p", 2, 2.0, 1.0, None), ("c", "moved", 3, 1.0, 1.0, "c3"), ("d", "p", 4, 3.0, 3.0, "c4"), ("d", "q", 7, 3.0, 3.0, "c4"), ("e", "other", 5, 1.0, 1.0, None), ("n", "p", 8, 1.8e9, 1.8e9, "c8")]
SHAPE = "name string, path string, size long, last_content_modification_date double, last_metadata_modification_date double, checksum_md5 string"


def test_cascade_tiers_and_conservation(spark):
    old, new = spark.createDataFrame(OLD, SHAPE + ", uuid string"), spark.createDataFrame(NEW, SHAPE)
    for partitions in (1, 5):
        found = cascade(old.repartition(partitions), new.repartition(partitions + 1))
        tiers = {r.uuid: r.tier for r in found.matched.collect()}
        assert tiers == {"u1": 1, "u2": 2, "u4": 2, "u3": 3, "u5": 3, "u6": 3}
        assert [r.name for r in found.left.collect()] == ["n"] and [r.uuid for r in found.right.collect()] == ["u9"]
        assert linkage.conserved(new, found.matched, found.left).first().holds


def test_duplicates_stay_in_the_rest(spark):
    left = spark.createDataFrame([("x", 1), ("x", 1), ("y", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("x", 1, "a"), ("y", 2, "b"), (None, 3, "c")], "k string, v int, uuid string")
    t = linkage.match_unique(left, right, ["k", "v"], ["uuid"])
    assert {r.uuid for r in t.ok.collect()} == {"b", "c"} and t.left.count() == 2 and [r.uuid for r in t.right.collect()] == ["a"]


def test_rebuild(spark):
    columns = [f.name for f in INVENTORY] + ["uuid", "source2s3", "extension", "file_type", "finding_aid", "s3_key"]
    old = spark.createDataFrame([(*r[:3], r[5], *r[3:5], r[6], "az", None, None, "fa" + r[6], None) for r in OLD] + [("w.tif", "s", 1, "cw", 1.0, 1.0, "uw", None, None, None, "faw", "k")],
                                "name string, path string, size long, checksum_md5 string, last_content_modification_date double, last_metadata_modification_date double, uuid string, source2s3 string, extension string, file_type string, finding_aid string, s3_key string")
    new = spark.createDataFrame([(*r[:3], r[5], *r[3:5]) for r in NEW] + [("Thumbs.db", "p", 1, "x", 1.0, 1.0)], INVENTORY)
    got = {r.name + "|" + r.path: r for r in rebuild(old, new, 2027).collect()}
    assert set(got) == {"a|p", "b|p", "c|moved", "d|p", "d|q", "e|other", "n|p", "w.tif|s"}
    assert got["b|p"].uuid == "u2" and got["b|p"].finding_aid == "fau2" and len(got["n|p"].uuid) == 32 and got["n|p"].finding_aid is None
    assert got["w.tif|s"].file_type == "tiff" and got["w.tif|s"].s3_key == "k" and set(columns) == set(old.columns)


def test_decision_table(spark):
    rows = [("c1", "n1", 2.0, 1), ("c1", "n1", 1.0, 2), ("c2", "n2", None, 3), ("c2", "n2", None, 4), ("c3", "n3", 5.0, 5), ("c3", "n4", 5.0, 6), ("c5", "n6", 1.0, 7), ("c6", "n6", 1.0, 8), ("c7", "n7", 1.0, 9), ("c8", "n8", 1.0, 10), ("c8", "n8", 1.0, 11), (None, "n9", 1.0, 12)]
    got = {r.i: r for r in survive.decide_transfers(spark.createDataFrame(rows, "checksum_md5 string, name string, d double, i int"), ["checksum_md5", "name"], ["name"], "d", ["i"]).collect()}
    assert {i for i, r in got.items() if r.action == "transférer"} == {1, 3, 9, 10, 12}
    assert got[1].traitement.endswith("conservé — modif. la plus récente") and got[3].traitement.endswith("1er (dates absentes)") and got[10].traitement.endswith("1er (dates égales)")
    assert got[5].traitement.startswith("doublon résiduel sur checksum_md5 :") and got[7].traitement.startswith("doublon résiduel sur name :")
    assert got[2].traitement == "doublon (2 copies, 1 écartée(s)) : écarté — copie non retenue" and got[9].traitement == "unique : à transférer"


def test_enrichment_edge_cases(spark):
    base = spark.createDataFrame([("u1", "1_D_2"), ("u2", None), ("u3", "x")], "uuid string, unitid string")
    listing = spark.createDataFrame([("k2", "2025-01-02", "u1", "b"), ("k1", "2025-01-01", "u1", "b"), ("k3", "bad", "u3", "b"), ("k4", "2025-01-01", None, "b")], "key string, last_modified string, uuid string, s3_bucket string")
    got = {r.uuid: r for r in enrich.add_objects(base, listing).collect()}
    assert (got["u1"].s3_key, got["u1"].s3_uploaded_date) == ("k1", 20250101) and got["u2"].s3_uploaded is False and got["u3"].s3_uploaded_date is None
    records = spark.createDataFrame([("i2", "1 D 2", "s2", "R2"), ("i1", " 1  D 2 ", "s1", "R1"), ("i3", "", "s", "R3")], "identifier string, cote string, setname string, osiros_id string")
    assert {r.uuid: r.osiros_id for r in enrich.add_records(base, records).collect()} == {"u1": "R1", "u2": None, "u3": None}


def test_group_anti_match_and_tiers(spark):
    l = spark.createDataFrame([("g", "access:image", "A.jpg"), ("g", "preservation:image", "A.tif"), ("g", "access:audio", "A.mp3"), ("h", "access:image", "A.jpg")], "g string, role string, href string").withColumn("f", K.role_family(F.col("role")))
    got = matching.missing_in_group(l, "g", F.col("role").startswith("access:"), F.col("role").startswith("preservation:"), "f", K.exact_keys(F.col("href"), "", "x"))
    assert {(r.g, r.href) for r in got.collect()} == {("g", "A.mp3"), ("h", "A.jpg")}


def test_samples(spark):
    df = spark.createDataFrame([(g, i, i % 7 + 1) for g in "abc" for i in range({"a": 30, "b": 12, "c": 25}[g])], "g string, i int, size int")
    order = sampling.shuffled_order(5, "g", "i")
    for rows, size in ((600, 1e9), (15, 1e9), (600, 60), (2, 1e9)):
        got = sampling.balanced_sample(df, "g", "size", order, rows, size).collect()
        counts = {g: sum(r.g == g for r in got) for g in "abc"}
        n = counts["a"]
        assert set(counts.values()) == {n} and n <= 12 and 3 * n <= rows and sum(r.size for r in got) <= size
        ranked = sampling.running_budget(df, "g", "size", order).collect()
        bigger = sum(r.size for r in ranked if r.rank <= n + 1)
        assert n == 12 or 3 * (n + 1) > rows or bigger > size
    assert {r.g for r in sampling.codes_with_prefix(spark.createDataFrame([("PRA_X",), ("MED",), (None,)], "g string"), "g", ["PRA_", "MED"]).collect()} == {"PRA_X", "MED"}


def test_ids(spark):
    df = spark.range(2000).select((F.col("id") * 7 % 2000).alias("k"))
    got = [r.number for r in ids.global_numbers(df, ["k"]).orderBy("k").collect()]
    assert got == list(range(1, 2001))
    taken = spark.createDataFrame([("m01" + "x" * 6,)], "id string")
    made = [r.id for r in ids.new_ids(df, taken, "m0", 1, ["k"]).collect()]
    assert len(set(made)) == 2000 and all(len(x) == 9 for x in made)


def test_reports(spark):
    df = spark.createDataFrame([("a", "x", "oui", 1, "u"), ("a", None, None, 2, None), ("a", "x", "non", 3, "v"), (None, "TRANSFERT", "oui", 10, "w")], "code string, st string, pub string, size long, uuid string")
    got = {r.code: r for r in A.dashboard(df, "code", "uuid", "size", "st", "pub", K.contains_any(F.col("st"), ["TRANSFERT"])).collect()}
    assert got["a"].st == "x (2) ; NON RENSEIGNÉ (1)" and got["a"].fichiers == 2 and got["TOTAL"].fichiers == 4 and got["TOTAL"].traitement_s3 == 25.0
    cross = A.crosstab(df, "code", "pub", ["oui", "non"]).collect()
    assert [tuple(r) for r in cross] == [("a", 1, 1)]


@settings(max_examples=60, deadline=None)
@given(st.floats(2, 60), st.integers(1, 40), st.integers(41, 100))
def test_calibration_never_beats_its_best_try(target, low, high):
    sizes = lambda q: 2000 + 900 * q
    got = images.calibrate(1_000_000, sizes, target, 0.02, low, high, 8)
    assert low <= got.quality <= high and got.steps <= 8 and got.ratio == pytest.approx(1_000_000 / sizes(got.quality))
    every = min(abs(1_000_000 / sizes(q) - target) for q in range(low, high + 1))
    assert abs(got.ratio - target) <= max(0.02 * target, every * 1.0001 + 1e-9) or got.steps >= 6


def test_calibration_fails_by_row(spark):
    df = spark.createDataFrame([("a", 1000, bytearray(b"x" * 10)), ("b", 1000, bytearray(b""))], "path string, raw long, content binary")

    def encode(data, q):
        if not data:
            raise ValueError("empty")
        return b"y" * q

    got = {r.path: r for r in images.calibrate_images(df, encode, target=20.0).collect()}
    assert got["a"].error is None and abs(got["a"].ratio - 20) <= 2 and got["b"].error == "empty"
    jobs = images.plan_jobs(spark.createDataFrame([("c", "/i/x.tif", 4000.0), ("c", "/i/y.tif", 1000.0)], "corpus string, source string, width double"), images.sweep(spark.createDataFrame([("c", 50)], "corpus string, facteur int"), "jp2", [80], [3000]), "/out", ".jp2", spark.createDataFrame([("/out/jp2_q80_f50_rmin3000/y_jp2_q80_f50_rmin3000.jp2",)], "path string"))
    assert [(r.source, r.scale) for r in jobs.collect()] == [("/i/x.tif", 0.75)]


def test_samples_and_budgets_agree_with_sorting(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a", "b", None]), rng.randint(1, 9)) for i in range(9000)] + [(9001, "one", 4)]
    df = spark.createDataFrame(rows, "id long, g string, size long")
    order = sampling.shuffled_order(3, "id")
    key = {r.id: r.o for r in df.select("id", order.alias("o")).collect()}
    groups = {}
    for i, g, n in sorted(rows, key=lambda r: key[r[0]]):
        groups.setdefault(g, []).append((i, n))
    expected = {i: (k + 1, sum(n for _, n in some[: k + 1])) for some in groups.values() for k, (i, _) in enumerate(some)}
    assert {r.id: (r["rank"], r.running) for r in sampling.running_budget(df, "g", "size", order).collect()} == expected
    for share in (0.01, 0.5, 1.0):
        drawn = {r.id for r in sampling.share_sample(df, "g", share, order).collect()}
        assert drawn == {i for some in groups.values() for i, _ in some[: -int(-len(some) * share // 1)]}


def test_common_parts_of_a_key_clash_without_a_window(spark):
    rows = [(i, f"c{i}", "common", 1.0) for i in range(500)] + [(600, "c0", "other", 1.0), (601, None, None, None), (602, None, None, 3.0), (603, "x", "alone", None)]
    out = {r.id: (r.action, r.traitement) for r in survive.decide_transfers(spark.createDataFrame(rows, "id long, checksum_md5 string, name string, d double"), ["checksum_md5", "name"], ["name"], "d", ["id"]).collect()}
    assert out[1] == ("ne pas transférer", "doublon résiduel sur name : non transféré (même nom pour des contenus différents)")
    assert "checksum_md5, name" in out[0][1] and "sur checksum_md5 :" in out[600][1] and out[603][0] == "transférer" and out[602][0] == "transférer" and "écarté" in out[601][1]


def test_small_functions(spark):
    assert values(spark, [("image/tiff",), ("audio/mpeg",), ("x/y",), (None,)], "m string", K.extension_of_mime(F.col("m"))) [2:] == [None, None]
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "y int, z int")
    assert linkage.column_difference(a, b) == ["x", "z"] and [tuple(r) for r in linkage.stacked([a, b]).collect()] == [(1, 2, None), (None, 3, 4)]
    images_ = spark.createDataFrame([("c", 4000.0, 100.0, 300.0), ("c", 1000.0, 10.0, 300.0), ("c", None, 1.0, 1.0)], "corpus string, width double, height double, dpi double")
    r = images.resolution_recap(images_, F.lit(0.25)).first()
    assert (r.x_before, r.x_after, r.reduced, r.at_floor, r.unchanged) == (2500, 1500, 1, 1, 1)
