from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cartulary.llm import decontaminate, exact_dedup, simhash, substrings
from cartulary.llm.components import components, settled
from cartulary.llm.shared import named_rows


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[bare(r[1])].append((len(r[1] or ""), r[0]))
    return groups


@pytest.mark.parametrize("digest", [F.xxhash64, lambda c: F.pmod(F.xxhash64(c), F.lit(3))])
def test_exact_dedup_agrees_with_brute_force_even_when_digests_clash(docs, rows, digest):
    found = exact_dedup.exact_dedup(docs, 16, 64, digest).collect()
    groups = expected_groups(rows)
    assert len(found) == len(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    kept = defaultdict(int)
    for r in found:
        members = by_sha[r.text_sha256]
        most = max(n for n, _ in members)
        ids = [d for n, d in members if n == most]
        best = min((d for d in ids if d is not None), default=None)
        assert r.group_size == len(members) and r.keep_id == best
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}


def test_exact_dedup_splits_crowded_groups(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}") for i in range(6000)] + [(7000 + i, None) for i in range(1500)] + [(None, "the  same text")]
    found = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    sizes = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in found}
    assert sizes[4] == (None, 4001, False) and sizes[None] == (None, 4001, True)  # one more space
    assert sizes[7000] == (7000, 1500, True) and sizes[7001] == (7000, 1500, False) and sizes[3] == (3, 1, True)
    assert sum(r.kept for r in found) == 2002


def test_exact_dedup_stage_keeps_columns_and_one_of_each(docs, rows, empty):
    out = exact_dedup.drop_exact_copies(docs)
    assert out.columns == docs.columns
    assert sorted(bare(r.text) for r in out.collect()) == sorted(expected_groups(rows))
    assert exact_dedup.drop_exact_copies(empty).count() == 0
    assert exact_dedup.exact_dedup(empty).count() == 0


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w)] if len(w) < 4 else [" ".join(w[i : i + 4]) for i in range(len(w) - 3)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("hot", [2000, 2])
def test_simhash_components(docs, rows, hot):
    prints = [(r[0], brute_fingerprint(r[1])) for r in rows]
    roots = brute_components([p for _, p in prints])
    least = defaultdict(list)
    for d, p in prints:
        if d is not None:
            least[roots[p]].append(d)
    expected = sorted((d if d is not None else -1, f"{p:016x}", min(least[roots[p]], default=-1)) for d, p in prints)
    found = [(r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id if r.component_id is not None else -1) for r in simhash.near_duplicates(docs, hot).collect()]
    assert sorted(found) == expected


@pytest.mark.parametrize("cut", simhash.CUTS)
@pytest.mark.parametrize("hot", [2000, 4])
def test_links_lose_no_pair(spark, hot, cut):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(25)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), hot, cut)
    got = {r.node & ((1 << 64) - 1): r.root & ((1 << 64) - 1) for r in components(edges, "a", "b").collect()}
    roots = brute_components(prints)
    classes = lambda m: sorted(sorted(p for p in prints if m.get(p, p) == r) for r in {m.get(p, p) for p in prints})
    assert classes(got) == classes(roots)


def test_simhash_stage(docs, empty):
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect() if r.doc_id is not None]
    comps = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert set(ids) == {c for d, c in comps.items() if d is not None}
    assert simhash.keep_one(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(8)
    a, b, c = (" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(200)) for _ in range(3))
    near = lambda t, n: " ".join([*t.split()[:-1], f"x{n}"])
    assert all(0 < (simhash.fingerprint(t) ^ simhash.fingerprint(near(t, n))).bit_count() <= simhash.DISTANCE for t in (a, b, c) for n in (1, 2))
    rows = [(1, a), (2, near(a, 1)), (2, b), (3, c), (3, near(c, 1)), (3, c), (None, near(b, 1)), (None, near(b, 2))]
    alone = " ".join("".join(rng.choices("ijklmnop", k=5)) for _ in range(200))
    rows += [(None, alone), (None, near(alone, 2)), (None, alone)]
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    assert len(kept) == 4 and {(1, a), (2, b)} <= set(kept)
    assert sorted(d for d, _ in kept if d) == [1, 2, 3] and [t for d, t in kept if d is None][0] in (alone, near(alone, 2))


def test_the_number_of_fingerprints_tells_the_cut():
    assert simhash.best_cut(0) == simhash.best_cut(10**6) == simhash.CUTS[0] and simhash.best_cut(10**9) == simhash.CUTS[1]
    for cut in simhash.CUTS:  # segments tile the 64 bits, and their radii leave no pair of four bits out
        assert [a + n for a, n, _ in cut] == [*(a for a, _, _ in cut[1:]), 64] and sum(r + 1 for _, _, r in cut) == simhash.DISTANCE + 1
    assert len(simhash.ball(32, 2)) == 529 and sorted(simhash.ball(3, 1)) == [0, 1, 2, 4]


def test_rows_are_named_whatever_they_come_from(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id long, text string").repartition(3)
    df.write.parquet(f"{tmp_path}/p")
    df.write.csv(f"{tmp_path}/c")
    stored = spark.read.parquet(f"{tmp_path}/p")
    twice = stored.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    stored.withColumn("_metadata", F.lit("mine")).write.parquet(f"{tmp_path}/m")
    sources = [(spark.read.parquet(f"{tmp_path}/m"), 50), (stored, 50), (stored.where("doc_id > 9").select("text"), 40), (stored.unionByName(stored), 100), (twice, 100), (df, 50), (spark.read.csv(f"{tmp_path}/c"), 50), (stored.limit(0), 0)]
    for source, n in sources:
        named = named_rows(source, "file", "row")
        names = {(r.file, r.row): r[0] for r in named.collect()}
        assert len(names) == n and names == {(r.file, r.row): r[0] for r in named.collect()} and named.columns == [*source.columns, "file", "row"]


def test_edges_are_settled_when_they_are_stars(spark):
    e = lambda *x: settled(spark.createDataFrame(list(x), "a long, b long"))
    assert e((2, 1), (3, 1), (5, 4)) and not e((2, 1), (3, 2)) and not e((3, 1), (3, 2)) and settled(spark.createDataFrame([], "a long, b long"))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 60)}}


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_decontamination_agrees_with_brute_force(docs, rows, items, empty):
    tests = [(r.item_id, words(r.text)) for r in items.collect()]
    grams = defaultdict(set)
    for item, w in tests:
        for i in range(max(len(w) - 9, 1) if w else 0):
            grams[tuple(w[i : i + 10])].add(item)
    expected = []
    for r in rows:
        w, hit, ids = words(r[1]), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    ids |= grams[tuple(w[i : i + n])]
        ids = sorted(str(i) for i in ids if i is not None)
        expected.append((r[0] or -1, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    found = decontaminate.decontaminate(docs, items).drop("item_ids").collect()
    assert sorted((r.doc_id or -1, *r[1:]) for r in found) == sorted(expected)
    assert sum(r.contaminated for r in found) >= 8
    out = decontaminate.drop_contaminated(docs, items)
    assert out.columns == docs.columns and out.count() == sum(not e[-1] for e in expected)
    assert decontaminate.decontaminate(empty, items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).where("contaminated").count() == 0


def test_one_word_items_and_repeated_words(spark):
    rng = random.Random(12)
    texts = [" ".join(rng.choices(["the", "of", "a", "b"], [6, 2, 1, 1])[0] for _ in range(rng.randint(0, 60))) for _ in range(120)]
    items = [(1, "the"), (2, "of of"), (3, "the the the the the the the the the the the"), (4, "a b the of the of a"), (5, " ".join(texts[3].split()[:14]) or "x"), (6, "absent the")]
    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        for x in range(max(len(w) - 9, 1)):
            grams[tuple(w[x : x + 10])].add(str(i))
    expected = []
    for k, t in enumerate(texts):
        w, hit, ids = words(t), set(), set()
        for g, some in grams.items():
            for x in range(len(w) - len(g) + 1):
                if tuple(w[x : x + len(g)]) == g:
                    hit.update(range(x, x + len(g)))
                    ids |= some
        expected.append((k, len(hit), sorted(ids)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_hit, r.item_ids) for r in found) == expected and sum(n > 0 for _, n, _ in expected) > 100


def test_rows_repeated_whole_are_hit_alike(spark, rows):
    passage = " ".join(rows[85][1].split()[25:50])
    data = [(1, f"a {passage} b"), (1, f"a {passage} b"), (1, f"a {passage} b"), (2, passage), (2, "other words"), (None, passage), (None, passage)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    items = spark.createDataFrame([(9, passage), (9, passage)], "item_id long, text string")
    found = decontaminate.decontaminate(docs, items).collect()
    assert sorted((r.doc_id or -1, r.n_hit, r.n_items) for r in found) == [(-1, 25, 1)] * 2 + [(1, 25, 1)] * 3 + [(2, 0, 0), (2, 25, 1)]
    assert [r.text for r in decontaminate.drop_contaminated(docs, items).collect()] == ["other words"]


def test_proximity_finds_reordered_words(spark):
    docs = spark.createDataFrame([(1, "w1 w2 w3 filler w5 w4 w6 end"), (2, "w1 w2 w3"), (3, "w1 w2 w3 w4 w5 w6")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "w1 w2 w3 w4 w5 w6")], "item_id long, text string")
    grams = decontaminate.windows(items, 10)
    found = {(r.k, r.start) for r in decontaminate.matches(docs, grams, slop=1).collect()}
    assert {k for k, _ in found} == {1, 3} and (1, 0) in found
    assert {r.k for r in decontaminate.matches(docs, grams).collect()} == {3}


def brute_repeats(rows):
    key = lambda r: (r[0] if r[0] is not None else -(1 << 63), r[1])
    texts = sorted({(key(r)[0], r[1] or "") for r in rows}, key=lambda x: x[0])
    assert len({i for i, _ in texts if i >= 0}) >= len([1 for i, _ in texts if i >= 0]) - 1
    return texts


def clashing(piece) -> int:
    """A digest that many different contexts share."""
    return len(piece) % 3


@pytest.mark.parametrize("alphabet", [1, 2, 3, 40])
def test_suffixes_are_ordered(alphabet):
    rng = np.random.default_rng(alphabet)
    for n in (0, 1, 2, 7, 60, 400):
        for share in (None, 0.0, 0.1, 0.7):
            t = rng.integers(97, 97 + alphabet, n).astype(np.uint8)
            wanted = None if share is None else rng.random(n) < share
            raw = t.tobytes()
            expected = sorted((i for i in range(n) if wanted is None or wanted[i]), key=lambda i: raw[i:])
            assert substrings.suffix_order(t, n + 1, wanted).tolist() == expected
            got = substrings.suffix_order(t, 5, wanted).tolist()  # right to the depth, all there
            assert sorted(got) == sorted(expected) and [raw[i : i + 5] for i in got] == sorted(raw[i : i + 5] for i in got)


def test_runs_are_joined():
    x = np.array([(0, 0, 5, 7, 10), (0, 5, 4, 7, 15), (0, 9, 4, 7, 30), (0, 13, 2, 8, 34), (1, 15, 3, 8, 36)], substrings.RUN)
    got = substrings.joined(x, (x["doc"], x["odoc"]))
    assert got.tolist() == [(0, 0, 9, 7, 10), (0, 9, 4, 7, 30), (0, 13, 2, 8, 34), (1, 15, 3, 8, 36)]


@pytest.mark.parametrize(("crowd", "digest", "longest"), [(2000, substrings.xxh3, 1 << 15), (1, substrings.xxh3, 1 << 15), (2000, clashing, 1 << 15), (1, clashing, 1 << 15), (2000, substrings.xxh3, 64)])
def test_substrings_agree_with_brute_force(spark, docs, rows, empty, crowd, digest, longest):
    hashes = {r.t: r.h for r in docs.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    texts = sorted({(r[0] if r[0] is not None else -(1 << 63), hashes[r[1] or ""], r[1] or "") for r in rows})
    seen, expected = set(), {}
    for i, h, t in texts:
        b, fresh, cut = t.encode(), set(), bytearray(len(t.encode()))
        for p in range(len(b) - 99):
            s = b[p : p + 100]
            if s in seen or s in fresh:
                cut[p : p + 100] = b"\1" * 100
            fresh.add(s)
        seen |= fresh
        rest = bytes(x for x, c in zip(b, cut) if not c)
        spans = len(re.findall(b"\1+", bytes(cut)))
        expected[i, h] = (len(b), sum(cut), spans, hashlib.sha256(rest).hexdigest())
    found = substrings.remove_repeats(docs, crowd, digest, longest).drop("kept").collect()
    wanted = sorted((r[0] if r[0] is not None else -1, *expected[r[0] if r[0] is not None else -(1 << 63), hashes[r[1] or ""]]) for r in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, *r[1:]) for r in found) == wanted
    assert sum(r.n_removed > 0 for r in found) > 20
    assert substrings.remove_repeats(empty).count() == 0
