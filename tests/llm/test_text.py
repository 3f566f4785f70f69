from __future__ import annotations

import gzip
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartulary.llm import html_text, licenses, mixing, token_counts, toxicity, warc
from cartulary.llm.queries import VOCABULARY


# ---- HTML ----

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">Cookies!</div>
<article><header class="entry-header"><h1>Title &amp; more</h1><span>by me</span></header><p><b>First  <i>line</i>
of text.<br><p>Second&nbsp;one<div class="ad">Buy</div><form><p>Name</p></form><ul><li>x<li>y</ul><script>1</script>
<table><tr><td>a<td>b<tr><td>c</table></article><section id="comments"><p>me too</p></section><aside>more</aside><footer>&copy;</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == "Title & more\n\nFirst line of text.\n\nSecond one\n\nx\n\ny\n\na b\n\nc"
    assert html_text.main_text("<body><p>a<p>b") == "a\n\nb"
    assert html_text.main_text("plain &lt; text") == "plain < text"
    for broken in (None, "", "<", "<p", "<script>x", "<!-- a", "</p></div>", "<article>", "&#x;", "<a b='"):
        assert isinstance(html_text.main_text(broken), str)


def test_templates_of_a_host_go(spark):
    def page(i):
        return f"<body><div><p>Follow us everywhere</p></div><article><p>Text number {i} about {i * 7}</p><p>Read the terms</p></article></body>"

    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(12)] + [(100 + i, "http://one.example/", page(3)) for i in range(12)]
    rows += [(200, None, None), (None, "http://h.example/x", ""), (201, "nonsense", page(1))]
    rows += [(300 + i, "http://two.example/", f"<nav>menu {i}</nav>{page(4)}<footer>{i}</footer>") for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("nodes", F.lit(1))
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    assert len(got) == len(rows)
    assert got[4].text == "Text number 4 about 28" and got[4].n_chars == 22
    assert got[105].text == "Text number 3 about 21\n\nRead the terms"  # copies of one page count once
    assert got[305].text == "Text number 4 about 28\n\nRead the terms"  # and so do copies in different menus
    assert got[200].text == "" and got[200].n_chars == 0 and got[None].text == ""
    assert html_text.extract(pages.limit(0)).count() == 0


def test_main_around_articles_stays():
    page = "<body><h1>Site</h1><main><h1>Title</h1><p>beside</p><article><p>A long first part of the story.</p></article><div><h2>Next</h2></div><article><p>End.</p></article>outro</main></body>"
    assert html_text.main_text(page).split("\n\n") == ["Title", "beside", "A long first part of the story.", "Next", "End.", "outro"]
    assert html_text.main_text("<body><main><h1>Other</h1></main><article>Story</article><article>2</article></body>") == "Story\n\n2"
    assert html_text.main_text("<body><main><h1>Title</h1><p>x</p><article> </article></main></body>").split() == ["Title", "x"]
    assert html_text.main_text('<div role="main"><header><h1>T</h1></header><article>x</article></div><article class="comment">no</article>') == "T\n\nx"


def test_what_an_article_excludes_and_keeps():
    inside = lambda x: html_text.main_text(f"<article><p>a</p>{x}<p>z</p></article>").split("\n\n")[1:-1]
    for gone in (
        '<div class="ad">x</div>', '<div class="ad-container">x</div>', '<p class="ad">x</p>', '<section id="article-comments">x</section>', '<div class="related-posts">x</div>', '<nav>x</nav>', "<aside>x</aside>",
        "<footer>x</footer>", "<form><p>x</p></form>", '<div hidden>x</div>', '<div role="alert">x</div>', '<div class="cookie-notice">x</div>', "<script>x</script>", '<ul class="social-share-buttons"><li>x</li></ul>', "<!-- x -->", "</3>",
    ):
        assert inside(gone) == [], gone
    for kept in (
        '<div class="related-work">x</div>', '<section id="notice-period">x</section>', '<p class="notice">x</p>', '<table class="widget"><tr><td>x</td></tr></table>', '<header><p class="lead">x</p><span>by me</span></header>',
        '<div class="header">x</div>', "<math><mi>x</mi><annotation>tex</annotation></math>", '<div class="has-sidebar">x</div>',
    ):
        assert inside(kept) == ["x"], kept
    assert inside('<a href="x>y') == ["y"] and html_text.main_text('<a href="x>link') == "link" and html_text.main_text("<a title=it's>don't</a>") == "don't"
    assert html_text.main_text('<p title="a > b">x</p><p title=\'"\'>y') == "x\n\ny"


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<b>" * 100_000 + "</i>" * 100_000 + "x", "<article>" * 20_000 + "x", "<i><div>" + "<b>" * 30_000 + "</i>" * 30_000 + "x", "<span><div>" * 30_000 + "x"])
def test_deep_nesting_is_read(page):
    assert html_text.main_text(page) == "x"
    assert len(html_text.page_hashes(page)[1]) == (0 if page.startswith("<b>") else len(set(html_text.subtree_hashes(html_text.parse(page)).values())))


def test_each_deep_page_goes_through_spark(spark):
    deep = "<div>" * 50_000 + "x"
    got = html_text.extract(spark.createDataFrame([(1, "http://a/", deep), (2, "http://a/", "<p>y")], "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {1: "x", 2: "y"}


def _site(rng, host, n, layouts):
    """Pages of known articles in layouts of known furniture that nothing marks: (url, html, expected text)."""
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8)))
    line = lambda k: " ".join(word() for _ in range(k))
    furniture = [([line(6) for _ in range(3)], line(9), line(12)) for _ in range(layouts)]
    stock = line(30)  # a paragraph that many articles quote
    for i in range(n):
        links, before, after = furniture[i % layouts]
        blocks = [line(rng.randint(1, 40)) for _ in range(rng.randint(1, 6))] + [stock] * (i % 4 == 0)
        tags = [rng.choice(["p", "h2", "div", "blockquote", "li", "pre"]) for _ in blocks]
        spaced = [b.replace(" ", rng.choice([" ", "\n  ", "&nbsp;", " <b></b>", "&#32;"]), 2) for b in blocks]
        story = "".join(f"<{t}>{x}</{t}>" if rng.random() < 0.8 or t not in ("p", "li") else f"<{t}>{x}" for t, x in zip(tags, spaced))
        body = f"<div><ul>{''.join(f'<li><a href=#>{x}</a></li>' for x in links)}</ul></div><div><p>{before}</p></div>{'<article>' if i % 2 else '<div>'}{story}{'</article>' if i % 2 else '</div>'}<div><span>{after}</span></div>"
        yield f"http://{host}/{i}", f"<html><head><title>{line(3)}</title></head><body>{body}</body></html>", "\n\n".join(blocks)


@pytest.mark.parametrize("layouts", [1, 2, 3])
def test_planted_articles_of_sites_come_back(spark, layouts):
    rng = random.Random(layouts)
    rows = [(i, *x) for i, x in enumerate([*_site(rng, "a.example", 90, layouts), *_site(rng, "b.example", 60, layouts)])]
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got == {r[0]: r[3] for r in rows}


def test_templates_agree_with_counting_by_hand(spark):
    rng = random.Random(9)
    rows = [(i, *x) for i, x in enumerate([*_site(rng, "a.example", 40, 2), *_site(rng, "b.example", 7, 1), *_site(rng, "c.example", 30, 4)])]
    rows += [(900 + i, *rows[0][1:]) for i in range(20)]
    by_host: dict[str, dict[int, set[int]]] = {}
    for _, url, page, _ in rows:
        sig, nodes = html_text.page_hashes(page)
        by_host.setdefault(url.split("/")[2], {})[sig] = nodes
    expected = {}
    for h, found in by_host.items():
        for k in set().union(*found.values()):
            n = sum(k in x for x in found.values())
            if n >= 8 and n >= (0.5 if k & 1 else 0.25) * len(found):
                expected.setdefault(h, []).append(k)
    got = {r.host: r.nodes for r in html_text.templates(spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")).collect()}
    assert got == {h: sorted(x) for h, x in expected.items()} and set(got) == {"a.example", "c.example"}


# ---- toxicity ----


def _labelled(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(600)]
    texts, labels = [], []
    for i in range(n):
        w = rng.choices(words, k=rng.randint(10, 120))
        if i % 4 == 0:
            w[rng.randrange(len(w))] = rng.choice(["Scoundrel,", "blockhead", "NITWIT"])
        texts.append(" ".join(w))
        labels.append(int(i % 4 == 0))
    return texts, np.array(labels)


def test_classifier_learns_and_holds_out(spark, rows):
    texts, y = _labelled(1500)
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).withColumn("held_out", toxicity.fold(F.col("doc_id")) == 0).collect()
    held = [(r.score >= 0.5) == bool(y[r.doc_id]) for r in got if r.held_out]
    assert len(held) > 200 and np.mean(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)
    flipped = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, flipped)).collect()}
    assert all(again[r.doc_id] == r.score for r in got)  # held-out labels change nothing


def test_whole_texts_train(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(7, 10))) for _ in range(300)]
    rows = []
    for i in range(180):  # the insult of a toxic text comes last, after 2200 words and over 16384 characters
        w = rng.choices(words, k=40 if i % 3 == 1 else 2200)
        rows.append((i, " ".join([*w, "blockhead"] if i % 3 == 0 else w), "en", int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    got = toxicity.score(docs, model).withColumn("held_out", toxicity.fold(F.col("doc_id")) == 0).where("held_out").collect()
    assert len(got) > 20 and all((r.score >= 0.5) == (r.doc_id % 3 == 0) for r in got)


def test_rows_are_kept_back_for_calibration():
    rng = np.random.default_rng(3)
    hashes = [rng.integers(0, 1 << 62, 9).astype(np.uint64) for _ in range(900)]
    y = (np.arange(900) % 4 == 0).astype(float)
    back = toxicity.calibration_rows([*hashes, hashes[0]], np.append(y, 0))
    assert 0.1 < back.mean() < 0.25 and back[0] == back[-1]
    assert not toxicity.calibration_rows(hashes[:60], y[:60]).any() and not len(toxicity.calibration_rows([], y[:0]))
    p, z = np.r_[np.full(30, 0.62), np.full(30, 0.8)], np.r_[np.zeros(30), np.ones(30)]
    assert 0.62 < toxicity.calibrated(p, z) < 0.8 and toxicity.calibrated(p, np.r_[np.zeros(55), np.ones(5)]) == 0.5


def test_classifier_edge_cases(docs, empty, spark):
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    for d in (docs, empty):
        model = toxicity.fit(d, labels)
        assert toxicity.score(d, model).count() == d.count()
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == docs.count()
    assert toxicity.drop_toxic(docs, labels.limit(0)).columns == docs.columns
    assert toxicity.drop_toxic(empty, labels).count() == 0


# ---- WARC ----


def test_warc_roundtrip(spark):
    big, other = "é" * 700, "x" * 1000
    data = [(1, "http://a/1", big), (2, "u", big), (3, None, None), (4, "u", "short"), (5, "u", "short"), (6, "u", other), (7, "u\r\nX: y", big), (None, "n", other), (6, "u", other), (8, "u", "\r\n\r\n" * 400)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("owner", "s", "b", "c", "refers_to", "payload_digest")})
    got = sorted(warc.roundtrip(pages).collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    want = []
    for i, _, h in data:
        b = (h or "").encode()
        same = [j for j, _, g in data if (g or "") == (h or "") and j is not None]
        owner = max(same) if len(b) >= 1000 and same else i
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if owner == i else "revisit", None if owner == i else owner))
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: (r[0] is None, r[0] or 0))
    assert warc.roundtrip(pages.limit(0)).count() == 0


def test_warc_members_and_damage():
    archive = b"".join(warc.page_record(i, "http://x/", "y" * i * 3000, 7 if i == 3 else None) for i in range(1, 6))
    got = list(warc.read_archive(io.BytesIO(archive)))
    assert [r["page_id"] for r in got] == [1, 2, 3, 4, 5] and got[2]["refers_to"] == 7 and got[2]["payload"] is None
    assert got[4]["payload"] == b"y" * 15000
    with pytest.raises((warc.WarcError, zlib.error)):
        list(warc.read_archive(io.BytesIO(archive[:-5])))
    plain = gzip.decompress(warc.page_record(1, "u", "payload", None))
    for bad in (plain.replace(b"payload", b"pAyload"), plain[:-1], plain.replace(b"WARC/1.1", b"HTTP"), plain + b"x", plain[:20], plain.replace(b"Content-Length: ", b"Content-Length: x")):
        with pytest.raises(warc.WarcError):
            warc.parse(bad)
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(io.BytesIO(gzip.compress(bad))))


def test_too_long_a_record_stops_the_reader_early():
    bomb = b"WARC/1.1\r\nContent-Length: 3\r\n\r\n" + b"x" * 50_000_000
    stream = io.BytesIO(gzip.compress(bomb) + b"never read" * 100_000)
    with pytest.raises(warc.WarcError, match="longer"):
        list(warc.records(stream))
    assert stream.tell() <= warc.READ
    frame = warc.Frame()
    for b in warc_bytes(plain := gzip.decompress(warc.page_record(5, "u", "é" * 900, None))):
        frame.feed(b)
    assert frame.whole() == warc.parse(plain)


def warc_bytes(data):
    return (data[i : i + 1] for i in range(len(data)))


# ---- mixing ----


def test_targets_are_shared_and_capped():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    got = mixing.targets([10, 100, 1000], [1, 2, 3])
    assert got[0] == 30 and got[1] == 300 and abs(got[2] - 780) < 1e-9
    assert mixing.targets([0, 5], [1, 2]) == [0.0, 5.0] and mixing.targets([], []) == []


def test_permutation_is_a_bijection():
    for n in (1, 2, 3, 10, 64, 1000):
        for key in (0, 12345):
            image = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(image.tolist()) == list(range(n))


def test_draws_pay_what_is_owed():
    owed = np.array([5, 0, 1000, 333])
    shards = list(mixing.draw_shards(owed, 64, 1))
    assert (sum(shards) == owed).all() and all(s.sum() == 64 for s in shards[:-1])


def test_groups_of_shards_make_whole_shards(docs, monkeypatch):
    plain = mixing.Mix(docs, block=4, shard=16, bin_words=500)
    monkeypatch.setattr(mixing, "GROUPS", 7)
    grouped = mixing.Mix(docs, block=4, shard=16, bin_words=500)
    counts = [[tuple(r) for r in m.slots.groupBy("src").count().orderBy("src").collect()] for m in (plain, grouped)]
    assert counts[0] == counts[1]
    shards = [r["count"] for r in grouped.slots.groupBy("shard").count().orderBy("shard").collect()]
    assert set(shards[:-1]) == {16} and len(shards) == -(-sum(shards) // 16) > 100
    assert [r.shard for r in grouped.slots.select("shard").distinct().orderBy("shard").collect()] == list(range(len(shards)))
    times = [{r["n"] for r in m.slots.groupBy("src", "block").agg(F.count("*").alias("n")).collect()} for m in (plain, grouped)]
    assert times[0] == times[1]


def test_mix(docs, rows, empty):
    got = [tuple(r) for r in mixing.mix(docs, block=4, shard=16, bin_words=500).select("doc_id", "source", "size", "source_size", "target", "taken").collect()]
    again = [tuple(r) for r in mixing.mix(docs.repartition(2), block=4, shard=16, bin_words=500).select("doc_id", "source", "size", "source_size", "target", "taken").collect()]
    key = lambda r: tuple((x is None, x) if x is not None else (True, 0) for x in r)
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    goals = dict(zip(order, mixing.targets([sizes[s] for s in order], mixing.cyclic_weights(len(order)))))
    for s in order:
        mine = [r for r in got if r[1] == s]
        assert {r[3] for r in mine} == {sizes[s]} and all(abs(r[4] - goals[s]) < 1e-6 for r in mine)
        assert abs(sum(r[5] for r in mine) - goals[s]) <= 0.5
    assert all(0 <= r[5] <= 3 * r[2] for r in got)
    assert mixing.mix(empty).count() == 0


def test_taken_agrees_with_laying_out_the_words(docs, rows):
    """Words laid out one by one as the docstring says, and counted in every slot."""
    m = mixing.Mix(docs, block=7, shard=16, bin_words=300)
    words: dict[int, list[int]] = {}
    for r in sorted(m.placed.collect(), key=lambda r: (r.src, r.bin, r["at"])):
        laid = words.setdefault(r.src, [])
        laid += [r.rid] * r["size"]
    assert {len(x) for x in words.values()} == {r.source_size for r in m.sources.collect()} and len({r.bin for r in m.placed.collect()}) > 20
    taken: dict[int, int] = {}
    uses: dict[tuple[int, int], int] = {}
    for s in m.slots.collect():
        uses[s.src, s.block] = uses.get((s.src, s.block), 0) + 1
        for rid in words[s.src][7 * s.block :][: 7 if s["first"] < 0 else s["first"]]:
            taken[rid] = taken.get(rid, 0) + 1
    of = {r.rid: (r.doc_id, r.source, r["size"]) for r in m.placed.collect()}
    expected = sorted(((*map(str, of[k]), taken.get(k, 0)) for k in of))
    assert sorted((str(r.doc_id), str(r.source), str(r["size"]), r.taken) for r in m.taken().collect()) == expected
    for src in filter(words.get, words):  # every block equally often, but for the last round
        counts = [uses.get((src, b), 0) for b in range(-(-len(words[src]) // 7))]
        assert max(counts) - min(counts) <= 1


def test_small_sources_meet_their_targets(spark):
    small = [(i, " ".join("w" * n), s) for i, (s, n) in enumerate([("a", 40), ("b", 40), ("c", 40), ("d", 1), ("e", 0), ("f", 200), (None, 3)])]
    got = mixing.mix(spark.createDataFrame(small, "doc_id long, text string, source string")).collect()
    assert all(abs(r.taken - r.target) <= 0.5 and r.taken <= 3 * r["size"] for r in got) and len(got) == 7
    rng = random.Random(3)
    for _ in range(200):
        size, block = np.array([rng.randint(0, 300) for _ in range(4)]), rng.randint(1, 90)
        words = np.array([rng.randint(0, 3 * n) for n in size.tolist()])
        dues = mixing.Dues.of(size, words, block)
        for i in range(4):
            slots = np.arange(dues.slots()[i])
            at, first = dues.filled(np.full(len(slots), i), slots, np.full(len(slots), i))
            length = np.minimum(block, size[i] - at * block)
            assert np.where(first < 0, length, first).sum() == words[i] and (first <= length).all() and (at >= 0).all()


# ---- token counts ----


def test_token_counts_agree_with_the_public_tokenizer(spark, docs, rows, empty):
    import sentencepiece
    from tokenizers import Tokenizer, models, pre_tokenizers

    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    vocabulary = [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]
    reference = Tokenizer(models.Unigram(vocabulary, 0, True))
    reference.pre_tokenizer = pre_tokenizers.Metaspace("▁", "always", True)
    counter = token_counts.load(VOCABULARY)
    rng = random.Random(5)
    texts = ["", " ", "  a", "a  b ", "\n", "x\ny\t z", "漢字 word", "▁x ▁▁", "😀😀a", "<s> </s> <0x0A> <unk>", "é́ñ", "\u0000\u0001"]
    texts += ["".join(rng.choices("abcdeéß漢 \n.,'😀<>0x1", k=rng.randint(1, 60))) for _ in range(400)]
    texts += [r[1] for r in rows[:30] if r[1]]
    for t in texts:
        assert counter.text(t)[0] == len(reference.encode(t, add_special_tokens=False).ids), repr(t)
    got = token_counts.token_counts(docs, VOCABULARY).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.n_tokens, r.score) for r in got} == {(r[0], *counter.text(r[1])) for r in rows}
    assert token_counts.token_counts(empty, VOCABULARY).count() == 0


def test_ties_take_the_piece_that_starts_earliest():
    counter = token_counts.Counter([("<unk>", 0.0), ("▁", 0.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0)])
    assert counter.viterbi("▁aaa") == (2, -3.0)


# ---- licenses ----


def test_license_matches_and_spans(spark, empty):
    mit = licenses.TEMPLATES["mit-grant"]
    damaged = " ".join(w for i, w in enumerate(mit.split()) if i % 12 != 7)
    rows = [
        (1, "Some text. Released under the MIT License. More."), (2, f"é intro\n{mit.upper()}\nend"), (3, f"x {damaged} y"), (4, None), (5, ""),
        (6, "released under the mit"), (7, "Released under the MIT License. " * 2), (8, " ".join(mit.split()[:20])), (9, "word " * 50_000 + "Licensed under CC BY-NC 4.0."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for clash in ("license", "owner", "span_start", "n_words", "coverage"):
        docs = docs.withColumn(clash, F.lit(1))
    got = {}
    for r in licenses.scan(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == {1, 2, 3, 7, 9}
    assert got[1][0].license == "mit-notice" and rows[0][1].encode()[got[1][0].span_start : got[1][0].span_end] == b"Released under the MIT License"
    assert got[2][0].license == "mit-grant" and got[2][0].coverage == 1.0
    assert got[3][0].license == "mit-grant" and 0.8 <= got[3][0].coverage < 1
    assert [(r.license, r.coverage, r.n_words) for r in got[7]] == [("mit-notice", 1.0, 5)] * 2
    assert got[9][0].license == "cc-by-nc-4.0-notice"
    assert licenses.scan(empty).count() == 0


def test_each_copy_of_a_notice_is_found():
    index = licenses.Index(licenses.TEMPLATES)
    for k, (name, notice) in enumerate(licenses.TEMPLATES.items()):
        if not name.endswith("-notice"):
            continue
        n = len(index.words[k])
        for copies in (2, 3, 7):
            got = [x for x in index.scan(licenses._words(f"Here. {notice * copies}")) if x[0] == k]
            assert got == [(k, 1.0, 1 + i * n, 1 + (i + 1) * n) for i in range(copies)], name


def _whole_coverage(template, text):
    """Longest common subsequence of a template and a whole text, over the template's words."""
    row = [0] * (len(text) + 1)
    for w in template:
        before = row[:]
        for j, x in enumerate(text):
            row[j + 1] = before[j] + 1 if w == x else max(before[j + 1], row[j])
    return row[-1] / len(template)


def test_damaged_texts_are_recalled():
    """Words of each template dropped, changed and added; what a whole-text alignment covers by 0.8 is found where it was put."""
    rng, index = random.Random(11), licenses.Index(licenses.TEMPLATES)
    found = wanted = 0
    for k, name in enumerate(index.names):
        template = licenses.TEMPLATES[name].split()
        for rate in (0.03, 0.08, 0.14):
            for _ in range(4):
                damaged = []
                for w in template:
                    damaged += rng.choices([[w], [f"x{rng.randint(0, 99)}"], [], [w, f"y{rng.randint(0, 99)}"]], [1 - rate, rate * 0.6, rate * 0.2, rate * 0.2])[0]
                before = [f"z{rng.randint(0, 9)}" for _ in range(rng.randint(0, 40))]
                h = licenses._words(" ".join(before + damaged + before))
                if _whole_coverage(index.words[k].tolist(), h.tolist()) >= licenses.COVERAGE:
                    wanted += 1
                    hits = [x for x in index.scan(h) if x[0] == k]
                    found += bool(hits) and hits[0][2] <= len(before) + 0.25 * len(template)
    assert wanted > 180 and found >= 0.97 * wanted, (found, wanted)


def test_scan_agrees_with_aligning_every_place():
    rng, index = random.Random(5), licenses.Index(licenses.TEMPLATES)
    for text, name in (
        ("Licensed under the Apache Licence, Version 2.0", "apache-2.0-notice"), ("Licensed under CC BY-NC 3.0", "cc-by-nc-4.0-notice"),
        ("This work is licensed under the ABC General Public License, version 3.", "gpl-3.0-notice"), *((" ".join(w if i != x else "other" for i, w in enumerate("Released under the MIT License".split())), "mit-notice") for x in range(5)),
    ):
        assert [index.names[x[0]] for x in index.scan(licenses._words(text))] == [name], text
    common = "the of under license and work in".split()
    for _ in range(150):
        words = rng.choices(common, k=rng.randint(0, 15))
        for notice in rng.choices([t for t in licenses.TEMPLATES.values() if len(t) < 200], k=rng.randint(1, 3)):
            for w in notice.split():
                words += rng.choices([[w], ["other"], [], [w, "more"]], [9, 1, 1, 1])[0]
            words += rng.choices(common, k=rng.choice([0, 0, 9]))
        h = licenses._words(" ".join(words))
        if len(h) >= licenses.LEAST_WORDS:
            every = [(k, *hit) for k, t in enumerate(index.words) for hit in licenses.occurrences(t, h, range(-len(t) - 8, len(h) + 9))]
            assert index.scan(h) == sorted(every, key=lambda x: (x[2], x[0])), words
    mine = [i for i, x in enumerate(index.names) if x == "mit-notice"][0]
    hurt = "Released under the MIT License. Released under the MIT licence. Released under the MIT License."
    assert [x[1:] for x in index.scan(licenses._words(hurt)) if x[0] == mine] == [(1.0, 0, 5), (0.8, 5, 9), (1.0, 10, 15)]


def test_alignment_agrees_with_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        t = [rng.randrange(30) for _ in range(rng.randint(5, 25))]
        d = [x for x in t if rng.random() > 0.12]
        for _ in range(rng.randint(0, 2)):
            d.insert(rng.randrange(len(d) + 1), 99)
        table = [[0] * (len(d) + 1) for _ in range(len(t) + 1)]
        for i, x in enumerate(t):
            for j, y in enumerate(d):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        best = table[-1][-1] / len(t)
        if abs(len(t) - len(d)) < licenses.BAND - 3:
            got = licenses.aligned(np.array(t), np.array(d), 0)
            assert (got is None) == (best < licenses.COVERAGE) and (got is None or abs(got[0] - best) < 1e-9)
