"""Vector codes, hard negatives and page templates against brute force, with nulls, ties, repeated rows and odd pages."""

from __future__ import annotations

import hashlib
import html
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from accountlens.llm import hard_negatives as hn
from accountlens.llm import html_templates as ht
from accountlens.llm import vector_codes as vc

VECTORS = "vec_id long, embedding array<float>, label int, code string, cells string, __group int, v int, id long"


def vector_rows(n=150, dim=16, seed=3):
    """Vectors with few distinct values (ties), a hot copy, repeated rows and ids, nulls, NaN and infinities."""
    rng = random.Random(seed)

    def vector():
        return [rng.randint(-9, 9) / 8 + (rng.random() / 64 if rng.random() < 0.3 else 0) for _ in range(dim)]

    hot = vector()
    rows = [(i, hot if i % 3 == 0 else vector(), rng.choice([0, 0, 0, 1, 2, None]), "x", "y", 1, 2, 3) for i in range(n)]
    rows += [(n, None, 1, "x", "y", 1, 2, 3), (n + 1, [None] * dim, 1, "x", "y", 1, 2, 3), (None, vector(), 1, None, None, None, None, None),
             (n + 2, [math.nan] * dim, 1, "x", "y", 1, 2, 3), (n + 3, [math.inf] + [0.0] * (dim - 1), None, "x", "y", 1, 2, 3),
             (4, vector(), 2, "x", "y", 1, 2, 3)]
    return rows + rows[:5]


def kept(rows):
    out = []
    for r in rows:
        v = r[1]
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((r[0], [float(np.float32(x)) for x in v], r[2]))
    return out


# vector codes

@pytest.mark.parametrize("entries,dim,spread", [(16, 8, 5), (16, 1, 3), (130, 4, 9), (3, 2, 10**6), (64, 3, 50), (65, 3, 50)])
def test_slices_find_the_nearest_entry(entries, dim, spread):
    rng = np.random.default_rng(entries + dim)
    book = rng.integers(-spread, spread + 1, (entries, dim))
    book[entries // 2] = book[0]  # an entry twice: the lower index wins
    x = rng.integers(-2 * spread, 2 * spread + 1, (500, dim))
    entry, distance = vc.Slices(book).nearest(x)
    full = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (entry == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_slices_leave_few_candidates_and_never_lose_the_nearest():
    rng = np.random.default_rng(1)
    book = rng.integers(-1000, 1000, (64, 6))
    x = book[rng.integers(0, 64, 300)] + rng.integers(-20, 21, (300, 6))
    slices = vc.Slices(book)
    radius = np.full(300, 60)
    masks = slices.candidates(x, radius)
    inside = (np.abs(x[:, None, :] - book[None]) <= 60).all(axis=2)
    assert (((masks[:, slices.word] >> slices.bit) & np.uint64(1)).astype(bool) == inside).all()
    assert inside.sum() < 2 * 300


def fitted(rows, parts=8, entries=16, rounds=6, scale=4096):
    rows = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in kept(rows)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    step = len(rows[0][1]) // parts

    def part(v, p):
        return v[p * step:(p + 1) * step]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x)), k) for k, e in enumerate(book))

    books = [[part(v, p) for _, v, _ in rows[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, v, _ in rows:
                groups[nearest(books[p], part(v, p))[1]].append(part(v, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if groups[k] else e for k, e in enumerate(books[p])]
    out, by_label = [], Counter()
    for i, v, label in rows:
        found = [nearest(books[p], part(v, p)) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, c, e, by_label[label]) for i, c, e, label in out), digest


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_codes_equal_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(vc, "BROADCAST_GROUPS", broadcast)
    rows = vector_rows()
    vectors = vc.CodedVectors(spark.createDataFrame(rows, VECTORS).repartition(5), "embedding", ["vec_id", "label"], block_rows=16)
    coded = vc.with_group_sum(vectors.codes(), "label", "error", "label_error").collect()
    expected, digest = fitted(rows)
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in coded) == expected
    assert vectors.digest() == digest


def test_codes_of_few_rows_none_and_wrong_lengths(spark):
    rows = vector_rows(5)[:4]
    vectors = vc.CodedVectors(spark.createDataFrame(rows, VECTORS), "embedding", ["vec_id", "label"])
    assert vectors.digest() == fitted(rows)[1]
    assert Counter((r.vec_id, r.code) for r in vectors.codes().collect()) == Counter(k[:2] for k in fitted(rows)[0].elements())
    none = vc.CodedVectors(spark.createDataFrame([], VECTORS), "embedding", ["vec_id", "label"])
    assert none.codes().collect() == [] and none.digest() == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError, match="equal parts"):
        vc.CodedVectors(spark.createDataFrame([(1, [0.5] * 9)], "i long, v array<double>"), "v", ["i"])
    with pytest.raises(Exception, match="different lengths"):
        vc.CodedVectors(spark.createDataFrame([(1, [0.5] * 8), (2, [0.5] * 16)], "i long, v array<double>"), "v", ["i"]).codes().collect()


def test_group_sum_replaces_a_column_and_keeps_clashing_ones(spark):
    df = spark.createDataFrame([(1, 5, 0, 0), (1, 6, 0, 0), (None, 7, 0, 0), (None, 1, 0, 0)], "g int, x long, total long, __group int")
    assert sorted(map(tuple, vc.with_group_sum(df, "g", "x", "total").select("x", "total", "__group").collect())) == [
        (1, 8, 0), (5, 11, 0), (6, 11, 0), (7, 8, 0)]


# hard negatives

@pytest.mark.parametrize("dim", [64, 16, 5, 1])
def test_segment_summaries_bound_the_score_ever_closer(dim):
    rng = np.random.default_rng(dim)
    x = np.floor(rng.normal(0, 40, (50, dim)) + rng.normal(0, 40, (50, 1)))
    x[0], x[1] = 0, 7  # no deviation
    score = x @ x.T
    slack = None
    for mean, deviation in hn.summaries(x):
        middle, spread = mean @ mean.T, deviation @ deviation.T
        assert (middle - spread <= score).all() and (score <= middle + spread).all()
        assert slack is None or spread.sum() <= slack * (1 + 1e-9)
        slack = spread.sum()


def brute_negatives(rows, every, positives=5, negatives=3, scale=256):
    rows = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in kept(rows) if label is not None]
    last = 1 << 62
    out = []
    for n, (i, v, label) in enumerate(rows):
        if i is None or i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), last if j is None else j, m, j, l) for m, (j, w, l) in enumerate(rows) if m != n))
        for minus, _, _, j, _ in [s for s in scored if s[4] == label][:positives]:
            fits = [s for s in scored if s[4] != label and 50 * -minus <= 100 * -s[0] <= 95 * -minus]
            out += [(i, j, rank + 1, s[3], -minus, -s[0]) for rank, s in enumerate(fits[:negatives])]
    return Counter(out)


@pytest.mark.parametrize("wave_bytes,levels", [(1, (1, 4, 16)), (16 << 20, (1, 4, 16)), (40 * 16 * 8, (2,))])
def test_negatives_equal_brute_force(spark, wave_bytes, levels):
    rows = vector_rows(200)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    mined = hn.HardNegatives(df, "vec_id", "embedding", "label", F.col("vec_id") % 3 == 0, block_rows=32, levels=levels,
                             wave_bytes=wave_bytes)
    assert mined.waves > 1 if wave_bytes < 16 << 20 else mined.waves == 1
    expected = brute_negatives(rows, 3)
    assert len(expected) > 100
    assert Counter(map(tuple, mined.mine().collect())) == expected


def test_negatives_of_nothing(spark):
    for rows in ([], [(1, [1.0, 2.0], 1)], [(50, None, 1), (50, [1.0], None)]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        found = hn.HardNegatives(df, "vec_id", "embedding", "label", F.col("vec_id") % 50 == 0).mine()
        assert found.collect() == [] and found.columns == [c.split()[0] for c in hn.NEGATIVE_SCHEMA.split(", ")]


def test_segment_bounds_strike_out_most_pairs_of_clustered_vectors():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 60, (40, 8)).repeat(8, axis=1)  # each segment of 8 components of its own height
    label = rng.integers(0, 40, 3000)
    x = np.floor(centres[label] + rng.normal(0, 4, (3000, 64)))

    def vectors(rows):
        return hn.Vectors(rows, label[rows], np.zeros(len(rows), dtype=int), rows, x[rows], [(m[rows], d[rows]) for m, d in levels])

    levels = hn.summaries(x, (1, 8))
    anchors, rest = vectors(np.arange(0, 3000, 50)), vectors(np.arange(3000))
    infinite = np.full((60, 1), np.inf)
    best = hn.Best(-infinite, infinite, 5)
    hn.search(anchors, rest, best, True)
    positive = best.score[:, 0]
    found = hn.Best(np.ceil(positive / 2), np.floor(95 * positive / 100), 3)
    struck = [0, 0, 0]
    for start in range(0, 3000, 200):
        hn.search(anchors, rest.take(np.arange(start, start + 200)), found, False, struck)
    assert struck[2] < struck[0] / 10
    scores = x[::50] @ x.T
    for a in range(60):
        fits = np.where((label != label[a * 50]) & (scores[a] >= np.ceil(positive[a, 0] / 2)) & (scores[a] <= np.floor(0.95 * positive[a, 0])), scores[a], -np.inf)
        assert (np.sort(fits)[::-1][:3] == found.score[a, 0]).all()


# main text of pages

@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), (" \n ", ""), ("plain & simple", "plain & simple"), ("<p>a<p>b", "a\nb"), ("<p>a<br>b</p>", "a b"),
    ("<p>a &lt; b &amp;amp; c&nbsp;&#233;&eacute</p>", "a < b &amp; c éé"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<p>a<!-- <p>no</p> -->b</p><!-- never closed <p>x", "ab"), ("<!--><p>a</p>", "a"), ("<p>a</p><script>var t='</p><p>x'</script><p>b", "a\nb"),
    ("<article><h1>T</h1><p><b>one<br><p>two</article><footer>f</footer>", "T\none\ntwo"),
    ("<p title=\"a > b\">x</p>", "x"), ("<p title=\"open>x</p><p>y</p>", "x\ny"), ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"), ("<table><tr><td>a<td>b<tr><th>c</table>", "a\nb\nc"),
    ("<p>a <a href=x>link</a> b</i></p>", "a link b"), ("<div class='has-sidebar'>a</div><div class='left-sidebar'>b</div>", "a"),
    ("<div hidden>a</div><div style='display: none'>b</div><p>c", "c"), ("<SCRIPT>x</SCRIPT ><P>a</P>", "a"), ("<script>x", ""),
    ("<header>site</header><article><header><h1>T</h1></header><p>a</p><div class=comments>c</div><form>f</form></article>", "T\na"),
    ("<main><h1>T</h1><div class=cookieBar>c</div><p>a</p></main><div>other</div>", "T\na"),
    ("<nav>n</nav><div id='content'><p>" + "long " * 9 + "</p></div><div>x</div>", ("long " * 9).strip()),
    ("<article>a</article><article class='teaser'>b</article>", "a"), ("<p>a</p></div></div></p><p>b", "a\nb"), ("<p>a<", "a<"), ("<p>a</", "a</"),
])
def test_main_text_of_odd_pages(page, text):
    assert ht.main_text(page) == text


@pytest.mark.parametrize("piece", ["<p>word ", "<div>", "<div>x", "<ul><li>x", "<a \"", "<a href='>x", "<b>x", "<!--", "</div>", "<li>x",
                                   "<script>", "&", "<", "</", "w " * 20])
def test_very_long_pages_are_read_in_linear_time(piece):
    took = []
    for size in (20_000, 200_000):
        start = time.time()
        ht.main_text(piece * (size // len(piece)) + "end")
        took.append(time.time() - start)
    assert took[1] < 40 * max(took[0], 0.02)


WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu".split()


def site(host, n, seed, shared=True):
    """Pages of one site whose parts are told by no name: a name, a menu, a notice on every second page, the text, links, a foot."""
    rng = random.Random(seed)

    def words(k=12):
        return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(k))

    rows = []
    for i in range(n):
        text = [f"Title {words(3)}", *[words() for _ in range(rng.randint(1, 5))]]
        if shared and i % 3 == 0:
            text.append("A passage that many pages share word for word.")
        page = "<html><body><div class=t7><span>My Site</span></div><ul class=m><li><a href=/>Home</a><li><a href=/b>About</a></ul>"
        if i % 2:
            page += "<div class=x9><p>We use them, accept?</p><p>Yes</p></div>"
        page += f"<div class=z1><h1>{text[0]}</h1>" + "".join(f"<p>{p}" for p in text[1:])
        page += f"</div><div class=q><a href=1>{words(3)}</a> <a href=2>{words(3)}</a></div><div id=comments><p>{words()}</p></div>"
        rows.append((i, f"https://{host}/a{i}", page + "<div class=b5>All kept</div></body></html>", "\n".join(text)))
    return rows


@pytest.mark.parametrize("broadcast_bytes", [32 << 20, 0])
def test_the_template_of_a_host_is_left_out(spark, broadcast_bytes):
    rows = site("Big.example", 24, 1) + site("small.example", 7, 2)
    odd = [(100, None, "<p>no address</p>", None), (101, "https://one.example/x", None, None), (102, "no host", "", None), (None, None, None, None)]
    copies = [(200 + i, "https://copies.example/", "<p>one text</p><p>on all copies</p>", None) for i in range(6)]
    df = spark.createDataFrame([(*r[:3], "old", 7, "x") for r in rows + rows[:4] + odd + copies],
                               "page_id long, url string, html string, text string, __host int, __template string")
    got = ht.extract(df, broadcast_bytes=broadcast_bytes)
    assert got.columns == ["page_id", "url", "html", "__host", "__template", "text", "n_chars"]
    expected = Counter([(r[0], r[1], r[3]) for r in rows + rows[:4]])
    expected += Counter([(100, None, "no address"), (101, odd[1][1], ""), (102, "no host", ""), (None, None, "")])
    expected += Counter((200 + i, copies[0][1], "one text\non all copies") for i in range(6))
    result = got.collect()
    assert Counter((r.page_id, r.url, r.text) for r in result) == expected
    assert all(r.n_chars == len(r.text) and r["__host"] == 7 for r in result)


def test_classes_equal_brute_force_occurrence_vectors(spark):
    rows = site("a.example", 15, 4) + site("b.example", 9, 5, shared=False)
    df = spark.createDataFrame([(r[1][8:17], r[2]) for r in rows], "host string, html string")
    got = {r.host: ht.read_template(r.template) for r in ht.host_templates(df, "host", "html").collect()}
    for host in ("a.example", "b.example"):
        pages = [ht.page_tokens(r[2]) for r in rows if r[1][8:17] == host]
        where, longest, own, places = defaultdict(set), defaultdict(set), {}, defaultdict(list)
        for n, tokens in enumerate(pages):
            for token, element, place, signature, _, _ in tokens:
                if element != 1:
                    where[token].add(n)
                    longest[token].add(signature)
                    own[token] = element
                    places[token].append(place)
        classes = defaultdict(set)
        for token, found in where.items():
            if len(found) >= 3:
                classes[frozenset(found)].add(token)
        expected = {frozenset(c) for c in classes.values() if any(own[t] in c and own[t] and len(longest[t]) > 1 for t in c)}
        mine = defaultdict(list)
        for token, (number, order, element) in got[host].tokens.items():
            assert element == own[token]
            mine[number].append((order, token))
        assert {frozenset(t for _, t in c) for c in mine.values()} == expected and len(expected) >= 2
        sizes = [len(where[sorted(mine[n])[0][1]]) for n in sorted(mine)]
        assert sizes == sorted(sizes, reverse=True)
        for c in mine.values():
            means = [np.mean(places[t]) for _, t in sorted(c)]
            assert means == sorted(means)


def test_a_class_out_of_order_is_not_used_and_one_in_two_gaps_is_split():
    page = "<div class=a>one</div><div class=b>two</div><p>x</p><div class=c>three</div>"
    one, two, x, three = ht.blocks(page)

    def template(*classes):
        members = [",".join(f"{t}:{e}" for t, e in c) for c in classes]
        return ht.read_template(";".join(members) + "||")

    def pair(b):
        return [(b.element, 0), (b.token, b.element)]

    assert ht.main_text(page, template([*pair(one), *pair(two)])) == "x\nthree"
    assert ht.main_text(page, template([*pair(two), *pair(one)])) == "one\ntwo\nx\nthree"
    # the second class lies before and behind the first: two parts, each with its own element
    assert ht.main_text(page, template(pair(two), [*pair(one), *pair(three)])) == "x"
    # a text whose element is not in its part is no word of the template
    assert ht.main_text(page, template(pair(two), [(one.element, 0), (three.token, three.element)])) == "one\nx\nthree"


def test_all_pages_of_the_test_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in ht.extract(pages).collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        pieces = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(filter(None, pieces)) and r.n_chars == len(r.text)


def test_an_empty_table_of_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert ht.extract(df).collect() == []
