"""Pages and vectors: the operators against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, embedding_dedup, html_text, url_rules, warc

PAGES = "page_id long, url string, html string"
VECTORS = "vec_id long, embedding array<float>, label int"
CLASH = ["row", "id", "vector", "file", "offset", "payload", "domain", "stack", "shard", "block", "rule", "host"]


def clashing(made):
    for name in CLASH:
        made = made.withColumn(name, F.lit("clash"))
    return made


# Web addresses


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host)), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


@pytest.mark.parametrize("sweep_rows", [7, 50_000])
def test_rules_match_brute_force(spark, sweep_rows):
    rng = random.Random(1)
    hosts = ["org", "example.org", "a.example.org", "EXAMPLE.org", "xexample.org", "com", "b.com", "", "net:80"]
    paths = ["", "/", "/es/", "/es/x", "/en/1", "/en/12/3", "/en", "/é/\U0001f600", "/fr/", "/%20 x"]
    rules = [url_rules.Rule(h, p, rng.choice(["allow", "block"])) for h in hosts[:7] if h != "EXAMPLE.org" for p in paths if rng.random() < 0.5]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/es/', '#x'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "http://", "HTTP://A.B.Example.ORG/es/", "a://b://org/", "http://org\n/x", "http://com/" + "y" * 50_000]
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(0, urls[0], "again"), (None, urls[1], None)]
    table = url_rules.rule_table(spark, rules)
    table = table.unionByName(table.limit(2)).unionByName(spark.createDataFrame([(None, "/", "block"), ("org", None, "block")], table.schema))
    found = url_rules.judge(clashing(spark.createDataFrame(rows, PAGES)), table, sweep_rows=sweep_rows).collect()
    assert sorted(map(repr, found)) == sorted(
        repr(type(found[0])(**dict(zip(("page_id", "host", "path", "rule", "verdict"), (i, *plain_verdict(u, rules))))))
        for i, u, _ in rows
    )


def test_hosts_and_paths_of_any_length_are_judged(spark):
    deep, long = "a." * 20_000 + "org", "/en/" + "1/" * 50_000
    rules = [*url_rules.RULES, url_rules.Rule("x.y.example.org", long, "block")]
    pages = spark.createDataFrame(
        [(1, f"http://{deep}/x", ""), (2, f"http://x.y.example.org{long}tail", ""), (3, f"http://example.org{long}", "")], PAGES
    )
    found = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge(pages, url_rules.rule_table(spark, rules)).collect()}
    assert found == {1: ("org/", "allow"), 2: (f"x.y.example.org{long}", "block"), 3: ("example.org/en/1", "block")}


def test_rules_of_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://org/", None)], PAGES)
    none = url_rules.rule_table(spark, [])
    assert [r.verdict for r in url_rules.judge(pages, none, default="block").collect()] == ["block"]
    assert url_rules.judge(pages.where("false"), url_rules.rule_table(spark, url_rules.RULES)).collect() == []


def test_a_rule_given_both_ways_blocks(spark):
    rules = [url_rules.Rule("org", "/", "block"), url_rules.Rule("ORG", "/", "allow")]
    pages = spark.createDataFrame([(1, "http://x.org/", None)], PAGES)
    assert url_rules.judge(pages, url_rules.rule_table(spark, rules)).first().verdict == "block"


# Archives


def test_archive_round_trip(spark):
    long = "é" * 60
    rows = [(5, "http://a/\r\nX: y%0A", long), (3, "http://b", long), (9, None, long), (4, "c", "short"), (6, "c", "short")]
    rows += [(7, "d", None), (8, "d", ""), (3, "http://b", long), (None, "n", long), (10, "e", "x" * 300_000), (11, "f", "\r\n\r\nWARC/1.1")]
    rows += [(100 + i, "h", "hot " * 50) for i in range(200)]
    pages = clashing(spark.createDataFrame(rows, PAGES).repartition(5))
    archive = warc.write(pages)
    found = warc.read(archive).collect()
    assert len(found) == len(rows)
    least = {}
    for i, _, html in rows:
        if i is not None:
            least[html] = min(i, least.get(html, i))
    want = []
    for i, url, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 100 and i is not None and least[html] != i
        want.append((i, url, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", least[html] if revisit else None, b"" if revisit else data))
    shaped = [(r.row_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in found]
    assert sorted(map(repr, shaped)) == sorted(map(repr, want))
    some = warc.read(archive, archive.index.where("row_id in (4, 10)"), keep_payload=False).collect()
    assert {(r.row_id, r.payload) for r in some} == {(4, None), (10, None)}


def test_archive_of_no_pages(spark):
    assert warc.read(warc.write(spark.createDataFrame([], PAGES))).collect() == []


def test_reads_are_coalesced_within_bounds():
    ranges = [(0, 10), (10, 5), (40, 10), (1000, 10), (1010, 500)]
    assert list(warc.coalesced(ranges, gap=30, most=300)) == [(0, 50, [0, 1, 2]), (1000, 10, [3]), (1010, 500, [4])]
    assert list(warc.coalesced([])) == []


# Main text

STORY = "This is the first paragraph of the story and it has a number of the words that are in the list, so that it is good."


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("<article>x&nbsp;y\n z<script>if(a<b)</script><!-- c --></article>", "x y z"),
        ("<article><p>a<br>b</p><p>1 &lt; 2<div>n</div></article>", "a b\n1 < 2\nn"),
        ("<script>never closed <article>x</article>", ""),
        ("<article><p title='a>b'>T</p><ul><li>i1<li>i2</ul><table><tr><td>c1<td>c2</table></article>", "T\ni1\ni2\nc1\nc2"),
        ("<nav><p>menu</p></nav><article><h1>H</h1><p>It.</p><aside>side</aside><p><b>open<br><p>end</article><footer>f</footer>", "H\nIt.\nopen\nend"),
        (f"<article><p>{STORY}</p><section class='user-comments'><p>{STORY}</p></section><div id=share>x</div></article>", STORY),
        (f"<body class='no-sidebar'><form><header><h1>Site</h1></header><div id=menu><a href=/>Home</a></div><h2>Title</h2><p>{STORY}<p>Short.<p>{STORY}</p><div class=cookie-notice>{STORY}</div></form>", f"Title\n{STORY}\nShort.\n{STORY}"),
        (f"<div><a href=1>one</a> <a href=2>two</a></div><p>{STORY}</p><ul><li><a href=3>three</a></ul><p>&copy; 2020 all of the rights are with us and that is the end of it for all of you.</p>", STORY),
    ],
)
def test_main_text_of_pages(html, text):
    assert html_text.main_text(html) == text


TALE = [f"This is part {i} of the tale and it is about the river that runs by the town, so it is long enough to be kept." for i in range(4)]
SAID = "This is what some of them said about the tale and it would be kept if it were not for the name of its class."
BESIDE = """
    post-comments article-comments entry-comments entry-footer page-footer content-ad body-ad main-menu
    article-share post-related usercomments reader-responses disclaimer postComments comments-area ad-slot
    comment-list leftSidebar submenu entry_footer
""".split()
AROUND = """
    no-sidebar page-with-comments has-sidebar content-sidebar-wrap layout-sidebar-main with-footer entry-header
    is-popular entry-content article-body post commented documents
""".split()


@pytest.mark.parametrize("outer", ["article", "div"])
@pytest.mark.parametrize("name", BESIDE)
def test_parts_named_for_what_they_are_go(outer, name):
    tale = "".join(f"<p>{part}</p>" for part in TALE)
    for beside in (f"<div class='{name}'><p>{SAID}</p></div>", f"<section id='{name}'><ul><li>{SAID}</ul></section>"):
        page = f"<html><body><{outer}>{tale}{beside}</{outer}></body></html>"
        assert html_text.main_text(page) == "\n".join(TALE)
        # However long they are.
        assert SAID not in html_text.main_text(page.replace(SAID, " ".join([SAID] * 40)))


@pytest.mark.parametrize("name", AROUND)
def test_wrappers_named_for_what_lies_in_them_stay(name):
    tale = "".join(f"<p>{part}</p>" for part in TALE)
    page = f"<html><body><div class='{name}'>{tale}<div class='post-comments'><p>{SAID}</p></div></div></body></html>"
    assert html_text.main_text(page) == "\n".join(TALE)


def test_an_unclear_part_with_little_text_goes():
    tale = "".join(f"<p>{part}</p>" for part in TALE)
    page = f"<html><body>{tale}<div class='sidebar-content'><p>{SAID}</p></div></body></html>"
    assert html_text.main_text(page) == "\n".join(TALE)


RUSSIAN = "Это обычный русский текст о погоде и природе, который написан для проверки того, что статья остаётся целой."
CHINESE = "这是一段用于测试的中文文本,它没有任何拉丁字母,但是它仍然是网页的正文,所以应该被保留下来。"
FINNISH = "Tämä on suomenkielinen kirjoitus, joka kertoo säästä sekä luonnosta, ja sen pitää säilyä kokonaan tallessa."
CODE = "for (int row = 0; row < rows.length; row++) { total += rows[row].price * rows[row].count; }"
NAMES = "Anna Berg, Carl Dietz, Emma Falk, Georg Hahn, Ida Jung, Karl Lenz, Maria Noll, Otto Pohl, Rosa Stein"
MENU = "<div><a href=1>one</a> <a href=2>two</a></div>"


@pytest.mark.parametrize("lines", [[RUSSIAN], [CHINESE], [FINNISH], [RUSSIAN, FINNISH], [STORY, CODE, NAMES, STORY], [STORY, RUSSIAN]])
def test_long_blocks_without_known_words_stay(lines):
    paragraphs = "".join(f"<p>{line.replace('<', '&lt;')}</p>" for line in lines)
    assert html_text.main_text(f"<body>{MENU}<div>{paragraphs}</div>{MENU}</body>") == "\n".join(lines)


def test_second_pass_takes_the_nearest_label():
    labels = ["near", "bad", "near", "near", "good", "near", "near", "bad", "near"]
    kept = html_text.second_pass(labels, [False] * 9)
    assert kept == [False, False, False, True, True, True, False, False, False]
    assert html_text.second_pass(["near", "near"], [False, True]) == [False, False]


def test_markup_never_takes_long():
    for html in ('<a b="' * 20_000, '<a b="' * 20_000 + ">", "<p " + "'\"" * 90_000, "<div>" * 9000 + "</b>" * 9000, "<" * 90_000):
        assert len(html_text.main_text(html)) <= len(html)


def test_extract_keeps_rows(spark):
    rows = [(1, "u", "<article>a</article>"), (1, "u", "<article>a</article>"), (2, None, None), (3, "", "<article>" + "w " * 90_000)]
    made = clashing(spark.createDataFrame(rows, PAGES))
    found = made.select("page_id", html_text.extract(F.col("html")).alias("t")).collect()
    assert sorted((r.page_id, len(r.t)) for r in found) == [(1, 1), (1, 1), (2, 0), (3, 179_999)]


# Vectors


def odd_vectors():
    nan, inf = float("nan"), float("inf")
    return [None, [], [0.0] * 16, [nan] + [1.0] * 15, [inf] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 3]


def vector_rows(seed, n=400):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, 16))
    near = [base[i % 5] + rng.standard_normal(16) * 0.05 for i in range(120)]
    made = [*base, *near, *[base[7]] * 30, *[base[8] * 2] * 3, base[8]]
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(made)]
    rows += [(9000 + i, v, 1) for i, v in enumerate(odd_vectors())] + [(None, rows[0][1], 0)]
    return rows


def usable(rows):
    return [(i, np.array(v)) for i, v, _ in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]


def test_near_vectors_match_brute_force(spark):
    rows = vector_rows(1)
    good = usable(rows)
    ids, vectors = np.array([i for i, _ in good]), np.array([v for _, v in good])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    roots = ids.copy()
    while True:
        least = np.minimum(roots, np.where(linked, roots[None, :], 10**9).min(axis=1))
        if (least == roots).all():
            break
        roots = least
    found = embedding_dedup.near_duplicates(clashing(spark.createDataFrame(rows, VECTORS))).collect()
    assert len(found) == len(rows)
    by_id = {r.vec_id: r for r in found if r.vec_id is not None}
    links = np.array([by_id[i].n_links for i in ids])
    assert links.sum() >= 0.99 * linked.sum() and (links <= linked.sum(axis=1)).all()
    assert [by_id[i].component_id for i in ids] == roots.tolist()
    assert all(r.n_links == 0 and r.kept for r in found if r.vec_id is None or r.vec_id >= 9000)
    assert all(r.kept == (r.vec_id == r.component_id) for r in by_id.values())


def test_crowded_buckets_are_cut(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rows = vector_rows(2, 100)
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    good = usable(rows)
    vectors = np.array([v for _, v in good])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    assert [found[i].n_links for i, _ in good] == linked.tolist()


def test_equal_vectors_and_none(spark):
    same = spark.createDataFrame([(4, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (2, [1.0, 2.0], 1)], VECTORS)
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(same).orderBy("vec_id").collect()] == [
        (2, 2, 2, True), (2, 2, 2, True), (4, 2, 2, False)]
    for none in (same.where("false"), spark.createDataFrame([(1, None, 0)], VECTORS)):
        assert embedding_dedup.near_duplicates(none).count() == none.count()
        assert ann.search(none, F.lit(True)).collect() == []


def test_codes_are_balanced():
    rng = np.random.default_rng(3)
    unit = rng.standard_normal((2000, 16)) + 0.5
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    tables = embedding_dedup.learn_tables(unit, 5000)
    for centre, projection in tables.codes:
        share = ((unit - centre) @ projection > 0).mean(axis=0)
        assert share.min() > 0.35 and share.max() < 0.65
    assert tables.keys(unit).shape == (2000, tables.count)


@pytest.mark.parametrize("common", [0.0, 0.3, 0.6])
def test_pairs_at_the_threshold_meet_whatever_the_mean(common):
    rng = np.random.default_rng(6)

    def drawn(count):
        loose = rng.standard_normal((count, 64))
        loose *= np.sqrt(1 - common) / np.linalg.norm(loose, axis=1, keepdims=True)
        loose[:, 0] += np.sqrt(common)
        return loose / np.linalg.norm(loose, axis=1, keepdims=True)

    tables = embedding_dedup.learn_tables(drawn(2000), 51_200)
    one = drawn(4000)
    away = rng.standard_normal(one.shape)
    away -= (away * one).sum(axis=1, keepdims=True) * one
    other = 0.9 * one + np.sqrt(0.19) * away / np.linalg.norm(away, axis=1, keepdims=True)
    assert (tables.keys(one) == tables.keys(other)).any(axis=1).mean() >= 0.98
    assert tables.bits >= 6


@pytest.mark.parametrize("lengths", [False, True])
def test_nearest_match_brute_force(spark, monkeypatch, lengths):
    monkeypatch.setattr(ann, "SHARD_ROWS", 300)
    monkeypatch.setattr(ann, "QUERY_ROWS", 17)
    rows = vector_rows(4, 900)
    if lengths:
        rows = [(i, [float(np.float32(x * (1 + i % 3))) for x in v] if v and None not in v else v, n) for i, v, n in rows if i is not None]
    asked = F.col("vec_id") % 20 == 0
    found = ann.search(clashing(spark.createDataFrame(rows, VECTORS)), asked, rerank=300).collect()
    good = usable(rows)
    ids, vectors = np.array([i for i, _ in good]), np.array([v for _, v in good])
    hits = total = 0
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append(r)
    assert set(by_query) == {i for i in ids if i % 20 == 0}
    for place, i in enumerate(ids):
        if i % 20:
            continue
        scores = vectors @ vectors[place]
        scores[place] = -np.inf
        order = np.lexsort((ids, -scores))[:20]
        rows_of = sorted(by_query[i], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows_of] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in rows_of] == sorted((-r.score, r.vec_id) for r in rows_of)
        assert all(abs(r.score - scores[np.searchsorted(ids, r.vec_id)]) < 1e-9 for r in rows_of)
        hits += len({r.vec_id for r in rows_of} & set(ids[order].tolist()))
        total += 20
    assert hits / total >= 0.9


def test_footrule_of_the_inverted_file():
    orders = np.array([[0, 1, 2], [2, 1, 0], [3, 4, 5], [1, 0, 5]], dtype=np.int16)
    files = ann.InvertedFile(orders, 6)

    def plain(a, b):
        places = [{p: i for i, p in enumerate(x)} for x in (a, b)]
        return sum(abs(places[0].get(p, 3) - places[1].get(p, 3)) for p in set(a) | set(b))

    for query in orders:
        assert files.footrule(query).tolist() == [plain(query.tolist(), o.tolist()) for o in orders]


def test_copies_neither_crowd_out_nor_depend_on_arrival(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 200)
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(900, 12))
    vectors[rng.permutation(900)[:300]] = vectors[7]
    rows = [(int(i) * 5, v.tolist(), 0) for i, v in enumerate(vectors)]
    answers = []
    for order in (rows, rows[::-1], [rows[i] for i in rng.permutation(900)]):
        made = spark.createDataFrame(order, VECTORS).repartition(5)
        answers.append(sorted(map(tuple, ann.search(made, F.col("vec_id") % 20 == 0, rerank=60).collect())))
    assert answers[0] == answers[1] == answers[2]
    found, shares = {}, []
    for query, _, near, _ in answers[0]:
        found.setdefault(query, set()).add(near)
    ids = np.array([i for i, _, _ in rows])
    for i, vector, _ in rows:
        if i % 20 == 0:
            scores = np.where(ids == i, -np.inf, vectors @ vector)
            shares.append(len(found[i] & set(ids[np.lexsort((ids, -scores.round(9)))[:20]].tolist())) / 20)
    assert np.mean(shares) >= 0.9 and np.mean(sorted(shares)[: len(shares) // 10]) >= 0.6


def test_nothing_to_search(spark):
    none = spark.createDataFrame([], VECTORS)
    assert ann.search(none, F.col("vec_id") % 20 == 0).collect() == []


def test_fewer_candidates_than_asked(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (20, [1.0, 0.0], 0), (3, [0.5, 1.0], 0)], VECTORS)
    found = ann.search(few, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in found] == [
        (0, 1, 20, 1.0), (0, 2, 3, 0.5), (20, 1, 0, 1.0), (20, 2, 3, 0.5)]
