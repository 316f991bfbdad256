"""Classes of the HTML templates against whole occurrence vectors; odd pages; broken markup in linear time."""

from __future__ import annotations

import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rowtide.llm import html_text

PAGES = "page_id long, url string, html string"


def vectors(rows):
    """host -> {(token, is_text): ((page, n), ...)} over the different pages that have tokens."""
    found = defaultdict(lambda: defaultdict(dict))
    for host, source in {(host, source) for host, source in rows if source}:
        page = html_text.Page(source)
        texts = Counter(html_text._text_token(path, text) for path, text, *_ in page.blocks())
        if not texts and not page.tokens:
            continue
        for some, is_text in (({0: 1}, False), (page.tokens, False), (texts, True)):
            for token, n in some.items():
                found[host][token, is_text][source] = n
    return found


def template_texts(rows):
    kept = {}
    for host, tokens in vectors(rows).items():
        groups = defaultdict(list)
        for token, vector in tokens.items():
            groups[frozenset(vector.items())].append(token)
        n = len(tokens[0, False])
        valid = [
            token for vector, group in groups.items() for token, is_text in group
            if is_text and len(vector) >= max(html_text.MIN_PAGES, html_text.SUPPORT * n) and len(group) >= html_text.MIN_CLASS
        ]
        if valid:
            kept[host] = sorted(t - (1 << 64) if t >> 63 else t for t in valid)
    return kept


def page(i, rng, body="", menu="Home of all news"):
    words = " ".join(f"w{rng.randrange(5000)}" for _ in range(20))
    return f"<html><body><div><span>{menu}</span><b>{menu} too</b></div><div><p>{words}</p>{body}<p>Read more below</p></div></body></html>"


def test_classes_match_whole_vectors(spark):
    rng = random.Random(2)
    rows = []
    for host, n in (("a.org", 14), ("b.org", 25), ("c.org", 9), ("d.org", 12)):
        for i in range(n):
            body = rng.choice(["", "<p>often</p>", "<p>often</p><ul><li>x<li>x</ul>"])
            source = page(i, rng, body)
            rows += [(host, source)] * rng.choice([1, 1, 1, 3])
        rows += [(host, None), (host, ""), (host, " "), (host, "<p>gone")]
    # ten copies and more of one page are one page
    rows += [("d.org", page(99, rng))] * 30
    frame = spark.createDataFrame([(i, f"http://{h}/{i}", s) for i, (h, s) in enumerate(rows)], PAGES)
    frame = frame.withColumn("host", F.lit("mine")).withColumn("copies", F.lit(7)).withColumn("token", F.lit(0))
    got = {r.host: r.template for r in html_text.templates(frame).collect()}
    want = template_texts(rows)
    assert got == want and set(want) == {"a.org", "b.org", "d.org"}


@pytest.mark.parametrize("odd", [[""], [None], ["<html><body><h1>404</h1></body></html>"], ["", "plain text", "<div>moved</div>"]])
def test_odd_pages_leave_the_others_their_template(spark, odd):
    rng = random.Random(6)
    sources = [page(i, rng) for i in range(14)] + odd
    frame = spark.createDataFrame([(i, f"http://a.org/{i}", s) for i, s in enumerate(sources)], PAGES)
    got = {r.page_id: r.text for r in html_text.main_texts(frame).collect()}
    assert all(len(got[i].split()) == 20 and "Read" not in got[i] and "Home" not in got[i] for i in range(14))
    assert [got[14 + i] for i in range(len(odd))] == [html_text.page_text(s or "") for s in odd]


def test_copies_of_a_page_are_no_template(spark):
    rng = random.Random(8)
    sources = [page(0, rng, "<p>told once</p>")] * 40 + [page(i, rng) for i in range(5)]
    frame = spark.createDataFrame([(i, f"http://a.org/{i}", s) for i, s in enumerate(sources)], PAGES)
    assert all("told once" in r.text for r in html_text.main_texts(frame).where("page_id < 40").collect())


@pytest.mark.parametrize("broken", [
    lambda n: "<div>" * n + "</section>" * n,
    lambda n: "<i><div>" + "<b>" * n + "</i>" * n,
    lambda n: "<ul>" + "<div>" * n + "<li>" * n + "</td>" * n,
    lambda n: "<p>" * n + "</p>" * n,
    lambda n: "<li>" * n + "</ul>" * n,
    lambda n: '<a href="' * n,
])
def test_unmatched_tags_take_linear_time(broken):
    times = []
    for n in (10_000, 80_000):
        start = time.process_time()
        html_text.page_text(broken(n))
        times.append(time.process_time() - start)
    # eight times the page: 64 times the work if it were quadratic
    assert times[1] < 20 * times[0] + 0.2


def framed(sources):
    return [(i, "http://a.org/", source) for i, source in enumerate(sources)], PAGES


def test_equal_texts_have_a_role_in_each_slot(spark):
    """A text that stands in every menu is template there, and content where the article says it."""
    rng = random.Random(3)
    sources = []
    for i in range(24):
        said = ["<p>News</p>"] * (i % 3)
        sources.append(f"<div><b>Site</b><p>News</p><i>of today</i>{''.join(said)}<p>w{rng.random()}</p></div>")
    got = {r.page_id: r.text.split("\n") for r in html_text.main_texts(spark.createDataFrame(*framed(sources))).collect()}
    assert all(got[i][:-1] == ["News"] * (i % 3) and got[i][-1].startswith("w0.") for i in range(24))


def test_texts_in_changing_order_are_no_class(spark):
    """Of two texts that change places, one can be in the template's order; the other is a slot's content."""
    parts = ["<h3>left</h3>", "<h4>right</h4>"]
    sources = [f"<div><h1>Site</h1>{''.join(parts[:: 1 - 2 * (i % 2)])}<p>{i}</p><h2>End</h2></div>" for i in range(30)]
    got = [r.text for r in html_text.main_texts(spark.createDataFrame(*framed(sources))).orderBy("page_id").collect()]
    assert all(("left" in t) + ("right" in t) == 1 and "Site" not in t and "End" not in t for t in got)


@pytest.mark.parametrize("seed", range(3))
def test_trees_are_ordered_and_nested(spark, seed):
    """On every page, tokens of the tree open, go on with and close classes like brackets, each in one slot of one class."""
    rng = random.Random(seed)
    sources = []
    for i in range(40):
        links = "".join(f"<li><a>x{rng.randrange(3)}</a><b>more</b>by<em>us</em></li>" for _ in range(rng.randrange(1, 4)))
        swapped = "".join(rng.sample(["<h3>s</h3>", "<h4>t</h4>", "<h5>u</h5>"], 3))
        often = "<section><q>a</q><div>b</div><div>c</div></section>" * (rng.random() < 0.7)
        both = [f"<ul>{links}</ul>", often] if rng.random() < 0.5 else [often, f"<ul>{links}</ul>"]
        sources.append(f"<div><u>go</u><div>on</div>{swapped}<p>{rng.random()}</p><div><u>go</u></div>{''.join(both)}</div>")
    frame = spark.createDataFrame(*framed(sources))
    nodes = html_text.trees(frame)
    assert nodes.where("level > 1").count() > 0
    [packed] = html_text._packed(nodes).toArrow().column("nodes").combine_chunks()
    tree = html_text._Tree(packed.values)
    slots = defaultdict(set)
    for source in sources:
        tokens, _ = html_text.Page(source).sequence()
        open_classes = []
        for node in tree.roles(tokens, html_text.np.array([len(tokens)]))[1].tolist():
            if node < 0:
                continue
            cls, rank, size = (int(c[node]) for c in (tree.cls, tree.rank, tree.size))
            if rank == 0:
                slots[cls].add(tuple(open_classes[-1]) if open_classes else ())
                open_classes.append([cls, 0])
            assert open_classes[-1][0] == cls
            open_classes[-1][1] = rank + 1
            if rank + 1 == size:
                open_classes.pop()
        assert not open_classes
    assert len(slots) > 2 and all(len(where) == 1 for where in slots.values())


def test_slots_of_many_classes_take_linear_time():
    times = []
    for n in (1_000, 16_000):
        nodes = [{"level": 1, "cls": i // 3 + 1, "rank": i % 3, "size": 3, "token": i + 1} for i in range(3 * n)]
        tokens = html_text.np.arange(1, 3 * n + 1).repeat(2)
        tokens[1::2] = -5
        tree = html_text._Tree(html_text.pa.array(nodes))
        start = time.process_time()
        _, _, slot, outer = tree.roles(tokens, html_text.np.array([len(tokens)]))
        times.append(time.process_time() - start)
        # after the first and second token of a class there is a slot, after the third none
        assert [len(set(slot[1::6])), len(set(slot[3::6])), set(slot[5::6])] == [n, n, {0}] and outer[1] == 1
    # sixteen times the classes: 256 times the work if each met all tokens
    assert times[1] < 50 * times[0] + 0.2
