import hashlib
import time
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from samples import LONG, awkward, clashing, words

from opsflow.llm import html_text, mixing, quality, topk, toxicity
from opsflow.llm.queries import QUERIES
from opsflow.llm.sample import labelled_sample
from opsflow.session import job_scope

SF = "/root/testdata/sf0.01"


def mix_by_hand(rows, weights=(1, 2, 3), most=3):
    """Copies of each (id, source, size) row, by sorting."""
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for _, t, n in rows if t == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    capped = {s for s in sources if not size[s]}
    while True:
        rest = sum(size.values()) - sum(most * size[s] for s in capped)
        level = rest / sum(weight[s] for s in sources if s not in capped) if len(capped) < len(sources) else 0
        over = {s for s in sources if s not in capped and most * size[s] < level * weight[s]}
        if not over:
            break
        capped |= over
    target = {s: min(most * size[s], level * weight[s]) for s in sources}
    rank = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    copies = []
    for i, s, _ in rows:
        whole = min(most, int(target[s] // size[s])) if size[s] else 0
        before = sum(n for j, t, n in rows if t == s and rank(j) < rank(i))
        tied = sum(n for j, t, n in rows if t == s and rank(j) == rank(i))
        copies.append(whole + (whole < most and 2 * before + tied <= 2 * (target[s] - whole * size[s])))
    return target, copies


def test_mix_of_awkward_rows(spark):
    more = [(1000 + i, "w " * (i % 40), "en", "abcdefg"[i % 7] if i % 3 else "hot", 0) for i in range(400)]
    docs = clashing(awkward(spark, more))
    rows = [(r.doc_id, r.source, len(words(r.text))) for r in docs.collect()]
    target, copies = mix_by_hand(rows)
    with job_scope(spark):
        got = mixing.mixed(docs)
        assert got.columns == docs.columns
        counts = {}
        for r in got.collect():
            counts[(r.doc_id, r.source, len(words(r.text)))] = counts.get((r.doc_id, r.source, len(words(r.text))), 0) + 1
        wanted = {}
        for row, n in zip(rows, copies):
            wanted[row] = wanted.get(row, 0) + n
        assert counts == {k: n for k, n in wanted.items() if n}
        sized = docs.select("source", F.col("text").isNotNull().cast("long").alias("size"), mixing.rank(F.col("doc_id")).alias("rank"))
        plan = mixing.thresholds(sized)
        assert plan.agg(F.sum("target")).first()[0] == pytest.approx(sized.agg(F.sum("size")).first()[0])
        assert mixing.mixed(docs.where("false")).collect() == []
    assert sum(target.values()) == pytest.approx(sum(n for _, _, n in rows))


def test_larger_budgets_take_supersets(spark):
    sized = spark.range(3000).select(
        F.lit("s").alias("source"), (F.col("id") % 13).alias("size"), mixing.rank(F.col("id")).alias("rank"), "id"
    )
    with job_scope(spark):
        total, taken = sized.agg(F.sum("size")).first()[0], []
        for other in (1.0, 0.5, 0.2):
            extra = spark.createDataFrame([("t", int(total * other), 5, -1)], "source string, size long, rank long, id long")
            both = sized.unionByName(extra)
            rows = mixing.with_copies(both, mixing.thresholds(both, (1, 1), 3), "source", F.col("rank")).where("source = 's'")
            once = rows.select("id", "size", "copies", "mix.target").collect()
            assert abs(sum(r["size"] * r.copies for r in once) - once[0].target) <= 6
            taken.append({(r.id, c) for r in once for c in range(r.copies)})
    taken.sort(key=len)
    assert taken[0] < taken[1] < taken[2] or taken[0] <= taken[1] <= taken[2]


def best_by_hand(rows, asks, k):
    def quantised(v):
        return None if v is None or None in v or not np.isfinite(v).all() else np.floor(np.array(v, float) * 256).astype(np.int64)

    fine = [(i, quantised(v)) for i, v in rows if i is not None and quantised(v) is not None]
    out = []
    for n, (i, v) in enumerate(fine):
        if asks(i):
            scores = sorted((-int(v @ w), j) for m, (j, w) in enumerate(fine) if m != n and len(v) == len(w))[:k]
            out += [(i, place, j, -s) for place, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def test_search(spark):
    random = np.random.default_rng(9)
    rows = [(i, random.standard_normal(12).round(1).tolist()) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [(300, rows[5][1]), (300, rows[5][1])]  # ties and a repeated row
    rows += [(400, None), (401, [1.0, None] * 6), (402, [float("nan")] * 12), (403, [1.0, 2.0]), (404, [3.0, 1.0]), (405, []), (406, [])]
    with job_scope(spark):
        df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        own = df.withColumn("vector", topk.quantised(F.col("embedding"), 256))
        for lists, block in ((2, 1024), (3, 7), (1, 1024)):
            got = topk.search(own, F.col("vec_id") % 5 == 0, k=4, lists=lists, block=block)
            assert got.columns == ["query_id", "rank", "vec_id", "score"]
            assert sorted(map(tuple, got.collect())) == best_by_hand(rows, lambda i: i % 5 == 0, 4)
        assert topk.search(own.where("false"), F.lit(True), k=4).collect() == []
        lost = own.withColumn("vec_id", F.lit(None).cast("long"))
        assert topk.search(lost, F.lit(True), k=4).collect() == []


def test_search_of_one_id_with_several_vectors(spark):
    random = np.random.default_rng(19)
    rows = [(i // 2, random.standard_normal(6).round(1).tolist()) for i in range(40)]
    rows += [(3, rows[0][1]), (2, rows[31][1]), (7, [1.0, 2.0]), (7, [3.0, 1.0])]
    with job_scope(spark):
        own = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("vector", topk.quantised(F.col("embedding"), 256))
        got = topk.search(own, F.col("vec_id") % 5 == 0, k=4).collect()
        assert sorted(map(tuple, got)) == best_by_hand(rows, lambda i: i % 5 == 0, 4)


def test_products_of_large_components_are_exact():
    big = np.array([[2**30, 1], [2**30, -1]], np.int64)
    assert topk.products(big, big).tolist() == [[2**60 + 1, 2**60 - 1], [2**60 - 1, 2**60 + 1]]


ABUSE = ["awful scum", "go away idiot", "you moron", "worthless trash"]


def sentences():
    """Abuse that often names one group, and clean sentences of which few do."""
    rows = []
    for i in range(240):
        filler = f"text{i % 11} and more{i % 7} here."
        group = "muslims" if i % 4 else "neighbours"
        rows.append((f"{ABUSE[i % 4]} {group} {filler}", 1))
        rows.append((f"nice day for {'everyone' if i % 20 else 'muslims'} {filler}", 0))
    return rows


def test_counterfactuals_free_neutral_mentions(spark):
    with job_scope(spark):
        sample = spark.createDataFrame(sentences(), "body string, label int")
        plain = toxicity.fit_sample(sample, balance=0.0, min_signal=4.0)
        fair = toxicity.fit_sample(sample, balance=20.0, min_signal=4.0)
    mention = ["nice day for muslims", "nice day for christians", "nice day for people"]
    assert np.ptp(plain.scores(mention)) > 5 * np.ptp(fair.scores(mention))
    assert fair.scores(mention)[0] < plain.scores(mention)[0]
    assert (fair.scores(["you idiot", "worthless trash, muslims", "awful scum"]) > 0.5).all()
    assert fair.scores([None])[0] == fair.scores([""])[0] == fair.scores([" \n"])[0]
    assert 0 <= fair.scores([LONG + " idiot"])[0] <= 1


def test_swaps():
    assert toxicity.swapped({"a", "gay", "day"}) == [{"a", "lesbian", "day"}, {"a", "people", "day"}]
    assert toxicity.swapped({"a", "day"}) == []


def test_the_swap_terms_are_told_apart():
    listed = [t for groups in toxicity.IDENTITY.values() for group in groups for t in group]
    assert len(listed) == len(set(listed)) and not set(listed) & set(toxicity.NOUNS)
    assert toxicity.swapped({"die", "frauen"}) == [{"die", "männer"}, {"die", "menschen"}]


def plain_fit(rows, index, balance, ridge):
    """The loss written out term by term and lowered by plain gradient steps."""
    weights, bias = np.zeros(len(index)), 0.0
    n, pairs = len(rows), [(told, other) for body, _ in rows for told in [toxicity.words_of(body)] for other in toxicity.swapped(told)]
    vector = lambda found: np.array([w in found for w in index], float)
    x, y = np.array([vector(toxicity.words_of(b)) for b, _ in rows]), np.array([v for _, v in rows], float)
    gaps = np.array([vector(a) - vector(b) for a, b in pairs])
    for _ in range(30_000):
        error = 1 / (1 + np.exp(-(x @ weights + bias))) - y
        slope = x.T @ error / n + 2 * ridge * weights + 2 * balance * gaps.T @ (gaps @ weights) / len(gaps)
        weights, bias = weights - 0.05 * slope, bias - 0.05 * error.mean()
    return weights, bias


def test_toxicity_scores_equal_a_plain_fit(spark):
    """One sentence a text, so that every swap is of the whole text."""
    rows = [(b.replace(".", ""), y) for b, y in sentences()[:120]]
    with job_scope(spark):
        model = toxicity.fit_sample(spark.createDataFrame(rows, "body string, label int"), min_signal=4.0, balance=2.0, ridge=1e-2)
    weights, bias = plain_fit(rows, list(model.words), 2.0, 1e-2)
    texts = [b for b, _ in rows] + ["muslims", "", "idiot", "people"]
    plain = [1 / (1 + np.exp(-(bias + sum(w for word, w in zip(model.words, weights) if word in toxicity.words_of(t))))) for t in texts]
    assert np.abs(model.scores(texts) - plain).max() < 0.01


def test_boosting_equals_trees_grown_one_node_at_a_time():
    """Every split found by trying each feature and threshold on the rows themselves, every row walked down by itself."""
    random = np.random.default_rng(4)
    rows = random.integers(0, 6, (150, 3)).astype(float)
    y = ((rows[:, 0] > 2) | (rows[:, 1] > random.integers(0, 6, 150))).astype(float)
    forest = quality.boost(rows, y, trees=5, depth=2, bins=64, rate=0.3, ridge=1.0, least=5)
    total = np.full(150, forest.start)

    def best(inside, g, h):
        found = (1e-6, None, None)
        for f in range(3):
            for cut in np.unique(np.quantile(rows[:, f], np.linspace(0, 1, 65)[1:-1])):
                left = inside & (rows[:, f] <= cut)
                right = inside & ~left
                if min(left.sum(), right.sum()) >= 5:
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, right)) - g[inside].sum() ** 2 / (h[inside].sum() + 1)
                    if gain > found[0] * (1 + 1e-9):
                        found = (gain, f, cut)
        return found

    def grow(inside, g, h, depth):
        _, f, cut = best(inside, g, h) if depth else (0, None, None)
        if not depth:
            return {i: -0.3 * g[inside].sum() / (h[inside].sum() + 1) for i in np.flatnonzero(inside)}
        if f is None:
            return grow(inside, g, h, depth - 1)
        left = inside & (rows[:, f] <= cut)
        return {i: v for half in (left, inside & ~left) if half.any() for i, v in grow(half, g, h, depth - 1).items()}

    for _ in range(5):
        p = 1 / (1 + np.exp(-total))
        leaves = grow(np.ones(150, bool), p - y, p * (1 - p), 2)
        total += np.array([leaves[i] for i in range(150)])
    assert np.abs(forest.scores(rows) - 1 / (1 + np.exp(-total))).max() < 1e-9


def test_the_sample_is_bounded_under_a_hot_id(spark):
    hot = next(i for i in range(1, 99, 2) if zlib.crc32(str(i).encode()) % 4 != 2)
    docs = spark.range(6000).select(
        F.when(F.col("id") < 5000, hot).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    with job_scope(spark):
        for rows in (10, 300, 100_000):
            got = [sorted(map(tuple, labelled_sample(docs, labels, "toxic", 4, 2, rows).collect())) for _ in range(2)]
            usable = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in [hot, *range(5000, 6000)])
            assert got[0] == got[1] and len(got[0]) == min(rows, usable)
        one = labelled_sample(docs, labels.where(F.col("doc_id") == hot), "toxic", 4, 2, 10).collect()
        assert len(one) == 1 and one[0].label == 1


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_awkward_rows(spark, module, label):
    docs = clashing(awkward(spark))
    for rows in ([], [(1, 1)], [(1, 1), (1, 0), (3, 0), (5, 1), (None, 1), (6, None), (77, 1)]):
        with job_scope(spark):
            labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
            model = module.fit(docs, labels)
            got = docs.select("doc_id", module.score(F.col("text"), model).alias("result")).collect()
            assert len(got) == docs.count() and all(0 <= r.result <= 1 for r in got)
            assert docs.where("false").select(module.score(F.col("text"), model)).collect() == []


@pytest.mark.parametrize("name,label,recall", [("op2_toxicity", "toxic", 0.6), ("op8_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, recall):
    """Some held-out texts with the label toxic hold nothing toxic, so recall has a bound below 1."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    with job_scope(spark):
        rows = QUERIES[name](spark, SF).join(labels, "doc_id").where("held_out").collect()
    hits = [r.predicted for r in rows if r[label] == 1]
    false = [r.predicted for r in rows if r[label] == 0]
    assert np.mean(hits) >= recall and np.mean(false) <= 0.1


@settings(max_examples=50, deadline=None)
@given(st.text(max_size=200))
def test_statistics_of_any_text(text):
    row = quality.statistics(text)
    assert row.shape == (quality.STATISTICS,) and np.isfinite(row).all()


def test_boosting_learns_and_flattens():
    random = np.random.default_rng(1)
    rows = random.standard_normal((2000, 3))
    y = ((rows[:, 0] > 0) ^ (rows[:, 1] > 0.5)).astype(float)
    forest = quality.boost(rows, y, trees=40)
    assert ((forest.scores(rows) > 0.5) == (y > 0.5)).mean() > 0.97
    one = quality.Forest(0.0, np.array([[0, 1, 1]]), np.array([[0.0, 0.0, 1.0]]), np.array([[-1.0, 1.0, 2.0, 3.0]]))
    walk = [(-1, -1, -1.0), (-1, 1, 1.0), (1, 0, 2.0), (1, 2, 3.0)]
    got = one.scores(np.array([w[:2] for w in walk], float))
    assert np.allclose(got, [1 / (1 + np.exp(-w[2])) for w in walk])


def test_visibility_is_inherited_and_taken_back():
    show = html_text.visible_text
    assert show('<div style="visibility:hidden">a<span style="visibility:visible">b</span>c</div>d') == "b\nd"
    assert show('<p style="visibility:hidden">a<i style="visibility:inherit">b</i><i style="visibility: hidden; visibility: visible">c</i>') == "c"
    assert show('<div style="display:none"><b style="visibility:visible">x</b></div><div hidden><b style="visibility:visible">y</b></div>') == ""
    assert show('<ul><li style="visibility:collapse">a<li>b<li style="visibility:hidden">c<p style="visibility:visible">d</ul>') == "- b\n  d"
    assert show('<ol><li style="visibility:hidden">a<li>b</ol>') == "2. b"
    assert show('<svg visibility="hidden"><text>a</text><text visibility="visible">b</text></svg>') == "b"
    assert show('<div style="visibility:hidden"><textarea>a</textarea><pre>b</pre><table><td>c<td style="visibility:visible">d</table></div>') == "  d"


@pytest.mark.parametrize("part", ["<ul><li>x", "<ol><li>x<p>y", "<dl><dd>x", "<table><tr><td>x", "<div>x", "<b><p>x", "<table><td><ul><li>x"])
def test_deep_pages_take_time_and_space_by_their_length(part):
    times, sizes = [], []
    for depth in (6_000, 24_000):
        start = time.process_time()
        text = html_text.visible_text(part * depth + "</i>" * depth)
        times.append(time.process_time() - start)
        sizes.append(len(text))
        assert text.count("x") == depth * part.count("x")
    assert times[1] < 12 * times[0] + 1 and sizes[1] < 4.5 * sizes[0] < 30 * (html_text.MAX_INDENT + 10) * 6_000


def blocks_of(node, pre=False, listed=False, counter=None):
    """A plain renderer: the node's lines, made from those of its children, each item and cell by itself. For lists, paragraphs, headings and tables."""
    lines, words, due, number = [], "", False, 1

    def close(force=False):
        nonlocal words, due
        if words.strip() or force:
            lines.extend([""] * bool(due and lines) + [" ".join(words.split())])
            due = False
        words = ""

    def add(block):
        nonlocal due
        close()
        for line in block:
            lines.extend([""] * bool(due and lines) + [line])
            due = False

    def trimmed(block):
        while block and not block[-1]:
            block.pop()
        return block

    def walk(node, listed, kind=None, number=None):
        nonlocal words, due
        for child in node.children:
            if isinstance(child, str):
                words += child
            elif child.tag == "br":
                close(True)
            elif child.tag in ("ul", "ol"):
                close()
                due = due or not listed
                walk(child, listed, child.tag, [1])
                close()
                due = due or not listed
            elif child.tag in ("li", "dd"):
                mark = "  " if child.tag == "dd" else f"{number[0]}. " if kind == "ol" else "- "
                if kind == "ol" and child.tag == "li":
                    number[0] += 1
                inner = trimmed(blocks_of(child, listed=True)) or [""]
                add([((mark if not i else " " * len(mark)) + line if line or not i else "").rstrip() for i, line in enumerate(inner)])
                due = False
            elif child.tag == "table":
                close()
                due = True
                rows = [[(trimmed(blocks_of(cell, listed=listed)), 1, 1) for cell in row.children] for row in child.children]
                add(html_text.aligned(rows))
                due = True
            elif child.tag in ("p", "h1"):
                close()
                due = True
                walk(child, listed)
                close()
                due = True
            elif child.tag == "div":
                close()
                walk(child, listed)
                close()
            else:
                walk(child, listed)

    walk(node, listed)
    close()
    return trimmed(lines)


leaf = st.sampled_from(["one", " two ", "three four", " ", "<br>", "<b>bold</b>"])


def wrapped(inner):
    several = st.lists(inner, min_size=0, max_size=4).map("".join)
    item = several.map(lambda x: f"<li>{x}</li>")
    cell = several.map(lambda x: f"<td>{x}</td>")
    row = st.lists(cell, min_size=1, max_size=3).map(lambda c: f"<tr>{''.join(c)}</tr>")
    return st.one_of(
        several.map(lambda x: f"<div>{x}</div>"), several.map(lambda x: f"<i>{x}</i>"),
        st.lists(item, max_size=3).map(lambda x: f"<ul>{''.join(x)}</ul>"), st.lists(item, max_size=3).map(lambda x: f"<ol>{''.join(x)}</ol>"),
        several.map(lambda x: f"<dl><dd>{x}</dd></dl>".replace("<dl>", "<div>").replace("</dl>", "</div>")),
        st.lists(row, min_size=1, max_size=3).map(lambda x: f"<table>{''.join(x)}</table>"), leaf,
    )


@settings(max_examples=400, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large])
@given(st.lists(st.recursive(leaf, wrapped, max_leaves=12), max_size=4).map("".join))
def test_rendering_equals_a_plain_renderer(page):
    assert html_text.visible_text(page) == "\n".join(blocks_of(html_text.parse(page)))


PAGE = """<!doctype html><title>gone</title><style>p{}</style><body hidden=no></body><h1>Head</h1><p>One <b>two</b>three<p>next<br>line &amp; x
<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul><div style="DISPLAY : none">gone</div><span hidden>gone</span>
<table><caption>Cap</caption><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td colspan=2>a wide cell<tr><td rowspan=2>r<td>1<tr><td>2</table><pre>
  keep
    this</pre>tail <script>if (a<b) x("</p>")</script> end<dl><dt>t<dd>d</dl><noscript>gone</noscript><p title="a>b">q</p> a < b <!-- gone --> z"""
SHOWN = """Head

One twothree

next
line & x

- a
- b
  3. c
  4. d
- e

Cap
Name       Qty
apple pie  3
a wide cell
r          1
           2


  keep
    this

tail end

t
  d

q

a < b z"""


def test_layout():
    assert html_text.visible_text(PAGE.replace("<body hidden=no></body>", "<body>")) == SHOWN


@pytest.mark.parametrize("page,text", [
    ("", ""), (None, None), ("plain  text", "plain text"), ("<p>a<p>b", "a\n\nb"), ("<div>a</div><div>b</div>", "a\nb"),
    ("a<br><br>b", "a\n\nb"), ("<ul><li>x", "- x"), ("<b>a</b> <i>b</i>", "a b"), ("&lt;p&gt; &eacute;", "<p> é"),
    ("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>", "a     d\n\nb  c"), ("<p", ""), ("x <!-- open", "x"),
    ("<script>never closed", ""), ("</p></div>a", "a"), ("<p style='visibility:hidden'>a</p>b", "b"), ("<dialog>a</dialog><dialog open>b</dialog>", "b"),
    ("<select><option>a</select>b", "b"), ("<ol><li>a<li>b</ol>", "1. a\n2. b"), ("<A HREF='x'>Link</A>", "Link"),
])
def test_small_pages(page, text):
    assert html_text.visible_text(page) == text


@pytest.mark.parametrize("page,text", [
    ('<td width=50">Hello</td><td width="50">World', "Hello\nWorld"), ("<p title=it's>Lost text</p> don't stop", "Lost text\n\ndon't stop"),
    ('<p a"b>x</p><p c"d>y', "x\n\ny"), ('<p "hidden">x', "x"), ("<p =\"a>x", "x"), ("<p title = 'a>b' class=\"c>d\">x", "x"), ("<p title=>x", "x"),
    ("<p title=a/hidden>x", "x"), ("<p title=a'/>x<p title='b'/>y", "x\n\ny"), ("<p title=a' hidden>gone</p>'x", "'x"), ("<p title='open>x", "x"),
    ("a<!-->b<!-- gone -->c", "abc"), ("a<!--->b<!-- gone -->c", "abc"), ("a<!---->b", "ab"), ("a<!-- gone --!>b<!-- -->c", "abc"), ("a<!--> b", "a b"),
])
def test_stray_quotes_and_short_comments(page, text):
    assert html_text.visible_text(page) == text


@pytest.mark.parametrize("tag", "font strong em u code label button time my-tag li dt dd td tr option p div a span section xmp head".split())
def test_any_other_tag_ends_the_head(tag):
    assert html_text.visible_text(f"<head><title>T</title><{tag}>whole page").endswith("whole page")
    assert html_text.visible_text(f"<html><head><bgsound src=b><{tag}>whole page").endswith("whole page")


@pytest.mark.parametrize("tag", "title style script template noscript noframes".split())
def test_elements_of_the_head_stay_in_it(tag):
    assert html_text.visible_text(f"<head><base><basefont><bgsound><link><meta><{tag}>gone</{tag}> <em>page</em></head>") == "page"


@pytest.mark.parametrize("page,text", [
    ("a<textarea>\n x &amp; <b>\n  y</textarea>b", "a\n x & <b>\n  y\nb"),
    ("<p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>gone</annotation></math> holds", "so x= 1 2 holds"),
    ("<svg><title>gone</title><defs/><path d='M0 0'/><g>gone<text>One</text><text><tspan x=0>Two</tspan><tspan x=0>Three</tspan></text></g></svg>z",
     "One\nTwo\nThree\nz"),
    ("<svg><style/><text><![CDATA[a > b]]></text><text display=none>gone</text><foreignObject><p>in</p></foreignObject></svg>", "a > b\n\nin"),
    ("<svg><g><p>out of it", "out of it"), ("<svg><title>gone</svg>after", "after"), ("<svg/>after", "after"),
])
def test_text_areas_formulas_and_drawings(page, text):
    assert html_text.visible_text(page) == text


def test_deep_and_long_pages():
    deep = "<div>" * 50_000 + "x" + "</div>" * 50_000
    assert html_text.visible_text(deep) == "x"
    assert html_text.visible_text("<p>" + LONG) == LONG
    assert html_text.visible_text("<ul><li>" * 300 + "x").endswith("x")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<table>", "<tr>", "<td>", "</table>", "<li>", "<ul>", "</ul>", "<pre>", "word ", "&amp;", "<", "\n",
                                 "<div hidden>", "</div>", "<td colspan=3>", "<td rowspan=0>", "</tr>", "<script>", "</script>", "<b", "<head>"]), max_size=30))
def test_any_markup_renders(parts):
    assert isinstance(html_text.visible_text("".join(parts)), str)


def test_words_of_the_test_pages(spark):
    """Every word outside hidden elements comes out once, as a plain tag stripper finds them."""
    import re
    from collections import Counter

    with job_scope(spark):
        got = {r.page_id: r.text for r in QUERIES["op1_html_text"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        bare = re.sub(r"(?s)<!--.*?-->|<(script|style|title)\b.*?</\1>", " ", r.html)
        bare = re.sub(r"</?(?:b|a|i|span)\b[^>]*>", "", bare)
        plain = html_text.html.unescape(re.sub(r"<[^>]*>", " ", bare))
        wanted, own = Counter(plain.split()), Counter(w for w in got[r.page_id].split() if w != "-")
        wanted.pop("-", None)
        assert own == wanted
