import re
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sparkwright.llm import bpe, licenses, preference, quality_rules, style_tree
from tests.conftest import SF001, SF01
from tests.llm import brute

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------------ BPE

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(VOCABULARY)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_matches_the_library(spark, edge, edge_rows, nothing, library):
    want = Counter()
    for i, t in edge_rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    rows = bpe.decode(bpe.encode(edge, VOCABULARY), VOCABULARY).collect()
    assert Counter((r.doc_id, tuple(array("I", r.ids)), r.decoded) for r in rows) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in rows)
    assert bpe.digests(nothing, VOCABULARY).count() == 0


def test_bpe_matches_the_library_on_documents(spark, library):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = dict(zip(texts, library.encode_batch(list(texts.values()), add_special_tokens=False)))
    for r in bpe.digests(docs, VOCABULARY).collect():
        want = ids[r.doc_id].ids
        assert (r.n_tokens, r.ids_sha256) == (len(want), brute.sha(array("I", want).tobytes()))
        assert r.decoded_sha256 == brute.sha(library.decode(want, skip_special_tokens=False))


def test_bpe_random_texts_and_full_memories(library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_PIECES", 50)
    monkeypatch.setattr(bpe, "MOST_PAIRS", 50)
    enc, rng = bpe.Encoder(VOCABULARY), np.random.default_rng(4)
    letters = "aeinst 's\n\t  ß中😀1٣²!?%<|endoftext|>"
    for _ in range(1500):
        t = "".join(letters[k] for k in rng.integers(0, len(letters), rng.integers(0, 60)))
        ids = library.encode(t, add_special_tokens=False).ids
        assert list(array("I", enc.encode(t))) == ids
        assert enc.decode(enc.encode(t)) == library.decode(ids, skip_special_tokens=False)


# ------------------------------------------------------------------ licenses

def test_license_base_matches_brute_force(spark, edge, edge_rows, nothing):
    got = Counter()
    for r in licenses.scan(edge).collect():
        got[r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels] += 1
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    want = Counter()
    for i, t in edge_rows:
        w, n, a, b, labels = brute.license_base(t)
        want[i, len(w), n, a, b, labels] += 1
    assert got == want
    assert licenses.scan(nothing).count() == 0


def plain_scan(text):
    """Detections of all rules without keywords, overlaps resolved pair by pair."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text))
    placed = " ".join(f"{x}@{k}" for k, x in enumerate(w))
    hits = set()
    for pattern, s in licenses.placed_patterns(licenses.signatures()):
        if all(k in w for k in s.keywords):
            hits |= {(int(m[1]), -int(m[2]), s.priority, s.label, s.weight) for m in re.finditer(pattern, placed)}
    best = {}
    for h in sorted(hits):
        best.setdefault(h[0], h)
    out = []
    for d in best.values():
        def beats(e):
            overlap = e[0] <= -d[1] and d[0] <= -e[1] and e[0] != d[0]
            holds = e[0] <= d[0] and e[1] <= d[1]
            held = d[0] <= e[0] and d[1] <= e[1]
            return overlap and (holds or not held and e[2] < d[2])
        if not any(beats(e) for e in best.values()):
            out.append((d[0], -d[1], d[3]))
    return sorted(out)


def test_license_detections(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0 (the License)",
        "This is released under the MIT License. All rights reserved.",
        "GNU Lesser General Public License v2.1; GPL v3; BSD 3-clause license",
        "either version 2 of the License, or (at your option) any later version",
        "CC BY-SA 4.0 and CC BY 3.0, see also Creative Commons Attribution ShareAlike 4.0",
        "mit license " * 300 + "apache license 2.0 gpl license mit", "nothing here", "cc", "license mit license"]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    for k, t in enumerate(texts):
        assert sorted((d.start, d.end, d.label) for d in got[k].detections or []) == plain_scan(t), t
    assert got[0].labels == "apache" and got[1].labels == "mit,reserved" and got[6].score == 0
    assert got[2].labels == "bsd,gpl,lgpl" and got[2].base_labels == "gpl"
    assert len(licenses.signatures()) > 300


def test_license_labels_by_hand(spark):
    """Labels written by hand, not taken from the rules."""
    want = {
        "GPL v3": "gpl", "GPLv2": "gpl", "GPLv3+": "gpl", "GPL3 or later": "gpl", "LGPL v2.1": "lgpl", "LGPLv2.1": "lgpl",
        "AGPLv3": "agpl", "Apache v2": "apache", "Apache v2.0": "apache", "Apache License 2": "apache", "Apache-2.0": "apache",
        "Creative Commons Attribution-ShareAlike 4.0": "cc-by-sa", "Creative Commons Attribution Share Alike": "cc-by-sa",
        "Creative Commons Attribution-NonCommercial 4.0 International": "cc-by-nc", "Creative Commons Attribution 4.0": "cc-by",
        "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: ISC": "isc", "SPDX-License-Identifier: GPL-2.0-only": "gpl",
        "SPDX-License-Identifier: BSD-3-Clause": "bsd", "SPDX-License-Identifier: EPL-2.0": "epl", "SPDX-License-Identifier: Unlicense": "unlicense",
        "licensed under the GPL": "gpl", "code is under the MIT": "mit", "released under the Unlicense": "unlicense", "MPL v2": "mpl",
        "CC BY-NC-SA 4.0": "cc-by,cc-by-nc-sa", "CC-BY-NC-ND 3.0": "cc-by,cc-by-nc-nd", "Server Side Public License": "sspl",
        "licensed under MIT and GPL": "gpl,mit", "dual licensed: MIT or Apache-2.0": "apache,mit", "Unlicense": "unlicense", "SSPL v1": "sspl",
        "SPDX-License-Identifier: MIT OR GPL-3.0-or-later": "gpl,mit", "Microsoft Public License (MS-PL)": "ms-pl",
        "Elastic License 2.0": "elastic", "X11 License": "x11", "OpenSSL License": "openssl", "PHP License 3.01": "php",
        "Business Source License 1.1": "busl", "GNU Free Documentation License": "gfdl", "The PostgreSQL Licence": "postgresql",
        "This is free and unencumbered software released into the public domain.": "unlicense",
        "salt and mit": "", "open software is good": "", "a business source": "", "elastic 3.5 bands": "", "server side": "",
        "Apache 2 helicopters": "", "version 3 of a gplan": "", "a creative way to share alike": "", "v2 of the identifier": ""}
    df = spark.createDataFrame(list(enumerate(want)), "doc_id int, text string")
    got = {t: r.labels for t, r in zip(want, licenses.scan(df).orderBy("doc_id").collect())}
    assert got == want


# ------------------------------------------------------------------ quality rules

def test_quality_rules_match_brute_force(spark, edge, edge_rows, nothing):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality_rules.apply_rules(edge).collect())
    assert got == Counter((i, *brute.quality(t)) for i, t in edge_rows)
    assert quality_rules.apply_rules(nothing).count() == 0


def test_quality_rules_table(spark):
    good = "the quick brown fox jumps over a lazy dog and then it runs to the far end of that long green field again"
    rows = [(0, good), (1, good.upper()), (2, good + " #### $$$$ %%%%"), (3, "\n".join([good] * 3)), (4, "too short"),
            (5, good.replace(" ", "! ")), (6, None)]
    got = {r.doc_id: r for r in quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[0].kept and got[0].failed_rules == ""
    assert got[1].failed_rules == "stop_words" and got[2].failed_rules == "symbols"
    assert got[3].failed_rules == "repeated_words,duplicate_lines"
    assert got[4].failed_rules == "too_short,stop_words" and got[6].base_failed
    assert got[5].failed_rules == "exclamations,stop_words" or "exclamations" in got[5].failed_rules
    loose = (quality_rules.Rule("too_short", "n_words", 2, None),)
    again = quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id int, text string"), loose)
    assert {r.doc_id for r in again.where("kept").collect()} == {0, 1, 2, 3, 4, 5}
    plan = quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id int, text string"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


# ------------------------------------------------------------------ quality classifier

def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    ranking = preference.train(docs, labels)
    out = preference.score(docs, ranking).join(labels, "doc_id").where(preference.held_out(F.col("doc_id"))).collect()
    right = [(r.score >= preference.CUT) == (r.quality == 1) for r in out]
    assert len(right) > 50 and np.mean(right) > 0.9
    assert all(0 <= r.score <= 1 for r in out)
    again = preference.train(docs.repartition(5), labels.repartition(3))
    assert np.array_equal(again.weights, ranking.weights) and again.threshold == ranking.threshold


def test_classifier_edges(spark, edge, edge_rows, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    ranking = preference.train(edge, none)
    assert {round(r.score, 12) for r in preference.score(edge, ranking).collect()} == {preference.CUT}
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 17)] + [(None, 1), (5, None), (6, 7), (7, 0)],
                                   "doc_id long, quality int")
    ranking = preference.train(edge, labels)
    assert Counter(r.doc_id for r in preference.score(edge, ranking).collect()) == Counter(i for i, _ in edge_rows)
    assert preference.score(nothing, ranking).count() == 0
    kept = preference.keep_good(edge, ranking)
    assert kept.columns == edge.columns
    want = Counter(r.doc_id for r in preference.score(edge, ranking).where(f"score >= {preference.CUT}").collect())
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_features_do_not_depend_on_the_batch(edge_rows):
    texts = [t or "" for _, t in edge_rows]
    whole = preference.features(texts)
    assert np.allclose(whole, np.concatenate([preference.features([t]) for t in texts]))
    assert preference.features([]).shape == (0, len(preference.FEATURES))


def test_ranking_learns_a_preference():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    label = (x @ np.array([2.0, -1.0, 0, 0]) + rng.normal(scale=0.3, size=600) > -1.5).astype(int)
    r = preference.fit(x, label)
    assert np.mean((r.score(x) >= preference.CUT) == (label == 1)) > 0.9
    assert r.weights[0] > 0 > r.weights[1] and abs(r.weights[2]) < 0.5 * r.weights[0]


def plain_features(text):
    """The features of one text, one character and one word at a time."""
    from collections import Counter
    w, size = brute.words(text), len(text.encode()) + 1  # the end mark is a line feed
    if not w:
        return [0.0] * len(preference.FEATURES)
    n, chars = len(w), sum(len(x.encode()) for x in w)
    share = lambda x, of: np.log1p(100 * x / of)
    count = lambda chosen: sum(c in chosen for c in text)
    top = max(Counter(zip(w, w[1:])).values(), default=0)
    return [np.log1p(n), chars / n, share(sum(a == b for a, b in zip(w, w[1:])), n), len(set(w)) / n ** 0.9,
            share(sum("A" <= c <= "Z" for c in text), size), share(count("#*$%&|<>{}[]~^=_@\\/+"), size), share(count("!"), size),
            share(sum(c in "0123456789" for c in text), size), (size - chars) / size, share(count("\n") + 1, n),
            np.log1p(max(len(x.encode()) for x in w)), share(max(top - 1, 0), n)]


def test_scores_match_brute_force(spark):
    """Scores of all documents from plain features, the weights as the minimum of the loss over the pairs, and the
    threshold by trying every cut."""
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    ranking = preference.train(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    x = {i: np.array(plain_features(t)) for i, t in texts.items()}
    known = sorted((r.doc_id, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 and r.doc_id in x)
    z = np.array([x[i] for i, _ in known])
    label = np.array([q for _, q in known])
    mean, scale = z.mean(axis=0), np.where(z.std(axis=0) > 1e-9, z.std(axis=0), 1.0)
    z = np.clip((z - mean) / scale, -8, 8)
    rng = np.random.default_rng(7)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    diff = z[rng.choice(good, preference.PAIRS)] - z[rng.choice(bad, preference.PAIRS)]

    def loss(w):
        return np.logaddexp(0, -(diff @ w)).mean() + preference.RIDGE / 2 * (w @ w)
    w = ranking.weights
    for k in range(len(w)):  # a minimum of a convex function
        for step in (1e-3, -1e-3):
            assert loss(w + step * np.eye(len(w))[k]) > loss(w)
    latent = z @ w
    cost = lambda cut: (preference.KEEP * ((latent < cut) & (label == 1)).sum() / len(good)
                        + ((latent >= cut) & (label == 0)).sum() / len(bad))
    cuts = np.sort(latent)
    assert cost(ranking.threshold) <= min(cost(c) for c in np.r_[cuts - 1e-9, cuts + 1e-9]) + 1e-12
    shift = np.log(0.3 / 0.7)
    got = {r.doc_id: r.score for r in preference.score(docs, ranking).collect()}
    for i, v in x.items():
        want = 1 / (1 + np.exp(-(np.clip((v - mean) / scale, -8, 8) @ w - ranking.threshold + shift)))
        assert abs(got[i] - want) < 1e-9, i


# ------------------------------------------------------------------ HTML

def article(source):
    import html as h
    m = re.search(r"<article[^>]*>(.*?)(</article>|\Z)", source, re.S)
    parts = re.split(r"</?(?:p|h1)>", m[1] if m else "")
    return "\n\n".join(x for x in (" ".join(h.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split())
                                   for p in parts) if x)


def test_html_of_pages(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in style_tree.main_text(pages).collect()} == want


def test_html_markup():
    source = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page-menu">
      <header>site</header><nav>menu</nav><div id="cookie-notice">cookies</div><main><h1>Caf&eacute; &#x41;&amp;B</h1>
      <p>One <b>two<br>three<p>Four &lt;five&gt;<ul><li>a<li>b <i>c</i></ul><table><tr><td>x<td>y</table>
      <form>f<input></form><div class="comments"><p>reader</p></div><script>if (a < b) "</p>";</script>
      <pre>k   l
      m</pre><p hidden>no</p></main><aside>side</aside><footer>foot</footer></body></html>"""
    one = lambda p, t: 1.0
    assert style_tree.Page(source).main_text(one).split("\n\n") == [
        "Café A&B", "One two three", "Four <five>", "a", "b c", "x", "y", "k l m"]
    assert style_tree.Page("<div>plain <i>x</i> text</div><p>z").main_text(one) == "plain x text\n\nz"
    assert style_tree.Page("").main_text(one) == "" and style_tree.Page("<p>a<b c=\"").main_text(one) == "a"
    assert style_tree.Page("<div>" * 5000 + "deep").main_text(one) == "deep"
    assert style_tree.Page("a < b & c <!-- x").main_text(one) == "a < b & c"


def test_style_tree_removes_what_a_host_repeats(spark, nothing, monkeypatch):
    monkeypatch.setattr(style_tree, "BLOCK", 800)
    page = lambda k, own: f"<body><div>Welcome to our site</div><div>{own}</div><div>All about us</div></body>"
    rows = [(k, f"http://big.example/{k}", page(k, f"story number {k} is unlike others")) for k in range(40)]
    rows += [(100 + k, "http://small.example/x", page(k, f"only {k}")) for k in range(2)]
    rows += [(200, None, "<article><p>x</p></article>"), (201, "no url", None), (202, "http://big.example/z", "")]
    rows += [(300 + k, f"http://copies.example/{k}", "<div>menu of it</div><article><p>same story</p></article>") for k in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS block", "'y' AS host")
    got = {r.page_id: r.text for r in style_tree.main_text(df).collect()}
    assert len(got) == len(rows)
    assert all(got[k] == f"story number {k} is unlike others" for k in range(40))
    assert got[100] == "Welcome to our site\n\nonly 0\n\nAll about us"  # too few pages to tell
    assert got[200] == "x" and got[201] == got[202] == ""
    assert all(got[300 + k] == "same story" for k in range(9))
    assert style_tree.main_text(df.limit(0)).count() == 0


def test_style_tree_counts_match_brute_force(spark, monkeypatch):
    """Entropies and page counts of the merged tree over many blocks, against one pass in Python."""
    import math
    import random
    from collections import defaultdict
    monkeypatch.setattr(style_tree, "BLOCK", 500)
    rng, rows = random.Random(4), []
    for k in range(60):
        host = rng.choice(["a.example", "a.example", "b.example"])
        body = "".join(f"<div class='c{rng.randint(0, 2)}'>{rng.choice(['x', 'y', 'z', str(k)])}{'<hr>' * rng.randint(0, 1)}</div>"
                       for _ in range(rng.randint(1, 5)))
        rows.append((k, f"http://{host}/{k}", body))
    styles, texts, pages = defaultdict(lambda: defaultdict(int)), defaultdict(int), defaultdict(int)
    parsed = {}
    for k, url, body in rows:
        host, page = url.split("/")[2], style_tree.Page(body)
        parsed[k] = host, page
        for p in {p for _, p, _, _ in page.blocks}:
            pages[host, p] += 1
        for p, x in set(page.elements):
            styles[host, p][x] += 1
        for t, p in {(t, p) for t, p, _, _ in page.blocks}:
            texts[host, p, t] += 1
    want = {}
    for k, (host, page) in parsed.items():
        kept = []
        for t, p, _, _ in page.blocks:
            m = pages[host, p]
            n = sum(styles[host, p].values())
            entropy = -sum(c / n * math.log(c / n) for c in styles[host, p].values()) / math.log(m) if m > 1 else 1.0
            value = 0.1 * min(1, entropy) + 0.9 * (1 - math.log(texts[host, p, t]) / math.log(m)) if m > 1 else 0.6
            value = ((m - 1) * value + 2 * 0.6) / (m + 1)
            kept += [t] if value >= 0.4 else []
        want[k] = "\n\n".join(kept)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in style_tree.main_text(df).collect()} == want


def test_host_statistics_decide_inside_and_outside_of_articles(spark, monkeypatch):
    monkeypatch.setattr(style_tree, "BLOCK", 500)
    news = "<article><h1>Title {k}</h1><p>story {k}</p><div>Get our letter</div></article>"
    teasers = "<div>body text {k}</div><article>Teaser one</article><article>Teaser two</article>"
    lead = "<div>All rights</div><h1>Head {k}</h1><article><p>long story {k}</p></article>"
    rows = [(100 * j + k, f"http://h{j}.example/{k}", body.format(k=k))
            for j, body in enumerate((news, teasers, lead)) for k in range(30)]
    rows += [(300 + k, f"http://h0.example/copy{k}", news.format(k="copied")) for k in range(30)]
    rows += [(400, "http://few.example/", lead.format(k=0))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in style_tree.main_text(df).collect()}
    for k in range(30):
        assert got[k] == f"Title {k}\n\nstory {k}"
        assert got[100 + k] == f"body text {k}"
        assert got[200 + k] == f"Head {k}\n\nlong story {k}"
        assert got[300 + k] == "Title copied\n\nstory copied"  # copies count as one page
    assert got[400] == "long story 0"  # too few pages to tell: the marks alone


def test_article_text_stays_whatever_the_host_repeats(spark, monkeypatch):
    """A line that all pages of a host have is article text in a paragraph of the article, boilerplate in a bare block."""
    monkeypatch.setattr(style_tree, "BLOCK", 500)
    page = ("<article><h1>T {k}</h1><p>The same line on every page.</p><ul><li>point</li></ul><table><tr><td>cell</td></tr></table>"
            "<blockquote class=share-quote>said {k}</blockquote><table class=menu-prices><tr><td>soup {k}</td></tr></table>"
            "<ol class=related-work><li>Paper {k}</li></ol><div class=quote-share-tools>Tell a friend</div><div>Get our letter</div>"
            "<div class=related-posts>More {k}</div></article>")
    rows = [(k, f"http://h.example/{k}", page.format(k=k)) for k in range(25)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in style_tree.main_text(df).collect()}
    for k in range(25):
        assert got[k].split("\n\n") == [f"T {k}", "The same line on every page.", "point", "cell", f"said {k}", f"soup {k}", f"Paper {k}"]


def test_comments_and_teasers_after_the_article_go(spark):
    page = ("<h1>Head {k}</h1><p>lead of {k}</p><article><p>story {k} is long enough</p></article>"
            "<section id=discussion><p>reader {k} says</p></section><div><p>Ann, 3 May</p><p>I liked {k}</p></div><div>Next: other {k}</div>")
    cards = "<div><p>the body text of page {k}, longer than its cards</p></div><article>Card {k}a</article><article>Card {k}b</article>"
    few = "<div>Subscribe now</div><article><p>text {k}</p></article>"
    rows = [(k, f"http://a.example/{k}", page.format(k=k)) for k in range(9)]
    rows += [(100 + k, f"http://b.example/{k}", cards.format(k=k)) for k in range(9)]
    rows += [(200 + k, f"http://c{k}.example/", few.format(k=k)) for k in range(3)]
    rows += [(300 + k, f"http://d.example/{k}", f"<div>Subscribe now</div><div>own text {k}</div>") for k in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in style_tree.main_text(df).collect()}
    for k in range(9):
        assert got[k] == f"Head {k}\n\nlead of {k}\n\nstory {k} is long enough"
        assert got[100 + k].startswith(f"the body text of page {k}")
    for k in range(3):
        assert got[200 + k] == f"text {k}" and got[300 + k] == f"own text {k}"


def test_names_like_noise():
    level = style_tree.named_like_noise
    assert [level(x) for x in ("ad", "ads-top", "relatedPosts", "SideBar", "side-bar", "comments-area", "site-footer c1", "x menu", "social_2")] == [2] * 9
    assert [level(x) for x in ("share-quote", "menu-prices", "related-work", "has-comments", "content-sidebar-wrap")] == [1] * 5
    assert [level(x) for x in ("", "story", "shareholders", "addendum", "header-image", "download")] == [0] * 6


def test_noise_belongs_to_the_text_read_in_it():
    text = lambda source: style_tree.Page(source).main_text(lambda p, t: style_tree.NEUTRAL)
    assert text("<div>Article text <select><option>A</option></select></div>") == "Article text"
    assert text("<p>Text <button>Subscribe</button></p>") == "Text"
    assert text("<p>one <span hidden>x</span>two <span class=advert>buy</span>three</p>") == "one two three"
    # wrappers named like noise
    assert text("<div class='content-sidebar-wrap'><p>body of it</p><div class=sidebar>s</div></div>") == "body of it"
    assert text("<article class='post has-comments'><p>post text</p><div class='comments'>c</div></article>") == "post text"
    assert text("<body><form action=x><div>whole page</div><input></form></body>") == "whole page"
    assert text("<form>name</form><main><p>text</p><form>mail</form></main>") == "text"
    assert text("<article class='post has-comments'>a</article>" * 3) == "a\n\na\n\na"
    assert text("<main><p>long article</p><div class=comments><article class=comment>c</article></div></main>") == "long article"
    # the host's statistics overrule a wrapper
    assert style_tree.Page("<form><p>x</p></form>").main_text(lambda p, t: 0.45) == ""
    assert style_tree.Page("<div><p>x</p></div>").main_text(lambda p, t: 0.45) == "x"
