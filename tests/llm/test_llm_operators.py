"""The training-data operators against brute force on small fixtures with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from idhealth.llm import chaining, chat, components, decontaminate, media, mixing, neardup, quality, suffixdedup, textflat, warc, wrapper
from idhealth.llm.base import new_dir

WORDS = [a + b for a in "ka re mi to su le na vo".split() for b in ("", "na", "ré", "ß", "nd", "ks", "li", "mo", "ta", "7")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(60, 200)) for _ in range(25)]
    passage = prose(rng, 70)
    out = list(base)
    out += [base[0], base[0], base[1]]  # copies
    for i in range(3):  # near copies
        w = base[2].split()
        w[i * 7] = "changed"
        out.append(" ".join(w))
    out += [base[3] + " " + passage, passage + " " + base[4], base[5][:300] + " " + passage + " " + base[5][300:]]
    out += [None, "", "   ", "one", "two words", "Orre " * 300, "\x00\x01 a\nb", prose(rng, 6000), "two words"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, x, "en", f"s{i % 3}" if i % 7 else None, len(x or ""), "clash", i) for i, x in enumerate(texts)]
    rows.append(rows[5])  # a repeated row
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, h string, bands int").repartition(4)


def empty(docs):
    return docs.where("doc_id < -5")


def slow_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    out, cur = [], ""
    for c in low:
        if c.isascii() and not (c.isdigit() or "a" <= c <= "z"):
            if cur:
                out.append(cur)
            cur = ""
        else:
            cur += c
    return out + ([cur] if cur else [])


def test_intermediate_tables_can_be_cleaned(spark, tmp_path):
    import os

    from idhealth.llm import base

    base.clean(spark)
    base.written(spark.range(3), "t-clean").count()
    path = base._given[spark.sparkContext.applicationId][0].removeprefix("file://")
    assert os.path.isdir(path) and base.clean(spark) == 1 and not os.path.exists(path) and base.clean(spark) == 0


def test_words_and_hashes(texts):
    given = ["Ab,céD 12", None, "", "x", "  ", "Éa BÉ"]
    data, offsets = textflat.flat(pa.array(given))
    row, start, end, h = textflat.words(data, offsets)
    raw = data.tobytes().decode()
    got = defaultdict(list)
    for r, s, e in zip(row, start, end):
        got[int(r)].append("".join(c.lower() if "A" <= c <= "Z" else c for c in data[s:e].tobytes().decode()))
    assert [got[i] for i in range(6)] == [slow_words(x) for x in given] and raw
    again = textflat.words(*textflat.flat(pa.array(["12 ab"])))[3]
    assert again[0] == h[2] and again[1] == h[0]


def test_minimizers_hold_one_in_each_window():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 50, 300).astype(np.uint64)
    row = np.sort(rng.integers(0, 6, 300))
    some = set(textflat.minimizers(h, row, 9).tolist())
    for i in range(300 - 8):
        if row[i] == row[i + 8]:
            window = range(i, i + 9)
            best = min(window, key=lambda j: (h[j], -j))
            assert best in some


# 1 -----------------------------------------------------------------------------------------------------------------
def test_chain_is_the_best_one():
    rng = random.Random(2)
    for _ in range(40):
        pts = sorted({(rng.randint(0, 40), rng.randint(0, 40)) for _ in range(9)})
        d, l = np.array([p[0] for p in pts]), np.array([p[1] for p in pts])
        best = [float(chaining.K)] * len(pts)
        for j in range(len(pts)):
            for i in range(j):
                if d[i] < d[j] and l[i] < l[j]:
                    gap = chaining.GAP_COST * (d[j] - d[i] + l[j] - l[i])
                    best[j] = max(best[j], chaining.K + best[i] - gap)
        line = chaining.chains(d, l)[0]
        assert all(d[a] < d[b] and l[a] < l[b] for a, b in zip(line, line[1:]))
        # overlaps are taken off after the choice, so the chain's score is at most the best without overlaps
        assert len(line) >= 1 and chaining.K <= max(best)


def test_alignment_finds_edited_passage():
    rng = np.random.default_rng(0)
    p = rng.integers(0, 1000, 80)
    q = np.delete(p.copy(), 30)
    q[10] = 5000
    a = np.concatenate([rng.integers(2000, 3000, 20), p, rng.integers(3000, 4000, 20)])
    b = np.concatenate([rng.integers(6000, 7000, 5), q, rng.integers(7000, 8000, 9)])
    x = chaining.align(a, b, np.array([22, 60]), np.array([7, 44]))
    assert (x[0], x[1], x[2], x[3]) == (20, 100, 5, 84) and x[4] == 78


def test_passages_match_brute_force(docs, texts):
    got = chaining.repeated_passages(docs).collect()
    pairs = {(r.doc_id, r.partner_id) for r in got}
    grams = defaultdict(set)
    for i, x in enumerate(texts):
        w = slow_words(x)
        for k in range(len(w) - chaining.MIN_WORDS + 1):
            grams[tuple(w[k : k + chaining.MIN_WORDS])].add(i)
    shared = {i for s in grams.values() if len(s) > 1 for i in s}
    assert shared <= {x for p in pairs for x in p}
    for r in got:
        a, b = slow_words(texts[r.doc_id])[r.doc_from : r.doc_to], slow_words(texts[r.partner_id])[r.partner_from : r.partner_to]
        assert r.identity >= 0.8 and min(len(a), len(b)) >= 50 and r.partner_id < r.doc_id
    assert not {7, 8, 9, 10} & {x for p in pairs for x in p}  # clean texts
    assert chaining.repeated_passages(empty(docs)).count() == 0


def test_passages_of_few_words_that_repeat(spark):
    rng = random.Random(6)
    junk = "Orre " * 90
    df = spark.createDataFrame([(1, prose(rng, 40) + " " + junk), (2, junk + prose(rng, 30)), (3, prose(rng, 100)), (None, junk), (4, "Orre " * 20)], "doc_id long, text string")
    got = chaining.repeated_passages(df).collect()
    assert {(r.doc_id, r.partner_id) for r in got} == {(2, 1)} and all(85 <= r.n_equal <= 90 for r in got)


def test_pieces_are_all_maximal_passages():
    rng = random.Random(8)
    for _ in range(300):
        runs, at = [], (0, 0)
        for _ in range(rng.randint(1, 12)):
            runs.append((*at, rng.choice([2, 9, 30, 60])))
            at = tuple(x + runs[-1][2] + rng.choice([0, 1, 2, 8, 20, 45]) for x in at)
        good = set()
        for i, (a, b, _) in enumerate(runs):
            for j in range(i, len(runs)):
                end_a, end_b = runs[j][0] + runs[j][2], runs[j][1] + runs[j][2]
                equal = sum(n for _, _, n in runs[i : j + 1])
                if min(end_a - a, end_b - b) >= chaining.MIN_WORDS and equal >= chaining.IDENTITY * max(end_a - a, end_b - b):
                    good.add((a, end_a, b, end_b, equal))
        longest = {x for x in good if not any(y != x and y[0] <= x[0] and y[1] >= x[1] for y in good)}
        got = chaining.pieces(runs)
        assert set(got) <= longest and len(set(got)) == len(got)
        words = lambda some: {w for x in some for w in range(x[0], x[1])}
        assert words(got) == words(longest)


def test_two_passages_of_one_pair(spark):
    rng = random.Random(7)
    rows, want = [], set()
    for t, (one, gap, two) in enumerate([(60, 40, 60), (100, 60, 100), (200, 150, 200)] * 8):
        x, y = prose(rng, one), prose(rng, two)
        rows += [(2 * t + k, f"{x} {prose(rng, gap)} {y}") for k in range(2)]
        want |= {(2 * t + 1, 2 * t, 0, one), (2 * t + 1, 2 * t, one + gap, one + gap + two)}
    got = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    near = lambda x: [(r.doc_id, r.partner_id) == x[:2] and abs(r.doc_from - x[2]) < 12 and abs(r.doc_to - x[3]) < 12 for r in got]
    assert all(sum(near(x)) == 1 for x in want) and len(got) == len(want)


def test_passage_of_phrases_that_earlier_documents_have(spark):
    rng = random.Random(9)
    rows, want = [], set()
    for t in range(8):
        p = prose(rng, 56).split()
        phrases = [" ".join(p[i : i + chaining.K]) for i in range(len(p) - chaining.K + 1)]
        rows += [(1000 * t + i, f"{prose(rng, 12)} {x} {prose(rng, 12)}") for i, x in enumerate(phrases)]
        rows += [(1000 * t + 900, f"{prose(rng, 30)} {' '.join(p)} {prose(rng, 30)}"), (1000 * t + 901, f"{rng.choice(phrases)} {prose(rng, 50)} {' '.join(p)}")]
        want.add((1000 * t + 901, 1000 * t + 900))
    got = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.partner_id) for r in got) == sorted(want) and all(r.n_equal >= 56 for r in got)


def test_recall_of_fuzzy_passages(spark):
    """80-word passages with every 7th word replaced (identity 0.86), at a place of its own in each text."""
    rng = random.Random(10)
    rows = []
    for t in range(300):
        p = [f"w{rng.randrange(10**6)}" for _ in range(80)]
        q = [f"x{t}y{i}" if i % 7 == 3 else w for i, w in enumerate(p)]
        for k, x in enumerate((p, q)):
            rows.append((2 * t + k, " ".join([f"a{rng.randrange(10**6)}" for _ in range(rng.randint(0, 60))] + x + [f"b{rng.randrange(10**6)}" for _ in range(rng.randint(0, 60))])))
    got = {(r.doc_id, r.partner_id) for r in chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got <= {(2 * t + 1, 2 * t) for t in range(300)} and len(got) >= 0.95 * 300


@pytest.mark.parametrize("stride", [14, 7])
def test_recall_of_passages_whose_runs_stand_in_earlier_texts(spark, stride):
    """As above; every second, or every, run of six words that both texts have stands in a document of its own, before and between them.

    All pairs are found that share a sampled seed at all. Passages without one are what sampling loses: 3 in 100 of these
    on the average, of these 100 six and five, so that a share of 0.95 would test the draw and not the method.
    """
    def seeds(x):
        row, _, _, h = textflat.words(*textflat.flat(pa.array([x])))
        g, _ = textflat.grams(h, row, chaining.K)
        return set(g[textflat.mix(g + textflat.U64(chaining.K)) % textflat.U64(chaining.RATE) == 0].tolist())

    rng = random.Random(12)
    rows, want = [], set()
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    for t in range(100):
        p = words(80)
        q = [f"x{t}y{i}" if i % 7 == 3 else w for i, w in enumerate(p)]
        runs = range(4, 75, stride)
        rows += [(1000 * t + i + k, " ".join(words(20) + p[i : i + 6] + words(20))) for i in runs for k in (0, 500)]
        rows += [(1000 * t + 400, " ".join(words(30) + p + words(30))), (1000 * t + 900, " ".join(words(10) + q + words(40)))]
        if seeds(" ".join(p)) & seeds(" ".join(q)):
            want.add((1000 * t + 900, 1000 * t + 400))
    got = {(r.doc_id, r.partner_id) for r in chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and len(want) >= 94


def test_alignment_goes_on_beyond_the_words_sent_first(spark, monkeypatch):
    monkeypatch.setattr(chaining, "REACH", 5)
    rng = random.Random(13)
    x = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    y = [f"y{i}" if i % 6 == 5 else w for i, w in enumerate(x)]
    rows = [(1, " ".join(["a"] + x + ["b"])), (2, " ".join(y))]
    got = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert any(r.doc_to - r.doc_from >= 390 for r in got) and {(r.doc_id, r.partner_id) for r in got} == {(2, 1)}


def test_exact_passages_whose_halves_stand_in_earlier_texts(spark):
    rng = random.Random(11)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows = []
    for t in range(100):
        x, y = words(40), words(40)
        rows += [(4 * t + k, z) for k, z in enumerate([f"{words(30)} {x} {words(9)}", f"{y} {words(30)}", f"{words(20)} {x} {y} {words(20)}", f"{words(5)} {x} {y}"])]
    got = {(r.doc_id, r.partner_id) for r in chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(4 * t + 3, 4 * t + 2) for t in range(100)}


# 2 -----------------------------------------------------------------------------------------------------------------
def test_chat_round_trip(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "a\\b <|im_end|> \\<|x"), (1, 2, "assistant", "<\\|<|im_start|>user\n"), (2, 0, "user", None), (2, 1, None, "x"), (3, 1, "assistant", "z"), (3, 0, "user", "y"), (4, 0, "Odd\nRole", ""), (None, 0, "user", "n"), (5, None, "user", "t"), (5, None, "user", "t")]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in chat.format_chat(df).withColumn("back", chat.read_back(F.col("formatted"))).collect()}
    for c in {t[0] for t in turns}:
        want = sorted([(t[1] if t[1] is not None else -1, t[2] or "", t[3] or "") for t in turns if t[0] == c])
        assert [(b["role"], b["text"]) for b in out[c]["back"]] == [w[1:] for w in want]
        assert "".join(s["text"] for s in out[c]["segments"]) == out[c]["formatted"]
        assert [s["text"] for s in out[c]["segments"] if s["loss"]] == [w[2].replace("\\", "\\\\").replace("<|", "<\\|") for w in want if w[1] == "assistant"]
    assert out[1]["valid"] and out[3]["valid"] and not any(out[c]["valid"] for c in (2, 4, 5, None))
    assert chat.format_chat(df.where("conv_id < 0")).count() == 0


# 3 -----------------------------------------------------------------------------------------------------------------
def page(menu, body, article=True):
    mark = ("<article>", "</article>") if article else ("<div>", "</div>")
    return f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header>Top</header><nav><ul><li><a href="/">{menu}</a></li></ul></nav><div class="ad">Buy {menu}</div>{mark[0]}{body}{mark[1]}<div id="comments"><p>Nice {menu}</p></div><aside>Side</aside><form>F</form><footer>&copy; x</footer></body></html>'


def test_main_text(spark):
    given = [
        (1, "http://a.example/1", page("one", "<h1>Head &amp; more</h1><p><b>First\n  text<br><p>Second.<script>var t='</p>';</script></p>"), "First"),
        (2, "http://a.example/2", page("two", "<h1>B</h1><p>x</p><div class='notice'>No</div><ul><li>i<li>j</ul>"), None),
        (3, None, None, None), (4, "http://b.example", "", None), (5, "x", "no markup < at &lt;all", None), (6, "http://c.example", "<p>cut off <b>here", None),
        (6, "http://c.example", "<p>cut off <b>here", None), (7, "http://a.example/3", "<table><tr><td>" * 400 + "deep", None),
    ]
    given += [(8, "http://d.example", "<body><div class='site-header'>Site</div><main><header>Top</header><article class='post'><div class='entry-header'><h1>T</h1></div><p>A<span> b</span></p><div class='comment-list'>c</div><ins class='adsbygoogle'>ad</ins></article><p>Else</p></main>", None)]
    given += [(9, "http://d.example/2", "<body><div id='header'>Site</div><div role=main><h2>H</h2>x<br>y<div hidden>z</div></div><p>out</p>", None)]
    given += [(10 + i, f"http://w.example/{i}", f"<html><body><div><p>Always here</p><p>Only {i} here</p></div></body></html>", None) for i in range(4)]
    df = spark.createDataFrame([(*g[:3], "clash") for g in given], "page_id long, url string, html string, text string")
    got = defaultdict(list)
    for r in wrapper.extract_text(df).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert got[1] == ["Head & more\nFirst text\nSecond."] and got[2] == ["B\nx\ni\nj"]
    assert got[3] == [""] and got[4] == [""] and got[5] == ["no markup < at <all"] and got[6] == ["cut off here"] * 2 and got[7] == ["deep"]
    assert got[8] == ["T\nA b"] and got[9] == ["H\nx y"]
    assert [got[10 + i] for i in range(4)] == [[f"Only {i} here"] for i in range(4)]  # the constant slot is template
    assert wrapper.extract_text(df.where("page_id < 0")).count() == 0


def test_main_text_of_copied_pages(spark):
    body = lambda *ps: "<html><body><div>" + "".join(f"<p>{p}</p>" for p in ps) + "</div></body></html>"
    given = [(i, "http://copies.example/", body("One text", "on all pages")) for i in range(5)]
    given += [(10 + i, f"http://some.example/{i}", body("Copied", "page") + f"<script>{i}</script>") for i in range(3)]
    given += [(13 + i, f"http://some.example/{i + 3}", body(f"Own {i}", f"text {i}")) for i in range(2)]
    given += [(20 + i, f"http://article.example/{i}", f"<body><nav>{i}</nav><article><p>Copied</p><p>article</p></article></body>") for i in range(25)]
    given += [(50 + i, f"http://most.example/{i}", body("Template" if i else "Not this", f"Own {i}")) for i in range(6)]
    got = {r.page_id: r.text for r in wrapper.extract_text(spark.createDataFrame(given, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "One text\non all pages" for i in range(5))
    assert all(got[10 + i] == "Copied\npage" for i in range(3)) and all(got[13 + i] == f"Own {i}\ntext {i}" for i in range(2))
    assert all(got[20 + i] == "Copied\narticle" for i in range(25))
    assert all(got[50 + i] == f"Own {i}" for i in range(1, 6)) and got[50] == "Not this\nOwn 0"  # another text in a template slot stays


def plain(node):
    """A tree with each element a node of its own."""
    out = wrapper.Part(node.tag)
    out.kids = [plain(k) for k in node.kids if k.tag.strip()]
    return wrapper.finish(out)


def test_wrapper_holds_optional_and_repeated_nodes():
    one = wrapper.outline(wrapper.parse("<body><nav>a</nav><div><p>1</p></div><footer>x</footer></body>"))
    two = wrapper.outline(wrapper.parse("<body><nav>a</nav><div><h1>t</h1><p>1</p><p>2</p><p>3</p><ul><li>i</ul></div><section>s</section><footer>x</footer></body>"))
    w = wrapper.read_tree(wrapper.written_tree(wrapper.merge(one, two)))
    body = w.kids[0]
    assert [k.tag for k in body.kids] == ["nav", "div", "section", "footer"] and [k.tag for k in body.kids[1].kids] == ["h1", "p", "ul"]
    page = wrapper.parse("<body><nav>a</nav><div><p>1</p><p>2</p><p>3</p><p>4</p></div><footer>x</footer></body>")
    wrapper.align(w, wrapper.outline(page), {})
    kids = page.kids[0].kids
    assert [k.slot for k in kids] == [body.kids[i].slot for i in (0, 1, 3)] and {k.slot for k in kids[1].kids} == {body.kids[1].kids[1].slot}


def templated(i, rename=lambda c: c, rng=random.Random(0)):
    body = "".join(f"<p>{prose(rng, 20)}</p>" for _ in range(rng.randint(1, 6)))
    extra = f"<section><p>{prose(rng, 10)}</p></section>" if i % 3 == 0 else ""
    c = rename
    page = (f"<body><div class='{c('menu')}'><ul><li>Home<li>About<li>Contact</ul></div><div class='{c('promo')}'>Buy now</div><div class='{c('post')}'><h1>{prose(rng, 4)}</h1>{body}{extra}"
            f"<div class='{c('share')}'>Share this</div></div><div class='{c('legal')}'>All rights</div></body>")  # fmt: skip
    return page, body + extra


def test_main_text_comes_from_the_wrapper(spark, monkeypatch):
    """With class names that say nothing the text is the same; without wrappers it isn't."""
    def texts(rename):
        rng = random.Random(12)
        rows = [(i, f"http://h{i % 4}.example/{i}", templated(i, rename, rng)[0]) for i in range(60)]
        return {r.page_id: r.text for r in wrapper.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}

    clear, blind = texts(lambda c: c), texts(lambda c: "x" + hashlib.md5(c.encode()).hexdigest()[:5])
    rng = random.Random(12)
    for i in range(60):
        html = templated(i, rng=rng)[0]
        want = [x for x in re.split(r"<[^>]*>", html) if x and x not in ("Home", "About", "Contact", "Buy now", "Share this", "All rights")]
        assert clear[i].split("\n") == want
    assert blind == clear
    monkeypatch.setattr(wrapper, "MIN_PAGES", 1000)
    without = texts(lambda c: "x" + hashlib.md5(c.encode()).hexdigest()[:5])
    assert all(without[i] != clear[i] for i in range(60))


def test_varying_menus_and_adverts_without_any_marks(spark):
    """Only divs, whose every text varies: the wrapper's node with nearly all of the text is the article."""
    rng = random.Random(14)
    rows, want = [], {}
    for i in range(30):
        art = [prose(rng, 5), *(prose(rng, rng.randint(3, 60)) for _ in range(rng.randint(2, 9)))]
        body = f"<h1>{art[0]}</h1>" + "".join(f"<p>{x}</p>" for x in art[1:])
        rows.append((i, f"http://o{i % 2}.example/{i}", f"<body><div><ul>{''.join(f'<li>{prose(rng, 1)}</li>' for _ in range(6))}</ul></div><div>{prose(rng, 4)}</div><div>{body}</div><div>{prose(rng, 4)}</div></body>"))
        want[i] = "\n".join(art)
    got = {r.page_id: r.text for r in wrapper.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_odd_markup(spark):
    given = ["Hello <a href=x title=it's>link</a> more", "<!--><p>kept</p><!-- c -->", "<!---><p>kept</p>", "<p title=\"a>b\">x</p>", "<p title='a>b' hidden=false>x", "<p a=\"open>lost"]
    df = spark.createDataFrame([(i, None, x) for i, x in enumerate(given)], "page_id long, url string, html string")
    assert [r.text for r in wrapper.extract_text(df).orderBy("page_id").collect()] == ["Hello link more", "kept", "kept", "x", "x", "lost"]


def test_template_of_layouts_outside_the_sample(spark):
    """What none of the merged pages has gets a place by tags and classes: a constant note goes, varying text there stays."""
    rng = random.Random(15)
    rows, want = [], {}
    for i in range(200):
        art = [prose(rng, rng.randint(5, 40)) for _ in range(4)]
        odd = f"<section class=q1><b>Constant words of a note</b></section><section class=q2>{art[3]}</section>" if i % 20 == 3 else ""
        body = "".join(f"<p>{x}</p>" for x in art[:3])
        rows.append((i, f"http://rare.example/{i}", f"<body><div>Menu words</div><div><h1>T {i}</h1>{body}{odd}</div><div>End words</div></body>"))
        want[i] = "\n".join([f"T {i}", *art[: 4 if odd else 3]])
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    own = df.select(wrapper.host_of(F.col("url")).alias("host"), "html", F.xxhash64("html").alias("key"))
    assert "section" not in wrapper.wrappers_of(own).first().wrapper
    assert {r.page_id: r.text for r in wrapper.extract_text(df).collect()} == want


def test_articles_own_notices_and_teasers(spark):
    rng = random.Random(13)
    rows = []
    for i in range(8):
        rows.append((i, f"http://n.example/{i}", f"<body><div class=search>Find</div><main><article class=teaser>{prose(rng, 3)}</article><h1>Head {i}</h1><p class=alert>Mind {prose(rng, 5)}</p><p>{prose(rng, 40)}</p></main><div class=related>{prose(rng, 9)}</div></body>"))
    got = {r.page_id: r.text.split("\n") for r in wrapper.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert len(got[i]) == 4 and got[i][1] == f"Head {i}" and got[i][2].startswith("Mind ")


def test_very_long_and_wide_pages(spark):
    given = ["<div>" * 3000 + "deep", "".join(f"<h2>t{i}</h2><p>x{i}</p>" for i in range(3000)), "".join(f"<div class=c{i}><b>x{i}</b></div>" for i in range(3000))]
    df = spark.createDataFrame([(i, "http://wide.example", x) for i, x in enumerate(given)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrapper.extract_text(df).collect()}
    assert got[0] == "deep" and got[1].count("\n") == 5999 and got[2].count("\n") == 2999


def test_tree_matching_is_maximal():
    def slow(a, b):
        if a.tag != b.tag:
            return 0
        m = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
        for i, x in enumerate(a.kids, 1):
            for j, y in enumerate(b.kids, 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + slow(x, y))
        return 1 + m[-1][-1]

    rng = random.Random(4)

    def tree(depth):
        return f"<{(t := rng.choice(['div', 'span', 'b']))}>" + "".join(tree(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)) + f"</{t}>"

    for _ in range(40):
        a, b = plain(wrapper.parse(tree(3))), plain(wrapper.parse(tree(3)))
        assert wrapper.match(a, b, {}) == slow(a, b)


# 4 -----------------------------------------------------------------------------------------------------------------
def slow_repeats(texts, n):
    seen = defaultdict(int)
    raw = [(x or "").encode() for x in texts]
    for x in raw:
        for i in range(len(x) - n + 1):
            seen[x[i : i + n]] += 1
    out = []
    for x in raw:
        cover = bytearray(len(x))
        for i in range(len(x) - n + 1):
            if seen[x[i : i + n]] > 1:
                cover[i : i + n] = b"\1" * n
        runs = sum(cover[i] and (i == 0 or not cover[i - 1]) for i in range(len(x)))
        out.append((len(x), sum(cover), runs, bytes(c for c, k in zip(x, cover) if not k)))
    return out


@pytest.mark.parametrize("bucket", [40_000, 2])
def test_suffix_dedup(spark, docs, texts, bucket, monkeypatch):
    monkeypatch.setattr(suffixdedup, "BUCKET_ROWS", bucket)
    all_texts = [*texts, texts[5]]
    want = slow_repeats(all_texts, suffixdedup.LENGTH)
    got = suffixdedup.remove_repeats(docs).collect()
    assert len(got) == len(all_texts)
    for r in got:
        n, cut, runs, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, cut, runs, hashlib.sha256(kept).hexdigest()), r.doc_id
    left = suffixdedup.remove_repeats(docs, keep_text=True)
    assert left.columns == [*docs.columns, "n_removed"]
    for r in left.collect():
        assert r.text == want[r.doc_id][3].decode("utf-8", "ignore")
    assert suffixdedup.remove_repeats(empty(docs)).count() == 0


def test_multikey_order():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 3, (200, 24)).astype(np.uint8)
    x[50:80] = x[0]
    order, common = suffixdedup.multikey_order(x, 24)
    rows = [x[i].tobytes() for i in order]
    assert rows == sorted(x[i].tobytes() for i in range(200))
    for k in range(1, 200):
        a, b = rows[k - 1], rows[k]
        assert common[k] == next((i for i in range(24) if a[i] != b[i]), 24)


# 5 -----------------------------------------------------------------------------------------------------------------
def test_decontaminate(spark, docs, texts):
    items = [(1, " ".join(texts[6].split()[20:45])), (2, texts[7].upper()[:200]), (3, "Two  WORDS"), (4, "one"), (5, None), (6, "..."), (7, "not in any text at all of these ones here now"), (1, " ".join(texts[6].split()[20:45])), (None, "one")]
    bench = spark.createDataFrame([(i, x, 1) for i, x in items], "item_id long, text string, g int")
    want = []
    for x in texts:
        w = slow_words(x)
        hit, ids = set(), set()
        for i, y in items:
            v = slow_words(y)
            n = min(10, len(v))
            for k in range(len(v) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[k : k + n]:
                        hit |= set(range(p, p + n))
                        ids.add("" if i is None else str(i))
        want.append((len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    got = decontaminate.decontaminate(docs, bench).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want[r.doc_id], r.doc_id
    assert decontaminate.decontaminate(docs, bench.where("item_id > 100")).where("contaminated").count() == 0
    assert decontaminate.decontaminate(empty(docs), bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.where("item_id > 100")).count() == len(texts) + 1


def test_decontaminate_lowers_only_ascii(spark):
    for between in ("'", ".", ":", " "):
        x = f"ΟΔΟΣ{between}ΑΒ " * 12
        d = spark.createDataFrame([(1, x), (2, x.lower()), (3, "Ab " + x)], "doc_id long, text string")
        got = {r.doc_id: r for r in decontaminate.decontaminate(d, spark.createDataFrame([(1, x)], "item_id long, text string")).collect()}
        assert got[1].n_hit == got[1].n_words == 24 and got[2].n_hit == 0 and got[3].n_hit == 24 and got[3].n_words == 25


def test_clashing_columns(spark, docs):
    names = "doc spans whole gone gone_id digest_ hit_id hit_key row rep n k g w tkey key d mix_size source_key size h threshold stays class_id n_removed bands digest tid".split()
    wide = docs.drop("h", "bands").withColumns({n: F.lit(i) for i, n in enumerate(names)})
    bench = spark.createDataFrame([(1, "one")], "item_id long, text string")
    for out in (suffixdedup.remove_repeats(wide, keep_text=True, counted=False), neardup.without_near_duplicates(wide), decontaminate.without_benchmark(wide, bench)):
        assert out.columns == wide.columns
        assert all([r[n] for n in names] == list(range(len(names))) for r in out.collect())
    left = mixing.mixed_documents(wide)
    assert left.columns == [*wide.drop("mix_size").columns, "mix_size", "mix_taken"] and left.count() > 0


# 6 -----------------------------------------------------------------------------------------------------------------
def slow_classes(texts):
    sets = []
    for x in texts:
        w = slow_words(x)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (texts[i] or "") == (texts[j] or "") or a and len(a & b) >= 0.8 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def test_near_duplicates(docs, texts):
    want = slow_classes(texts)
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(texts) + 1
    assert {r.doc_id: r.class_id for r in got} == dict(enumerate(want))
    kept = [r.doc_id for r in got if r.is_kept]
    assert sorted(kept) == sorted(set(want))
    left = neardup.without_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(set(want))
    assert neardup.near_duplicates(empty(docs)).count() == 0


def mixed_boilerplate(rng, pairs):
    """Texts of 12 of 20 common segments and 16 own words, in pairs with one word changed; their classes by brute force."""
    segments = [prose(rng, 20) for _ in range(20)]
    out = []
    for i in range(pairs):
        w = " ".join(rng.sample(segments, 12)) + " " + " ".join(f"own{i}x{k}" for k in range(16))
        v = w.split()
        for k in range(2):
            v[rng.randrange(240)] = f"edit{i}x{k}"
        out += [w, " ".join(v)]
    return out


def linked_by_counting(texts):
    sets = []
    for x in texts:
        w = x.split()
        sets.append({hash(tuple(w[i : i + 5])) for i in range(len(w) - 4)})
    df = defaultdict(int)
    for s in sets:
        for g in s:
            df[g] += 1
    column = {g: i for i, g in enumerate(g for g, n in df.items() if n > 1)}
    m = np.zeros((len(texts), len(column)), np.float32)
    for i, s in enumerate(sets):
        m[i, [column[g] for g in s if g in column]] = 1
    size, links = np.array([len(s) for s in sets]), set()
    for a in range(0, len(texts), 1000):
        both = m[a : a + 1000] @ m.T
        x, y = np.nonzero(both >= 0.8 * (size[a : a + 1000, None] + size[None] - both) - 1e-6)
        links |= {(int(i) + a, int(j)) for i, j in zip(x, y) if i + a < j}
    return links


def test_links_of_mixed_boilerplate(spark):
    texts = mixed_boilerplate(random.Random(3), 600)
    want = linked_by_counting(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    class_of = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    lost = [x for x in want if class_of[x[0]] != class_of[x[1]]]
    assert len(want) > 550 and not lost
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in want:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert [class_of[i] for i in range(len(texts))] == [find(i) for i in range(len(texts))]


def test_chain_of_truncated_copies(spark):
    """Each text is like its neighbours only; many share every band's bucket."""
    rng = random.Random(4)
    w = prose(rng, 400).split()
    texts = [" ".join(w[:n]) for n in range(60, 401, 4)]
    got = neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (1, "x y z u v w"), (2, "x y z u v w")], "doc_id long, text string")
    got = neardup.near_duplicates(df).collect()
    assert len(got) == 5 and {r.class_id for r in got if r.doc_id is not None} == {1} and sum(r.is_kept for r in got if r.doc_id is not None) == 1
    assert all(r.is_kept and r.class_id is None for r in got if r.doc_id is None)


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(3)
    g = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    w = np.ones(300)
    a, b = np.arange(0, 200), np.arange(50, 250)  # 150 of 250 in common
    row = np.concatenate([np.zeros(200, np.int64), np.ones(200, np.int64)])
    idx = np.concatenate([a, b])
    sig = neardup.prob_min_hash(row, g[idx], w[idx], 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.04


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(30)] + [(200, 200 + i) for i in range(30)]
    got = {r.id: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


# 7 -----------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("least", [0, 8])
def test_warc(spark, least, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 3)
    big = "<p>same é\r\n\r\nWARC/1.1</p>"
    pages = [(i, f"http://host{i % 3}.example.org/p{i}", big if i % 2 else f"page {i}") for i in range(20)]
    pages += [(20, None, None), (21, "http://host1.example.org/p1", ""), (None, "x", "null id"), (22, "HTTP://Host1.Example.org:80/p1#f", "tiny"), (23, "odd\nurl", "tiny")]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, key string")
    archive, index = new_dir(spark, "t-warc"), new_dir(spark, "t-cdx")
    got = {r.page_id: r for r in warc.archive_pages(df, archive, index, least).collect()}
    assert len(got) == len(pages)
    for i, _, html in pages:
        x = (html or "").encode()
        same = [p[0] for p in pages if (p[2] or "") == (html or "") and p[0] is not None]
        top = max(same) if same else None
        revisit = len(x) >= least and top is not None and i != top
        r = got[i]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(x), warc.base32_sha1(x), "revisit" if revisit else "response", top if revisit else None), i
    assert warc.archive_pages(df.where("page_id < -1"), new_dir(spark, "t-warc"), new_dir(spark, "t-cdx")).count() == 0


def test_url_keys(spark):
    got = [r[0] for r in spark.createDataFrame([("http://User@A.b.C:8080/X?y=1#z",), (None,), ("nonsense",)], "u string").select(warc.url_key(F.col("u"))).collect()]
    assert got == ["c,b,a)/x?y=1", "", "nonsense"]


def test_equal_records_are_alike(spark):
    rows = [(5, "http://a.example", "same"), (5, "http://a.example", "same"), (4, "http://a.example", "same"), (5, "http://b.example", "same"), (3, None, "same")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.record_type, r.refers_to or 0) for r in warc.archive_pages(df, new_dir(spark, "t-warc"), new_dir(spark, "t-cdx")).collect())
    # the greatest (page_id, url) is the response
    assert got == [(3, "revisit", 5), (4, "revisit", 5), (5, "response", 0), (5, "revisit", 5), (5, "revisit", 5)]


# 8 -----------------------------------------------------------------------------------------------------------------
def test_mix_takes_equal_ids_alike(spark):
    df = spark.createDataFrame([(i // 2, "a b c", f"s{i % 2}") for i in range(40)] + [(None, "x", None), (None, "y z", None), (1, None, "s1")], "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == 43
    for s in ("s0", "s1", None):
        for i in {r.doc_id for r in got if r.source == s}:
            assert len({r.taken // r.size for r in got if r.source == s and r.doc_id == i and r.size}) <= 1


def test_mix(docs):
    got = mixing.mix(docs).collect()
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    sources = sorted(by, key=lambda s: (s is None, s or ""))
    size = {s: sum(r.size for r in by[s]) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    full, total = set(), sum(size.values())
    while True:
        rest = total - sum(3 * size[s] for s in full)
        free = sum(weight[s] for s in sources if s not in full)
        more = {s for s in sources if s not in full and weight[s] * rest / free > 3 * size[s]}
        if not more:
            break
        full |= more
    for s in sources:
        target = 3 * size[s] if s in full else weight[s] * rest / free
        assert all(abs(r.target - target) < 1e-6 * max(1, target) and r.source_size == size[s] for r in by[s])
        taken, most = sum(r.taken for r in by[s]), max(r.size for r in by[s])
        assert abs(taken - target) <= most and all(r.taken <= 3 * r.size for r in by[s])
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(docs).collect()), key=repr)
    left = mixing.mixed_documents(docs)
    assert left.columns == [*docs.columns, "mix_size", "mix_taken"] and {(r.doc_id, r.mix_taken) for r in left.collect()} == {(r.doc_id, r.taken) for r in got if r.taken}
    assert mixing.mix(empty(docs)).count() == 0


# 9 -----------------------------------------------------------------------------------------------------------------
def test_quality(spark, docs):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        kind = i % 3
        w = prose(rng, rng.randint(20, 80)).split()
        if kind == 0:
            w[rng.randrange(len(w))] = rng.choice(["vilewordone", "vilewordtwo"])
        if kind == 1:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w)))
        labels.append((i, 0 if kind == 1 else 1, 1 if kind == 0 else 0))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([x for x in labels if x[0] < 600] + [(None, 1, 1), (5000, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(df, lab)
    held = [r for r in quality.classify(df, model).collect() if r.doc_id >= 600]
    right = sum(r.keep == (r.doc_id % 3 == 2) for r in held) / len(held)
    assert right > 0.93
    assert all(abs(r.expected_grade - (r.p_good + model.tail(np.array([r.score]), 1)[0])) < 1e-9 for r in held)
    assert np.all(np.diff(model.thresholds) >= 0)
    scored = quality.classify(docs, model)
    assert scored.count() == docs.count() and scored.where("p_good IS NULL").count() == 0
    good = quality.select_good(docs, model)
    assert good.columns == docs.columns
    none = quality.fit(df, lab.where("doc_id < -1"))
    assert quality.classify(df, none).where("keep").count() == 900
    assert quality.classify(empty(docs), model).count() == 0


# 10 ----------------------------------------------------------------------------------------------------------------
def test_media(spark, docs, texts):
    got = media.media_columns(docs, new_dir(spark, "t-media")).collect()
    assert len(got) == len(texts) + 1
    seen = {}
    for r in got:
        x = (texts[r.doc_id] or "").encode()
        p = x + b"\xff" * (max(576, -(-len(x) // 576) * 576) - len(x))
        m = media.wav(p)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) == (len(x), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(m), hashlib.sha256(m).hexdigest())
        assert seen.setdefault(x, r.feature) == r.feature
    assert media.media_columns(empty(docs), new_dir(spark, "t-media")).count() == 0


def test_cuts_are_content_defined():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, 300_000).astype(np.uint8)
    a = media.cuts(x)
    b = media.cuts(np.concatenate([rng.integers(0, 256, 77).astype(np.uint8), x]))
    pieces = lambda v, c: {v[i:j].tobytes() for i, j in zip([0, *c], c)}
    assert a[-1] == len(x) and all(j - i <= media.MOST for i, j in zip([0, *a], a))
    assert len(pieces(x, a) & pieces(np.concatenate([np.zeros(77, np.uint8), x]), b)) > 0.9 * len(a)


def test_damaged_pack_is_noticed(spark, docs):
    folder = new_dir(spark, "t-media")
    refs = media.store(docs.where("doc_id < 3"), folder)
    import os

    for name in os.listdir(folder.removeprefix("file://")):
        with open(f"{folder.removeprefix('file://')}/{name}", "r+b") as f:
            f.seek(40)
            f.write(b"\0\0\0\0")
    with pytest.raises(Exception):
        media.rebuild(refs, folder).collect()
    assert json.dumps("")
