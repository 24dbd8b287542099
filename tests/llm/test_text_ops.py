"""Secrets, decontamination, suffix removal, web pages, mixing and quality rules against plain Python."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkwright.llm import decontam, html_text, queries, suffix_dedup
from linkwright.llm.mixing import mix_sources
from linkwright.llm.oracle import ORACLE_SQL
from linkwright.llm.quality_rules import judge, keep_good
from linkwright.llm.secrets import BASE62, find_secrets, redact, scanner
from linkwright.llm.suffix_dedup import repeated_strings
from tests.llm.test_minhash import shingles


def token(body="a1B2" * 7 + "zz"):
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = BASE62[d] + digits
    return body + digits


def brute_spans(text):
    out = []
    p = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [("assign", m.start(), m.end()) for m in re.finditer(p, text, re.I | re.A) if len(m.group(2)) >= 12]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


CASES = ["token = 'abcdefghijkl' PASSWORD: short secret:secret:abcdefghijklmnop", "AKIAAKIA0123456789 akia0123456789abcd AKIAX",
         "é" * 5 + "api_key=ABCDEF123456 ApiKey \"= zzzzzzzzzzzz", "deadbeefdeadbeef0 deadbeef", "token token = tokentoken= x=yyyyyyyyyyyyy",
         "passwordpasswd=aaaaaaaaaaaaaaaa", "ſecret=aaaaaaaaaaaaaaaa toKen=aaaaaaaaaaaaaaaa", "", "token" * 50 + "=" + "b" * 40,
         "secret: password = 0123456789abcdef0123"]


def test_base_spans_equal_whole_text_patterns(spark, sf_dir):
    texts = CASES + [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    scan = scanner()
    for t in texts:
        assert [s for s in scan(t) if s[0] in ("assign", "access", "hex")] == brute_spans(t or "")


def test_checked_tokens_need_their_checksum():
    good = "ghp_" + token()
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    scan = scanner()
    assert scan(f"x {good} y") == [("github", 2, 2 + len(good))]
    assert scan(f"x {bad} y") == []
    assert scan(f"npm_{token()}")[0][0] == "npm"


def test_secret_rows_and_redaction(spark, messy, messy_rows, empty):
    assert find_secrets(messy).count() == len(messy_rows)
    assert find_secrets(empty).collect() == []
    rows = spark.createDataFrame([(1, CASES[0], 5), (2, None, 6), (3, "plain", 7)], "doc_id long, text string, spans int")
    clean = {r.doc_id: r for r in redact(rows).collect()}
    assert clean[1].text == "[secret]' PASSWORD: short secret:secret:abcdefghijklmnop" and clean[1].spans == 5
    assert clean[2].text is None and clean[3].text == "plain"


def brute_leaks(docs, items):
    out = []
    for d, t, *_ in docs:
        own = shingles(t)
        for i, x in items:
            want = shingles(x)
            n = len(want & own)
            if want and 100 * n >= 75 * len(want):
                out.append((d, i, len(want), n))
    return sorted(out, key=str)


@pytest.mark.parametrize("bound", [decontam.MAX_INDEX_VALUES, 0])
def test_contained_items_equal_brute_force(spark, messy, messy_rows, bound):
    texts = {r[0]: r[1] for r in messy_rows}
    part = texts[7].split()
    items = [(1, " ".join(texts[400].split()[1000:1040])), (2, texts[5].upper()), (3, None), (4, ""), (5, "one two"),
             (6, " ".join(part[:12] + ["new"] * 2)), (7, " ".join(part[:8] + ["new"] * 8)), (7, "one two"), (7, "one two"), (8, texts[5])]
    frame = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, doc_id string")
    got = [tuple(r)[:4] for r in decontam.find_contained(messy, frame, max_index_values=bound).collect()]
    want = brute_leaks(messy_rows, items)
    assert sorted(got, key=str) == want
    clean = decontam.drop_contaminated(messy, frame, max_index_values=bound)
    assert clean.columns == messy.columns
    leaked = {w[0] for w in want if w[0] is not None}
    assert {r.doc_id for r in clean.collect()} - {None} == {r[0] for r in messy_rows} - leaked - {None}


def test_a_sketch_holds_one_more_than_may_be_missed():
    for n in range(1, 300):
        may_miss = n - -(-n * 75 // 100)
        assert decontam.sketch_size(n, 75) >= min(n, may_miss + 1)
        assert 1 <= decontam.needed_hits(n, 75) <= decontam.sketch_size(n, 75)


def brute_removed(rows):
    first = {}
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    for d, b in texts:
        if d is not None:
            for i in range(len(b) - 49):
                first[b[i:i + 50]] = min(d, first.get(b[i:i + 50], d))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        if d is not None:
            for i in range(len(b) - 49):
                if first[b[i:i + 50]] < d:
                    gone[i:i + 50] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed(df):
    return sorted(((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.removed), len(r.removed), r.kept_sha256)
                   for r in df.collect()), key=str)


def test_removed_bytes_equal_brute_force(messy, messy_rows, empty):
    assert removed(repeated_strings(messy)) == brute_removed(messy_rows)
    assert repeated_strings(empty).collect() == []


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 2])
def test_periodic_and_shared_id_texts(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    line = "a line that very many documents of this corpus hold, word for word"
    rows = [(100 + i, f"{i * 7919 % 1000} {line} {i * 104729 % 1000}" + (f" and {line}" if i % 3 else "")) for i in range(60)]
    rows += [(1, "ab" * 100), (2, "ab" * 60 + "c"), (3, "b" + "ab" * 30), (5, "é" * 30), (6, "è" * 30), (7, "x" + "é" * 30),
            (8, "q" * 49), (9, "q" * 49), (10, "first text of ten " * 4), (10, "other text of ten " * 4),
            (11, "other text of ten " * 4 + "!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert removed(repeated_strings(docs)) == brute_removed(rows)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><article>";</script></head><body>
<header class="top"><h1>Site</h1></header><div id="menu"><ul><li>A<li>B</ul></div><!-- <article>no</article> -->
<article><header><h1>T&eacute;st &amp; more</h1></header><p>one <b>two</b>&nbsp;three<br>four<p class="notice">cookie!<p>five
&lt;x&gt;<form><p>name</form><section class="comments"><article>bad</article></section><aside>side</aside>
<div class="ad">buy</div>tail</article><footer>f"""


def test_article_blocks():
    blocks, marked = html_text.read_blocks(PAGE)
    assert marked and blocks == ["Tést & more", "one two three four", "five <x>", "tail"]
    assert html_text.read_blocks(None) == ([], False)
    assert html_text.read_blocks("plain  text") == (["plain text"], False)


@pytest.mark.parametrize("around", ['<div class="content-sidebar-wrap">', '<div class="layout no-sidebar">', '<div class="sidebar">',
                                    '<form action="/">', '<div class="widget"><div id="search">'])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_what_holds_the_article_stays(around, tag):
    ends = "".join(f"</{t}>" for t in re.findall(r"<(\w+)", around)[::-1])
    page = f"<body><nav>menu</nav>{around}<{tag}><p>one</p></{tag}>{ends}<footer>foot</footer></body>"
    assert html_text.read_blocks(page) == (["one"], True)


def test_names_that_only_hold_a_telling_word_stay():
    inside = ('<h2 id="search-and-rescue">one</h2><section id="social-effects">two</section><p class="form-group">three</p>'
              '<div id="related-work">four</div><h3 class="comments">five</h3><div class="site-footer">no</div>'
              '<div class="x ad-box">no</div><div id="comments">no</div>')
    page = f'<article>{inside}</article><div class="related"><article>teaser</article></div>'
    assert html_text.read_blocks(page) == (["one", "two", "three", "four", "five"], True)
    assert html_text.read_blocks('<div hidden><article>no</article></div><p>yes') == (["yes"], False)


@pytest.mark.parametrize("page, blocks", [
    ("<ul><li class=search>x<li>y</ul><article>one</article>", ["one"]),
    ("<dl><dt class=ad>x<dd>y</dl><article>one</article>", ["one"]),
    ("<article><ul><li class=ad>x<li>one</ul>two</article>", ["one", "two"]),
    ("<article><dl><dt class=ad>x<dd>one<dt>two</dl></article>", ["one", "two"]),
    ("<article><table><tr class=ad><td>x<tr><td class=ad>y<td>one<tr><th class=ad>z<th>two</table>three</article>", ["one", "two", "three"]),
    ("<html><head><title>t</title><meta x><body><article>one</article>", ["one"]),
    ("<head><title>t</title><link y><div><article>one</article></div>", ["one"]),
    ("<div><article>one<div class=ad>x</article>no</div><article>two</article>", ["one", "two"]),
    ("<article><section>one<div class=ad><ul><li>x</section>two</article>", ["one", "two"]),
    ("<article><p>one <span class=ad>x<p>two</article>", ["one", "two"]),
    ("<article>one<ul class=menu><li>x<ul><li>y</ul><li>z</ul>two</article>", ["one", "two"]),
    ("<article>one<div class=ad><table><tr><td>x</div>y</table></div>two</article>", ["one", "two"]),
])
def test_missing_end_tags_end_what_is_left_out(page, blocks):
    assert html_text.read_blocks(page) == (blocks, True)


def test_pages_without_article_lose_what_their_host_repeats(spark):
    shared = " ".join(f"boiler{i}" for i in range(14))
    rows = [(i, f"http://h/{i}", f"<div><div>{shared}</div><div>own{i} words of page {i}</div></div>", "x") for i in range(4)]
    rows += [(9, "http://other/1", f"<div>{shared}</div>", "x"), (10, None, None, "x"), (11, "http://h/9", "", "x"),
             (0, rows[0][1], rows[0][2], "x"), (None, "http://h/a", PAGE, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, node string")
    got = sorted(((r.page_id, r.text) for r in html_text.extract(pages).collect()), key=str)
    want = [(i, f"own{i} words of page {i}") for i in (0, 0, 1, 2, 3)]
    want += [(9, shared), (10, ""), (11, ""), (None, "Tést & more\none two three four\nfive <x>\ntail")]
    assert got == sorted(want, key=str)
    assert html_text.extract(pages.limit(0)).collect() == []


def test_marked_articles_lose_what_half_of_their_host_repeats(spark):
    """Class-less blocks on half of a host's articles go; shared passages of fewer pages, copies and near copies stay."""
    def page(host, i, *blocks):
        return (i, f"http://{host}/{i}", "<body><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article></body>")

    own = lambda i: " ".join(f"own{i}x{k}" for k in range(30))
    plea, short = " ".join(f"plea{k}" for k in range(11)), "Share it"
    passage = " ".join(f"passage{k}" for k in range(15))
    rows = [page("h", i, own(i), plea, short, f"end {i}") for i in range(6)] + [page("h", i, own(i), passage) for i in range(6, 9)]
    rows += [page("copies", 20 + i, own(20), f"copy {i // 2}") for i in range(6)]     # near copies and copies
    rows += [page("few", 30 + i, own(30 + i), plea) for i in range(3)] + [page("h", 40, f"{plea} and {own(40)}")]
    want = {i: f"{own(i)}\nend {i}" for i in range(6)} | {i: f"{own(i)}\n{passage}" for i in range(6, 9)}
    want |= {20 + i: f"{own(20)}\ncopy {i // 2}" for i in range(6)} | {30 + i: f"{own(30 + i)}\n{plea}" for i in range(3)}
    want |= {40: f"{plea} and {own(40)}"}
    for parts in (1, 3, 19):    # in whatever batches the pages come
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        assert {r.page_id: r.text for r in html_text.extract(pages).collect()} == want


def filled(sizes):
    """Targets by sharing the excess again until none is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in capped]
        left, share = total - sum(capped.values()), sum(weight[s] for s in rest)
        over = {s: 3 * sizes[s] for s in rest if left * weight[s] / share > 3 * sizes[s]}
        if not over:
            return capped | {s: left * weight[s] / share for s in rest}
        capped |= over


def test_mix_meets_targets(messy, messy_rows, empty):
    got = mix_sources(messy).collect()
    sizes = {}
    for r in messy_rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").encode().split())
    want = filled(sizes)
    assert len(got) == len(messy_rows)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert all(abs(r.target - want[s]) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= 0.5
        assert all(0 <= r.taken <= 3 * r.size for r in mine)
        whole = int(round(want[s])) // max(1, sizes[s])
        assert sum(r.taken not in (whole * r.size, (whole + 1) * r.size) for r in mine) <= 1
    again = sorted(map(tuple, mix_sources(messy.repartition(3)).collect()), key=str)
    assert again == sorted(map(tuple, got), key=str)
    assert mix_sources(empty).collect() == []


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = {}, set()
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            again |= {i + j for i in at for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text), len(lines) - len(set(lines)), len(again))


def test_quality_counts_and_verdicts(spark, messy, messy_rows, empty):
    repeats = [(700, "a b c d e f " * 30, "en", "s0"), (701, " ".join(f"q{i}" for i in range(40)) + " a b c d e a b c d e", "en", "s0")]
    extra = spark.createDataFrame([(*r, *[None] * 10) for r in repeats], messy.schema)
    got = judge(messy.unionByName(extra)).collect()
    want = sorted(((r[0], *counts(r[1])) for r in messy_rows + repeats), key=str)
    assert sorted((tuple(r)[:6] for r in got), key=str) == want
    for r in got:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and (not failed or not r.kept)
    assert judge(empty).collect() == []
    kept = keep_good(messy)
    assert kept.columns == messy.columns
    assert kept.count() == sum(r.kept for r in judge(messy).collect())


def test_outliers_go_and_clean_documents_stay(spark):
    rows = [(i, " ".join(f"word{(i * j) % 97}" for j in range(1, 60 + i % 40)), "en", "s") for i in range(200)]
    rows += [(1000 + i, " ".join(f"x{j}***" for j in range(50)), "en", "s") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in judge(docs).where("kept").collect()}
    base = {r[0] for r in rows[:200] if not (100 * counts(r[1])[4] > 20 * counts(r[1])[0])}
    assert kept == base


def test_junk_in_two_fifths_of_a_group_goes(spark):
    rows = [(i, " ".join(f"word{(i * j) % 97}" for j in range(1, 60 + i % 40)), "en", "s") for i in range(1, 97)]
    rows += [(1000 + i, " ".join(f"x{i}y{j}" + "#*$%"[:1 + (i + j) % 4] for j in range(40 + i % 30)), "en", "s") for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = judge(docs).collect()
    base = {r.doc_id for r in got if not r.base_failed}
    assert len([d for d in base if d < 1000]) <= 96 and len([d for d in base if d >= 1000]) == 64
    assert {r.doc_id for r in got if r.kept} == {d for d in base if d < 1000}
    # the SQL is the same method: it gives the same verdicts here
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([dict(zip(("doc_id", "text", "lang", "source"), r)) for r in rows]))
    want = con.sql(ORACLE_SQL["op2_quality_rules"])
    at = want.columns.index("doc_id"), want.columns.index("kept")
    assert {r[at[0]] for r in want.fetchall() if r[at[1]]} == {r.doc_id for r in got if r.kept}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, sf_dir).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_word_count_expression(spark, messy_rows):
    from linkwright.llm.common import word_count

    rows = [(r[1],) for r in messy_rows] + [("\x0b a \x0c b c ",), ("\n",)]
    got = spark.createDataFrame(rows, "text string").select("text", word_count(F.col("text")).alias("n")).collect()
    for r in got:
        assert r.n == len((r.text or "").encode().split())
