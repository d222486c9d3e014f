"""Prefix trie, page differencing and spelling variants, against SQL and brute force."""

from __future__ import annotations

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_MID
from odd_rows import no_docs, odd_docs  # noqa: F401 - fixtures
from test_pairs import same

from meterwise.llm import page_diff, prefix_trie, spelling
from meterwise.llm.queries import QUERIES


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_spelling_trie"])
def test_equals_sql(spark, duck, name):
    same(spark, duck, name, SF_MID)


# -- prefix trie -----------------------------------------------------------

def nodes_of(sequences):
    """Rows of the trie of {conv_id: sequence}, from the definition."""
    members, below = {}, {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], set()).add(c)
    for s in members:
        if s:
            below.setdefault(s[:-1], []).append(s)
    out, sums = [], {}
    for s in sorted(members, key=len, reverse=True):
        inner = below.get(s, [])
        sums[s] = (sum(sums[x][0] for x in inner) or 1,
                   sum(sums[x][1] for x in inner) + ((len(members[s]) - 1) * len(s[-1][1].encode()) if s else 0))
        ends = ",".join(str(c) for c in sorted(members[s]) if sequences[c] == s)
        out.append((min(members[s]), len(s), min(members[s[:-1]]) if s else None, len(members[s]), len(inner), *sums[s],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            turns.setdefault(c, []).append((-10**9 if t is None else t, r or "", x or ""))
    return {c: tuple((r, x) for _, r, x in sorted(v)) for c, v in turns.items()}


def trie_rows(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(df.columns) == sorted(columns)
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def odd_turns(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"hot {t}" if c % 3 else f"own {c} {t}") for c in range(60) for t in range(c % 7)]
    rows += [(100, None, None, None), (100, 3, "user", "é" * 50), (101, 1, "user", "tie"), (101, 1, "user", "tie"), (None, 0, "user", "nobody"),
             (102, 0, "user", "word " * 40000), (-7, 0, "user", "below zero"), (-10, 2, "assistant", None), (103, 0, "a", "bc"), (104, 0, "ab", "c")]
    random.Random(1).shuffle(rows)
    turns = spark.createDataFrame([(*r, 1, b"k") for r in rows], "conv_id long, turn long, role string, text string, depth int, chain binary")
    return rows, turns.repartition(5)


def test_trie_of_odd_rows(spark):
    rows, turns = odd_turns(spark)
    assert trie_rows(prefix_trie.trie(turns)) == nodes_of(conversations([r for r in rows if r != (100, None, None, None)]))
    own = conversations(rows)
    rebuilt = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - int(math.fmod(c, 5)), ())[:h] + s[h:]
    assert trie_rows(prefix_trie.trie(prefix_trie.rebuilt(turns))) == nodes_of(rebuilt)


def test_trie_is_exact_where_the_sketch_is_too_small(spark):
    rows, turns = odd_turns(spark)
    whole = nodes_of(conversations([r for r in rows if r != (100, None, None, None)]))
    chains = prefix_trie.written(prefix_trie.chains(turns, "conv_id", "turn", "role", "text"), "chains")
    exact = Counter(r["chain"][i:i + 16] for r in chains.collect() for i in range(0, len(r["chain"]), 16))
    for width in (8, 1 << 14):  # never fewer than are shared; with room to spare, hardly more
        for r in prefix_trie.screen(chains, width).collect():
            shared = sum(exact[r["chain"][i:i + 16]] > 1 for i in range(0, len(r["chain"]), 16))
            assert r["shared"] >= shared and (width == 8 or r["shared"] <= shared + 1)
    assert trie_rows(prefix_trie.trie(turns, sketch_bytes=512)) == whole


def test_ids_of_one_node_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    ids = random.Random(3).sample(range(10**6), 400)
    rows = spark.createDataFrame([(b"hot", i) for i in ids] + [(b"one", 5), (b"two", 11), (b"two", 2)], "digest binary, conv long").repartition(9)
    found = {bytes(r["digest"]): r["ends_sha256"] for r in prefix_trie.ends_of(rows).collect()}
    assert found == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in [(b"hot", ids), (b"one", [5]), (b"two", [2, 11])]}


def test_trie_of_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(none).count() == 0 and prefix_trie.trie(prefix_trie.rebuilt(none)).count() == 0


# -- page differencing -----------------------------------------------------

def test_text_of_given_pages(spark):
    """The given pages mark their article, so its text can be had by a pattern."""
    found = {r["page_id"]: r for r in QUERIES["op12_page_diff"](spark, SF_MID).collect()}
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet").collect()
    assert len(found) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*)</article>", p["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", body))).split())
        assert found[p["page_id"]]["text"] == want and found[p["page_id"]]["n_chars"] == len(want) and found[p["page_id"]]["url"] == p["url"]


@pytest.mark.parametrize("page,want", [
    ('<div class="page has-sidebar"><header><h1>Site</h1></header><div id="menu"><li>A</div><main><h1>T&eacute;st</h1><p>Hello<b>wor</b>ld<br>x&nbsp;y</p>'
     '<section class="comments"><article>nice</article></section></main><footer>f</footer>', ["Tést", "Helloworld x y"]),
    ("<p>a < b and c > d</p><p>e", ["a < b and c > d", "e"]),
    ('<article><header><h1>T</h1></header><p>x<span class="ad">AD</span>y<article><p>reply</article><form>f</form></article><p>z', ["T", "xy"]),
    ('<form><article><p>in a form</article></form><div class="cookieNotice">c</div>', ["in a form"]),
    ('<script>var a="<p>";</script>ok<style>p{}', ["ok"]), ('<p title="a>b">q</p><p class="x', ["q"]),
    ("<!-- <article>no</article> --><ul><li>1<li hidden>2<li>3</ul>", ["1", "3"]), ("", []), ("<article></article><p>after", [])])
def test_lines_of_awkward_pages(page, want):
    assert page_diff.main_lines(*page_diff.read_lines(page)) == want


@pytest.mark.parametrize("kept", [1 << 29, 4])
def test_alignment_is_longest(monkeypatch, kept):
    monkeypatch.setattr(page_diff, "KEPT_BITS", kept)
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 14))] for _ in range(2))
        size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
        met = page_diff.common(a, b)
        assert len(met) == size[-1][-1] and all(a[i] == b[j] for i, j in met) and all(p < q and s < t for (p, s), (q, t) in zip(met, met[1:]))


def site(host, n, seed, article=False):
    """Pages of one host whose template carries no telling names, with copies among them, as (url, html, main text)."""
    rng = random.Random(seed)
    words = lambda k: " ".join(rng.choice("alder birch cedar dogwood elm fir ginkgo hazel".split()) + str(rng.randint(0, 999)) for _ in range(k))
    bodies = [[words(30) for _ in range(4)] for _ in range(n)]
    for i in range(0, n - 1, 9):
        bodies[i + 1] = bodies[i]  # a copy at the next URL
    out = []
    for i, body in enumerate(bodies):
        text = "".join(f"<p>{x}</p>" for x in body)
        text = f"<article>{text}</article>" if article else f"<div>{text}</div>"
        out.append((f"https://{host}/{'abc'[i % 3]}/{i:04d}", f"<div>{host} home</div><div>About us</div>{text}<div>All rights {host}</div>", " ".join(body)))
    return out


def test_differencing_deletes_the_template(spark, monkeypatch):
    pages = site("one.example.org", 150, 1) + site("two.example.org", 40, 2, article=True)
    single = [("https://lone.example.org/x", "<div>only</div><p>page</p>", "only page")]
    rows = [(i, u, h, 1, b"d") for i, (u, h, _) in enumerate(pages + single)]
    rows += [(900, None, None, 1, b"d"), (901, "u", "", 1, b"d"), (None, "https://lone.example.org/x", single[0][1], 1, b"d"), (5, *rows[5][1:]),
             (902, "https://long.example.org/", "<article>" + "<p>line é</p>" * 30000 + "</article>", 1, b"d")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int, digest binary").repartition(6)
    want = {i: t for i, (_, _, t) in enumerate(pages + single)} | {900: "", 901: "", None: "only page", 902: " ".join(["line é"] * 30000)}
    for tile in (64, 5):  # the tiles' size does not matter
        monkeypatch.setattr(page_diff, "TILE", tile)
        found = page_diff.main_text(frame).collect()
        assert len(found) == len(rows) and {r["page_id"]: r["text"] for r in found} == want
        assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert page_diff.main_text(frame.where("false")).count() == 0


def runs_of_copies(host, runs, seed):
    """(url, html) in path order: runs of pages that differ from each other by a line, or drop one, between a head and a foot each run shares with others."""
    rng = random.Random(seed)
    words = lambda k: " ".join(rng.choice("alder birch cedar dogwood elm fir ginkgo hazel".split()) + str(rng.randint(0, 999)) for _ in range(k))
    out = []
    for run in runs:
        body = [words(12) for _ in range(15)] * rng.choice([1, 1, 2])
        for _ in range(run):
            lines = [f"{host} home", f"No {rng.randint(0, 3)}", *body, f"seen {rng.randint(0, 10**9)}", rng.choice(["About us", "All rights"])]
            if rng.random() < 0.2:
                del lines[rng.randrange(2, 2 + len(body))]
            out.append((f"https://{host}/{len(out):05d}", "".join(f"<p>{x}</p>" for x in lines)))
    return out


def test_partners_behind_long_runs_of_copies(spark, monkeypatch):
    """Copies are passed however many they are; by definition: the nearest page that is no copy, on either side."""
    sites = [runs_of_copies("run.example.org", [1, 30, 2, 1, 70, 12, 1], 3), runs_of_copies("copies.example.org", [40], 4), runs_of_copies("ends.example.org", [25, 9], 5),
             runs_of_copies("few.example.org", [1] * 9 + [9, 1], 6)]
    want = {}
    for pages in sites:
        read = [page_diff.read_lines(h)[0] for _, h in pages]
        lines = [[t for _, t in x] for x in read]
        for i, mine in enumerate(lines):
            lost = []
            for others in (range(i - 1, -1, -1), range(i + 1, len(lines))):
                for j in others:
                    met = page_diff.common(*((mine, lines[j]) if i < j else (lines[j], mine)))
                    if sum(len(lines[min(i, j)][p]) for p, _ in met) < page_diff.COPY * min(sum(map(len, mine)), sum(map(len, lines[j]))):
                        lost.append({p if i < j else q for p, q in met})
                        break
            lost = set.intersection(*lost) if lost else set()
            want[pages[i][0]] = " ".join(t for k, t in enumerate(mine) if k not in lost)
    home = [u for u, t in want.items() if "home" not in t]
    assert {"https://run.example.org/00015", "https://run.example.org/00070", "https://ends.example.org/00003"} <= set(home)
    assert not any("copies" in u for u in home)
    rows = [(i, u, h) for i, (u, h) in enumerate(p for pages in sites for p in pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    for tile, block in ((64, 256), (5, 4)):  # neither size matters
        monkeypatch.setattr(page_diff, "TILE", tile)
        monkeypatch.setattr(page_diff, "BLOCK", block)
        assert {r["url"]: r["text"] for r in page_diff.main_text(frame).collect()} == want


def test_summaries_promise_only_copies(monkeypatch):
    rng = random.Random(8)
    size = {x: rng.choice([1, 3, 40]) for x in range(12)}
    promised = compared = 0
    for _ in range(400):
        base = [rng.randint(0, 11) for _ in range(rng.randint(1, 14))]
        pages = []
        for _ in range(6):
            page = [x if rng.random() > 0.04 else rng.randint(0, 11) for x in base if rng.random() > 0.02] or [0]
            pages.append((np.array(page), np.array([size[x] for x in page]), np.zeros(len(page), int)))
        near, far = page_diff._Block(pages[:3]).summary(0, 3), page_diff._Block(pages[3:]).summary(0, 3)
        others = [not page_diff._paired(pages[0], p)[1] for p in pages]
        for lines in (0, 1 << 17):  # without and with summaries
            monkeypatch.setattr(page_diff, "LINES", lines)
            block, mine = page_diff._Block(pages), page_diff._page_summary(pages[0])
            assert [block.first_other(pages[0], mine, i, 0, 6) for i in range(6)] == [next((j for j in range(i, 6) if others[j]), None) for i in range(6)]
        if page_diff._surely_copies(near, far):
            promised += 1
            assert all(page_diff._paired(a, b)[1] for a in pages[:3] for b in pages[3:])
        told = page_diff._copies(pages[:3], pages[3:])
        if told is not None:
            compared += 1
            assert told.tolist() == [[bool(page_diff._paired(a, b)[1]) for b in pages[3:]] for a in pages[:3]]
    assert 50 < promised < 400 and 50 < compared < 400


# -- spelling --------------------------------------------------------------

def words_of(docs, noise):
    n = Counter()
    for d, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            n[w[:h % len(w)] + w[h % len(w) + 1:] if noise and h % noise == 0 else w] += 1
    return {w: k for w, k in n.items() if k >= 3 and len(w) >= 5}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def groups_of(n):
    best = {}
    for w in n:
        others = [v for v in n if near(w, v)]
        best[w] = (len(others), min(((-n[v], v) for v in others), default=None))
    form = {w: b[1] if b and -b[0] >= 2 * n[w] else None for w, (_, b) in best.items()}
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n[w], best[w][0], form[w], n[form[w]] if form[w] else None, root))
    return out


def spelled(df):
    return {tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()}


@pytest.mark.parametrize("noise", [None, 7])
def test_variants_of_random_words(spark, noise):
    rng = random.Random(8)
    docs = []
    for i in range(120):  # few letters, so that prefixes, runs of a letter and chains of words abound
        docs.append((i, " ".join("".join(rng.choice("aabÉz") for _ in range(rng.randint(4, 8))) for _ in range(60))))
    docs += [(500, "a" * k) for k in range(5, 40) for _ in range(3)] + [(501, "letter " * 40 + "lettar " * 9 + "lettor " * 9 + "lettr " * 4 + "betterx " * 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert spelled(spelling.variant_groups(frame, noise=noise)) == groups_of(words_of(docs, noise))


def test_variants_of_odd_rows(spark, odd_docs, no_docs):
    long = "x" * 3000 + "é" * 3000
    more = spark.createDataFrame([(1, long, 1), (2, long, 1), (3, long + " " + long[1:], 1), (4, (long[1:] + " ") * 9, 1), (4, None, 1)], "doc_id long, text string, id int")
    docs = [(r[0], r[1]) for r in odd_docs.select("doc_id", "text").collect()] + [(r[0], r[1]) for r in more.collect()]
    both = odd_docs.select("doc_id", "text", "id").unionByName(more)
    assert spelled(spelling.variant_groups(both)) == groups_of(words_of(docs, None))
    assert spelling.variant_groups(no_docs).count() == 0
    with pytest.raises(ValueError):
        spelling.variant_groups(no_docs, ratio=1)
