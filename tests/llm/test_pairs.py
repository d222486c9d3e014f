"""Near duplicates of vectors and texts, and benchmark passages, against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import SF_MID
from odd_rows import no_docs, odd_docs  # noqa: F401 - fixtures

from meterwise.llm import nn_descent, parity_join, winnowing
from meterwise.llm.common import PLAIN_WORDS, WordHasher, components
from meterwise.llm.queries import ORACLES, QUERIES


def same(spark, duck, name, sf_dir):
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    want = duck(sf_dir).execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", ["op1_nn_descent", "op4_parity_join", "op7_winnowing", "op8_warc_index", "op10_chat_format"])
def test_equals_sql(spark, duck, name):
    same(spark, duck, name, SF_MID)


def test_components_of_chain_and_hub(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}}


def test_vectors_odd_rows_and_dense_cluster(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(8)
    rows = [(i, (centre + 0.05 * rng.standard_normal(8)).tolist()) for i in range(40)]
    rows += [(100 + i, rng.standard_normal(8).tolist()) for i in range(60)]
    odd = [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, []), (204, [None] * 8), (205, [float("inf")] * 8),
           (206, [1.0, 2.0]), (207, [2.0, 4.0]), (0, rows[0][1]), (None, rows[0][1])]
    found = nn_descent.near_links(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"))
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found.collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    extra = near[0].astype(int) * 2  # two more copies of vector 0
    want = {i: int(n) - 1 + int(e) for (i, _), n, e in zip(rows, near.sum(axis=1), extra)}
    assert {(i, n) for i, n, _, _ in got if i is not None and i < 200} == set(want.items())
    assert {g for g in got if g[0] is not None and g[0] >= 200} == {*((i, 0, i, True) for i in range(200, 206)), (206, 1, 206, True), (207, 1, 206, False)}
    assert (None, want[0], 0, False) in got
    assert nn_descent.near_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def jaccard_brute(texts):
    import re
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    at = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                low, high = sorted((at[i], at[j]))
                at = [low if k == high else k for k in at]
    return sets, at


def test_jaccard_at_the_threshold_across_bands(spark):
    rng = np.random.default_rng(5)
    texts = []
    for n in (5, 6, 8, 9, 12, 60, 66, 70, 90, 250, 300, 1100):
        base = [f"w{rng.integers(10**9)}" for _ in range(n)]
        texts.append(" ".join(base))
        for share in (0.02, 0.1, 0.14, 0.15, 0.2, 0.34):  # what is cut off the end: around the threshold
            texts.append(" ".join(base[: max(1, round(n * (1 - share)))]))
        for edits in (1, max(1, n // 70), max(1, n // 35)):  # scattered changes
            changed = list(base)
            for k in rng.choice(n, edits, replace=False):
                changed[k] = "new"
            texts.append(" ".join(changed))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"u{k}x{i}" for i in range(70)) for k in range(30)]
    sets, want = jaccard_brute(texts)
    found = {r["doc_id"]: r for r in parity_join.jaccard_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [found[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [found[i]["component_id"] for i in range(len(texts))] == want


def test_jaccard_odd_rows(spark, odd_docs, no_docs):
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in parity_join.jaccard_classes(odd_docs).collect()), key=repr)
    assert [f for f in found if f[0] in (1, 2, 3)] == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert [f for f in found if f[0] in (5, 6, 7)] == [(5, 1, 5), (6, 1, 5), (7, 1, 5), (7, 1, 5)]
    assert len(found) == odd_docs.count() and parity_join.jaccard_classes(no_docs).count() == 0


@pytest.mark.parametrize("length", range(1, 13))
def test_winnowing_finds_every_shared_window(length):
    rng = np.random.default_rng(length)
    k, w = winnowing.family(length)
    size = min(length, 10)
    assert k + w - 1 == size
    a = rng.integers(0, 4, 300).astype(np.uint64) + np.uint64(1)
    b = rng.integers(0, 4, 300).astype(np.uint64) + np.uint64(1)
    b[100:100 + size] = a[50:50 + size]
    ours, theirs = (set(winnowing.fingerprints(x, k, w)[1].tolist()) for x in (a[50:50 + size], b))
    assert ours & theirs


def test_contamination_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "two three FOUR"), (2, None), (3, "!!"), (1, "über öl endoftext"), (11, "tok " * 12), (None, "five words and")],
                                  "item_id long, text string")
    found = {(r["doc_id"], r["text"]): r for r in winnowing.contamination(odd_docs, items).collect()}
    by_id = {k[0]: r for k, r in found.items()}
    assert (by_id[5]["n_words"], by_id[5]["n_hit"], by_id[5]["items"]) == (4, 3, ["1"])
    assert by_id[8]["n_hit"] == 30000 and by_id[8]["items"] == ["11"] and by_id[10]["items"] == []
    assert by_id[None]["items"] == [""] and by_id[1]["n_words"] == 0 and by_id[5]["spans"][0]["start"] == 1
    assert winnowing.contamination(no_docs, items).count() == 0
    assert winnowing.contamination(odd_docs, items.where("false")).where("n_hit > 0").count() == 0


def vectors(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def tight_families(rng, families, size, dim, across):
    """Families of near copies (cosine about 0.999 inside) around centres whose cosine is ``across``."""
    common = rng.standard_normal(dim)
    common /= np.linalg.norm(common)
    out = []
    for _ in range(families):
        own = rng.standard_normal(dim)
        own -= (own @ common) * common
        centre = np.sqrt(across) * common + np.sqrt(1 - across) * own / np.linalg.norm(own)
        out.append(centre + 0.03 / np.sqrt(dim) * rng.standard_normal((size, dim)))
    return np.concatenate(out)


@pytest.mark.parametrize("block", [512, 16])
def test_tight_families_are_one_component(spark, monkeypatch, block):
    monkeypatch.setattr(nn_descent, "BLOCK", block)
    x = tight_families(np.random.default_rng(11), 2, 20, 64, 0.97)
    x = np.concatenate([x, np.random.default_rng(12).standard_normal((60, 64))])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    n_links = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert (n_links[:40] == 39).all() and not n_links[40:].any()
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nn_descent.near_links(vectors(spark, x)).collect()}
    assert found == {i: (int(n), 0 if i < 40 else i) for i, n in enumerate(n_links)}


@pytest.mark.parametrize("links, others, kept", [(8, 7, 10), (10, 5, 10), (12, 3, 12), (60, 5, nn_descent.MOST)])
def test_lists_are_enlarged_for_links(spark, links, others, kept):
    rows = [(1, 100 + i, 0.96 + i * 1e-4, False, True) for i in range(links)] + [(1, 900 + i, 0.5, False, True) for i in range(others)]
    edges = spark.createDataFrame(rows + rows[:3], "u long, v long, sim double, own boolean, fresh boolean")
    found = nn_descent._top(edges, nn_descent.K, 0.95, nn_descent.MOST).collect()
    assert len(found) == kept and sum(r["sim"] > 0.95 for r in found) == min(links, kept)


def test_tables_grow_with_the_blocks():
    near = 1 - np.arccos(0.95) / np.pi
    for count in (100, 10**4, 10**5, 10**7, 10**8):
        together = near ** nn_descent._bits(count)
        assert 1 - (1 - together) ** nn_descent._tables(count, 0.95) >= nn_descent.TARGET


def test_audit_sees_few_links_and_what_is_missed_is_an_error(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 16))
    x[1::300] = x[::300] + 0.01 * rng.standard_normal((10, 16))  # 10 pairs among 3,000
    found = nn_descent.near_links(vectors(spark, x))
    assert found.where("n_links > 0").count() == 20
    empty = spark.createDataFrame([], "u long, v long, sim double, own boolean, fresh boolean, rank int")
    monkeypatch.setattr(nn_descent, "_search", lambda *args: (empty, empty.select("u", "v", "sim")))
    with pytest.raises(RuntimeError, match="recall"):
        nn_descent.near_links(vectors(spark, x)).count()


def test_repeated_ids_with_other_texts(spark):
    """An id that stands for two texts hides neither: each row is judged by its own text."""
    import random

    rng = random.Random(12)
    words = [f"w{i}" for i in range(400)]

    def text():
        return [rng.choice(words) for _ in range(60)]

    rows = []
    for g in range(40):
        a, b = text(), text()
        near_a, near_b = a[:-1] + ["end"], b[:-1] + ["end"]
        rows += [(10 * g + 1, a), (10 * g + 1, b), (10 * g + 2, near_a), (10 * g + 3, near_b), (10 * g + 3, near_b)]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(6)
    classes = jaccard_brute([" ".join(t) for _, t in rows])[1]
    least = {}
    for (i, _), c in zip(rows, classes):
        least[c] = min(least.get(c, i), i)
    want = sorted((i, least[c]) for (i, _), c in zip(rows, classes))
    assert sorted((r["doc_id"], r["component_id"]) for r in parity_join.jaccard_classes(frame).collect()) == want


def test_sets_survive_packing_and_full_tables_of_ids(spark, monkeypatch):
    rng = np.random.default_rng(1)
    s = np.unique(rng.integers(0, 2 ** 63, 500, dtype=np.uint64))
    assert (parity_join.unpacked(parity_join.packed(s)) == s >> np.uint64(16)).all()
    monkeypatch.setattr(parity_join, "MOST_BITS", 64)  # a table that lists nearly everything only costs time
    monkeypatch.setattr(parity_join, "RANGE", 50)
    texts = [" ".join(f"w{(i // 3) * 50 + j}" for j in range(40)) + (f" x{i}" if i % 3 else "") for i in range(90)] * 2
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert {(r["doc_id"], r["component_id"]) for r in parity_join.jaccard_classes(frame).collect()} == {(i, (i % 90) // 3 * 3) for i in range(180)}


def test_hits_of_repeated_words():
    """Runs along every diagonal equal a search for each window; long repeats stay quick."""
    import random
    import time

    rng = random.Random(8)
    for _ in range(60):
        words = rng.choices("ab", k=rng.randint(1, 80)) + rng.choices("abcdefgh", k=10)
        item = rng.choices("ab", k=rng.randint(1, 30)) if rng.random() < 0.5 else words[5:5 + rng.randint(3, 40)]
        size = min(10, len(item))
        at, g = winnowing.fingerprints(WordHasher(PLAIN_WORDS)(" ".join(words).encode()), *winnowing.family(len(item)))
        windows = {tuple(item[i:i + size]) for i in range(len(item) - size + 1)}
        want = [any(tuple(words[j:j + size]) in windows for j in range(max(0, i - size + 1), i + 1)) for i in range(len(words))]
        hit, ids = winnowing._hits(words, [("x", " ".join(item), list(at))], 10)
        assert hit.tolist() == want and ids == (["x"] if any(want) else [])
    begun = time.process_time()
    hit, _ = winnowing._hits(["same"] * 20000, [("x", "same " * 400, list(range(20000)))], 10)
    assert hit.all() and time.process_time() - begun < 3


def test_items_beyond_a_row_come_in_parts(spark):
    """A document that meets many items is compared in parts, with the same result; no column of the documents is lost."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(12)]
    bench = [(f"i{i}", " ".join(texts[i % 12].split()[j:j + 10 + i % 25])) for i, j in enumerate(rng.integers(0, 25, 80).tolist())]
    docs = [(i, texts[i] + " " + texts[(i + 1) % 12], "k", "m", 7) for i in range(12)] + [(0, "short", "k", "m", 7), (0, None, "k", "m", 7), (None, texts[3], "k", "m", 7), (99, "no such", "k", "m", 7)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, _key string, _met string, n_hit int")
    items = spark.createDataFrame(bench, "item_id string, text string")
    whole, parts, mixed = ([tuple(r) for r in winnowing.contamination(docs, items, part=p).sort("doc_id", "text").collect()] for p in (1 << 20, 1, 700))
    assert whole == parts == mixed and len(whole) == 16 and {r[2:4] for r in whole} == {("k", "m")}
    assert sum(r[4] > 0 for r in whole) >= 12
