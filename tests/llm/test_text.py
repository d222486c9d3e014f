"""Language, personal data, token counts and quality against brute force and held-out labels."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from conftest import SF_MID
from odd_rows import no_docs, odd_docs  # noqa: F401 - fixtures
from pyspark.sql import functions as F

from meterwise.llm import language_id, pii, quality_qda, token_counts
from meterwise.llm.common import remainder, table
from meterwise.llm.queries import QUERIES, held_out, vocabulary


def greedy_phrases(symbols: str, text: str) -> int:
    """Phrases of the greedy parse of the whole of ``symbols`` with ``text``."""
    n = i = 0
    while i < len(symbols):
        j = i + 1
        while j <= len(symbols) and symbols[i:j] in text:
            j += 1
        i, n = max(i + 1, j - 1), n + 1
    return n


def test_cross_parse_is_the_greedy_parse():
    ref = language_id.Reference(("a", "b"), ("abracadabra alakazam", "simsalabim hokus pokus"))
    parser = language_id.Parser(ref)
    texts = ["abra pokus", "zzz", "x" * 700 + " hokus abra", "", "Ünder 12 ß", "simsalabim " * 200]
    found = parser.predict(texts)

    def letters(t):
        return "".join(chr(65 + int(parser.symbol[ord(c)])) for c in t.lower())

    assert [list(p) for p in found["phrases"]] == [[greedy_phrases(letters(t), letters(r)) for r in ref.texts] for t in texts]
    assert list(found["lang_pred"])[3] == "und" and list(found["lang_pred"])[5] == "b"


@pytest.mark.parametrize("passes", [0, 1, 8])
def test_parse_runs_on_over_columns(monkeypatch, passes):
    """No restart at a column's end, whether the columns settle or a text is parsed through."""
    monkeypatch.setattr(language_id, "BLOCK", 7)
    monkeypatch.setattr(language_id, "CELLS", 50)
    monkeypatch.setattr(language_id, "PASSES", passes)
    rng = random.Random(passes)
    ref = language_id.Reference(("a", "b"), ("abcabcabcabd" * 3, "".join(rng.choice("abcd") for _ in range(60))))
    parser = language_id.Parser(ref)
    texts = ["abc" * 40, "", "ab", "q" * 30, *("".join(rng.choice("abcde ") for _ in range(rng.randint(1, 90))) for _ in range(40))]

    def letters(t):
        return "".join(chr(65 + int(parser.symbol[ord(c)])) for c in t)

    assert [list(p) for p in parser.predict(texts)["phrases"]] == [[greedy_phrases(letters(t), letters(r)) for r in ref.texts] for t in texts]


def test_letters_of_many_scripts_are_told_apart():
    blocks = [range(0x430, 0x450), range(0x3B1, 0x3C9), range(0x10D0, 0x10F1), range(0x561, 0x587), range(0x61, 0x7B)]
    ref = language_id.Reference(tuple("abcde"), tuple("".join(map(chr, b)) for b in blocks))
    parser = language_id.Parser(ref)
    codes = [int(parser.symbol[p]) for b in blocks for p in b]
    assert len(set(codes)) == len(codes) > 100 and min(codes) > 1


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF_MID, "documents").select("doc_id", "lang")
    row = (QUERIES["op2_language_id"](spark, SF_MID).join(docs, "doc_id").where("held_out")
           .agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first())
    assert row[0] > 0.95 and 0 <= row[1] and row[2] <= 1


def test_language_odd_rows(odd_docs, no_docs):
    ref = language_id.reference(odd_docs.where(~held_out(3, 1)))
    found = {(r["doc_id"], r["n_words"]): r for r in language_id.identify(odd_docs, ref).collect()}
    assert {i for (i, _), r in found.items() if r["lang_pred"] == "und"} == {1, 2, 3, 4}
    assert found[(1, "n")]["score"] == 0
    nothing = language_id.reference(no_docs)
    assert {r["lang_pred"] for r in language_id.identify(odd_docs, nothing).collect()} == {"und"}
    assert language_id.identify(no_docs, ref).count() == 0


def base_brute(text: str) -> list[tuple[int, int, int]]:
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@pytest.mark.parametrize("text", [
    "a@b.c@d.e x@@y.z .@a-.b p.q@r", "1.2.3.4.5.6.7.8 0001.2.3.4 256.1.1.1 1.2.3.1000", "4111 1111 1111 1111 4111-1111-1111-1112",
    "+1 (234) 567-8901 +49 30 123456 +1 +123456789012345678", "é 😀 a@b.cd 1.1.1.1", ""])
def test_base_spans_are_the_patterns(text):
    assert pii.base_spans(text) == base_brute(text)


def test_personal_data_on_documents(spark, odd_docs, no_docs):
    docs = table(spark, SF_MID, "documents").select("doc_id", "text")
    found = {r["doc_id"]: r for r in QUERIES["op3_pii"](spark, SF_MID).collect()}
    added = 0
    for r in docs.collect():
        want = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base_brute(r["text"] or "")]
        have = found[r["doc_id"]]["spans"].split(",") if found[r["doc_id"]]["spans"] else []
        assert [s for s in have if s.split(":")[0] in pii.BASE] == want
        for s in have:
            kind, a, b = s.split(":")
            if kind == "secret":
                added += 1
                assert r["text"][int(a):].startswith("AKIA") or re.search(r"=\s*\"?$", r["text"][:int(a)])
    assert added > 0
    model = pii.fit(odd_docs)
    hidden = {r["doc_id"]: r for r in pii.redact(odd_docs, model).collect()}
    assert hidden[9]["text"].startswith("mail [EMAIL] or [PHONE]") and hidden[1]["text"] is None and hidden[2]["text"] == ""
    assert pii.fit(no_docs) == pii.Model(None, None) and pii.detect(no_docs, model).count() == 0


def test_secrets_are_learnt_without_labels():
    votes = np.array([[2, 2, 2, 2], [1, 2, 2, 2], [1, 1, 0, 1], [1, 0, 0, 0]])
    personal, table_ = pii.expectation_maximisation(votes, np.array([50.0, 40, 80, 60]))
    assert (personal.round() == [1, 1, 0, 0]).all() and np.allclose(table_.sum(axis=2), 1)


def test_token_counts_equal_the_library(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [r["text"] for r in table(spark, SF_MID, "documents").where("doc_id % 7 = 3").collect()]
    texts += ["", " ", "  a", "a \n b\n\n c  ", "x<|endoftext|>y <|endoftext|>", "aaaaaaaaaaaaaaa", "it's we'll 'S", "　 x \x1c \x85", "é" * 99]
    assert token_counts.Vocabulary(path).counts(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    for r in token_counts.count_tokens(odd_docs, path).collect():
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((r["text"] or "").encode()), n, n > 512)
    assert token_counts.count_tokens(no_docs, path).count() == 0


def test_quality_held_out(spark):
    labels = table(spark, SF_MID, "labels")
    rows = QUERIES["op6_quality_qda"](spark, SF_MID).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (2, 0), (5, 1), (8, 1), (9, 1), (9, None), (99, 1), (None, 1)], "doc_id long, quality int")
    learn = F.coalesce(remainder("doc_id", 5) >= 0, F.lit(False))
    scored = quality_qda.classify(odd_docs, labels, learn)
    rows = scored.collect()
    assert len(rows) == odd_docs.count() and all(0 < r["score"] < 1 for r in rows)
    assert quality_qda.classify(odd_docs, labels.where("quality = 1"), learn).where("score < 0.9").count() == 0
    for docs, known, where in ((odd_docs, labels.where("false"), learn), (odd_docs, labels, F.lit(False)), (no_docs, labels, learn)):
        unlearned = quality_qda.classify(docs, known, where)
        assert unlearned.count() == docs.count() and unlearned.where("score <> 0.5").count() == 0


def test_quality_equals_dense_densities(spark):
    """Scores equal Gaussian log densities computed densely: two-pass covariances, inverse and determinant by numpy."""
    rng = np.random.default_rng(3)
    d = len(quality_qda.FEATURES)
    x = rng.normal(size=(400, d)) @ rng.normal(size=(d, d)) + 5
    y = (rng.random(400) < 0.4).astype(int)
    x[y == 1] += rng.normal(size=d)
    rows = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, y)], "features array<double>, label int").repartition(5)
    model = quality_qda.fit(rows)
    scale = x.std(axis=0)
    z = (x - x.mean(axis=0)) / scale
    own = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    within = sum(c * (y == k).sum() for k, c in enumerate(own)) / len(y)
    density = []
    for k in (0, 1):
        cov = (1 - quality_qda.POOLED) * own[k] + quality_qda.POOLED * within
        cov = (1 - quality_qda.RIDGE) * cov + quality_qda.RIDGE * np.trace(cov) / d * np.eye(d)
        off = z - z[y == k].mean(axis=0)
        density.append(np.log((y == k).mean()) - 0.5 * (np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off) + np.linalg.slogdet(cov)[1]))
    want = 1 / (1 + np.exp(density[0] - density[1]))
    assert np.allclose(model.score(x), np.clip(want, quality_qda.EDGE, 1 - quality_qda.EDGE), atol=1e-6)


def test_long_pre_tokens_equal_the_library():
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    library, vocab = Tokenizer.from_file(path), token_counts.Vocabulary(path)
    rng = random.Random(5)
    texts = ["a" * 4001, "ab" * 900 + "a", "é" * 2000, "9" * 1500, "=" * 3001, " " * 2000 + "x", "\n" * 1001]
    for alphabet in ("ab", "abc", "etaoinshr", "abcdefghijklmnopqrstuvwxyz", "あいう漢字中文"):
        texts += ["".join(rng.choices(alphabet, k=k)) for k in (511, 512, 513, 600, 1500, 6000)]
    texts.append(" short " + " ".join(texts[:9]) + " tail")
    assert vocab.counts(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    piece = np.array(vocab.symbol[np.frombuffer(texts[-2].encode(), np.uint8)])
    assert (vocab.swept(piece) == vocab.merge(piece, np.zeros(len(piece), np.int64))[0]).all()


def test_language_learns_from_any_part(spark):
    """A long text's piece begins at a hashed place; the sample is bounded and the same for any order of rows."""
    rows = [(i, "x" * 3000 + " " + " ".join(f"word{'abcdefghij'[j % 10]}" for j in range(2000)), "aa") for i in range(40)]
    rows += [(3, "other text of the same id", "aa"), (3, "und noch einer", "bb"), (50, "12 ... only letters: é", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = [language_id.reference(docs.repartition(n), sample_texts=16, sample_symbols=100) for n in (1, 7)]
    assert refs[0] == refs[1] and refs[0].languages == ("aa", "bb")
    assert "word" in refs[0].texts[0] and len(refs[0].texts[0]) <= 16 * 101
    assert refs[0].texts[1] in ("only letters é und noch einer", "und noch einer only letters é")
