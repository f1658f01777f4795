import unicodedata

import numpy as np
import pytest

from conftest import SF_CHECK
from stratum.llm import langid
from stratum.llm.queries import op4_language_id


def small_net():
    net = langid.BiGru.fresh(["a", "b", "c"], 4, np.random.default_rng(0))
    net.params = {k: v.astype(np.float64) for k, v in net.params.items()}
    return net


def test_gradients_equal_finite_differences():
    net = small_net()
    words, size = [b"abc", b"de", b"fghij"], np.array([3, 2, 5])
    data, label = langid.packed(words, 5), np.array([0, 1, 2])
    mask = langid.letter_mask(data, size).astype(float)
    _, g = net.gradients(data, size, label, mask)
    for k, p in net.params.items():
        at = np.unravel_index(np.argmax(abs(g[k])), g[k].shape)
        old, e, sides = p[at], 1e-4, []
        for move in (e, -e):
            p[at] = old + move
            sides.append(net.gradients(data, size, label, mask)[0])
        p[at] = old
        assert g[k][at] == pytest.approx((sides[0] - sides[1]) / (2 * e), rel=1e-2)


def letters(text):
    """Which bytes of a text belong to a letter."""
    return [unicodedata.category(c)[0] == "L" for c in text for _ in c.encode()]


def test_pieces_lose_nothing_and_cut_between_characters():
    for word in ("", "x" * 31, "x" * 33, "é" * 50, "x" + "漢" * 40, "😀" * 9, "a😀" * 30):
        cut = langid.pieces(word.encode())
        assert b"".join(cut) == word.encode() and all(len(p) <= langid.SPAN for p in cut)
        assert "".join(p.decode() for p in cut) == word


def test_pooled_equals_one_word_at_a_time():
    net = langid.BiGru.fresh(["a", "b"], 5, np.random.default_rng(1))
    texts = ["Hello wörld 42 again", "", "x" * 100 + " y", "  \n", "Hello Hello", "漢字" * 40 + "é" * 33 + "—€—", "— €"]
    got = langid.Pooled(net).documents(texts)
    for text, row in zip(texts, got):
        total, n = np.zeros(2), 0
        for word in text.split():
            for piece in langid.pieces(word.encode()):
                (_, _, _, p), = net.positions([piece])
                mask = letters(piece.decode())
                total, n = total + p[0][mask].sum(0), n + sum(mask)
        assert row == pytest.approx(total / max(n, 1), abs=1e-4)


def test_forgetting_changes_nothing(monkeypatch):
    net = langid.BiGru.fresh(["a", "b"], 5, np.random.default_rng(1))
    texts = [f"word{i} other{i % 7}" for i in range(200)]
    whole = langid.Pooled(net).documents(texts)
    monkeypatch.setattr(langid, "CACHE_ENTRIES", 10)
    small = langid.Pooled(net)
    parts = np.concatenate([small.documents(texts[i:i + 20]) for i in range(0, 200, 20)])
    assert parts == pytest.approx(whole, abs=1e-5)


def test_position_runs_cover_letters():
    net = langid.BiGru.fresh(["a", "b"], 5, np.random.default_rng(1))
    text = "Hé, 12 word — 5€ " + "漢字" * 30
    runs = langid.position_runs(net, text)
    covered = {i for r in runs for i in range(r["start"], r["end"])}
    assert covered == set(np.flatnonzero(letters(text)))
    assert langid.position_runs(net, "") == []


def test_frame_edges(docs_of):
    net = langid.train(["the house and the dog"] * 5 + ["das haus und der hund"] * 5, ["en"] * 5 + ["de"] * 5, steps=80)
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "the dog"), (4, "the dog"), (5, "der hund " * 50_000), (None, "und")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs_of(rows), net).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "en" and got[5][0] == "de" and all(0 <= s <= 1 for _, s in got.values())
    assert langid.predict(docs_of([]), net).count() == 0
    assert {r.lang_pred for r in langid.predict(docs_of(rows), None).collect()} == {"und"}


def test_nothing_to_learn_from(docs_of, spark):
    assert langid.fit(spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")) is None


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    got = [r for r in op4_language_id(spark, SF_CHECK).collect()]
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert held and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
