import hashlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from stratum.llm import sentencepiece_sampling as sp
from stratum.llm.queries import op8_sentencepiece_samples, vocabulary

PATH = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def voc():
    return sp.Vocabulary(PATH)


def segmentations(voc, text):
    """Every segmentation of a text with its log probability, by enumeration."""
    lib, norm = voc.library, sp.SPACE + text.replace(" ", sp.SPACE)
    done = []

    def go(at, ids, w):
        if at == len(norm):
            done.append((tuple(ids), w))
            return
        for end in range(at + 1, min(len(norm), at + 16) + 1):
            piece = lib.piece_to_id(norm[at:end])
            if piece != lib.unk_id():
                go(end, ids + [piece], w + voc.weight[piece])
        if lib.piece_to_id(norm[at]) == lib.unk_id():
            spelled = [int(voc.byte_ids[b]) for b in norm[at].encode()]
            go(at + 1, ids + spelled, w + sum(voc.weight[b] for b in spelled))

    go(0, [], 0.0)
    total = np.logaddexp.reduce([w for _, w in done])
    return {ids: w - total for ids, w in done}


def samples(voc, texts, keys, k):
    found = sp.sample_slice(texts, keys, k, voc)
    return [[(tuple(ids[b[i]:b[i + 1]].tolist()), p[i], g[i], q[i]) for ids, b, alive, p, g, q in found if alive[i]]
            for i in range(len(texts))]


def test_distribution_without_replacement(voc):
    text, n = "the cat é∞", 20_000
    exact = segmentations(voc, text)
    drawn = samples(voc, [text] * n, sp.row_keys(range(n), 1), 3)
    assert all(len({s[0] for s in d}) == 3 for d in drawn)
    assert all(d[0][2] >= d[1][2] >= d[2][2] for d in drawn)
    assert max(abs(exact[ids] - p) for d in drawn for ids, p, _, _ in d) < 1e-9
    first = Counter(d[0][0] for d in drawn)
    best = sorted(exact, key=exact.get)[::-1][:4]
    for ids in best:
        assert first[ids] / n == pytest.approx(np.exp(exact[ids]), abs=0.012)
    second = Counter(d[1][0] for d in drawn if d[0][0] == best[0])
    for ids in best[1:]:
        want = np.exp(exact[ids]) / (1 - np.exp(exact[best[0]]))
        assert second[ids] / sum(second.values()) == pytest.approx(want, abs=0.015)
    # inclusion scores weigh a sample so that sums over it are unbiased: here the sum of all probabilities
    assert np.mean([sum(np.exp(p - q) for _, p, _, q in d) for d in drawn]) == pytest.approx(1, abs=0.01)


def test_all_segmentations_of_a_short_text(voc):
    for text in ("", "a", "ab c", "\n", "∞"):
        exact = segmentations(voc, text) if text else {(): 0.0}
        got, = samples(voc, [text], sp.row_keys([1], 3), 100)
        assert {s[0] for s in got} == set(exact)
        assert {s[3] for s in got} == {0.0}


def test_rows_do_not_depend_on_each_other(voc, check_docs):
    rows = [(i, r["text"]) for i, r in list(check_docs.items())[:40]]
    together = samples(voc, [t for _, t in rows], sp.row_keys([i for i, _ in rows], 5), 3)
    for (i, t), want in zip(rows, together):
        (alone,) = samples(voc, [t], sp.row_keys([i], 5), 3)
        assert [s[0] for s in alone] == [s[0] for s in want]
        assert [s[2] for s in alone] == pytest.approx([s[2] for s in want], abs=1e-6)


def test_round_trip(voc, check_docs):
    texts = [r["text"] for r in list(check_docs.values())[:60]] + ["  a  b ", "x\ty\r\n", "日本 𝔘∞é", "w" * 500, " " * 70]
    for text, found in zip(texts, samples(voc, texts, sp.row_keys(range(len(texts)), 1), 4)):
        assert len({s[0] for s in found}) == len(found) >= 1
        for ids, *_ in found:
            assert voc.decode(ids) == text == voc.library.decode(list(ids))


def sums(voc, text):
    """The log of the summed weights of all segmentations, and of those without a piece over each place."""
    lib, norm = voc.library, sp.SPACE + text.replace(" ", sp.SPACE)
    edges = []
    for at in range(len(norm)):
        ids = ((end, lib.piece_to_id(norm[at:end])) for end in range(at + 1, min(len(norm), at + 16) + 1))
        out = [(end, voc.weight[i]) for end, i in ids if i != lib.unk_id()]
        if not out or out[0][0] > at + 1:
            out.append((at + 1, sum(voc.weight[voc.byte_ids[b]] for b in norm[at].encode())))
        edges.append(out)
    beta, alpha = np.full(len(norm) + 1, -np.inf), np.full(len(norm) + 1, -np.inf)
    beta[-1] = alpha[0] = 0
    for at in reversed(range(len(norm))):
        beta[at] = np.logaddexp.reduce([w + beta[end] for end, w in edges[at]])
    for at in range(len(norm)):
        for end, w in edges[at]:
            alpha[end] = np.logaddexp(alpha[end], alpha[at] + w)
    return beta[0], alpha + beta


LONG = ["https://example.com/" + "international" * 15, "identifier" * 20, " " * 200, "x" + " " * 70 + "word",
        "QmFzZTY0" * 25 + "==", "日本語のテキスト" * 25, "∞" * 200, "-" * 200 + "\n" + "=" * 200]


@pytest.mark.parametrize("text", LONG)
def test_long_runs_keep_every_segmentation(voc, text):
    """log_prob is normalised over the whole text's lattice, and each place has a piece over it as often as it should."""
    total, through = sums(voc, text)
    n = 3000
    crossed = np.zeros(len(through))
    for drawn in samples(voc, [text] * n, sp.row_keys(range(n), 7), 2):
        for ids, p, _, _ in drawn:
            assert p == pytest.approx(sum(voc.weight[list(ids)]) - total, abs=1e-6)
        places = np.cumsum([0] + [len(voc.bytes_of[i]) for i in drawn[0][0]])
        crossed += 1 - np.isin(np.cumsum([0] + [len(c.encode()) for c in sp.SPACE + text.replace(" ", sp.SPACE)]), places)
    assert np.abs(crossed / n - (1 - np.exp(through - total))).max() < 0.05


def test_long_units_are_cut_only_where_no_piece_crosses(voc):
    pieces = [voc.library.id_to_piece(i) for i in range(voc.library.get_piece_size())]
    for text in LONG:
        units = voc.units(text)
        assert "".join(units) == sp.SPACE + text.replace(" ", sp.SPACE)
        for a, b in zip(units, units[1:]):
            assert not any(a[-1] + b[0] in p for p in pieces)
    assert len(voc.units(LONG[1])) == 1 and max(map(len, voc.units(LONG[0]))) > 190


def test_frame_edges(docs_of):
    rows = [(1, None), (2, ""), (3, "hello world"), (3, "hello world"), (4, "long text " * 30_000), (None, "a")]
    got = sp.encode_samples(docs_of(rows), PATH, k=3).collect()
    by = Counter((r.doc_id, r["sample"]) for r in got)
    assert by[(1, 1)] == by[(2, 1)] == 1 and (1, 2) not in by
    assert by[(3, 3)] == 2 and len({tuple(r.ids) for r in got if r.doc_id == 3}) == 3
    assert (None, 1) in by
    assert sp.decode(sp.encode_samples(docs_of([]), PATH), PATH).count() == 0


def test_query_decodes_to_the_texts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op8_sentencepiece_samples(spark, SF_SMALL).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
        assert r.log_inclusion <= 0 and r.log_prob <= 0 and np.isfinite(r.log_inclusion)


def lattices_built(monkeypatch):
    built, add = [], sp.Lattice.add_unseen

    def counted(self):
        built.extend(self.index.unseen)
        add(self)

    monkeypatch.setattr(sp.Lattice, "add_unseen", counted)
    return built


def equal(a, b):
    return all(np.array_equal(x, y) for one, two in zip(a, b, strict=True) for x, y in zip(one, two, strict=True))


def test_lattices_are_kept_from_slice_to_slice(monkeypatch):
    built, voc, keys = lattices_built(monkeypatch), sp.Vocabulary(PATH), sp.row_keys([1, 2], 3)
    first = sp.sample_slice(["the cat sat", "the ∞ cat"], keys, 4, voc)
    assert sorted(built) == sorted([" the", " cat", " sat", " ∞"])
    again = sp.sample_slice(["the cat sat", "the ∞ cat"], keys, 4, voc)
    assert len(built) == 4 and equal(first, again)


def test_kept_lattices_are_bounded_and_change_no_result(monkeypatch):
    """With little room the units of most slices stay, and results are those of a worker that keeps nothing."""
    built = lattices_built(monkeypatch)
    monkeypatch.setattr(sp, "KEPT", 120)
    voc = sp.Vocabulary(PATH)
    slices = [f"common words stay {w * 3} {w * 5}é {w}" for w in "abcdefghijklmnopqrstuvwxyz"] + ["x" * 400, "common again"]
    for n, text in enumerate(slices):
        keys = sp.row_keys([n], 3)
        got = sp.sample_slice([text], keys, 4, voc)
        here = len(built)
        assert equal(got, sp.sample_slice([text], keys, 4, sp.Vocabulary(PATH)))
        del built[here:]
        assert len(voc.lattice.edges) <= max(120, 60 + sum(len(u) + 1 for u in voc.words(text)) + 1)
        assert list(voc.lattice.index.values()) == list(range(len(voc.lattice.first)))
    assert built.count(" common") == 1 < len(slices) and len(voc.lattice.edges) < 120


def test_siblings_out_of_reach_are_not_drawn(voc, monkeypatch, check_docs):
    """The samples are those found when every sibling along a path is drawn; on long texts few are."""
    texts = [r["text"] for r in list(check_docs.values())[:20]] + ["long text " * 3000, "", "a", "x" * 300, " " * 3000]
    keys, drawn, under = sp.row_keys(range(len(texts)), 9), [], sp._under

    def counted(location, bound, u):
        drawn.append(len(location))
        return under(location, bound, u)

    monkeypatch.setattr(sp, "_under", counted)
    few, n_few = sp.sample_slice(texts, keys, 6, voc), sum(drawn)
    drawn.clear()
    monkeypatch.setattr(sp, "REACH", np.inf)
    every, n_every = sp.sample_slice(texts, keys, 6, voc), sum(drawn)
    assert equal(few, every) and n_few < n_every / 2


def test_under_stays_within_reach():
    value = sp._under(np.array([-50.0, -3.0]), np.array([0.0, 0.0]), np.array([1.0, 1.0]))
    assert (value < np.array([-50.0, -3.0]) + sp.REACH).all() and (value <= 0).all()


def test_trie_steps(voc):
    for i in range(0, voc.library.get_piece_size(), 7):
        piece = voc.library.id_to_piece(i)
        if voc.library.is_control(i) or voc.library.is_unknown(i) or voc.library.is_unused(i) or voc.library.is_byte(i):
            continue
        state = np.zeros(1, np.int64)
        for c in piece:
            state = voc.step(state, np.array([ord(c)]))
        assert voc.piece_at[state[0]] == i
    assert voc.step(np.zeros(2, np.int64), np.array([0x10FFFF, 0xE000])).tolist() == [-1, -1]


def test_decode_many_is_decode(voc):
    rows = [[], [int(voc.byte_ids[0xE2])], voc.library.encode("two  words"), [int(voc.byte_ids[b]) for b in "é∞".encode()]]
    ids, bounds = np.array(sum(rows, []), np.int64), np.cumsum([0] + [len(r) for r in rows])
    assert voc.decode_many(ids, bounds).to_pylist() == [voc.decode(r) for r in rows]
    rows[1] = []
    ids, bounds = np.array(sum(rows, []), np.int32), np.cumsum([0] + [len(r) for r in rows])
    assert voc.decode_many(ids, bounds).to_pylist() == [voc.decode(r) for r in rows]
