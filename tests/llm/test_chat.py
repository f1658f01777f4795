import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from stratum.llm import chat
from stratum.llm.queries import vocabulary

PATH = vocabulary("byte_bpe_50k.json")
PIECES = ["<", "|", "\\", "/", "s>", "</s>", "[", "INST]", "[INST]", "[/INST]", chat.TURN, chat.TEXT, chat.END,
          "<|endoftext|>", "a", " ", "\n", "é", "😀", ""]


@pytest.fixture(scope="module")
def conversations(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x") for r in rows],
                                     "conv_id long, turn long, role string, text string, part string")
    return make


def random_text(rnd, n=12):
    return "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, n)))


def test_escapes_are_reversible_and_complete():
    rnd = random.Random(1)
    for _ in range(20_000):
        text = random_text(rnd)
        out = chat.escape(text)
        assert chat.unescape(out) == text
        assert not any(c in out for c in chat.CONTROL)


def test_mask_equals_brute_force():
    rnd = random.Random(2)
    for _ in range(300):
        turns = [(rnd.choice(["user", "assistant", "system"]), random_text(rnd)) for _ in range(rnd.randint(0, 6))]
        text, spans = chat.render(turns)
        assert chat.parse(text) == turns
        e = chat.encoder(PATH).encode(text, add_special_tokens=False)
        offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
        mask = chat.mask_of(spans, offsets[:, 0], offsets[:, 1])
        assert list(mask) == [int(any(a < y and x < b for x, y in spans)) for a, b in e.offsets]
        read = "".join(chat.unescape(text[s["start"]:s["end"]])
                       for s in chat.masked_spans(mask, offsets[:, 0], offsets[:, 1]))
        assert read == "".join(t for r, t in turns if r == "assistant")


def brute(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest(), len(chat.render(turns)[0]))
    return out


def test_frame_edges(conversations, monkeypatch):
    rnd = random.Random(3)
    rows = [(c, t, rnd.choice(["user", "assistant", None, "a|b\n"]), random_text(rnd) if t % 5 else None)
            for c in range(8) for t in range(rnd.randint(1, 9))]
    rows += [(20, t, "assistant" if t % 2 else "user", f"turn {t} " * 5) for t in range(300)]
    rows += [(21, 3, "assistant", f"tie {i:03}") for i in range(150)]
    rows += [(22, 0, "user", "q"), (22, 0, "user", "q"), (22, None, "system", "first"), (22, -1, "assistant", "early")]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (23, 0, "assistant", "long " * 300_000)]
    formatted = chat.format_conversations(conversations(rows), PATH)
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(formatted).collect()}
    assert got == brute(rows)
    parts = [r for r in formatted.where("conv_id = 20").collect()]
    assert len(parts) == -(-300 // chat.PART_TURNS) and all(len(r.ids) == len(r.loss_mask) for r in parts)
    assert chat.read_back(chat.format_conversations(conversations([]), PATH)).count() == 0


def test_parts_end_to_end_are_the_whole_conversation():
    rnd = random.Random(4)
    turns = [(rnd.choice(["user", "assistant"]), random_text(rnd)) for _ in range(40)]
    whole = chat.encoder(PATH).encode(chat.render(turns)[0], add_special_tokens=False).ids
    split = [i for at in range(0, 40, 7)
             for i in chat.encoder(PATH).encode(chat.render(turns[at:at + 7])[0], add_special_tokens=False).ids]
    assert split == whole
