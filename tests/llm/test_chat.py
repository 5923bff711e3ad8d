import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from propense.llm import chat, queries

PIECES = ["<turn>", "</turn>", "<says>", "\\", "(", "<", "/turn>", "turn>", "<|endoftext|>", "\n", " ", "é", "\U0001f600", "a", "\\(turn>", "### "]
TEXT = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)

with open(chat.TOKENIZER, encoding="utf-8") as file:
    ENCODER = chat.load(file.read())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), TEXT), TEXT), max_size=5))
@settings(max_examples=300, deadline=None)
def test_round_trip(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for _, t in turns]
    code = ENCODER.encode(formatted, add_special_tokens=False)
    wanted = np.array([r == "assistant" for r, _ in turns], dtype=bool)
    loss = chat.mask(np.array(code.offsets, dtype=np.int64).reshape(-1, 2), spans[wanted])
    learnt = ENCODER.decode([i for i, x in zip(code.ids, loss) if x], skip_special_tokens=False)
    assert chat.unescape(learnt) == "".join(t for r, t in turns if r == "assistant")
    # no token reaches over the edge of a text
    edges = set(spans.ravel().tolist())
    assert not any(a < e < b for a, b in code.offsets for e in edges)


def test_mask_by_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        cuts = np.sort(rng.choice(60, 8, replace=False)).reshape(-1, 2)
        ends = np.sort(rng.choice(60, 20))
        offsets = np.stack([np.append(0, ends[:-1]), ends], axis=1)
        want = [any(max(a, c) < min(b, d) for c, d in cuts) for a, b in offsets]
        found = chat.mask(offsets, cuts)
        assert [f for f, (a, b) in zip(found, offsets) if a < b] == [w for w, (a, b) in zip(want, offsets) if a < b]


def test_hard_rows(spark):
    rows = [
        (1, 2, "assistant", "b"), (1, 1, "user", "a"), (2, 0, None, None), (2, None, "assistant", ""), (None, 0, "assistant", "n"),
        (3, 1, "user", "x"), (3, 1, "assistant", "same number"), (4, 0, "assistant", "again"), (4, 0, "assistant", "again"),
        (5, 0, "assistant", "long é " * 40_000),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS turns", "2 AS loss")
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    want = {
        1: [("user", "a"), ("assistant", "b")], 2: [("assistant", ""), ("", "")], None: [("assistant", "n")],
        3: [("assistant", "same number"), ("user", "x")], 4: [("assistant", "again")] * 2, 5: [("assistant", "long é " * 40_000)],
    }
    assert set(found) == set(want)
    for c, ts in want.items():
        learnt = "".join(t for r, t in ts if r == "assistant")
        assert (found[c].n_turns, found[c].turns_sha256) == (len(ts), sha("".join(f"{r}\n{t}\n" for r, t in ts)))
        assert (found[c].loss_chars, found[c].loss_sha256) == (len(learnt), sha(learnt))
        assert found[c].formatted_chars == len(chat.render(ts)[0])
    assert chat.format_conversations(turns.limit(0)).count() == 0


def test_query(spark, sf_dir):
    turns = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = "\\### Assistant: </turn> ok"
    turns += [(-7, 0, "user", odd), (-7, 1, "assistant", odd)]
    by_conv = {}
    for c, n, r, t in sorted(turns):
        by_conv.setdefault(c, []).append((r, t))
    rows = queries.op4_chat_formatting(spark, sf_dir).collect()
    assert {r.conv_id for r in rows} == set(by_conv) and len(rows) == len(by_conv)
    for r in rows:
        ts = by_conv[r.conv_id]
        learnt = "".join(t for role, t in ts if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(ts), sha("".join(f"{a}\n{b}\n" for a, b in ts)))
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), sha(learnt))
