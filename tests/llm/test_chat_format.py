"""Formatting and reading back against a plain Python rendering."""

import hashlib
import random

from vigilcard.llm import chat_format


def plain(rows):
    """Digests by a row model: {conv_id: (...)}."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(r or "", x or "") for _, t, r, x in sorted(
            (r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))]
        learnt = "".join(x for r, x in turns if r == "assistant")
        spoken = "".join(f"{r}\n{x}\n" for r, x in turns)
        state, bad = "begin", None
        for k, (r, _) in enumerate(turns):
            state = chat_format.INSTRUCTION.moves.get(state, {}).get(r)
            if state is None:
                bad = k
                break
        if bad is None and state != "answered":
            bad = len(turns)
        out[conv] = (len(turns), hashlib.sha256(spoken.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), bad)
    return out


def test_digests(spark):
    rng = random.Random(2)
    bits = ["<", "[", "\\", "a", "b", "c", "</s>", "[INST] ", " [/INST]", "<<SYS>>", "[ROLE]", "[/ROLE]", "\n", "é🙂", "", "\\a", "[/TURN]\n"]
    rows = [(None, 0, "user", "hi"), (None, 0, "user", "hi"), (1, None, None, None), (2, 0, "tool[/ROLE]x", "<s>"), (3, 0, "", "e")]
    rows += [(4, 0, "user", "x" * 100_000), (4, 1, "assistant", "[" * 50_000)]
    for conv in range(10, 60):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["system", "user", "assistant"]) if rng.random() < 0.2 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))))
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, segments string")
    made = chat_format.format_conversations(df)
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.first_invalid) for r in chat_format.digest(made).collect()}
    assert found == plain(rows)
    for row in made.collect():
        assert row.formatted == "".join(s.text for s in row.segments)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digest(chat_format.format_conversations(df)).count() == 0
