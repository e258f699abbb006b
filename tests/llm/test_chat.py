import hashlib

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import chat as C

TEXTS = ["", "plain", "\\### Assistant: </turn> ok", "</turn>\n### user: x", "\\\\h\\l#### ##", "é日🙂 </tur</turn>n>", "a" * 1000 + "\\" * 401, ": \\c :"]


@pytest.mark.parametrize("role", ["user", "assistant", "a: b", "### x\n", ""])
def test_template_is_reversible(llm, role):
    rows = llm.createDataFrame([(i, 0, role, t) for i, t in enumerate(TEXTS)], "conv_id long, msg int, role string, text string")
    for r in C.render(rows).collect():
        assert C.parse_piece(r.piece) == (role, TEXTS[r.conv_id])
        assert r.piece.count(C.OPEN) == 1 and r.piece.count("</turn>") == 1
        inside = C.unescape(r.piece[r.loss_start : r.loss_start + r.loss_length])
        assert inside == (TEXTS[r.conv_id] if role == "assistant" else "")


def test_fold(llm):
    log = [
        (1, 1, 0, "open", "user", None), (1, 2, 0, "delta", None, "he"), (1, 3, 0, "delta", None, "llo"),
        (1, 4, 1, "open", "assistant", None), (1, 5, 1, "delta", None, "draft"), (1, 6, 2, "open", "user", "next"),
        (1, 7, 1, "regenerate", None, None), (1, 8, 1, "delta", None, "fi"), (1, 9, 1, "delta", None, "nal"),
        (1, 10, 3, "open", "user", None), (1, 11, 3, "delta", None, "typo"), (1, 12, 3, "edit", None, "fixed"), (1, 13, 3, "delta", None, "!"),
        (1, 14, 4, "open", "user", "gone"), (1, 15, 4, "delete", None, None), (1, 16, 5, "delta", None, "never opened"), (1, 17, 3, "noise", None, "x"),
        (2, 1, 0, "open", None, None), (None, 1, 0, "open", "user", "n"), (None, 2, 1, "open", "user", "old"), (None, 3, 0, "regenerate", None, None), (None, 4, 0, "delta", None, "new"),
    ]
    df = llm.createDataFrame(log, "conv_id long, seq int, msg int, kind string, role string, text string").repartition(4)
    got = sorted((tuple(r) for r in C.fold(df).collect()), key=repr)
    assert got == sorted([(1, 0, "user", "hello"), (1, 1, "assistant", "final"), (1, 3, "user", "fixed!"), (2, 0, "", ""), (None, 0, "user", "new")], key=repr)


def test_digests(llm):
    rows = [(c, t, r, x) for c in (5, 3, None) for t, (r, x) in enumerate(zip(["system", "user", "assistant", None] * 2, TEXTS))]
    rows += [(5, 0, "system", ""), (5, None, "user", "first"), (9, 1, "user", None), (-7, 0, "user", TEXTS[2]), (-7, 1, "assistant", TEXTS[2])]
    # Texts of one turn that begin alike, and a null turn.
    rows += [(c, t, "assistant", "z" * 70 + x) for c in (7, None) for t in (3, None) for x in ("b", "", "ab", "a", "b")]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("clash") for c in ("msg", "seq", "kind", "piece", "same", "copy", "log")})
    want = []
    for conv in {r[0] for r in rows}:
        own = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, r, x in own if r == "assistant")
        want.append((conv, len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    got = C.read_back(C.format_conversations(df.repartition(5))).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    pieces = C.format_conversations(df).groupBy("conv_id").agg(F.sum(F.char_length("piece"))).collect()
    assert {r[0]: r[1] for r in pieces} == {r.conv_id: r.formatted_chars for r in got}
    assert C.read_back(C.format_conversations(df.limit(0))).collect() == []
