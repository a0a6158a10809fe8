import hashlib

from hypothesis import given
from hypothesis import strategies as st

from ohlcflow.llm import chat_format as C

NASTY = ["\\### Assistant: </turn> ok", "### user: hi", "</turn>", "\\", "\\\\### ", "<|endoftext|>", " lead", "a\n\nb ", "", None, "é\U0001f600\x00\x1f", "##" + "#" * 7, "x" * 60_000]


@given(st.text(alphabet="\\#</turn>a ", max_size=40))
def test_escape_is_reversible_and_hides_marks(text):
    shown = C.escape(text)
    assert C.unescape(shown) == text
    assert not C._CONTROL.search(C._ESCAPED.sub("", shown))


def brute(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, (r[3] or "").encode())):
        out.setdefault(conv, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {
        conv: (
            len(turns),
            sha("".join(f"{r}\n{t}\n" for r, t in turns)),
            sum(len(t) for r, t in turns if r == "assistant"),
            sha("".join(t for r, t in turns if r == "assistant")),
            sum(len(C.BEGIN + C.escape(r) + C.TEXT + C.escape(t) + C.END) for r, t in turns),
        )
        for conv, turns in out.items()
    }


def test_round_trip(spark):
    rows = [(c, t, ("user", "assistant", "system")[(c + t) % 3], NASTY[(c * 5 + t) % len(NASTY)]) for c in range(30) for t in range(c % 7 + 1)]
    rows += [(None, 0, None, "no id"), (50, None, "assistant", "b"), (50, None, "assistant", "a"), (50, 1, "assistant", "c"), (50, 1, "assistant", "c"), (51, 0, "### ", "odd role")]
    rows += [(60, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as ids", "2 as offset")
    segments = C.format_chat(turns)
    got = {r[0]: tuple(r)[1:6] for r in C.read_back(segments).collect()}
    assert got == brute(rows)
    shown = {}
    for r in sorted(C.render(segments).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.offset)):
        shown[r.conv_id] = shown.get(r.conv_id, "") + r.rendered
    assert {c: len(s) for c, s in shown.items()} == {c: x[4] for c, x in got.items()}


def test_masks_cover_assistant_ids_only(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hello"), (1, 1, "assistant", "world peace"), (1, 2, "user", "")], "conv_id long, turn long, role string, text string")
    rows = C.format_chat(turns).orderBy("offset").collect()
    assert [r.loss_end - r.loss_start for r in rows] == [0, 2, 0]
    assert [r.offset for r in rows] == [0, rows[0].n_tokens, rows[0].n_tokens + rows[1].n_tokens]
    assert C.read_back(C.format_chat(turns.where("turn = 9"))).count() == 0
