import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from shopmart.llm import chat

BITS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|user|>", "<|end|>", "\\", "[", "<", " ", "\n", "é", "a", "|", "INST]", "s>", "%7c"]


MARK = re.compile(r"[<\[](?:/?INST\]|/?s>|</?SYS>>|\|[^|\n]*\|>)")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "a|b"]), st.lists(st.sampled_from(BITS), max_size=6).map("".join)), max_size=6), st.integers(1, 9))
def test_turns_from_the_stream(turns, step):
    """Turns are found by their marks alone, however the stream is cut."""
    formatted = "".join(chat.render(r, t)[0] for r, t in turns)
    assert chat.parse(formatted) == turns
    reader, got = chat.Reader(), []
    for i in range(0, len(formatted), step):
        got += list(reader.turns(formatted[i:i + step]))
    assert [g[:2] for g in got] == turns and reader.whole()
    assert all(chat.unescape(formatted[a:b]) == t for _, t, a, b in got)


def test_marks_inside_marks():
    assert chat.escape("<|</s>|>") == "<\\|<\\/s>|>" and chat.escape("<| [/INST] </s> |>") == "<\\| [\\/INST] <\\/s> |>"
    assert chat.escape("<|a<|>b|>") == "<\\|a<\\|>b|>"
    assert chat.parse(chat.render("user", "a <|x")[0] + chat.render("assistant", "|> [/INST]")[0]) == [("user", "a <|x"), ("assistant", "|> [/INST]")]


@settings(max_examples=400, deadline=None)
@given(st.sampled_from(["user", "assistant", "system", "tool", "", "a|b\n%\\"]), st.lists(st.sampled_from(BITS), max_size=12).map("".join))
def test_round_trip(role, text):
    piece, a, b = chat.render(role, text)
    assert chat.parse(piece) == [(role, text)]
    escaped = chat.escape(text)
    assert not any(MARK.match(escaped, i) for i in range(len(escaped)))  # no mark starts anywhere
    assert chat.unescape(escaped) == text
    assert chat.unescape(piece[a:b]) == (text if role == "assistant" else "")


def brute(log):
    """The log in order, one event after the other."""
    messages = {}
    for conv, seq, _, msg, event, role, text in log:
        m = messages.setdefault((conv, msg), {"seq": seq, "role": None, "text": []})
        if event == "delete":
            m["text"] = None
            continue
        if m["text"] is None or event in ("edit", "regenerate"):
            m["text"] = []
        if role is not None and (event == "start" or m["role"] is None):
            m["role"] = role
        if text is not None and event != "regenerate":
            m["text"].append(text)
    return {(c, m["seq"], k, m["role"] or "", "".join(m["text"])) for (c, k), m in messages.items() if m["text"] is not None}


def test_fold_against_replay(spark):
    rng = random.Random(8)
    log = []
    for conv in [1, 2, None, 4]:
        for seq in range(120):
            msg = rng.randint(0, 6)
            log.append((conv, seq, 0, msg, rng.choice(["start", "delta", "delta", "delta", "edit", "regenerate", "delete"]), rng.choice(["user", "assistant", None]), rng.choice([None, "", "x", "é[INST]", "long " * 50])))
    shuffled = rng.sample(log, len(log))
    df = spark.createDataFrame(shuffled, "conv_id long, seq long, part int, message long, event string, role string, text string").repartition(5)
    got = chat.fold(df).collect()
    assert {tuple(r) for r in got} == brute(log) and len(got) == len(brute(log))


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_conversations(spark):
    long = "[INST] é\\" * 4000
    rows = [(1, 1, "assistant", "a</s>"), (1, 0, "user", None), (2, 0, "system", ""), (2, 1, "user", "[/INST]"), (2, 2, "assistant", long), (2, 3, "assistant", "b"),
            (None, 0, "tool", "x"), (None, 0, "tool", "x"), (3, None, None, "y"),
            *[(4, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(["<|x", "|> [", "\\", "<|</s>|>", "[", "<", " </s", "end <|end|> <", "a" * 700])]]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn int, role string, text string, piece string").repartition(4)
    pieces = chat.formatted(chat.fold(chat.events_of_messages(df)))
    got = {r.conv_id: r for r in chat.digests(pieces).collect()}
    assert got[1][1:5] == (2, sha("user\n\nassistant\na</s>\n"), 5, sha("a</s>"))
    assert got[2][1:5] == (4, sha(f"system\n\nuser\n[/INST]\nassistant\n{long}\nassistant\nb\n"), len(long) + 1, sha(long + "b"))
    assert got[None][1:5] == (2, sha("tool\nx\ntool\nx\n"), 0, sha(""))
    assert got[3][1:3] == (1, sha("\ny\n"))
    def said(turn):
        return (-1 if turn[1] is None else turn[1], turn[2] or "", turn[3] or "")

    for r in chat.whole(pieces).collect():
        assert len(r.formatted) == got[r.conv_id].formatted_chars
        turns = sorted((said(x) for x in rows if x[0] == r.conv_id), key=lambda x: x[0])
        assert chat.parse(r.formatted) == [t[1:] for t in turns]
    log = chat.events_of_messages(df)
    assert {x.event for x in log.select("event").distinct().collect()} == {"start", "delta", "edit", "regenerate", "delete"}
    assert chat.digests(chat.formatted(chat.fold(chat.events_of_messages(df.limit(0))))).count() == 0
