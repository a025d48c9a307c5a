from __future__ import annotations

import hashlib
from collections import defaultdict

from footfall.llm import chat
from footfall.llm.queries import OK, op10_chat
from tests.llm.frames import documents, noise

EVENTS = "conv_id long, seq long, kind string, message_id string, role string, text string, x int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, said in turns.items():
        said.sort()
        loss = "".join(t for _, r, t in said if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in said)
        out[conv] = (len(said), sha(whole), len(loss), sha(loss))
    return out


def result(frame):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
            for r in frame.collect()}


def test_control_strings_in_texts_and_roles_come_back(spark):
    pieces = ["<", "|", "[", "\\", "s>", "/s>", "INST]", "/INST]", "\n", "$1", "<|end|>\n", "<|says|>"]
    rows = []
    for conv, text in enumerate(noise(pieces, 400, 10)):
        rows += [(conv, 0, "user", text), (conv, 1, "assistant", text), (conv, 2, text[:9], "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = result(chat.digests(chat.render(chat.fold(chat.as_events(frame)))))
    assert got == brute(rows)


def test_awkward_rows(spark):
    rows = [
        (None, 0, "user", "no id"),
        (1, None, None, None),
        (1, 0, "assistant", ""),
        (1, 0, "assistant", ""),
        (1, 0, "assistant", "tie"),
        (2, 0, "user", "long " * 30_000),
    ]
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame(rows, schema)
    got = result(chat.digests(chat.render(chat.fold(chat.as_events(frame)))))
    plain = brute([(c, -1 if t is None else t, r, x) for c, t, r, x in rows])
    assert got == plain
    assert chat.render(chat.fold(chat.as_events(frame.limit(0)))).count() == 0


def test_fold(spark):
    events = [
        (1, 1, "message", "a", "user", "hi"),
        (1, 2, "message", "b", "assistant", None),
        (1, 3, "delta", "b", None, "foo"),
        (1, 5, "regenerate", "b", None, "ignored"),
        (1, 6, "delta", "b", None, "baz"),
        (1, 7, "edit", "a", None, "hello"),
        (1, 8, "message", "c", "user", "x"),
        (1, 9, "delete", "c", None, None),
        (1, 10, "delta", "b", None, "!"),
        (1, 11, "odd", "b", None, "?"),
        (1, 12, "delta", "d", "tool", "late"),
    ]
    frame = spark.createDataFrame([(*e, 0) for e in events], EVENTS)
    got = [(r.role, r.text) for r in chat.fold(frame).orderBy("seq").collect()]
    assert got == [("user", "hello"), ("assistant", "baz!"), ("tool", "late")]
    rendered = chat.render(chat.fold(frame)).first()
    assert "".join(s.text for s in rendered.segments if s.loss) == "baz!"


def test_query(spark, sf_dir):
    table = documents(spark, sf_dir, "conversations")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    rows += [(-7, 0, "user", OK), (-7, 1, "assistant", OK)]
    assert result(op10_chat(spark, sf_dir)) == brute(rows)
    plan = op10_chat(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "BatchEval" not in plan
