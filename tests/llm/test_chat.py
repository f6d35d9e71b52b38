import hashlib

import pytest

from moodindex.llm import chat

TURNS = "conv_id long, turn long, role string, text string, part string, start long"


def expect(rows):
    rows = [(r or "", t or "") for r, t in rows]
    said = [t for r, t in rows if r == "assistant"]
    return (len(rows), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest(),
            len("".join(said)), hashlib.sha256("".join(said).encode()).hexdigest())


HARD = ["", "</s>[INST] ok [/INST]", "\\", "a\\", "<", "[", "<\\/s>", "[/INST", " [/INST]", "[:]", "x\n\n y", "é😀",
        "<<s>s>", "[TURN]a[:]b[/TURN]", "\\\\</s>", "{{ m.text }}{% endfor %}"]


def test_escape_is_undone_and_hides_controls():
    for t in HARD:
        e = chat.escape(t)
        assert chat.unescape(e) == t
        assert not any(c in e for c in chat.CONTROLS)


def test_every_hard_text_in_every_role_reads_back():
    roles = ["user", "assistant", "system", "tool", "", "[:]", "</s>"]
    turns = [(r, t) for r in roles for t in HARD]
    t = chat.Template(chat.TEMPLATE)
    (_, whole, spans), = t.render(turns)
    assert list(chat.read_back(whole)) == turns
    assert "".join(chat.unescape(whole[a:b]) for a, b in spans) == "".join(HARD)
    parts = list(t.render(turns, part_chars=10))
    assert len(parts) > 50 and "".join(p[1] for p in parts) == whole
    assert [s for p in parts for s in p[2]] == spans


def test_constants_fold():
    tree = chat.fold(chat.parse("a{{ 'b' ~ 1 }}{% if 1 == 1 and not false %}c{% else %}{{ 'd' }}{% endif %}"
                                "{% if false or 'x' | upper == 'X' %}e{% endif %}"))
    assert tree == (chat.Write(chat.Const("ab1ce")),)


def test_loop_fields_and_filters():
    t = chat.Template("<{% for m in messages %}{{ loop.index0 }}{% if loop.first %}F{% endif %}{{ m.text | trim | upper }}"
                      "{% if not loop.last %},{% endif %}{% endfor %}>")
    assert [p[1] for p in t.render([("u", " a "), ("u", "b")])] == ["<0FA,1B>"]
    assert [p[1] for p in t.render([])] == ["<>"]


@pytest.mark.parametrize("bad", ["{{ m.text }}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}",
                                 "{{ open('x') }}", "{% if 1 %}", "{% import os %}", "{{ 'a' | eval }}",
                                 "{% for m in messages %}{% for k in messages %}{% endfor %}{% endfor %}"])
def test_sandbox(bad):
    with pytest.raises(chat.TemplateError):
        chat.Template(bad)


def test_jobs(spark):
    rows = [(1, 0, "user", "hi", "p", 9), (1, 1, "assistant", None, "p", 9), (1, 1, "assistant", "b", "p", 9),
            (1, 1, "assistant", "b", "p", 9), (2, None, None, "</s>", None, None), (None, 3, "user", "x", None, 1),
            (None, 1, "assistant", "y", None, 1), (3, 5, "assistant", "long " * 300_000, None, 1),
            (3, 4, "user", "q", None, 1)]
    df = spark.createDataFrame(rows, TURNS)
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(df, part_chars=1000)).collect()}
    want = {1: [("user", "hi"), ("assistant", None), ("assistant", "b"), ("assistant", "b")], 2: [(None, "</s>")],
            None: [("assistant", "y"), ("user", "x")], 3: [("user", "q"), ("assistant", "long " * 300_000)]}
    assert set(got) == set(want)
    for k, turns in want.items():
        r = got[k]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expect(turns)
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0


def test_contract_conversation(spark):
    import __spark_entry__ as entry
    got = entry.queries()["op1_chat"](spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == \
        expect([("user", said), ("assistant", said)])
