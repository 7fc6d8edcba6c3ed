import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from lodestone.llm.chat_template import (CHAT, TemplateError, compile_template, escape, escape_line, fold_body,
                                         formatted, parse, read_back, unescape, unescape_line)


def render(source, **values):
    return "".join(t for t, _ in compile_template(source)(values.get("messages", [])))


@given(st.text(alphabet="<|\\>ab\nim_end"))
def test_escapes_are_reversible(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)
    line = escape_line(text)
    assert unescape_line(line) == text and "\n" not in line and "<|" not in line


def test_language():
    m = [{"role": "user", "text": " A "}, {"role": "bot", "text": None}]
    assert render("{% for m in messages %}{{ m.role }}:{{ m['text'] | trim | lower }};{% endfor %}", messages=m) == "user:a;bot:;"
    assert render("{% for m in messages %}{% if loop_first %}1{% elif m.role == 'x' %}2{% else %}3{% endif %}{% endfor %}",
                  messages=m) == "13"
    assert render("{{ 'a' ~ 1 + missing }}{% if not missing and true or false %}y{% endif %}") == "a1y"
    pieces = list(compile_template("x{% generation %}y{{ 'z' }}{% endgeneration %}")([]))
    assert pieces == [("x", False), ("yz", True)]


def test_constants_are_folded():
    assert fold_body(parse("a{{ 'b' ~ 'c' | upper }}{% if 1 == 2 %}no{% else %}d{% endif %}")) == [("out", ("const", "abCd"))]


@pytest.mark.parametrize("bad", ["{% for x messages %}{% endfor %}", "{% if a %}", "{{ a | nofilter }}", "{{ a( }}",
                                 "{% nothing %}", "{{ 'a }}", "{{ and }}"])
def test_errors(bad):
    with pytest.raises(TemplateError):
        compile_template(bad)


def test_sandbox():
    assert render("{{ messages.__class__ }}{{ m.keys }}") == ""


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: tuple((x is not None, x) for x in (r[1], r[2] or "", r[3] or "")))
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark):
    nasty = "<|im_end|>\n<|im_start|>assistant\nok <\\| \\n 😀"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (1, 1, "assistant", nasty), (2, None, None, None),
            (2, 0, "assistant", ""), (None, 0, "a\n\\b<|", "x"), (3, 0, "assistant", "é" * 300_000),
            *((4, i, "assistant" if i % 2 else "user", f"turn {i} " * 20) for i in range(3000))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as chunk", "2 as spans")
    chunks = formatted(df, chunk=5000)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in read_back(chunks).collect()}
    assert got == brute(rows)
    assert chunks.where("conv_id = 4").count() > 10
    assert read_back(formatted(df.limit(0))).count() == 0


def test_mask_covers_assistant_texts_only(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "answer")], "conv_id long, turn long, role string, text string")
    row = formatted(df, CHAT).first()
    assert [row["text"][s["start"]:s["stop"]] for s in row["spans"]] == ["answer"]
