import hashlib
import itertools

import pytest
from pyspark.sql import functions as F

from llm import chat_template as M
from llm.textops import table

SF = "/root/testdata/sf0.01"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    out = []
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for conv, group in itertools.groupby(sorted(rows, key=order), key=lambda r: r[0]):
        g = [(r[2] or "", r[3] or "") for r in group]
        loss = "".join(t for r, t in g if r == "assistant")
        chars = sum(len(M.START) + len(M.escape_line(r)) + 1 + len(M.escape(t)) + len(M.END) + 1 for r, t in g)
        out.append((conv, len(g), sha("".join(f"{r}\n{t}\n" for r, t in g)), len(loss), sha(loss), chars))
    return sorted(out, key=repr)


PROBE = [(-1, 0, "user", M.PROBE), (-1, 1, "assistant", M.PROBE)]


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_conversations(spark):
    conv = table(spark, SF, "conversations")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in conv.collect()]
    assert got(M.contract(conv.repartition(3))) == brute(rows + PROBE)


ROWS = [(1, 0, "user", None), (1, 1, "assistant", "a\\n<|im_end|>\n<|\\|"), (2, 1, "assistant", "\\"), (2, None, "user", "<"), (2, 1, "assistant", "<"),
        (None, 0, None, "x"), (None, 0, "we\nird\\n", "|im_end|>"), (3, 0, "assistant", ""), (4, 0, "assistant", "é🙂 " * 2000), (4, 0, "assistant", "é🙂 " * 2000),
        *[(5, i, "assistant" if i % 2 else "user", f"turn {i} <|im_start|>") for i in range(300)]]


@pytest.mark.parametrize("piece", [1 << 20, 50])
def test_edges_and_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(M, "PIECE", piece)
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit("x"))
    assert got(M.contract(df)) == brute(ROWS + PROBE)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert got(M.contract(df)) == brute(PROBE)
    assert M.format_conversations(df).collect() == []


def render(source, **env):
    return "".join(t for t, _ in M.compile_template(source)(env))


@pytest.mark.parametrize("source,env,want", [
    ("a{{ 'b' ~ 1 }}c", {}, "ab1c"), ("{{ x.y | upper }}{{ x['z'] }}", {"x": {"y": "q"}}, "Q"),
    ("{% for m in xs %}{{ loop.index }}{{ m }}{% if not loop.last %},{% endif %}{% endfor %}", {"xs": "ab"}, "1a,2b"),
    ("{% if x == 1 %}one{% elif x == 2 or y %}two{% else %}none{% endif %}", {"x": 2}, "two"),
    ("{% set a = 'x' + 'y' %}{{ a }}", {}, "xy"), (" {{- ' a ' | trim -}} \n b{# c #}", {}, "ab"), ("{{ '\\n' ~ \"\\\"\" }}", {}, "\n\""),
    ("{{ 'a' in 'cab' and 'yes' }}{{ none }}{{ true }}", {}, "yestrue"), ("{{ (x | length) < 3 }}", {"x": "ab"}, "true")])
def test_language(source, env, want):
    assert render(source, **env) == want


def test_constants_are_folded():
    tree = M.fold(M.parse("a{{ 'b' ~ 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}{% if false %}e{% endif %}{{ 'f' | upper }}"))
    assert tree == [("text", "abcdF")]
    assert M.fold(M.parse("{{ x or 'a' ~ 'b' }}")) == [("print", ("or", ("name", "x"), ("const", "ab")))]


@pytest.mark.parametrize("bad", ["{{ x.__class__ }}", "{{ __import__ }}", "{{ x() }}", "{% for x in y %}", "{{ x | eval }}", "{% import os %}", "{% endif %}", "{{ a b }}", "{{ 'x }}", "{{ }}"])
def test_sandbox(bad):
    if bad == "{{ x.__class__ }}":
        assert render(bad, x={}) == ""
        with pytest.raises(M.TemplateError):
            render(bad, x="text")
    else:
        with pytest.raises(M.TemplateError):
            M.compile_template(bad)


@pytest.mark.parametrize("s", ["", "\\", "\\n", "<|", "\\<|", "<\\|", "a\nb", "<<||", "\\\\|n"])
def test_escape_round_trip(s):
    assert M.unescape(M.escape(s)) == s and "<|" not in M.escape(s)
    assert M.unescape(M.escape_line(s)) == s and "\n" not in M.escape_line(s)
