"""Operator 13: the template language, the escape, and whole conversations against a plain version."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from marketscope.llm.chat_format import (CONTROL, PROBE_TEXT, TEMPLATE, chat_format, compiled, escape, formatted, read_back, turns,
                                         unescape)
from marketscope.llm.template import Template, TemplateError, joined

SCHEMA = "conv_id long, turn long, role string, text string, n_turns long, piece string"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*CONTROL, "<", "[", "\\", "s>", "/s>", "INST]", "/", " ", "\n", "x", "é"]), max_size=12).map("".join))
def test_escape_is_reversible_and_hides_control_strings(text):
    hidden = escape(text)
    assert unescape(hidden) == text and not any(c in hidden for c in CONTROL)


def render(source, **values):
    return "".join(t for t, _ in Template(source).chunks(values.pop("messages", []), **values))


@pytest.mark.parametrize("source,expected", [
    ("a {{- ' b ' -}} c", "a b c"),
    ("{# no #}{{ 1 + 2 * 3 }}", "7"),
    ("{{ x | default('n') | upper }}", "N"),
    ("{{ 'a' if x is none else 'b' }}", "a"),
    ("{% if y == 'q' and not x %}1{% elif y %}2{% else %}3{% endif %}", "2"),
    ("{% set z = y ~ '!' %}{{ z }}", "v!"),
    ("{% for m in items %}{{ loop.index }}{{ m.k }}{{ ',' if not loop.last }}{% endfor %}", None),
    ("{% for m in items %}{{ loop.index }}{{ m.k }}{{ ',' if not loop.last else ';' }}{% endfor %}", "1p,2q;"),
    ("{{ items[1]['k'] }}{{ items[9] }}", "q"),
    ("{{ 'p' in ['p', 'r'] }}{{ 'p' not in y }}", "TrueTrue"),
    ("{% set a = 1 %}{% for m in items %}{% set a = 2 %}{% endfor %}{{ a }}", "1"),
])
def test_language(source, expected):
    if expected is None:
        with pytest.raises(TemplateError):
            render(source, y="v", items=[{"k": "p"}, {"k": "q"}])
    else:
        assert render(source, y="v", items=[{"k": "p"}, {"k": "q"}]) == expected


@pytest.mark.parametrize("source", [
    "{{ x.__class__ }}", "{{ _x }}", "{{ x() }}", "{{ x | eval }}", "{% include 'a' %}", "{% for a in b %}", "{{ 1 + }}",
    "{{ " + "(" * 200 + "1" + ")" * 200 + " }}", "{{ 'a' * 10 }}", "{% if x %}{% endfor %}", "{{ 1 + 'a' }}", "{{ x is weird }}"])
def test_sandbox_and_syntax_errors(source):
    with pytest.raises(TemplateError):
        render(source, x="a")


def test_fields_are_map_entries_only():
    assert render("{{ x.upper }}{{ x['join'] }}", x="abc") == ""


def test_folding():
    t = Template("a{{ 'b' ~ 'c' }}{% if 1 == 2 %}no{% else %}d{% endif %}{{ 'x' if false else 'e' }}")
    assert [(n.kind, n.value) for n in t.tree] == [("text", "abcde")]
    assert Template("{% if 2 > 1 or x %}y{% endif %}").tree[0].value == "y"
    t = Template(TEMPLATE, {"escape": escape})
    assert t.per_turn and [n.kind for n in t.tree] == ["for"]
    assert not Template("{% for m in messages %}{{ loop.first }}{% endfor %}").per_turn
    assert not Template("{% set a = messages %}{% for m in messages %}{{ m.text }}{% endfor %}").per_turn


def test_generation_marks():
    t = Template("{% for m in messages %}<{% generation %}{{ m.text }}{% endgeneration %}>{% endfor %}")
    assert joined(t.chunks([{"text": "ab"}, {"text": ""}, {"text": "é"}])) == ("<ab><><é>", [(1, 3), (7, 8)])


def test_streams_with_one_turn_ahead():
    seen = []

    def messages():
        for i in range(100):
            seen.append(i)
            yield {"text": str(i)}

    out = Template("{% for m in messages %}{{ m.text }}{{ '.' if loop.last else ',' }}{% endfor %}").chunks(messages())
    assert next(out)[0] == "0" and seen == [0, 1]
    assert "".join(t for t, _ in out).endswith(",99.")


def brute(rows):
    """conv -> expected row, from the input alone (formatted_chars from a plain rendering)."""
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, ts in groups.items():
        ts = sorted(ts, key=lambda r: r[:3] + (f"<s>{escape(r[2])}" + escape(r[3]),))
        said = "".join(x for *_, r, x in ts if r == "assistant")
        plain = "".join(f"<s>{escape(r)}{'[/INST] ' if r == 'assistant' else '[INST] '}{escape(x)}</s>\n" for *_, r, x in ts)
        out[conv] = (len(ts), hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in ts).encode()).hexdigest(), len(said),
                     hashlib.sha256(said.encode()).hexdigest(), len(plain))
    return out


PROBE_ROWS = [(-7, 0, "user", PROBE_TEXT), (-7, 1, "assistant", PROBE_TEXT)]


def frame(spark, rows):
    return spark.createDataFrame([Row(conv_id=a, turn=b, role=c, text=d, n_turns=5, piece="clash") for a, b, c, d in rows], SCHEMA)


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_conversations_match_brute_force(spark, seed):
    rng = random.Random(seed)
    bits = ["</s>", "<s>", "[INST]", " ", "\n", "hé", "[/INST] ", "\\", "<", "[", "x" * 50]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "<s>", None, "a\nb[INST] "]), "".join(rng.choices(bits, k=rng.randint(0, 9))))
            for c in range(30) for t in range(rng.randint(1, 12))]
    rows += [(99, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]       # a hot conversation
    rows += [(None, 1, "user", None), (None, None, None, "x"), (50, 1, "user", "same"), (50, 1, "user", "same"),
             (51, 0, "assistant", "y" * 1_000_000), (52, 3, "", "")]
    rng.shuffle(rows)
    assert result(chat_format(frame(spark, rows))) == brute(rows + PROBE_ROWS)


def test_empty_table_and_own_conversation_of_the_probes_number(spark):
    assert result(chat_format(frame(spark, []))) == brute(PROBE_ROWS)
    got = chat_format(frame(spark, [(-7, 0, "user", "mine")])).collect()
    assert sorted(r["n_turns"] for r in got) == [1, 2] and {r["conv_id"] for r in got} == {-7}


def test_template_that_looks_around(spark):
    source = TEMPLATE.replace("<s>{{ message.role", "{{ '' if loop.last else '' }}<s>{{ message.role")
    assert not compiled(source).per_turn
    rows = [(c, t, "assistant" if t % 2 else "user", f"{c} [INST] {t}") for c in range(5) for t in range(7)]
    plain = turns(frame(spark, rows))
    assert result(read_back(formatted(plain, source), source)) == brute(rows)
