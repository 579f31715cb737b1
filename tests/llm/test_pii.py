"""Personal data: fixed patterns against the plain expressions, the field on cases, Viterbi against all paths."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rooftally.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    return sum(sum(divmod(int(d) * (1 + at % 2), 10)) for at, d in enumerate(reversed(number))) % 10 == 0


def plain(text):
    return (
        [("email", *m.span()) for m in EMAIL.finditer(text)]
        + [("ip", *m.span()) for m in IP.finditer(text) if all(int(part) <= 255 for part in m.group().split("."))]
        + [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
        + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    )


@settings(max_examples=500, deadline=None)
@given(st.one_of(
    st.text(alphabet="a@.-+%_ x9é", max_size=40), st.text(alphabet="0123456789. ", max_size=40), st.text(alphabet="0123456789 -", max_size=60), st.text(alphabet="+0123456789().- a", max_size=60),
))
def test_base_is_what_the_expressions_say(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", [
    "a@b.c", "a@b", "a@b@c.d", "@b.c", "x a@b.c.d-e. y", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "001.002.003.004", "0000000255.1.1.1", "4111 1111 1111 1111",
    "4111-1111-1111-1112 4111111111111111", "+1 (212) 555-0142", "+12 3", "+1 22 333 4444 555 6666 77", "1" * 5000, "a" * 5000 + "@", "." * 3000,
])
def test_base_on_cases(text):
    assert pii.base_spans(text) == plain(text)


def test_viterbi_takes_the_best_path():
    random_ = np.random.default_rng(3)
    moves = random_.normal(size=(3, 3))
    runs = [random_.normal(size=(size, 3)) for size in (1, 4, 2, 5, 4)]

    def value(run, path):
        steps = [0, *path, 0]
        return sum(run[at, label] for at, label in enumerate(path)) + sum(moves[a, b] for a, b in zip(steps, steps[1:]))

    for run, labels in zip(runs, pii.viterbi(runs, moves)):
        best = max(itertools.product(range(3), repeat=len(run)), key=lambda path: value(run, path))
        assert tuple(labels) == best
    assert pii.viterbi([], moves) == []


def test_cutting_certain_tokens_changes_no_path():
    field = pii.train()
    text = "call her on +44 20 7946 0958 or 4012 8888 8888 1882 now and password=b7db7aa4a5fcc78305 then " * 3
    tokens = text.split()
    scores = field.emissions(tokens)
    doubt = field.doubtful(scores)
    assert 0 < doubt.sum() < len(tokens)
    assert not pii.viterbi([scores], field.moves)[0][~doubt].any()


def test_table_is_learned():
    field = pii.train()
    for tokens, labels in pii.parse_table(pii.TABLE + pii.PLAIN):
        assert pii.viterbi([field.emissions(tokens)], field.moves)[0].tolist() == labels


@pytest.mark.parametrize("text, found", [
    ('the token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" was set', ["1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae"]), ("and password=b7db7aa4a5fcc78305 it is", ["password=b7db7aa4a5fcc78305"]),
    ("words and 1,200 more in 1999, version 2.0", []), ("Thonent edly thinwh, and onhe.", []), (None, []), ("", []), ("At " * 20, []), ("a | b | c. | d", []),
])
def test_added_spans(text, found):
    _, added = pii.spans_of(pii.train(), [text])[0]
    assert [text[start:stop] for _, start, stop in added] == found


def test_added_overlap_no_base(documents, clashing):
    texts = ["mail a.b@c.example, card 4111 1111 1111 1111, ip 10.0.0.1, +1 (212) 555-0142, key 4012888888881882", None, "", "é " * 20_000 + "x@y.zz", "a@b.cc"]
    rows = {r.doc_id: r for r in pii.find(clashing(documents(*enumerate(texts), (9, "a@b.cc"), (9, "a@b.cc")))).collect()}
    assert len(rows) == 6
    for key, text in enumerate(texts):
        base = [tuple(span) for span in rows[key].base]
        assert base == plain(text or "")
        for _, start, stop in rows[key].added:
            assert all(stop <= a or b <= start for _, a, b in base)
    assert pii.find(documents().limit(0)).count() == 0


def test_long_runs_of_zeros_are_no_error():
    text = "0" * 5000 + ".1.1.1"
    assert ("ip", 0, len(text)) in pii.base_spans(f"{text}")
    assert not [span for span in pii.base_spans("0" * 5000 + "256.1.1.1") if span[0] == "ip"]


def test_features_tell_long_tokens_apart():
    head = "a9-" * 12
    one, other = pii.token_class(head + "x_1"), pii.token_class(head + "x_1_2=3")
    assert one != other and set(one) & set(other)
    assert pii.token_class("a9-b8") == pii.token_class("c7-d6")
    names = [pii.token_class(f"{'n' * 12}{tail}=5") for tail in ("abc", "xyz")]
    assert names[0] != names[1]
