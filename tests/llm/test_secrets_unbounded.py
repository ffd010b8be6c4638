"""Secrets of any length: nothing that the lexer reads is cut, and its time stays linear."""

from __future__ import annotations

import random
import time

import pytest

from watchpost.llm import secrets

PART = "Q7rt9xLw2pZ"
LONG = PART * 182  # 2,002 characters


def literals(text):
    return [text[a:z] for a, kind, z, _ in secrets.secret_spans(text) if kind == 3]


@pytest.mark.parametrize(
    "text",
    [
        f"AUTH_BEARER={LONG}",
        f"<privateKey>{LONG}</privateKey>",
        f'{{"{"a." * 1000}password": "{LONG}"}}',
        f"{'a' * 2000}_token = {LONG}",
        f"password.{'.'.join('abcdefghijklm')}={LONG}",
        f'config["{"k" * 2000}"].token = "{LONG}"',
    ],
)
def test_long_values_and_names(text):
    assert literals(text) == [LONG]


def test_all_operands_of_a_right_side():
    parts = [f"q7Rt9-xLw2p{i}" for i in range(100)]
    assert literals("password = " + " + ".join(f'"{p}"' for p in parts)) == parts
    names = [f"part_{i}" for i in range(100)]
    bound = "\n".join(f'{n} = "{p}"' for n, p in zip(names, parts))
    assert literals(f"{bound}\npassword = {' + '.join(names)}") == parts


def test_assignments_within_one_word():
    text = f"url=q7Rt9;x=1&token={LONG}&id=2"
    assert literals(text) == [f"{LONG}&id=2"]
    assert literals("a = : \ntoken = q7Rt9-xLw2pZ = :") == ["q7Rt9-xLw2pZ"]  # nothing is given to the last name


def test_literals_with_one_end_are_judged_as_each_by_itself():
    rng = random.Random(4)
    for alphabet in ("ab", "xX", "0123.", "aB3=&-", "example=", "a =b1", "".join(map(chr, range(33, 127))), "é9Ω="):
        for _ in range(20):
            text = "".join(rng.choice(alphabet) for _ in range(400))
            starts = sorted(rng.sample(range(len(text) - 1), 30))
            single = [secrets.likeness(text[a:]) for a in starts]
            assert secrets.likenesses(text, starts, len(text)) == pytest.approx(single)


@pytest.mark.parametrize("text", ["a=", "token=", "b=b + ", "a.b.", "a-", "<a>", "a:", "x[k", "password=q7Rt9xLw&", "k='k=\"", "a=b."])
def test_time_is_linear(text):
    def seconds(n):
        begin = time.process_time()
        secrets.secret_spans(text * n)
        return time.process_time() - begin

    seconds(1000)
    assert seconds(32_000) < 40 * seconds(4_000) + 0.5  # 8 times the text; the square would be 64
