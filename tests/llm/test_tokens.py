import random
import sys

import numpy as np
import pytest

from tidemark.llm import tokens


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder("byte_bpe_50k.json")


def plain(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_every_code_point_in_every_place(encoder):
    for point in range(0, sys.maxunicode + 1, 7):
        if 0xD800 <= point < 0xE000:
            continue
        c = chr(point)
        text = f"a{c}1{c}!{c} {c}{c}  {c}\n{c}"
        assert encoder.ids(text) == plain(encoder, text), hex(point)


def test_random_strings(encoder):
    drawn = random.Random(3)
    pool = [chr(c) for c in range(0x250)] + list("   \n\t'sdmt") * 20
    pool += ["<|endoftext|>", "'ll", "'ve", " ", "　", "漢", "😀", "\x1c"]
    for _ in range(3000):
        text = "".join(drawn.choices(pool, k=drawn.randint(0, 20)))
        assert encoder.ids(text) == plain(encoder, text), repr(text)


@pytest.mark.parametrize("text", ["ab" * 40_000, " " * 200_000, "\n" * 50_000 + "a", "é" * 9000])
def test_long_runs_do_not_break(encoder, text):
    assert encoder.ids(text) == plain(encoder, text)


def test_long_run_is_never_missed():
    drawn = random.Random(4)
    for _ in range(300):
        parts = ["ab " * drawn.randint(0, 900), drawn.choice([" ", "x", "\n"]) * 3000, " c" * 40]
        drawn.shuffle(parts)
        assert tokens.has_long_run("".join(parts))


def test_special_string_and_array(encoder):
    assert encoder.ids("a<|endoftext|>b")[1] == 50256
    assert encoder.array("a b").dtype == np.dtype("<u4")
