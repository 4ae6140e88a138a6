import itertools

import pytest

from deltaloom.llm import op5_packing

SPACES = [" ", "\u00a0", "\t", "\n", "\r\n", "\x0b", "\u2003", "\u3000", "\x85", "\x1c"]


@pytest.fixture(scope="module")
def both():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = op5_packing.Tokens(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return own.ids, lambda t: whole.encode(t, add_special_tokens=False).ids


def test_alternating_space_and_no_break_space(both):
    assert both[0]("a \u00a0 \u00a0 b").tolist() == both[1]("a \u00a0 \u00a0 b") == [64, 11504, 275]


def test_runs_of_white_space(both):
    own, whole = both
    for n in (1, 2, 3, 4):
        for run in itertools.product(SPACES if n < 4 else SPACES[:4], repeat=n):
            for text in (f"a{''.join(run)}b", f"one two{''.join(run)}'s 12 {''.join(run)}", f"{''.join(run)}x y"):
                assert own(text).tolist() == whole(text), ascii(text)
