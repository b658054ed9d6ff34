"""What a chunk costs a worker that packs."""

import random
import sys
from collections import Counter

from strandline.llm import packing
from strandline.llm.queries import byte_bpe


def test_chunks_are_learned_without_calls_for_each():
    rng = random.Random(5)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(500)) for _ in range(20)]
    encoder, calls = packing.Encoder(byte_bpe(), packing.MEMO_SIZE), Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        got = encoder.encode(texts)
    finally:
        sys.setprofile(None)
    assert calls["call"] + calls["c_call"] < len(encoder.memo) / 2  # 9,980 chunks; about four calls each before
    assert got == encoder.whole(texts)


def test_chunks_that_end_in_any_blank_keep_their_ids():
    blanks = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    texts = [f"w{b} v{b} {b}u {b}" for b in blanks] + [f"x w{b}" for b in blanks]
    encoder = packing.Encoder(byte_bpe(), packing.MEMO_SIZE)
    assert encoder.encode(texts) == encoder.whole(texts) == encoder.encode(texts)
