"""The budget of a trie bounds what it takes in memory, whatever the texts."""

import random
import tracemalloc

import pytest

from quillmine.llm.exact_dedup import PatriciaTrie


@pytest.mark.parametrize("kind", ["short", "shared", "long"])
def test_budget_bounds_memory(kind):
    r = random.Random(4)
    make = {"short": lambda: r.randbytes(8), "shared": lambda: b"the same opening of all " * 3 + str(r.random()).encode(), "long": lambda: r.randbytes(3000)}[kind]
    texts = [make() for _ in range(40_000 if kind != "long" else 4000)]
    budget, out, most = 4 << 20, 0, 0
    trie = PatriciaTrie()
    tracemalloc.start()
    for i, text in enumerate(texts):
        trie.insert(text, i)
        while trie.size > budget:
            out += sum(1 for _ in trie.spill())
        if i % 500 == 0:
            most = max(most, tracemalloc.get_traced_memory()[0])
    tracemalloc.stop()
    assert most < 1.3 * budget and trie.size > 0
    assert out + sum(1 for _ in trie.drain()) >= len(set(texts))
