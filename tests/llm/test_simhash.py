import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from lapsewise.llm import simhash
from lapsewise.llm.components import components
from lapsewise.llm.common import Scratch

SCHEMA = "doc_id long, text string, print string, row string, first int"


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, max_distance=3):
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_distance:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def corpus(rng):
    words = ["alpha", "Beta", "GAMMA", "δelta", "Épsilon", "x", "y,", "z."]
    base = [rng.choices(words, k=rng.randint(40, 120)) for _ in range(12)]
    texts = []
    for k in range(160):
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 5])):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append((1000 - k, rng.choice([" ", "\n", "\t "]).join(own)))
    return texts + [(3, None), (None, ""), (2, " \n "), (5, "one"), (6, "one two"), (7, "ONE two"), (None, "lonely null id text"), (5, "one")]


@pytest.mark.parametrize("options", [{}, {"long_list": 3}])
def test_groups_equal_brute_force(spark, options):
    texts = corpus(random.Random(1))
    frame = spark.createDataFrame([(i, t, None, "r", 1) for i, t in texts], SCHEMA).repartition(4)
    rows = simhash.near_duplicate_groups(frame, **options).collect()
    prints = [plain_fingerprint(t) for _, t in texts]
    label = plain_components(prints)
    least = {}
    for (i, _), g in zip(texts, label):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    expected = [(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(texts, prints, label)]
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    kept = simhash.one_of_each_group(frame)
    assert kept.columns == frame.columns
    groups = {g: least.get(g) for g in label}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(groups.values(), key=repr)


def test_empty_table(spark):
    assert simhash.near_duplicate_groups(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("search_from", [1, 1 << 16])
def test_stars_of_a_list_are_its_components(monkeypatch, search_from):
    monkeypatch.setattr(simhash, "SEARCH_FROM", search_from)
    rng = np.random.default_rng(2)
    mask = simhash.long_masks(simhash.list_masks(3)[3], 3)[7]
    free = [b for b in range(64) if not mask >> b & 1]
    members = {0x0123456789ABCDEF & mask}
    for _ in range(400):
        start = list(members)[rng.integers(len(members))]
        members.add(start ^ sum(1 << int(b) for b in rng.choice(free, rng.integers(1, 6), replace=False)))
    members = sorted(members)
    edges = simhash.stars(np.array(members, np.uint64), mask, 3)
    label = plain_components(members)
    assert len(edges) == len(members) - len(set(label))
    at = {m: k for k, m in enumerate(members)}
    assert all(members[label[at[b]]] == a for a, b in edges)


def test_every_near_pair_shares_a_list():
    rng = random.Random(3)
    masks = simhash.list_masks(3)
    assert len(masks) == 8
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << p for p in rng.sample(range(64), rng.randint(0, 3)))
        met = [m for m in masks if a & m == b & m]
        assert met
        # The lists that replace a long one still hold every pair with the minimum.
        for m in met:
            assert any(a & n == b & n for n in simhash.long_masks(m, 3))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    chain = [(k, k + 1) for k in range(100, 180)]
    star = [(7, 1000 + k) for k in range(200)]
    edges = chain + star + [(1, 1), (2000, 2001), (2001, 2000)]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()
    expected = {k: 100 for k in range(100, 181)} | {7: 7} | {1000 + k: 7 for k in range(200)} | {2000: 2000, 2001: 2000}
    assert {r.node: r.label for r in got} == expected and len(got) == len(expected)
