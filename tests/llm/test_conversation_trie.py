import collections
import hashlib
import random
import zlib

from lapsewise.llm import conversation_trie
from lapsewise.llm.common import Scratch
from lapsewise.llm.conversation_trie import numbered_turns, prefix_trie, rebuilt_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, pos string, h1 string"


def ordered(rows):
    """conversation -> its (role, text) in order."""
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn, role or "", text or ""))

    def key(turn):
        digest = hashlib.sha256(f"{len(turn[1].encode())}:{turn[1]}{turn[2]}".encode()).digest()
        return turn[0] is not None, turn[0] or 0, *(int.from_bytes(digest[k : k + 8], "big", signed=True) for k in (0, 8))

    return {c: [t[1:] for t in sorted(v, key=key)] for c, v in turns.items()}


def rebuilt(convs):
    found = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        found[c] = convs.get(c - c % 5, [])[:h] + turns[h:]
    return found


def nodes(convs):
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, of in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(of) - 1) * len(path[-1][1].encode()) if path else 0
    rows = []
    for path, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        rows.append((min(of), len(path), parent, len(of), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(60), 40):
        for turn in range(rng.choice([1, 2, 3, 4, 5, 8, 9, 13])):
            rows.append((conv, turn if rng.random() > 0.1 else None, rng.choice(["u", "a", None]), rng.choice(["x", "yy", None, "é"])))
    rows += rng.sample(rows, 10) + [(None, 0, "u", "x"), (None, None, None, None)]
    # Two long conversations with one path for most of it, and one turn that is long.
    rows += [(100, k, "u", "x") for k in range(41)] + [(105, k, "u", "x") for k in range(44)] + [(200, 0, "u", "long " * 40_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", None, "clash") for r in rows], SCHEMA).repartition(3)


def test_nodes_are_those_of_brute_force(spark, monkeypatch):
    for seed, width, run in ((1, 4, 4096), (2, 3, 2)):
        monkeypatch.setattr(conversation_trie, "RUN", run)
        monkeypatch.setattr(conversation_trie, "CHUNK_BITS", seed)
        rows = random_rows(seed)
        got = rebuilt_trie(frame(spark, rows), width=width)
        assert sorted(map(tuple, got.collect()), key=repr) == nodes(rebuilt(ordered(rows)))


def test_trie_of_conversations_as_they_are(spark):
    rows = [(c, t, "u", f"text {t if c % 7 else c}") for c in range(-30, 30) for t in range(c % 6 + 1)]
    scratch = Scratch(spark, "test-trie")
    got = prefix_trie(numbered_turns(frame(spark, rows), scratch), scratch)
    assert sorted(map(tuple, got.collect()), key=repr) == nodes(ordered(rows))


def test_rebuilt_conversations_without_turns_are_members_of_the_root(spark):
    # Their bases are absent and they have fewer turns than they would share.
    convs = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9][:7]
    rows = [(c, 0, "u", "only") for c in convs]
    assert [tuple(r) for r in rebuilt_trie(frame(spark, rows)).collect()] == nodes(rebuilt(ordered(rows)))
    assert rebuilt_trie(frame(spark, [])).collect() == []
