"""The conversation trie against a walk over all rebuilt conversations."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

from ingot.llm import trie
from tests.llm.test_operators import same


def rebuilt(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + t[h:])
    return out


def brute(rows):
    nodes = defaultdict(list)
    for c, seq in rebuilt(rows).items():
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    words = {n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0 for n in nodes}
    children = defaultdict(int)
    for n in nodes:
        if n:
            children[n[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for n, members in nodes.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(members) - 1) * words[n]
    whole = defaultdict(list)
    for c, seq in rebuilt(rows).items():
        whole[seq].append(c)
    for n, m in nodes.items():
        yield (min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n],
               hashlib.sha256(",".join(map(str, sorted(whole.get(n, [])))).encode()).hexdigest())


def odd_rows():
    rnd = random.Random(5)
    say = lambda k: "".join(rnd.choice(["a b", "c", "", "d\te", "\x0b", "Ä ö"]) for _ in range(k))
    texts = [say(2) for _ in range(4)] + [None, ""]
    rows = []
    for c in range(130):
        for t in range(rnd.choice([1, 2, 2, 3, 5])):
            rows.append((c, t, rnd.choice(["user", "assistant"]) if t % 2 else "user", rnd.choice(texts)))
    rows += [(c, t, "user", f"long {t}") for c in (200, 201, 202, 220, 227) for t in range(300)]  # long ones, shared
    rows += [(5, None, None, "first"), (6, None, "user", None), (None, 1, "user", "x"), (None, None, None, None), (-3, 1, "user", "neg"), (-20, 0, "u", "base"),
             (9_000_000_000, 0, "user", "far " * 5000), (7, 1, "user", "again"), (300, 0, "user", "same"), (300, 0, "user", "same"), (300, 0, "user", "same")]
    rows = list({(c, t): r for r in rows if r[0] != 300 for c, t in [r[:2]]}.values()) + [r for r in rows if r[0] == 300]  # no ties but equal rows
    rnd.shuffle(rows)
    return rows


def test_trie(spark):
    rows = odd_rows()
    df = spark.createDataFrame([r + (1, "x") for r in rows], "conv_id long, turn int, role string, text string, depth int, seq string").repartition(3)
    got = [r[:8] for r in trie.conversation_trie(df).collect()]
    want = list(brute(rows))
    same(got, want)
    assert len(want) > 300 and max(w[6] for w in want) > 0
    assert trie.conversation_trie(df.where("false")).collect() == []


def test_trie_of_a_hot_conversation(spark):
    # one conversation with a third of all rows, one repeated as often: their rows are dealt to several parts
    rows = [(40, t, "user", f"turn {t}") for t in range(3000)] + [(c, 0, "user", "hi") for c in range(1000, 4000)] + [(c, t, "bot", f"q {t}") for c in range(5000, 5100) for t in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(4)
    assert trie.turns(df).where("conv_id = 40").select("part").distinct().count() > 1
    got = {r[:8] for r in trie.conversation_trie(df.where("conv_id != 40 or turn < 120")).collect()}
    assert got == set(brute([r for r in rows if r[0] != 40 or r[1] < 120]))
    top = trie.conversation_trie(df).where("depth = 0").first()
    assert (top.n_convs, top.parent_conv_id) == (3101, None)


def test_ties_and_repeats(spark):
    rows = [(1, 0, "user", t) for t in ("b", "a", "b")] + [(1, 1, "bot", "c")]
    one = {r for r in map(tuple, trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect())}
    other = {r for r in map(tuple, trie.conversation_trie(spark.createDataFrame(rows[::-1], "conv_id long, turn int, role string, text string").repartition(3)).collect())}
    assert one == other and len(one) == len(rebuilt(rows)[1]) + 1
