import hashlib
import random
import zlib
from collections import defaultdict

import brute
import pytest
from quizlog.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def want(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)

    def down(k):
        return [k] + [x for c in children[k] for x in down(c)]

    rows = []
    for k, m in members.items():
        sub = down(k)
        ending = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(k))))
        rows.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]),
                     sum(not children[x] for x in sub),
                     sum((len(members[x]) - 1) * len(brute.SPACE.findall(x[-1][1])) for x in sub if x),
                     hashlib.sha256(ending.encode()).hexdigest()))
    return sorted(rows, key=str)


def got(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                       "saved_tokens", "ends_sha256").collect()), key=str)


def log(seed, n=120, depth=6, alphabet=2):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(0, depth)):
            rows.append((c, t, r.choice(["user", "assistant"][:alphabet]), r.choice(["a", "b c", "a\x0bd  e"][:alphabet])))
    return rows


AWKWARD = [
    (0, 0, "user", "hi there"), (0, 1, "assistant", "yes"), (0, None, "user", "null turn first"), (0, 1, "assistant", "yes"),
    (1, 0, None, None), (1, 0, "", ""), (2, 0, "user", "hi there"), (3, 0, "us", "erhi there"), (19, 5, "user", "x" * 100_000),
    (None, 0, "user", "nobody's"), (40, 0, "user", "é ü z"), (41, 7, "user", "é ü z"), (45, 0, "user", "q"), (45, 0, "user", "q"),
]


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_against_brute_force(spark, parts):
    rows = AWKWARD + [(c + 60 if c is not None else c, *x) for c, *x in log(parts, depth=2 + parts % 6)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(P.nodes(df, parts)) == want(rebuilt(rows))


def test_one_hot_conversation_and_copies(spark):
    """A long conversation, many copies, one common first turn, and one
    conversation that extends the copies."""
    rows = [(c, t, "user", f"copy {t}") for c in range(0, 400, 20) for t in range(4)]
    rows += [(c, t, "user", "copy 0" if t == 0 else f"own {c} {t}") for c in range(400, 700, 20) for t in range(3)]
    rows += [(1000, t, "user", f"copy {t}") for t in range(300)]
    rows += [(1020, t, "user", f"copy {t}" if t < 250 else "other") for t in range(300)]
    assert got(P.nodes(spark.createDataFrame(rows, SCHEMA), 5)) == want(rebuilt(rows))


def test_merged_ranges_equal_one_forest():
    """``forest`` on every cut of sorted sequences, its pieces merged by hand."""
    r = random.Random(5)
    for _ in range(60):
        seqs = sorted({tuple(r.choice("ab") for _ in range(r.randint(0, 5))) for _ in range(r.randint(1, 14))})
        counts = [r.randint(1, 3) for _ in seqs]

        def pieces(cuts):
            out = []
            for a, z in zip([0, *cuts], [*cuts, len(seqs)]):
                part = [list(s) for s in seqs[a:z]]
                out += P.forest(part, [[len(x) + ord(x) % 3 for x in s] for s in part], counts[a:z], list(range(a, z)),
                                [f"end{i}" for i in range(a, z)], P.lcp(seqs[a - 1], seqs[a]) if a else -1,
                                P.lcp(seqs[z - 1], seqs[z]) if z < len(seqs) else -1)
            return out

        def figures(rows):
            by = defaultdict(lambda: [0, 0, 0, 0, 10**9, set()])
            closed = []
            for key, pkey, conv, depth, _, n, kids, leaves, saved, end in rows:
                if key is None:
                    closed.append((depth, conv, n, kids, leaves, saved, end))
                    continue
                x = by[key, pkey, depth]
                for i, v in enumerate((n, kids, leaves, saved)):
                    x[i] += v
                x[4] = min(x[4], conv)
                x[5] |= {end} - {None}
            return sorted(closed + [(k[2], x[4], *x[:4], (list(x[5]) or [P.NOTHING])[0]) for k, x in by.items()])

        whole = figures(pieces([]))
        for _ in range(4):
            cuts = sorted(r.sample(range(1, len(seqs)), r.randint(0, len(seqs) - 1))) if len(seqs) > 1 else []
            assert figures(pieces(cuts)) == whole


def test_clashing_and_empty(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    extra = df
    for c in ("at", "turns", "n", "key", "depth", "part", "_lead", "_lender", "seq_key"):
        extra = extra.selectExpr("*", f"7 AS {c}")
    assert got(P.nodes(extra)) == got(P.nodes(df)) == want(rebuilt(AWKWARD))
    assert P.nodes(df.limit(0)).count() == 0
    assert got(P.nodes(spark.createDataFrame([(21, 0, "user", "gone")], SCHEMA))) == want(rebuilt([(21, 0, "user", "gone")]))
