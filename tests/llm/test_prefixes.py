import hashlib
import random
import zlib

import pytest

from tripmill.llm import prefixes
from pyspark.sql import functions as F

SCHEMA = "conv_id bigint, turn bigint, role string, text string, x1 bigint, path string, depth int, n int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, 7, "p", 3, 4) for r in rows], SCHEMA).repartition(3)


def ordered(rows):
    """Turns of each conversation by number, nulls first, as (role, text)."""
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(ts, key=lambda t: t[:2])] for c, ts in convs.items()}


def rebuilt(convs):
    found = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return found


def brute(convs):
    """Every prefix of every conversation in a dictionary."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    nodes = {}
    for prefix, convs_in in sorted(members.items(), key=lambda m: -len(m[0])):
        children = [p for p in members if len(p) == len(prefix) + 1 and p[: len(prefix)] == prefix]
        ends = sorted(c for c in convs_in if len(convs[c]) == len(prefix))
        nodes[prefix] = {
            "leaves": sum(nodes[p]["leaves"] for p in children) or 1,
            "saved": sum(nodes[p]["saved"] for p in children) + (len(convs_in) - 1) * (len(prefix[-1][1]) if prefix else 0),
            "children": len(children),
            "ends": hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        }
    return sorted(
        [
            (min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), nodes[p]["children"], nodes[p]["leaves"], nodes[p]["saved"], nodes[p]["ends"])
            for p, cs in members.items()
        ],
        key=repr,
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def result(df):
    assert df.columns == COLUMNS
    assert [k for n, k in df.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted([tuple(r) for r in df.collect()], key=repr)


def plain(turns):
    return turns, turns.select("conv_id").distinct()


def random_rows(n, depth, words, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, depth)):
            rows.append((c * 7 % n, t, "user" if t % 2 else "system", rng.choice(words)))
    rng.shuffle(rows)
    return rows


def chains(n):
    """Conversations that each start with all shorter ones, and two that leave late."""
    return [(c, t, "u", f"t{t}") for c in range(n) for t in range(c + 1)] + [
        (n + 1 + i, t, "u", f"t{t}" if t < n - 3 + i else "off") for i in range(2) for t in range(n)
    ]


CASES = {
    "random": random_rows(120, 6, ["a", "b", "cc"], 1),
    "few shared": random_rows(60, 9, [f"w{i}" for i in range(40)], 2),
    "chains": chains(20),
    "copies": [(c, t, "u", f"t{t}" if c % 3 else f"t{t}{c}") for c in range(60) for t in range(4)],
    "one": [(5, 0, "u", "only")],
    "odd": [
        (1, None, None, None),
        (1, 2, "u", ""),
        (1, 1, "u", "x" * 100_000),
        (2, None, "", ""),
        (None, 0, "u", "no conversation"),
        (-3, 5, "ab", "c"),
        (-4, 5, "a", "bc"),
        (10**12, 1, "u", "é🙂"),
        (10**12 + 1, 9, "u", "é🙂"),
    ],
}


@pytest.mark.parametrize("name", CASES)
def test_same_as_all_prefixes(spark, name):
    turns = prefixes.turns_in_order(rows_of(spark, CASES[name]))
    assert result(prefixes.trie_nodes(prefixes.sequences(*plain(turns)))) == brute(ordered(CASES[name]))


@pytest.mark.parametrize("seed", [3, 4])
def test_rebuilt_from_other_conversations(spark, seed):
    rows = [(c + 37, t, r, x) for c, t, r, x in random_rows(250, 8, ["a", "b"], seed)]
    turns = prefixes.turns_in_order(rows_of(spark, rows))
    found = prefixes.trie_nodes(prefixes.sequences(*prefixes.with_shared_starts(turns, 5, 100)))
    convs = rebuilt(ordered(rows))
    assert any(not ts for ts in convs.values())
    assert result(found) == brute(convs)


def test_ends_of_many_copies_are_hashed_in_order(spark, monkeypatch):
    rows = [(c * 13 % 999, 0, "u", "same") for c in range(999)]
    ends = spark.createDataFrame([(1, 2, c) for c, *_ in rows] + [(3, 4, 10**9)], "x1 bigint, x2 bigint, conv_id bigint").repartition(5)
    found = {(r["x1"], r["x2"]): r["ends_sha256"] for r in prefixes.ends_hashes(ends).collect()}
    assert found[1, 2] == hashlib.sha256(",".join(map(str, sorted(c for c, *_ in rows))).encode()).hexdigest()
    assert found[3, 4] == hashlib.sha256(str(10**9).encode()).hexdigest()


def test_empty_table(spark):
    for rows in ([], [(None, 0, "u", "x")]):
        turns = prefixes.turns_in_order(rows_of(spark, rows))
        assert result(prefixes.trie_nodes(prefixes.sequences(*prefixes.with_shared_starts(turns, 5, 100)))) == []


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 70)]
    found = spark.createDataFrame(pairs, "a int, b int").select("a", "b", prefixes.two_fattest("a", "b").alias("f")).collect()
    fat = lambda n: n & -n
    assert all(r["f"] == max(range(r["a"] + 1, r["b"] + 1), key=fat) for r in found)


def test_search_finds_where_each_conversation_leaves(spark):
    """Exit depth and edge of conversations that are not in the trie, against comparing with all that are."""
    def paths(rows):
        seqs = prefixes.sequences(*plain(prefixes.turns_in_order(rows_of(spark, rows))))
        last = F.get("path", F.size("path") - 1)
        return seqs.select(last["x1"].alias("x1"), last["x2"].alias("x2"), "path").dropDuplicates(["x1", "x2"])

    inside, outside = paths(CASES["random"]), paths(random_rows(80, 12, ["a", "b", "cc", "d"], 9))
    nodes = prefixes.build(inside)
    known = {t["x1"] for r in inside.collect() for t in r["path"]}
    extents = {(r["x1"], r["x2"]): (r["top"], r["top"] + len(r["edge"])) for r in nodes.collect()}
    rest = outside.withColumn("a", F.lit(0))
    for row in prefixes.located(rest, nodes, 12).collect():
        depth = sum(t["x1"] in known for t in row["path"])
        assert row["depth"] == depth
        if row["v1"] is not None:
            low, high = extents[row["v1"], row["v2"]]
            assert low < depth < high
        else:
            assert depth == 0 or (row["path"][depth - 1]["x1"], row["path"][depth - 1]["x2"]) in extents
