import hashlib
import random
import zlib

import pytest

from clickpulse.llm.prefixtrie import COLUMNS, PrefixTrie, prefix_trie_report, rebuilt, sequences

DDL = "conv_id long, turn long, role string, text string"


def _plain(rows):
    """The trie from Python lists: {path: members}, then sums over paths."""
    own = {}
    for c, turn, role, text in rows:
        own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items() if c is not None}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        turns = own.get(c - c % 100, [])[:h] + turns[h:]
        for d in range(len(turns) + 1):
            members, ends = paths.setdefault(tuple(turns[:d]), ([], []))
            members.append(c)
            if d == len(turns):
                ends.append(c)
    out = []
    for path, (members, ends) in paths.items():
        under = [p for p in paths if p[:len(path)] == path]
        child = lambda p: [q for q in paths if len(q) == len(p) + 1 and q[:len(p)] == p]
        out.append((min(members), len(path), min(paths[path[:-1]][0]) if path else None, len(members), len(child(path)),
                    sum(not child(p) for p in under),
                    sum((len(paths[p][0]) - 1) * len(p[-1][1]) for p in under if p),
                    hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def talks():
    """Ids over several blocks; a very common first turn; one conversation many times over."""
    rng = random.Random(3)
    rows = []
    for c in rng.sample(range(0, 900), 150):
        kind = c % 3
        turns = ["hello", "same", "same"] if kind == 0 else [rng.choice(["hello", "hi", f"x{c}"])] + [
            rng.choice(["a", "b", "日本é", ""]) for _ in range(rng.randint(0, 7))]
        rows += [(c, t, ("user", "assistant")[t % 2], text) for t, text in enumerate(turns)]
    rng.shuffle(rows)
    return rows


def _found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def test_same_nodes_as_plain_version(spark, talks):
    assert _found(prefix_trie_report(spark.createDataFrame(talks, DDL))) == _plain(talks)


@pytest.mark.parametrize("rows,turns", [(1, 1), (2, 5), (10, 10**6), (10**6, 10**6)])
def test_nodes_do_not_depend_on_when_containers_burst(spark, talks, rows, turns):
    convs = rebuilt(sequences(spark.createDataFrame(talks, DDL)))
    assert _found(PrefixTrie(convs, rows, turns).nodes()) == _plain(talks)


def test_one_long_conversation_and_one_that_most_share(spark):
    rows = [(1, t, "user", f"line {t}") for t in range(3000)] + [(100 + 7 * i, t, "user", "x" * t) for i in range(300) for t in range(4)]
    found = _found(prefix_trie_report(spark.createDataFrame(rows, DDL)))
    h = zlib.crc32(b"1") % 6  # turns that the absent conversation 0 does not give
    assert [r[:4] for r in found if r[1] == 0] == [(1, 0, None, 301)]
    assert sorted(r[1] for r in found if r[0] == 1) == list(range(3000 - h + 1))
    assert all(r[3:6] == (1, r[1] < 3000 - h, 1) for r in found if r[0] == 1 and r[1] > 0)


def test_odd_rows(spark):
    rows = [(0, None, "user", "b"), (0, 0, None, None), (0, 1, "user", "t"), (None, 0, "user", "nobody's"), (7, 0, "user", "q"),
            (7, 0, "user", "q"), (250, 3, None, "é")]
    assert _found(prefix_trie_report(spark.createDataFrame(rows, DDL))) == _plain(rows)
    assert prefix_trie_report(spark.createDataFrame([], DDL)).count() == 0
    assert prefix_trie_report(spark.createDataFrame([(None, 1, "a", "b")], DDL)).count() == 0
    # a conversation without turns is a member of the root
    h = zlib.crc32(b"150") % 6
    short = [(150, t, "user", "z") for t in range(min(h, 1))]
    if short:
        assert [r[:6] for r in _found(prefix_trie_report(spark.createDataFrame(short, DDL)))] == [(150, 0, None, 1, 0, 1)]
