import random

import numpy as np
import pytest

from hourglass.llm import mixing as M


def test_highest_quotients():
    r = np.random.default_rng(1)
    for _ in range(50):
        votes, seats = r.integers(0, 1000, r.integers(1, 9)), int(r.integers(0, 200))
        want = np.zeros(len(votes), int)
        for _ in range(seats if votes.sum() else 0):
            want[np.argmax(votes / (want + 0.5))] += 1
        assert M.sainte_lague(votes, seats).tolist() == want.tolist()


def test_targets_stop_at_twice_the_size():
    sizes = np.array([10, 1000, 1000, 500, 30])
    goal = M.targets(sizes, np.array([5.0, 2, 1, 5, 2]))
    assert (goal <= 2 * sizes + 1e-9).all() and abs(goal.sum() - 1.5 * sizes.sum()) < 1e-6
    free = goal < 2 * sizes - 1e-6
    assert np.ptp((goal / np.array([5.0, 2, 1, 5, 2]))[free]) < 1e-6


@pytest.fixture()
def rows():
    r = random.Random(4)
    return [(i, " ".join(["w"] * r.choice([0, 1, 5, 40, 300, 2000])), "en", "a" if i % 3 else r.choice(["b", "c", None])) for i in range(600)]


def test_mix_comes_near_the_targets(spark, make_docs, rows):
    out = M.mix(make_docs(rows, extra=True), shard_rows=50).collect()
    assert len(out) == len(rows)
    per = {}
    for (i, text, _, src) in rows:
        per[src] = per.get(src, 0) + len(text.split())
    order = sorted((s for s in per if s is not None)) + [None]
    goal = dict(zip(order, M.targets(np.array([per[s] for s in order]), np.resize([5.0, 2, 1], len(order)))))
    source = {r[0]: r[3] for r in rows}
    got = {s: 0 for s in order}
    for x in out:
        assert x.size == len(rows[x.doc_id][1].split()) and x.source_size == per[source[x.doc_id]]
        assert abs(x.target - goal[source[x.doc_id]]) < 1e-6
        assert 0 <= x.taken <= 2 * x.size
        got[source[x.doc_id]] += x.taken
    for s in order:
        assert abs(got[s] - goal[s]) <= 0.01 * goal[s] + 16 * 8
    again = {x.doc_id: x.taken for x in M.mix(make_docs(list(reversed(rows))).repartition(7), shard_rows=50).collect()}
    assert again == {x.doc_id: x.taken for x in out}


def test_words_taken_equal_the_chosen_blocks_one_by_one(spark, make_docs, rows):
    placed = M._placed(make_docs(rows), block=16, shard_rows=50, seed=3).collect()
    shards = {}
    for p in placed:
        shards.setdefault((p.src_key, p.shard), []).append(p)
    for members in shards.values():
        p = members[0]
        times = [p._once + ((b + 1) * p._more + p._from) // p._n - (b * p._more + p._from) // p._n for b in range(p.n_blocks)]
        assert sum(times) == p.shard_quota
        for m in members:
            assert m.taken == sum(times[w // 16] for w in range(m._start, m._end))


def test_mixed_documents(spark, make_docs, odd_rows, rows):
    docs = make_docs(rows, extra=True)
    out = M.mixed(docs, shard_rows=50)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert max(ids.count(i) for i in set(ids)) <= 2
    assert sorted(ids) == sorted(r.doc_id for r in M.mixed(docs, shard_rows=50).collect())
    M.mixed(make_docs(odd_rows, extra=True)).collect()
    assert M.mix(make_docs(odd_rows, extra=True)).count() == len(odd_rows)
    assert M.mix(make_docs([])).count() == 0 and M.mixed(make_docs([])).count() == 0


@pytest.mark.parametrize("others", [2, 12, 60])
def test_long_documents_of_a_hot_source_come_near_its_target(spark, make_docs, others):
    r = random.Random(9)
    rows = [(i, " ".join(["w"] * r.randint(3000, 6000)), "en", "c") for i in range(60)]
    rows += [(1000 + i, " ".join(["w"] * r.randint(100, 900)), "en", "ab"[i % 2]) for i in range(others * 20)]
    size = {x[0]: len(x[1].split()) for x in rows}
    per = {s: sum(size[x[0]] for x in rows if x[3] == s) for s in "abc"}
    goal = dict(zip("abc", M.targets(np.array([per[s] for s in "abc"]), np.array(M.WEIGHTS, float))))
    got = dict.fromkeys("abc", 0)
    for x in M.mixed(make_docs(rows)).collect():
        got[x.source] += size[x.doc_id]
    for s in "abc":
        assert abs(got[s] - goal[s]) <= max(size[x[0]] for x in rows if x[3] == s) + 4 * 1024, (s, got, goal)
