import pytest

from qafila.operators import replay
from qafila.operators.generation import Outage
from qafila.operators.pool import Member, Pool, PoolOf, RequestFailed, in_order, load, share_of


class Scripted:
    def __init__(self, *answers):
        self.answers, self.calls = list(answers), 0

    def chat(self, messages, seed):
        self.calls += 1
        a = self.answers.pop(0) if len(self.answers) > 1 else self.answers[0]
        if isinstance(a, Exception):
            raise a
        return a


def pool(*backends, **options):
    now = [0.0]
    slept = []

    def sleep(s):
        slept.append(s)
        now[0] += s

    return Pool([Member(f"e{i}", b, replay.Endpoint(hard=2, effective=2)) for i, b in enumerate(backends)], clock=lambda: now[0], sleep=sleep, **options), slept


def test_round_robin_and_fail_over():
    a, b = Scripted("a"), Scripted(RequestFailed("timeout"), "b")
    p, _ = pool(a, b)
    assert [p.chat([], 0) for _ in range(4)] == ["a", "a", "b", "a"] and p.attempts[1] == ("e1", "timeout")
    assert p.members[1].state.effective == 1


def test_retries_then_outage():
    p, slept = pool(Scripted(RequestFailed("transport")))
    with pytest.raises(Outage):
        p.chat([], 0)
    assert len(p.attempts) == 4 and slept[:2] == [1.0, 2.0]


def test_authentication_disables_and_other_refusals_raise():
    p, _ = pool(Scripted(RequestFailed("http", 401)), Scripted("b"))
    assert p.chat([], 0) == "b" and p.snapshot()[0]["disabled"]
    q, _ = pool(Scripted(RequestFailed("http", 400)))
    with pytest.raises(RequestFailed):
        q.chat([], 0)
    r, _ = pool(Scripted(RequestFailed("http", 403)))
    with pytest.raises(Outage):
        r.chat([], 0)


def test_busy_endpoint_is_left_in_peace():
    p, slept = pool(Scripted(RequestFailed("http", 429, 5.0), "late"))
    assert p.chat([], 0) == "late" and sum(slept) >= 5.0


def test_load_and_shares():
    rows = load(Scripted("x"), [[], []], 3, 0.05)
    assert rows and all(r["error"] is None for r in rows) and share_of(32, 5) == 6 and share_of(1, 9) == 1


def test_warm_up_is_left_out():
    rows = load(Scripted("x"), [[]], 2, 0.03, warm_up=0.03)
    assert rows and all(r["begun"] >= 0.03 for r in rows)


def test_bounded_map_keeps_order():
    def work(x):
        if x == 3:
            raise ValueError("three")
        return x * x

    got = in_order(work, list(range(20)), 4)
    assert got[:3] == [0, 1, 4] and isinstance(got[3], ValueError) and got[19] == 361 and in_order(work, [], 2) == []
    with pytest.raises(Outage):
        in_order(lambda x: Pool([]).chat([], x), [1, 2], 1)
    with pytest.raises(ValueError):
        in_order(work, [1], 0)


def test_pool_travels_without_its_locks():
    import pickle

    p = PoolOf([("a", Scripted("x"), 1, None)])
    assert p.chat([], 0) == "x" and pickle.loads(pickle.dumps(p)).chat([], 0) == "x"
