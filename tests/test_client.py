import json

import pytest

from loomspar import config, errors
from loomspar.sources.client import Client


def client(answers, **more):
    calls, waits = [], []

    def transport(method, url, headers, body):
        calls.append((method, url, headers.get("Authorization"), body))
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    return Client("http://x/", transport, lambda: {"Authorization": "t"}, sleep=waits.append, **more), calls, waits


def test_retries_and_parameters():
    c, calls, waits = client([(503, ""), OSError("reset"), (200, '{"a": 1}')])
    assert c.request("GET", "/p", {"a": 1, "b": None}) == {"a": 1} and waits == [1, 2] and calls[0][1] == "http://x/p?a=1"
    c, _, _ = client([(429, ""), (429, ""), (429, "")])
    with pytest.raises(errors.EngineError) as e:
        c.request("GET", "/p")
    assert e.value.code == errors.RATE_LIMIT


def test_failures():
    c, _, _ = client([(400, '{"errors": {"f": "bad"}, "errorMessages": ["no"]}')])
    with pytest.raises(errors.EngineError) as e:
        c.request("POST", "/p", body={"x": 1})
    assert (e.value.code, e.value.message) == (errors.VALIDATION, "f: bad; no")
    c, _, _ = client([(401, ""), (200, "[]")], refresh=lambda: True)
    assert c.request("GET", "/p") == []
    c, _, _ = client([OSError("x")] * 3)
    with pytest.raises(errors.EngineError) as e:
        c.request("GET", "/p")
    assert e.value.code == errors.NETWORK


def test_pages():
    c, _, _ = client([(200, json.dumps({"values": [1, 2], "total": 3})), (200, json.dumps({"values": [3], "total": 3}))])
    assert list(c.pages("/p", 2)) == [1, 2, 3]
    c, _, _ = client([(200, "[1, 2]"), (200, "[3]")])
    assert list(c.pages("/p", 2)) == [1, 2, 3]


def test_settings():
    s = config.load({"TRACKER_URL": "https://h/", "TRACKER_TOKEN": "t", "CACHE_URL": "redis://c:99", "CACHE_PORT": "7"})
    assert (s.base_url, s.cache_host, s.cache_port) == ("https://h", "c", 7) and s.headers() == {"Authorization": "Bearer t"}
    assert config.load({"TRACKER_URL": "http://h", "TRACKER_TOKEN": "t", "TRACKER_USER": "u"}).headers()["Authorization"].startswith("Basic ")
    for bad in ({"TRACKER_URL": "ftp://h", "TRACKER_TOKEN": "t"}, {"TRACKER_URL": "http://h"}, {"TRACKER_URL": "http://h", "TRACKER_TOKEN": "t", "CACHE_PORT": "0"}, {"TRACKER_URL": "http://h", "TRACKER_TOKEN": "t", "AMBIGUITY": "?"}):
        with pytest.raises(errors.EngineError):
            config.load(bad)
    assert config.migrate({"auth": {"token": "t"}})["auth"]["type"] == "token" and config.migrate({"a": 1}) == {"a": 1}


def test_connection_and_deployment():
    c, calls, _ = client([(200, '{"deploymentType": "Cloud"}')])
    assert c.deployment() == c.deployment() == ("cloud", 3) and len(calls) == 1
    c, _, _ = client([(200, '{"version": "9"}')])
    assert c.deployment() == ("server", 2)
    c, _, _ = client([(401, "")])
    with pytest.raises(errors.EngineError) as e:
        c.check_connection()
    assert e.value.code == errors.NETWORK


def test_progress_is_followed():
    from loomspar.streaming.progress import follow

    now, counts, seen = [0.0], iter([0, 3, 3, 9]), []
    last = follow(lambda: next(counts), 9, seen.append, clock=lambda: now[0], wait=lambda s: now.__setitem__(0, now[0] + s))
    assert [x["count"] for x in seen] == [0, 3, 3, 9] and last["complete"] and last["at"] == 6000
    now[0] = 0.0
    last = follow(lambda: 2, 9, seen.append, stuck_ms=5000, clock=lambda: now[0], wait=lambda s: now.__setitem__(0, now[0] + s))
    assert last["stuck"] and not last["complete"] and last["at"] == 6000


def test_lookups_by_project():
    from loomspar.streaming.progress import ExpiringCache, Lookups

    now = [0.0]
    kept = Lookups(ExpiringCache(clock=lambda: now[0]))
    kept.set("P", "priority", [1])
    kept.set("P", "option", [2], "Bug")
    kept.set("Q", "option", [3])
    assert kept.get("P", "option", "Bug") == [2] and kept.get("P", "option") is None and kept.stats() == {"P": 2, "Q": 1}
    assert len(kept.clear("P", "option")) == 1 and kept.get("P", "priority") == [1] and kept.stats() == {"P": 1, "Q": 1}
    now[0] = 901
    assert kept.get("Q", "option") is None
