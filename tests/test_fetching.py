import json
import threading
import time

import pytest

from registrylake.sources import fetching as f


class Site:
    """Answers by url, in turn if there are several; what was asked is kept."""

    def __init__(self, **answers):
        self.answers, self.asked, self.slept = answers, [], []

    def __call__(self, url, headers):
        self.asked.append((url, headers))
        key = next(k for k in sorted(self.answers, key=len, reverse=True) if k in url)
        got = self.answers[key]
        if isinstance(got, list):
            got = got.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    def sleep(self, s):
        self.slept.append(s)


def page(value, status=200, **headers):
    return f.Response(status, json.dumps(value), headers)


def test_parameters_are_bound(spark):
    got = f.rows(spark, "SELECT :a AS a, :b AS b", a="x' OR 1 = 1 --", b=3).first()
    assert tuple(got) == ("x' OR 1 = 1 --", 3)


def test_authenticated_json_counts_and_throws():
    site, calls = Site(one=page({"x": 1}), two=page({}, 403)), []
    assert f.get_json(site, "h/one", "t", calls) == {"x": 1} and site.asked[0][1]["authorization"] == "Bearer t"
    assert "authorization" not in (f.get_json(site, "h/one"), site.asked[1][1])[1]
    with pytest.raises(f.FetchFailed):
        f.get_json(site, "h/two", None, calls)
    assert calls == ["h/one", "h/two"]


def test_null_on_any_failure():
    site = Site(a=page({"x": 1}), b=page({}, 500), c=f.Response(200, "<html>"), d=TimeoutError())
    assert [f.json_or_none(site, u) for u in "abcd"] == [{"x": 1}, None, None, None]


@pytest.mark.parametrize("statuses, end, waits", [([200], 200, []), ([429, 429, 200], 200, [5.0, 15.0]), ([429] * 4, 429, [5.0, 15.0, 45.0]), ([500], 500, []), ([429, 503], 503, [5.0])])
def test_the_same_page_is_retried_on_429_only(statuses, end, waits):
    site = Site(u=[f.Response(s) for s in statuses])
    assert f.page_with_retry(site, "u", lambda h: None, site.sleep).status == end
    assert site.slept == waits and len({u for u, _ in site.asked}) == 1


def test_retry_after_is_honoured():
    site = Site(u=[f.Response(429, None, {"retry-after": "2"}), f.Response(200)])
    assert f.page_with_retry(site, "u", lambda h: int(h) * 1000 if h else None, site.sleep).ok and site.slept == [2.0]


def test_cursor_chain_ends():
    answers = {"first": "b", "b": "c", "c": "b"}
    asked = []

    def fetch(url):
        cursor = url.rsplit("cursor=", 1)[1] if "cursor=" in url else "first"
        asked.append(cursor)
        return page({"servers": [cursor], "metadata": {"nextCursor": answers[cursor]}})

    assert [p["servers"][0] for p in f.cursor_pages(fetch, "h", {"limit": 100}, lambda s: None)] == ["first", "b", "c"]
    with pytest.raises(f.FetchFailed):
        list(f.cursor_pages(lambda u: f.Response(500), "h", {}, lambda s: None))


def test_search_stops_on_a_short_page_and_at_the_window():
    full, short = page({"objects": [0] * 250}), page({"objects": [0] * 249})
    site = Site(**{"from=0": full, "from=250": [page({}, 502), page({}, 502), full], "from=500": short})
    assert [len(p["objects"]) for p in f.search(site, "h", "mcp sdk", site.sleep)] == [250, 250, 249] and site.slept == [1.5, 3.0]
    assert "keywords:mcp%20sdk&size=250&from=0" in site.asked[0][0]
    site = Site(h=full)
    assert len(list(f.search(site, "h", "k", site.sleep, window=1000))) == 4 and site.asked[-1][0].endswith("from=750")
    site = Site(h=page({}, 500))
    with pytest.raises(f.FetchFailed):
        list(f.search(site, "h", "k", site.sleep))
    assert site.slept == [1.5, 3.0, 6.0]


def test_tree_is_walked_by_segments():
    trees = {"trees/main": {"tree": [{"path": "a", "type": "tree", "sha": "1"}, {"path": "b", "type": "blob", "sha": "x"}]}, "trees/1": {"tree": [{"path": "c", "type": "tree", "sha": "2"}]}, "trees/2?recursive=1": {"tree": [{"path": "d/e", "type": "blob"}]}}
    get = lambda url: trees[url.split("git/")[1]]
    assert f.tree_of(get, "h", "main", "a/c") == [{"path": "d/e", "type": "blob"}]
    with pytest.raises(f.FetchFailed):
        f.tree_of(get, "h", "main", "b")  # a file is no tree
    trees["trees/2?recursive=1"]["truncated"] = True
    with pytest.raises(f.FetchFailed):
        f.tree_of(get, "h", "main", "a/c")


def test_bounded_map_keeps_order_and_bound():
    lock, now, most = threading.Lock(), [0], [0]

    def work(x):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.002 * (x % 3))
        with lock:
            now[0] -= 1
        return x * x

    assert f.in_order(list(range(40)), work, 4) == [x * x for x in range(40)] and 1 < most[0] <= 4
    assert f.in_order([], work) == []
    with pytest.raises(ZeroDivisionError):
        f.in_order([1, 0], lambda x: 1 / x)


def test_chunks_and_errors():
    assert list(f.chunks([1, 2, 3, 4, 5], 2)) == [[1, 2], [3, 4], [5]] and list(f.chunks([], 2)) == []
    with pytest.raises(ValueError):
        list(f.chunks([1], 0))
    assert json.loads(f.error_text(OSError(5, "no"))) == {"name": "OSError", "message": "[Errno 5] no", "errno": 5}
