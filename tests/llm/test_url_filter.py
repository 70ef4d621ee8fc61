import datetime as dt
import re

from tessera.llm import url_filter as uf

D = dt.date


def keys(url, depth=2):
    m = re.match(uf.HOST, url or "")
    if not m:
        return []
    host = m[1].lower()
    labels = host.split(".")
    out = [".".join(labels[i:]) for i in range(max(1, len(labels) - 1))]
    segs = [s for s in re.match(uf.PATH, url)[1].split("/") if s]
    return list(dict.fromkeys(out + [host + "/" + "/".join(segs[:i + 1]) for i in range(min(depth, len(segs)))]))


def brute(captures, events):
    """State of every (key, category) at the fetch time by replaying its events."""
    out = []
    for cid, url, at in set(captures):
        active = []
        for key in keys(url):
            for cat in {c for k, c, _, _ in events if k == key}:
                past = sorted((e[3], e[2]) for e in events if e[0] == key and e[1] == cat and at is not None and e[3] and e[3] <= at)
                # a removal wins over an addition of the same moment
                if past and max(a for d, a in past if d == past[-1][0]) == "add":
                    active.append((len(key), past[-1][0], key, cat != "allow", cat))
        top = max(active) if active else None
        out.append((cid, url, at, len(active), bool(top) and top[3], top and top[2], top and top[4], top and top[1]))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.url, r.fetched_at, r.n_active, r.blocked, r.list_key, r.category, r.listed_since)
                   for r in df.collect()), key=str)


EVENTS = [("bad.example.com", "spam", "add", D(2023, 1, 10)), ("bad.example.com", "spam", "remove", D(2023, 2, 10)),
          ("bad.example.com", "spam", "add", D(2023, 3, 10)), ("example.com", "malware", "add", D(2023, 1, 1)),
          ("bad.example.com/ok", "allow", "add", D(2023, 1, 1)), ("tie.org", "spam", "add", D(2023, 5, 5)),
          ("tie.org", "spam", "remove", D(2023, 5, 5)), ("twice.org", "spam", "add", D(2023, 1, 1)),
          ("twice.org", "spam", "add", D(2023, 6, 1)), ("twice.org", "spam", "add", D(2023, 6, 1)), (None, "spam", "add", D(2023, 1, 1)),
          ("twice.org", "adult", "add", None), ("both.org", "adult", "add", D(2023, 1, 1)), ("both.org", "allow", "add", D(2023, 1, 1)),
          ("both.org", "malware", "add", D(2023, 1, 1)), ("late.org", "phishing", "add", D(2023, 1, 1)), ("late.org", "allow", "add", D(2023, 1, 5))]
CAPTURES = [(i, u, t) for i, u in enumerate([
    "http://bad.example.com/x", "https://BAD.example.com:80/ok/deep?q", "http://other.example.com", "http://tie.org/", "http://twice.org", "http://both.org/x", "http://late.org",
    None, "", "no url", "ftp://user@www.bad.example.com/a/b/c#f", "http://localhost/x"]) for t in (
        D(2022, 1, 1), D(2023, 1, 10), D(2023, 2, 9), D(2023, 2, 10), D(2023, 5, 5), D(2023, 7, 1), None)]


def test_captures_are_judged_by_the_list_of_their_day(spark):
    ev = spark.createDataFrame(EVENTS, "list_key string, category string, action string, at date")
    cap = spark.createDataFrame(CAPTURES + CAPTURES[:3], "page_id int, url string, fetched_at date").selectExpr(
        "*", "'x' as list_key", "1 as salt", "2 as cid", "3 as category")
    intervals = uf.validity_intervals(ev)
    assert got(uf.judge(cap, intervals)) == brute(CAPTURES, [e for e in EVENTS if e[0]])
    assert got(uf.judge(cap.limit(0), intervals)) == []
    none = got(uf.judge(cap, intervals.limit(0)))
    assert len(none) == len(CAPTURES) and not any(r[4] for r in none)


def test_keys(spark):
    urls = ["http://a.b.example.com/x/y/z", "https://example.com", "http://h/p//q", "bad", None, "http://" + "s." * 2000 + "com/" + "p/" * 2000]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [list(r.k) for r in df.select(uf.capture_keys(df.url).alias("k")).collect()] == [keys(u) for u in urls]


def test_intervals(spark):
    ev = spark.createDataFrame(EVENTS, "list_key string, category string, action string, at date")
    spans = sorted(((r.list_key, r.valid_from, r.valid_to) for r in uf.validity_intervals(ev).collect()
                    if r.category == "spam"), key=str)
    assert spans == [("bad.example.com", D(2023, 1, 10), D(2023, 2, 10)), ("bad.example.com", D(2023, 3, 10), None),
                     ("twice.org", D(2023, 1, 1), D(2023, 6, 1)), ("twice.org", D(2023, 6, 1), None)]


def test_entries_of_any_path_depth(spark):
    """An entry matches as many path segments as it has."""
    deep = "d.org/" + "/".join("abcdefgh")
    events = [("h.com/a/b/c", "spam", "add", D(2023, 1, 1)), ("h.com/a", "allow", "add", D(2023, 1, 1)), (deep, "adult", "add", D(2023, 1, 1))]
    urls = {"http://h.com/a/b/c": "h.com/a/b/c", "http://h.com/a//b/c/d?x": "h.com/a/b/c", "http://h.com/a/b": "h.com/a",
            "http://h.com/a/b/cc": "h.com/a", "http://" + deep + "/i/j": deep, "http://d.org/a/b/c": None}
    cap = spark.createDataFrame([(i, u, D(2023, 2, 1)) for i, u in enumerate(urls)], "page_id int, url string, fetched_at date")
    ev = spark.createDataFrame(events, "list_key string, category string, action string, at date")
    intervals = uf.validity_intervals(ev)
    assert {r.url: r.list_key for r in uf.judge(cap, intervals).collect()} == urls
    assert {r.url for r in uf.judge(cap, intervals).where("blocked").collect()} == {u for u, k in urls.items() if k and k != "h.com/a"}


def test_one_key_in_several_categories(spark):
    """Blocking comes before 'allow' on the same day; a later 'allow' wins."""
    ev = spark.createDataFrame(EVENTS, "list_key string, category string, action string, at date")
    cap = spark.createDataFrame([(1, "http://both.org/", D(2023, 2, 1)), (2, "http://late.org/", D(2023, 2, 1)), (3, "http://late.org/", D(2023, 1, 2))],
                                "page_id int, url string, fetched_at date")
    out = {r.page_id: (r.n_active, r.blocked, r.category) for r in uf.judge(cap, uf.validity_intervals(ev)).collect()}
    assert out == {1: (3, True, "malware"), 2: (2, False, "allow"), 3: (1, True, "phishing")}


def test_registered_list_has_deep_entries(spark):
    """Some captures of the table are decided by entries of several path segments."""
    from tessera.llm.registry import QUERIES

    from .conftest import SF
    keys = [r.list_key for r in QUERIES["op10_url_filter"](spark, SF).where("list_key is not null").collect()]
    assert {k.count("/") for k in keys} >= {0, 1, 2}
