from __future__ import annotations

import re

import pytest

from tenderlake.llm import urls

CHANGES = [
    ("bad.com", 10, "block"), ("bad.com", 50, "remove"), ("bad.com", 70, "block"),
    ("good.bad.com", 20, "allow"), ("shop.org/a", 0, "block"), ("shop.org/a/b", 30, "allow"),
    ("Upper.NET", 5, "block"), ("twice.com", 5, "allow"), ("twice.com", 5, "block"),
    (None, 1, "block"), ("x.com", None, "block"), ("y.com", 3, None), ("y.com", 3, "other"),
]
URLS = [
    "http://bad.com/", "https://good.bad.com/x", "http://a.good.bad.com:80/x?q", "http://notbad.com/",
    "http://shop.org/a", "http://shop.org/a/b/c", "http://shop.org/ab", "http://u@UPPER.net", "http://twice.com#f",
    None, "", "no url", "http:///x", "ftp://bad.com/z", "http://x.com/", "http://y.com/" + "s/" * 5000,
]


def brute(url, day):
    spans = []
    rank = {"block": 0, "allow": 1, "remove": 2}
    for pattern in {p.lower() for p, d, a in CHANGES if p and d is not None and a in rank}:
        daily = {}
        for p, d, a in CHANGES:
            if p and p.lower() == pattern and d is not None and a in rank:
                daily[d] = min(daily.get(d, 9), rank[a])
        days = sorted(daily)
        for k, d in enumerate(days):
            until = days[k + 1] if k + 1 < len(days) else 10**9
            if daily[d] < 2 and day is not None and d <= day < until:
                spans.append((pattern, "block" if daily[d] == 0 else "allow"))
    m = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)(?::[^/?#]*)?(/[^?#]*)?", url or "", re.I)
    if not m:
        return ("none", None, 0)
    host, path = m[1].lower(), [p for p in (m[2] or "").split("/") if p]
    labels = host.split(".")
    keys = {".".join(labels[k:]) for k in range(len(labels))}
    keys |= {"/".join([host, *path[:k]]) for k in range(1, len(path) + 1)}
    hits = sorted((p for p in spans if p[0] in keys), key=lambda p: len(p[0]))
    return (hits[-1][1], hits[-1][0], len(hits)) if hits else ("none", None, 0)


@pytest.fixture
def changes(llm):
    return llm.createDataFrame(CHANGES, "pattern string, day int, action string")


def test_as_of_join_equals_brute_force(llm, changes):
    days = [0, 9, 10, 25, 49, 50, 69, 70, 300, None]
    rows = [(k * 100 + d, u, day, "x") for k, u in enumerate(URLS) for d, day in enumerate(days)]
    rows += [rows[0], rows[0], (None, "http://bad.com/", 10, "x")]
    captures = llm.createDataFrame(rows, "capture_id long, url string, fetch_day int, month string")
    out = urls.judge(captures, changes, 300).collect()
    got = [(r["capture_id"], r["fetch_day"], r["decision"], r["pattern"], r["n_active"]) for r in out]
    want = [(i, day, *brute(u, day)) for i, u, day, _ in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_empty_sides(llm, changes):
    captures = llm.createDataFrame([], "capture_id long, url string, fetch_day int")
    assert urls.judge(captures, changes, 10).collect() == []
    some = llm.createDataFrame([(1, "http://bad.com", 20)], captures.schema)
    (row,) = urls.judge(some, changes.limit(0), 30).collect()
    assert row["decision"] == "none" and row["n_active"] == 0


def test_plan_has_no_product(llm, changes):
    captures = llm.createDataFrame([(1, "http://bad.com", 20)], "capture_id long, url string, fetch_day int")
    plan = urls.judge(captures, changes, 30)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("CartesianProduct", "BroadcastNestedLoop", "Python"))


def test_deep_paths_and_their_case(llm):
    """Entries of any depth, against plain prefixes of the whole path."""
    log = [("shop.org/a/b/c", 0, "block"), ("shop.org/a/b/c/d/e/f", 5, "allow"), ("Shop.ORG/Sale", 0, "block"),
           ("shop.org", 0, "allow"), ("shop.org/A/B/C", 8, "remove")]
    pages = ["http://shop.org/a/b/c", "http://shop.org/a/b/c/d/e/f/g?q=/h", "http://shop.org/a/b", "HTTP://SHOP.org/Sale",
             "HTTPS://shop.org/a/b/c/x", "http://shop.org/sale", "http://shop.org/A/B/C", "http://x.shop.org/a/b/c",
             "http://shop.org/a/b/cc", "http://shop.org/Sale/" + "s/" * 500]
    entries = {p.split("/", 1)[0].lower() + "".join("/" + x for x in p.split("/")[1:]): (d, a) for p, d, a in log}

    def plain(url, day):
        host, *path = re.sub(r"[?#].*", "", url.split("://", 1)[1]).split("/")
        host, path = host.lower(), [p for p in path if p]
        labels = host.split(".")
        keys = [".".join(labels[k:]) for k in range(len(labels))]
        keys += ["/".join([host, *path[:k]]) for k in range(1, len(path) + 1)]
        hits = [(len(k), k, entries[k][1]) for k in keys if k in entries and entries[k][0] <= day and entries[k][1] != "remove"]
        return (max(hits)[2], max(hits)[1], len(hits)) if hits else ("none", None, 0)

    rows = [(k * 100 + day, u, day) for k, u in enumerate(pages) for day in (0, 4, 5, 9)]
    captures = llm.createDataFrame(rows, "capture_id long, url string, fetch_day int")
    out = urls.judge(captures, llm.createDataFrame(log, "pattern string, day int, action string"), 9).collect()
    got = {r["capture_id"]: (r["decision"], r["pattern"], r["n_active"]) for r in out}
    assert got == {i: plain(u, day) for i, u, day in rows}
    assert got[0] == ("block", "shop.org/a/b/c", 2) and got[105][0] == "allow" and got[300][:2] == ("block", "shop.org/Sale")


@pytest.mark.parametrize("entry", ["shop.org/a", "shop.org/a/", "http://shop.org/a", "HTTPS://u:p@Shop.ORG:8080//a//",
                                   ".shop.org", "shop.org:80", "shop.org/", "//shop.org", " shop.org. ", "..org"])
def test_entries_as_lists_write_them(llm, entry):
    log = llm.createDataFrame([(entry, 1, "block")], "pattern string, day int, action string")
    some = llm.createDataFrame([(1, "http://shop.org/a/b/c", 20)], "capture_id long, url string, fetch_day int")
    (row,) = urls.judge(some, log, 30).collect()
    want = "org" if entry == "..org" else "shop.org/a" if "a" in entry else "shop.org"
    assert (row["decision"], row["pattern"], row["n_active"]) == ("block", want, 1)


def test_what_is_no_entry_is_reported(llm):
    bad = ["shop.org/a?x=1", "shop.org#f", "", "/a", "two words.org", None, "http://"]
    log = llm.createDataFrame([(p, 1, "block") for p in [*bad, "shop.org"]], "pattern string, day int, action string")
    assert {r["pattern"] for r in urls.unreadable(log).collect()} == set(bad)
    some = llm.createDataFrame([(1, "http://shop.org/a?x=1", 20)], "capture_id long, url string, fetch_day int")
    (row,) = urls.judge(some, log, 30).collect()
    assert (row["pattern"], row["n_active"]) == ("shop.org", 1)


@pytest.mark.parametrize("way", ["groupBy", "dropDuplicates", "sort"])
def test_captures_behind_an_exchange(llm, changes, way):
    """Rows whose order differs from one reading of the plan to the next."""
    rows = [(k, f"{URLS[k % 9]}{'' if k % 3 else '?' + str(k)}", k % 80) for k in range(1500)]
    captures = llm.createDataFrame(rows * 2, "capture_id long, url string, fetch_day int").repartition(16)
    if way == "groupBy":
        captures = captures.groupBy("capture_id").agg({"url": "max", "fetch_day": "max"}).toDF("capture_id", "u", "d")
        captures = captures.selectExpr("capture_id", *(["u AS url", "d AS fetch_day"] if dict(captures.dtypes)["u"] == "string"
                                                       else ["d AS url", "u AS fetch_day"]))
    elif way == "dropDuplicates":
        captures = captures.dropDuplicates(["capture_id"])
    else:
        captures = captures.distinct().orderBy("fetch_day")
    out = urls.judge(captures, changes, 300).collect()
    got = sorted((r["capture_id"], r["decision"], r["pattern"] or "", r["n_active"]) for r in out)
    want = [(i, d, p or "", n) for i, u, day in rows for d, p, n in [brute(u, day)]]
    assert got == sorted(want)
