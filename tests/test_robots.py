"""Robots rules against a plain loop over the lines of a body."""

import random
import re
from datetime import datetime, timedelta

from harrow.sources import robots

NOW = datetime(2024, 1, 2)
BODY = "﻿# none\nUser-agent: A/1.0\nUser-agent: b\nDisallow: /x # all\nallow : /x/y*z$\nCrawl-delay: 2\nSitemap: s\nUser-agent: *\nDisallow: /\r\nUser-agent: c\nDisallow:\nDisallow no colon\n"


def test_lines():
    got = list(robots.parsed(BODY))
    named = [(r[0], r[2]) for r in got if r[1] == "disallow"]
    assert named == [("a", "/x"), ("b", "/x"), ("*", "/")]
    assert [r[0] for r in got if r[1] == "agent"] == ["a", "b", "*", "c"]
    assert [(r[0], r[3]) for r in got if r[1] == "delay"] == [("a", 2.0), ("b", 2.0)]


def loop(body, agent, path):
    lines = list(robots.parsed(body))
    own = agent if any(r[0] == agent for r in lines) else "*"
    best = None
    for name, kind, pattern, _ in lines:
        if name == own and kind in ("allow", "disallow"):
            bare = pattern.removesuffix("$")
            if re.match("(?s)" + ".*".join(map(re.escape, bare.split("*"))) + (r"\Z" if bare != pattern else ""), path):
                best = max(best or (-1, False, ""), (len(pattern), kind == "allow", pattern))
    return (best[1], best[2]) if best else (True, None)


def test_against_a_loop(spark):
    rng = random.Random(4)
    part = lambda n, chars: "".join(rng.choice(chars) for _ in range(rng.randint(0, n)))
    bodies, pages = [], []
    for k in range(12):
        lines = []
        for _ in range(rng.randint(0, 12)):
            lines += rng.choice([["User-agent: " + rng.choice(["me", "*", "you"])], [rng.choice(["Allow: /", "Disallow: /"]) + part(4, "ab/*$.?(") + part(20, "ab")]])
        bodies.append((f"h{k}.org", "\n".join(lines), 200, NOW - timedelta(hours=1)))
        pages += [(k * 100 + n, f"http://H{k}.org/{part(6, 'ab/.?($')}{part(20, 'ab')}#f") for n in range(40)]
    pages += [(9000, "http://h1.org"), (9001, "http://h1.org?q"), (9002, "nonsense"), (9003, None), (9004, "http://other.org/x"), (0, pages[0][1])]
    df = spark.createDataFrame(pages, "page_id long, url string")
    rules = robots.rules(spark.createDataFrame(bodies, "host string, body string, status int, fetched_at timestamp"), NOW)
    for agent in ("Me/1.2", "nobody"):
        got = sorted((r.page_id, r.allowed, r.rule or "") for r in robots.judged(df, rules, agent).collect())
        want = []
        for i, url in pages:
            m = re.match(r"http://([^/?#]*)([^#]*)", url or "")
            body = next((b for h, b, *_ in bodies if m and h == m[1].lower()), "")
            path = m and (m[2] if m[2].startswith("/") else "/" + m[2])
            allowed, rule = loop(body, agent.split("/")[0].lower(), path) if m else (True, None)
            want.append((i, allowed, rule or ""))
        assert got == sorted(want)


def test_freshness_and_delays(spark):
    rows = [("a.org", BODY, 200, NOW - timedelta(hours=23)), ("b.org", BODY, 200, NOW - timedelta(hours=24)), ("c.org", BODY, 404, NOW), ("d.org", None, 200, NOW), ("a.org", "", 200, NOW - timedelta(hours=30))]
    bodies = spark.createDataFrame(rows, "host string, body string, status int, fetched_at timestamp")
    rules = robots.rules(bodies, NOW)
    assert {r.host for r in rules.collect()} == {"a.org"}
    assert [tuple(r) for r in robots.delays(rules, "B").collect()] == [("a.org", 2000)] and robots.delays(rules, "c").count() == 0
    pages = spark.createDataFrame([(f"http://{h}/x/yaz",) for h in ("a.org", "b.org", "c.org", "d.org", "e.org")], "url string")
    assert {r.host for r in robots.to_read(pages, bodies, NOW).collect()} == {"b.org", "e.org"}
    assert [r.allowed for r in robots.judged(pages, rules, "a").orderBy("url").collect()] == [True] * 5
    assert [r.allowed for r in robots.judged(pages, rules, "zzz").orderBy("url").collect()] == [False, True, True, True, True]
    assert robots.judged(pages.limit(0), rules, "a").count() == 0
